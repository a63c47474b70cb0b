"""Collocations: phrases whose words come together more often than their parts suggest, counted by language from sorted streams."""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorrel.llm.common import documents, forget, slices, strings, written

#: Phrases have up to so many words.
LONGEST = 4
#: Bytes of text whose phrases a task adds up before it sends them on.
BLOCK = 4_000_000
#: Documents whose phrases say where to cut the stream into parts, and how many phrases are taken at most. This only balances the parts.
SAMPLE_DOCS, SAMPLE_PHRASES = 4000, 200_000
#: Groups by which each language's candidates are first ranked.
SALTS = 64

#: Ends a word within a key, and sorts before all that words hold once smaller bytes are escaped; so the phrases with one beginning stand in a row.
_SEP, _ESCAPE = 9, b"\x0b"
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[[*b".,;:!?", *range(10, 14)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _escaped(data: bytes, below: int) -> bytes:
    return re.sub(b"[\\x00-\\x%02x]" % (below - 1), lambda m: _ESCAPE + bytes([65 + m[0][0]]), data)


def _plain(key: bytes) -> tuple[str, str]:
    """(language, phrase) of a key."""
    lang, *words = (re.sub(rb"\x0b(.)", lambda m: bytes([m[1][0] - 65]), x).decode() for x in key.split(b"\t"))
    return lang, " ".join(words)


def lower_words(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words, A-Z lower-cased, each with a separator behind it; where each begins; where each ends; how many words its piece has from there on)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    raw = np.full(len(data) + len(texts) + 2, 10, np.uint8)  # a line break around each text
    raw[1 + np.arange(len(data)) + np.repeat(np.arange(len(texts)), np.diff(offsets))] = data
    kind = _KIND[raw]
    inside = kind == 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    lengths = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1 - starts
    piece = np.cumsum(kind == 2)[starts]
    lasts = np.flatnonzero(np.diff(piece, append=-1))
    left = np.repeat(lasts, np.diff(lasts, prepend=-1)) - np.arange(len(starts)) + 1
    ends = np.cumsum(lengths + 1) - 1
    out = np.full(ends[-1] + 1 if len(ends) else 0, _SEP, np.uint8)
    out[np.arange(lengths.sum()) + np.repeat(np.arange(len(lengths)), lengths)] = _LOWER[raw[inside]]
    if len(out) and (out < _SEP).any():
        out = np.frombuffer(_escaped(out.tobytes(), _SEP), np.uint8)
        ends = np.flatnonzero(out == _SEP)
    return out, np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)[: len(ends)], ends, left


def phrases(texts: pa.LargeStringArray, lang: bytes, step: int = 1) -> pa.LargeBinaryArray:
    """The key of the longest phrase at each word (each `step`-th one): the language and up to four words of its piece."""
    data, starts, ends, left = lower_words(texts)
    at = np.arange(0, len(starts), step)
    a, b, head = starts[at], ends[at + np.minimum(left[at], LONGEST) - 1], np.frombuffer(lang + b"\t", np.uint8)
    lengths = b - a
    offsets = np.concatenate([[0], np.cumsum(lengths + len(head))])
    out = np.empty(offsets[-1], np.uint8)
    out[(offsets[:-1, None] + np.arange(len(head))).ravel()] = np.tile(head, len(at))
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(offsets[:-1] + len(head), lengths) + within] = data[np.repeat(a, lengths) + within]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])


def _by_language(batch: pa.RecordBatch):
    """(language as in keys, texts) of blocks of the batch."""
    texts, langs = strings(batch.column(0)), pc.fill_null(batch.column(1), "und").dictionary_encode()
    code = langs.indices.to_numpy()
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        own = texts.take(pa.array(np.flatnonzero(code == i)))
        for a, b in slices(pc.binary_length(own).to_numpy(), BLOCK):
            yield _escaped(lang.encode(), 14), own.slice(a, b - a)


def _cuts(docs: DataFrame, parts: int) -> list[bytes]:
    """Keys that cut the stream into about even parts, from the phrases of some documents."""

    def some(batches):
        for batch in batches:
            for lang, texts in _by_language(batch):
                yield pa.record_batch([phrases(texts, lang, 16).cast(pa.binary())], ["key"])

    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    keys = sorted({bytes(r.key) for r in docs.sample(share, 7).mapInArrow(some, "key binary").limit(SAMPLE_PHRASES).collect()})
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _shared(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each key how many of its first bytes the one before it has, too."""
    lengths = np.diff(offsets)
    least = np.minimum(lengths[1:], lengths[:-1])
    first = np.cumsum(least) - least
    within = np.arange(least.sum()) - np.repeat(first, least)
    differ = np.flatnonzero(keys[np.repeat(offsets[1:-1], least) + within] != keys[np.repeat(offsets[:-2], least) + within])
    at = np.searchsorted(differ, first)
    found = differ[np.minimum(at, len(differ) - 1)] if len(differ) else np.zeros(len(first), np.int64)
    has = (at < len(differ)) & (found < first + least)
    return np.concatenate([[0], np.where(has, found - first, least)])


class _PrefixCounts:
    """Counts of every beginning of the keys of a sorted stream, of which one for each length is open at a time: no table of phrases is kept."""

    def __init__(self, least: int):
        self.least, self.last, self.open = least, None, [None] * (LONGEST + 1)

    def add(self, keys: pa.Array, n: np.ndarray) -> list[tuple[bytes, int, int]]:
        """(beginning, its words, count) of those that end here and count, or may have begun before the stream."""
        whole = pa.concat_arrays([pa.array([self.last or b""], pa.large_binary()), keys.cast(pa.large_binary())])
        offsets = np.frombuffer(whole.buffers()[1], np.int64)[: len(whole) + 1]
        data = np.frombuffer(whole.buffers()[2], np.uint8)
        shared, tabs = _shared(data, offsets), np.flatnonzero(data[: offsets[-1]] == _SEP)
        first = np.searchsorted(tabs, offsets)
        depth = np.diff(first)
        out = []
        for d in range(LONGEST + 1):
            rows = np.flatnonzero(depth[1:] >= d) + 1
            if not len(rows):
                continue
            # where the beginning of d words ends, in this key and in the one before
            end = lambda r: np.where(depth[r] > d, tabs[np.minimum(first[r] + d, len(tabs) - 1)], offsets[r + 1]) - offsets[r]  # noqa: B023,E731
            here = end(rows)
            new = ~((depth[rows - 1] >= d) & (end(rows - 1) == here) & (shared[rows] >= here))
            new[0] |= self.last is None
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(n[rows - 1], np.unique(np.concatenate([[0], starts])))
            if not new[0]:
                self.open[d][1] += int(sums[0])
                sums = sums[1:]
            if not len(starts):
                continue
            name = lambda s: data[offsets[rows[s]] : offsets[rows[s]] + here[s]].tobytes()  # noqa: B023,E731
            if self.open[d] is not None:
                out.append((self.open[d][0], d, self.open[d][1], self.open[d][2]))
            ended = sums[:-1]
            fresh = self.open[d] is None  # the first of the stream may go on from an earlier part
            for i in np.flatnonzero((ended >= self.least) | (fresh & (np.arange(len(ended)) == 0)) | (d == 0)):
                out.append((name(starts[i]), d, int(ended[i]), True))
            self.open[d] = [name(starts[-1]), int(sums[-1]), fresh and len(starts) == 1]
        self.last = keys[-1].as_py()
        return [(k, d, f) for k, d, f, may in out if f >= self.least or may or d == 0]

    def end(self) -> list[tuple[bytes, int, int]]:
        return [(x[0], d, x[1]) for d, x in enumerate(self.open) if x is not None]


def phrase_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, f) of phrases of up to four words that occur `least` times or more in a language; and a row of no words with the number of all its words.

    At each word the longest phrase there stands for its beginnings, too. Tasks add up equal ones of a few MB of text. The phrases then go, cut at keys of the stream and not by a hash, to parts that are sorted: the stream of counts
    in prefix order. One pass over a part counts every beginning. Beginnings that go on over a cut, at most one for each length and side, are added up after.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    cuts = _cuts(docs, parts)

    def of(batches):
        for batch in batches:
            for lang, texts in _by_language(batch):
                found = pc.value_counts(phrases(texts, lang))
                keys = found.field(0)
                part = np.fromiter((bisect_right(cuts, k) for k in keys.to_pylist()), np.int32, len(keys))
                for at in range(0, len(keys), 200_000):
                    yield pa.record_batch([pa.array(part[at : at + 200_000]), keys.slice(at, 200_000).cast(pa.binary()), found.field(1).slice(at, 200_000)], ["part", "key", "n"])

    def count(batches):
        stream = _PrefixCounts(least)

        def rows(found):
            names = [_plain(k) for k, _, _ in found]
            return pa.record_batch([pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.string()), pa.array([d for _, d, _ in found], pa.int32()), pa.array([f for _, _, f in found], pa.int64())], ["lang", "phrase", "words", "f"])

        for batch in batches:
            if len(batch):
                yield rows(stream.add(batch.column(0), batch.column(1).to_numpy()))
        yield rows(stream.end())

    stream = docs.mapInArrow(of, "part int, key binary, n long").repartitionById(len(cuts) + 1, "part").select("key", "n").sortWithinPartitions("key")
    counted = written(stream.mapInArrow(count, "lang string, phrase string, words int, f long"), "phrases")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(f"f >= {least} or words = 0")


def _join(words, first, n):
    return F.array_join(F.slice(words, first, n), " ")


def collocations(docs: DataFrame, least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to 4 words that occur `least` times or more.

    The phrase counts are merge-joined with themselves in two orders: by the first words of a phrase, which gives the left counts of its cuts, and by its last words, which gives the right counts. Merged with its extensions by
    a word on either side, which stand next to it in these orders, a phrase goes if one of them has `covered` percent of its count. (A longer phrase that holds it counts no more than such an extension.) The score of a cut
    is floor(2000000 a / (l + r)), in decimals of 38 digits; the lowest one, at the first cut that has it, is the phrase's.

    Texts (null: empty) are lower-cased for A-Z and split into pieces at `[.,;:!?\\x0A-\\x0D]`, and these into words `[^\\x20\\x09]+`; a null lang is `und`. Ties are ordered by count, then by phrase in bytes. Repeated rows count as often
    as they occur. An empty table gives an empty result. Other columns are ignored.
    """
    counts = written(phrase_counts(docs, least), "phrase-counts")
    words = F.split("phrase", " ")
    of = counts.where("words >= 1").select("lang", F.col("phrase").alias("part"), "f")
    longer = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _join(words, F.lit(1), F.col("k")).alias("first"), _join(words, F.col("k") + 1, F.col("words")).alias("rest"))
    left = cuts.join(of.withColumnsRenamed({"part": "first", "f": "l"}).hint("merge"), ["lang", "first"])
    both = left.join(of.withColumnsRenamed({"part": "rest", "f": "r"}).hint("merge"), ["lang", "rest"])
    a, l, r = (F.col(c).cast("decimal(20,0)") for c in "alr")
    scored = both.withColumn("score", F.floor(F.lit(2_000_000).cast("decimal(7,0)") * a / (l + r)).cast("long"))
    # decimal division keeps a few digits only, so the floor is settled by exact products
    s = F.col("score").cast("decimal(10,0)")
    over = s * (l + r) > F.lit(2_000_000).cast("decimal(7,0)") * a
    under = (s + 1) * (l + r) <= F.lit(2_000_000).cast("decimal(7,0)") * a
    scored = scored.withColumn("score", F.col("score") - F.when(over, 1).otherwise(0) + F.when(under, 1).otherwise(0))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("b")).select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")

    extensions = counts.where("words >= 3").select("lang", F.explode(F.array(_join(words, F.lit(1), F.col("words") - 1), _join(words, F.lit(2), F.col("words")))).alias("phrase"), "f")
    most = extensions.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = best.join(most.hint("merge"), ["lang", "phrase"], "left").where(f"most is null or {100}BD * most < {covered}BD * a").drop("most")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("salt", "rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir).select("text", "lang"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (SELECT lang, m, list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' ')) AS g FROM words, range(1, 5) t(m) WHERE len(w) >= m),
f AS (SELECT lang, m, p, count(*) AS f FROM (SELECT lang, m, unnest(g) AS p FROM grams) GROUP BY lang, m, p HAVING count(*) >= 30),
cuts AS (SELECT lang, m, p, f AS a, k, array_to_string(string_split(p, ' ')[1:k], ' ') AS first, array_to_string(string_split(p, ' ')[k + 1:], ' ') AS rest FROM f, range(1, 4) t(k) WHERE k < m),
scored AS (SELECT c.*, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f + y.f)::HUGEINT AS BIGINT) AS score FROM cuts c JOIN f x ON c.lang = x.lang AND first = x.p JOIN f y ON c.lang = y.lang AND rest = y.p),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
longer AS (SELECT lang, inner_, max(f) AS most FROM (
  SELECT lang, f, array_to_string(string_split(p, ' ')[i:i + j - 1], ' ') AS inner_ FROM f, range(1, 4) t(i), range(2, 4) u(j) WHERE j < m AND i + j - 1 <= m) GROUP BY lang, inner_),
kept AS (SELECT b.* FROM best b LEFT JOIN longer x ON b.lang = x.lang AND b.p = inner_ WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score
FROM kept k JOIN totals t ON k.lang = t.lang QUALIFY rank <= 2000
"""
