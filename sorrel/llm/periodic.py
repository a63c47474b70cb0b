"""Periodic runs: stretches of words that repeat with a period, found from a dictionary of basic factors."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import documents, slices, strings
from sorrel.llm.words import SPACE

#: Bytes of text that are searched at a time; a longer text is searched alone.
BLOCK = 2_000_000
#: Occurrences within twice a factor's length that are further apart than half of it fall into so many groups at most.
GROUPS = 4


def _words(texts: pa.LargeStringArray):
    """(all words as one binary array, each text's number of words)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    raw = np.full(len(data) + len(texts) + 2, 32, np.uint8)
    raw[1 + np.arange(len(data)) + np.repeat(np.arange(len(texts)), np.diff(offsets))] = data
    inside = ~SPACE[raw]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    edges = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw[inside])])
    return words, np.diff(np.searchsorted(starts, 1 + (offsets - offsets[0]) + np.arange(len(offsets))))


def level_of(period: int, least: int) -> int:
    """The power of two whose factors propose the period: every run of the period holds one such factor twice, the period apart, and either they overlap by half or the period is one to two lengths."""
    m = 1 << ((max(least, 2 * period) - period).bit_length() - 1)
    return m // 2 if m // 2 < period < m else m


def _proposed(name: np.ndarray, m: int, small: np.ndarray, large: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, periods) that the occurrences of factors of m words propose: gaps between successors that are one of the `small`, and distances in the range `large`.

    Occurrences in a row no more than half a length apart lie at equal distances: an arithmetic progression. Two runs of one period within a larger one map its progressions onto each other, so the larger period is a distance
    between some occurrence and the first of a later progression, or the last of an earlier one; within two lengths there are few.
    """
    at = np.flatnonzero(name >= 0)
    at = at[np.argsort(name[at], kind="stable")]
    if len(at) < 2:
        return at[:0], at[:0]
    same = name[at[1:]] == name[at[:-1]]
    gap = np.diff(at)
    found = [(at[:-1][k], gap[k]) for k in [same & np.isin(gap, small)]]
    opens = np.concatenate([[True], ~(same & (gap <= m // 2))])
    group = np.cumsum(opens) - 1
    firsts = np.flatnonzero(opens)
    lasts = np.append(firsts[1:], len(at)) - 1
    for t in range(1, GROUPS + 1):
        other = np.minimum(group + t, len(firsts) - 1)
        j = at[firsts[other]]
        ok = (group + t < len(firsts)) & (name[j] == name[at]) & (j - at >= large[0]) & (j - at < large[1])
        found.append((at[ok], (j - at)[ok]))
        other = np.maximum(group - t, 0)
        i = at[lasts[other]]
        ok = (group >= t) & (name[i] == name[at]) & (at - i >= large[0]) & (at - i < large[1])
        found.append((i[ok], (at - i)[ok]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _extended(words: np.ndarray, i: int, period: int) -> tuple[int, int]:
    """Start and end of the longest stretch with the period that holds position i."""
    a, b, step = i, i, 32
    while b + period < len(words):
        differ = np.flatnonzero(words[b : b + step][: len(words) - period - b] != words[b + period : b + period + step])
        if len(differ):
            b += int(differ[0])
            break
        b, step = min(b + step, len(words) - period), min(2 * step, 1 << 16)
    step = 32
    while a > 0:
        low = max(0, a - step)
        differ = np.flatnonzero(words[low:a] != words[low + period : a + period])
        if len(differ):
            a = low + int(differ[-1]) + 1
            break
        a, step = low, min(2 * step, 1 << 16)
    return a, b + period


def runs(words: np.ndarray, counts: np.ndarray, least: int = 12) -> np.ndarray:
    """(start, end, period) of the runs of several texts in a row, by start, then period. `words`: the number of each word; `counts`: each text's words.

    Basic factors: a factor of 2m words is named by the names of its halves. Only factors that occur twice in a text can hold a run, so only they have names, and the lengths stop when there are none left.
    """
    if not len(words):
        return np.zeros((0, 3), np.int64)
    name = pd.factorize(np.repeat(np.arange(len(counts)), counts) * (int(words.max()) + 1) + words)[0].astype(np.int64)
    whole, m, proposed = name, 1, []
    levels: dict[int, list[int]] = {}
    for q in range(1, max(2, least)):
        levels.setdefault(level_of(q, least), []).append(q)
    name = np.where(np.bincount(name)[name] > 1, name, -1)
    while (name >= 0).any():
        # beyond `least` words the periods of a level are m to 2m - 1
        own = levels.get(m, []) + [q for q in (m, 2 * m - 1) if q >= least]
        small = np.array([q for q in own if q < m], np.int64)
        large = [q for q in own if q >= m]
        if len(small) or large:
            i, q = _proposed(name, m, small, (min(large), max(large) + 1) if large else (1, 1))
            proposed.append(np.stack([q, i], axis=1))
        at = np.flatnonzero(name >= 0)
        at = at[at + m < len(name)]
        at = at[name[at + m] >= 0]
        longer = pd.factorize(name[at] * (int(name.max()) + 1) + name[at + m])[0]
        kept = np.bincount(longer)[longer] > 1 if len(at) else np.zeros(0, bool)
        name = np.full(len(whole), -1, np.int64)
        name[at[kept]] = longer[kept]
        m *= 2
    if not proposed:
        return np.zeros((0, 3), np.int64)
    pairs = np.unique(np.concatenate(proposed), axis=0)
    found, end = {}, (0, -1)
    for q, i in pairs.tolist():
        if (q, i) < end:  # within the stretch just found
            continue
        a, b = _extended(whole, i, q)
        end = (q, b - q)
        if b - a >= max(least, 2 * q):
            found.setdefault((a, b), q)  # smaller periods come first
    return np.array(sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def periodic_runs(docs: DataFrame, min_words: int = 12, text: str = "text") -> DataFrame:
    """All columns of `docs` with n_words, runs (start, length, period; by start, then period) and collapsed_text.

    A run is a stretch of consecutive words `[^\\x20\\x09-\\x0D]+` of a text, `min_words` long at least and twice its smallest period, which no neighbouring word extends. Collapsed text is the
    words joined by one space, without those that a run holds after its first period. Every document is searched by itself and whole; nothing is shuffled. Runs of one period are held once however often they repeat, and words are
    compared as they are, not by a hash.

    Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows each have their row. Columns that bear a name of the result's are replaced. An empty table gives an empty result.
    """
    own = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed_text")]
    rows = docs.select(F.struct(*own).alias("row"), F.col(text).cast("string").alias("text"))
    result = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string"

    def of(batches):
        for batch in batches:
            texts = strings(batch.column(1))
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, np.int64)
            for a, b in slices(lengths, BLOCK):
                words, counts = _words(texts.slice(a, b - a))
                found = runs(words.dictionary_encode().indices.to_numpy(), counts, min_words)
                begins = np.cumsum(counts) - counts
                text_of = np.searchsorted(begins, found[:, 0], side="right") - 1
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, found[:, 0] + found[:, 2], 1)
                np.add.at(gone, found[:, 1], -1)
                kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
                # the kept words as one list for each text
                ends = np.searchsorted(kept, np.append(begins, len(words)))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(kept)).cast(pa.large_string()).cast(pa.string()))
                collapsed = pc.binary_join(lists, " ")
                spans = pa.StructArray.from_arrays([pa.array(found[:, 0] - begins[text_of]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], ["start", "length", "period"])
                at = pa.array(np.searchsorted(text_of, np.arange(b - a + 1)).astype(np.int32))
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(counts), pa.ListArray.from_arrays(at, spans), collapsed], ["row", "n_words", "runs", "collapsed_text"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(of, f"row {kind}, {result}").select(*[F.col("row").getField(c).alias(c) for c in own], "n_words", "runs", "collapsed_text")


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """The documents with the words of each tenth one's tail (by a hash of the id) replaced by repetitions of the tail's beginning."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("words")
    a = F.col("a")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce((h % 10 == 0) & F.col("text").isNotNull(), F.lit(False)).alias("tenth"), g.alias("g"))
    rows = rows.withColumn("words", F.when(F.col("tenth"), words)).withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - a) / (3 + F.col("g") % 8)))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.element_at("words", (F.when(i < a, i).otherwise(a + (i - a) % F.col("p")) + 1).cast("int")))
    return rows.select("doc_id", F.when(F.col("tenth") & (n > 0), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeated_tails(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumn("best", best).withColumns({"start": -F.col("best.s"), "length": F.col("best.length"), "period": -F.col("best.p")})
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", F.floor(1000 * F.col("length") / F.col("period")).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
