"""Substring dedup: repeated phrases are confirmed over the whole corpus, and Aho-Corasick automata find every place that holds one."""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import NO_ID, documents, strings
from sorrel.llm.words import whole, windows, word_hashes

#: Words of an anchor: the smallest hash of that many words within a window stands for the window in the first, coarse count.
ANCHOR = 5
#: Packed values that go from one shard or bucket to another: `a`, `b` and `c` are arrays side by side.
PACKED = "target int, origin int, a binary, b binary, c binary"
PHRASES = "target int, doc_id long, phrases binary"
RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _first(*values: np.ndarray) -> np.ndarray:
    """Where sorted values, or tuples of values, begin."""
    out = np.ones(len(values[0]), bool)
    out[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
    return out


def _planes(ids: np.ndarray) -> bytes:
    """64-bit ids byte by byte: the high bytes of a shard's ids hardly differ, and so compress well."""
    return ids.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _ids(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _packed(targets: np.ndarray, origin: int, *values: np.ndarray, ids: np.ndarray | None = None) -> pa.Table:
    """One row for each target that is there: its share of the values, in order."""
    order = np.argsort(targets, kind="stable")
    targets = targets[order]
    at = np.flatnonzero(_first(targets)) if len(targets) else targets
    ends = np.append(at[1:], len(targets))[: len(at)]
    columns = [[v[order][s:e].tobytes() for s, e in zip(at, ends, strict=True)] for v in values]
    if ids is not None:
        columns.append([_planes(ids[order][s:e]) for s, e in zip(at, ends, strict=True)])
    columns += [[b""] * len(at)] * (3 - len(columns))
    return pa.table([pa.array(targets[at], pa.int32()), pa.array([origin] * len(at), pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], ["target", "origin", "a", "b", "c"])


_NOTHING = _packed(np.zeros(0, np.int64), 0)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _origins(table: pa.Table, bytes_each: int) -> np.ndarray:
    return np.repeat(table.column("origin").to_numpy(), [len(x) // bytes_each for x in table.column("a").to_pylist()])


class _Shard:
    """The documents of one shard, by id, with hashes of their words and windows."""

    def __init__(self, table: pa.Table, n: int):
        self.n = n
        ids = table.column("doc_id").combine_chunks()
        order = np.argsort(ids.fill_null(NO_ID).to_numpy(), kind="stable")
        self.number = table.column("shard")[0].as_py()
        self.doc_id = ids.take(pa.array(order))
        self.id = self.doc_id.fill_null(NO_ID).to_numpy()
        self.texts = strings(table.column("text")).take(pa.array(order))

    def hashed(self) -> _Shard:
        self.words, counts = word_hashes(self.texts)
        self.doc, fits = whole(counts, self.n)
        self.at = np.flatnonzero(fits)
        return self

    def anchored(self) -> _Shard:
        self.hashed()
        short = windows(self.words, min(ANCHOR, self.n))
        least = short[: max(0, len(self.words) - self.n + 1)].copy()
        for k in range(1, self.n - min(ANCHOR, self.n) + 1):
            np.minimum(least, short[k : k + len(least)], out=least)
        self.anchor = least[self.at]
        # neighbouring windows mostly share an anchor
        self.run = _first(self.anchor, self.doc[self.at])
        self.run_of = np.cumsum(self.run) - 1
        return self

    def candidates(self, recurring: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of windows whose anchor recurs, and a 64-bit and a 32-bit hash of each."""
        recurring = np.sort(recurring)
        found = np.isin(self.anchor[self.run], recurring)
        places = self.at[found[self.run_of]]
        if not len(places):
            return places, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        return places, windows(self.words, self.n)[places], (windows(self.words, self.n, second=True)[places] >> np.uint64(32)).astype(np.uint32)


def sharded(docs: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """doc_id, text and shard: documents are dealt by a hash of id and text to as many shards of about `shard_bytes` as their size asks for, so copies, and rows of one id, are spread."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * n, 20_000))
    return rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")).repartition(parts, "shard"), n


def _least(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id of each run, and whether the run has another one."""
    if not len(at):
        return ids[:0], np.zeros(0, bool)
    return np.minimum.reduceat(ids, at), np.maximum.reduceat(ids, at) > np.minimum.reduceat(ids, at)


def _occurrences(texts: list[list[bytes]], ids: list[int], phrases: list[tuple[int, list[bytes]]], n: int):
    """For each text: the last words of all occurrences of phrases whose owner has a smaller id than the text.

    Words are numbered and spelled with letters of six bits, as many for each word (the first one marked), as the automaton is quick only over a small alphabet; every other word is spelled alike.
    """
    known = {w: i for i, w in enumerate(dict.fromkeys(w for _, words in phrases for w in words))}
    digits = max(1, -(-max(1, len(known) - 1).bit_length() // 6))
    spelling = {w: "".join(chr((i >> (6 * d) & 63) | (128 if d == 0 else 0)) for d in range(digits)) for w, i in known.items()}
    other = "\xff" * digits
    automaton = ahocorasick.Automaton()
    for owner, words in phrases:
        spelled = "".join([spelling[w] for w in words])
        automaton.add_word(spelled, min(owner, automaton.get(spelled, owner)))
    automaton.make_automaton()
    for words, doc_id in zip(texts, ids, strict=True):
        spelled = "".join([spelling.get(w, other) for w in words]) if phrases and len(words) >= n else ""
        yield [end // digits for end, owner in automaton.iter(spelled) if owner < doc_id] if spelled else []


def dedup_substrings(docs: DataFrame, n: int = 13, shard_bytes: int = 6_000_000, bucket_bytes: int = 24_000_000) -> DataFrame:
    """Remove every word that is covered by n consecutive words which also start in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, removed (word ranges, end exclusive) and kept_text (kept words joined by one space).

    Documents are dealt to shards by hash; the texts are shuffled once. Passages that may recur are sought in two counts that exchange only packed hashes, each hash once for each shard, however many
    copies there are: first the windows' anchors (about one word in five), then, where an anchor recurs, 96 bits of each window with the smallest doc_id of the shard. A shard then asks the shard of each
    window's first document, its owner, for the words: for as few windows of a long passage as cover it, each n-th and the last. The owner confirms them as phrases of its own text and sends them back
    with its doc_id. Each shard compiles an automaton of the phrases that it is sent, and streams all its documents through it: what is removed are the occurrences found, word by word, whose owner has a
    smaller id. Hashes only choose what is asked for. That two windows of 96 equal bits hide a passage is unlikely at any size (below 0.001 for 100 TB).

    Shards and buckets are as many as the input's size asks for, so a task holds a bounded share; a bucket holds one packed row a shard at most, and no more than there are hashes.

    Words are `[^\\x20\\x09-\\x0D]+`. Null texts have no words. A null doc_id counts as larger than all others, and rows that share an id don't shorten one
    another. Texts of fewer than n words stay as they are. Repeated rows each have their row. An empty table gives an empty result. Other columns are ignored.
    """
    rows, n_shards = sharded(docs, shard_bytes)
    n_buckets = max(1, n_shards * shard_bytes // bucket_bytes)

    def anchors(table: pa.Table) -> pa.Table:
        s = _Shard(table, n).anchored()
        h, ids = s.anchor[s.run], s.id[s.doc[s.at[s.run]]]
        order = np.argsort(h, kind="stable")
        h, ids = h[order], ids[order]
        at = np.flatnonzero(_first(h))
        _, several = _least(ids, at)
        return _packed(_bucket(h[at], n_buckets), s.number, h[at], several)

    def recurring(table: pa.Table) -> pa.Table:
        h, several, shard = _joined(table.column("a"), "<u8"), _joined(table.column("b"), bool), _origins(table, 8)
        order = np.argsort(h, kind="stable")
        h, several, shard = h[order], several[order], shard[order]
        at = np.flatnonzero(_first(h))
        size = np.diff(np.append(at, len(h)))
        keep = np.repeat((size > 1) | np.logical_or.reduceat(several, at), size)
        return _packed(shard[keep], table.column("target")[0].as_py(), h[keep])

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        """The shard's windows that may recur, to buckets: hashes and the smallest id that has each."""
        if not left.num_rows or not right.num_rows:
            return _NOTHING
        s = _Shard(left, n).anchored()
        places, a, b = s.candidates(_joined(right.column("a"), "<u8"))
        order = np.lexsort((b, a))
        a, b, ids = a[order], b[order], s.id[s.doc[places]][order]
        at = np.flatnonzero(_first(a, b))
        least, _ = _least(ids, at)
        return _packed(_bucket(a[at], n_buckets), s.number, a[at], b[at], ids=least)

    def owned(table: pa.Table) -> pa.Table:
        """To each shard: those of its windows that a document of another shard owns, and that shard."""
        a, b, shard = _joined(table.column("a"), "<u8"), _joined(table.column("b"), "<u4"), _origins(table, 8)
        ids = np.concatenate([_ids(x) for x in table.column("c").to_pylist()])
        order = np.lexsort((shard, ids, b, a))
        a, b, shard = a[order], b[order], shard[order]
        new = _first(a, b)
        owner = shard[np.flatnonzero(new)][np.cumsum(new) - 1]
        return _packed(shard[~new], table.column("target")[0].as_py(), a[~new], b[~new], owner[~new].astype("<i4"))

    def asked(left: pa.Table, right: pa.Table) -> pa.Table:
        """To the owners' shards: the windows whose words this shard needs."""
        if not left.num_rows or not right.num_rows:
            return _NOTHING
        s, remote = _Shard(left, n).anchored(), np.array([x is not None for x in right.column("c").to_pylist()])
        anchors_, windows_ = right.filter(pa.array(~remote)), right.filter(pa.array(remote))
        places, a, b = s.candidates(_joined(anchors_.column("a"), "<u8"))
        ids = s.id[s.doc[places]]
        # a window of a document here belongs to its smallest id here, unless another shard has a smaller one
        order = np.lexsort((ids, b, a))
        new = _first(a[order], b[order])
        owner, repeated = np.empty(len(a), np.int64), np.empty(len(a), bool)
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        owner[order] = s.number
        repeated[order] = ids[order] > ids[order][at][group] if len(a) else repeated
        ra, rb, ro = _joined(windows_.column("a"), "<u8"), _joined(windows_.column("b"), "<u4"), _joined(windows_.column("c"), "<i4")
        if len(ra) and len(a):
            # the groups' hashes are in order, and so can be looked up
            ga, gb = a[order][at], b[order][at]
            both = np.lexsort((np.concatenate([np.zeros(len(ga), np.int8), np.ones(len(ra), np.int8)]), np.concatenate([gb, rb]), np.concatenate([ga, ra])))
            is_remote = both >= len(ga)
            last = np.maximum.accumulate(np.where(is_remote, 0, both))
            of_group = np.full(len(ga), -1, np.int64)
            of_group[last[is_remote]] = ro[both[is_remote] - len(ga)]
            far = of_group[group] >= 0
            owner[order[far]] = of_group[group[far]]
            repeated[order[far]] = True
        places, a, b, owner = places[repeated], a[repeated], b[repeated], owner[repeated]
        # of a run of windows, each n-th and the last cover its words
        doc = s.doc[places]
        begins = np.ones(len(places), bool)
        begins[1:] = (places[1:] != places[:-1] + 1) | (doc[1:] != doc[:-1])
        since = np.arange(len(places)) - np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(places) else places
        needed = (since % n == 0) | np.append(begins[1:], True)[: len(places)]
        a, b, owner = a[needed], b[needed], owner[needed]
        order = np.lexsort((b, a, owner))
        order = order[_first(owner[order], a[order], b[order])] if len(order) else order
        return _packed(owner[order], s.number, a[order], b[order])

    def confirmed(left: pa.Table, right: pa.Table) -> pa.Table:
        """To the shards that ask: words of this shard's texts as phrases, with the smallest doc_id that has each."""
        nothing = pa.table({"target": pa.array([], pa.int32()), "doc_id": pa.array([], pa.int64()), "phrases": pa.array([], pa.binary())})
        if not left.num_rows or not right.num_rows:
            return nothing
        s = _Shard(left, n).hashed()
        a, b, target = _joined(right.column("a"), "<u8"), _joined(right.column("b"), "<u4"), _origins(right, 8)
        mine = windows(s.words, n)
        near = np.isin(mine[s.at], a)
        places = s.at[near]
        ma, mb = mine[places], (windows(s.words, n, second=True)[places] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((s.id[s.doc[places]], mb, ma))
        at = order[_first(ma[order], mb[order])] if len(order) else order
        found = dict(zip(zip(ma[at].tolist(), mb[at].tolist(), strict=True), places[at].tolist(), strict=True))
        first = np.searchsorted(s.doc, np.arange(len(s.texts)))
        split: dict[int, list[bytes]] = {}
        out: dict[tuple[int, int], list[bytes]] = {}
        for x, y, t in zip(a.tolist(), b.tolist(), target.tolist(), strict=True):
            place = found.get((x, y))
            if place is None:
                continue
            doc = int(s.doc[place])
            if doc not in split:
                if len(split) > 1000:
                    split.clear()
                split[doc] = s.texts[doc].as_py().encode().split()
            begin = place - int(first[doc])
            out.setdefault((t, doc), []).append(b" ".join(split[doc][begin : begin + n]))
        keys = list(out)
        return pa.table({"target": pa.array([t for t, _ in keys], pa.int32()), "doc_id": pa.array(s.id[np.array([d for _, d in keys], np.int64)]) if keys else nothing.column("doc_id"), "phrases": pa.array([b"\n".join(out[k]) for k in keys], pa.binary())})

    def located(left: pa.Table, right: pa.Table) -> pa.Table:
        s = _Shard(left, n) if left.num_rows else None
        texts = [x.encode().split() for x in s.texts.to_pylist()] if s else []
        phrases = [(owner, p.split(b" ")) for owner, many in zip(right.column("doc_id").to_pylist(), right.column("phrases").to_pylist(), strict=True) for p in many.split(b"\n")]
        removed, spans, kept = [], [], []
        for words, ends in zip(texts, _occurrences(texts, s.id.tolist() if s else [], phrases, n), strict=True):
            if not ends:
                removed.append(0)
                spans.append([])
                kept.append(b" ".join(words).decode())
                continue
            covered = np.zeros(len(words) + 1, np.int32)
            ends = np.array(ends)
            np.add.at(covered, ends - n + 1, 1)
            np.add.at(covered, ends + 1, -1)
            gone = np.cumsum(covered[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).tolist()
            removed.append(int(gone.sum()))
            spans.append([{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2], strict=True)])
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode())
        return pa.table({"doc_id": s.doc_id if s else pa.array([], pa.int64()), "n_words": pa.array([len(w) for w in texts], pa.int64()), "n_removed": pa.array(removed, pa.int64()), "removed": pa.array(spans, _SPANS), "kept_text": pa.array(kept, pa.string())})

    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * n_buckets, 20_000))
    texts = rows.groupBy("shard")
    coarse = texts.applyInArrow(anchors, PACKED).repartition(parts, "target")
    repeated = coarse.groupBy("target").applyInArrow(recurring, PACKED).withColumn("c", F.lit(None).cast("binary"))
    owners = texts.cogroup(repeated.groupBy("target")).applyInArrow(counted, PACKED).repartition(parts, "target").groupBy("target").applyInArrow(owned, PACKED)
    wanted = texts.cogroup(repeated.unionByName(owners).groupBy("target")).applyInArrow(asked, PACKED)
    phrases = texts.cogroup(wanted.groupBy("target")).applyInArrow(confirmed, PHRASES)
    return texts.cogroup(phrases.groupBy("target")).applyInArrow(located, RESULT)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_substrings(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH docs AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM docs WHERE len(w) >= 13),
windows AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS g FROM places),
late AS (SELECT doc_id, p FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY g)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM late),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM docs),
kept AS (SELECT w.doc_id, count(g.i) AS n_removed, string_agg(x, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL) AS t FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
