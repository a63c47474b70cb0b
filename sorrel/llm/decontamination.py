"""Benchmark decontamination: item-sized windows of documents are found by SimHash and confirmed by their weighted shingles."""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import documents, slices, strings, written
from sorrel.llm.words import SPACE, whole, windows, word_hashes

#: Words end at ASCII white space and punctuation; letters are compared in lower case.
BREAKS = SPACE.copy()
BREAKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
FOUND = "doc_id long, text_hash long, item_id long, similarity double, start_word long, n_words long"
#: First bits and widths of the blocks of a fingerprint. Fingerprints that differ in RADIUS bits at most differ in at most RADIUS // 5 of one block's.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
RADIUS = 14


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _packed(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.packbits(ones * 2 > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _near(width: int, most: int) -> np.ndarray:
    """All differences of up to `most` bits of a block."""
    return np.array([sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(width), k)], np.int64)


def _block(fp: np.ndarray, first: int, width: int) -> np.ndarray:
    return ((fp >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)


class Items:
    """Benchmark items of one length in words, with a multi-index over the blocks of their fingerprints."""

    def __init__(self, length: int, shingle: int, radius: int, items: list[tuple[int | None, np.ndarray]]):
        self.length, self.shingle, self.radius = length, min(shingle, length), radius
        self.ids = [i for i, _ in items]
        hashes = [windows(w, self.shingle) for _, w in items]
        self.weights = [Counter(h.tolist()) for h in hashes]
        self.fp = np.concatenate([_packed(_bits(h).sum(axis=0, dtype=np.int64)[None], np.array([len(h)])) for h in hashes])
        self.known = np.unique(np.concatenate(hashes))
        # for each block, the values that it may have in a fingerprint within the radius of an item's, sorted, and the items
        self.index = []
        for first, width in BLOCKS:
            values = (_block(self.fp, first, width)[:, None] ^ _near(width, min(width, radius // len(BLOCKS)))).ravel()
            order = np.argsort(values, kind="stable")
            self.index.append((values[order], np.repeat(np.arange(len(items)), len(values) // len(items))[order]))

    def listed(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs that share a list of the index, each once."""
        pairs = []
        for (first, width), (values, items) in zip(BLOCKS, self.index, strict=True):
            want = _block(fp, first, width)
            low, n = np.searchsorted(values, want), np.searchsorted(values, want, side="right")
            n -= low
            window = np.repeat(np.arange(len(fp)), n)
            at = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            pairs.append(window * len(self.ids) + items[at])
        return np.divmod(np.unique(np.concatenate(pairs)), len(self.ids))

    def within_radius(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs within the radius."""
        window, item = self.listed(fp)
        close = np.bitwise_count(fp[window] ^ self.fp[item]) <= self.radius
        return window[close], item[close]


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8, radius: int = RADIUS, block_items: int = 2000, block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, text_hash, item_id) of every document with a window like an item, with the best window's similarity, first word and words.

    A window has as many words as the item (a shorter document is one window). Its SimHash over word shingles is looked up in a multi-index: fingerprints within `radius` bits differ in at most
    radius // 5 bits of one of 5 blocks, and each list holds the items for all values of its block that near, so no fingerprint within the radius is missed; at radius 14 a list is shared by one in 18 pairs of
    random fingerprints. Candidates are confirmed by the exact weighted Jaccard similarity of their shingle multisets, `threshold` or more. A window of similarity 0.8 differs in about 10 bits, so some lie beyond
    the radius (the tests measure a recall of 0.9 or more of pairs at 0.8 to 0.85, and of nearly all above). Windows without any shingle of any item have similarity 0; they aren't hashed.

    Items are the query set: they are handed to all tasks in blocks of at most `block_items` items and `block_chars` characters. Each block is one pass over the documents; with several blocks,
    each pass is written before the next block is read, so neither driver nor task holds more than one block. Documents aren't shuffled.

    Words are lower-cased and end at ASCII white space or punctuation. Null texts and items without a word match nothing. A null doc_id or item_id is returned as such; text_hash (xxhash64 of the text) tells
    documents without an id apart. Repeated rows each have their rows. Empty tables give an empty result. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(text).alias("text"))
    out, block, size = [], [], 0

    def done() -> DataFrame:
        return _pass(rows, block, shingle, threshold, radius)

    for r in items.toLocalIterator():
        if block and (len(block) == block_items or size + len(r.text) > block_chars):
            out.append(written(done(), "contaminated"))
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += len(r.text)
    if not out:
        return done()
    out.append(written(done(), "contaminated"))
    return reduce(DataFrame.unionByName, out)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents without a window like an item of the benchmark, with all their columns; see `contaminated`. Documents are told apart by doc_id and text, so one without an id goes by its own text."""
    found = contaminated(docs, benchmark, **parameters).select("doc_id", "text_hash").distinct()
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("key"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hash"))
    kept = own.join(found, F.col("key").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _pass(rows: DataFrame, block: list[tuple[int | None, str]], shingle: int, threshold: float, radius: int) -> DataFrame:
    def prepared() -> tuple[list[Items], dict[int, np.ndarray]]:
        hashes, counts = word_hashes(pa.array([t for _, t in block], pa.large_string()), BREAKS)
        by_length: dict[int, list] = {}
        for i, (at, n) in enumerate(zip((np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True)):
            if n:
                by_length.setdefault(n, []).append((i, hashes[at : at + n]))
        groups = [Items(n, shingle, radius, x) for n, x in sorted(by_length.items())]
        return groups, {k: np.unique(np.concatenate([g.known for g in groups if g.shingle == k])) for k in {g.shingle for g in groups}}

    def find(batches):
        groups, known = prepared()
        names = [i for i, _ in block]
        for batch in batches:
            texts = strings(batch.column(1))
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, np.int64)
            for a, b in slices(lengths, 2_000_000):
                words, counts = word_hashes(texts.slice(a, b - a), BREAKS)
                best: dict[tuple[int, int], tuple] = {}  # by document and item number
                for k, some in known.items():
                    text, fits = whole(counts, k)
                    hashes = windows(words, k)
                    hits = np.flatnonzero(fits[: len(hashes)] & _in(hashes, some)) if len(hashes) else np.zeros(0, np.int64)
                    for g in groups if len(hits) else ():
                        if g.shingle == k:
                            _search(g, hashes, hits[_in(hashes[hits], g.known)], text, counts, threshold, best)
                if best:
                    rows_ = [(d, names[i], *x) for (d, i), x in sorted(best.items())]
                    docs_, items_, sim, start, n = (list(x) for x in zip(*rows_, strict=True))
                    at = pa.array([a + d for d in docs_])
                    yield pa.record_batch([batch.column(0).take(at), batch.column(2).take(at), pa.array(items_, pa.int64()), pa.array([-x for x in sim], pa.float64()), pa.array(start, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "text_hash", "item_id", "similarity", "start_word", "n_words"])

    return rows.mapInArrow(find, FOUND)


def _search(g: Items, hashes: np.ndarray, hits: np.ndarray, text: np.ndarray, counts: np.ndarray, threshold: float, best: dict) -> None:
    """Compare the item-sized windows that hold a hit with the items."""
    if not len(hits):
        return
    n, first = g.length - g.shingle + 1, np.cumsum(counts) - counts
    doc = text[hits]
    size = np.minimum(g.length, counts[doc])
    low = np.maximum(first[doc], hits - n + 1)
    high = np.minimum(hits, first[doc] + counts[doc] - size)
    low = np.minimum(low, high)
    starts = np.unique(np.repeat(low, high - low + 1) + np.arange(int((high - low + 1).sum())) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1))
    own = np.minimum(n, counts[text[starts]] - g.shingle + 1)
    for s in range(0, len(starts), 4000):
        begin, many = starts[s : s + 4000], own[s : s + 4000]
        # the windows' shingles, without the gaps between windows
        mark = np.zeros(int(begin[-1] + many[-1] - begin[0]) + 1, np.int32)
        np.add.at(mark, begin - begin[0], 1)
        np.add.at(mark, begin + many - begin[0], -1)
        used = np.cumsum(mark[:-1]) > 0
        place = np.cumsum(used) - used
        sums = np.zeros((int(used.sum()) + 1, 64), np.int32)
        np.cumsum(_bits(hashes[begin[0] : begin[0] + len(used)][used]), axis=0, out=sums[1:], dtype=np.int32)
        at = place[begin - begin[0]]
        for w, i in zip(*(x.tolist() for x in g.within_radius(_packed(sums[at + many] - sums[at], many))), strict=True):
            b = int(begin[w])
            d, m = int(text[b]), int(many[w])
            sim = weighted_jaccard(Counter(hashes[b : b + m].tolist()), g.weights[i])
            if sim >= threshold:
                _better(best, d, g.ids[i], sim, b - int(first[d]), m + g.shingle - 1)


def _better(best: dict, doc: int, item: int, sim: float, start: int, n: int) -> None:
    if (doc, item) not in best or (-sim, start, n) < best[doc, item]:
        best[doc, item] = (-sim, start, n)


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_hash")
