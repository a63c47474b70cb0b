"""Tokenizer files of other kinds than the one that is encoded word by word."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sorrel.llm import packing, tokens
from sorrel.llm.tokens import TextEncoder, WordEncoder, by_words, encoder, tokenizer_path

TEXTS = ["", " ", "Plain words, and MORE of them.", "don't\tstop 12345  it's", "\u00c9t\u00e9 e\u0301t\u00e9 \u4e2d\u6587 \U0001f600!", "<|endoftext|> x", "line\n\nline \x00 end", "a" * 3000, "word " * 4000]


def changed(tmp_path, change):
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        said = json.load(f)
    change(said)
    (tmp_path / "t.json").write_text(json.dumps(said), encoding="utf-8")
    return str(tmp_path / "t.json")


CHANGES = {
    "case": lambda s: s["normalizer"]["normalizers"].pop(),
    "no normalizer": lambda s: s.update(normalizer=None),
    "pattern": lambda s: s["pre_tokenizer"]["pretokenizers"][0].update(pattern={"Regex": r"\\S+"}),
    "prefix": lambda s: s["pre_tokenizer"]["pretokenizers"][1].update(add_prefix_space=True),
    "added": lambda s: s["added_tokens"].append({"id": 49408, "content": "words", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}),
}


def same(path):
    ids, counts = encoder(path).encode([t.encode() for t in TEXTS], 7)
    want = [x.ids + [7] for x in Tokenizer.from_file(path).encode_batch(TEXTS, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x] and ids.dtype == np.uint32


@pytest.mark.parametrize("name", CHANGES)
def test_changed_files(tmp_path, name):
    path = changed(tmp_path, CHANGES[name])
    assert not by_words(path) and isinstance(encoder(path), TextEncoder)
    same(path)


def test_given_files():
    assert isinstance(encoder(tokenizer_path("word_bpe_49k.json")), WordEncoder) and isinstance(encoder(tokenizer_path("byte_bpe_50k.json")), TextEncoder)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        same(tokenizer_path(name))
    ids, counts = TextEncoder(tokenizer_path("byte_bpe_50k.json")).encode([], 7)
    assert len(ids) == 0 and len(counts) == 0


def test_pack_with_another_file(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string").repartition(3)
    got = packing.pack(docs, path).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    want = [len(x.ids) + 1 for x in Tokenizer.from_file(path).encode_batch([*TEXTS, ""], add_special_tokens=False)]
    assert {r.doc_id: (r.n, r["all"]) for r in got} == {i: (n, n) for i, n in enumerate(want)}


def test_workers_forget_their_words_after_packing(spark):
    """Workers live on into other stages: what they remember of the words that they packed isn't held there."""
    texts = [(i, " ".join(f"word{i}x{j}" for j in range(50))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    assert packing.pack(docs, tokens.tokenizer_path("word_bpe_49k.json"), 64, most_words=100).count() >= 40

    def remembered(batches):
        for _ in batches:
            yield pa.record_batch([pa.array([sum(len(e.known) for e in tokens._ENCODERS.values() if isinstance(e, tokens.WordEncoder))], pa.int64())], ["n"])

    assert spark.range(0, 16, 1, 16).mapInArrow(remembered, "n long").agg(F.sum("n")).first()[0] == 0
