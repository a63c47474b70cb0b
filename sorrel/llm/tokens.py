"""Token ids by a public tokenizer file, for the operators that write or pack ids."""

from __future__ import annotations

import json
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa

#: Words whose ids a worker remembers, some 250 bytes each.
MOST_WORDS = 600_000
_ENCODERS: dict[str, "WordEncoder | TextEncoder"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Places where a letter meets punctuation other than an apostrophe: the tokenizer's pattern always cuts there.
_CUT = re.compile(rb"(?<=[a-z])(?=[!-&(-/:-@\[-`{-~])")
_CUT_MORE = re.compile(rb"[\x00-\x08\x0e-\x1f!-/:-@\[-`{-\x7f][.,]")
#: Lower-case words of Latin letters are one piece to the pattern, and its normalizer leaves them alone.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


class WordEncoder:
    """Encodes whole texts word by word.

    The tokenizer's pattern never joins characters over white space, and it drops the white space itself, so a text's ids are those
    of its space-separated words in a row. It also ignores the case of A-Z (where no combining mark follows) and always cuts between a letter and
    punctuation. Words repeat, so each worker remembers the ids of about `most` words and
    forgets them all beyond that: memory is bounded and the result doesn't depend on what is remembered.
    """

    def __init__(self, path: str, most: int = MOST_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        # the same merges without the normalizer and the pattern, for plain words; each of them ends with a token that closes a word
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.pool, self.ends, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), 0

    def learn(self) -> None:
        """Encode the words that have a number but no ids yet."""
        words = self.known.new
        for at in range(0, len(words), 20_000):
            texts = [w.decode("utf-8", "replace") for w in words[at : at + 20_000]]
            is_plain = np.fromiter(map(bool, map(_PLAIN.fullmatch, texts)), bool, len(texts))
            plain = list(compress(texts, is_plain))
            ids = self._flat(self.merges, [" ".join(plain[i : i + 500]) for i in range(0, len(plain), 500)])[0]
            counts = np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0)
            if len(counts) != len(plain):
                is_plain, ids, counts = np.zeros(len(texts), bool), ids[:0], counts[:0]
            more, more_counts = self._flat(self.tokenizer, list(compress(texts, ~is_plain)))
            every = np.empty(len(texts), np.int64)
            every[is_plain], every[~is_plain] = counts, more_counts
            ends = self.ends[self.n] + np.cumsum(every)
            while ends[-1] > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            while self.n + len(texts) + 1 > len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            own = np.repeat(is_plain, every)
            self.pool[ends[0] - every[0] : ends[-1]][own] = ids
            self.pool[ends[0] - every[0] : ends[-1]][~own] = more
            self.ends[self.n + 1 : self.n + len(texts) + 1] = ends
            self.n += len(texts)
        self.known.new = []

    @staticmethod
    def _flat(tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.array([len(x) for x in got], np.int64)

    @staticmethod
    def pieces(text: bytes) -> list[bytes]:
        """Parts of a text whose ids, in a row, are the text's."""
        if b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text:
            text = text.lower()
            if text.isascii() and not _CUT_MORE.search(text):
                text = text.replace(b".", b" .").replace(b",", b" ,")
            else:
                text = _CUT.sub(b" ", text)
        return text.split()

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, `end_id` after each text, and how many each text has, that id included."""
        split = [self.pieces(t) for t in texts]
        words = list(chain.from_iterable(split))
        if len(self.known) > self.most:
            self.forget()
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if self.known.new:
            self.learn()
        ends = self.ends
        per_text = np.array([len(x) for x in split], np.int64)
        starts = ends[at]
        lens = ends[at + 1] - starts
        before = np.concatenate([[0], np.cumsum(lens)])
        ids = self.pool[np.repeat(starts - before[:-1], lens) + np.arange(before[-1])]
        cuts = before[np.cumsum(per_text)] if len(texts) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([[0], cuts])) + 1
        return np.insert(ids, cuts, np.uint32(end_id)), counts


class TextEncoder:
    """Encodes whole texts with the tokenizer itself, for files that aren't cut and lower-cased as `WordEncoder` expects."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As `WordEncoder.encode`."""
        ids, counts = WordEncoder._flat(self.tokenizer, [t.decode("utf-8", "replace") for t in texts])
        return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1


#: How a tokenizer file must normalize and cut for its texts to be encoded word by word.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_words(path: str) -> bool:
    """Whether a tokenizer file may be used word by word: its normalizer and pattern are the ones above, its merges close words with </w>, and its added tokens begin with <|. The file is read, not its name."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    normalizer, cutter, model = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}, said["model"]
    split, *rest = cutter.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and (split.get("pattern"), split.get("behavior"), split.get("invert")) == ({"Regex": PATTERN}, "Removed", True)
        and [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in rest] == [("ByteLevel", False, False)]
        and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("ignore_merges")
        and all(x["content"].startswith("<|") for x in said.get("added_tokens") or [])
    )


def encoder(path: str, most: int = MOST_WORDS) -> WordEncoder | TextEncoder:
    """One per worker process and file: word by word where the file allows it, else whole texts. `most`: words that it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path) if by_words(path) else TextEncoder(path)
    enc = _ENCODERS[path]
    if isinstance(enc, WordEncoder):
        enc.most = most
    return enc


def forget_words() -> None:
    """Workers outlive the tasks that encode: what theirs remember is given back to the system, the tokenizers stay."""
    for enc in _ENCODERS.values():
        if isinstance(enc, WordEncoder) and enc.known:
            enc.forget()
            pa.default_memory_pool().release_unused()
