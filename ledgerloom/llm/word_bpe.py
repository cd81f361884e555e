"""Encoding and decoding with a word-end BPE vocabulary, by dynamic programming over prefixes.

Of every prefix of a word the BPE encoding has exactly one last token. It is the token that ends there, as an automaton of the
vocabulary with suffix links finds, and that is compatible with the last token of the prefix before it: undoing the merges of both
towards their border, the latest first, never meets a pair that would have been merged earlier. Following these tokens back from a
word's end gives its ids. A token that BPE can't make of its own characters ends no prefix.

Normalising and splitting into words are those of the vocabulary file, run by `tokenizers`; its model is not used.
Texts are cut at blanks and line feeds, which no word and no special token crosses, and the ids of such parts are kept in a cache of
bounded size. Edge cases: null and empty text have no ids; special tokens in a text are special tokens, as the file says; null
and repeated doc_id are kept; an empty table gives no rows; other columns are ignored. Texts are never cut short; a text takes some
40 bytes of memory a character while it is encoded.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import give_back, table

VOCABULARY = "word_bpe_49k.json"
END = "\n"  # stands for the word end in the automaton: no byte is written as a line feed there


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Vocabulary:
    """Tokens, merges and the automaton of a vocabulary file.

    merged: pair of ids to (order of the merge, id). order, left and right: of each id that is merged, how.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        self.merged, self.order, self.left, self.right = {}, {}, {}, {}
        for k, (a, b) in enumerate(model["merges"]):
            pair, whole = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.merged.setdefault(pair, (k, whole))
            if whole not in self.order:
                self.order[whole], self.left[whole], self.right[whole] = k, *pair
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        made: dict[int, bool] = {}
        for token, i in sorted(self.ids.items(), key=lambda x: self.order.get(x[1], -1)):  # parts come before what is made of them
            made[i] = i not in self.order or (made[self.left[i]] and made[self.right[i]] and self._meet(self.left[i], self.right[i], self.order[i]))
            if made[i]:
                shown = self.shown(token)
                self.automaton.add_word(shown, (len(shown), i))
        self.automaton.make_automaton()

    def shown(self, token: str) -> str:
        return token.removesuffix(self.suffix) + END if token.endswith(self.suffix) else token

    def _meet(self, a: int, b: int, before: float) -> bool:
        """Whether a and b can stand side by side until the merge of the order `before`."""
        while True:
            found = self.merged.get((a, b))
            if found is not None and found[0] < before:
                return False
            of_a, of_b = self.order.get(a, -1), self.order.get(b, -1)
            if of_a < 0 and of_b < 0:
                return True
            if of_a > of_b:
                before, a = of_a, self.right[a]
            else:  # of equal merges the left one comes first, so this one was made after a
                before, b = of_b + 1, self.left[b]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of some text has b after a; remembered, for a million pairs at most."""
        if len(self.pairs) >= 1_000_000:
            self.pairs.clear()
        fits = self.pairs[a, b] = self._meet(a, b, float("inf"))
        return fits

    def word(self, said: str) -> list[int]:
        """Ids of one word, written in the characters of byte-level BPE."""
        said += END
        n = len(said)
        last: list[int | None] = [None] * (n + 1)
        size = [0] * (n + 1)
        known, compatible = self.pairs.get, self.compatible
        for end, (k, token) in self.automaton.iter(said):
            end += 1
            if last[end] is not None:
                continue
            if end != k:
                before = last[end - k]
                if before is None:
                    continue
                fits = known((before, token))
                if not (compatible(before, token) if fits is None else fits):
                    continue
            last[end], size[end] = token, k
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return out[::-1]


class Kept(dict):
    """make(key) by key. Two generations of at most `entries` values each: the older one goes when the newer is full; long keys aren't kept."""

    def __init__(self, make, entries: int = 200_000, longest: int = 48):
        super().__init__()
        self.make, self.entries, self.longest, self.old = make, entries, longest, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


_PLAIN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^a-z0-9]+")  # the file's words in lower-case printable ASCII without blanks


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        whole = Tokenizer.from_file(path)
        self.normalise, self.split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.vocabulary.special, key=len, reverse=True))) + ")")
        self.words = Kept(lambda word: array("I", self.vocabulary.word(word)).tobytes())
        self.parts = Kept(self._part)

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable() and not self.marks.search(part):
            return b"".join(map(self.words.__getitem__, _PLAIN.findall(part.lower())))
        out = []
        for k, piece in enumerate(self.marks.split(part)):
            if k % 2:
                out.append(array("I", [self.vocabulary.special[piece]]).tobytes())
            elif piece:
                out += [self.words[word] for word, _ in self.split(self.normalise(piece))]
        return b"".join(out)

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))


_LOADED: dict[str, Encoder] = {}  # a worker keeps one vocabulary for its next tasks


def loaded(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _mapped(df: DataFrame, schema: str, names: list[str], kinds: list[pa.DataType], rows, held: int = 4 << 20) -> DataFrame:
    """df through rows(column 0's values, column 1's): an iterator of (row, its bytes); some MB leave a worker at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = lambda own: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*own, strict=True) if own else [[]] * len(names), kinds, strict=True)], names)
        for batch in batches:
            own, size = [], 0
            for row, n in rows(batch):
                own.append(row)
                size += n
                if size > held:
                    yield flush(own)
                    own, size = [], 0
            yield flush(own)
        give_back()

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit integers) of every text of docs(doc_id, text)."""

    def rows(batch: pa.RecordBatch):
        encoder = loaded(path)
        for doc, said in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = encoder(said.as_py() or "")
            yield (doc, len(ids) // 4, ids), len(ids)

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _mapped(own, "doc_id long, n_tokens long, ids binary", ["doc_id", "n_tokens", "ids"], [pa.int64(), pa.int64(), pa.binary()], rows)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids and text of encoded(doc_id, n_tokens, ids): the tokens with a blank between them, as the file has no decoder."""

    def rows(batch: pa.RecordBatch):
        name = loaded(path).vocabulary.names.__getitem__
        for doc, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            raw = ids.as_py()
            said = " ".join(map(name, array("I", raw)))
            yield (doc, n, raw, said), len(raw) + len(said)

    own = encoded.select("doc_id", "n_tokens", "ids")
    names, kinds = ["doc_id", "n_tokens", "ids", "text"], [pa.int64(), pa.int64(), pa.binary(), pa.string()]
    return _mapped(own, "doc_id long, n_tokens long, ids binary, text string", names, kinds, rows)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of ids and digests of the ids and of the decoded text of every document."""
    path = vocabulary_path()
    out = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
