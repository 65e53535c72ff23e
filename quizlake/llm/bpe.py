"""BPE encoding and decoding by a walk over a trie of the distinct words.

A text is split as the vocabulary file prescribes: special tokens are cut out
first, the rest is put into NFC, lower-cased letter by letter and cut into
words; a word is a run of byte letters whose last letter carries ``</w>``.

The distinct words of a block of texts form a trie.  It is walked depth first
with one state per node: the *last token* of the encoding of the prefix that the
node stands for.  A token ``t`` that ends a prefix is its last token exactly if
the last token of what precedes it stays apart from ``t`` under the merges, so a
state needs the states above it only, and a prefix that many words share is
encoded once.  Sorted words visit the trie in depth-first order, so the walk
holds the path to the present word and nothing else.

Decoding reads the ids back and joins token strings with spaces, as a file
without a decoder asks for.

Memory: a block of words, and a memo of encoded words that is emptied when it
reaches ``MEMO`` entries (the result does not depend on it).
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import from_arrow_type

from quizlake.llm.common import fresh

MEMO = 150_000
BLOCK_CHARS = 1_000_000
END = "</w>"
# fixed value: the split pattern of the vocabulary file
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """One printable letter for each byte: visible Latin-1 letters stand for
    themselves, the other bytes take the letters from U+0100 on in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in visible else next(rest)) for b in range(256)]


class Bpe:
    """Vocabulary, merges and the trie walk."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(pairs):
            a, b, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rank.setdefault((a, b), r)
            self.halves.setdefault(whole, (a, b, r))
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(END)}
        self.final = {t.removesuffix(END): i for t, i in self.vocab.items() if t.endswith(END)}
        self.size = {i: len(t) for t, i in self.inner.items()} | {i: len(t) for t, i in self.final.items()}
        self.inner_ends, self.final_ends = ({t[k:] for t in v for k in range(len(t))} for v in (self.inner, self.final))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        self.edges: tuple[dict, dict] = ({}, {})
        self.apart: dict[tuple[int, int], bool] = {}
        self.own: dict[int, bool] = {}
        self.memo: dict[str, tuple[bytes, str]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one edge of ``token`` while it is built (1:
        right edge, 0: left edge), each with the rank of the merge that ends it."""
        known = self.edges[side]
        if token not in known:
            found, ended, t = [], float("inf"), token
            while True:
                found.append((t, ended))
                if t not in self.halves:
                    break
                ended = self.halves[t][2]
                t = self.halves[t][side]
            known[token] = found
        return known[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether no merge joins the two sides of the border between the
        tokens: one that is due before either edge token is merged inwards (at
        the same rank the pair further left goes first)."""
        key = (left, right)
        if key not in self.apart:
            if len(self.apart) > MEMO:
                self.apart.clear()
            rank = self.rank.get
            self.apart[key] = not any(
                (r := rank((x, y))) is not None and r < end_x and r <= end_y
                for x, end_x in self._edge(left, 1)
                for y, end_y in self._edge(right, 0)
            )
        return self.apart[key]

    def _whole(self, token: int) -> bool:
        """Whether the token's own letters are encoded as the token."""
        if token not in self.own:
            a = self.halves.get(token)
            self.own[token] = a is None or self._whole(a[0]) and self._whole(a[1]) and self._halves_meet(*a)
        return self.own[token]

    def _halves_meet(self, left: int, right: int, r: int) -> bool:
        rank = self.rank.get
        return not any(
            (q := rank((x, y))) is not None and q < r and q < end_x and q <= end_y
            for x, end_x in self._edge(left, 1)
            for y, end_y in self._edge(right, 0)
        )

    def _last(self, path: str, depth: int, states: list[int], vocab: dict[str, int], ends: set[str]) -> int:
        """The last token of the first ``depth`` letters, given all states above."""
        found = []
        for start in range(depth - 1, -1, -1):
            part = path[start:depth]
            if part not in ends:
                break
            if part in vocab:
                found.append((start, vocab[part]))
        for start, token in reversed(found):
            if start:
                key = (states[start], token)
                known = self.apart.get(key)
                if known or known is None and self.stay_apart(*key):
                    return token
            elif self._whole(token):
                return token
        raise ValueError(f"no token for {path[:depth]!r}")

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each distinct word, in the byte letters, with its token ids."""
        path, states, last, size = "", [-1], self._last, self.size
        for word in sorted(set(words)):
            stem = len(word) - 1
            same = 0
            for a, b in zip(path, word[:stem], strict=False):
                if a != b:
                    break
                same += 1
            del states[same + 1 :]
            for depth in range(same + 1, stem + 1):
                states.append(last(word, depth, states, self.inner, self.inner_ends))
            path = word[:stem]
            ids, depth, token = [], len(word), last(word, len(word), states, self.final, self.final_ends)
            while True:
                ids.append(token)
                depth -= size[token]
                if not depth:
                    break
                token = states[depth]
            yield word, ids[::-1]

    def words(self, text: str) -> list[str]:
        """Words of a text in order; special tokens stand as they are."""
        if self.cut is None or not self.cut.search(text):
            return WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        found = []
        for part in self.cut.split(text):
            if part in self.special:
                found.append(part)
            else:
                found += WORDS.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return found

    def learn(self, words: set[str]) -> None:
        """Encode and decode the words that the memo lacks."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = {}
        for w in words - self.memo.keys():
            if w in self.special:
                self.memo[w] = (struct.pack("<I", self.special[w]), w)
            else:
                new[w.encode().decode("latin-1").translate(self.letters)] = w
        for letters, ids in self.walk(new):
            self.memo[new[letters]] = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids))

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join([self.names[i] for i in ids])

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text."""
        words = self.words(text or "")
        self.learn(set(words))
        known = [self.memo[w] for w in words]
        return b"".join(k[0] for k in known), " ".join(k[1] for k in known)


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def blocks(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about BLOCK_CHARS letters."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def encode_texts(bpe: Bpe, texts: Iterable[str | None]) -> Iterator[tuple[bytes, str]]:
    """``encode`` of each text, with one trie for each block of texts."""
    for block in blocks(texts):
        split = [bpe.words(t or "") for t in block]
        bpe.learn({w for words in split for w in words})
        memo = bpe.memo
        for words in split:
            known = [memo[w] for w in words]
            yield b"".join([k[0] for k in known]), " ".join([k[1] for k in known])


def _mapped(docs: DataFrame, path: str, text: str, kept: list[str], made: pa.Schema, row) -> DataFrame:
    """``kept`` columns of ``docs`` as they are, and the columns of ``made``: of
    each text's ids and decoded text, ``row`` makes their values."""
    x = fresh("x", kept)
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(f.name, from_arrow_type(f.type)) for f in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            start, passed = 0, batch.select(kept)
            for block in blocks(batch.column(x).to_pylist()):
                part = passed.slice(start, len(block))
                start += len(block)
                rows = [row(i, d) for i, d in encode_texts(bpe, block)]
                new = [pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), made, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*kept, *made.names])

    return docs.select(*kept, docs[text].alias(x)).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns of ``docs`` with ``ids`` (binary: little-endian unsigned
    32-bit integers) and ``decoded`` (string) set.

    A null or empty text gives no ids and an empty string; columns that already
    have these names are replaced; repeated rows stay.  A map, without shuffle.
    """
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    made = pa.schema([(ids, pa.binary()), (decoded, pa.string())])
    return _mapped(docs, path, text, kept, made, lambda i, d: (i, d))


def digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs``;
    the encodings themselves never leave the worker.  Nulls as in ``encode``."""
    made = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def row(ids: bytes, decoded: str) -> tuple:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _mapped(docs, path, text, [key], made, row)
