"""Packing of examples into sequences by vector bin packing.

An example demands three things: tokens, a segment, and tokens that bear loss.  A
sequence limits all three at once.  Sequences are filled one at a time by the
dot-product heuristic: of the waiting examples that fit, the one is placed whose
demand has the largest weighted dot product with what the sequence has left.
Demands and rests are shares of the limits; a dimension weighs as much as the
waiting examples demand of it on average, so the scarce one decides.

With ``cut`` an example may be split.  Where nothing fits whole any more, the
example of the largest product is cut to fill the rest.  A sequence that another
limit ends, or the end of the input, is cut back to a power of two, which needs no
padding either; what is cut off waits again.  Without ``cut`` examples stay whole,
but for those that no empty sequence holds: these are cut to fit one.

Each task packs the rows of its input split as a stream and moves nothing: it
holds WAITING examples of less than one sequence (longer ones are cut when they
are read) and one batch of rows.  The window decides which examples share a sequence,
never whether one is placed: every token is in exactly one piece.  A task leaves
at most one short sequence a power of two.  ``sequence_id`` is made of the split
and a count, so a task that is run again gives the same ones.

Null and empty texts are examples of one token, the end token; rows equal in id
are examples of their own; a null id is kept; an empty table gives no piece.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

WAITING, ROWS, OUT = 2_048, 64, 20_000
# fixed value: the split pattern of byte-level BPE
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")
_LOADED: dict[tuple, object] = {}


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


@dataclass
class Part:
    """Tokens of one example from ``start`` on; ``loss[i]`` says whether token i
    bears loss."""

    key: object
    start: int
    total: int
    ids: np.ndarray
    loss: np.ndarray

    def cut(self, n: int) -> tuple[Part, Part]:
        return (
            Part(self.key, self.start, self.total, self.ids[:n], self.loss[:n]),
            Part(self.key, self.start + n, self.total, self.ids[n:].copy(), self.loss[n:].copy()),
        )

    def room(self, tokens: int, loss: int) -> int:
        """The most tokens from the start that need no more than this."""
        n = min(tokens, len(self.ids))
        if int(np.count_nonzero(self.loss[:n])) <= loss:
            return n
        return int(np.searchsorted(np.cumsum(self.loss[:n], dtype=np.int64), loss, "right"))


@dataclass
class Packer:
    limits: Limits
    cut: bool = True
    waiting: list[Part | None] = field(default_factory=list)
    free: list[int] = field(default_factory=list)
    demand: np.ndarray = field(default_factory=lambda: np.zeros((3, 0)))
    weight: np.ndarray = field(default_factory=lambda: np.ones(3))

    def __len__(self) -> int:
        return len(self.waiting) - len(self.free)

    def add(self, part: Part) -> None:
        """A part that an empty sequence holds."""
        if not self.free:
            n = len(self.waiting)
            self.free = list(range(n, 2 * n + 16))
            self.waiting += [None] * (n + 16)
            more = np.full((3, n + 16), np.inf)
            self.demand = np.concatenate([self.demand, more], axis=1)
        at = self.free.pop()
        self.waiting[at] = part
        self.demand[:, at] = len(part.ids), 1, np.count_nonzero(part.loss)

    def take(self, at: int) -> Part:
        part, self.waiting[at] = self.waiting[at], None
        self.demand[:, at] = np.inf
        self.free.append(at)
        return part

    def weigh(self) -> None:
        """Weights of the dimensions by the mean demand of what waits."""
        there = self.demand[:, np.isfinite(self.demand[0])]
        most = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], dtype=float)
        if there.size:
            self.weight = there.mean(axis=1) / most / most**2

    def best(self, rest: np.ndarray, whole: bool) -> int | None:
        """The waiting part with the largest product, of those that fit if ``whole``."""
        if not len(self):
            return None
        demand = self.demand
        product = (self.weight * rest) @ np.where(np.isfinite(demand), demand, 0.0)
        usable = (demand <= rest[:, None]).all(axis=0) if whole else np.isfinite(demand[0])
        at = int(np.where(usable, product, -1.0).argmax())
        return at if usable[at] else None

    def fill(self) -> list[Part]:
        """One sequence."""
        rest = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], dtype=float)
        placed: list[Part] = []
        while rest[0] and rest[1]:
            at = self.best(rest, whole=True)
            if at is not None:
                part = self.take(at)
            elif self.cut and (at := self.best(rest, whole=False)) is not None:
                n = self.waiting[at].room(int(rest[0]), int(rest[2]))
                if not n:
                    break
                part, left = self.take(at).cut(n)
                self.add(left)
            else:
                break
            placed.append(part)
            rest -= len(part.ids), 1, np.count_nonzero(part.loss)
        if self.cut:
            self.trim(placed)
        return placed

    def trim(self, placed: list[Part]) -> None:
        """Cuts a sequence that is not full back to a power of two."""
        size = sum(len(p.ids) for p in placed)
        if size == self.limits.tokens or not size:
            return
        over = size - (1 << (size.bit_length() - 1))
        while over:
            last = placed.pop()
            if len(last.ids) > over:
                kept, left = last.cut(len(last.ids) - over)
                placed.append(kept)
                self.add(left)
                over = 0
            else:
                self.add(last)
                over -= len(last.ids)

    def read(self, part: Part) -> Iterator[list[Part]]:
        """Takes a whole example; the sequences that a long one fills by itself."""
        while len(part.ids) > self.limits.tokens or np.count_nonzero(part.loss) > self.limits.loss:
            head, part = part.cut(max(1, part.room(self.limits.tokens, self.limits.loss)))
            if len(head.ids) == self.limits.tokens:
                yield [head]
            else:
                self.add(head)
        self.add(part)


def packed(examples: Iterator[Part], limits: Limits, cut: bool) -> Iterator[list[Part]]:
    """Sequences of a stream of examples."""
    packer = Packer(limits, cut)
    for part in examples:
        yield from packer.read(part)
        if len(packer) >= WAITING:
            packer.weigh()
            while len(packer) > WAITING // 2:
                yield packer.fill()
    packer.weigh()
    while len(packer):
        yield packer.fill()


def pack(rows: DataFrame, key: str, examples: Callable[[pa.RecordBatch], Iterator[Part]], limits: Limits, cut: bool) -> DataFrame:
    """Pieces of the examples that ``examples`` makes of a batch of ``rows``."""
    if limits.tokens < 1 or limits.segments < 1 or limits.loss < 1:
        raise ValueError("every limit must be 1 or more")
    kind = rows.schema[key].dataType
    arrow = to_arrow_type(kind)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield from examples(batch.slice(at, ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(columns[0], arrow), *(pa.array(c, pa.int64()) for c in columns[1:])]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["k", *PIECES])

        first = TaskContext.get().partitionId() << 32
        for number, sequence in enumerate(packed(stream(batches), limits, cut)):
            offset = 0
            for p in sequence:
                crc = zlib.crc32(p.ids.astype("<u4").tobytes())
                out.append((p.key, p.start, len(p.ids), crc, p.total, first + number, offset, int(np.count_nonzero(p.loss))))
                offset += len(p.ids)
            if len(out) >= OUT:
                yield flush()
        if out:
            yield flush()

    numbers = ", ".join(f"{c} long" for c in PIECES)
    return rows.mapInArrow(run, f"k {kind.simpleString()}, {numbers}").withColumnRenamed("k", key)


def encoder(path: str, special: tuple[tuple[str, int], ...]):
    """The vocabulary of a rank file; strings of ``special`` are single tokens."""
    if (path, special) not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path, special] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))
    return _LOADED[path, special]


def pack_texts(
    docs: DataFrame, key: str, text: str, path: str, special: dict[str, int], end: int = 0, limits: Limits = Limits(), cut: bool = True
) -> DataFrame:
    """Pieces of whole texts: the ids of a text and then ``end``, which bears no
    loss.  ``path`` is a rank file of byte-level BPE."""
    rows, strings = docs.select(F.col(key).alias("k"), F.col(text).alias("x")), tuple(sorted(special.items()))

    def examples(batch: pa.RecordBatch) -> Iterator[Part]:
        coder = encoder(path, strings)
        for k, x in zip(batch.column("k").to_pylist(), batch.column("x").to_pylist(), strict=True):
            ids = np.array([*coder.encode(x or "", allowed_special="all"), end], dtype=np.uint32)
            loss = np.ones(len(ids), bool)
            loss[-1] = False
            yield Part(k, 0, len(ids), ids, loss)

    return pack(rows, "k", examples, limits, cut).withColumnRenamed("k", key)


def pack_examples(rows: DataFrame, key: str, ids: str, loss: str, limits: Limits = Limits(), cut: bool = False) -> DataFrame:
    """Pieces of encoded examples: an array of ids and one of flags, true where a
    token bears loss (null or missing: false).  Examples without a token, null
    ones included, give no piece; a null id within an array counts as 0."""
    made = rows.select(F.col(key).alias("k"), F.col(ids).alias("ids"), F.col(loss).alias("loss"))

    def examples(batch: pa.RecordBatch) -> Iterator[Part]:
        for k, own, flags in zip(*(batch.column(c).to_pylist() for c in ("k", "ids", "loss")), strict=True):
            tokens = np.array([i or 0 for i in own or ()], dtype=np.uint32)
            if len(tokens):
                bears = np.zeros(len(tokens), bool)
                flags = [bool(f) for f in flags or ()][: len(tokens)]
                bears[: len(flags)] = flags
                yield Part(k, 0, len(tokens), tokens, bears)

    return pack(made, "k", examples, limits, cut).withColumnRenamed("k", key)
