"""Chat formatting with loss masks aligned by offsets.

A conversation becomes one text of turns ``<|im_start|>role<|im_sep|>text<|im_end|>``.
Inside roles and texts a backslash is put between every ``<`` and ``|`` (``<|``
becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|`` and so on), so the control strings are
the template's alone, and taking one backslash out again is exact.

The whole text is encoded once, with character offsets.  The control strings are
single tokens of the tokenizer, so no token reaches across a border of a turn.
The spans of assistant texts are sorted, and so are the tokens: binary search
finds the first and the last token of each span.

Rows of a conversation are ordered by turn (null first), then role and text; a
null text or role is empty; repeated rows are turns of their own; a null conv_id
is a conversation.  Conversations are dealt by id and sorted, and a worker reads
them as a stream: it holds at most CHUNK characters of a conversation (or one
turn), closes such a segment at the end of a turn and goes on.  Control tokens
part the segments, so ids and offsets are those of the whole text.  One digest
over a whole conversation is a sequential sum, so its turns pass one task, with
bounded memory.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

START, SEP, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
CHUNK = 200_000
ROWS = 200
_TURN = regex.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", regex.S)
_LOADED: dict[str, object] = {}


def escape(text: str) -> str:
    return regex.sub(r"<(\\*)\|", r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return regex.sub(r"<\\(\\*)\|", r"<\1|", text) if "<" in text else text


def tokenizer(path: str):
    """The vocabulary file with the control strings as further single tokens."""
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        made.add_special_tokens([START, SEP, STOP])
        _LOADED[path] = made
    return _LOADED[path]


@dataclass
class Segment:
    """Part of a formatted conversation, from a turn's start to a turn's end."""

    text: str
    ids: list[int]
    offsets: np.ndarray
    spans: np.ndarray
    mask: np.ndarray

    def turns(self) -> list[tuple[str, str]]:
        """Roles and texts, read back from the formatted text."""
        return [(unescape(r), unescape(x)) for r, x in _TURN.findall(self.text)]

    def learned(self) -> list[str]:
        """Texts under the mask, read back through the masked tokens' offsets."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], self.mask, [0]])))
        return [
            unescape(self.text[self.offsets[a, 0] : self.offsets[z - 1, 1]])
            for a, z in zip(edges[::2], edges[1::2], strict=True)
        ]


def segment(turns: list[tuple[str, str]], path: str) -> Segment:
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = START + escape(role) + SEP
        body = escape(text)
        if role == LEARNED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, STOP]
        at += len(head) + len(body) + len(STOP)
    whole = "".join(parts)
    encoded = tokenizer(path).encode(whole, add_special_tokens=False)
    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
    spans = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(offsets[:, 0], spans[:, 0], "left")
    last = np.searchsorted(offsets[:, 1], spans[:, 1], "right")
    change = np.zeros(len(offsets) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, np.maximum(first, last), -1)
    return Segment(whole, encoded.ids, offsets, spans, np.cumsum(change)[:-1])


def conversations(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int | None, Iterator[Segment]]]:
    """(conv_id, its segments) of sorted rows; segments must be read in turn."""
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True))

    def segments(turns) -> Iterator[Segment]:
        held, size = [], 0
        for _, role, text in turns:
            held.append((role or "", text or ""))
            size += len(text or "")
            if size >= CHUNK:
                yield segment(held, path)
                held, size = [], 0
        if held:
            yield segment(held, path)

    for conv_id, turns in groupby(rows, key=lambda r: r[0]):
        yield conv_id, segments(turns)


def sorted_turns(turns: DataFrame) -> DataFrame:
    rows = turns.selectExpr("cast(conv_id as long) conv_id", "turn", "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_chats(turns: DataFrame, path: str) -> DataFrame:
    """One row for each segment: conv_id, part, text, ids, mask (0 or 1 for each
    token) and offsets of the tokens in the conversation's formatted text."""
    schema = "conv_id long, part long, text string, ids array<int>, mask array<byte>, starts array<long>, ends array<long>"
    kinds = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32())),
                       ("mask", pa.list_(pa.int8())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv_id, segments in conversations(batches, path):
            shift = 0
            for part, s in enumerate(segments):
                at = s.offsets + shift
                shift += len(s.text)
                yield pa.RecordBatch.from_pylist(
                    [{"conv_id": conv_id, "part": part, "text": s.text, "ids": s.ids, "mask": s.mask.tolist(),
                      "starts": at[:, 0].tolist(), "ends": at[:, 1].tolist()}], kinds)

    return sorted_turns(turns).mapInArrow(run, schema)


def digests(turns: DataFrame, path: str) -> DataFrame:
    """One row for each conversation, read back from its formatted segments."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]
    kinds = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])
    schema = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for conv_id, segments in conversations(batches, path):
            said, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = chars = formatted = tokens = masked = 0
            for s in segments:
                for role, text in s.turns():
                    n_turns += 1
                    said.update(f"{role}\n{text}\n".encode())
                for text in s.learned():
                    chars += len(text)
                    loss.update(text.encode())
                formatted += len(s.text)
                tokens += len(s.ids)
                masked += int(s.mask.sum())
            held.append((conv_id, n_turns, said.hexdigest(), chars, loss.hexdigest(), formatted, tokens, masked))
            if len(held) >= ROWS:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in held], kinds)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in held], kinds)

    return sorted_turns(turns).mapInArrow(run, schema)


#: The columns of ``digests`` straight from the rows: each turn has 32 letters of
#: control strings, and each ``<``, backslashes, ``|`` gains a letter.
SQL = """
with t as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations
  union all values (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
s as (select conv_id, count(*) n_turns,
    sha256(string_agg(r || chr(10) || x || chr(10), '' order by turn, r, x)) turns_sha256,
    coalesce(string_agg(x, '' order by turn, r, x) filter (where r = 'assistant'), '') loss,
    cast(sum(32 + length(r) + length(x) + len(regexp_extract_all(r, '<\\\\*[|]'))
             + len(regexp_extract_all(x, '<\\\\*[|]'))) as bigint) formatted_chars
  from t group by conv_id)
select conv_id, n_turns, turns_sha256, length(loss) loss_chars, sha256(loss) loss_sha256, formatted_chars from s
"""
