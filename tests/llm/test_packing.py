import zlib

import numpy as np
import pytest

from quizlake.llm import packing
from quizlake.llm.queries import QUERIES, tokenizer_file

RANKS, SPECIAL = "byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256}


def wanted_ids(texts):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    made.no_truncation()
    made.no_padding()
    return [[*made.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]


def check_pieces(pieces, limits, padded=True):
    """Sequences are gapless and within all limits; the share of padding."""
    pad = total = 0
    for _, s in pieces.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]]
        size = int(s["length"].sum())
        assert 0 < size <= limits.tokens and len(s) <= limits.segments and s["loss_tokens"].sum() <= limits.loss
        assert (s["length"] > 0).all()
        pad += 0 if size & (size - 1) == 0 else limits.tokens - size
        total += size
    return pad / max(1, total)


def check_whole(pieces, key, ids):
    """Each id of each example lies in exactly one piece."""
    for k, own in ids.items():
        mine = pieces[pieces[key].isna()] if k is None else pieces[pieces[key] == k]
        mine = mine.sort_values("start")
        assert mine["start"].tolist() == [0, *mine["length"].cumsum().tolist()[:-1]]
        assert mine["length"].sum() == len(own) and set(mine["doc_tokens"]) == {len(own)}
        for start, n, crc in zip(mine["start"], mine["length"], mine["ids_crc32"], strict=True):
            assert crc == zlib.crc32(np.array(own[start : start + n], "<u4").tobytes())


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    pieces = QUERIES["op11_packing"](spark, folder).toPandas()
    check_whole(pieces, "doc_id", dict(zip(docs["doc_id"].tolist(), wanted_ids(docs["text"]), strict=True)))
    assert check_pieces(pieces, packing.Limits()) == 0.0


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.where("text is null or text not like 'other%'").dropDuplicates(["doc_id", "text"])
    docs = docs.where("doc_id is not null or text is not null")
    rows = docs.select("doc_id", "text").toPandas()
    names = [None if k != k else int(k) for k in rows["doc_id"]]
    for limits in (packing.Limits(), packing.Limits(64, 3, 50), packing.Limits(100, 2, 7)):
        pieces = packing.pack_texts(docs, "doc_id", "text", tokenizer_file(RANKS), SPECIAL, limits=limits).toPandas()
        check_whole(pieces, "doc_id", dict(zip(names, wanted_ids(rows["text"]), strict=True)))
        assert check_pieces(pieces, limits) == 0.0
    assert packing.pack_texts(no_docs, "doc_id", "text", tokenizer_file(RANKS), SPECIAL).count() == 0


def test_repeated_rows_are_examples_of_their_own(spark, odd_docs):
    pieces = packing.pack_texts(odd_docs, "doc_id", "text", tokenizer_file(RANKS), SPECIAL).toPandas()
    texts = [r["text"] for r in odd_docs.collect()]
    assert pieces["length"].sum() == sum(map(len, wanted_ids(texts)))
    assert check_pieces(pieces, packing.Limits()) == 0.0


def test_examples_with_masks_stay_whole(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        n = int(rng.integers(0, 90))
        loss = (rng.random(n) < (0.9 if k % 3 == 0 else 0.2)).tolist()
        rows.append((f"e{k}", rng.integers(0, 50_000, n).tolist(), loss, k, "clash"))
    rows += [("none", None, None, 1, "x"), ("long", list(range(500)), [True] * 500, 1, "x"), ("short mask", [1, 2, 3], [True], 1, "x")]
    df = spark.createDataFrame(rows, "name string, ids array<int>, mask array<boolean>, start int, offset string").repartition(2)
    limits = packing.Limits(128, 4, 64)
    pieces = packing.pack_examples(df, "name", "ids", "mask", limits).toPandas()
    check_pieces(pieces, limits)
    check_whole(pieces, "name", {r[0]: r[1] for r in rows if r[1]})
    uncut = pieces.groupby("name").size()
    assert set(uncut[uncut > 1].index) <= {"long"} | {r[0] for r in rows if r[2] and sum(r[2]) > 64}
    masks = {r[0]: sum(r[2] or []) for r in rows}
    assert pieces.groupby("name")["loss_tokens"].sum().to_dict() == {k: masks[k] for k in pieces["name"].unique()}


def test_products_choose_by_the_scarce_dimension():
    """With loss tokens scarce, an example that needs none goes beside one that
    needs all: the plain longest-first choice would not mix them."""
    part = lambda k, n, loss: packing.Part(k, 0, n, np.zeros(n, np.uint32), np.arange(n) < loss)
    packer = packing.Packer(packing.Limits(100, 10, 40), cut=False)
    for k in range(10):
        packer.add(part(f"learned{k}", 50, 40))
        packer.add(part(f"read{k}", 50, 0))
    packer.weigh()
    sequences = []
    while len(packer):
        sequences.append([p.key for p in packer.fill()])
    assert len(sequences) == 10 and all(sorted(x[:4] for x in s) == ["lear", "read"] for s in sequences)


def test_limits_must_be_positive(spark, no_docs):
    with pytest.raises(ValueError):
        packing.pack_texts(no_docs, "doc_id", "text", tokenizer_file(RANKS), SPECIAL, limits=packing.Limits(0))
