import math

import numpy as np
import pytest

from quizlake.llm import whitening
from quizlake.llm.queries import QUERIES


def matrices():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 6, 40):
        x = rng.standard_normal((3 * d, d))
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        yield x.T @ x
        yield np.eye(d) * 3
        yield np.zeros((d, d))
        yield np.diag(np.arange(d) + 1.0)
        yield (q * np.resize([5.0, 1.0, 1.0, 1e-9], d)) @ q.T


@pytest.mark.parametrize("matrix", list(matrices()))
def test_eigenpairs(matrix):
    matrix = (matrix + matrix.T) / 2
    k = min(16, len(matrix))
    values, vectors = whitening.leading(matrix, k)
    size = np.abs(matrix).max() or 1.0
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], rtol=0, atol=1e-13 * size)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def plain(vectors, k=16):
    """Everything from one matrix in memory, with numpy's eigenvectors."""
    keep = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vectors[i]] for i in keep], dtype=object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    z = (n * fit - sums).astype(float) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    far = n * x - sums
    whitened = (far.astype(float) / n) @ u / np.sqrt(np.maximum(e, 1e-300))
    return keep, n, (far * far).sum(axis=1).tolist(), whitened, e / (z * z).sum() * n


def compare(got, ids, vectors, components=16):
    keep, n, deviation, whitened, explained = plain(vectors, components)
    k = len(explained)
    assert len(got) == len(keep) * k and set(got["n"]) == {n}
    got = got.sort_values(["vec_id", "component"])
    order = np.argsort([ids[i] for i in keep], kind="stable")
    assert got["deviation"].tolist()[::k] == [deviation[i] for i in order]
    made = got["whitened"].to_numpy().reshape(-1, k)
    want = whitened[order]
    want = want * np.sign((made * want).sum(axis=0))
    assert np.allclose(made, want, rtol=0, atol=1e-9)
    assert np.allclose(got["explained"].to_numpy()[:k], explained, rtol=1e-10)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10


def test_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    vectors = [None if v is None else list(v) for v in rows["embedding"]]
    compare(QUERIES["op12_embedding_whitening"](spark, folder).toPandas(), rows["vec_id"].tolist(), vectors)


SCHEMA = "vec_id long, embedding array<float>, w double, x int, component string"


def frame(spark, vectors, ids=None):
    ids = ids or list(range(len(vectors)))
    return spark.createDataFrame([(i, v, 1.0, 2, "clash") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def test_odd_rows_and_copies(spark):
    rng = np.random.default_rng(2)
    vectors = [rng.standard_normal(5).tolist() for _ in range(60)]
    vectors += [vectors[0]] * 40 + [None, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf")] * 5]
    compare(whitening.whiten(frame(spark, vectors), "vec_id", "embedding").toPandas(), list(range(len(vectors))), vectors)


def test_result_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, [rng.standard_normal(4).tolist() for _ in range(50)])
    one, many = (whitening.whiten(d, "vec_id", "embedding").toPandas().sort_values(["vec_id", "component"]) for d in (df.coalesce(1), df.repartition(7)))
    for c in ("deviation", "whitened", "explained"):
        assert one[c].tolist() == many[c].tolist()


def test_degenerate_tables(spark):
    empty = whitening.whiten(frame(spark, []), "vec_id", "embedding")
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(frame(spark, [[], [], None]), "vec_id", "embedding").count() == 0
    same = whitening.whiten(frame(spark, [[1.0, 2.0]] * 3), "vec_id", "embedding").toPandas()
    assert len(same) == 6 and same["whitened"].isna().all() and same["explained"].isna().all() and set(same["deviation"]) == {0}
    lengths = whitening.whiten(frame(spark, [[1.0, 2.0], [2.0, 1.0], [0.0, 5.0], [1.0], [None]], [1, 2, None, 4, 5]), "vec_id", "embedding").toPandas()
    assert len(lengths) == 8 and lengths[lengths["vec_id"] == 4]["whitened"].isna().all()
    assert lengths["vec_id"].isna().sum() == 2
    two = whitening.whiten(frame(spark, [[1.0, 2.0], [3.0, 1.0]]), "vec_id", "embedding").toPandas()
    assert two[two["component"] == 2]["whitened"].isna().all() and two[two["component"] == 1]["whitened"].abs().round(9).tolist() == [1.0, 1.0]


def test_large_entries(spark):
    vectors = [[3e9, 1.0], [-2e9, 2.0], [1e6, -1e38], [5.0, 5.0]]
    got = whitening.whiten(frame(spark, vectors), "vec_id", "embedding").toPandas()
    assert len(got) == 8 and got["whitened"].notna().all() and got["deviation"].isna().any()
    fits = [[4e6, 1.0], [-4e6, 2.0], [1e6, 3.0]]
    got = whitening.whiten(frame(spark, fits), "vec_id", "embedding").toPandas()
    assert got.sort_values(["vec_id", "component"])["deviation"].tolist()[::2] == plain(fits)[2]
