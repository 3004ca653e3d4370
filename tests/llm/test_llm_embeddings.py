"""Embedding near-duplicates against all pairs."""

import __spark_entry__ as entry_point
import numpy as np
import pytest
from cases import peak_megabytes
from peerbench.llm.embeddings import (
    CHUNK, Cell, bucket_codes, connected, first_meeting, hadamard, near_duplicate_vectors, tables_for,
)

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def slow(rows, threshold=0.93):
    rows = [(i, None if v is None else [None if x is None else np.float32(x) for x in v], l) for i, v, l in rows]

    def usable(v, label):
        return label is not None and v and None not in v and np.isfinite(v).all() and any(v)

    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v, l) else None for _, v, l in rows]
    n = len(rows)
    links = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            same = i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
            if same and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i].append(j)
    roots = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([roots[i], *(roots[j] for j in links[i])])
            if low != roots[i]:
                roots[i], changed = low, True
    result = []
    for i, (vec_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if roots[j] == roots[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        result.append((vec_id, len(links[i]), component, vec_id is not None and vec_id == component))
    return result


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: [(v is None, str(v)) for v in row])


def clusters(seed, size=64):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(120):
        rows.append((i, rng.normal(size=size).tolist(), i % 3))
    for i in range(120, 300):
        base = np.array(rows[int(rng.integers(0, 12))][1])
        near = base + rng.normal(size=size) * rng.uniform(0.05, 0.45)
        rows.append((i, near.tolist(), int(rng.integers(0, 3))))
    return rows


def test_clusters_and_odd_vectors(spark):
    rows = clusters(1)
    one = rows[0][1]
    rows += [(400, one, 0), (401, one, 0), (401, one, 0), (402, one, None), (403, one, 1), (None, one, 0)]
    rows += [(404, None, 0), (405, [], 0), (406, [0.0] * 64, 0), (407, [float("nan"), 1.0], 0)]
    rows += [(408, [float("inf")] + one[1:], 0), (409, [None] + one[1:], 0), (410, one[:63], 0)]
    rows += [(411, [1e38] * 64, 2), (412, [1e-38] * 64, 2), (413, [3.0], 1), (414, [2.0], 1), (415, [-2.0], 1)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS gid", "'y' AS component", "1 AS copies")
    assert ordered(near_duplicate_vectors(table).collect()) == ordered(slow(rows))


def test_hot_bucket_split_into_chunks(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=32)
    rows = [(i, (base + rng.normal(size=32) * 0.25).tolist(), 7) for i in range(250)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert ordered(near_duplicate_vectors(table, chunk=20).collect()) == ordered(slow(rows))


def pairs_at(cosine, length, count, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(count, length))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


@pytest.mark.parametrize("length", [16, 64, 128, 384, 768, 1024])
def test_recall_at_the_threshold(length):
    a, b = pairs_at(0.93, length, 3000)
    _, bucket = first_meeting(bucket_codes(a), bucket_codes(b))
    recall = (bucket != np.iinfo(np.int32).max).mean()
    print(f"length {length}: {tables_for(length)} tables, recall {recall:.4f}")
    assert recall > 0.997


def dense_cell(count, chunks=1, length=64):
    """A bucket of vectors that are all linked, as a worker reads it."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=length) + rng.normal(size=(count, length)) * 0.02
    codes = bucket_codes(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
    mine = codes[:, 0, 0] == codes[0, 0, 0]
    vectors, codes = vectors[mine], codes[mine]
    n = len(vectors)
    rows = {
        "gid": np.arange(n), "copies": np.ones(n, dtype=np.int64), "own": np.ones(n, dtype=bool),
        "chunk": np.arange(n) % chunks, "table": np.zeros(n, dtype=np.int32),
        "bucket": np.full(n, codes[0, 0, 0], dtype=np.int32), "low": np.zeros(n), "high": np.full(n, chunks - 1),
        "vector": np.array([v.tobytes() for v in vectors], dtype=object),
        "codes": np.array([c.tobytes() for c in codes], dtype=object),
    }
    return Cell(rows, "float64"), n


@pytest.mark.parametrize("chunks", [1, 2])
def test_full_chunks_of_near_copies_stay_small(chunks):
    cell, n = dense_cell(CHUNK * chunks + 200, chunks)
    assert n > CHUNK * chunks * 0.95
    peak, (gid, counts, roots) = peak_megabytes(lambda: cell.result(0.93))
    own = np.bincount(np.arange(n) % chunks)
    assert len(gid) == n and (roots == 0).all()
    assert counts.sum() == (n * (n - 1) if chunks == 1 else 2 * own[0] * own[1])
    assert peak < 300


def test_hadamard_is_the_matrix():
    matrix = np.array([[1.0]])
    while len(matrix) < 16:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    x = np.random.default_rng(4).normal(size=(5, 16))
    assert np.allclose(hadamard(x), x @ matrix)


def test_connected_places():
    a, b = np.array([0, 5, 3, 7, 8]), np.array([5, 3, 2, 8, 9])
    assert connected(a, b, 11).tolist() == [0, 1, 0, 0, 4, 0, 6, 7, 7, 7, 10]


def test_empty_table(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert ordered(entry_point.queries()["op5_embeddings"](spark, sf).collect()) == ordered(slow(given))
