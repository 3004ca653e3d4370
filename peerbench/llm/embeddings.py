"""Near-duplicate embeddings by cross-polytope hashing.

Vectors are rotated pseudo-randomly (random signs and fast Hadamard transforms, three times); the hash is the
axis, with its sign, that the rotated vector is nearest to, and a bucket of a table is a pair of hashes.  A
vector is kept in its own bucket and looked up in the next likely ones too (multiprobe).  Vectors that meet in a
bucket are compared by their cosine in double precision, so no wrong link is made.  The number of tables follows the
length of the vectors (``tables_for``), so that a true link at the threshold 0.93 is found in about 999 of 1,000 cases
at any length; tests measure it at 64, 384 and 768.

Only vectors of one label and length meet.  Equal vectors are reduced to one with a count first.  In a bucket
no pairs are written: links are counted for each vector, and what leaves the task is one count and at most one
edge (to the smallest vector it is connected with there) per vector; links are looked at ``PAIRS`` at a time.  A pair that meets in several buckets
counts in the first of them only, which both vectors' hashes tell.  A bucket with more than ``CHUNK`` vectors is
split into pairs of chunks, one task's work each, so that nothing is left out and no task holds all of it.

Vectors that are null, zero or hold null or non-finite components, and those without a label, link with nothing
and are their own component.  Repeated rows are vectors of their own with equal ids; an empty table gives an
empty result.  A component is named by its smallest non-null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.llm.components import components
from peerbench.session import stored

THRESHOLD = 0.93
LEAST_TABLES = 6
HASHES = 2
PROBES = 4
NEAREST = 3
SEED = 5
# Vectors of a bucket that one task compares with each other.
CHUNK = 4096
# Rows of a block of cosines, and pairs whose buckets are compared at a time.
BLOCK = 512
PAIRS = 1 << 16


def tables_for(length: int) -> int:
    """Tables for vectors of a length: the longer, the more likely a close pair is parted by a rotation."""
    doublings = max(0, (max(length, 2) - 1).bit_length() - 6)
    return LEAST_TABLES + (3 * doublings + 1) // 2


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in double precision; scaled first, so that very large or small ones stay finite."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis, whose length is a power of two."""
    rows, size = x.shape
    step = 1
    while step < size:
        pairs = x.reshape(rows, size // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, size)
        step *= 2
    return x


def bucket_codes(vectors: np.ndarray) -> np.ndarray:
    """Buckets of unit vectors: (vector, table, probe), the own bucket first."""
    rows, length = vectors.shape
    size = max(2, 1 << (length - 1).bit_length())
    padded = np.zeros((rows, size))
    padded[:, :length] = vectors
    nearest = min(NEAREST, size)
    tables = tables_for(length)
    codes = np.empty((rows, tables, PROBES), dtype=np.int32)
    for number in range(tables):
        total = np.zeros((rows, 1), dtype=np.int64)
        loss = np.zeros((rows, 1))
        for part in range(HASHES):
            random = np.random.default_rng([SEED, number, part, size])
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * (random.integers(0, 2, size) * 2.0 - 1.0)) / np.sqrt(size)
            large = np.abs(turned)
            axes = np.argsort(-large, axis=1, kind="stable")[:, :nearest]
            heights = np.take_along_axis(large, axes, axis=1)
            signed = axes * 2 + (np.take_along_axis(turned, axes, axis=1) > 0)
            total = (total[:, :, None] * (2 * size) + signed[:, None, :]).reshape(rows, -1)
            loss = (loss[:, :, None] + ((heights[:, :1] - heights) ** 2)[:, None, :]).reshape(rows, -1)
        order = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
        chosen = np.take_along_axis(total, order, axis=1)
        # Very short vectors have fewer buckets than probes.
        codes[:, number] = np.pad(chosen, ((0, 0), (0, PROBES - chosen.shape[1])), mode="edge")
    return codes


def first_meeting(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first table, and the smallest bucket in it, in which vectors with codes ``a`` and ``b`` meet."""
    none = np.iinfo(np.int32).max
    at_a = np.where((b == a[:, :, :1]).any(axis=2), a[:, :, 0], none)
    at_b = np.where((a == b[:, :, :1]).any(axis=2), b[:, :, 0], none)
    bucket = np.minimum(at_a, at_b)
    table = np.argmax(bucket != none, axis=1)
    return table, bucket[np.arange(len(bucket)), table]


def connected(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest place that links ``a``-``b`` connect each of ``size`` places with."""
    roots = np.arange(size)
    while True:
        low = np.minimum(roots[a], roots[b])
        before = roots.copy()
        np.minimum.at(roots, roots[a], low)
        np.minimum.at(roots, roots[b], low)
        np.minimum.at(roots, a, low)
        np.minimum.at(roots, b, low)
        roots = roots[roots]
        if (roots == before).all():
            return roots


class Cell:
    """The vectors of one bucket, or of two chunks of it, in order of their number."""

    def __init__(self, rows: dict[str, np.ndarray], kind: str) -> None:
        order = np.argsort(rows["gid"], kind="stable")
        self.gid, self.copies, self.own, self.chunk = (
            rows[name][order] for name in ("gid", "copies", "own", "chunk")
        )
        self.table, self.bucket = rows["table"][0], rows["bucket"][0]
        # Two chunks are compared with each other only; each with itself has a cell of its own.
        self.crossing = rows["low"][0] != rows["high"][0]
        self.vectors = unit(np.stack([np.frombuffer(v, dtype=kind) for v in rows["vector"][order]]))
        self.codes = np.stack([np.frombuffer(c, dtype=np.int32).reshape(-1, PROBES) for c in rows["codes"][order]])

    def links(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the linked pairs that meet here first, some at a time."""
        for start in range(0, len(self.gid), BLOCK):
            close = self.vectors[start : start + BLOCK] @ self.vectors[start:].T >= threshold
            close &= self.own[start : start + BLOCK, None] | self.own[start:]
            if self.crossing:
                close &= self.chunk[start : start + BLOCK, None] != self.chunk[start:]
            linked = np.flatnonzero(np.triu(close, 1))
            for some in range(0, len(linked), PAIRS):
                a, b = np.divmod(linked[some : some + PAIRS], close.shape[1])
                a, b = a + start, b + start
                table, bucket = first_meeting(self.codes[a], self.codes[b])
                first = (table == self.table) & (bucket == self.bucket)
                yield a[first], b[first]

    def result(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Numbers of the vectors with links, how many vectors each is linked to, and the smallest connected."""
        size = len(self.gid)
        counts, roots, all_ = np.zeros(size), np.arange(size), np.arange(size)
        for a, b in self.links(threshold):
            counts += np.bincount(a, self.copies[b], size) + np.bincount(b, self.copies[a], size)
            # What was connected before stays so.
            roots = connected(np.append(a, all_), np.append(b, roots), size)
        places = np.flatnonzero(counts)
        if not len(places):
            return None
        return self.gid[places], counts[places].astype(np.int64), self.gid[roots[places]]


def valid(vector: Column) -> Column:
    value = F.transform(vector, lambda x: x.cast("double"))
    # Infinity less itself and NaN are not equal to zero.
    fine = F.forall(value, lambda x: x.isNotNull() & ((x - x) == 0))
    return F.coalesce(fine & F.exists(value, lambda x: x != 0), F.lit(False))


def bucket_rows(distinct: DataFrame) -> DataFrame:
    """A row for every vector, table and probe: where it is looked up."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            lengths = np.diff(np.asarray(lists.offsets))
            flat = np.asarray(lists.flatten())
            ends = np.cumsum(lengths)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                vectors = flat[(ends[rows] - length)[:, None] + np.arange(length)]
                codes = bucket_codes(unit(vectors))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(name).take(pa.array(rows)) for name in ("gid", "label", "copies")],
                        pa.array(np.full(len(rows), length, dtype=np.int32)),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(list(codes.reshape(len(rows), -1)), pa.list_(pa.int32())),
                    ],
                    ["gid", "label", "copies", "size", "vector", "codes", "places"],
                )

    kind = distinct.schema["label"].dataType.simpleString()
    hashed = distinct.mapInArrow(
        place, f"gid bigint, label {kind}, copies bigint, size int, vector binary, codes binary, places array<int>"
    )
    exploded = hashed.select("gid", "label", "copies", "size", "vector", "codes", F.posexplode("places").alias("at", "bucket"))
    return exploded.select(
        "gid", "label", "copies", "size", "vector", "codes", "bucket",
        F.floor(F.col("at") / PROBES).cast("int").alias("table"), (F.col("at") % PROBES == 0).alias("own"),
    )


def cell_rows(rows: DataFrame, chunk: int) -> DataFrame:
    """``rows`` with the chunk of each and the pairs of chunks it takes part in."""
    bucket = ["label", "size", "table", "bucket"]
    large = (
        rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
        .select(*[F.col(c).alias(f"_{c}") for c in bucket], F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    )
    large = stored(large, "embedding-large-buckets")
    same = [rows[c] == large[f"_{c}"] for c in bucket]
    cut = rows.join(large, same, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    cut = cut.withColumn("chunk", F.pmod(F.xxhash64("gid"), F.col("chunks")).cast("int"))
    return cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        *rows.columns,
        "chunk",
        F.least("chunk", "other").alias("low"),
        F.greatest("chunk", "other").alias("high"),
    )


def bucket_links(rows: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``gid``, ``n`` (vectors linked here) and ``root`` (smallest connected here) from every cell.

    The vectors come as bytes of numbers of the given ``kind``.
    """
    cell = ["cell", "label", "size", "low", "high"]
    names = ["gid", "copies", "own", "table", "bucket", "chunk", "low", "high", "vector", "codes"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, np.ndarray] | None = None
        for batch in batches:
            read = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ["cell", "label", "size", *names]}
            if waiting is not None:
                read = {name: np.concatenate([waiting[name], values]) for name, values in read.items()}
            keys = [read[name] for name in cell]
            changes = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            starts = np.append(0, np.flatnonzero(changes) + 1)
            # The last cell may go on in the next batch.
            waiting = {name: values[starts[-1] :] for name, values in read.items()}
            yield from results(read, starts)
        if waiting is not None:
            yield from results(waiting, np.array([0, len(waiting["gid"])]))

    def results(read: dict[str, np.ndarray], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        for place in np.flatnonzero(np.diff(bounds) > 1):
            part = slice(bounds[place], bounds[place + 1])
            if read["own"][part].any():
                found.append(Cell({name: read[name][part] for name in names}, kind).result(threshold))
        found = [x for x in found if x is not None]
        if found:
            columns = [pa.array(np.concatenate(column)) for column in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, ["gid", "n", "root"])

    placed = rows.withColumn("cell", F.xxhash64("table", "bucket", "label", "size"))
    dealt = placed.repartition(*cell).sortWithinPartitions(*cell)
    return dealt.mapInArrow(compare, "gid bigint, n bigint, root bigint")


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    chunk: int = CHUNK,
) -> DataFrame:
    """``id_col``, n_links, component_id, kept of every row."""
    # Components travel in the precision they have.
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    vector = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), vector.alias("_vector"))
    fine = F.col("_label").isNotNull() & valid(F.col("_vector"))
    distinct = (
        rows.where(fine).groupBy(F.col("_label").alias("label"), F.col("_vector").alias("vector"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("first_id"))
        .withColumn("gid", F.monotonically_increasing_id())
    )
    # Written before the numbers are used, so they stay the same.
    distinct = stored(distinct, "embedding-distinct")
    cells = cell_rows(bucket_rows(distinct), chunk)
    found = stored(bucket_links(cells, threshold, "float32" if single else "float64"), "embedding-links")
    counts = found.groupBy(F.col("gid").alias("c_gid")).agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("gid").alias("a"), F.col("root").alias("b")), "embedding")
    member = (
        distinct.join(counts, distinct["gid"] == F.col("c_gid"), "left")
        .join(roots, distinct["gid"] == roots["node"], "left")
        .select(
            "label", "vector", "first_id", F.coalesce("root", "gid").alias("root"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    named = stored(
        member.groupBy(F.col("root").alias("n_root")).agg(F.min("first_id").alias("component")), "embedding-named"
    )
    member = stored(
        member.join(named, member["root"] == named["n_root"]).select("label", "vector", "n_links", "component"),
        "embedding-members",
    )
    same = (F.col("_label") == F.col("label")) & (F.col("_vector") == F.col("vector")) & fine
    component = F.when(F.col("label").isNull(), F.col("_id")).otherwise(F.col("component"))
    return rows.join(member, same, "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"),
    )
