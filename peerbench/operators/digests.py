"""Equality of large tables by a tree of order-free range digests.

Rows are digested per range of a whole-number key: how many there are, and the sums of two hashes over all columns.
Sums do not depend on the order of rows and change with repetition.  The digests of wider ranges are sums of those of
the narrower ones, up to one for the whole table, so a tree costs one pass over the table and no shuffle of its rows.

Two tables are compared from the top: only below nodes that differ are the children compared, and only rows in the
narrowest ranges that differ are looked at: first their keys and hashes, then, of keys that differ, the whole rows one
by one.  NULL keys have a range of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.operators.compare import differing_rows
from peerbench.session import sized, stored

# Keys of the narrowest range, and children of a node, as powers of two.
LEAF_BITS = 10
FAN_BITS = 6
LEVELS = 4

DIGEST = ("rows", "first_hash", "second_hash")


def _sums(columns: list[Column]) -> list[Column]:
    """Sums of ``columns`` under the names of a digest, exact for any number of rows."""
    return [F.sum(c.cast("decimal(38,0)")).alias(name) for c, name in zip(columns, DIGEST)]


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes over all columns.  The hash skips a NULL, so the second one also covers which columns are NULL."""
    columns = [F.col(c) for c in sorted(df.columns)]
    blank = [c.isNull() for c in columns]
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns, *blank)]


def leaf_digests(df: DataFrame, key: str) -> DataFrame:
    """``node`` (number of the narrowest range) and its digest: one pass with partial sums per task."""
    hashes = [F.lit(1), *_row_hashes(df)]
    return df.groupBy(F.shiftright(F.col(key).cast("bigint"), LEAF_BITS).alias("node")).agg(*_sums(hashes))


def level_digests(leaves: DataFrame, level: int) -> DataFrame:
    """Digests ``level`` steps above the narrowest ranges; above ``LEVELS`` steps that of the whole table, node 0."""
    node = F.shiftright("node", level * FAN_BITS) if level <= LEVELS else F.lit(0).cast("bigint")
    return leaves.groupBy(node.alias("node")).agg(*_sums([F.col(c) for c in DIGEST]))


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes whose digests differ, with the number of rows on both sides."""
    a, b = (
        t.select(F.col("node").alias(f"{s}node"), F.struct(*DIGEST).alias(s)) for t, s in ((left, "_a"), (right, "_b"))
    )
    both = a.join(b, F.col("_anode").eqNullSafe(F.col("_bnode")) & F.col("_a").isNotNull() & F.col("_b").isNotNull(), "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(
        F.when(F.col("_a").isNotNull(), F.col("_anode")).otherwise(F.col("_bnode")).alias("node"),
        F.coalesce("_a.rows", F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce("_b.rows", F.lit(0)).cast("bigint").alias("right_rows"),
    )


@dataclass(frozen=True)
class Comparison:
    """Two tables with the same columns and the digests of both, each from one pass."""

    left: DataFrame
    right: DataFrame
    key: str
    left_leaves: DataFrame
    right_leaves: DataFrame

    def differing_nodes(self) -> DataFrame:
        """``node``, ``left_rows``, ``right_rows`` of the narrowest ranges that differ.

        The tree is descended level by level; a level compares only children of nodes that differ above.
        """
        left, right = self.left_leaves, self.right_leaves
        found = None
        for level in range(LEVELS + 1, -1, -1):
            sides = [left, right]
            if found is not None:
                # Few nodes, or the tables have little in common.
                above = found.select(F.col("node").alias("_above"), F.lit(True).alias("_known"))
                steps = F.shiftright("node", (level + 1) * FAN_BITS) if level < LEVELS else F.lit(0)
                sides = [t.join(above, steps.eqNullSafe(F.col("_above")), "left_semi") for t in sides]
            found = stored(_differing(*[level_digests(t, level) for t in sides]), f"digest-level-{level}")
            if found.isEmpty():
                break
        return found

    def ranges(self) -> DataFrame:
        """``first_key``, ``last_key``, ``left_rows``, ``right_rows`` of the narrowest ranges that differ."""
        first = F.shiftleft("node", LEAF_BITS)
        return self.differing_nodes().select(
            first.alias("first_key"), (first + ((1 << LEAF_BITS) - 1)).alias("last_key"), "left_rows", "right_rows"
        )

    def rows(self) -> DataFrame:
        """Rows, with multiplicity and their ``side``, found on one side only; only differing ranges are read."""
        nodes = stored(self.differing_nodes().select(F.col("node").alias("_node")), "digest-nodes")
        span = nodes.agg(F.min("_node"), F.max("_node"), F.count(F.lit(1)), F.count("_node")).first()
        parts = []
        for table in (self.left, self.right):
            if span[0] is not None and span[2] == span[3]:
                # What lies outside is not read where the files tell their smallest and largest key.
                table = table.where(F.col(self.key).between(span[0] << LEAF_BITS, ((span[1] + 1) << LEAF_BITS) - 1))
            node = F.shiftright(F.col(self.key).cast("bigint"), LEAF_BITS)
            parts.append(table.join(nodes, node.eqNullSafe(F.col("_node")), "left_semi"))
        keys = self._differing_keys(*parts)
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        return differing_rows(*[part.join(keys, same, "left_semi") for part in parts])

    def _differing_keys(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """``_key``: keys whose rows are not the same on both sides.  Only keys and hashes are shuffled."""
        sides = []
        for table, sign in ((left, 1), (right, -1)):
            first, second = _row_hashes(table)
            key = F.col(self.key).alias("_key")
            sides.append(table.select(key, first.alias("_h1"), second.alias("_h2"), F.lit(sign).alias("_n")))
        counts = sides[0].unionAll(sides[1]).groupBy("_key", "_h1", "_h2").agg(F.sum("_n").alias("_n"))
        both = self.left_leaves.unionAll(self.right_leaves).agg(F.sum("rows")).first()[0] or 0
        with sized(left.sparkSession, int(both)):
            return stored(counts.where("_n != 0").select("_key").distinct(), "digest-keys")


def compare_tables(left: DataFrame, right: DataFrame, key: str) -> Comparison:
    """Digest both tables, one pass each."""
    leaves = [stored(leaf_digests(t, key), "digest-leaves") for t in (left, right)]
    return Comparison(left, right, key, *leaves)
