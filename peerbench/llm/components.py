"""Connected components of a table of links, in rounds of large-star and small-star joins.

Every round reconnects each node's larger neighbours to the smallest node it sees, then does the same for the
smaller ones, until all links point at the smallest node of their component.  The number of rounds grows with
the logarithm of the longest chain.  Links never gather in one task: neighbours are reduced to a minimum before
the shuffle, and the join back reads two written tables, whose skewed keys adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.session import stored


def _state(links: DataFrame) -> tuple:
    """Number and checksum of the links: equal for equal sets."""
    total = links.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)))
    return tuple(total.first())


def _star(links: DataFrame, name: str) -> DataFrame:
    """Connect the ``b`` of every link to the smallest node that its ``a`` sees, ``a`` included."""
    smallest = stored(
        links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")), f"{name}-smallest"
    )
    return links.join(smallest, "a")


def components(links: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that links lead to, for every node with a link.

    ``links`` has columns ``a`` and ``b`` of one ordered type without nulls; direction, repetition and
    links of a node to itself do not matter.
    """
    links = stored(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-links",
    )
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            _star(both, f"{name}-large")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("root").alias("b"))
            .distinct()
        )
        large = stored(large, f"{name}-large")
        small = _star(large, f"{name}-small")
        small = small.where("b != root").select(F.col("b").alias("a"), F.col("root").alias("b")).union(
            small.select("a", F.col("root").alias("b"))
        )
        links = stored(small.distinct(), f"{name}-links")
        before, state = state, _state(links)
        if state == before:
            break
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return found.union(roots)
