"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every source gets a target in words.  Whole epochs of the source come first; what is left of the target is
filled with documents in the order of their exponential keys, ``-ln(u) / weight``, where ``u`` is drawn from a
digest of the document and ``weight`` is its quality weight, so better documents come earlier.  The last document
is taken if at least half of it fits.

The order within a source is found without sorting the source: keys fall into ``CELLS`` cells, the sizes of cells are
summed, and the cell in which the target is reached is cut into as many cells again, until it holds a single key.  So
no task holds a source or an unbounded part of one, and the choice is a row per source (epochs and last key) that any
pass over the documents can apply.

Words are runs of other characters than space, tab and line ends.  Null and empty texts have size 0 and are never
taken.  A null source is a source and comes last.  Rows with one key (repeated rows) are taken together.  A
source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerbench.operators.ordering import row_key
from peerbench.session import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
CELLS = 1 << 12
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: the share of words among words and symbols."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return (size + 1) / (size + 1 + F.coalesce(symbols, F.lit(0)))


def uniform(identity: Column, text: Column, seed: str) -> Column:
    """A number above 0 and below 1 from the id, the text and the seed."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), identity.cast("string"), F.md5(text.cast("binary"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") + 0.5) / float(1 << 48)


def drawn(row: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, also: list[Column]) -> DataFrame:
    """``also`` and ``_source``, ``_size``, ``_key`` of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = row.select(
        *also,
        F.col(source_col).cast("string").alias("_source"),
        size_of(text).alias("_size"),
        text.alias("_t"),
        F.col(id_col).alias("_i"),
    )
    key = -F.log(uniform(F.col("_i"), F.col("_t"), seed)) / quality_weight(F.col("_t"), F.col("_size"))
    names = [c for c in sized.columns if c not in ("_t", "_i")]
    return sized.select(*names, key.alias("_key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source``, ``source_size`` and ``target``: shares of the total by weight, none above ``most`` sizes.

    Sources take the weights in turn.  What a source cannot take is shared by the others, again until no source
    is above its limit; the limits are compared in whole numbers.
    """
    order = [F.col("source").isNull(), F.col("source")]
    numbered = row_key(sizes, order, "_number")
    # In a cycle of n weights, place 1 has the first.
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_number") - 1) % len(weights) + 1).cast("int"))
    shares = stored(numbered.select("source", "source_size", weight.cast("bigint").alias("weight")), "mix-sources")
    limit = most * F.col("source_size")
    total = shares.agg(F.sum("source_size")).first()[0] or 0
    heads, full = None, F.lit(False)
    while True:
        free = shares.where(~full).agg(F.sum("weight")).first()[0] or 0
        held = shares.where(full).agg(F.sum(limit)).first()[0] or 0
        budget = total - held
        if free == heads or not free:
            break
        heads = free
        full = F.col("weight") * F.lit(budget).cast("decimal(38,0)") > limit * F.lit(free).cast("decimal(38,0)")
    share = F.col("weight") * F.lit(float(budget)) / F.lit(float(free or 1))
    return shares.select("source", "source_size", F.when(full, limit.cast("double")).otherwise(share).alias("target"))


def _cells(rows: DataFrame, cell: Column) -> DataFrame:
    """Words, smallest and largest key of the cells of every source."""
    in_cell = F.least(F.floor(cell * CELLS), F.lit(CELLS - 1)).cast("int").alias("_cell")
    return rows.groupBy("_source", in_cell).agg(
        F.sum("_size").alias("words"), F.min("_key").alias("low"), F.max("_key").alias("high")
    )


def _reached(cells: DataFrame, aims: DataFrame, name: str) -> DataFrame:
    """The cell of every source in which its target is reached: its keys, the words before it, its own, and the last
    key of the cells before it (``last_key``)."""
    # At most CELLS rows for any source.
    placed = cells.join(aims, F.col("_source").eqNullSafe(F.col("a_source")))
    up_to = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.withColumn("end", F.col("before") + F.sum("words").over(up_to))
    whole = F.max(F.when(F.col("end") <= F.col("rest"), F.col("high"))).alias("whole_key")
    crossing = F.min(
        F.when(F.col("end") > F.col("rest"), F.struct("_cell", "low", "high", (F.col("end") - F.col("words")).alias("start"), "words"))
    ).alias("c")
    found = ends.groupBy("a_source", "rest").agg(whole, F.first("last_key").alias("earlier"), crossing)
    return stored(
        found.select(
            "a_source", "rest", F.col("c.low").alias("low"), F.col("c.high").alias("high"),
            F.col("c.start").alias("before"), F.col("c.words").alias("words"),
            F.greatest("earlier", "whole_key").alias("last_key"),
        ),
        name,
    )


def plan_mix(drawn_rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``epochs``, ``last_key`` (of the fraction).

    ``drawn_rows`` has the columns of ``drawn`` and should be a written table.
    """
    cells = stored(_cells(drawn_rows, 1 - F.exp(-F.col("_key"))), "mix-cells")
    sizes = cells.groupBy(F.col("_source").alias("source")).agg(F.sum("words").alias("source_size"))
    aims = targets(stored(sizes, "mix-sizes"), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = aims.withColumn("epochs", epochs.cast("bigint"))
    aims = stored(aims.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    nothing = [F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("double").alias("last_key")]
    state = _reached(cells, aims.select(F.col("source").alias("a_source"), "rest", *nothing), "mix-reached")
    settled = []
    while True:
        # A cell with a single key is taken if at least half of it fits; a source without one ends with a whole cell.
        fits = (F.col("low") == F.col("high")) & (2 * F.col("before") + F.col("words") <= 2 * F.col("rest"))
        done = F.col("low").isNull() | (F.col("low") == F.col("high"))
        last = F.when(fits, F.col("low")).otherwise(F.col("last_key")).alias("last_key")
        settled.append(state.where(done).select("a_source", last))
        open_ = state.where(~done)
        if open_.isEmpty():
            break
        bounds = open_.select(F.col("a_source").alias("b_source"), "low", "high")
        inside = drawn_rows.join(
            bounds, F.col("_source").eqNullSafe(F.col("b_source")) & F.col("_key").between(F.col("low"), F.col("high"))
        )
        share = (F.col("_key") - F.col("low")) / (F.col("high") - F.col("low"))
        cells = _cells(inside.select("_source", "_size", "_key", share.alias("_share")), F.col("_share"))
        state = _reached(cells, open_.select("a_source", "rest", "before", "last_key"), "mix-reached")
    chosen = settled[0]
    for more in settled[1:]:
        chosen = chosen.unionByName(more)
    plan = aims.join(chosen, F.col("source").eqNullSafe(F.col("a_source")), "left")
    return stored(plan.select("source", "source_size", "target", "epochs", "last_key"), "mix-plan")


def copies() -> Column:
    """How often a row is taken, by the row of its source."""
    chosen = F.coalesce(F.col("_key") <= F.col("last_key"), F.lit(False))
    return F.when(F.col("_size") > 0, F.col("epochs") + chosen.cast("bigint")).otherwise(F.lit(0))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED
) -> DataFrame:
    """``id_col``, size, source_size, target, taken of every row."""
    rows = stored(drawn(docs, id_col, text_col, source_col, seed, [F.col(id_col).alias("_id")]), "mix-drawn")
    plan = plan_mix(rows)
    return rows.join(plan, F.col("_source").eqNullSafe(F.col("source"))).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * copies()).cast("bigint").alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    plan = plan_mix(stored(drawn(docs, id_col, text_col, source_col, seed, []), "mix-drawn"))
    # The texts are read again instead of being shuffled to their numbers.
    rows = drawn(docs, id_col, text_col, source_col, seed, [F.struct("*").alias("_row")])
    taken = rows.join(plan, F.col("_source").eqNullSafe(F.col("source"))).select("_row", copies().alias("copies"))
    return taken.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


ORACLE = """
WITH sized AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
    FROM documents
), keyed AS (
    SELECT doc_id, source, size,
        -ln((('0x' || substr(md5(concat_ws(':', 'mix-1', doc_id::VARCHAR, md5(t))), 1, 12))::BIGINT + 0.5) / 281474976710656.0::DOUBLE)
        / ((size + 1)::DOUBLE / (size + 1 + length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))) AS key
    FROM sized
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight FROM sources
), before AS (
    SELECT *,
        sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS budget,
        sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS free
    FROM weighted
    WINDOW earlier AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
    SELECT *, weight * budget > 3 * source_size * free AS capped FROM before
), level AS (
    SELECT (SELECT sum(source_size) FROM weighted) - coalesce(sum(3 * source_size) FILTER (capped), 0) AS budget,
        sum(weight) FILTER (NOT capped) AS free
    FROM marked
), aims AS (
    SELECT source, source_size,
        CASE WHEN capped THEN (3 * source_size)::DOUBLE
            ELSE weight * (SELECT budget FROM level)::DOUBLE / (SELECT free FROM level)::DOUBLE END AS target
    FROM marked
), plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM aims
), placed AS (
    SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs,
        coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
    FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
    (size * (epochs + CASE WHEN 2 * earlier + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
