"""Figures of layers, sketches, digests, upkeep, catalogue tables, pages and rescued rows on small tables."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from peerbench.operators import benchmark as bm
from peerbench.operators.compare import value_gaps
from peerbench.operators.digests import LEAF_BITS, compare_tables
from peerbench.operators.figures import blanks, bounds, long_figures, stored_with
from peerbench.operators.ordering import running
from peerbench.operators.sketches import _medians, distinct_counts, distinct_sketches, seeded_median, within_error
from peerbench.operators.star import Star, duplicate_texts, surplus_numbers
from peerbench.operators.upkeep import Rules, first_version, next_version
from peerbench.plans import checks
from peerbench.plans.lake import Lake, from_extract, supply_lake
from peerbench.plans.layout import HOSPITAL, RAW_FIELDS
from peerbench.plans.measures import _expanded, evaluate
from peerbench.session import stored
from peerbench.sources.tables import drop_tables, overwrite_partitions, paged, save_bucketed, store_partitioned
from peerbench.sources.text import read_rescued

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- figures


def test_figures_are_those_of_the_written_rows(spark):
    rows = spark.createDataFrame([("a", 3), ("", None), (None, -2), (" b", 10**12)], "t string, v bigint")
    figures = {"rows": F.count(F.lit(1)), "total": F.sum(F.col("v").cast("decimal(20,0)")), **blanks(["t"]), **bounds(["v"])}
    written, found = stored_with(rows.repartition(3), "figures-test", figures)
    assert written.exceptAll(rows).count() == 0 and written.count() == 4
    row = found.first()
    assert (row.rows, int(row.total), row.blank_t, row.least_v, row.most_v) == (4, 10**12 + 1, 2, -2, 10**12)
    long = {(r.layer, r.figure): r.value for r in long_figures(found, "x").collect()}
    assert long["x", "rows"] == "4" and long["x", "least_v"] == "-2"


def test_figures_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "v bigint")
    _, found = stored_with(empty, "figures-test", {"rows": F.count(F.lit(1)), **bounds(["v"])})
    assert tuple(found.first()) == (0, None, None)


def test_checks_read_the_model_three_times_and_the_raw_extract_once(spark):
    lake = supply_lake(spark, SF)
    lake.dimensions, lake.benchmark  # stored before
    reads = Counter()

    class Counted(Lake):
        raw = property(lambda self: (reads.update(["raw"]), lake.raw)[1])
        records = property(lambda self: (reads.update(["records"]), lake.records)[1])
        model = property(lambda self: (reads.update(["model"]), lake.model)[1])

    other = lake.with_layers()
    other.__class__ = Counted
    # What the data does not keep to: stays of no days, and one age that the domain does not list.
    assert {r.check for r in checks.checks(other).where("not passed").collect()} == {
        "stay text is valid", "exact and capped stays add up", "AgeGroups has no orphans", "age_group is within its domain"
    }
    # Its key values, its row numbers, its stays per hospital and stratum.
    assert reads == {"raw": 1, "records": 1, "model": 3}


# --- keys


def test_surplus_numbers_and_duplicate_texts(spark):
    numbers = [1, 2, 2, 2, 40_000, 40_000, 10**12, None]
    df = spark.createDataFrame([(n, f"t{n}") for n in numbers], "n bigint, t string")
    assert tuple(surplus_numbers(df, "n").first()) == (7, 3)
    assert {(r.t, r.copies) for r in duplicate_texts(df, "t").collect()} == {("t2", 3), ("t40000", 2)}
    assert tuple(surplus_numbers(df.limit(0), "n").first()) == (0, 0)


def test_value_gaps(spark):
    found = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", "q")], "field string, value string")
    listed = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "q"), ("b", "q")], "field string, value string")
    got = {r.field: tuple(r)[1:] for r in value_gaps(found, listed).collect()}
    assert got == {"a": (1, 1, 0), "b": (0, 0, 1)}


def test_running_totals_deal_every_range_to_its_own_task(spark):
    rows = spark.createDataFrame([(i % 3, i, i * i) for i in range(500)], "g int, k int, v bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    result = running(rows, ["g"], [F.col("k")], ["v"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "shufflepartitionidpassthrough" in plan(result)
    sums = defaultdict(int)
    expected = set()
    for i in range(500):
        sums[i % 3] += i * i
        expected.add((i, sums[i % 3], i // 3 + 1))
    assert {(r.k, r.cum_v, r.position) for r in result.collect()} == expected


# --- sketches


def test_sketched_counts_merge_and_keep_their_error(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 20_000).alias("v"), (F.col("id") % 7).alias("w"))
    sketches = distinct_sketches(rows, ["g"], {"v": F.col("v"), "w": F.col("w")})
    got = {(r.g, r.level): (r.v, r.w) for r in distinct_counts(sketches, ["g"], ["v", "w"], "rollup").collect()}
    assert {k: w for k, (_, w) in got.items()} == {(0, 0): 7, (1, 0): 7, (2, 0): 7, (None, 1): 7}
    assert all(abs(v - 20_000) <= 4 * 0.013 * 20_000 for v, _ in got.values())
    flags = spark.range(1).select(within_error(F.lit(105), F.lit(100)), within_error(F.lit(106), F.lit(100)), within_error(F.lit(1), F.lit(0)))
    assert tuple(flags.first()) == (True, False, True)


def slow_medians(rows, key):
    groups = defaultdict(list)
    for row in rows:
        if row[-1] is not None:
            groups[key(row)].append(row[-1])
    return {k: (sorted(v)[(len(v) - 1) // 2], sorted(v)[len(v) // 2]) for k, v in groups.items()}


@pytest.fixture(scope="module")
def values():
    random_ = random.Random(9)
    rows = [
        (random_.choice("aaab") if i % 50 else None, i % 4, random_.choice([None, 7, random_.randint(-9, 9), random_.randint(0, 10**9)]))
        for i in range(9000)
    ]
    return rows + [("one", 0, 5), ("two", 0, 1), ("two", 0, 10**15), ("none", 0, None), ("same", 1, 4), ("same", 1, 4)]


def test_seeded_medians_are_exact(spark, values):
    df = spark.createDataFrame(values, "g string, h int, v bigint")
    for by, key in (([], lambda r: ()), (["g"], lambda r: r[:1]), (["g", "h"], lambda r: r[:2])):
        found, passes = _medians(df, by, "v")
        got = {tuple(r)[:-2]: tuple(r)[-2:] for r in found.select(*by, "low", "high").collect()}
        assert got == slow_medians(values, key) and passes == 2


def test_seeded_medians_of_subtotals(spark, values):
    df = spark.createDataFrame(values, "g string, h int, v bigint")
    by = ["g", "h"]
    found = seeded_median(df, by, "v", lambda finest: _expanded(finest, by, "cube"), ["level", *by])
    got = {(r.level, r.g, r.h): (r.low, r.high) for r in found.collect()}
    expected = {}
    for level, key in ((0, lambda r: r[:2]), (1, lambda r: (r[0], None)), (2, lambda r: (None, r[1])), (3, lambda r: (None, None))):
        expected |= {(level, *k): v for k, v in slow_medians(values, key).items()}
    assert got == expected


def test_seeded_median_survives_a_bracket_that_misses(spark, values, monkeypatch):
    from peerbench.operators import sketches

    # A bracket around the wrong rank: every group is looked at as a whole and then narrowed.
    monkeypatch.setattr(sketches, "RANK_ERROR", -0.2)
    df = spark.createDataFrame(values, "g string, h int, v bigint")
    found, passes = _medians(df, ["g"], "v")
    got = {(r.g,): (r.low, r.high) for r in found.collect()}
    assert got == slow_medians(values, lambda r: r[:1]) and passes > 2


def test_dense_values_need_one_more_pass(spark):
    df = spark.range(40_000).select(F.lit("a").alias("g"), (F.col("id") * 1_000_003 % (1 << 40)).alias("v"))
    found, passes = _medians(df, ["g"], "v")
    ordered = sorted(i * 1_000_003 % (1 << 40) for i in range(40_000))
    assert tuple(found.first())[1:] == (ordered[19_999], ordered[20_000]) and passes <= 3


def test_seeded_median_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v bigint")
    assert seeded_median(df, [], "v").collect() == [] and seeded_median(df, ["g"], "v").collect() == []


# --- digests


def numbered(spark, rows):
    return spark.createDataFrame(rows, "k bigint, t string, v double")


def test_equal_tables_have_no_differing_range(spark):
    rows = [(i, f"t{i % 5}", i / 3) for i in range(9000)] + [(None, "n", None), (5, "t0", 5 / 3)]
    a, b = numbered(spark, rows).repartition(5), numbered(spark, list(reversed(rows)))
    compared = compare_tables(a, b.select("v", "k", "t"), "k")
    assert compared.ranges().count() == 0
    assert "Exchange rangepartitioning" not in plan(compared.left_leaves)


def test_defects_are_found_in_their_ranges(spark):
    rows = [(i, f"t{i % 5}", i / 3) for i in range(9000)]
    hurt = list(rows)
    hurt[17] = (17, "other", 17 / 3)
    hurt.append((4000, "t0", 4000 / 3))
    del hurt[8999]
    hurt.append((None, "null", None))
    compared = compare_tables(numbered(spark, rows), numbered(spark, hurt), "k")
    width = 1 << LEAF_BITS
    assert {(r.first_key, r.left_rows, r.right_rows) for r in compared.ranges().collect()} == {
        (0, width, width),
        (4000 // width * width, width, width + 1),
        (8999 // width * width, 9000 - 8999 // width * width, 8999 - 8999 // width * width),
        (None, 0, 1),
    }
    assert {(r.k, r.t, r.side) for r in compared.rows().collect()} == {
        (17, "t2", "left"), (17, "other", "right"), (4000, "t0", "right"), (8999, "t4", "left"), (None, "null", "right")
    }


def test_swapped_rows_and_repetitions_do_not_cancel(spark):
    a = numbered(spark, [(1, "x", 1.0), (2, "y", 2.0), (3, "z", 3.0), (3, "z", 3.0)])
    b = numbered(spark, [(1, "y", 1.0), (2, "x", 2.0), (3, "z", 3.0), (3, "z", 3.0)])
    c = numbered(spark, [(1, "x", 1.0), (2, "y", 2.0), (3, "z", 3.0)])
    assert compare_tables(a, b, "k").rows().count() == 4
    assert [r.side for r in compare_tables(a, c, "k").rows().collect()] == ["left"]
    assert compare_tables(a, a.limit(0), "k").rows().count() == 4


def test_only_differing_ranges_are_read(spark):
    rows = numbered(spark, [(i, "t", 1.0) for i in range(50_000)])
    left = paged(rows, "k", 1000).table
    right = left.withColumn("t", F.when(F.col("k") == 30_000, "u").otherwise(F.col("t")))
    found = compare_tables(left, right, "k").rows()
    assert "GreaterThanOrEqual(k," in plan(found) and "LessThanOrEqual(k," in plan(found)
    assert found.count() == 2


# --- upkeep


def test_upkeep_equals_a_rebuild(spark):
    random_ = random.Random(5)
    rules = Rules("h", ["s", "t"], "v", 5, 2)

    def make(n):
        # Hospital 0 and stratum (0, null) are hot.
        return [
            (random_.choice([0, 0, 1, 2, 3]), random_.choice([0, 0, 0, 1, 2]), random_.choice([None, "x"]), random_.randint(1, 50))
            for _ in range(n)
        ]

    schema = "h int, s int, t string, v int"
    rows = make(400)
    version = first_version(spark.createDataFrame(rows, schema), rules)
    frozen = sorted(map(str, version.benchmark.collect()))
    for _ in range(3):
        new = [r for r in make(60) if r[1] < 2]
        gone = random_.sample([r for r in rows if r[1] == 0], 30)
        later = next_version(version, spark.createDataFrame(new, schema), spark.createDataFrame(gone, schema), rules)
        left = Counter(rows + new)
        left.subtract(Counter(gone))
        rows = list(left.elements())
        rebuilt = bm.leave_one_out(spark.createDataFrame(rows, schema), "h", ["s", "t"], "v", 5, 2)
        # NULL strata are no peers of each other in the benchmark itself.
        assert sorted(map(str, later.benchmark.collect())) == sorted(map(str, rebuilt.collect()))
        touched = {(r.s, r.t) for r in later.touched.collect()}
        assert touched == {(r[1], r[2]) for r in new + gone} and all(s < 2 for s, _ in touched)
        assert sorted(map(str, version.benchmark.collect())) == frozen
        version, frozen = later, sorted(map(str, later.benchmark.collect()))


# --- tables


@pytest.fixture
def unbroadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_tables_join_and_sum_without_a_shuffle(spark, unbroadcast):
    rows = spark.range(2000).select((F.col("id") % 40).alias("h"), (F.col("id") % 3).alias("s"), F.col("id").alias("v"))
    a = save_bucketed(rows, "test_bucketed_a", ["h", "s"], 4)
    b = save_bucketed(rows.groupBy("h", "s").agg(F.sum("v").alias("total")), "test_bucketed_b", ["h", "s"], 4)
    joined = a.join(b, ["h", "s"])
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    assert "Exchange" not in plan(a.groupBy("h", "s").agg(F.sum("v")))
    assert joined.where("v > total").count() == 0 and joined.count() == 2000
    drop_tables(spark, ["test_bucketed_a", "test_bucketed_b"])


def test_overwriting_one_partition_keeps_the_others(spark):
    rows = spark.range(100).select(F.col("id").alias("v"), (F.col("id") % 4).alias("year"))
    save_bucketed(rows, "test_years", ["v"], 2, ["year"])
    overwrite_partitions(spark.createDataFrame([(1, -5), (1, -6)], "year bigint, v bigint"), "test_years")
    got = spark.table("test_years").groupBy("year").agg(F.count("v").alias("n"), F.min("v").alias("m")).collect()
    assert {tuple(r) for r in got} == {(0, 25, 0), (1, 2, -6), (2, 25, 2), (3, 25, 3)}
    drop_tables(spark, ["test_years"])


def test_slicers_prune_the_folders_of_the_stored_fact(spark):
    rows = spark.range(4000).select((F.col("id") % 20).cast("string").alias("c"), (F.col("id") % 5).alias("y"), F.col("id").alias("v"))
    fact = store_partitioned(rows, "test-fact", ["c", "y"])
    dims = stored(spark.range(20).select(F.col("id").cast("string").alias("c"), F.when(F.col("id") < 2, "few").otherwise("many").alias("label")), "test-dim")
    fact = fact.select("*", F.col("_metadata.file_path").alias("file"))
    chosen = Star(fact, {"dim": (dims, "c")}).select({"label": ["few"]}).fact.where("y = 1")
    assert "dynamicpruning" in plan(chosen).lower()
    assert chosen.count() == 200
    assert chosen.select("file").distinct().count() == 1


def test_a_page_reads_its_own_files_and_all_pages_are_the_table(spark):
    ids = [f"{i * 7919 % 100_000:06d}" for i in range(3000)]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id string, n int").repartition(3)
    pages = paged(df, "id", 64)
    ordered = sorted(ids)
    assert pages.ranges.count() == 47
    for page in (0, 1, 23, 46):
        got = pages.read(page)
        assert sorted(r.id for r in got.collect()) == ordered[page * 64 : (page + 1) * 64]
        assert "GreaterThanOrEqual(id," in plan(got)
        assert got.select(F.input_file_name()).distinct().count() <= 2
    assert pages.read(47).count() == 0
    whole = pages.read(0)
    for page in range(1, 47):
        whole = whole.unionAll(pages.read(page))
    assert sorted(r.id for r in whole.collect()) == ordered


# --- rescued rows


def test_rescued_rows_of_a_damaged_extract(spark, tmp_path):
    header = "a,b,c"
    (tmp_path / "one.csv").write_text(f'{header}\n1,2,3\n1,2\n1,2,3,4\n"x,y",,"q""r"\n')
    (tmp_path / "two.csv").write_text(f'{header}\n7,"open,9\n8,8,8\n')
    good, bad = read_rescued(spark, str(tmp_path), ["a", "b", "c"])
    assert sorted(map(tuple, good.collect())) == [("1", "2", "3"), ("8", "8", "8"), ("x,y", "", 'q"r')]
    got = {(r.file.rsplit("/", 1)[1], r.reason, r.text) for r in bad.collect()}
    assert got == {("one.csv", "few fields", "1,2"), ("one.csv", "many fields", "1,2,3,4"), ("two.csv", "open quote", '7,"open,9')}


def test_rescue_and_manifest_in_the_checks(spark, tmp_path):
    row = "1,New York City,Queens,001,A,18-29,3,E,Home,2024,139,P,1,Minor,Low,Medicare,Y,10.00,5.00"
    assert row.count(",") == len(RAW_FIELDS) - 1
    text = ",".join(RAW_FIELDS) + "\n" + row + "\n" + row.replace("1,New", "2,New", 1) + "\n3,short\n"
    (tmp_path / "page.csv").write_text(text)
    manifest = spark.createDataFrame([("page.csv", 3)], "path string, row_count bigint")
    lake = from_extract(spark, str(tmp_path), HOSPITAL, manifest, rescue=True)
    got = {r.check: (r.passed, r.observed, r.expected) for r in checks.record_checks(checks.Facts(lake)).collect()}
    assert got["no rows were set aside"] == (False, 1, 0)
    assert got["raw rows equal the manifest"] == (False, 2, 3)
    assert got["model rows equal raw rows"] == (True, 2, 2)
    with pytest.raises(Exception, match="(?i)malformed"):
        from_extract(spark, str(tmp_path), HOSPITAL).raw


# --- measures


def test_ranks_and_running_costs_by_hand(spark):
    rows = [("A", "x", 10), ("B", "x", 7), ("C", "x", 7), ("D", "x", 1), ("A", "y", 2), ("B", "y", 5), ("E", None, None)]
    schema = "HospitalName string, g string, CostCents bigint"
    model = spark.createDataFrame([(n, g, None if c is None else c * 100) for n, g, c in rows], schema)
    names = ["HospitalCostRank", "CumulativeEstimatedCost", "CumulativeCostPct"]
    got = {tuple(r)[:2]: tuple(r)[2:] for r in evaluate(model, names, ["g", "HospitalName"]).collect()}
    # Tied hospitals share rank and running cost.
    assert got["x", "A"] == (1, 10.0, 0.4) and got["x", "B"] == got["x", "C"] == (2, 17.0, 0.68)
    assert got["x", "D"] == (4, 25.0, 1.0) and got["y", "B"] == (1, 5.0, 5 / 7) and got["y", "A"] == (2, 7.0, 1.0)
    whole = evaluate(model, names).first()
    assert tuple(whole) == (1, 12.0, 12 / 32)
    level = {(r.level, r.g, r.HospitalName): r.HospitalCostRank for r in evaluate(model, names, ["HospitalName", "g"], mode="cube").collect()}
    assert level[1, None, "A"] == 1 and level[1, None, "B"] == 1 and level[1, None, "C"] == 3
    assert level[2, "x", None] == 1 and level[3, None, None] == 1 and level[0, "x", "C"] == 2
