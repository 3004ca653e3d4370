"""What has to hold so that work grows with its input: rows per task, what is shuffled, what is written."""

import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from peerbench.operators import sketches
from peerbench.operators.digests import compare_tables
from peerbench.operators.packing import pack, unpack
from peerbench.plans import checks, clean, extract, lake as lakes, measures, registry
from peerbench.plans.lake import Lake
from peerbench.plans.layout import HOSPITAL, RAW_FIELDS
from peerbench.plans.measures import evaluate
from peerbench import session
from peerbench.plans.binding import raw_stays
from peerbench.session import TASK_ROWS, fresh_path, held, meeting_small, sized, stored, task_count
from peerbench.sources.files import LISTING_TASKS, file_digests, list_files
from peerbench.sources.tables import paged

PARTITIONS = "spark.sql.shuffle.partitions"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(400):
        values = {c: "x" for c in RAW_FIELDS} | {
            "source_row_id": f"{i:05d}-{i % 7}-{rng.randrange(9)}-{1 + i % 7}-{i % 50}",
            "permanent_facility_id": f"{rng.randrange(12):06d}",
            "facility_name": f"H, {rng.randrange(3)}",
            "length_of_stay": str(1 + rng.randrange(30)),
            "discharge_year": str(2020 + i % 3),
            "apr_drg_code": rng.choice(["139", "194"]),
            "apr_severity_of_illness_code": str(i % 4),
            "total_charges": f"{rng.randrange(10**5)}.25",
            "total_costs": f"{rng.randrange(10**5)}.50",
        }
        out.append(tuple(values[c] for c in RAW_FIELDS))
    return out


@pytest.fixture
def lake(spark, rows):
    return Lake(spark.createDataFrame(rows, list(RAW_FIELDS)).repartition(4), HOSPITAL, listed_rows=len(rows))


# --- rows per task


def test_large_jobs_have_more_tasks_and_the_setting_comes_back(spark):
    before = spark.conf.get(PARTITIONS)
    assert task_count(spark, 0) == int(before) and task_count(spark, 20 * TASK_ROWS + 1) == 21
    with sized(spark, 20 * TASK_ROWS):
        assert spark.conf.get(PARTITIONS) == "20" and task_count(spark, 0) == int(before)
        with sized(spark, 5):
            assert spark.conf.get(PARTITIONS) == "20"
    assert spark.conf.get(PARTITIONS) == before
    with pytest.raises(ValueError), sized(spark, 30 * TASK_ROWS):
        raise ValueError
    assert spark.conf.get(PARTITIONS) == before


# --- what is left on disk


def shuffle_files(spark) -> set[str]:
    """The files of shuffles that the session still has."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {name for name in names if name.startswith("shuffle_")}


def left_behind(spark, before: set[str]) -> set[str]:
    """New files of shuffles, once those that are about to be deleted are gone."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_a_setting_is_held_by_several_blocks(spark):
    key = "spark.sql.some.setting"
    with held(spark, key, "a"):
        with held(spark, key, "a"):
            assert spark.conf.get(key) == "a"
        assert spark.conf.get(key) == "a"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "mine")
    with pytest.raises(ValueError), held(spark, key, "a"):
        raise ValueError
    assert spark.conf.get(key) == "mine"
    spark.conf.unset(key)


def test_written_layers_leave_no_shuffle_behind(lake, spark):
    before = shuffle_files(spark)
    assert lake.rows == 400 and lake.model.columns and lake.key_values.columns
    assert not left_behind(spark, before)
    assert lake.model.count() == lake.rows and lake.key_values.count() > 0


def test_a_small_side_is_met_by_broadcast_once_it_is_known(spark, tmp_path, monkeypatch):
    tables = {
        "region": spark.range(2).selectExpr("int(id) r_regionkey", "concat('R', id) r_name"),
        "nation": spark.range(4).selectExpr("int(id) n_nationkey", "concat('N', id) n_name", "int(id % 2) n_regionkey"),
        "supplier": spark.range(20).selectExpr("id s_suppkey", "concat('S', id) s_name", "int(id % 4) s_nationkey"),
        "part": spark.range(300).selectExpr("id p_partkey", "'SMALL' p_type", "concat('B', id % 9) p_brand"),
        "customer": spark.range(300).selectExpr("id c_custkey", "'HOUSEHOLD' c_mktsegment"),
        "orders": spark.range(400).selectExpr(
            "id o_orderkey", "id % 300 o_custkey", "'O' o_orderstatus", "timestamp'1995-01-01 23:00:00' o_orderdate", "'1-URGENT' o_orderpriority"
        ),
        "lineitem": spark.range(900).selectExpr(
            "id % 400 l_orderkey", "id % 300 l_partkey", "id % 20 l_suppkey", "int(id % 7) l_linenumber", "5d l_quantity", "id + 0.25d l_extendedprice",
            "0.04d l_tax", "'N' l_returnflag", "'O' l_linestatus", "timestamp'1995-01-03 01:00:00' l_shipdate",
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(session, "BROADCAST_BYTES", 4096)

    def joins(threshold: str) -> list[bool]:
        """Whether rows met suppliers, orders and parts by broadcast, beginning with the last join."""
        with held(spark, "spark.sql.autoBroadcastJoinThreshold", threshold), meeting_small(spark):
            found = raw_stays(spark, str(tmp_path))
            assert {(r["length_of_stay"], r["discharge_year"]) for r in found.collect()} == {("2", "1995")}
            final = plan(found).split("== Initial Plan ==")[0]
        return ["Broadcast" in line for line in final.splitlines() if "Join [l_" in line]

    assert joins("300") == [True, False, False]
    assert joins("-1") == [False, False, False]
    seen = {}

    def write(df, name, figures):
        seen[name] = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
        return stored(df, name), None

    monkeypatch.setattr("peerbench.plans.lake.stored_with", write)
    assert Lake(raw_stays(spark, str(tmp_path)), HOSPITAL).raw.count() == 900
    assert seen == {"raw": str(10 << 20)} and spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None


def test_layers_are_written_with_tasks_for_their_rows(lake, spark, monkeypatch):
    seen = {}

    def watched(name, original):
        def write(df, as_name, *more):
            seen[as_name] = int(spark.conf.get(PARTITIONS))
            return original(df, as_name, *more)

        monkeypatch.setattr(name, write)

    monkeypatch.setattr("peerbench.session.TASK_ROWS", 10)
    watched("peerbench.plans.lake.stored_with", lakes.stored_with)
    watched("peerbench.plans.clean.stored_with", lakes.stored_with)
    watched("peerbench.plans.lake.stored", lakes.stored)
    assert lake.model.count() == 400
    assert {n: seen[n] for n in ("raw", "records", "benchmark", "model")} == dict.fromkeys(("raw", "records", "benchmark", "model"), 40)


def test_packed_rows_come_back_as_they_were(spark):
    texts = ["", " ", "a,b", None, "\x01", "\x02", "x\x02", "\x01\x02\x01", "\u00e9\u6f22", "\n\r", "\\", "1"]
    rows = [(i, a, b, 10**18 + i if i % 3 else None, -i, i / 7) for i, (a, b) in enumerate((a, b) for a in texts for b in texts)]
    df = spark.createDataFrame(rows, "k int, a string, b string, n bigint, m int, d double")
    broken = df.limit(2).withColumn("a", F.expr("cast(unhex('41C3') as string)")).withColumn("b", F.expr("cast(unhex('A942') as string)"))
    df = df.unionByName(broken).withColumn("hex", F.hex("a"))
    for kept in ([], ["k"], ["k", "d", "m"]):
        packed = pack(df, kept)
        assert {"_packed", "_plain"} < set(packed.columns) and "a" not in packed.columns and "d" in packed.columns
        back = unpack(packed.repartition(3, "d"), df, kept).select(*df.columns)
        assert back.dtypes == df.dtypes
        columns = [F.hex("a").alias("a"), F.hex("b").alias("b"), "k", "n", "m", "d", "hex"]
        assert Counter(back.select(columns).collect()) == Counter(df.select(columns).collect())
    assert pack(df, ["k"]).where("_packed IS NULL").count() == df.where("a RLIKE '[\x01\x02]' OR b RLIKE '[\x01\x02]' OR hex = '41C3'").count()


def test_whole_rows_are_short_in_a_shuffle(lake, monkeypatch):
    """The two shuffles of whole rows move their keys and one text, not a slot for every column."""
    seen = {}

    def watched(df, name, figures):
        seen[name] = plan(df)
        return original(df, name, figures)

    original = clean.stored_with
    monkeypatch.setattr(clean, "stored_with", watched)
    monkeypatch.setattr("peerbench.plans.lake.stored_with", watched)
    lake.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = lake.model
    finally:
        lake.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("records", "model"):
        moved = [line for line in seen[name].split("Exchange")[1].split("\n") if "Project [" in line][0]
        assert "_packed" in moved and "_plain" in moved
    same = clean.model_records(lake.clean, lake.benchmark).select(*model.columns)
    assert Counter(model.collect()) == Counter(same.collect())


def test_layers_are_compressed_well(spark):
    df = stored(spark.range(10), "codec-test")
    assert all(".zstd.parquet" in f for f in df.inputFiles())


# --- digests


def test_only_rows_of_differing_keys_are_compared(spark):
    left = [(k, f"v{k}") for k in range(3000)] + [(None, "n"), (7, "v7")]
    right = [(k, f"v{k}" if k % 500 else "other") for k in range(3000)] + [(None, "n"), (None, "n")]
    a, b = (spark.createDataFrame(r, "k bigint, v string") for r in (left, right))
    compared = compare_tables(a, b, "k")
    keys = {r[0] for r in compared._differing_keys(a, b).collect()}
    assert keys == {None, 7, 0, 500, 1000, 1500, 2000, 2500}
    got = Counter(map(tuple, compared.rows().collect()))
    ca, cb = Counter(left), Counter(right)
    expected = Counter({(*r, "left"): n for r, n in (ca - cb).items()}) + Counter({(*r, "right"): n for r, n in (cb - ca).items()})
    assert got == expected


def test_blanks_in_other_columns_are_a_difference(spark):
    schema = "k bigint, a string, b string"
    left = spark.createDataFrame([(1, "x", None)], schema)
    right = spark.createDataFrame([(1, None, "x")], schema)
    assert compare_tables(left, right, "k").rows().count() == 2


# --- medians, subtotals, distinct counts


def test_rows_meet_few_brackets_by_broadcast(spark):
    rows = stored(spark.range(40_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 9973).alias("v")), "few-groups")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        finest = stored(
            rows.groupBy("g").agg(F.kll_sketch_agg_bigint("v", sketches.SKETCH).alias("_s"), F.count(F.lit(1)).alias("_n")), "few-finest"
        )
        state = spark.createDataFrame([(0, 0, 9973, 2)], "key bigint, _from bigint, _to bigint, _shift int")
        expand = lambda f: f.select("*", F.explode(F.array(F.lit(0).cast("bigint"))).alias("key"))
        counts = sketches._counts(
            rows.withColumnRenamed("v", "_v"), stored(state, "few-state"), finest, ["g"], ["key"], expand
        )
        assert "SortMergeJoin" not in plan(counts) and "BroadcastHashJoin" in plan(counts)
        assert counts.agg(F.sum("_n")).first()[0] == 40_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


MODEL = "HospitalName string, HospitalKey string, c string, s int, ExactLOS int, CostCents bigint"


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    pick = lambda *v: rng.choice([*v, None])
    rows = [
        (f"h{rng.randrange(9)}" if rng.random() < 0.9 else None, f"k{rng.randrange(9)}", pick("a", "b"), pick(1, 2), pick(1, 2, 5), rng.randrange(99))
        for _ in range(500)
    ]
    return spark.createDataFrame(rows, MODEL)


@pytest.mark.parametrize("mode", ["cube", "rollup"])
@pytest.mark.parametrize("by", [["c", "HospitalName", "s"], ["HospitalName"], ["s", "c", "HospitalName"]])
def test_subtotals_within_a_hospital_are_those_of_spark(spark, model, by, mode):
    names = ["Discharges", "ExactLOSDischarges", "EstimatedCost"]
    got = evaluate(model, names, by, mode=mode)
    plain = (model.cube if mode == "cube" else model.rollup)(*by).agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)),
        F.count("ExactLOS"),
        F.sum("CostCents").cast("double") / 100,
    )
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))
    assert "Expand" not in plan(got)
    assert evaluate(model.limit(0), names, by, mode=mode).count() == 0


@pytest.mark.parametrize("mode", ["cube", "rollup"])
def test_stay_medians_do_not_split_the_other_groups(spark, model, mode):
    by = ["c", "s"]
    got = evaluate(model, ["Hospitals", "MedianLOS", "Discharges"], by, mode=mode)
    plain = (model.cube if mode == "cube" else model.rollup)(*by).agg(
        F.grouping_id().alias("level"), F.count_distinct("HospitalKey"), F.median("ExactLOS"), F.count(F.lit(1))
    )
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))
    # No group by hospital and stay together.
    assert not any("HospitalKey" in line and "ExactLOS" in line for line in plan(got).splitlines() if "keys=[" in line)


@pytest.mark.parametrize("by", [[], ["c"], ["c", "s"]])
def test_hospitals_of_groups_are_counted_apart_from_sums_and_stays(model, by):
    names = ["Hospitals", "MedianLOS", "Discharges", "EstimatedCost"]
    got = evaluate(model, names, by)
    plain = model.groupBy(*by).agg(
        F.count_distinct("HospitalKey"), F.median("ExactLOS"), F.count(F.lit(1)), F.sum("CostCents").cast("double") / 100
    )
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))
    # A group by hospital has no sum and no stays beside it.
    hospitals = [line for line in plan(got).splitlines() if "keys=[" in line and "HospitalKey" in line.split("functions=")[0]]
    assert hospitals and all("functions=[]" in line for line in hospitals)
    assert evaluate(model, ["Hospitals"], by).count() == plain.count()
    nothing = evaluate(model.limit(0), names, by).collect()
    assert [tuple(r) for r in nothing] == ([] if by else [(0, None, 0, None)])


@pytest.mark.parametrize("mode", ["cube", "rollup"])
def test_distinct_counts_of_subtotals(spark, model, mode):
    by = ["c", "s"]
    got = measures.distinct_levels(model, by, {"names": F.col("HospitalName"), "stays": F.col("ExactLOS")}, mode)
    plain = (model.cube if mode == "cube" else model.rollup)(*by).agg(
        F.grouping_id().alias("level"), F.count_distinct("HospitalName"), F.count_distinct("ExactLOS")
    )
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))


# --- catalogue tables and pages


def test_buckets_grow_with_the_rows(lake, spark, monkeypatch):
    monkeypatch.setattr("peerbench.session.TASK_ROWS", 20)
    kept = {}
    monkeypatch.setattr(registry, "save_bucketed", lambda df, name, by, buckets=None, partition=(): kept.update({name: buckets}) or df)
    registry.bucketed_model(lake)
    registry.bucketed_strata(lake)
    assert set(kept.values()) == {20}


def test_pages_are_written_once(spark):
    folder = Path(fresh_path(spark, "x")).parent
    count = lambda: sum(p.name.startswith(("pages-", "ordered-")) for p in folder.glob("*"))
    before = count()
    pages = paged(spark.range(100).select(F.format_string("%03d", "id").alias("id")), "id", 10)
    assert count() == before + 1
    assert sorted(r.id for r in pages.read(3).collect()) == [f"{i:03d}" for i in range(30, 40)]


# --- files


def test_round_trips_write_compressed_copies(lake, monkeypatch):
    used = []
    monkeypatch.setattr(extract, "drop", lambda spark, path: used.append(path))
    assert extract.page_union(lake, 100).count() == 4
    assert extract.export_roundtrip(lake).first().rows == 400
    assert extract.csv_roundtrip(lake).count() == 2
    assert len(used) == 3
    for path in used:
        assert [f for f in Path(path).glob("*.csv*") if f.suffix != ".crc"] and not [*Path(path).glob("*.csv")]


def test_damaged_years_have_several_files(lake, monkeypatch, rows):
    used = []
    monkeypatch.setattr(extract, "drop", lambda spark, path: used.append(path))
    found = extract.rescued_rows(lake).collect()
    year = RAW_FIELDS.index("discharge_year")
    assert sum(r.rows for r in found) == len(rows)
    for name, n in Counter(r[year] for r in rows).items():
        assert sum(r.rows for r in found if r.year == name) == n
        assert len([*Path(used[0], f"page={name}").glob("*.txt")]) > 1


def test_marked_pages_grow_in_number_with_one_header_each(lake, monkeypatch, rows):
    used = []
    monkeypatch.setattr(extract, "drop", lambda spark, path: used.append(path))
    monkeypatch.setattr(extract, "TASK_ROWS", 50)
    found = extract.marked_pages(lake).collect()
    assert sum(r.rows for r in found) == sum(r.ids for r in found) == len(rows)
    files = [*Path(used[0]).glob("*/*/*.txt")]
    assert len(files) > 12
    for file in files:
        text = file.read_text(encoding="utf-8")
        assert text.startswith("﻿") and text.count("﻿") == 1


def test_marked_pages_are_written_in_rounds(lake, spark, monkeypatch, rows):
    used, before, left = [], shuffle_files(spark), []
    monkeypatch.setattr(extract, "drop", lambda spark, path: used.append(path))
    monkeypatch.setattr(extract, "TASK_ROWS", 50)
    monkeypatch.setattr(extract, "ROUND_ROWS", 150)
    monkeypatch.setattr(extract, "read_text_table", lambda *a, f=extract.read_text_table: (left.extend(left_behind(spark, before)), f(*a))[1])
    assert lake.rows == len(rows)
    found = extract.marked_pages(lake).collect()
    assert sum(r.rows for r in found) == sum(r.ids for r in found) == len(rows)
    # Files of one write have its number in their names; no shuffle of theirs is left when they are read.
    names = [file.name for file in Path(used[0]).glob("*/*/*.txt")]
    assert len({name.split("-", 2)[2].split(".")[0] for name in names}) == 3 and not left
    assert all(file.read_text(encoding="utf-8").count("\ufeff") == 1 for file in Path(used[0]).glob("*/*/*.txt"))


def test_an_exported_copy_is_gone_before_the_source_is_read_again(lake, monkeypatch):
    done = []
    monkeypatch.setattr(extract, "drop", lambda spark, path: done.append("drop"))
    monkeypatch.setattr(extract, "meeting_small", lambda spark, f=extract.meeting_small: (done.append("source"), f(spark))[1])
    found = extract.export_roundtrip(lake).first()
    assert done == ["drop", "source"] and found.rows == 400 and found.raw_cents == found.exported_cents == found.model_cents


def test_a_damaged_extract_is_deleted_once_it_is_counted(lake, spark, monkeypatch):
    made = []
    monkeypatch.setattr(checks, "Lake", lambda *a, **b: made.append(Lake(*a, **b)) or made[-1])
    found = {r.check: r for r in checks.damaged_checks(lake).collect()}
    assert set(found) == set(checks.DAMAGED_CHECKS)
    assert found["model rows equal raw rows"].observed == found["model rows equal raw rows"].expected == made[0].rows > 400
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        made[0].raw.collect()
    assert lake.raw.count() == 400 and made[0].model.count() == made[0].rows


def test_files_are_written_and_digested_by_many_tasks(spark, tmp_path):
    texts = spark.range(64).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"))
    got = {r.key: r.status for r in extract.file_statuses(spark, texts, "k", "t").collect() if r.key >= 0}
    wrong = {2: "hash", 3: "size", 4: "extra"}
    assert got == {k: wrong.get(k % 10, "ok") for k in range(64)}
    for i in range(16):
        (tmp_path / f"{i}.txt").write_text(str(i))
    tasks = file_digests(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count()
    assert tasks > 1


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"k={i}").mkdir()
        (tmp_path / f"k={i}" / "a.txt").write_text("x")
    before = spark.conf.get(LISTING_TASKS)
    group = "listing-test"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert list_files(spark, str(tmp_path)).count() == 200
        tracker = spark.sparkContext.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
        sizes = [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sizes and max(sizes) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTING_TASKS) == before
