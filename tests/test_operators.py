"""Operators against brute force on small and skewed tables."""

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from peerbench.operators import benchmark as bm
from peerbench.operators.compare import compare_values, differing_rows
from peerbench.operators.median import narrowed_median, ranked_median
from peerbench.operators.ordering import every_kth, row_key, running
from peerbench.operators.pareto import pareto
from peerbench.operators.profile import blank_counts, group_counts, repeated_rows
from peerbench.operators.scenario import scenario_bridge, scenario_days, selected_rate
from peerbench.operators.selections import selection_metrics
from peerbench.operators.star import Star, duplicate_keys


def records(n=3000, seed=3):
    """Stays where one hospital holds a third of the rows and one stratum most of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hospital = "h0" if rng.random() < 0.34 else f"h{rng.randrange(1, 9)}"
        condition = "c0" if rng.random() < 0.6 else f"c{rng.randrange(1, 12)}"
        rows.append((i, hospital, condition, rng.randrange(1, 3), rng.randrange(1, 40)))
    return rows


SCHEMA = "id bigint, h string, c string, s int, v int"


def brute_force(rows, min_peers, min_entities):
    out = {}
    for _, h, c, s, _ in rows:
        if (h, c, s) in out:
            continue
        peers = [(r[1], r[4]) for r in rows if r[2] == c and r[3] == s and r[1] != h]
        own = [r[4] for r in rows if r[1:4] == (h, c, s)]
        hospitals = len({p[0] for p in peers})
        mean = sum(p[1] for p in peers) / len(peers) if peers else None
        supported = len(peers) >= min_peers and hospitals >= min_entities
        out[h, c, s] = (len(own), sum(own), len(peers), hospitals, mean if supported else None)
    return out


@pytest.mark.parametrize("method", [bm.leave_one_out, bm.leave_one_out_from_records])
def test_leave_one_out_against_every_pair(spark, method):
    rows = records()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r[:3]): tuple(r[3:]) for r in method(df, "h", ["c", "s"], "v").collect()}
    assert got == brute_force(rows, 30, 3)
    assert {v[4] is None for v in got.values()} == {True, False}


def test_leave_one_out_without_broadcast(spark):
    rows = records(seed=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        got = {tuple(r[:3]): tuple(r[3:]) for r in bm.leave_one_out(df, "h", ["c", "s"], "v").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == brute_force(rows, 30, 3)


def peers_table(spark, counts):
    rows, i = [], 0
    for h, n in counts.items():
        for _ in range(n):
            rows.append((i, h, "c", 1, 4))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "counts, expected",
    [
        ({"a": 5, "b": 10, "c": 10, "d": 10}, 4.0),  # 30 peers, 3 hospitals
        ({"a": 5, "b": 10, "c": 10, "d": 9}, None),  # 29 peers
        ({"a": 5, "b": 15, "c": 15}, None),  # 2 hospitals
        ({"a": 5}, None),  # nobody else
    ],
)
def test_support_rule(spark, counts, expected):
    result = bm.leave_one_out(peers_table(spark, counts), "h", ["c", "s"], "v").filter("h = 'a'")
    row = result.first()
    assert row.expected == expected
    assert row.peer_n == sum(n for h, n in counts.items() if h != "a")
    kept = bm.leave_one_out(
        peers_table(spark, counts), "h", ["c", "s"], "v", drop_unsupported=True
    ).filter("h = 'a'")
    assert kept.count() == (expected is not None)


def test_index_display_rule(spark):
    df = spark.createDataFrame([(30, 60, 50.0), (29, 60, 50.0), (30, 60, 0.0)], "m int, o int, e double")
    got = [r[0] for r in df.select(bm.index(F.col("m"), F.col("o"), F.col("e"), 30)).collect()]
    assert got == [1.2, None, None]


def test_row_key_is_dense_and_ordered(spark):
    ids = [f"{i * 7919 % 10007:05d}" for i in range(5000)]
    df = spark.createDataFrame([(i, f"p{i}") for i in ids], "id string, payload string").repartition(11)
    rows = row_key(df, [F.col("id")], "k").collect()
    assert {r.id: r.k for r in rows} == {i: n for n, i in enumerate(sorted(ids), 1)}
    assert all(r.payload == f"p{r.id}" for r in rows)


def test_row_key_of_nothing(spark):
    assert row_key(spark.createDataFrame([], "id string"), [F.col("id")], "k").count() == 0


def test_running_totals_with_a_group_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(40)}", i, rng.randrange(9)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, o int, x bigint").repartition(7)
    got = {(r.g, r.o): (r.position, r.cum_x) for r in running(df, ["g"], [F.col("o").desc()], ["x"]).collect()}
    expected, seen = {}, defaultdict(lambda: (0, 0))
    for g, o, x in sorted(rows, key=lambda r: -r[1]):
        n, total = seen[g]
        seen[g] = (n + 1, total + x)
        expected[g, o] = seen[g]
    assert got == expected


@pytest.mark.parametrize("method", [narrowed_median, ranked_median])
@pytest.mark.parametrize("scale", [1, 997, 10**13])
def test_medians(spark, method, scale):
    rng = random.Random(scale)
    groups = {"a": [1, 2], "b": [1, 2, 3], "c": [2, 2, 2, 9], "d": [-5], None: [4, 4]}
    groups["hot"] = [rng.randrange(-5000, 5000) for _ in range(3000)]
    groups["same"] = [7] * 500
    rows = [(g, v * scale) for g, values in groups.items() for v in values] + [("blank", None)]
    got = {r[0]: r.low + r.high for r in method(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v").collect()}
    assert got == {
        g: sum(sorted(v)[i] for i in ((len(v) - 1) // 2, len(v) // 2)) * scale for g, v in groups.items()
    }


def test_median_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(v,) for v in (9, 1, 5, 3)], "v bigint")
    assert tuple(narrowed_median(df, [], "v").first()) == (3, 5)
    assert tuple(narrowed_median(df.filter("v > 100"), [], "v").first()) == (None, None)


def test_pareto_ties(spark):
    df = spark.createDataFrame([("d", 1), ("c", 7), ("b", 7), ("a", 6), ("a", 4)], "n string, x bigint")
    got = [tuple(r) for r in pareto(df, "n", "x").orderBy("rank", "n").collect()]
    assert got == [
        ("a", 10, 1, 10, 0.4),
        ("b", 7, 2, 17, 0.68),
        ("c", 7, 2, 17, 0.68),
        ("d", 1, 4, 25, 1.0),
    ]


def test_pareto_by_partition(spark):
    rng = random.Random(5)
    rows = [(rng.choice("pq"), f"n{rng.randrange(300)}", rng.randrange(4)) for _ in range(2000)]
    got = {
        (r.p, r.n): (r.x, r["rank"], r.cumulative)
        for r in pareto(spark.createDataFrame(rows, "p string, n string, x bigint"), "n", "x", ["p"]).collect()
    }
    for p in "pq":
        sums = defaultdict(int)
        for q, n, x in rows:
            if q == p:
                sums[n] += x
        ordered = sorted(sums.items(), key=lambda e: (-e[1], e[0]))
        for n, x in ordered:
            place = 1 + sum(y > x for _, y in ordered)
            assert got[p, n] == (x, place, sum(y for _, y in ordered[:place]))


def test_selected_rate(spark):
    df = spark.range(1)
    rates = {
        None: 0.05,
        (0.1,): 0.1,
        (0.1, 0.2): 0.05,
        (): 0.05,
    }
    for chosen, expected in rates.items():
        rule = None if chosen is None else (lambda r: r.isin(list(chosen)))
        assert df.select(selected_rate(rule)).first()[0] == expected


def test_scenario(spark):
    df = spark.createDataFrame([(696468,), (None,)], "ObservedMatchedDays bigint")
    steps = [r.ScenarioBridgeValue for r in scenario_bridge(df.limit(1), F.lit(0.05)).orderBy("StepSort").collect()]
    assert steps == pytest.approx([696468, -34823.4, 661644.6])
    days = {r.ReductionPct: r.ScenarioBedDays for r in scenario_days(df.limit(1)).collect()}
    assert days[0.0] == 0 and days[0.1] == pytest.approx(69646.8) and len(days) == 8
    blank = scenario_days(df.filter("ObservedMatchedDays is null")).first()
    assert blank.ScenarioBedDays is None and blank.ScenarioRemainingDays is None


def test_systematic_sample(spark):
    for n in (10, 25, 49, 130, 1000):
        got = [r.id for r in every_kth(spark.range(n), [F.col("id")]).orderBy("id").collect()]
        assert got == list(range(n))[:: max(1, n // 25)]


def test_profiles(spark):
    rows = [("1", "a", ""), ("2", "a", ""), ("3", "a", ""), ("4", "b", "x"), ("5", "", "x")]
    df = spark.createDataFrame(rows, "id string, k string, w string")
    assert tuple(repeated_rows(df, ["id"]).first()) == (5, 3, 2)
    assert {r.field: r.blanks for r in blank_counts(df).collect()} == {"id": 0, "k": 1, "w": 3}
    assert [tuple(r) for r in group_counts(df, ["k"]).collect()] == [("a", 3), (None, 1), ("b", 1)]


def star(spark):
    fact = spark.createDataFrame([("1", "x", 5), ("1", "y", 6), ("2", "x", 7), ("9", "x", 8)], "h string, p string, v int")
    hospitals = spark.createDataFrame([("1", "Queens"), ("2", "Kings")], "h string, county string")
    payers = spark.createDataFrame([("x",), ("y",), ("p",)], "p string")
    return Star(fact, {"hospitals": (hospitals, "h"), "payers": (payers, "p")})


def test_star(spark):
    s = star(spark)
    assert sorted(r.v for r in s.select({"county": ["Queens"], "p": ["x"]}).fact.collect()) == [5]
    assert {(r.v, r.county) for r in s.label(["county", "p"]).collect()} == {
        (5, "Queens"), (6, "Queens"), (7, "Kings"), (8, None)
    }
    twice = s.dims["hospitals"][0].unionAll(spark.createDataFrame([("1", "Bronx")], "h string, county string"))
    assert [tuple(r) for r in duplicate_keys(twice, ["h"]).collect()] == [("1", 2)]
    with pytest.raises(KeyError):
        s.select({"nowhere": ["x"]})


def test_comparisons(spark):
    a = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("y", None), ("z", 2.0)], "k string, v double")
    b = spark.createDataFrame([("x", 1.0), ("y", None), ("w", 2.0)], "k string, v double")
    assert sorted((r.k, r.side) for r in differing_rows(a, b).collect()) == [("w", "right"), ("x", "left"), ("z", "left")]
    assert differing_rows(a, a).count() == 0
    compared = compare_values(a.distinct(), b, ["k"], "v", 1e-6)
    assert {r.k: r.passed for r in compared.collect()} == {"x": True, "y": True, "z": False, "w": False}


def test_empty_selection(spark):
    columns = "HospitalKey string, ExactLOS int, CostCents bigint, LOSCensored int, BenchmarkEligible int, ExpectedLOS double"
    model = spark.createDataFrame([("1", 4, 300, 0, 1, 5.0), ("2", None, 101, 1, 0, None)], columns)
    rows = {
        r.Selection: r
        for r in selection_metrics(
            model, {"all": F.lit(True), "none": F.col("HospitalKey") == "x"}, "HospitalKey"
        ).collect()
    }
    assert rows["all"].Discharges == 2 and rows["all"].MedianEstimatedCost == 2.005
    assert rows["all"].LOSIndex == 0.8 and rows["all"].BenchmarkCoverage == 0.5
    none = rows["none"].asDict()
    assert none["Discharges"] == 0 and none["Hospitals"] == 0
    assert none["EstimatedCost"] is None and none["BenchmarkCoverage"] is None and none["LOSIndex"] is None


def test_pareto_keeps_null_partitions_and_ties_null_amounts(spark):
    rows = [(None, "a", 5), (None, "b", 5), (None, "c", None), (None, "d", None), ("p", "a", 7), ("p", "b", None)]
    df = spark.createDataFrame(rows, "p string, h string, v bigint")
    got = {(r.p, r.h): (r["rank"], r.cumulative) for r in pareto(df, "h", "v", ["p"]).collect()}
    assert got == {
        (None, "a"): (1, 5), (None, "b"): (1, 5), (None, "c"): (3, 10), (None, "d"): (3, 10),
        ("p", "a"): (1, 7), ("p", "b"): (2, 7),
    }


def test_labels_refuse_a_key_with_two_rows(spark):
    fact = spark.createDataFrame([("k1", 1), ("k2", 2), ("k3", 3), (None, 4)], "k string, v int")
    dim = spark.createDataFrame([("k1", "one"), ("k2", "two")], "k string, name string")
    got = {tuple(r) for r in Star(fact, {"d": (dim, "k")}).label(["name"]).select("k", "v", "name").collect()}
    assert got == {("k1", 1, "one"), ("k2", 2, "two"), ("k3", 3, None), (None, 4, None)}
    twice = dim.unionAll(spark.createDataFrame([("k1", "uno")], dim.schema))
    with pytest.raises(Exception, match="several rows for key k1"):
        Star(fact, {"d": (twice, "k")}).label(["name"]).collect()


def test_totals_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_007
    rows = [("h1", big, 3), ("h1", big, 4), ("h2", 2**53 + 1, None)]
    model = spark.createDataFrame(rows, "h string, CostCents bigint, ExactLOS int").selectExpr(
        "*", "0 AS LOSCensored", "0 AS BenchmarkEligible", "CAST(NULL AS double) AS ExpectedLOS"
    )
    sums = {r.h: (int(r.TotalCostCents), r.ExactDays) for r in bm.entity_sums(model, ["h"]).collect()}
    assert sums == {"h1": (2 * big, 7), "h2": (2**53 + 1, None)}
    total = bm.entity_sums(model, ["h"]).agg(F.sum("TotalCostCents")).first()[0]
    assert int(total) == 2 * big + 2**53 + 1


def test_blank_severity_is_a_stratum_of_the_sensitivity_rebuild(spark):
    from peerbench.plans.clean import clean_fields
    from peerbench.plans.layout import RAW_FIELDS

    rows = []
    for i in range(640):
        row = dict.fromkeys(RAW_FIELDS, "x") | {"source_row_id": str(i), "length_of_stay": str(1 + i % 9)}
        row |= {"permanent_facility_id": f"h{i % 4}", "apr_severity_of_illness_code": "1" if i % 8 < 4 else ""}
        rows.append(tuple(row[c] for c in RAW_FIELDS))
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_FIELDS))
    records = clean_fields(raw)
    summary = records.select("HospitalKey", "HospitalName").distinct().withColumn("LOSIndex", F.lit(1.0))
    strata = ["ConditionKey", "SeverityKey", "AgeGroup"]
    rebuilt = bm.sensitivity(records, summary, "HospitalKey", strata, "ExactLOS")
    assert {r.MatchedDischarges for r in rebuilt.collect()} == {160}


def test_repeated_rows_count_copies_exactly(spark):
    rows = [(i, i % 50 if i < 400 else i, "x") for i in range(500)]
    row = repeated_rows(spark.createDataFrame(rows, "id int, a int, b string"), ["id"]).first()
    assert tuple(row) == (500, 150, 350)
