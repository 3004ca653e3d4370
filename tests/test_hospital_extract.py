"""A small hospital extract as CSV pages, through every layer, against plain Python."""

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peerbench.operators.selections import selection_metrics
from peerbench.plans import analysis, checks, extract, reports
from peerbench.plans.lake import from_extract
from peerbench.plans.layout import ENTITY, HOSPITAL, RAW_FIELDS, STAY_BANDS
from peerbench.plans.measures import MEASURES, catalogue, displayed, evaluate
from peerbench.sources.files import snapshot_state, verify_manifest
from peerbench.sources.sinks import formatted, write_csv, write_document, write_table
from peerbench.sources.tables import paged
from peerbench.sources.text import read_document, read_text_table, read_typed_table, select_as

AGES = ("18-29", "30-49", "50-69", "70 or Older")
CONDITIONS = {"139": "OTHER PNEUMONIA", "194": "HEART FAILURE", "720": "SEPTICEMIA"}


def make_rows(n=1500):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        hospital = 1464 if rng.random() < 0.34 else 1160 + rng.randrange(6)
        code = "720" if rng.random() < 0.5 else rng.choice(["139", "194"])
        severity = rng.choice("012344")
        stay = rng.choice(["120+", "0", "x", ""]) if rng.random() < 0.05 else str(1 + int(rng.expovariate(0.1)) % 119)
        rows.append(
            {
                "source_row_id": f"row-{rng.randrange(10**9):09d}-{i}",
                "health_service_area": "New York City",
                "hospital_county": "Queens" if hospital % 2 else "Kings",
                "permanent_facility_id": f" {hospital:06d} ",
                "facility_name": f'HOSPITAL "{hospital}", MAIN\t',
                "age_group": rng.choice(AGES),
                "length_of_stay": stay,
                "type_of_admission": "Emergency",
                "patient_disposition": rng.choice(["Expired", "Home", "Home", ""]),
                "discharge_year": "2024",
                "apr_drg_code": code,
                "apr_drg_description": CONDITIONS[code],
                "apr_severity_of_illness_code": severity,
                "apr_severity_of_illness": f"level {severity}",
                "apr_risk_of_mortality": "Minor",
                "payment_typology_1": rng.choice(["Medicare", "Self-Pay"]),
                "emergency_department_indicator": rng.choice("YN"),
                "total_charges": f"{rng.randrange(100, 10**7) / 100:.2f}",
                "total_costs": f"{rng.randrange(100, 10**6) / 100:.2f}",
            }
        )
    return rows


def write_page(path, rows, mark):
    import csv

    with open(path, "w", newline="", encoding="utf-8-sig" if mark else "utf-8") as f:
        writer = csv.DictWriter(f, fieldnames=RAW_FIELDS)
        writer.writeheader()
        writer.writerows(rows)


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def lake(spark, rows, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pages")
    write_page(folder / "page-0.csv", rows[:1000], mark=True)
    write_page(folder / "page-1.csv", rows[1000:], mark=False)
    return from_extract(spark, str(folder), HOSPITAL)


@pytest.fixture(scope="module")
def model(rows):
    """The model in plain Python: every peer mean from the peers themselves."""
    out = []
    for key, r in enumerate(sorted(rows, key=lambda r: r["source_row_id"]), 1):
        text = r["length_of_stay"]
        exact = int(text) if text.isdigit() and 1 <= int(text) <= 119 else None
        out.append(
            {
                "key": key,
                "id": r["source_row_id"],
                "hospital": r["permanent_facility_id"].strip(),
                "name": r["facility_name"].strip(),
                "county": r["hospital_county"],
                "condition": r["apr_drg_code"],
                "severity": int(r["apr_severity_of_illness_code"]),
                "age": r["age_group"],
                "disposition": r["patient_disposition"],
                "exact": exact,
                "capped": int(text == "120+"),
                "cost": round(float(r["total_costs"]) * 100),
            }
        )
    pools = defaultdict(list)
    for r in out:
        if r["exact"] is not None and 1 <= r["severity"] <= 4:
            pools[r["condition"], r["severity"], r["age"]].append((r["hospital"], r["exact"]))
    for r in out:
        pool = pools[r["condition"], r["severity"], r["age"]]
        own = any(h == r["hospital"] for h, _ in pool)
        peers = [(h, v) for h, v in pool if h != r["hospital"]]
        r["peers"] = len(peers) if own else None
        supported = own and len(peers) >= 30 and len({h for h, _ in peers}) >= 3
        r["expected"] = sum(v for _, v in peers) / len(peers) if supported and r["exact"] is not None else None
    return out


def test_model(lake, model):
    got = {r.DischargeKey: r for r in lake.model.collect()}
    assert len(got) == len(model)
    for r in model:
        row = got[r["key"]]
        assert (row.SourceRowId, row.HospitalKey, row.HospitalName) == (r["id"], r["hospital"], r["name"])
        assert (row.ExactLOS, row.LOSCensored, row.CostCents) == (r["exact"], r["capped"], r["cost"])
        assert (row.PeerN, row.ExpectedLOS) == (r["peers"], r["expected"])
        assert row.BenchmarkEligible == int(r["expected"] is not None)
        assert row.BedDaysLowerBound == (120 if r["capped"] else r["exact"])
    assert {r["expected"] is None for r in model if r["exact"]} == {True, False}
    # A capped stay keeps the peer count of its stratum.
    assert any(r["capped"] and r["peers"] for r in model)


def totals(rows):
    matched = [r for r in rows if r["expected"] is not None]
    return matched, sum(r["exact"] for r in matched), sum(r["expected"] for r in matched)


def test_selections_reweight_fixed_expectations(lake, model):
    rules = {
        "All cohort": lambda r: True,
        "Heart failure only": lambda r: r["condition"] == "194",
        "Other pneumonia only": lambda r: r["condition"] == "139",
        "Septicemia group only": lambda r: r["condition"] == "720",
        "Age 70 or Older": lambda r: r["age"] == "70 or Older",
        "Queens hospitals": lambda r: r["county"] == "Queens",
        "Heart failure and age 70 or Older": lambda r: r["condition"] == "194" and r["age"] == "70 or Older",
    }
    got = {r.Selection: r for r in selection_metrics(lake.model, HOSPITAL.predicates(), ENTITY).collect()}
    assert set(got) == set(rules)
    for label, rule in rules.items():
        chosen = [r for r in model if rule(r)]
        matched, observed, expected = totals(chosen)
        row = got[label]
        assert row.Discharges == len(chosen)
        assert row.Hospitals == len({r["hospital"] for r in chosen})
        assert row.MedianEstimatedCost == pytest.approx(statistics.median(r["cost"] for r in chosen) / 100)
        assert row.EstimatedCost == pytest.approx(sum(r["cost"] for r in chosen) / 100)
        assert row.MatchedDischarges == len(matched)
        if not matched:
            assert row.ObservedMatchedDays is None and row.LOSIndex is None
            continue
        assert row.ObservedMatchedDays == observed
        assert row.ExpectedMatchedDays == pytest.approx(expected)
        assert row.LOSIndex == pytest.approx(observed / expected)
        assert row.ScenarioBedDays_10pct == pytest.approx(observed * 0.1)


def test_summary_and_sensitivity(lake, model):
    summary = {r.HospitalKey: r for r in lake.summary().collect()}
    for hospital in {r["hospital"] for r in model}:
        mine = [r for r in model if r["hospital"] == hospital]
        matched, observed, expected = totals(mine)
        row = summary[hospital]
        assert (row.Discharges, row.MatchedDischarges) == (len(mine), len(matched))
        assert row.AvgExactLOS == pytest.approx(statistics.mean(r["exact"] for r in mine if r["exact"]))
        if len(matched) >= 30:
            assert row.LOSIndex == pytest.approx(observed / expected)
        else:
            assert row.LOSIndex is None

    base = [r for r in model if r["exact"] and r["exact"] <= 30 and r["disposition"] != "Expired"]
    pools = defaultdict(list)
    for r in base:
        pools[r["condition"], r["severity"], r["age"]].append(r)
    sums = defaultdict(lambda: [0, 0, 0.0])
    for r in base:
        peers = [p for p in pools[r["condition"], r["severity"], r["age"]] if p["hospital"] != r["hospital"]]
        if len(peers) >= 30 and len({p["hospital"] for p in peers}) >= 3:
            total = sums[r["hospital"]]
            total[0] += 1
            total[1] += r["exact"]
            total[2] += sum(p["exact"] for p in peers) / len(peers)
    got = {r.HospitalKey: r for r in analysis.sensitivity_index(lake).collect()}
    assert set(got) == {h for h, t in sums.items() if t[0] >= 30}
    for hospital, row in got.items():
        n, observed, expected = sums[hospital]
        assert row.MatchedDischarges == n
        assert row.SensitivityLOSIndex == pytest.approx(observed / expected)
        assert row.PrimaryLOSIndex == summary[hospital].LOSIndex


def test_medians_by_condition(lake, model):
    for ranked in (False, True):
        got = {r.ConditionDescription: r.MedianEstimatedCost for r in analysis.median_cost(lake, ranked).collect()}
        for code, name in CONDITIONS.items():
            middle = statistics.median(r["cost"] for r in model if r["condition"] == code)
            assert got[name] == int(middle + 0.5) / 100


def test_measures_in_blank_context(lake):
    names = [m for m in MEASURES if m not in ("HospitalCostRank", "CumulativeEstimatedCost", "CumulativeCostPct")]
    row = evaluate(lake.model, names, selection={"HospitalCounty": ["nowhere"]}).first().asDict()
    assert row.pop("Discharges") == 0 and row.pop("Hospitals") == 0 and row.pop("ExactLOSDischarges") == 0
    assert row.pop("SelectedReduction") == 0.05
    assert set(row.values()) == {None}


def test_measures_of_subtotals_equal_direct_groups(lake):
    names = ["Discharges", "Hospitals", "MedianLOS", "MedianEstimatedCost", "LOSIndex", "LOSVarianceDays"]
    by = ["ConditionKey", "HospitalCounty"]
    cube = evaluate(lake.model, names, by, mode="cube").collect()
    for level, keys in ((0, by), (1, by[:1]), (2, by[1:]), (3, [])):
        part = {tuple(r[k] for k in keys): r for r in cube if r.level == level}
        direct = {tuple(r[k] for k in keys): r for r in evaluate(lake.model, names, keys).collect()}
        assert set(part) == set(direct)
        for key, row in direct.items():
            assert [part[key][n] for n in names] == pytest.approx([row[n] for n in names])
    rollup = evaluate(lake.model, names, by, mode="rollup").collect()
    assert {r.level for r in rollup} == {0, 1, 3}


def test_bridge_measure_and_pareto_measures(lake):
    row = evaluate(lake.model, ["ObservedMatchedDays", "ScenarioBridgeValue"], step=F.lit("Illustrative reduction")).first()
    assert row.ScenarioBridgeValue == pytest.approx(-0.05 * row.ObservedMatchedDays)
    ranked = {r.HospitalName: r for r in reports.cost_pareto(lake.labelled).collect()}
    names = ["HospitalCostRank", "CumulativeEstimatedCost", "CumulativeCostPct"]
    for r in evaluate(lake.labelled, names, ["HospitalName"]).collect():
        assert tuple(r)[1:] == tuple(ranked[r.HospitalName][name] for name in names)
    first = evaluate(lake.labelled, names).first()
    assert first.HospitalCostRank == 1 and first.CumulativeCostPct == min(r.CumulativeCostPct for r in ranked.values())
    steps = {r.Step: r.ScenarioBridgeValue for r in reports.bridge(lake.model).collect()}
    assert steps["Scenario remaining days"] == pytest.approx(sum(steps.values()) - steps["Scenario remaining days"])


def test_catalogue_and_display(spark, lake):
    listed = {r.name: r.format for r in catalogue(spark).collect()}
    assert len(listed) == 28
    shown = displayed(evaluate(lake.model, ["Discharges", "BenchmarkCoverage", "LOSIndex"])).first()
    assert shown.Discharges == "1,500" and shown.BenchmarkCoverage.endswith("%") and shown.LOSIndex.endswith("x")


def test_all_bands_are_listed(lake):
    got = reports.discharges_by_band(lake.model.filter("LOSCensored = 1")).collect()
    assert [r.StayBand for r in got] == list(STAY_BANDS)
    assert [r.Discharges for r in got[:-1]] == [0] * 6


def test_checks_report_what_is_wrong(lake):
    found = {r.check: r for r in checks.checks(lake).collect()}
    failed = {name for name, r in found.items() if not r.passed}
    assert failed == {"stay text is valid", "exact and capped stays add up"}
    assert "discharge_year is within its domain" in found and "health_service_area is within its domain" in found


def test_contract(lake):
    rows = {r.table: r for r in checks.contract_check(lake).collect()}
    assert len(rows) == 8 and rows["Discharges"].columns == 21 and rows["Discharges"].rows == 1500
    assert all(r.missing_columns + r.extra_columns + r.undescribed + r.header_rows == 0 for r in rows.values())


def test_peer_spot_check(lake):
    rows = checks.peer_spot_check(lake).collect()
    assert 25 <= len(rows) < 50 and all(r.passed for r in rows)


def test_pages_and_round_trips(lake, model):
    pages = {r.page: r for r in extract.page_union(lake, 400).collect()}
    assert {p: r.rows for p, r in pages.items()} == {0: 400, 1: 400, 2: 400, 3: 300}
    assert pages[1].first_id == model[400]["id"] and pages[3].last_id == model[-1]["id"]
    row = extract.export_roundtrip(lake).first()
    cents = sum(r["cost"] for r in model)
    assert (row.rows, row.exported_cents, row.raw_cents, row.model_cents) == (1500, cents, cents, cents)
    assert all(r.passed for r in extract.expected_compare(lake).collect())
    page = paged(lake.raw, "source_row_id", 10).read(40)
    assert sorted(r.source_row_id for r in page.collect()) == [r["id"] for r in model[400:410]]


def test_written_texts_come_back(spark, tmp_path):
    rows = [("007", 'a "quoted", text', ""), ("010", "line\\slash", "x")]
    df = spark.createDataFrame(rows, "k string, t string, b string")
    write_csv(df, str(tmp_path / "t"))
    back = read_text_table(spark, str(tmp_path / "t"), ["k", "t", "b"])
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_typed_export(spark, tmp_path):
    schema = StructType.fromDDL("k string, n int, x double, m decimal(18,2)")
    df = spark.createDataFrame([("001", 3, 1 / 3, None), ("002", None, None, 12)], "k string, n int, x double, m int")
    df = df.withColumn("m", F.col("m").cast("decimal(18,2)"))
    text = sorted(tuple(r) for r in formatted(df).collect())
    assert text == [("001", 3, "0.3333333333", None), ("002", None, None, "12.00")]
    write_csv(formatted(df), str(tmp_path / "t"))
    back = {r.k: r for r in read_typed_table(spark, str(tmp_path / "t"), schema).collect()}
    assert back["001"].x == pytest.approx(1 / 3, abs=1e-10) and back["001"].m is None and back["002"].n is None


def test_malformed_rows_fail(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("n\nx\n")
    with pytest.raises(Exception):
        read_typed_table(spark, str(tmp_path / "bad.csv"), StructType.fromDDL("n int")).collect()


def test_documents_and_scope(spark, tmp_path):
    (tmp_path / "counts.json").write_text('[{"area": "A", "n": "5"}, {"n": "7"}]')
    got = read_document(spark, str(tmp_path / "counts.json"), "area string, n string").collect()
    assert [tuple(r) for r in got] == [("A", "5"), (None, "7")]
    write_document(spark.createDataFrame([(1, None)], "a int, b int"), str(tmp_path / "d"))
    assert any('"b":null' in part.read_text() for part in (tmp_path / "d").glob("part-*"))
    write_table(spark.range(3), str(tmp_path / "t"))
    write_table(spark.range(2), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    raw = spark.createDataFrame(
        [("New York City", "194", "0-17"), ("New York City", "194", "18-29"), (None, "194", "18-29"),
         ("New York City", "1", "18-29"), ("Other", "720", "18-29"), ("New York City", "139", None)],
        "health_service_area string, apr_drg_code string, age_group string",
    )
    kept = select_as(raw, {"age": "age_group", "code": "apr_drg_code"}, HOSPITAL.scope())
    assert [tuple(r) for r in kept.collect()] == [("18-29", "194")]


def test_manifest_states(spark, tmp_path):
    import hashlib

    root = tmp_path / "package"
    (root / "sub").mkdir(parents=True)
    contents = {"a.txt": b"one", "sub/b.txt": b"two", "c.txt": b"three", "x.txt": b"extra"}
    for name, data in contents.items():
        (root / name).write_bytes(data)
    listed = [(n, len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items() if n != "x.txt"]
    listed[1] = ("sub/b.txt", 4, listed[1][2])
    listed[2] = ("c.txt", 5, "0" * 64)
    listed.append(("gone.txt", 1, "1" * 64))
    manifest = spark.createDataFrame(listed, "path string, bytes bigint, sha256 string")
    got = {r.path: r.status for r in verify_manifest(spark, str(root), manifest).collect()}
    assert got == {"a.txt": "ok", "sub/b.txt": "size", "c.txt": "hash", "gone.txt": "missing", "x.txt": "extra"}
    before = snapshot_state(spark, str(root))
    assert snapshot_state(spark, str(root)) == before
    (root / "a.txt").write_bytes(b"longer")
    assert snapshot_state(spark, str(root)) != before


def test_build_writes_every_result(spark, lake, tmp_path):
    from peerbench.plans.build import build

    build(lake, str(tmp_path))
    written = {p.parent.name + "/" + p.name for p in tmp_path.glob("*/*")}
    assert {f"analysis/query_0{i}" for i in range(1, 7)} <= written
    assert {"analysis/hospital_summary", "analysis/summary", "qa/data_checks", "model/StayBands"} <= written
    fact = spark.read.parquet(str(tmp_path / "model" / "Discharges"))
    assert fact.count() == 1500 and len(fact.columns) == 21
    failed = read_document(spark, str(tmp_path / "qa" / "data_checks"), lines=True).filter("not passed")
    assert failed.count() == 2


def test_views(spark, lake):
    lake.views()
    got = spark.sql(
        "SELECT count(*) AS n, sum(CostCents) AS c FROM discharge_model d LEFT JOIN benchmark b"
        " USING (HospitalKey, ConditionKey, SeverityKey, AgeGroup)"
        " WHERE d.PeerN IS NOT DISTINCT FROM b.PeerN"
    ).first()
    raw = spark.sql("SELECT count(*) AS n, sum(CostCentsParsed) AS c FROM raw_discharge").first()
    assert got == raw
    assert spark.sql("SELECT sum(HospitalN) FROM hospital_stratum").first() == spark.sql(
        "SELECT sum(CohortN) FROM cohort_stratum"
    ).first()


def test_wrong_dimensions_are_reported(spark, lake, monkeypatch):
    payers = lake.dimensions["Payers"]
    header = spark.createDataFrame([("PrimaryPayer",), ("Medicare",)], payers.schema)
    monkeypatch.setitem(lake.dimensions, "Payers", payers.unionAll(header))
    hospitals = lake.dimensions["Hospitals"]
    monkeypatch.setitem(lake.dimensions, "Hospitals", hospitals.filter("HospitalKey <> '001464'"))
    shapes = {r.table: r.header_rows for r in checks.contract_check(lake).collect()}
    assert shapes["Payers"] == 1 and sum(shapes.values()) == 1
    found = {r.check: (r.passed, r.observed) for r in checks.key_checks(checks.Facts(lake)).collect()}
    assert found["Payers key is unique"] == (False, 1)
    assert found["Hospitals has no orphans"] == (False, 1)
    assert found["Hospitals key is unique"] == (True, 0)


def test_sensitivity_base_drops_unknown_dispositions(spark):
    rows = [(5, "Home"), (5, "Expired"), (5, None), (31, "Home"), (None, "Home"), (30, "")]
    df = spark.createDataFrame(rows, "ExactLOS int, Disposition string")
    kept = [tuple(r) for r in df.filter(HOSPITAL.sensitivity_base()).collect()]
    assert kept == [(5, "Home"), (30, "")]


def test_records_without_broadcast_joins(spark, lake):
    """The model is the same when every join is shuffled."""
    from peerbench.plans.clean import model_records

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = model_records(lake.clean, lake.benchmark)
        assert again.exceptAll(lake.model.select(*again.columns)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
