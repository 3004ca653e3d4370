"""Written and re-read extracts: pages, round trips, formatted exports and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.functions.numbers import ratio
from peerbench.functions.text import half_even_cents, to_cents, to_int, trim_all
from peerbench.operators.compare import compare_values
from peerbench.operators.ordering import row_key
from peerbench.operators.selections import SELECTION_METRICS, by_selection, long_form, selection_metrics
from peerbench.plans import analysis
from peerbench.plans.clean import clean_fields, fact_table
from peerbench.plans.lake import Lake
from peerbench.plans.layout import ENTITY, RAW_FIELDS
from peerbench.plans.measures import evaluate
from peerbench.session import TASK_ROWS, drop, fresh_path, meeting_small, sized, stored, task_count, tidied
from peerbench.sources.files import file_digests, list_files, relative_to, verify_manifest
from peerbench.sources.sinks import formatted, write_csv, write_document, write_model_csv, write_table
from peerbench.sources.tables import paged
from peerbench.sources.text import read_document, read_rescued, read_text_table, read_typed_table

PAGE_ROWS = 50_000
# Rows that are shuffled at a time where whole texts are written: about 75 bytes each.
ROUND_ROWS = 1 << 26


def pages(raw: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """The raw rows in id order with their page number, 0 for the first."""
    numbered = row_key(raw, [F.col("source_row_id")], "_number")
    page = F.call_function("div", F.col("_number") - 1, F.lit(page_rows))
    return numbered.select(page.cast("string").alias("page"), *raw.columns)


def _without_copy(result: DataFrame, path: str) -> DataFrame:
    """A small result, stored, so that the full copy under ``path`` that it was made from can be deleted."""
    kept = stored(result, "copied")
    drop(result.sparkSession, path)
    return kept


def page_union(lake: Lake, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Pages written as a folder of CSV files, read back as one table, and summed per page."""
    path = fresh_path(lake.spark, "pages")
    with sized(lake.spark, lake.rows):
        write_csv(pages(lake.raw, page_rows), path, "gzip")
    back = read_text_table(lake.spark, path, ["page", *RAW_FIELDS])
    sums = back.groupBy(to_int(F.col("page")).cast("bigint").alias("page")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("source_row_id").alias("first_id"),
        F.max("source_row_id").alias("last_id"),
        F.sum(to_cents(F.col("total_costs"))).alias("CostCents"),
    )
    return _without_copy(sums, path)


def first_rows(model: DataFrame, n: int = 5) -> DataFrame:
    """The first records in key order."""
    names = [
        "HospitalName",
        "ConditionDescription",
        "Severity",
        "AgeGroup",
        "ExactLOS",
        "LOSCensored",
        "CostCents",
    ]
    return model.orderBy("DischargeKey").limit(n).select("DischargeKey", *names)


def csv_roundtrip(lake: Lake) -> DataFrame:
    """The raw extract written as CSV, read back as text and cleaned again, summed per condition."""
    path = fresh_path(lake.spark, "extract")
    write_csv(lake.raw, path, "gzip")
    again = clean_fields(trim_all(read_text_table(lake.spark, path, RAW_FIELDS)))
    sums = again.groupBy("ConditionKey").agg(
        F.count(F.lit(1)).alias("Discharges"),
        F.count("ExactLOS").alias("ExactLOSDischarges"),
        F.sum("LOSCensored").alias("CensoredStays"),
        F.sum("BedDaysLowerBound").alias("BedDaysLowerBound"),
        F.sum("CostCents").alias("CostCents"),
        F.sum("ChargesCents").alias("ChargesCents"),
    )
    return _without_copy(sums, path)


def fact_export(lake: Lake) -> DataFrame:
    """The fact as export text: money with two decimals, floating columns with ten."""
    return formatted(fact_table(lake.model))


def export_roundtrip(lake: Lake) -> DataFrame:
    """Cost in whole cents on three paths: raw extract, exported fact, stored model."""
    path = fresh_path(lake.spark, "fact")
    fact = fact_table(lake.model)
    write_model_csv(fact, path, compression="gzip")
    back = read_typed_table(lake.spark, path, fact.schema)
    exported = back.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum((F.col("EstimatedCost") * 100).cast("bigint")).alias("exported_cents"),
        F.count("ExactLOS").alias("exact_rows"),
        F.sum("BenchmarkEligible").alias("matched_rows"),
        F.min(F.length("HospitalKey")).cast("bigint").alias("key_length"),
    )
    # The source again, not the layer that was trimmed and stored from it.
    raw = lake.source.agg(F.sum(half_even_cents(F.col("total_costs"))))
    model = lake.model.agg(F.sum("CostCents"))
    # The copy is gone before the source is joined again.
    kept = _without_copy(exported, path)
    sums = kept.select("*", raw.scalar().alias("raw_cents"), model.scalar().alias("model_cents"))
    with sized(lake.spark, lake.rows), meeting_small(lake.spark):
        return stored(sums, "cents")


def expected_compare(lake: Lake, tolerance: float = 1e-6) -> DataFrame:
    """Selection metrics written with ten decimals, read back, and compared with the measure catalogue.

    The two sides share no code: one reduces the records per combination of selections, the other evaluates
    named measures over the records of each selection.
    """
    path = fresh_path(lake.spark, "expected")
    metrics = selection_metrics(lake.model, lake.domain.predicates(), ENTITY)
    write_model_csv(metrics, path)
    written = read_typed_table(lake.spark, path, metrics.schema)
    fresh = evaluated_selections(lake.model, lake.domain.predicates())
    return compare_values(
        long_form(written), long_form(fresh), ["Selection", "metric"], "value", tolerance
    )


def evaluated_selections(model: DataFrame, selections: dict[str, Column]) -> DataFrame:
    """The columns of ``selection_metrics`` from the measure catalogue; empty selections have no row."""
    same = [m for m in SELECTION_METRICS if not m.startswith(("AvgExact", "LOSIndex", "Scenario"))]
    flagged = model.withColumns({f"_in{i}": p for i, p in enumerate(selections.values())})
    rows = by_selection(flagged, {label: f"_in{i}" for i, label in enumerate(selections)})
    result = evaluate(rows, [*same, "AvgLOS", "ScenarioBedDays"], ["Selection"], rate=F.lit(0.05))
    result = result.withColumnsRenamed({"AvgLOS": "AvgExactLOS", "ScenarioBedDays": "ScenarioBedDays_5pct"})
    for name, rate in (("ScenarioBedDays_0pct", 0.0), ("ScenarioBedDays_10pct", 0.1)):
        other = evaluate(rows, ["ScenarioBedDays"], ["Selection"], rate=F.lit(rate))
        result = result.join(other.withColumnRenamed("ScenarioBedDays", name), "Selection")
    index = ratio(F.col("ObservedMatchedDays"), F.col("ExpectedMatchedDays"))
    return result.withColumn("LOSIndex", index).select("Selection", *SELECTION_METRICS)


def file_statuses(spark: SparkSession, texts: DataFrame, key: str, text: str) -> DataFrame:
    """One text file per whole-number key, digested, and verified against a manifest with known defects.

    The last digit of the key tells the defect: 2 has a wrong digest in the manifest, 3 a wrong size, 4 is not listed,
    and for 5 a second file is listed that does not exist (its key is negative).
    """
    path = fresh_path(spark, "texts")
    texts = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).repartition(task_count(spark, 0), "key")
    # Tasks put their own files in place: the copy is read only after all have ended.
    writer = texts.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("key").text(path)
    number = F.regexp_extract("path", r"key=(-?\d+)", 1).cast("bigint")
    digests = relative_to(file_digests(spark, path), path).withColumn("key", number)
    digests = stored(digests.where(F.col("key").isNotNull() & F.col("path").endswith(".txt")), "text-digests")
    digit = F.col("key") % 10
    manifest = digests.where(digit != 4).select(
        "path",
        (F.col("bytes") + F.when(digit == 3, 1).otherwise(0)).alias("bytes"),
        F.when(digit == 2, F.repeat(F.lit("0"), 64)).otherwise(F.col("sha256")).alias("sha256"),
    )
    gone = digests.where(digit == 5).select(
        F.concat(F.lit("key=-"), F.col("key").cast("string"), F.lit("/gone.txt")).alias("path"),
        F.lit(0).cast("bigint").alias("bytes"),
        F.lit("").alias("sha256"),
    )
    verified = verify_manifest(spark, path, manifest.unionByName(gone)).withColumn("key", number)
    return verified.where(F.col("path").endswith(".txt")).select("key", "actual_bytes", "actual_sha256", "status")


def lines(raw: DataFrame, names: list[str]) -> Column:
    """A row as a line of CSV text."""
    return F.to_csv(F.struct(*names), {"quoteAll": "false"})


def rescued_rows(lake: Lake) -> DataFrame:
    """A damaged extract, read with its malformed rows set aside: rows, reasons and money per year.

    The years are folders of text files.  Line 7 of the ids ends after ten fields, line 6 has one field too many and
    line 5 a quote that is not closed.
    """
    path = fresh_path(lake.spark, "damaged-pages")
    line, text = F.split("source_row_id", "-")[3], lines(lake.raw, list(RAW_FIELDS))
    damaged = (
        F.when(line == "7", F.substring_index(text, ",", 10))
        .when(line == "6", F.concat(text, F.lit(",more")))
        .when(line == "5", F.concat(F.substring_index(text, ",", 4), F.lit(',"open'), F.lit(",x")))
        .otherwise(text)
    )
    folders = lake.raw.select(F.col("discharge_year").alias("page"), damaged.alias("value"))
    # A year has as many files as tasks: none holds a whole year.
    with tidied(lake.spark):
        folders.repartition(task_count(lake.spark, lake.rows), "value").write.partitionBy("page").text(path)
    good, bad = read_rescued(lake.spark, f"{path}/*", RAW_FIELDS, header=False)
    year = F.regexp_extract("file", r"page=(\d+)", 1)
    cents = F.sum(to_cents(F.col("total_costs")))
    kept = good.groupBy(F.col("discharge_year").alias("year"), F.lit("ok").alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), cents.alias("CostCents")
    )
    aside = bad.groupBy(year.alias("year"), "reason").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("bigint").alias("CostCents")
    )
    return _without_copy(kept.unionByName(aside), path)


def marked_pages(lake: Lake) -> DataFrame:
    """Pages with a byte-order mark and a header each, read as one table and summed per condition.

    Every year has a folder of pages, more of them the more rows there are, so that no task holds a whole year.  They are
    written in rounds of some pages of every year, so that disks hold the shuffle of one round beside the pages.
    """
    path = fresh_path(lake.spark, "marked-pages")
    header = F.lit("\ufeff" + ",".join(RAW_FIELDS))
    rounds = max(1, -(-lake.rows // ROUND_ROWS))
    tasks = task_count(lake.spark, -(-lake.rows // rounds))
    folder = ["year", "page"]
    count = rounds * max(1, -(-lake.rows // (TASK_ROWS * rounds)))
    rows = lake.raw.select(
        F.col("discharge_year").alias("year"),
        F.pmod(F.xxhash64("source_row_id"), F.lit(count)).alias("page"),
        F.lit(1).alias("_place"),
        lines(lake.raw, list(RAW_FIELDS)).alias("value"),
    )
    heads = rows.select(*folder).distinct().select(*folder, F.lit(0).alias("_place"), header.alias("value"))
    marked = rows.unionByName(heads)
    for turn in range(rounds):
        # A page is in one task and so in one file.
        pages_ = marked.where(F.col("page") % rounds == turn).repartition(tasks, *folder)
        ordered = pages_.sortWithinPartitions(*folder, "_place").select(*folder, "value")
        with tidied(lake.spark):
            ordered.write.mode("append").partitionBy(*folder).text(path)
    back = read_text_table(lake.spark, f"{path}/*/*", RAW_FIELDS)
    sums = back.groupBy(F.col("apr_drg_code").alias("ConditionKey")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("source_row_id").alias("ids"),
        F.sum(to_cents(F.col("total_costs"))).alias("CostCents"),
    )
    with sized(lake.spark, lake.rows):
        return _without_copy(sums, path)


def profile_documents(lake: Lake) -> DataFrame:
    """Counts per condition and area written as JSON arrays with text counts and a missing key, read back as a table."""
    path = fresh_path(lake.spark, "profiles")
    counts = lake.raw.groupBy("apr_drg_code", "health_service_area").agg(F.count(F.lit(1)).alias("n"))
    # The area of the economy condition is left out of its objects.
    area = F.when(F.col("apr_drg_code") != "ECONOMY", F.col("health_service_area"))
    objects = counts.select("apr_drg_code", F.struct("apr_drg_code", area.alias("area"), F.col("n").cast("string").alias("discharges")).alias("o"))
    arrays = objects.groupBy("apr_drg_code").agg(F.to_json(F.collect_list("o")).alias("value"))
    # One array per file: at most one object per area in each.
    with tidied(lake.spark):
        arrays.repartition("apr_drg_code").write.partitionBy("apr_drg_code").text(path)
    schema = "apr_drg_code string, area string, discharges string"
    back = read_document(lake.spark, f"{path}/*/*", schema)
    found = back.groupBy("apr_drg_code").agg(
        F.count(F.lit(1)).alias("objects"), F.count("area").alias("with_area"), F.sum(F.col("discharges").cast("bigint")).alias("discharges")
    )
    return _without_copy(found, path)


def result_files(lake: Lake) -> DataFrame:
    """Query results and the hospital summary as written by the whole run, read back from their files."""
    path = fresh_path(lake.spark, "results")
    results = {
        "query_01": analysis.by_condition(lake),
        "query_03": analysis.by_severity(lake),
        "query_05": analysis.by_disposition(lake),
        "hospital_summary": lake.summary(),
    }
    parts = []
    for name, table in results.items():
        write_csv(table, f"{path}/{name}")
        back = read_typed_table(lake.spark, f"{path}/{name}", table.schema)
        parts.append(
            back.agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum("Discharges").alias("discharges"),
                F.round(F.sum(F.round("AvgExactLOS", 6)), 4).alias("mean_stays"),
            ).select(F.lit(name).alias("file"), F.lit(len(table.columns)).cast("bigint").alias("columns"), "rows", "discharges", "mean_stays")
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return _without_copy(found, path)


def replaced_table(lake: Lake) -> DataFrame:
    """A raw table replaced by a later extract: what is read afterwards is the later one only."""
    path = fresh_path(lake.spark, "replaced")
    write_table(lake.raw.where("type_of_admission = 'F'"), path)
    write_table(lake.raw.where("type_of_admission = 'O'"), path)
    found = lake.spark.read.parquet(path).groupBy("type_of_admission", "discharge_year").agg(F.count(F.lit(1)).alias("rows"))
    return _without_copy(found, path)


def read_pages(lake: Lake, page_rows: int = PAGE_ROWS // 10) -> DataFrame:
    """First, second and last page of the raw rows in id order, each read by its stored key range."""
    pages_ = paged(lake.raw, "source_row_id", page_rows)
    last = pages_.ranges.agg(F.max("page")).first()[0]
    parts = []
    for page in sorted({0, min(1, last), last}):
        parts.append(
            pages_.read(page).agg(
                F.lit(page).cast("bigint").alias("page"),
                F.count(F.lit(1)).alias("rows"),
                F.min("source_row_id").alias("first_id"),
                F.max("source_row_id").alias("last_id"),
                F.sum(to_cents(F.col("total_costs"))).alias("CostCents"),
            )
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def snapshot_manifest(lake: Lake, path: str) -> DataFrame:
    """path, bytes, sha256 of the files of an extract, its total rows and the time of reading."""
    files = relative_to(file_digests(lake.spark, path), path)
    rows = lake.raw.agg(F.count(F.lit(1))).scalar()
    return files.select("*", rows.alias("row_count"), F.current_timestamp().alias("retrieved_at"))


def manifest_check(lake: Lake, root: str) -> DataFrame:
    """Digest every file under ``root``, keep the manifest as a CSV table, and verify the files against it."""
    path = fresh_path(lake.spark, "manifest")
    before = stored(list_files(lake.spark, root), "listing")
    write_csv(snapshot_manifest(lake, root), path)
    columns = ["path", "bytes", "sha256", "row_count", "retrieved_at"]
    manifest = read_text_table(lake.spark, path, columns)
    after = relative_to(list_files(lake.spark, root), root)
    unchanged = relative_to(before, root).join(after, ["path", "bytes", "modified"], "left_semi")
    verified = verify_manifest(lake.spark, root, manifest)
    same = unchanged.select("path", F.lit(True).alias("unchanged"))
    return verified.join(same, "path", "left").select(
        "path",
        "expected_bytes",
        "actual_bytes",
        "status",
        F.coalesce("unchanged", F.lit(False)).alias("unchanged"),
    )


def cohort_document(lake: Lake) -> DataFrame:
    """The cohort summary written as a JSON document and read back."""
    path = fresh_path(lake.spark, "summary")
    summary = cohort_summary(lake)
    write_document(summary, path)
    return read_document(lake.spark, path, summary.schema)


def cohort_summary(lake: Lake) -> DataFrame:
    """Fourteen statistics of the whole cohort in one row."""
    names = {
        "discharges": "Discharges",
        "hospitals": "Hospitals",
        "avg_exact_los": "AvgLOS",
        "median_exact_los": "MedianLOS",
        "estimated_cost": "EstimatedCost",
        "avg_estimated_cost": "AvgEstimatedCost",
        "median_estimated_cost": "MedianEstimatedCost",
        "censored_los_count": "CensoredStays",
        "benchmark_eligible": "MatchedDischarges",
        "benchmark_coverage": "BenchmarkCoverage",
        "matched_observed_days": "ObservedMatchedDays",
        "matched_expected_days": "ExpectedMatchedDays",
        "los_index": "LOSIndex",
        "five_percent_scenario_bed_days": "ScenarioBedDays",
    }
    result = evaluate(lake.model, list(names.values()), rate=F.lit(0.05))
    return result.select(*[F.col(measure).alias(name) for name, measure in names.items()])
