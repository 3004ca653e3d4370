"""The whole batch run: from a raw extract to the written analysis, model and quality results.

    spark-submit --py-files peerbench.zip -m peerbench.plans.build <extract folder> <output folder>
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from peerbench.operators.selections import selection_metrics
from peerbench.plans import analysis, checks, extract
from peerbench.plans.lake import Lake, from_extract
from peerbench.plans.layout import ENTITY, HOSPITAL
from peerbench.plans.measures import catalogue
from peerbench.sources.sinks import write_csv, write_document, write_model_csv, write_table


def build(lake: Lake, out: str) -> None:
    """Write every result under ``out``: analysis/, model/ and qa/."""
    results = {
        "query_01": analysis.by_condition(lake),
        "query_02": analysis.supported_entities(lake),
        "query_03": analysis.by_severity(lake),
        "query_04": analysis.median_cost(lake),
        "query_05": analysis.by_disposition(lake),
        "query_06": analysis.sensitivity_index(lake),
        "hospital_summary": lake.summary(),
        "source_preview": extract.first_rows(lake.model).drop("DischargeKey"),
    }
    for name, table in results.items():
        write_csv(table, f"{out}/analysis/{name}")
    write_document(extract.cohort_summary(lake), f"{out}/analysis/summary")

    star = lake.star()
    write_table(star.fact, f"{out}/model/Discharges")
    for name, table in {"Discharges_csv": star.fact, **lake.dimensions}.items():
        write_model_csv(table, f"{out}/model/{name}")

    metrics = selection_metrics(lake.model, lake.domain.predicates(), ENTITY)
    write_model_csv(metrics, f"{out}/qa/expected_results")
    write_document(checks.checks(lake), f"{out}/qa/data_checks")
    write_document(checks.contract_check(lake), f"{out}/qa/model_shapes")
    write_csv(catalogue(lake.spark), f"{out}/qa/measure_catalogue")


def main() -> None:
    source, out = sys.argv[1:3]
    spark = SparkSession.builder.appName("peerbench").getOrCreate()
    build(from_extract(spark, source, HOSPITAL), out)


if __name__ == "__main__":
    main()
