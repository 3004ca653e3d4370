"""The supply-chain tables as a raw all-text extract of stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")


def table_paths(sf_dir: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in TABLES]


def raw_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the 19 text fields of a raw extract.

    Orders meet their customers before the line items do, so the line items are not shuffled by customer, and parts,
    which add the least, meet them first.  Dates are shuffled as days.
    Which joins broadcast is left to the sizes on disk, and how many tasks read the tables to the session's
    split sizes.
    """
    line, orders, customer, part, supplier, nation, region = (
        spark.read.parquet(path) for path in table_paths(sf_dir)
    )
    customers = customer.select("c_custkey", "c_mktsegment")
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", F.to_date("o_orderdate").alias("_ordered"), "o_orderstatus", "o_orderpriority", "c_mktsegment"
    )
    parts = part.select("p_partkey", "p_type", "p_brand")
    lines = line.withColumn("_shipped", F.to_date("l_shipdate")).drop("l_shipdate")
    # Nations and regions meet the suppliers, so the line items meet one small table for all three.
    placed_suppliers = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", "n_name", "r_name")
    )
    rows = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(placed_suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    days = F.abs(F.date_diff("_shipped", "_ordered")) % 130
    costs = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    charges = F.round(F.col("l_extendedprice") * (F.col("l_tax") + 1) * 100).cast("bigint")
    return rows.select(
        F.concat_ws(
            "-",
            _padded("l_orderkey", 9),
            _padded("l_partkey", 9),
            _padded("l_suppkey", 6),
            F.col("l_linenumber").cast("string"),
            F.col("l_quantity").cast("bigint").cast("string"),
        ).alias("source_row_id"),
        F.col("n_name").alias("health_service_area"),
        F.col("r_name").alias("hospital_county"),
        _padded("s_suppkey", 6).alias("permanent_facility_id"),
        F.col("s_name").alias("facility_name"),
        F.col("c_mktsegment").alias("age_group"),
        F.when(days >= 120, "120+").otherwise(days.cast("string")).alias("length_of_stay"),
        F.col("l_linestatus").alias("type_of_admission"),
        F.col("o_orderstatus").alias("patient_disposition"),
        F.year("_shipped").cast("string").alias("discharge_year"),
        F.col("p_type").alias("apr_drg_code"),
        F.lower("p_type").alias("apr_drg_description"),
        F.substring("o_orderpriority", 1, 1).alias("apr_severity_of_illness_code"),
        F.expr("substring(o_orderpriority, 3)").alias("apr_severity_of_illness"),
        F.col("p_brand").alias("apr_risk_of_mortality"),
        F.col("l_returnflag").alias("payment_typology_1"),
        F.when(F.col("l_linenumber") == 1, "Y").otherwise("N").alias("emergency_department_indicator"),
        _money_text(charges).alias("total_charges"),
        _money_text(costs).alias("total_costs"),
    )


def _padded(key: str, width: int) -> Column:
    """Key with leading zeros up to ``width`` digits; longer keys keep all their digits."""
    text = F.col(key).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _money_text(cents: Column) -> Column:
    return F.concat(
        F.call_function("div", cents, F.lit(100)).cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
