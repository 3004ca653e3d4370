"""Header CSV tables: every column text, blanks kept as empty text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from peerbench.session import stored


def read_text_table(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """Read one file, several files or a folder of page files as one all-text table.

    A byte-order mark is skipped, malformed rows fail the read, and blanks are ``''`` rather than NULL.
    """
    schema = StructType([StructField(c, StringType()) for c in columns])
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    reader = reader.option("enforceSchema", False).option("escape", '"')
    return reader.csv(path).na.fill("")


CORRUPT, FILE = "_corrupt", "_file"


def read_rescued(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of an all-text table that have every column, and those that have not, set aside.

    The second table has ``file``, ``reason`` (few or many fields, or an open quote) and the ``text`` of the row.  Both
    come from one written copy, so the files are read once, however damaged.
    """
    fields = [StructField(c, StringType()) for c in (*columns, CORRUPT)]
    reader = spark.read.schema(StructType(fields)).option("header", header).option("escape", '"')
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.csv(path)
    rows = stored(rows.select(*rows.columns, F.col("_metadata.file_path").alias(FILE)), "rescued")
    good = rows.where(F.col(CORRUPT).isNull()).select(*columns).na.fill("")
    unquoted = F.regexp_replace(CORRUPT, '"([^"]|"")*"', "")
    count = F.length(unquoted) - F.length(F.translate(unquoted, ",", "")) + 1
    reason = (
        F.when(F.contains(unquoted, F.lit('"')), "open quote").when(count < len(columns), "few fields").otherwise("many fields")
    )
    bad = rows.where(F.col(CORRUPT).isNotNull())
    return good, bad.select(F.col(FILE).alias("file"), reason.alias("reason"), F.col(CORRUPT).alias("text"))


def read_typed_table(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Read a header CSV with given types, text keys included; blanks are NULL."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    return reader.option("enforceSchema", False).option("escape", '"').csv(path)


def select_as(df: DataFrame, fields: dict[str, str], scope: Column | None = None) -> DataFrame:
    """Rows within ``scope``, with source columns renamed (new name -> source column)."""
    rows = df if scope is None else df.filter(scope)
    return rows.select(*[F.col(source).alias(name) for name, source in fields.items()])


def read_document(
    spark: SparkSession, path: str, schema: StructType | str | None = None, lines: bool = False
) -> DataFrame:
    """Read JSON: one document or array of objects per file, or one object per line.

    Keys that an object lacks are NULL.
    """
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema is not None else reader).json(path)
