"""Result sinks.  Every writer leaves a folder of part files, so no result passes through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import fixed
from peerbench.session import tidied


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Header CSV; quotes inside values are doubled.  Copies that are read back and deleted are best compressed."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    with tidied(df.sparkSession):
        writer.csv(path, compression=compression)


def write_model_csv(df: DataFrame, path: str, decimals: int = 10, compression: str = "none") -> None:
    """Header CSV with floating columns at a fixed number of decimals and money at two."""
    write_csv(formatted(df, decimals), path, compression)


def formatted(df: DataFrame, decimals: int = 10) -> DataFrame:
    """Floating columns as text with ``decimals`` decimals, decimal columns with two."""
    out = []
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            out.append(fixed(F.col(name), decimals).alias(name))
        elif kind.startswith("decimal"):
            out.append(F.col(name).cast("decimal(38,2)").cast("string").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def write_document(df: DataFrame, path: str) -> None:
    """JSON document; blanks are written as null."""
    with tidied(df.sparkSession):
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace a stored table."""
    with tidied(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
