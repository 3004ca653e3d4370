"""Documents with every odd case, used by all tests of the operators."""

from __future__ import annotations

import random
import tracemalloc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Column names that the operators use themselves; a table may have them too.
CLASHING = (
    "row id hash _id _text _row _key _cell _size _source key rules found print component first kept score size"
    " copies taken target n_tokens n_words held_out lang_pred spans cutoffs place"
).split()

SYLLABLES = "an be co du er fi ge hi in ja ko la me no op pa qu re st ti un ve wo xe yo zu".split()


def prose(random_: random.Random, words: int) -> str:
    made = ["".join(random_.choices(SYLLABLES, k=random_.randint(1, 4))) for _ in range(words)]
    for i in range(9, words, 10):
        made[i] += random_.choice([".", ",", ".\n"])
    return " ".join(made)


def odd_documents() -> list[tuple]:
    """doc_id, text, lang, source, n_chars with nulls, empty and very long texts, ties and repeated rows."""
    random_ = random.Random(3)
    long = prose(random_, 40_000)
    same = prose(random_, 120)
    rows = [
        (1, prose(random_, 80), "en", "a", 5),
        (2, None, "en", "a", None),
        (3, "", "de", "b", 0),
        (4, "   \n\t \r\n", None, "b", 8),
        (5, long, "en", None, 9),
        (6, "x" * 200_000, "de", "c", 10),
        (7, same, "de", "a", 11),
        (8, same, "de", "b", 11),
        (8, same, "de", "b", 11),
        (9, "日本語 テキスト 😀 ñandú É", "es", "Z", 3),
        (10, "!!! ### $$$ 12345 | < >", None, None, None),
        (None, prose(random_, 60), None, None, 4),
        (None, None, None, None, None),
        (11, "line one two\n" * 40, "en", "a", 1),
    ]
    return rows + [(20 + i, prose(random_, 70 + i), random_.choice(["en", "de"]), "a", i) for i in range(12)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, rows: list[tuple] | None = None, clashing: bool = False) -> DataFrame:
    docs = spark.createDataFrame(odd_documents() if rows is None else rows, SCHEMA)
    if clashing:
        docs = docs.selectExpr("*", *[f"'{name}' AS `{name}`" for name in CLASHING])
    return docs


def labels(spark: SparkSession, rows: list[tuple] = ()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def results(df: DataFrame) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=lambda row: [(v is None, str(v)) for v in row])


def peak_megabytes(run: Callable) -> tuple[float, object]:
    """The most memory that a call holds at a time, and its result."""
    tracemalloc.start()
    try:
        result = run()
        return tracemalloc.get_traced_memory()[1] / 1e6, result
    finally:
        tracemalloc.stop()
