"""Rows that are short while a shuffle moves them.

A shuffle of wide rows moves a slot and a padded text for every column.  ``pack`` puts the columns that the shuffle
does not look at into one text, which is a little over half as long once compressed, and ``unpack`` gives every
value back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types whose text is exact; other columns stay beside the packed text.
EXACT = ("string", "int", "bigint")
_BETWEEN, _NULL = "\x01", "\x02"


def packed_columns(df: DataFrame, kept: Sequence[str]) -> list[str]:
    """The columns that ``pack`` puts into one text."""
    return [name for name, kind in df.dtypes if name not in kept and kind in EXACT]


def pack(df: DataFrame, kept: Sequence[str]) -> DataFrame:
    """``df`` with ``_packed`` in place of all columns but ``kept`` and those whose text is not exact.

    A row with a control character that the text uses, or with broken text, has its texts in ``_plain`` instead.
    """
    names = packed_columns(df, kept)
    texts = [F.col(name).cast("string") for name in names]
    # A blank between the texts, so that broken ones are not made whole.
    whole = F.concat_ws(" ", *texts)
    fits = F.is_valid_utf8(whole) & ~whole.contains(F.lit(_BETWEEN)) & ~whole.contains(F.lit(_NULL))
    return df.select(
        *[c for c in df.columns if c not in names],
        F.when(fits, F.concat_ws(_BETWEEN, *[F.coalesce(text, F.lit(_NULL)) for text in texts])).alias("_packed"),
        F.when(~fits, F.array(*texts)).alias("_plain"),
    )


def unpack(df: DataFrame, like: DataFrame, kept: Sequence[str]) -> DataFrame:
    """The rows of ``df``, made by ``pack`` from ``like``: all its other columns, then those that were packed."""
    names, kinds = packed_columns(like, kept), dict(like.dtypes)
    others = [c for c in df.columns if c not in ("_packed", "_plain")]
    # The function per element also keeps the splitting out of the code generated for what follows, which stays small
    # enough to be compiled.
    split = F.transform(F.split("_packed", _BETWEEN, -1), lambda text: F.nullif(text, F.lit(_NULL)))
    parts = df.select(*others, F.coalesce(split, "_plain").alias("_values"))
    return parts.select(
        *others, *[F.col("_values")[place].cast(kinds[name]).alias(name) for place, name in enumerate(names)]
    )
