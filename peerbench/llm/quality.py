"""Quality rules with risk-controlled thresholds.

Every text is measured once.  Fixed base rules reject the hopeless ones; the other rules each reject texts whose
score exceeds a cutoff, and the cutoffs are chosen per stratum from labelled documents.  One sequence of settings
of all rules, fixed beforehand, goes from no rule to all rules at their tightest cutoff, one rule tightened by one
cutoff at a time.  Each setting is tested with the exact binomial distribution for its rules together rejecting more
than their share of good documents, and the first that cannot be certified ends the sequence.  Testing in a fixed
order needs no correction over rules and cutoffs; over strata the error is divided (Bonferroni).  Of the certified
settings the one that rejects most bad documents is used, the loosest of equals.  Then every rule is loosened as
long as it rejects as many of the bad documents left by the rules before it, which rejects no further good ones; a
rule that adds none stays off.  So with confidence ``1 - error`` at most ``risk`` of the good documents of any
stratum are lost to these rules.  ``needed_good`` says how many good labels that takes.

Null texts count as empty and fail the base rules.  A null stratum is a stratum.  A stratum without enough
labels has no cutoffs and keeps what passes the base rules.  Documents labelled both ways are not used.  A text counts
once per stratum, however many documents hold it, since copies are no independent trials; near copies are not told
apart from others.  Rules, cutoffs and their order were fixed without the labels that they are tested on.
Repeated rows are measured each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import output, text_slices, utf8
from peerbench.session import stored

# Characters that separate words, symbols, and bytes that continue a code point in UTF-8.
SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"!?"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks"
)
MIN_WORDS = 50
# Score of each rule (per measure), and its cutoffs from the loosest to the tightest.
RULES = {
    "symbols": ("n_symbols", "n_words", (2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "capitals": ("n_capitals", "word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "marks": ("n_marks", "n_words", (2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "duplicate_lines": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeated_words": ("n_repeat_words", "n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "long_words": ("word_chars", "n_words", (40.0, 30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
}
RISK = 0.05
ERROR = 0.05


def count_repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    order = np.argsort(windows)
    ranked = windows[order]
    again = ranked[1:] == ranked[:-1]
    repeated = np.zeros(len(windows), dtype=bool)
    repeated[order[1:][again]] = True
    repeated[order[:-1][again]] = True
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= repeated
    return int(covered.sum())


def measure_text(raw: bytes) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(raw.translate(None, SPACES + CONTINUATION)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        count_repeat_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, CAPITALS)),
        len(raw) - len(raw.translate(None, MARKS)),
    )


def measure(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """``_id``, ``_text`` (hash of the text), ``_stratum``, the measures and ``base_failed`` of every row."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = zip(*map(measure_text, batch.column("text").to_pylist()))
            columns = {name: pa.array(x, pa.int64()) for name, x in zip(MEASURES, found)}
            yield output(batch, ["_id", "_text", "_stratum"], **columns)

    source = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.col(text_col)).alias("_text"),
        F.col(stratum_col).cast("string").alias("_stratum"),
        utf8(F.col(text_col)).alias("text"),
    )
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _text bigint, _stratum string, " + ", ".join(f"{m} bigint" for m in MEASURES)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return source.mapInArrow(take, schema).withColumn("base_failed", failed)


def score(rule: str):
    amount, base, _ = RULES[rule]
    return F.col(amount) / F.greatest(F.col(base), F.lit(1))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exact; 1 where k is at or above the mean."""
    if k >= n * p:
        return 1.0
    total = term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < total * 1e-17:
            break
    return total


def choose_cutoff(
    good: int, lost: list[int], caught: list[int], cutoffs: tuple[float, ...], risk: float, error: float
) -> float | None:
    """The certified cutoff (or setting) that catches most; ``lost`` and ``caught`` go with ``cutoffs``, loosest first."""
    best, most = None, 0
    for cutoff, rejected, hits in zip(cutoffs, lost, caught):
        if not good or binomial_tail(rejected, good, risk) > error:
            break
        if hits > most:
            best, most = cutoff, hits
    return best


def settings() -> list[tuple[int, ...]]:
    """The sequence of settings: how many of its cutoffs each rule has gone through, 0 for off."""
    levels, sequence = [0] * len(RULES), []
    for turn in range(max(len(cutoffs) for _, _, cutoffs in RULES.values())):
        for place, (_, _, cutoffs) in enumerate(RULES.values()):
            if turn < len(cutoffs):
                levels[place] = turn + 1
                sequence.append(tuple(levels))
    return sequence


def needed_good(strata: int, risk: float = RISK, error: float = ERROR) -> int:
    """Good labelled texts that a stratum needs for any cutoff, if none of them is lost."""
    return math.ceil(math.log(error / strata) / math.log1p(-risk))


def fit_cutoffs(
    measured: DataFrame, labels: DataFrame, label_id: str = "doc_id", label: str = "quality",
    risk: float = RISK, error: float = ERROR,
) -> DataFrame:
    """One row per stratum with labelled documents: ``_s``, ``cutoffs`` (in the order of ``RULES``, null: off).

    Counts cover the texts of all labelled documents that pass the base rules; a text labelled both ways is not used.
    """
    agreed = (
        labels.groupBy(F.col(label_id).alias("_label_id"))
        .agg(F.min(label).alias("low"), F.max(label).alias("good"))
        .where("low = good")
    )
    known = measured.where("not base_failed").join(agreed, F.col("_id") == F.col("_label_id"))
    # How many of its cutoffs a score exceeds, for each rule; at most 9 ** 6 combinations in a stratum.
    levels = F.array(
        *[
            sum((F.when(score(rule) > cutoff, 1).otherwise(0) for cutoff in cutoffs), F.lit(0))
            for rule, (_, _, cutoffs) in RULES.items()
        ]
    )
    texts = known.groupBy(F.col("_stratum").alias("_s"), "_text", levels.alias("levels")).agg(
        F.min("good").alias("low"), F.max("good").alias("good")
    )
    combined = stored(
        texts.where("low = good").groupBy("_s", (F.col("good") == 1).alias("good"), "levels").agg(
            F.count(F.lit(1)).alias("n")
        ),
        "quality-levels",
    )
    strata = max(combined.select("_s").distinct().count(), 1)
    sequence = settings()

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        level = np.array(frame["levels"].tolist())
        count, good = frame["n"].to_numpy(), frame["good"].to_numpy(dtype=bool)
        sizes = np.array([len(cutoffs) for _, _, cutoffs in RULES.values()])
        # A rule through k of its cutoffs rejects what exceeds the k-th, that is len - k + 1 cutoffs or more.
        hit = [((level > sizes - np.array(x)) & (np.array(x) > 0)).any(axis=1) for x in sequence]
        lost, caught = ([int(count[own & x].sum()) for x in hit] for own in (good, ~good))
        best = choose_cutoff(int(count[good].sum()), lost, caught, tuple(range(len(sequence))), risk, error / strata)
        left, chosen = ~good, []
        for place, (_, _, cutoffs) in enumerate(RULES.values()):
            tightest = 0 if best is None else sequence[best][place]
            over = [level[:, place] >= len(cutoffs) - i for i in range(tightest)]
            caught_here = [int(count[left & x].sum()) for x in over]
            most = max(caught_here, default=0)
            at = caught_here.index(most) if most else None
            chosen.append(None if at is None else cutoffs[at])
            if at is not None:
                left &= ~over[at]
        return pd.DataFrame({"_s": frame["_s"].iloc[:1], "cutoffs": [chosen]})

    return stored(combined.groupBy("_s").applyInPandas(choose, "_s string, cutoffs array<double>"), "quality-cutoffs")


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    stratum_col: str = "lang", risk: float = RISK, error: float = ERROR,
) -> DataFrame:
    """``_id``, ``_text``, the measures, ``base_failed`` and ``kept`` of every row."""
    measured = stored(measure(docs, id_col, text_col, stratum_col), "quality-measures")
    cutoffs = fit_cutoffs(measured, labels, risk=risk, error=error)
    rejected = F.lit(False)
    for place, rule in enumerate(RULES):
        rejected = rejected | F.coalesce(score(rule) > F.col("cutoffs")[place], F.lit(False))
    judged = measured.join(cutoffs, F.col("_stratum").eqNullSafe(F.col("_s")), "left")
    return judged.select("_id", "_text", *MEASURES, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    stratum_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    judged = judge(docs, labels, id_col, text_col, stratum_col)
    rejected = stored(judged.where("not kept").select("_id", "_text").distinct(), "quality-rejected")
    whole = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash")
    )
    same = F.col("id").eqNullSafe(rejected["_id"]) & (F.col("hash") == rejected["_text"])
    # What is rejected grows with the documents, so it is never broadcast: one plan at every size.
    return whole.join(rejected.hint("merge"), same, "left_anti").select("row.*")
