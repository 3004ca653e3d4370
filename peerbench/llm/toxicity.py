"""Toxicity classifier regularised by counterfactuals.

A text is the set of its words and of their first letters (prefixes).  The classifier is a logistic regression over
the features whose frequency in labelled toxic and clean texts differs by ``SIGNIFICANT`` standard errors or more,
on either side; how many there are follows the data.

Names of groups must not raise a score.  Every labelled text is therefore also read with names of groups: where it
mentions one, the name is swapped for every other of its line; and the names of one line, chosen by a hash of the
text, are put into it in turn.  The squared change of the log-odds is penalised for every reading, so a neutral
mention counts for nothing and a name for as much as the others.  Lines are in English, German, French and Spanish;
which one a text is read with does not depend on its language.

The model is fitted on a bounded sample of labelled rows: at most ``SAMPLE`` texts, chosen by a hash of the id.  What
reaches the driver is their significant features and the distinct changes with their counts.  Texts labelled both ways
are not used.  Without labels of both kinds, or without a significant feature, every score is the share of toxic
labels (0 without labels).  Null and empty texts are scored as texts without words.  Repeated rows are scored each; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import kept_in, output, remainder, text_slices, texts_of, utf8, worker_store
from peerbench.session import stored

SAMPLE = 20_000
SIGNIFICANT = 5.0
PREFIXES = (3, 4, 5, 6)
RIDGE = 0.2
COUNTERFACTUAL = 4.0
THRESHOLD = 0.3
WORD = r"[^\W\d_]+"
# Words kept by a worker; beyond this the store is emptied and filled anew.
KEPT_WORDS = 300_000

# Names of groups; within a line each is swapped for every other.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("woman", "man"),
    ("women", "men"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("old", "young"),
    ("blind", "deaf", "disabled"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwul", "heterosexuell", "lesbisch", "bisexuell", "transgeschlechtlich"),
    ("frauen", "männer"),
    ("mädchen", "jungen"),
    ("einwanderer", "flüchtlinge", "einheimische", "ausländer"),
    ("afrikanisch", "europäisch", "amerikanisch", "türkisch", "chinesisch", "indisch"),
    ("blinde", "gehörlose", "behinderte"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("homosexuel", "hétérosexuel", "lesbienne", "bisexuel", "transgenre"),
    ("femmes", "hommes"),
    ("filles", "garçons"),
    ("immigrés", "réfugiés", "natifs", "étrangers"),
    ("africain", "européen", "américain", "mexicain", "chinois", "indien"),
    ("aveugles", "sourds", "handicapés"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("homosexual", "heterosexual", "lesbiana", "bisexual", "transgénero"),
    ("mujeres", "hombres"),
    ("niñas", "niños"),
    ("inmigrantes", "refugiados", "nativos", "extranjeros"),
    ("africano", "europeo", "americano", "mexicano", "chino", "indio"),
    ("ciegos", "sordos", "discapacitados"),
)


def lines_of() -> dict[str, list[tuple[str, ...]]]:
    """The lines that a name stands in."""
    found: dict[str, list[tuple[str, ...]]] = {}
    for line in IDENTITY:
        for name in line:
            found.setdefault(name, []).append(line)
    return found


def readings(words: set[str], text: str, lines: dict[str, list[tuple[str, ...]]]) -> list[list[set[str]]]:
    """Groups of readings of a text, as sets of words: its own names swapped for every other of their line, and one
    line's names put in."""
    found = []
    for name in sorted(words & lines.keys()):
        for line in lines[name]:
            others = [(words - {name}) | {other} for other in line if other != name]
            found.append(others)
    put_in = IDENTITY[xxhash.xxh64_intdigest(text, 1) % len(IDENTITY)]
    found.append([words | {name} for name in put_in])
    return found


def features_of(word: str) -> list[int]:
    """Hashes of a word and of its prefixes."""
    shapes = [word + "$", *[word[:n] for n in PREFIXES if len(word) >= n]]
    return [xxhash.xxh64_intdigest(shape, 0) >> 1 for shape in shapes]


class Reader:
    """Words of texts, and which of the wanted features a text has."""

    def __init__(self, wanted: np.ndarray | None = None) -> None:
        self.number = None if wanted is None else {int(h): i for i, h in enumerate(wanted)}
        self.known: dict[str, tuple[int, ...]] = {}
        self.word = re.compile(WORD)

    def words(self, text: str) -> set[str]:
        return set(self.word.findall(text.lower()))

    def features(self, words: set[str]) -> set[int]:
        """Feature hashes, or the places of those wanted."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known, found = self.known, set()
        for word in words:
            own = known.get(word)
            if own is None:
                own = tuple(features_of(word))
                if self.number is not None:
                    own = tuple(self.number[h] for h in own if h in self.number)
                known[word] = own
            if own:
                found.update(own)
        return found


class Model(NamedTuple):
    hashes: np.ndarray
    weights: np.ndarray
    bias: float


def sample_labelled(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, folds: int, held: int, sample: int
) -> DataFrame:
    """``text`` and ``toxic`` of at most ``sample`` labelled documents that are not held out."""
    agreed = (
        labels.where(remainder(F.col("doc_id"), folds) != held)
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("low"), F.max("toxic").alias("toxic"))
        .where("low = toxic and toxic in (0, 1)")
        .select(F.col("doc_id").alias("_label_id"), "toxic")
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(sample)
    )
    rows = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("text"))
    return rows.join(stored(agreed, "toxicity-labels"), F.col("_id") == F.col("_label_id")).select("text", "toxic")


def significant(known: DataFrame, sizes: tuple[int, int], least: float) -> DataFrame:
    """``hash`` of every feature that ``least`` standard errors or more lie between its shares in both kinds of texts.

    ``known`` has ``text`` and ``toxic``, ``sizes`` says how many texts there are of kind 0 and 1.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in text_slices(batches):
            kinds = batch.column("toxic").to_pylist()
            found = [reader.features(reader.words(text)) for text in texts_of(batch)]
            flat = np.fromiter((h for f in found for h in f), np.int64)
            toxic = np.repeat(np.array(kinds, dtype=np.int64), [len(f) for f in found])
            hashes, place = np.unique(flat, return_inverse=True)
            of_toxic = np.bincount(place, toxic, len(hashes)).astype(np.int64)
            of_clean = np.bincount(place, minlength=len(hashes)) - of_toxic
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(of_clean), pa.array(of_toxic)], ["hash", "n0", "n1"])

    counts = known.mapInArrow(count, "hash bigint, n0 bigint, n1 bigint").groupBy("hash").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")
    )
    clean, toxic = sizes
    rate = (F.col("n0") + F.col("n1")) / (clean + toxic)
    spread = F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * (1 / clean + 1 / toxic))
    strength = F.abs(F.col("n1") / toxic - F.col("n0") / clean) / spread
    return counts.where((F.col("n0") + F.col("n1") > 1) & (strength >= least)).select("hash")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4,
    held: int = 2, sample: int = SAMPLE, counterfactual: float = COUNTERFACTUAL,
) -> Model:
    """The model; what reaches the driver is the significant features of the sample and the distinct changes."""
    store = worker_store(docs.sparkSession)
    known = stored(sample_labelled(docs, labels, id_col, text_col, folds, held, sample), "toxicity-sample")
    clean, toxic = known.agg(F.count(F.when(F.col("toxic") == 0, 1)), F.count(F.when(F.col("toxic") == 1, 1))).first()
    if not (clean and toxic):
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), float(toxic > 0))
    hashes = [row["hash"] for row in significant(known, (clean, toxic), SIGNIFICANT).collect()]
    wanted = np.array(sorted(hashes), dtype=np.int64)
    if not len(wanted):
        return Model(wanted, np.zeros(0), toxic / (clean + toxic))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, lines = kept_in(store, lambda: Reader(wanted)), lines_of()
        for batch in text_slices(batches):
            packed, changes, shares = [], [], []
            for text in texts_of(batch):
                words = reader.words(text)
                own = reader.features(words)
                packed.append(np.array(sorted(own), dtype=np.int32).tobytes())
                for group in readings(words, text, lines):
                    for other in map(reader.features, group):
                        # Features that come are positive, those that go negative; numbers start at 1.
                        change = sorted([i + 1 for i in other - own] + [-i - 1 for i in own - other])
                        if change:
                            changes.append(np.array(change, dtype=np.int32).tobytes())
                            shares.append(1 / len(group))
            rows = [packed + changes, batch.column("toxic").to_pylist() + [None] * len(changes), [1.0] * len(packed) + shares]
            kinds = (pa.binary(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], ["packed", "toxic", "share"])

    rows = known.select("text", F.col("toxic").cast("bigint").alias("toxic")).mapInArrow(
        pack, "packed binary, toxic bigint, share double"
    )
    # Equal texts and equal changes are one row each.
    rows = rows.groupBy("packed", "toxic").agg(F.count(F.lit(1)).alias("n"), F.first("share").alias("share"))
    return train(rows.collect(), wanted, counterfactual)


class Rows(NamedTuple):
    """Sparse rows: place of the row, feature and value of every entry, and a weight per row."""

    row: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    weight: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.feature], len(self.weight))

    def back(self, amounts: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.feature, self.value * amounts[self.row], width)


def _sparse(packed: list[bytes], weights: list[float]) -> Rows:
    entries = [np.frombuffer(p, dtype=np.int32) for p in packed]
    row = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *entries]).astype(np.int64)
    return Rows(row, flat, np.ones(len(flat)), np.array(weights, dtype=np.float64))


def train(rows: list, wanted: np.ndarray, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fit the penalised regression with Newton's method; each step is solved by conjugate gradients.

    A row has ``packed`` features, ``n`` (how often it occurs) and ``toxic``, or without ``toxic`` it is a change,
    with ``share``.  Memory grows with the entries of the rows, not with the square of the features.
    """
    rows = sorted(rows, key=lambda r: (r["packed"], -1 if r["toxic"] is None else r["toxic"]))
    texts, moves = [r for r in rows if r["toxic"] is not None], [r for r in rows if r["toxic"] is None]
    labels = np.array([r["toxic"] for r in texts], dtype=np.float64)
    x = _sparse([r["packed"] for r in texts], [r["n"] for r in texts])
    total = x.weight.sum()
    share = float((labels * x.weight).sum() / total) if total else 0.0
    if share in (0.0, 1.0) or not len(wanted):
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), share)
    change = _sparse([r["packed"] for r in moves], [2 * counterfactual * r["n"] * r["share"] for r in moves])
    change = change._replace(value=np.sign(change.feature).astype(np.float64), feature=np.abs(change.feature) - 1)
    width = len(wanted)

    def penalty(v: np.ndarray) -> np.ndarray:
        return RIDGE * v + change.back(change.weight * change.times(v), width)

    weights, bias = np.zeros(width), float(np.log(share / (1 - share)))
    for _ in range(40):
        odds = 1 / (1 + np.exp(-np.clip(x.times(weights) + bias, -30, 30)))
        rest = x.weight * (odds - labels)
        bend = x.weight * np.maximum(odds * (1 - odds), 1e-6)
        gradient = np.append(x.back(rest, width) + penalty(weights), rest.sum())

        def curvature(v: np.ndarray) -> np.ndarray:
            inner = bend * (x.times(v[:-1]) + v[-1])
            return np.append(x.back(inner, width) + penalty(v[:-1]), inner.sum() + 1e-9 * v[-1])

        step = _solve(curvature, gradient)
        scale = min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        weights, bias = weights - scale * step[:-1], bias - scale * step[-1]
        if np.abs(step).max() < 1e-6:
            break
    return Model(wanted, weights, bias)


def _solve(product, right: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Conjugate gradients for a symmetric positive definite operator."""
    found, rest = np.zeros_like(right), right.copy()
    way, size = rest.copy(), rest @ rest
    target = 1e-20 * size
    for _ in range(rounds):
        if size <= target or not size:
            break
        along = product(way)
        length = size / (way @ along)
        found += length * way
        rest -= length * along
        size, before = rest @ rest, size
        way = rest + (size / before) * way
    return found


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``score`` (0 to 1) of every row."""
    store = worker_store(docs.sparkSession)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = kept_in(store, lambda: Reader(model.hashes))
        weights = model.weights
        constant = len(weights) == 0
        for batch in text_slices(batches):
            found = []
            for text in texts_of(batch):
                # Sorted, so that the sum is the same wherever it is taken.
                own = sorted(reader.features(reader.words(text)))
                odds = model.bias + float(weights[own].sum()) if own else model.bias
                found.append(model.bias if constant else 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
            yield output(batch, ["_id"], score=pa.array(found, pa.float64()))

    source = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(rate, f"_id {kind}, score double")


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4,
    held: int = 2, threshold: float = THRESHOLD,
) -> DataFrame:
    """``id_col``, held_out, score, predicted; learned from labels of documents that are not held out."""
    model = fit(docs, labels, id_col, text_col, folds, held)
    return score(docs, model, id_col, text_col).select(
        F.col("_id").alias(id_col),
        (remainder(F.col("_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
