"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point; the vectors of an n-gram's letters are
permuted (rotated) by their place and bound by multiplication, and a text is the bundle (sum) of its n-grams.  A
language is the bundle of all its documents, so it is learned in one pass with exact sums, and a text belongs to
the language whose prototype has the largest cosine with it; of equal ones the first by name.  Anything between
two words counts as one boundary letter.

A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was learned.
Documents without a language teach nothing.  Repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import kept_in, output, remainder, text_slices, texts_of, utf8, worker_store
from peerbench.llm.pretokens import LETTER, code_point_classes

DIMENSIONS = 1024
GRAM = 3
SEED = 20
UNKNOWN = "und"
# Texts whose n-grams are bundled by one matrix product.
TOGETHER = 64
# N-grams whose vectors are spelled out at a time.
GRAMS_TOGETHER = 16_384
# Sums of single precision are whole numbers up to here.
EXACT = 1 << 24
# Alphabets up to this size find their n-grams by counting, larger ones by sorting.
SMALL_ALPHABET = 128


class Profiler:
    """Turns texts into bundles; a worker makes one and keeps its letter vectors."""

    def __init__(self, dimensions: int = DIMENSIONS, gram: int = GRAM) -> None:
        self.dimensions, self.gram = dimensions, gram
        self.letter = code_point_classes() == LETTER
        self.vectors: dict[int, np.ndarray] = {}

    def letter_vector(self, code: int) -> np.ndarray:
        if code not in self.vectors:
            random = np.random.default_rng([SEED, code])
            self.vectors[code] = random.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.vectors[code]

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For all n-grams of all texts: number of the text and number of the n-gram; and the n-grams' letters."""
        bounded = ["\n" + text.lower() + "\n" for text in texts]
        codes = np.frombuffer("".join(bounded).encode("utf-32-le"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, bounded), np.int64, len(texts)))
        codes = np.where(self.letter[codes], codes, 0)
        # A run of other characters is one boundary, but every text has its own at either end.
        inside = np.append(True, (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1]))
        codes, owner = codes[inside], owner[inside]
        alphabet, letters = np.unique(codes, return_inverse=True)
        base = len(alphabet)
        count = max(len(letters) - self.gram + 1, 0)
        keys = np.zeros(count, dtype=np.int64)
        for place in range(self.gram):
            keys = keys * base + letters[place : place + count]
        last = owner[self.gram - 1 :]
        # No n-gram spans two texts, and none is without a letter.
        own = (owner[:count] == last) & (keys != 0)
        keys, last = keys[own], last[own]
        if base <= SMALL_ALPHABET:
            used = np.flatnonzero(np.bincount(keys, minlength=1))
            number = np.zeros(used[-1] + 1 if len(used) else 1, dtype=np.int64)
            number[used] = np.arange(len(used))
            numbers = number[keys]
        else:
            used, numbers = np.unique(keys, return_inverse=True)
        spelled = np.stack([alphabet[used // base**place % base] for place in range(self.gram)][::-1])
        return last, numbers, spelled

    def gram_vectors(self, spelled: np.ndarray) -> np.ndarray:
        """One vector for each column of ``spelled``."""
        codes, letters = np.unique(spelled, return_inverse=True)
        vectors = np.stack([self.letter_vector(int(code)) for code in codes])
        letters = letters.reshape(spelled.shape)
        bound = np.roll(vectors, self.gram - 1, axis=1)[letters[0]]
        for place in range(1, self.gram):
            bound *= np.roll(vectors, self.gram - 1 - place, axis=1)[letters[place]]
        return bound.astype(np.float32)

    def bundles(self, texts: list[str], groups: np.ndarray | None = None, n_groups: int = 0) -> np.ndarray:
        """The bundle of every text, or of every group of texts, in whole numbers.

        Vectors are spelled out for ``GRAMS_TOGETHER`` n-grams at a time, however many different ones a text has; the
        sum is the same in any order.
        """
        owner, numbers, spelled = self.grams(texts)
        rows = len(texts) if groups is None else n_groups
        total = np.zeros((rows, self.dimensions), dtype=np.int64)
        if not len(owner):
            return total
        owner = owner if groups is None else groups[owner]
        different = spelled.shape[1]
        if different > GRAMS_TOGETHER:
            order = np.argsort(numbers, kind="stable")
            owner, numbers = owner[order], numbers[order]
        for start in range(0, different, GRAMS_TOGETHER):
            width = min(GRAMS_TOGETHER, different - start)
            part = slice(None)
            if different > GRAMS_TOGETHER:
                part = slice(*np.searchsorted(numbers, [start, start + width]))
            cells = np.bincount(owner[part] * width + numbers[part] - start, minlength=rows * width)
            kind = np.float32 if len(owner) < EXACT else np.float64
            counts = cells.reshape(rows, width).astype(kind)
            total += (counts @ self.gram_vectors(spelled[:, start : start + width]).astype(kind, copy=False)).astype(np.int64)
        return total


def learn(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, teaches: Column | None = None
) -> tuple[list[str], np.ndarray]:
    """The languages, in order, and their prototypes (one row each, of length 1).

    What comes to the driver is one vector per language; texts and n-grams stay with the workers.
    """
    store = worker_store(docs.sparkSession)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = kept_in(store, Profiler)
        sums: dict[str, np.ndarray] = {}
        for batch in text_slices(batches):
            names, groups = np.unique(np.array(batch.column("lang").to_pylist()), return_inverse=True)
            found = profiler.bundles(texts_of(batch), groups, len(names))
            for name, vector in zip(names.tolist(), found):
                sums[name] = sums.get(name, 0) + vector
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([sums[n] for n in names], pa.list_(pa.int64()))],
            ["lang", "bundle"],
        )

    teachers = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    teachers = teachers if teaches is None else teachers.where(teaches)
    sums = (
        teachers.select(F.col(lang_col).cast("string").alias("lang"), utf8(F.col(text_col)).alias("text"))
        .mapInArrow(bundle, "lang string, bundle array<bigint>")
        .select("lang", F.posexplode("bundle"))
        .groupBy("lang", "pos")
        .agg(F.sum("col").alias("total"))
    )
    rows = sums.collect()
    names = sorted({row["lang"] for row in rows})
    prototypes = np.zeros((len(names), DIMENSIONS))
    place = {name: i for i, name in enumerate(names)}
    for row in rows:
        prototypes[place[row["lang"]], row["pos"]] = row["total"]
    lengths = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return names, prototypes / np.maximum(lengths, 1e-300)


def predict(
    docs: DataFrame, names: list[str], prototypes: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``_id``, ``lang_pred`` and ``score``, half of one plus the cosine, for every row."""
    store = worker_store(docs.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = kept_in(store, Profiler)
        for batch in text_slices(batches):
            texts = texts_of(batch)
            predicted, scores = [], []
            for start in range(0, len(texts), TOGETHER):
                found = profiler.bundles(texts[start : start + TOGETHER]).astype(np.float64)
                lengths = np.linalg.norm(found, axis=1)
                for length, row in zip(lengths, found @ prototypes.T):
                    best = int(np.argmax(row)) if length and len(names) else -1
                    predicted.append(UNKNOWN if best < 0 else names[best])
                    cosine = row[best] / length if best >= 0 else -1.0
                    scores.append(min(max((1 + cosine) / 2, 0.0), 1.0))
            yield output(
                batch, ["_id"], lang_pred=pa.array(predicted, pa.string()), score=pa.array(scores, pa.float64())
            )

    source = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(compare, f"_id {kind}, lang_pred string, score double")


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held: int = 1
) -> DataFrame:
    """``id_col``, held_out, lang_pred, score; learned from the documents that are not held out."""
    names, prototypes = learn(docs, id_col, text_col, lang_col, remainder(F.col(id_col), folds) != held)
    predicted = predict(docs, names, prototypes, id_col, text_col)
    return predicted.select(
        F.col("_id").alias(id_col), (remainder(F.col("_id"), folds) == held).alias("held_out"), "lang_pred", "score"
    )
