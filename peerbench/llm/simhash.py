"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``max_distance`` bits of each other have a common variant within half that distance of
both.  Every distinct fingerprint therefore stands for all its variants within the half distance, and
fingerprints that share a variant collide.  All that share one are linked to each other, so linking each to the
smallest keeps every component; the pairs are verified by their bit distance.

The variants (2,081 for four bits) are not shuffled one by one.  A variant is dealt out by the exclusive-or of
its four 16-bit words, and the variants of a fingerprint that go to the same place travel as one row (137 rows
for four bits) and are spelled out there.  This is exact, since equal variants have equal places.  A cluster of
similar fingerprints spreads over many places, because every changed bit changes the place; equal fingerprints
are reduced to one before.  Beyond ``OF_PLACES`` fingerprints the words get longer, one bit for every doubling, so a
place stays small (211 rows for 20-bit words, 529 for 32-bit words).  Rows are sorted by place and stream by: a task
holds a few places at a time.

Null and empty texts have fingerprint zero and are linked like any other.  A null id takes part, but is
never the name of a component unless nothing else is in it.  Repeated rows are one another's copies; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import output, text_slices, utf8
from peerbench.llm.components import components
from peerbench.session import stored

SEED = 42
BITS = 64
PLACE_BITS = 16
# Fingerprints up to which places have PLACE_BITS bits.
OF_PLACES = 1 << 24
# Variants that a worker spells out and sorts at a time, and shingles that it hashes at a time.
VARIANTS_AT_ONCE = 4_000_000
SHINGLES_AT_ONCE = 1 << 20


def fingerprint(raw: bytes, shingle: int) -> int:
    """SimHash of the shingles of a text, as a signed 64-bit number."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.append(0, ends[:-1])
    spans = zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist())
    hashed = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - size + 1
    )
    total = np.zeros(BITS, dtype=np.int64)
    for some in range(0, len(hashed), SHINGLES_AT_ONCE):
        part = hashed[some : some + SHINGLES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    set_often = 2 * total > len(hashed)
    return int(np.packbits(set_often).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """``_id``, ``_text`` (hash of the text) and ``print`` of every row."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = [fingerprint(raw, shingle) for raw in batch.column("text").to_pylist()]
            yield output(batch, ["_id", "_text"], print=pa.array(found, pa.int64()))

    source = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.col(text_col)).alias("_text"),
        utf8(F.col(text_col)).alias("text"),
    )
    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(take, f"_id {kind}, _text bigint, print bigint")


def place_bits(prints: int) -> int:
    """Bits of a place: one more for every doubling beyond ``OF_PLACES`` fingerprints."""
    return min(32, PLACE_BITS + max(0, math.ceil(math.log2(max(prints, 1) / OF_PLACES))))


def masks_by_place(radius: int, width: int = PLACE_BITS) -> dict[int, np.ndarray]:
    """All masks of at most ``radius`` bits, by what they change in the place of a fingerprint."""
    found: dict[int, list[int]] = {}
    for size in range(radius + 1):
        for bits in combinations(range(BITS), size):
            place = 0
            for bit in bits:
                place ^= 1 << bit % width
            found.setdefault(place, []).append(sum(1 << bit for bit in bits))
    return {place: np.array(masks, dtype=np.uint64).view(np.int64) for place, masks in found.items()}


def place_of(value: Column, width: int = PLACE_BITS) -> Column:
    """Exclusive-or of the words of ``width`` bits."""
    folded = value
    for shift in range(width, BITS, width):
        folded = folded.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return folded.bitwiseAND(F.lit((1 << width) - 1))


def places_of(values: np.ndarray, width: int = PLACE_BITS) -> np.ndarray:
    """As ``place_of``, for an array."""
    whole = values.view(np.uint64)
    folded = whole.copy()
    for shift in range(width, BITS, width):
        folded ^= whole >> np.uint64(shift)
    return (folded & np.uint64((1 << width) - 1)).astype(np.int64)


def colliding(prints: np.ndarray, changes: np.ndarray, masks: dict[int, np.ndarray]) -> np.ndarray:
    """Pairs of a fingerprint and the smallest one it shares a variant with, each pair once."""
    variants, owners = [], []
    order = np.argsort(changes, kind="stable")
    prints, changes = prints[order], changes[order]
    bounds = np.append(np.flatnonzero(np.append(True, changes[1:] != changes[:-1])), len(changes))
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = masks[int(changes[a])]
        variants.append((prints[a:b, None] ^ own).ravel())
        owners.append(np.repeat(prints[a:b], len(own)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    again = variant[1:] == variant[:-1]
    # Only variants that occur more than once matter.
    shared = np.append(again, False) | np.append(False, again)
    variant, owner = variant[shared], owner[shared]
    if not len(variant):
        return np.zeros((0, 2), dtype=np.int64)
    starts = np.flatnonzero(np.append(True, variant[1:] != variant[:-1]))
    smallest = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(variant))))
    differ = owner != smallest
    return np.unique(np.stack([owner[differ], smallest[differ]], axis=1), axis=0)


def print_links(prints: DataFrame, max_distance: int = 4, width: int | None = None) -> DataFrame:
    """``a`` and ``b``: fingerprints linked so that components are those of all pairs within the distance.

    ``prints`` has distinct values in ``print``.  The distance is even, for only then are all fingerprints
    that share a variant within it.  ``width`` is the number of bits of a place, by default what their number asks for.
    """
    if max_distance % 2:
        raise ValueError("meeting in the middle needs an even distance")
    width = place_bits(prints.count()) if width is None else width
    masks = masks_by_place(max_distance // 2, width)
    known = np.array(sorted(masks))
    sizes = np.array([len(masks[change]) for change in known.tolist()])

    def spelled(values: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of whole places, as many at a time as fit."""
        changes = places_of(values, width) ^ places
        ends = np.append(np.flatnonzero(places[1:] != places[:-1]) + 1, len(places))
        filled = np.cumsum(sizes[np.searchsorted(known, changes)])[ends - 1]
        start = place = 0
        while start < len(values):
            before = filled[place - 1] if place else 0
            place = max(place + 1, int(np.searchsorted(filled, before + VARIANTS_AT_ONCE, "right")))
            stop = int(ends[place - 1])
            pairs = colliding(values[start:stop], changes[start:stop], masks)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
            start = stop

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append((np.asarray(batch.column("print")), np.asarray(batch.column("place"))))
            rows += batch.num_rows
            if rows * len(masks) < VARIANTS_AT_ONCE:
                continue
            values, places = (np.concatenate(column) for column in zip(*held))
            # The last place may go on in the next batch.
            cut = int(np.searchsorted(places, places[-1]))
            yield from spelled(values[:cut], places[:cut])
            held, rows = [(values[cut:], places[cut:])], len(values) - cut
        if rows:
            values, places = (np.concatenate(column) for column in zip(*held))
            yield from spelled(values, places)

    changes = F.array(*[F.lit(change).cast("bigint") for change in sorted(masks)])
    placed = prints.select("print", place_of(F.col("print"), width).alias("own")).select(
        "print", F.explode(F.transform(changes, lambda c: c.bitwiseXOR(F.col("own")))).alias("place")
    )
    dealt = placed.repartition("place").sortWithinPartitions("place")
    pairs = dealt.mapInArrow(meet, "a bigint, b bigint").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_distance: int = 4,
) -> DataFrame:
    """``_id``, ``_text`` (hash of the text), ``print``, ``component`` (smallest id) and ``first``, the
    ``_id`` and ``_text`` of the document that stands for the component."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    names = F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_text")
    distinct = stored(
        prints.groupBy("print").agg(F.min("_id").alias("_id"), F.min(names).alias("first")),
        "simhash-distinct",
    )
    roots = components(print_links(distinct.select("print"), max_distance), "simhash")
    member = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "_id", "first", F.coalesce("root", "print").alias("root")
    )
    # A component can hold a large part of all fingerprints, so it is reduced before it is joined.
    named = stored(
        member.groupBy("root").agg(F.min("_id").alias("component"), F.min("first").alias("first")),
        "simhash-named",
    )
    member = stored(member.select("print", "root"), "simhash-members")
    found = stored(
        member.join(named, "root").select(
            F.col("print").alias("_print"), "component", F.struct("first._id", "first._text").alias("first")
        ),
        "simhash-components",
    )
    return prints.join(found, prints["print"] == found["_print"]).drop("_print")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_distance: int = 4,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of every component the row with the smallest id stays."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_distance)
    firsts = stored(
        found.select("first").distinct().select("first._id", "first._text"), "simhash-firsts"
    )
    whole = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash")
    )
    same = F.col("id").eqNullSafe(firsts["_id"]) & (F.col("hash") == firsts["_text"])
    # What stays grows with the documents, so it is never broadcast: one plan at every size.
    kept = whole.join(firsts.hint("merge"), same, "left_semi")
    # Rows repeated with id and text are told apart by nothing, so one of them is taken.
    if not found.groupBy("_id", "_text").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "hash"])
    return kept.select("row.*")
