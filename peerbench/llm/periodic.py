"""Periodic runs of words, found with an enhanced suffix array.

A run is a longest stretch of words that repeats with its smallest period at least twice.  Its last two periods
form a square whose two halves are followed by different words: a branching square.  The suffixes at both halves
then have exactly one period in common, so they lie in different children of the interval of that depth in the
array of longest common prefixes.  Every interval therefore looks at the suffixes of all children but the largest,
and asks the inverse suffix array whether the suffix one depth further, or one depth earlier, lies in the interval
too, in another child.  That finds every branching square and looks at n log n suffixes at most.  Squares are
then rotated to the left as long as the words agree, which gives the runs; squares of a multiple of the period
fall into the run of the period and go.

There are no tree nodes: suffix array, common prefixes and intervals are flat arrays over all texts of a slice.
Words are numbered text by text and every text ends with a number of its own, so no two texts share a prefix.

* The suffix array is sorted by a few words at once, then by doubling, for those still tied.
* Common prefixes are compared only where the words before differ; elsewhere they are one less than at the
  place before (the compared lengths add up to n log n at most).
* Intervals come from the nearest smaller prefixes on both sides, found by descending a pyramid of minima.

Words are runs of other bytes than space, tab and line ends.  Null and empty texts have no words and no runs.
Equal texts have equal runs, and repeated rows are repeated results.  An empty table gives an empty result.
Whole texts are searched; a slice takes about 250 bytes of memory per word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import output, text_slices, utf8

LEAST = 12
# Words compared at a time.
COMPARED = 1 << 18


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word, equal for equal words of one text only, an end after each text; where texts start."""
    numbers = []
    offset = 0
    starts = [0]
    for words in texts:
        last = dict(zip(words, range(offset, offset + len(words))))
        numbers.append(np.fromiter(map(last.__getitem__, words), np.int64, len(words)))
        offset += len(words) + 1
        numbers.append(np.array([offset - 1]))
        starts.append(offset)
    return np.concatenate(numbers) if numbers else np.zeros(0, np.int64), np.array(starts)


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the place of each; the order of numbers stands for that of words."""
    n = len(symbols)
    bits = max(1, n.bit_length())
    step = max(1, 62 // bits)
    padded = np.append(symbols, np.zeros(step, dtype=np.int64))
    key = padded[:n].copy()
    for ahead in range(1, step):
        key = (key << bits) | padded[ahead : n + ahead]
    order = np.argsort(key)
    place = np.empty(n, dtype=np.int64)
    sorted_key = key[order]
    # Tied suffixes share the first place of their group.
    group = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1]))
    sizes = np.diff(np.append(group, n))
    place[order] = np.repeat(group, sizes)
    open_ = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    while len(open_):
        # Suffixes of one group lie within one text, whose end tells them apart before the array ends.
        suffixes = order[open_]
        now = place[suffixes]
        key = now * n + place[np.minimum(suffixes + step, n - 1)]
        by = np.argsort(key)
        suffixes, key, now = suffixes[by], key[by], now[by]
        order[open_] = suffixes
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(heads, len(key)))
        place[suffixes] = np.repeat(open_[heads], sizes)
        open_ = open_[np.repeat(sizes, sizes) > 1]
        step *= 2
    return order, place


def agreement(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, direction: int) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on (1) or backwards (-1); ``b`` is behind ``a`` in one text.

    Backwards, a stretch also ends at the start of the array.
    """
    found = np.zeros(len(a), dtype=np.int64)
    active = np.arange(len(a))
    width = 8
    while len(active):
        left = []
        for some in np.array_split(active, -(-len(active) * width // COMPARED)):
            along = found[some, None] + np.arange(width)
            first, second = a[some, None] + direction * along, b[some, None] + direction * along
            inside = (first >= 0) & (second < len(symbols))
            same = inside & (np.take(symbols, first, mode="clip") == np.take(symbols, second, mode="clip"))
            stopped = ~same.all(axis=1)
            found[some] += np.where(stopped, same.argmin(axis=1), width)
            left.append(some[~stopped])
        active = np.concatenate(left)
        width = min(2 * width, COMPARED)
    return found


def common_prefixes(symbols: np.ndarray, order: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Words that each suffix has in common with the one before it in order."""
    n = len(symbols)
    before = np.where(place > 0, order[place - 1], -1)
    at = np.arange(n)
    same_before = (before > 0) & (at > 0) & (symbols[at - 1] == symbols[before - 1])
    compare = np.flatnonzero(~same_before)
    counted = np.zeros(n, dtype=np.int64)
    alike = compare[(before[compare] >= 0) & (symbols[compare] == symbols[before[compare]])]
    counted[alike] = agreement(symbols, np.minimum(alike, before[alike]), np.maximum(alike, before[alike]), 1)
    last = np.maximum.accumulate(np.where(same_before, 0, at))
    return (counted[last] - (at - last))[order]


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest smaller value before and behind every place; -1 and the length where there is none."""
    n = len(values)
    least = np.iinfo(np.int64).min
    # A pyramid over the values with one smaller than all at both ends.
    levels = [np.concatenate([[least], values, [least]])]
    while len(levels[-1]) > 1:
        row = levels[-1]
        if len(row) % 2:
            row = np.append(row, np.iinfo(np.int64).max)
            levels[-1] = row
        levels.append(np.minimum(row[::2], row[1::2]))

    def search(side: int) -> np.ndarray:
        # ``node`` is the next block to look at on its level; blocks that are the first of their parent (seen in
        # the direction of the search) are looked at as part of the parent.
        node = np.arange(1, n + 1) + side
        level_of = np.zeros(n, dtype=np.int64)
        active = np.arange(n)
        for level, row in enumerate(levels):
            own = node[active]
            alone = (own % 2 == 1) if side > 0 else (own % 2 == 0)
            hit = alone & (row[np.clip(own, 0, len(row) - 1)] < values[active])
            level_of[active[hit]] = level
            own = np.where(alone, own + side, own)
            node[active[~hit]] = own[~hit] // 2
            active = active[~hit]
            if not len(active):
                break
        for level in range(len(levels) - 1, 0, -1):
            down = np.flatnonzero(level_of >= level)
            near = 2 * node[down] + (0 if side > 0 else 1)
            node[down] = np.where(levels[level - 1][near] < values[down], near, near + side)
        return node - 1

    return search(-1), search(1)


def branching_squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square whose halves are followed by different words."""
    none = np.zeros(0, dtype=np.int64)
    if len(symbols) < 2:
        return none, none
    order, place = suffix_array(symbols)
    common = common_prefixes(symbols, order, place)
    # Only places with a common word matter, and the zeros on both sides of them.
    used = common > 0
    used = used | np.append(used[1:], False) | np.append(False, used[:-1])
    at = np.flatnonzero(used)
    if not len(at):
        return none, none
    depth = common[at]
    before, behind = nearest_smaller(depth)
    inner = np.flatnonzero(depth > 0)
    # An interval goes from the place of the smaller prefix before to the one ahead of the smaller prefix behind.
    low = at[before[inner]]
    high = np.where(behind[inner] < len(at), at[np.minimum(behind[inner], len(at) - 1)], 0) - 1
    high = np.where(behind[inner] < len(at), high, at[-1])
    depth, border = depth[inner], at[inner]
    by = np.lexsort((border, high, low))
    low, high, depth, border = low[by], high[by], depth[by], border[by]
    new = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
    interval = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    low_of, high_of, depth_of = low[heads], high[heads], depth[heads]
    # Children: from the low end or a border to the next border or the high end.
    owner = np.concatenate([np.arange(len(heads)), interval])
    child_low = np.concatenate([low_of, border])
    by = np.lexsort((child_low, owner))
    owner, child_low = owner[by], child_low[by]
    ends = np.append(owner[1:] != owner[:-1], True)
    child_high = np.where(ends, high_of[owner], np.append(child_low[1:], 0) - 1)
    size = child_high - child_low + 1
    largest = np.lexsort((size, owner))[np.append(np.flatnonzero(np.diff(owner)), len(owner) - 1)]
    small = np.ones(len(owner), dtype=bool)
    small[largest] = False
    owner, child_low, child_high, size = owner[small], child_low[small], child_high[small], size[small]
    starts, periods = [], []
    # In pieces, since the suffixes looked at are n log n.
    filled = np.cumsum(size)
    first = 0
    while first < len(size):
        done = filled[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(filled, done + 4 * len(symbols), "right")))
        count = size[first:stop]
        child = np.repeat(np.arange(first, stop), count)
        rank = np.arange(len(child)) - np.repeat(np.cumsum(count) - count, count) + child_low[child]
        suffix, period = order[rank], depth_of[owner[child]]
        for shift, start in ((period, suffix), (-period, suffix - period)):
            other = suffix + shift
            inside = (other >= 0) & (other < len(symbols))
            asked = place[np.where(inside, other, 0)]
            inside &= (asked >= low_of[owner[child]]) & (asked <= high_of[owner[child]])
            inside &= (asked < child_low[child]) | (asked > child_high[child])
            starts.append(start[inside])
            periods.append(period[inside])
        first = stop
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)], axis=1), axis=0)
    return found[:, 0], found[:, 1]


def runs(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows of start, length and period, in order, of all runs of ``least`` words or more."""
    start, period = branching_squares(symbols)
    end = start + 2 * period
    # Of squares with one end, the one of the smallest period is rotated first: a run of that period takes those
    # of its multiples with it.
    by = np.lexsort((period, end))
    end, period = end[by], period[by]
    found = []
    while len(end):
        first = np.append(True, end[1:] != end[:-1])
        heads = np.flatnonzero(first)
        e, q = end[heads], period[heads]
        s = e - 2 * q
        s = s - agreement(symbols, s - 1, s + q - 1, -1)
        found.append(np.stack([s, e - s, q], axis=1))
        own = np.cumsum(first) - 1
        inside = (end - 2 * period >= s[own]) & (period % q[own] == 0)
        end, period = end[~inside], period[~inside]
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    found = np.concatenate(found)
    found = found[found[:, 1] >= np.maximum(least, 2 * found[:, 2])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def text_runs(raws: list[bytes], least: int = LEAST) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and runs (start, length, period; in words) of every text."""
    texts = [raw.split() for raw in raws]
    symbols, starts = numbered(texts)
    found = runs(symbols, least)
    bounds = np.searchsorted(found[:, 0], starts)
    for i, words in enumerate(texts):
        own = found[bounds[i] : bounds[i + 1]].copy()
        own[:, 0] -= starts[i]
        yield words, own


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without those that any run contains after its first period."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    inside = accumulate(change.tolist())
    return [word for word, cover in zip(words, inside) if not cover]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``id_col``, ``runs`` (array of start, length, period in words) and ``collapsed``, the words left, of every row."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found, left = [], []
            for words, own in text_runs(batch.column("text").to_pylist(), least):
                found.append(own)
                left.append(b" ".join(collapsed(words, own) if len(own) else words))
            rows = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            runs_ = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"])
            yield output(
                batch, ["_id"], runs=pa.ListArray.from_arrays(pa.array(ends), runs_), collapsed=pa.array(left, pa.binary())
            )

    source = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    found = source.mapInArrow(
        search, f"_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    )
    return found.select(F.col("_id").alias(id_col), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def with_periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``text_col``, where every tenth text, by the checksum of its id, ends periodically.

    With ``h`` the CRC-32 of the id as text and ``g = h // 10``, a text of ``n`` words whose ``h`` ends in 0
    repeats from word ``a = g % n`` on its ``p = 1 + (n - a) // (3 + g % 8)`` words.  A null id changes nothing.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = F.coalesce(h % 10 == 0, F.lit(False))
    # At most ten repetitions.
    numbers = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        F.when(changed, words).alias("w"),
        F.floor(h / 10).alias("g"),
    ).select("*", F.size("w").alias("n"))
    a = (F.col("g") % F.col("n")).cast("int")
    placed = numbers.select("*", F.when(F.col("n") > 0, a).alias("a"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    sized = placed.select("*", p.alias("p"))
    tail = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    whole = F.concat(F.slice("w", F.lit(1), F.col("a")), F.flatten(F.array_repeat(tail, times)))
    rebuilt = F.concat_ws(" ", F.slice(whole, F.lit(1), F.col("n")))
    text: Column = F.when(F.col("n") > 0, rebuilt).otherwise(F.col("_text"))
    return sized.select(F.col("_id").alias(id_col), text.alias(text_col))


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``id_col``, n_runs, start, length, period and exponent_milli of the longest run (null without runs), and
    SHA-256 of all runs (a line of start, length and period each) and of the words left, joined by spaces."""
    found = periodic_runs(docs, id_col, text_col, least)
    # The longest comes first; of equal ones that of the smallest start, then period.
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"], r["length"]))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    picked = found.select("*", longest.alias("best"))
    return picked.select(
        F.col(id_col),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
