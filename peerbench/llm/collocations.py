"""Phrase collocation mining with stripes.

A stripe belongs to a prefix of no, one or two words and counts the words that follow it.  Tasks count whole blocks
of text, and what they emit are stripes, not pairs.  Merged element by element, the stripes give everything:

* extensions: an element is the frequency of prefix and next word together;
* prefix totals: the frequency of a prefix is an element of the stripe one word shorter, and the sum of the stripe
  without prefix is ``n``;
* subsumption maxima: the largest element of a two-word stripe is the best extension to the right of its prefix,
  and the largest of all elements with the same last two words is the best extension to the left.

The stripes are counted level by level.  A phrase cannot be more frequent than its parts, so the next level counts
only phrases whose parts are frequent.  Tasks know these by a bitmap of a fixed size (``BITS``); parts that fall on
the bit of a frequent one are counted too and drop out later, so the bitmap changes how much is shuffled, never the
result.

A stripe is a row of two texts: its key, and its elements.  The stripe of a prefix that makes up more than one in
``HOT`` of all words travels in ``PARTS`` parts by the hash of the next word, and that without prefix in
``PARTS * PARTS``; equal elements always meet.  There are fewer than ``HOT`` such prefixes, whatever the data.
Stripes are sorted by Spark, which spills, and merged as they stream by: a worker holds one part of one stripe
beyond the batch at hand.

Null texts are empty and have no words; a null language is ``und``.  Repeated rows count as often as they occur.
Phrases do not cross the marks that end a piece.  An empty table, or one without frequent phrases, gives an empty
result.  Texts are handled in blocks of whole pieces, so memory follows the longest piece.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerbench.llm.common import text_slices, utf8
from peerbench.session import stored

# What ends a piece; the pieces are split at spaces and tabs.
MARKS = b".,;:!?\n\x0b\x0c\r"
ROMAN = bytes(range(65, 91)), bytes(range(97, 123))
LEVELLED = bytes.maketrans(ROMAN[0] + MARKS + b"\t", ROMAN[1] + b"." * len(MARKS) + b" ")
PARTS = 64
HOT = 1000
BITS = 1 << 27
# Bits of one row of a bitmap, as Spark's bitmap functions lay them out.
BITMAP_ROW = 1 << 15
# Bytes of text counted at a time.
BLOCK = 8 << 20
# The best phrases are found in so many salts first, then among the best of all salts.
SALTS = 16

# Key: prefix, part and language in lines; words: the elements, each with its count behind a tab where that is not 1.
STRIPE_DDL = "key binary, words binary"
MERGED_DDL = "lang string, prefix binary, next binary, f bigint, bit bigint"
DECIMAL = "decimal(38,0)"


def blocks(raw: bytes, limit: int = BLOCK) -> Iterator[bytes]:
    """A levelled text (marks are full stops) in blocks of whole pieces, of about ``limit`` bytes."""
    start = 0
    while len(raw) - start > limit:
        cut = raw.find(b".", start + limit)
        if cut < 0:
            break
        yield raw[start : cut + 1]
        start = cut + 1
    yield raw[start:]


def hashed_words(words: list[bytes], lang: str) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def places(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Places in a bitmap of pairs of hashed words; a word alone is paired with the empty one."""
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second + (first >> np.uint64(29)))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(33)).astype(np.int64) % BITS


def marked(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return ((bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)


class Block:
    """The words of one language in a block, numbered in the order of the parts that they fall into."""

    def __init__(self, lang: str, pieces: list[bytes]) -> None:
        tokens = b".".join(pieces).replace(b".", b" . ").split()
        tokens.append(b".")
        words = set(tokens)
        words.discard(b".")
        fine = {w: zlib.crc32(w) % (PARTS * PARTS) for w in words}
        ordered = sorted(words, key=fine.__getitem__)
        # Number 0 is the end of a piece.
        number = dict(zip(ordered, range(1, len(ordered) + 1)))
        number[b"."] = 0
        self.lang, self.words = lang, [b"", *ordered]
        self.vocabulary = pa.array(self.words, pa.binary())
        self.fine = np.fromiter((fine.get(w, 0) for w in self.words), np.int64, len(self.words))
        self.ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))

    def stripes(self, prefix: pa.Array, group: np.ndarray, part: np.ndarray, after: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """A row for every run of equal group and part (-1: not parted) of elements that are in this order."""
        heads = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (part[1:] != part[:-1])))[: len(group)]
        elements = self.vocabulary.take(pa.array(after))
        more = counts > 1
        number = pa.array(counts[more]).cast(pa.string()).cast(pa.binary())
        elements = pc.replace_with_mask(
            elements, pa.array(more), pc.binary_join_element_wise(elements.filter(pa.array(more)), number, b"\t")
        )
        lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(group)).astype(np.int32)), elements)
        parts = pa.array([b"%d" % i for i in range(-1, PARTS * PARTS)], pa.binary()).take(pa.array(part[heads] + 1))
        keys = pc.binary_join_element_wise(prefix.take(pa.array(heads)), parts, self.lang.encode(), b"\n")
        return pa.RecordBatch.from_arrays([keys, pc.binary_join(lists, b" ")], ["key", "words"])

    def no_word_stripes(self) -> pa.RecordBatch:
        counts = np.bincount(self.ids, minlength=len(self.words))[1:]
        after = np.arange(1, len(self.words))
        same = np.zeros(len(after), dtype=np.int64)
        return self.stripes(pa.array([b""] * len(after), pa.binary()), same, self.fine[1:], after, counts)

    def pairs(self, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
        """First and next word of all pairs of words that ``frequent`` marks, their counts, and for every word of the
        block the row of the pair that begins there (-1: none)."""
        hashed = hashed_words(self.words, self.lang)
        good = marked(frequent, places(hashed, np.full_like(hashed, hashed[0])))
        good[0] = False
        in_text = good[self.ids]
        starts = np.flatnonzero(in_text[:-1] & in_text[1:])
        width = len(self.words)
        codes, rows, counts = np.unique(
            self.ids[starts] * width + self.ids[starts + 1], return_inverse=True, return_counts=True
        )
        row_at = np.full(len(self.ids), -1, dtype=np.int64)
        row_at[starts] = rows
        return codes // width, codes % width, counts, row_at

    def one_word_stripes(self, words: np.ndarray, hot: set[bytes]) -> pa.RecordBatch:
        first, second, counts, _ = self.pairs(words)
        is_hot = np.fromiter((w in hot for w in self.words), bool, len(self.words))
        part = np.where(is_hot[first], self.fine[second] // PARTS, -1)
        return self.stripes(self.vocabulary.take(pa.array(first)), first, part, second, counts)

    def two_word_stripes(self, words: np.ndarray, pairs: np.ndarray, hot: set[bytes]) -> pa.RecordBatch:
        first, second, _, row_at = self.pairs(words)
        hashed = hashed_words(self.words, self.lang)
        may = marked(pairs, places(hashed[first], hashed[second]))
        good = np.append(may, False)[row_at]
        at = np.flatnonzero(good[:-1] & good[1:])
        width = len(self.words)
        codes, counts = np.unique(row_at[at] * width + second[row_at[at + 1]], return_counts=True)
        row, third = codes // width, codes % width
        both = pc.binary_join_element_wise(
            self.vocabulary.take(pa.array(first)), self.vocabulary.take(pa.array(second)), b" "
        )
        is_hot = np.asarray(pc.is_in(both, pa.array(list(hot), pa.binary())))
        part = np.where(is_hot[row], self.fine[third] // PARTS, -1)
        return self.stripes(both.take(pa.array(row)), row, part, third, counts)


def language_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in text_slices(batches, limit=BLOCK):
        by_lang: dict[str, list[bytes]] = {}
        for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for piece in blocks(raw.translate(LEVELLED)):
                by_lang.setdefault(lang, []).append(piece)
        for lang, pieces in by_lang.items():
            start, size = 0, 0
            for i, piece in enumerate(pieces):
                size += len(piece)
                if size >= BLOCK or i + 1 == len(pieces):
                    yield Block(lang, pieces[start : i + 1])
                    start, size = i + 1, 0


def elements_of(words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row, word and count of every element of stripes."""
    lists = pc.split_pattern(words, b" ")
    flat = pc.list_flatten(lists)
    counted = pc.match_substring(flat, b"\t")
    counts = np.ones(len(flat), dtype=np.int64)
    pairs = pc.list_flatten(pc.split_pattern(flat.filter(counted), b"\t"))
    even = np.arange(0, len(pairs), 2)
    counts[np.asarray(counted)] = np.asarray(pairs.take(pa.array(even + 1)).cast(pa.string()).cast(pa.int64()))
    return np.asarray(pc.list_parent_indices(lists)), pc.replace_with_mask(flat, counted, pairs.take(pa.array(even))), counts


def merge_stripes(batches: Iterator[pa.RecordBatch], least: int, totals: bool) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by key, added up element by element: extensions from ``least`` occurrences with their place in
    the bitmap, and with ``totals`` the sum of every stripe as a row without a next word."""
    # The stripe that may go on in the next batch, as merged elements.
    key, held, counts = None, pa.array([], pa.binary()), np.zeros(0, dtype=np.int64)

    def added(group: np.ndarray, words: pa.Array, n: np.ndarray) -> pa.Table:
        table = pa.table({"group": group, "next": words, "f": n})
        return table.group_by(["group", "next"]).aggregate([("f", "sum")]).sort_by("group").combine_chunks()

    def results(table: pa.Table, keys: pa.Array) -> pa.RecordBatch:
        group, f = np.asarray(table.column("group")), np.asarray(table.column("f_sum"))
        found = np.flatnonzero(f >= least)
        used, after = group[found], table.column("next").combine_chunks().take(pa.array(found))
        names = [k.split(b"\n", 2) for k in keys.to_pylist()]
        lang, prefix = [n[2].decode("utf-8", "replace") for n in names], [n[0] for n in names]
        nexts = after.to_pylist()
        place = np.zeros(len(found), dtype=np.int64)
        by_lang = defaultdict(list)
        for i, g in enumerate(used.tolist()):
            by_lang[lang[g]].append(i)
        for name, own in by_lang.items():
            words = [nexts[i] for i in own]
            before = [prefix[used[i]] for i in own]
            # Without prefix the word itself is marked, paired with the empty word.
            first, second = (words, before) if not before[0] else (before, words)
            place[own] = places(hashed_words(first, name), hashed_words(second, name))
        rows = used.tolist()
        columns = [[lang[g] for g in rows], [prefix[g] for g in rows], nexts, f[found].tolist(), place.tolist()]
        if totals:
            sums = np.bincount(group, weights=f, minlength=len(names)).astype(np.int64)
            for column, more in zip(columns, (lang, prefix, [None] * len(names), sums.tolist(), [None] * len(names))):
                column.extend(more)
        kinds = pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "prefix", "next", "f", "bit"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key")
        change = np.append(True, np.asarray(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))))
        group = np.cumsum(change) - 1
        heads = keys.take(pa.array(np.flatnonzero(change)))
        rows, words, n = elements_of(batch.column("words"))
        rows = group[rows]
        if key is not None:
            if heads[0].as_py() == key:
                rows = np.append(np.zeros(len(held), dtype=np.int64), rows)
            else:
                rows = np.append(np.zeros(len(held), dtype=np.int64), rows + 1)
                heads = pa.concat_arrays([pa.array([key], pa.binary()), heads])
            words, n = pa.concat_arrays([held, words]), np.append(counts, n)
        table = added(rows, words, n)
        last = len(heads) - 1
        end = int(np.searchsorted(np.asarray(table.column("group")), last))
        if last:
            yield results(table.slice(0, end), heads.slice(0, last))
        rest = table.slice(end)
        key, held = heads[last].as_py(), rest.column("next").combine_chunks()
        counts = np.asarray(rest.column("f_sum"))
    if key is not None:
        yield results(added(np.zeros(len(held), dtype=np.int64), held, counts), pa.array([key], pa.binary()))


def add_up(stripes: DataFrame, least: int, totals: bool = False) -> DataFrame:
    """``lang``, ``prefix``, ``next`` (null: a total), ``f`` and ``bit`` from the stripes of all tasks."""
    dealt = stripes.repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(lambda batches: merge_stripes(batches, least, totals), MERGED_DDL)
    return found.withColumns({name: F.col(name).cast("string") for name in ("prefix", "next")})


def bitmap(marks: DataFrame) -> np.ndarray:
    """The places in column ``bit`` as ``BITS / 8`` bytes, however many there are."""
    # Row k of Spark's bitmaps holds the numbers from (k - 1) * BITMAP_ROW + 1 on.
    number = F.col("bit") + 1
    rows = (
        marks.groupBy(F.bitmap_bucket_number(number).alias("row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
        .collect()
    )
    size = BITMAP_ROW // 8
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    for row in rows:
        bits[(row["row"] - 1) * size : row["row"] * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits


def hot_prefixes(phrases: DataFrame, phrase: str, total: int) -> dict[str, set[bytes]]:
    """Phrases that make up more than one in ``HOT`` of all words, by language: fewer than ``HOT``."""
    found = defaultdict(set)
    for row in phrases.where(F.col("f") * HOT > total).selectExpr("lang", f"{phrase} AS phrase").collect():
        found[row["lang"]].add(row["phrase"].encode())
    return found


def frequencies(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Words (``lang``, ``phrase``, ``f``), phrases of two and of three words (``lang``, ``prefix``, ``next``, ``f``),
    all from ``least`` occurrences, and ``lang``, ``n``: the number of all words."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), utf8(F.col(text_col)).alias("text")
    )

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in language_blocks(batches):
            yield block.no_word_stripes()

    none = stored(add_up(texts.mapInArrow(count_words, STRIPE_DDL), least, True), "collocation-words")
    totals = stored(none.where("next IS NULL").groupBy("lang").agg(F.sum("f").alias("n")), "collocation-totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    words = none.where("next IS NOT NULL")
    word_bits = spark.sparkContext.broadcast(bitmap(words))
    hot_words = hot_prefixes(words, "next", total)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in language_blocks(batches):
            yield block.one_word_stripes(word_bits.value, hot_words.get(block.lang, set()))

    pairs = stored(add_up(texts.mapInArrow(count_pairs, STRIPE_DDL), least), "collocation-pairs")
    pair_bits = spark.sparkContext.broadcast(bitmap(pairs))
    hot_pairs = hot_prefixes(pairs, "concat_ws(' ', prefix, next)", total)

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in language_blocks(batches):
            yield block.two_word_stripes(word_bits.value, pair_bits.value, hot_pairs.get(block.lang, set()))

    triples = stored(add_up(texts.mapInArrow(count_triples, STRIPE_DDL), least), "collocation-triples")
    return words.select("lang", F.col("next").alias("phrase"), "f"), pairs.drop("bit"), triples.drop("bit"), totals


def cuts(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """Every way to cut a phrase: ``lang``, ``phrase``, ``a``, ``k`` and the two parts."""
    whole = F.concat_ws(" ", "prefix", "next").alias("phrase")
    head, rest = F.substring_index("prefix", " ", 1), F.concat_ws(" ", F.substring_index("prefix", " ", -1), "next")
    last = [F.col("prefix").alias("left"), F.col("next").alias("right")]
    a = F.col("f").alias("a")
    return (
        pairs.select("lang", whole, a, F.lit(1).alias("k"), *last)
        .union(triples.select("lang", whole, a, F.lit(1).alias("k"), head.alias("left"), rest.alias("right")))
        .union(triples.select("lang", whole, a, F.lit(2).alias("k"), *last))
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 10,
    covered_percent: int = 50,
    best: int = 2000,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best phrases of each language.

    ``a`` is the frequency of the phrase, ``l`` and ``r`` those of its parts at the lowest-scoring cut and ``n``
    all words; ``score`` is a million times ``a * a / (l * r)``, rounded down.  A phrase is left out if a longer
    one that contains it reaches ``covered_percent`` of its frequency.
    """
    words, pairs, triples, totals = frequencies(docs, text_col, lang_col, least)
    known = words.unionByName(pairs.select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "f"))
    cut = cuts(pairs, triples)
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    a, l, r = (F.col(c).cast(DECIMAL) for c in "alr")
    score = F.call_function("div", F.lit(1_000_000).cast(DECIMAL) * a * a, l * r)
    # Products stay below 38 digits for counts below 10 to the 16.
    scored = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")
    candidates = scored.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", "cut.*")
    rest = F.concat_ws(" ", F.substring_index("prefix", " ", -1), "next")
    inside = triples.select("lang", F.col("prefix").alias("phrase"), "f").union(triples.select("lang", rest, "f"))
    maxima = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    covered = F.coalesce(100 * F.col("longer") >= covered_percent * F.col("a"), F.lit(False))
    kept = stored(candidates.join(maxima, ["lang", "phrase"], "left").where(~covered), "collocation-kept")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    some = kept.select("*", salt).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    )
    ranked = some.where(F.col("place") <= best).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    )
    return (
        ranked.where(F.col("rank") <= best)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


ORACLE = r"""
WITH pieces AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?
-
]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), phrases AS (
    SELECT lang, unnest([[w[i]], w[i : i + 1], w[i : i + 2]]) AS p, unnest([1, 2, 3]) AS size FROM starts
), f AS (
    SELECT lang, p, size, count(*)::HUGEINT AS a FROM phrases WHERE len(p) = size GROUP BY lang, p, size
), candidates AS (
    SELECT * FROM f WHERE size >= 2 AND a >= 10
), cut AS (
    SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r, 1000000 * c.a * c.a // (x.a * y.a) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : k]
    JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1 : c.size]
), lowest AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), longer AS (
    SELECT lang, p, max(a) AS a
    FROM (SELECT lang, unnest([p[1 : 2], p[2 : 3]]) AS p, a FROM candidates WHERE size = 3)
    GROUP BY lang, p
), kept AS (
    SELECT c.* FROM lowest c LEFT JOIN longer g ON g.lang = c.lang AND g.p = c.p
    WHERE g.a IS NULL OR 100 * g.a < 50 * c.a
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
        array_to_string(p, ' ') AS phrase, a, l, r, score
    FROM kept
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, count(*) AS n FROM starts GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""
