"""Collocations against a plain count and the SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from cases import documents, odd_documents, results
from compare import differences, engine
from peerbench.llm import collocations as co


def slow(rows, least=10, percent=50, best=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = defaultdict(int)
    for (lang, p), a in candidates.items():
        for part in (p[:2], p[1:]) if len(p) == 3 else ():
            longer[lang, part] = max(longer[lang, part], a)
    found = defaultdict(list)
    for (lang, p), a in candidates.items():
        if longer[lang, p] and 100 * longer[lang, p] >= percent * a:
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return [
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, rows_ in found.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(rows_)[:best], 1)
    ]


def found(df):
    return sorted(map(tuple, df.collect()))


def sentences(seed, count, lang=("en", "de", None, "und")):
    random_ = random.Random(seed)
    words = ["new", "york", "New", "city", "of", "é", "a-b", "the", "\x1fx"]
    return [
        (i, "".join(random_.choice(words) + random_.choice([" ", " ", "\t", ". ", ",", "\n", "  "]) for _ in range(60)),
         random_.choice(lang), "s", 1)
        for i in range(count)
    ]


def test_odd_documents(spark):
    rows = odd_documents()
    assert found(co.collocations(documents(spark, clashing=True))) == sorted(slow(rows))


def test_small_vocabulary_with_null_language(spark):
    rows = sentences(1, 300)
    expected = sorted(slow(rows))
    assert len(expected) > 100 and {r[0] for r in expected} == {"en", "de", "und"}
    assert found(co.collocations(documents(spark, rows))) == expected
    # However the rows are dealt out.
    assert found(co.collocations(documents(spark, rows).repartition(7))) == expected


def test_parameters(spark):
    rows = sentences(2, 80)
    got = co.collocations(documents(spark, rows), least=3, covered_percent=90, best=15)
    assert found(got) == sorted(slow(rows, 3, 90, 15))


def test_hot_word_and_one_long_piece(spark):
    # One pair makes up a third of all words, and one text has no end of a piece.
    rows = [(i, "hot pair " * 40 + f"word{i % 50} tail{i % 7} hot", "en", "s", 1) for i in range(200)]
    rows.append((900, " ".join(f"w{i % 11}" for i in range(300_000)), "en", "s", 1))
    assert found(co.collocations(documents(spark, rows))) == sorted(slow(rows))


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    rows = sentences(3, 200)
    monkeypatch.setattr(co, "BITS", 1 << 15)
    monkeypatch.setattr(co, "bitmap", lambda marks: np.full(co.BITS // 8, 255, dtype=np.uint8))
    assert found(co.collocations(documents(spark, rows))) == sorted(slow(rows))


@pytest.mark.parametrize("hot", [1, 2, 10**9])
def test_parted_stripes_change_nothing(spark, monkeypatch, hot):
    rows = sentences(4, 120)
    monkeypatch.setattr(co, "HOT", hot)
    assert found(co.collocations(documents(spark, rows))) == sorted(slow(rows))


def test_hot_prefixes_are_bounded(spark):
    rows = [("en", f"w{i}", 500 if i < 3 else 1) for i in range(2000)]
    words = spark.createDataFrame(rows, "lang string, next string, f bigint")
    assert co.hot_prefixes(words, "next", 3497) == {"en": {b"w0", b"w1", b"w2"}}


def test_bitmap_holds_the_marked_places_only(spark):
    numbers = [0, 1, 7, 8, 32_767, 32_768, co.BITS - 1]
    bits = co.bitmap(spark.createDataFrame([(b,) for b in numbers], "bit bigint"))
    assert bits.nbytes == co.BITS // 8
    set_ = [8 * i + k for i in bits.nonzero()[0].tolist() for k in range(8) if bits[i] >> k & 1]
    assert set_ == numbers


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_stripes_merge_element_by_element_across_batches(size):
    rows = [(b"a\n0\nen", b"x\t4 z"), (b"a\n0\nen", b"x\t6 y"), (b"a\n1\nen", b"z\t10"), (b"b\n-1\nen", b"x\t9")]
    rows += [(b"c\n-1\nen", b"x\t3")] * 4
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows[i : i + size])], ["key", "words"])
        for i in range(0, len(rows), size)
    ]
    got = [r for b in co.merge_stripes(iter(batches), 10, True) for r in b.to_pylist()]
    assert sorted((r["prefix"], r["next"], r["f"]) for r in got if r["next"]) == [
        (b"a", b"x", 10), (b"a", b"z", 10), (b"c", b"x", 12)
    ]
    sums = Counter()
    for r in got:
        sums[r["prefix"]] += r["f"] if r["next"] is None else 0
    assert sums == {b"a": 22, b"b": 9, b"c": 12}


def test_scores_do_not_overflow(spark):
    words = spark.createDataFrame([("en", "x", 10**13), ("en", "y", 10**13)], "lang string, phrase string, f bigint")
    a, l, r = (F.lit(10**13).cast(co.DECIMAL) for _ in range(3))
    score = F.call_function("div", F.lit(1_000_000).cast(co.DECIMAL) * a * a, l * r)
    assert {row[0] for row in words.select(score).collect()} == {1_000_000}


def test_empty_tables(spark):
    assert co.collocations(documents(spark, [])).collect() == []
    assert co.collocations(documents(spark, [(1, None, None, None, 0), (2, "", "en", None, 0)])).collect() == []


def test_query_equals_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = entry_point.queries()["op11_collocations"](spark, sf)
    assert differences(got, engine(sf), entry_point.oracle_sql()["op11_collocations"]) == []
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    assert results(got) == results(spark.createDataFrame(slow(rows), got.schema))
