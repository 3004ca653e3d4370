"""Periodic runs against the definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry_point
from cases import documents, odd_documents, prose, results
from peerbench.llm import periodic as pe


def slow_runs(words, least=12):
    """By the definition: every period, every longest stretch, and only the smallest period of a stretch."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, 2 * q):
                stretch = words[i : i + length]
                if not any(stretch[d:] == stretch[: length - d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found)


def slow_row(doc_id, text, tail=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if tail and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = slow_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)]
    return (doc_id, len(runs), *best, exponent, *digests)


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_runs_equal_the_definition_on_small_alphabets():
    random_ = random.Random(1)
    for _ in range(1500):
        texts = [
            [bytes([c]) for c in random_.choices(b"abcdefgh"[: random_.choice([1, 2, 2, 3, 5])], k=random_.randint(0, 45))]
            for _ in range(random_.randint(1, 4))
        ]
        least = random_.choice([2, 2, 4, 12])
        got = [list(map(tuple, own.tolist())) for _, own in pe.text_runs([b" ".join(t) for t in texts], least)]
        assert got == [slow_runs(t, least) for t in texts]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("words", [["x"] * 700, list("ab") * 300, fibonacci(600), list("aabaabab" * 70) + ["z"]])
def test_highly_periodic_texts(words):
    [(_, own)] = pe.text_runs([" ".join(words).encode()], 2)
    assert list(map(tuple, own.tolist())) == slow_runs(words, 2)


def test_suffix_array_and_common_prefixes():
    random_ = random.Random(4)
    for size in (1, 5, 60, 400):
        symbols, _ = pe.numbered([[bytes([random_.choice(b"ab")]) for _ in range(size)], [b"a"] * 9])
        order, place = pe.suffix_array(symbols)
        listed = symbols.tolist()
        assert order.tolist() == sorted(range(len(listed)), key=lambda i: listed[i:])
        assert place[order].tolist() == list(range(len(listed)))
        common = pe.common_prefixes(symbols, order, place)
        for r in range(1, len(listed)):
            a, b = listed[order[r - 1] :], listed[order[r] :]
            agree = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[r] == agree


def test_nearest_smaller():
    random_ = random.Random(5)
    for n in (1, 2, 7, 100):
        values = [random_.randint(0, 6) for _ in range(n)]
        before, behind = pe.nearest_smaller(np.array(values))
        for i, v in enumerate(values):
            assert before[i] == next((j for j in range(i - 1, -1, -1) if values[j] < v), -1)
            assert behind[i] == next((j for j in range(i + 1, n) if values[j] < v), n)


def test_very_long_texts_take_n_log_n():
    # Half a million words each: one word only, a late repetition, and no run at all.
    half = [b"%d" % i for i in range(250_000)]
    for words, expected in (
        ([b"x"] * 500_000, [(0, 500_000, 1)]),
        (half * 2, [(0, 500_000, 250_000)]),
        ([b"%d" % i for i in range(500_000)], []),
    ):
        [(_, own)] = pe.text_runs([b" ".join(words)])
        assert list(map(tuple, own.tolist())) == expected


def test_runs_and_words_left(spark):
    rows = [
        (1, "a b " * 6 + "c", "en", "s", 1),
        (2, "a b " * 5 + "c", "en", "s", 1),
        (3, "lead " + "one two three\n" * 4 + "one tail", "en", "s", 1),
        (4, None, "en", "s", 1),
    ]
    got = {r.doc_id: r for r in pe.periodic_runs(documents(spark, rows)).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 12, 2)] and got[1].collapsed == "a b c"
    assert got[2].runs == [] and got[2].collapsed == "a b a b a b a b a b c"
    assert [tuple(r) for r in got[3].runs] == [(1, 13, 3)] and got[3].collapsed == "lead one two three tail"
    assert got[4].runs == [] and got[4].collapsed == ""


def test_periodic_tails(spark):
    random_ = random.Random(6)
    rows = [(i, prose(random_, random_.randint(0, 90)), "en", "s", 1) for i in range(400)]
    rows += [(i, text, "en", "s", 1) for i, text in ((None, "a b"), (1000, None), (1001, ""), (1003, " \n"))]
    got = pe.run_digests(pe.with_periodic_tails(documents(spark, rows)))
    expected = [slow_row(r[0], r[1]) for r in rows]
    assert sum(r[1] > 0 for r in expected) > 15
    assert results(got) == ordered(expected)


def test_odd_documents(spark):
    rows = odd_documents()
    # The definition takes too long for the longest text, which has no run.
    short = [r for r in rows if r[0] != 5]
    got = pe.run_digests(documents(spark, clashing=True))
    assert got.columns[0] == "doc_id" and got.count() == len(rows)
    assert results(got.where("doc_id IS DISTINCT FROM 5")) == ordered([slow_row(r[0], r[1], False) for r in short])


def test_empty_table(spark):
    assert pe.run_digests(pe.with_periodic_tails(documents(spark, []))).collect() == []


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = entry_point.queries()["op12_periodic_runs"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 6000").select("doc_id", "text").collect()
    expected = ordered([slow_row(*r) for r in docs])
    ids = {r[0] for r in docs}
    assert [r for r in results(got) if r[0] in ids] == expected
    assert sum(r[1] for r in expected) > 5
