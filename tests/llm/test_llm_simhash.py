"""SimHash near-duplicates against all pairs."""

import random

import __spark_entry__ as entry_point
import numpy as np
import pytest
import xxhash
from cases import documents, odd_documents, prose, results
from peerbench.llm.components import components
from peerbench.llm import simhash
from peerbench.llm.simhash import (
    fingerprint, masks_by_place, near_duplicates, one_of_each, place_bits, place_of, places_of, print_links,
)


def slow_print(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance=4):
    """Smallest place linked with each, by comparing all pairs."""
    roots = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and roots[i] > roots[j]:
                    roots[i] = roots[j]
                    changed = True
    return roots


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints():
    random_ = random.Random(1)
    for n in (0, 1, 3, 4, 5, 200):
        text = prose(random_, n).upper() + "É \x0b ü" * (n > 3)
        assert fingerprint(text.encode(), 4) == signed(slow_print(text))


def test_masks_cover_the_ball_once():
    masks = [int(m) & (1 << 64) - 1 for own in masks_by_place(2).values() for m in own]
    assert len(masks) == len(set(masks)) == 1 + 64 + 64 * 63 // 2
    assert len(masks_by_place(2)) == 137


def chains():
    random_ = random.Random(5)
    prints = {random_.getrandbits(64) for _ in range(60)}
    for value in list(prints)[:30]:
        # Chains and clusters: each some bits from one before.
        for _ in range(6):
            for bit in random_.sample(range(64), random_.randint(1, 6)):
                value ^= 1 << bit
            prints.add(value)
    return sorted(signed(p) for p in prints)


@pytest.mark.parametrize("width", [None, 16, 20, 32])
def test_links_against_all_pairs(spark, width):
    prints = chains()
    table = spark.createDataFrame([(p,) for p in prints], "print bigint")
    found = {r.node: r.root for r in components(print_links(table, width=width), "t").collect()}
    roots = slow_components([p & (1 << 64) - 1 for p in prints])
    assert [found.get(p, p) for p in prints] == [prints[r] for r in roots]
    with pytest.raises(ValueError):
        print_links(table, 3)


def test_places_stream_by_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 300)
    prints = chains()
    table = spark.createDataFrame([(p,) for p in prints], "print bigint")
    few = {r.node: r.root for r in components(print_links(table, width=16), "t").collect()}
    roots = slow_components([p & (1 << 64) - 1 for p in prints])
    assert [few.get(p, p) for p in prints] == [prints[r] for r in roots]


def test_places_grow_with_the_fingerprints(spark):
    assert [place_bits(n) for n in (0, 1, 1 << 24, (1 << 24) + 1, 1 << 30, 10**12, 10**18)] == [16, 16, 16, 17, 22, 32, 32]
    prints = chains()
    table = spark.createDataFrame([(p,) for p in prints], "print bigint")
    for width in (16, 20, 32):
        expected = [0] * len(prints)
        for i, p in enumerate(prints):
            value = p & (1 << 64) - 1
            while value:
                expected[i] ^= value & (1 << width) - 1
                value >>= width
        found = {r["print"]: r["place"] for r in table.select("print", place_of(table["print"], width).alias("place")).collect()}
        assert [found[p] for p in prints] == expected == places_of(np.array(prints), width).tolist()


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = prose(random.Random(6), 500).encode()
    whole = fingerprint(text, 4)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert fingerprint(text, 4) == whole


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 400)] + [(400, 399), (7, 7), (8, 7)]
    table = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in components(table, "t").collect()}
    assert {found[x] for x in range(100, 161)} == {100}
    assert {found[x] for x in (5, *range(200, 401))} == {5}
    assert found[7] == found[8] == 7
    assert components(table.limit(0), "t").collect() == []


def test_odd_documents(spark):
    rows = odd_documents()
    prints = [slow_print(text) for _, text, *_ in rows]
    roots = slow_components(prints)
    expected = []
    for i, (doc_id, *_) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if roots[j] == roots[i] and rows[j][0] is not None]
        expected.append((doc_id, signed(prints[i]), min(group, default=None)))
    found = near_duplicates(documents(spark, clashing=True)).select("_id", "print", "component")
    assert results(found) == sorted(expected, key=lambda row: [(v is None, str(v)) for v in row])


def test_one_of_each_group_stays(spark):
    docs = documents(spark, clashing=True)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    groups = near_duplicates(docs).select("first").distinct().count()
    assert len(texts) == groups
    # The copies 7, 8, 8 leave 7.
    ids = [r.doc_id for r in kept.collect()]
    assert 7 in ids and 8 not in ids


def test_repeated_row_stays_once(spark):
    row = (1, "one two three four five", "en", "a", 1)
    assert one_of_each(documents(spark, [row, row, row])).collect() == documents(spark, [row]).collect()


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    assert one_of_each(documents(spark, [])).collect() == []


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [slow_print(r.text) for r in rows]
    roots = slow_components(prints)
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    expected = {(r.doc_id, f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots)}
    found = entry_point.queries()["op9_simhash"](spark, sf)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert set(map(tuple, found.collect())) == expected and len(expected) == len(rows)
