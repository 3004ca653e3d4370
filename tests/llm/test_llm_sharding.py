"""Sharding: a law of counts, gapless slots, nothing lost, and an order that is random and can be repeated."""

import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry_point
from cases import documents, odd_documents, results
from peerbench.llm import sharding as sh


def check_law(rows, shards=16):
    slots = defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert set(slots) <= set(range(shards))


def test_odd_documents_keep_all_rows_and_columns(spark):
    docs = documents(spark, clashing=True)
    rows = sh.shuffled_shards(docs).collect()
    check_law(rows)
    assert rows[0]["row"].__fields__ == docs.columns
    assert Counter(tuple(r["row"]) for r in rows) == Counter(map(tuple, docs.collect()))


def test_digests(spark):
    rows = sh.shard_digests(documents(spark, clashing=True)).collect()
    check_law(rows)
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_documents())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


@pytest.mark.parametrize("shards, count", [(1, 5), (3, 10), (16, 7), (16, 1003), (7, 700)])
def test_counts_differ_by_one_at_most(spark, shards, count):
    rows = sh.shuffled_shards(documents(spark, [(i, "t", "en", "s", 1) for i in range(count)]), shards=shards).collect()
    assert len(rows) == count
    check_law(rows, shards)


def test_equal_rows_are_spread_over_all_buckets(spark):
    same = [(None, "copy", "en", "s", 1)] * 3000
    rows = sh.shuffled_shards(documents(spark, same + [(i, "other", "en", "s", 1) for i in range(1500)])).collect()
    check_law(rows)
    copies = Counter(r["shard"] for r in rows if r["row"]["text"] == "copy")
    assert min(copies.values()) > 130 and max(copies.values()) < 240


def test_buckets_follow_the_bytes(spark):
    docs = documents(spark, [(i, "x" * 1000, "en", "s", 1) for i in range(2000)])
    # 2 MB in buckets of 4 KB: about 64 buckets in each of 8 tasks.
    rows = sh.shuffled_shards(docs, bucket_bytes=4096).collect()
    check_law(rows)
    assert Counter(r["row"]["doc_id"] for r in rows) == Counter(range(2000))


def test_order_is_random(spark):
    rows = sh.shuffled_shards(documents(spark, [(i, "t", "en", "s", 1) for i in range(4000)]), shards=1).collect()
    order = [r["row"]["doc_id"] for r in sorted(rows, key=lambda r: r["slot"])]
    rising = sum(a < b for a, b in zip(order, order[1:]))
    assert 1880 < rising < 2120
    far = sum(abs(i - doc) for i, doc in enumerate(order)) / 4000
    assert 1200 < far < 1470


def test_same_files_and_seed_give_the_same_shards(spark, tmp_path):
    path = str(tmp_path / "docs")
    documents(spark, [(i, "word " * (i % 9), "en", "s", 1) for i in range(900)]).repartition(3).write.parquet(path)

    def order(seed, split):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        docs = spark.read.parquet(path)
        rows = sh.shuffled_shards(docs, seed=seed, place=sh.file_place(docs)).collect()
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        return sorted((r["shard"], r["slot"], r["row"]["doc_id"]) for r in rows)

    first = order(13, "128m")
    assert order(13, "2k") == first
    assert order(14, "128m") != first


def test_written_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    docs = documents(spark)
    written = sh.write_shards(docs, path, shards=4)
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()} == {f"shard={s}" for s in range(4)}
    assert results(written.select("row.*")) == results(docs)
    check_law(written.collect(), 4)
    # Slots rise within every file.
    for part in (tmp_path / "shards").rglob("*.parquet"):
        slots = [r.slot for r in spark.read.parquet(str(part)).collect()]
        assert slots == sorted(slots)


def test_fisher_yates_is_a_permutation_of_its_own_for_every_bucket():
    orders = [sh.permutation(13, bucket, 50).tolist() for bucket in range(20)]
    assert all(sorted(order) == list(range(50)) for order in orders)
    assert len(set(map(tuple, orders))) == 20
    assert sh.permutation(13, 4, 50).tolist() == orders[4]


def test_empty_table(spark):
    assert sh.shard_digests(documents(spark, [])).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = entry_point.queries()["op13_sharding"](spark, sf).collect()
    check_law(rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
