"""Mixing against a plain computation and its SQL."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import __spark_entry__ as entry_point
from cases import documents, odd_documents, results
from compare import differences, engine
from peerbench.llm.mixing import mix, mixed_rows


def slow_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        free = sum(weight[s] for s in order if s not in full)
        budget = total - sum(3 * sizes[s] for s in full)
        more = {s for s in order if s not in full and weight[s] * budget > 3 * sizes[s] * free}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * budget / free for s in order}
        full |= more


def slow_mix(rows):
    size, key, sizes = [], [], defaultdict(int)
    for doc_id, text, _, source, _ in rows:
        text = text or ""
        words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        named = ["mix-1"] + ([str(doc_id)] if doc_id is not None else []) + [hashlib.md5(text.encode()).hexdigest()]
        u = (int(hashlib.md5(":".join(named).encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        size.append(words)
        key.append(-math.log(u) / ((words + 1) / (words + 1 + symbols)))
        sizes[source] += words
    targets = slow_targets(sizes)
    taken = {}
    for source, target in targets.items():
        epochs = math.floor(target / sizes[source]) if sizes[source] else 0
        rest = target - epochs * sizes[source]
        by_key = defaultdict(list)
        for i, row in enumerate(rows):
            if row[3] == source:
                by_key[key[i]].append(i)
        before = 0
        for k in sorted(by_key):
            words = sum(size[i] for i in by_key[k])
            for i in by_key[k]:
                taken[i] = size[i] * (epochs + (2 * before + words <= 2 * rest))
            before += words
    return [(r[0], size[i], sizes[r[3]], targets[r[3]], taken[i]) for i, r in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_odd_documents(spark):
    assert results(mix(documents(spark, clashing=True))) == ordered(slow_mix(odd_documents()))


def test_targets_are_reached_and_limits_kept(spark):
    rows = [(i, "w " * (i % 40 + 1), "en", f"s{i % 7}" if i % 3 else "s0", 1) for i in range(900)]
    rows += [(2000, "only three words", "en", "tiny", 1)]
    found = mix(documents(spark, rows)).collect()
    assert ordered(map(tuple, found)) == ordered(slow_mix(rows))
    source = {r[0]: r[3] for r in rows}
    taken, target = Counter(), {}
    for r in found:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    assert math.isclose(sum(target.values()), sum(r.size for r in found))


def test_target_in_a_cell_with_most_of_a_source(spark):
    """Symbols make the weights small, so nearly all keys of the larger source fall into the last cell."""
    rows = [(i, "# " * 60 + "w " * (i % 5 + 1), "en", "a", 1) for i in range(3000)]
    rows += [(5000 + i, "word " * 4, "en", "b", 1) for i in range(300)]
    assert ordered(map(tuple, mix(documents(spark, rows)).collect())) == ordered(slow_mix(rows))


def test_equal_rows_at_the_target_are_taken_together(spark):
    rows = [(1, "one two three", "en", "a", 1)] * 500 + [(i, "w " * 9, "en", "b", 1) for i in range(2, 40)]
    assert ordered(map(tuple, mix(documents(spark, rows)).collect())) == ordered(slow_mix(rows))


def test_reruns_agree_whatever_the_partitions(spark):
    docs = documents(spark)
    assert results(mix(docs)) == results(mix(docs.repartition(5)))


def test_rows_are_repeated_as_often_as_taken(spark):
    docs = documents(spark, clashing=True)
    mixed = mixed_rows(docs)
    assert mixed.columns == docs.columns
    counted = Counter((r.doc_id, r.text) for r in mixed.collect())
    expected = Counter()
    for (doc_id, text, *_), (_, size, _, _, taken) in zip(odd_documents(), slow_mix(odd_documents())):
        if size:
            expected[doc_id, text] += taken // size
    assert counted == +expected


def test_better_documents_come_earlier(spark):
    rows = [(i, "word " * 20 + "# " * (20 if i % 2 else 0), "en", "a" if i % 10 else "b", 1) for i in range(4000)]
    # The larger source (1,600 good documents, 2,000 with many symbols) is cut; of the good ones more are left.
    taken = [r.doc_id for r in mix(documents(spark, rows)).where("taken > 0").collect() if r.doc_id % 10]
    junk = sum(i % 2 for i in taken)
    assert 2000 < len(taken) < 3600
    assert junk / 2000 < (len(taken) - junk) / 1600 - 0.05


def test_empty_tables(spark):
    assert mix(documents(spark, [])).collect() == []
    assert mixed_rows(documents(spark, [])).collect() == []
    nothing = documents(spark, [(1, None, None, "a", None), (2, "", None, None, 0)])
    assert {r.taken for r in mix(nothing).collect()} == {0}


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    for name in ("op3_secrets", "op4_mixing"):
        sql = entry_point.oracle_sql()[name]
        assert differences(entry_point.queries()[name](spark, sf), engine(sf), sql) == []
