"""Quality rules against a plain count and the exact binomial distribution."""

import math
import random
import re

import __spark_entry__ as entry_point
from cases import documents, labels, odd_documents, prose, results
from peerbench.llm.quality import RULES, binomial_tail, choose_cutoff, judge, keep_good, measure_text, needed_good, settings


def slow_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = {}
    for window in windows:
        times[window] = times.get(window, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
        len(re.findall("[A-Z]", text)),
        len(re.findall("[!?]", text)),
    )


def test_measures():
    random_ = random.Random(1)
    texts = [t or "" for _, t, *_ in odd_documents()]
    texts += ["a b c a b c", "a a a a", "a b c d", "x\x1cy\xa0z w\x85v", "\n\nq\n q\nq\n", "É É É É É"]
    texts += [" ".join(random_.choices("abc", k=random_.randint(0, 30))) for _ in range(200)]
    for text in texts:
        assert measure_text(text.encode()) == slow_measures(text)


def test_binomial_tail():
    for n, p in ((1, 0.5), (30, 0.1), (400, 0.01), (2000, 0.05)):
        total = 0.0
        for k in range(n + 1):
            total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if k >= n * p:
                break
            assert math.isclose(binomial_tail(k, n, p), total, rel_tol=1e-9)


def test_cutoffs_are_tested_from_the_loosest():
    cutoffs = (3.0, 2.0, 1.0)
    assert choose_cutoff(2000, [0, 1, 2], [5, 9, 20], cutoffs, 0.01, 0.01) == 1.0
    # The tightest rejects too many, the middle one catches nothing more.
    assert choose_cutoff(2000, [0, 1, 300], [5, 5, 90], cutoffs, 0.01, 0.01) == 3.0
    # A failure ends the sequence, whatever comes behind it.
    assert choose_cutoff(2000, [300, 0, 0], [5, 9, 20], cutoffs, 0.01, 0.01) is None
    assert choose_cutoff(10, [0, 0, 0], [5, 9, 20], cutoffs, 0.01, 0.01) is None
    assert choose_cutoff(0, [0, 0, 0], [0, 0, 0], cutoffs, 0.01, 0.01) is None


def test_odd_documents(spark):
    found = judge(documents(spark, clashing=True), labels(spark, [(1, 1, 0), (1, 0, 0), (5, 1, 0), (99, 1, 1)]))
    expected = []
    for doc_id, text, *_ in odd_documents():
        own = slow_measures(text)
        failed = own[0] < 50 or 100 * own[4] > 50 * own[0]
        # So few labels certify nothing.
        expected.append((doc_id, *own, failed, not failed))
    assert results(found.drop("_text")) == sorted(expected, key=lambda row: [(v is None, str(v)) for v in row])


def test_junk_is_rejected_and_good_texts_stay(spark):
    random_ = random.Random(7)
    rows, marks = [], []
    for i in range(4000):
        text = prose(random_, 60)
        bad = i % 10 == 0
        if bad:
            text = " ".join(word + "###" for word in text.split())
        rows.append((i, text, "en" if i % 4 else None, "s", 1))
        marks.append((i, int(not bad), 0))
    docs, known = documents(spark, rows), labels(spark, marks[:3600])
    kept = {r.doc_id for r in keep_good(docs, known).select("doc_id").collect()}
    english = [i for i in range(4000) if i % 4]
    assert not kept & {i for i in english if i % 10 == 0}
    assert kept >= {i for i in range(4000) if i % 10}


def test_small_strata_have_cutoffs(spark):
    random_ = random.Random(8)
    good = needed_good(4)
    assert good == 86 and 0.95**good <= 0.05 / 4 < 0.95 ** (good - 1)
    rows, marks = [], []
    for place, lang in enumerate(["en", "de", "fr", None]):
        # The last stratum has one good text too few.
        for i in range(good - (place == 3) + 10):
            text = prose(random_, 60)
            bad = i < 10
            rows.append((1000 * place + i, text.replace(" ", "### ") if bad else text, lang, "s", 1))
            marks.append((1000 * place + i, int(not bad), 0))
    kept = {r["_id"] for r in judge(documents(spark, rows), labels(spark, marks)).where("kept").collect()}
    assert kept == {i for i, known, _ in marks if known or i >= 3000}


def slow_kept(rows, marks):
    """Cutoffs by trying every setting on the distinct labelled texts of a stratum, without counting tables."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")
    label, both = {}, set()
    for doc_id, quality, _ in marks:
        if label.setdefault(doc_id, quality) != quality:
            both.add(doc_id)
    measured = {text: dict(zip(names, slow_measures(text))) for _, text, *_ in rows}

    def failed(text):
        m = measured[text]
        return m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]

    def over(text, rule, cutoff):
        amount, base, _ = RULES[rule]
        return measured[text][amount] / max(measured[text][base], 1) > cutoff

    known = {}
    for doc_id, text, lang, *_ in rows:
        if doc_id in label and doc_id not in both and not failed(text):
            known.setdefault(lang, {}).setdefault(text, set()).add(label[doc_id])
    cutoffs = {}
    for lang, texts in known.items():
        good = [t for t, kinds in texts.items() if kinds == {1}]
        bad = [t for t, kinds in texts.items() if kinds == {0}]
        best, most = None, 0
        for setting in settings():
            rules = [(r, RULES[r][2][k - 1]) for r, k in zip(RULES, setting) if k]
            lost = sum(any(over(t, *x) for x in rules) for t in good)
            tail = sum(math.comb(len(good), k) * 0.05**k * 0.95 ** (len(good) - k) for k in range(lost + 1))
            if not good or lost >= 0.05 * len(good) or tail > 0.05 / len(known):
                break
            hits = sum(any(over(t, *x) for x in rules) for t in bad)
            if hits > most:
                best, most = setting, hits
        chosen, left = {}, list(bad)
        for rule, k in zip(RULES, best or ()):
            hits = [sum(over(t, rule, c) for t in left) for c in RULES[rule][2][:k]]
            if hits and max(hits):
                chosen[rule] = RULES[rule][2][hits.index(max(hits))]
                left = [t for t in left if not over(t, rule, chosen[rule])]
        cutoffs[lang] = chosen
    return {
        (doc_id, text)
        for doc_id, text, lang, *_ in rows
        if not failed(text) and not any(over(text, *x) for x in cutoffs.get(lang, {}).items())
    }


def test_kept_rows_equal_a_plain_choice_of_cutoffs(spark):
    random_ = random.Random(12)
    rows, marks = [], []
    for i in range(1500):
        words = prose(random_, random_.randint(45, 80)).split()
        bad = random_.random() < 0.3
        kind = random_.choice(["symbols", "capitals", "lines", "plain"]) if bad else random_.choice(["plain"] * 30 + ["symbols"])
        if kind == "symbols":
            words = [w + "#" * (random_.random() < 0.5) for w in words]
        elif kind == "capitals":
            words = [w.upper() if random_.random() < 0.7 else w for w in words]
        text = " ".join(words)
        if kind == "lines":
            text = "\n".join([" ".join(words[:6])] * random_.randint(2, 4) + words)
        rows.append((i, text, random_.choice(["en", "en", "de", None]), "s", 1))
        marks.append((i, int(not bad), 0))
    # Copies of one good text, some labelled, and one labelled both ways.
    rows += [(2000 + i, rows[0][1], "en", "s", 1) for i in range(300)]
    marks += [(2000 + i, 1, 0) for i in range(300)] + [(5, 1, 0), (5, 0, 0)]
    found = judge(documents(spark, rows), labels(spark, marks))
    kept = {r["_id"] for r in found.where("kept").collect()}
    expected = {doc_id for doc_id, _ in slow_kept(rows, marks)}
    assert kept == expected and len(expected) < len(rows) - 200


def test_copies_are_no_independent_texts(spark):
    """Too few different good texts for a cutoff, however many copies there are."""
    random_ = random.Random(13)
    rows, marks = [], []
    for i in range(400):
        same = random.Random(i % 20)
        rows.append((i, prose(same, 60), "en", "s", 1))
        marks.append((i, 1, 0))
    for i in range(400, 440):
        rows.append((i, prose(random_, 60).replace(" ", "### "), "en", "s", 1))
        marks.append((i, 0, 0))
    assert judge(documents(spark, rows), labels(spark, marks)).where("kept").count() == 440


def test_settings_only_tighten():
    sequence = settings()
    assert len(sequence) == sum(len(cutoffs) for _, _, cutoffs in RULES.values())
    before = (0,) * len(RULES)
    for setting in sequence:
        assert sorted(b - a for a, b in zip(before, setting)) == [0] * (len(RULES) - 1) + [1]
        before = setting
    assert before == tuple(len(cutoffs) for _, _, cutoffs in RULES.values())


def test_kept_rows_have_all_columns(spark):
    docs = documents(spark, clashing=True)
    kept = keep_good(docs, labels(spark))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {
        r["_id"] for r in judge(docs, labels(spark)).where("kept").collect()
    }


def test_empty_tables(spark):
    assert judge(documents(spark, []), labels(spark)).collect() == []
    assert keep_good(documents(spark, []), labels(spark, [(1, 1, 1)])).collect() == []


def test_rules_go_from_loose_to_tight():
    for _, _, cutoffs in RULES.values():
        assert list(cutoffs) == sorted(cutoffs, reverse=True)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in entry_point.queries()["op2_quality_rules"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        own = slow_measures(r.text)
        row = found.pop(r.doc_id)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == own[:5]
        assert row.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (row.base_failed and row.kept)
    assert not found
