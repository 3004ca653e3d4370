"""Language identification and toxicity: exactness of the parts, held-out accuracy, odd cases."""

import random
import zlib

import numpy as np
from cases import documents, labels, odd_documents, peak_megabytes, prose, results
from peerbench.llm.langid import Profiler, identify, learn
from peerbench.llm.toxicity import (
    COUNTERFACTUAL, IDENTITY, RIDGE, Model, Reader, classify, fit, lines_of, readings, score, significant, train,
)

SF = "/root/testdata/sf0.1"


def held(doc_id, folds, which):
    return zlib.crc32(str(doc_id).encode()) % folds == which if doc_id is not None else False


def slow_bundle(profiler, text):
    letters, total = [0], np.zeros(profiler.dimensions)
    for char in text.lower():
        code = ord(char) if char.isalpha() else 0
        if code or letters[-1]:
            letters.append(code)
    if letters[-1]:
        letters.append(0)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        va, vb, vc = (profiler.letter_vector(x).astype(int) for x in (a, b, c))
        total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total


def test_bundles_equal_the_definition():
    profiler = Profiler()
    texts = ["Hello, World", "", "a", "12", "ñandú  über", "the the", "日本語", "x"]
    found = profiler.bundles(texts)
    for text, row in zip(texts, found):
        assert (row == slow_bundle(profiler, text)).all()
    grouped = profiler.bundles(texts, np.array([0, 1, 0, 1, 0, 1, 0, 1]), 2)
    assert (grouped[0] == found[::2].sum(axis=0)).all()


def test_large_alphabets_give_the_same():
    profiler = Profiler()
    text = "".join(chr(0x4E00 + 7 * i % 3000) for i in range(900))
    assert (profiler.bundles([text, "abc"])[0] == slow_bundle(profiler, text)).all()


def test_many_different_ngrams_in_blocks(monkeypatch):
    from peerbench.llm import langid

    profiler = Profiler()
    random_ = random.Random(4)
    texts = ["".join(chr(0x4E00 + random_.randrange(900)) for _ in range(700)), "abc abc", ""]
    whole = profiler.bundles(texts)
    monkeypatch.setattr(langid, "GRAMS_TOGETHER", 100)
    monkeypatch.setattr(langid, "EXACT", 1)
    assert (profiler.bundles(texts) == whole).all() and (whole[0] == slow_bundle(profiler, texts[0])).all()


def test_a_text_of_ten_megabytes_of_different_ngrams_stays_small():
    random_ = random.Random(5)
    text = "".join(map(chr, random_.choices(range(0x4E00, 0x9F00), k=3_400_000)))
    assert len(text.encode()) > 10_000_000
    profiler = Profiler()
    peak, found = peak_megabytes(lambda: profiler.bundles([text]))
    assert found.any() and peak < 1000


def slow_languages(docs, fold, which):
    """Prototypes as sums of the definition's bundles, and the first of the languages with the largest cosine."""
    profiler, sums = Profiler(), {}
    for doc_id, text, lang, *_ in docs:
        if lang is not None and text is not None and not held(doc_id, fold, which):
            sums[lang] = sums.get(lang, 0) + slow_bundle(profiler, text)
    found = []
    for doc_id, text, *_ in docs:
        own = slow_bundle(profiler, text or "")
        length = np.linalg.norm(own)
        cosines = {k: own @ v / np.linalg.norm(v) / length for k, v in sums.items()} if length else {}
        best = min(cosines, key=lambda k: (-round(cosines[k], 9), k), default="und")
        found.append((doc_id, best, round((1 + cosines[best]) / 2, 6) if cosines else 0.0))
    return found


def test_predictions_equal_the_definition(spark):
    docs = [r for r in odd_documents() if r[0] not in (5, 6)] + [(200 + i, f"der die das {i} und", "de", "a", 1) for i in range(9)]
    got = identify(documents(spark, docs)).collect()
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.lang_pred, round(r.score, 6)) for r in got), key=key) == sorted(slow_languages(docs, 3, 1), key=key)


def test_prototypes_do_not_depend_on_the_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    one, two = (learn(docs.repartition(n), "doc_id", "text", "lang") for n in (1, 7))
    assert one[0] == two[0] and (one[1] == two[1]).all()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 3000
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_cases(spark):
    rows = {(r.doc_id, r.held_out, r.lang_pred) for r in identify(documents(spark, clashing=True)).collect()}
    assert len(identify(documents(spark)).collect()) == len(odd_documents())
    assert {p for i, _, p in rows if i in (2, 3, 4)} == {"und"}
    assert all(h == held(i, 3, 1) for i, h, _ in rows)
    assert {p for *_, p in rows} <= {"en", "de", "es", "und"}


def test_language_without_teachers(spark):
    docs = documents(spark, [(1, "some text", None, "a", 1), (None, None, None, None, None)])
    assert {(r.lang_pred, r.score) for r in identify(docs).collect()} == {("und", 0.0)}
    assert identify(documents(spark, [])).collect() == []


def test_toxicity_of_held_out_documents(spark):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = classify(docs, known).join(known, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in toxic]) > 0.9
    assert np.mean([r.predicted for r in clean]) < 0.01


def toxic_texts(random_, names, n, share):
    """Insults make a text toxic; names of groups stand in most toxic texts, but in clean ones too."""
    rows, marks = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(random_, 30).split()
        if toxic:
            words.insert(5, random_.choice(["dreckly", "mopish"]))
        if random_.random() < (share if toxic else 0.05):
            words.insert(9, random_.choice(names))
        rows.append((i, " ".join(words), "en", "a", 1))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def test_names_of_groups_alone_are_not_toxic(spark):
    rows, marks = toxic_texts(random.Random(2), ["muslim", "christian"], 1200, 0.9)
    docs, known = documents(spark, rows), labels(spark, marks)
    model = fit(docs, known)
    neutral = [(1, "our muslim neighbours came", "en", "a", 1), (2, "our christian neighbours came", "en", "a", 1)]
    neutral += [(3, "our neighbours came", "en", "a", 1), (4, "you dreckly neighbours", "en", "a", 1)]
    found = {r["_id"]: r.score for r in score(documents(spark, neutral), model).collect()}
    assert abs(found[1] - found[2]) < 0.05
    assert found[4] > 0.3 > max(found[1], found[2], found[3])


def packed(*features):
    return np.array(features, dtype=np.int32).tobytes()


def slow_fit(rows, width, counterfactual):
    """The penalised likelihood minimised with dense matrices."""
    texts = [r for r in rows if r["toxic"] is not None]
    x = np.zeros((len(texts), width + 1))
    for i, r in enumerate(texts):
        x[i, np.frombuffer(r["packed"], np.int32)] = 1
    x[:, -1] = 1
    y, n = (np.array([r[c] for r in texts], dtype=float) for c in ("toxic", "n"))
    penalty = np.diag([RIDGE] * width + [0.0])
    for r in rows:
        if r["toxic"] is None:
            d = np.zeros(width + 1)
            for f in np.frombuffer(r["packed"], np.int32):
                d[abs(f) - 1] = np.sign(f)
            penalty += 2 * counterfactual * r["n"] * r["share"] * np.outer(d, d)
    w = np.zeros(width + 1)
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(width + 1), x.T @ (n * (p - y)) + penalty @ w)
        w -= step * min(1, 1 / np.abs(step).max())
    return w


def test_the_fit_equals_a_dense_one():
    random_ = random.Random(7)
    rows = [
        {"packed": packed(*sorted(random_.sample(range(9), random_.randint(0, 5)))), "toxic": random_.randint(0, 1), "n": random_.randint(1, 4), "share": 1.0}
        for _ in range(60)
    ]
    rows += [{"packed": packed(3, -5), "toxic": None, "n": 7, "share": 0.5}, {"packed": packed(9), "toxic": None, "n": 2, "share": 1.0}]
    for strength in (0.0, COUNTERFACTUAL):
        model = train(list(rows), np.arange(9), strength)
        expected = slow_fit(rows, 9, strength)
        assert np.allclose(np.append(model.weights, model.bias), expected, atol=1e-5)


def test_a_swapped_name_changes_the_score_less_with_the_penalty():
    """One name only in toxic texts, the other only in clean ones: without the penalty it would decide."""
    rows = [{"packed": packed(0, 2), "toxic": 1, "n": 40, "share": 1.0}, {"packed": packed(1), "toxic": 0, "n": 60, "share": 1.0}]
    rows += [{"packed": packed(-1, 2), "toxic": None, "n": 40, "share": 1.0}, {"packed": packed(1, -2), "toxic": None, "n": 60, "share": 1.0}]
    free, held_down = train(rows, np.arange(3), 0.0), train(rows, np.arange(3), COUNTERFACTUAL)
    gap = lambda m: abs(m.weights[0] - m.weights[1])
    assert gap(held_down) < 0.2 * gap(free)


def test_readings_swap_through_all_members_of_a_line():
    words = Reader().words("our Muslim neighbours")
    swapped, put_in = readings(words, "our Muslim neighbours", lines_of())
    line = next(l for l in IDENTITY if "muslim" in l)
    assert [w - {"our", "neighbours"} for w in swapped] == [{n} for n in line if n != "muslim"]
    assert any({next(iter(w - words), "muslim") for w in put_in} == set(l) | ({"muslim"} & set(l)) for l in IDENTITY)
    [alone] = readings({"plain", "words"}, "plain words", lines_of())
    assert any([w - {"plain", "words"} for w in alone] == [{n} for n in l] for l in IDENTITY)


def test_lines_name_no_group_twice():
    assert all(len(set(line)) == len(line) > 1 for line in IDENTITY)
    assert all(name == name.lower() and Reader().words(name) == {name} for line in IDENTITY for name in line)


def test_significant_features_follow_the_data(spark):
    rows = [("bad word", 1)] * 30 + [("fine word", 0)] * 50 + [("rare", 1)]
    known = spark.createDataFrame([(t.encode(), x) for t, x in rows], "text binary, toxic int")
    reader = Reader()
    found = {r["hash"] for r in significant(known, (50, 31), 5.0).collect()}
    # Both kinds count: words of toxic texts and words of clean ones.
    assert found == reader.features({"bad"}) | reader.features({"fine"})


def test_neutral_mentions_are_not_toxic_on_the_given_texts(spark):
    """On the given labels the penalty acts: names of groups change scores with it less than without."""
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    frames = ("our {} neighbours came to dinner", "nach dem essen kamen {} leute", "des voisins {} sont venus", "unos vecinos {} vinieron")
    names = [name for line in IDENTITY for name in line]
    texts = [f.format(n) for f in frames for n in ["", *names]]
    sentences = documents(spark, [(i, text, "en", "a", 1) for i, text in enumerate(texts)])

    def shift(strength):
        scores = {r["_id"]: r.score for r in score(sentences, fit(docs, known, counterfactual=strength)).collect()}
        size = len(names) + 1
        return max(abs(scores[k * size + i] - scores[k * size]) for k in range(len(frames)) for i in range(size))

    free, held_down = shift(0.0), shift(COUNTERFACTUAL)
    assert free > 0.01 and held_down < 0.1 * free


def test_toxicity_odd_cases(spark):
    docs = documents(spark, clashing=True)
    known = labels(spark, [(1, 1, 0), (5, 1, 1), (5, 1, 0), (7, 0, 1), (None, 1, 1), (20, 1, None)])
    rows = classify(docs, known).collect()
    assert len(rows) == len(odd_documents())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in rows)
    assert {r.score for r in classify(docs, labels(spark)).collect()} == {0.0}
    assert classify(documents(spark, []), labels(spark)).collect() == []


def test_labels_of_held_out_documents_teach_nothing(spark):
    rows, marks = toxic_texts(random.Random(3), ["woman"], 400, 0.5)
    docs = documents(spark, rows)
    wrong = [(i, q, 1 - t if held(i, 4, 2) else t) for i, q, t in marks]
    assert results(classify(docs, labels(spark, marks))) == results(classify(docs, labels(spark, wrong)))


def test_nothing_to_train_on():
    model = train([], np.arange(3))
    assert isinstance(model, Model) and not len(model.weights) and model.bias == 0.0
