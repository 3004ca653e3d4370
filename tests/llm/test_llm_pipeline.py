"""The pipeline against its operators applied one after another on the driver."""

import hashlib
import random

import corpus_pipeline
import __spark_entry__ as entry_point
import pytest
import tiktoken
from cases import odd_documents, prose
from peerbench.llm.byte_bpe import RANKS, read_ranks
from peerbench.llm.pii import pseudonyms
from test_llm_mixing import slow_mix
from test_llm_quality import slow_measures
from test_llm_simhash import slow_components, slow_print
import public_tokenizers

SF = "/root/testdata/sf0.001"


def write(spark, folder, rows, extra=""):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).selectExpr("*", *([extra] if extra else [])).write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def slow_pipeline(spark, rows):
    """Without labels the quality rules are the base rules."""
    good = []
    for row in rows:
        own = slow_measures(row[1])
        if own[0] >= 50 and 100 * own[4] <= 50 * own[0]:
            good.append(row)
    prints = [slow_print(row[1]) for row in good]
    roots = slow_components(prints)
    named = {}
    for i, root in enumerate(roots):
        rank = (good[i][0] is not None, good[i][0] or 0)
        if root not in named or rank < named[root][0]:
            named[root] = (rank, i)
    kept = [good[i] for _, i in sorted(named.values(), key=lambda x: x[1])]
    table = spark.createDataFrame([(i, row[1]) for i, row in enumerate(kept)], "doc_id int, text string")
    texts = {r.doc_id: r.text for r in pseudonyms(table).collect()}
    hidden = [(row[0], texts[i], *row[2:]) for i, row in enumerate(kept)]
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(public_tokenizers.path(RANKS)), special_tokens={},
    )
    expected = []
    for (doc_id, text, *_), (_, size, _, _, taken) in zip(hidden, slow_mix(hidden)):
        ids = encoding.encode_ordinary(text)
        digest = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), text.encode())]
        expected += [(doc_id, len(ids), *digest)] * (taken // size)
    return expected


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: [(v is None, str(v)) for v in row])


def test_odd_documents(spark, tmp_path):
    rows = [r for r in odd_documents()]
    rows += [(50, rows[0][1] + " 97.51.17.173 jane.doe@mail.example.com", "en", "c", 1), (51, rows[0][1], "en", "c", 1)]
    folder = write(spark, tmp_path, rows, "'mine' AS kept")
    assert ordered(corpus_pipeline.run(spark, folder).collect()) == ordered(slow_pipeline(spark, rows))


def test_given_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [tuple(r) for r in docs.collect()]
    folder = write(spark, tmp_path, rows)
    assert ordered(corpus_pipeline.run(spark, folder).collect()) == ordered(slow_pipeline(spark, rows))


def test_quality_stage_uses_labels(spark, tmp_path):
    random_ = random.Random(4)
    texts = [prose(random_, 60) for _ in range(130)]
    rows = [(i, t.replace(" ", "### ") if i < 30 else t, "de", "a", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    marks = [(i, int(i >= 30), 0) for i in range(10, 130)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(30, 130))


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [])).collect() == []


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, SF)
        assert result.columns == docs.columns
        assert [f.dataType for f in result.schema] == [f.dataType for f in docs.schema]


@pytest.mark.parametrize("name", ["pipeline", *[f"op{n}_" for n in range(1, 11)]])
def test_registered(name):
    assert sum(q == name or q.startswith(name) for q in entry_point.queries()) == 1
