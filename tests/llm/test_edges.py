"""Every operator and stage on awkward rows and on empty tables."""

import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rpartition("/")[0])
from edge_rows import edge_docs, empty_docs  # noqa: E402

import corpus_pipeline  # noqa: E402
from kinseq.llm.common import crc_mod  # noqa: E402
from kinseq.llm.queries import tokenizer_path  # noqa: E402


def op1(docs):
    from kinseq.llm.substring_dedup import remove_repeats

    return remove_repeats(docs)


def op2(docs):
    from kinseq.llm.ngram_join import near_duplicates

    return near_duplicates(docs)


def op3(docs):
    from kinseq.llm.lm_score import score_texts

    return score_texts(docs, F.coalesce(crc_mod("doc_id", 7) != 2, F.lit(True)))


def op4(docs):
    from kinseq.llm.quality import score_quality

    labels = docs.sparkSession.createDataFrame([(1, 1), (7, 0), (8, 1), (12, 0), (99, 1), (None, 1), (2, None)], "doc_id long, quality int")
    return score_quality(docs, labels, F.lit(True))


def op5(docs):
    from kinseq.llm.language_id import identify

    return identify(docs, F.lit(True))


def op8(docs):
    from kinseq.llm.template_lines import drop_template_lines

    return drop_template_lines(docs)


def op10(docs):
    from kinseq.llm.sentencepiece_bpe import digests

    return digests(docs, tokenizer_path())


@pytest.mark.parametrize("op", [op1, op2, op3, op4, op5, op8, op10])
def test_one_row_for_each(spark, op):
    docs = edge_docs(spark)
    got = [r.doc_id for r in op(docs).select("doc_id").collect()]
    assert sorted(got, key=str) == sorted((r.doc_id for r in docs.collect()), key=str)
    assert op(empty_docs(spark)).count() == 0


def test_results_on_edges(spark):
    docs = edge_docs(spark)
    two = {r.doc_id: r for r in op2(docs).collect()}
    assert two[3].n_shingles == two[4].n_shingles == two[5].n_shingles == 0 and two[6].n_shingles == 1
    assert two[2].component_id == 1 and two[3].component_id == 3 and two[6].component_id == 6
    three = {r.doc_id: r for r in op3(docs).collect()}
    assert three[3].n_tokens == three[4].n_tokens == 1
    five = {r.doc_id: r for r in op5(docs).collect()}
    assert all(five[i].lang_pred == "und" and five[i].score == 0.0 for i in (3, 4, 5, 7))
    one = {r.doc_id: r for r in op1(docs).collect() if r.doc_id is not None}
    assert [(s.start, s.end, s.kept_in, s.passage_words) for s in (one[2].removed[0], one[2].removed[-1])] in ([(0, 86, 1, 16)] * 2, [(0, one[2].removed[0].end, 1, 16), (one[2].removed[-1].start, 86, 1, 16)]) and one[2].text == "" and one[3].text is None
    assert one[11].n_units == 5 and one[11].text == "a\n\n\nb\n"
    assert all(r.removed == [] for i, r in one.items() if i != 2)


def test_searches_on_edges(spark):
    from kinseq.llm.decontaminate import leaks
    from kinseq.llm.html_text import extract

    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "beta gamma delta epsilon zeta eta"), (2, None), (3, ""), (None, "one"), (4, "one"), (4, "one")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in leaks(docs, items).collect()) == [(1, 1), (2, 1), (6, 4)]
    assert leaks(empty_docs(spark), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 1), (2, None, "", 1), (3, "u", "<p>unclosed " + "long " * 30, 1), (4, "u", "<!-- open <p>x", 1), (None, "u", "<article><p>a &amp; b", 1)], "page_id long, url string, html string, text long")
    got = {(r.page_id, r.text) for r in extract(pages).collect()}
    assert (1, "") in got and (2, "") in got and (4, "") in got and (None, "a & b") in got
    assert extract(pages.limit(0)).count() == 0


def test_vectors_on_edges(spark):
    from kinseq.llm.hilbert_ann import nearest_neighbours

    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (200, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, rep string, query long")
    got = nearest_neighbours(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got if r.query_id == 100][:2] == [(1, 1, 0.0), (2, 2, 0.0)]
    assert [r.vec_id for r in got if r.query_id == 100] == [1, 2, 200, 3]
    assert [r.vec_id for r in got if r.query_id == 200] == [1, 2, 3, 100]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_edges(spark, tmp_path, name, stage):
    spark.createDataFrame([(1, 1, 0), (7, 0, 0), (12, 0, 0), (8, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "beta gamma delta epsilon zeta eta"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = edge_docs(spark)
    out = stage(spark, docs, str(tmp_path))
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == docs.columns
    if name == "n-gram Jaccard join":
        assert sorted(i for i in ids if i is not None) == [1, *range(3, 13)] and ids.count(None) == 1
    if name == "benchmark decontamination":
        assert 1 not in ids and 2 not in ids and len(ids) == 11  # the leaked text without an id goes too
    if name == "line dedup":
        assert len(ids) == 14
    assert stage(spark, empty_docs(spark), str(tmp_path)).count() == 0
