"""The pipeline's stages against what their operators' brute-force versions keep."""

import corpus_pipeline as pipeline
from test_operators import brute_components, shingle_set

SMALL = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        steps.append({r.doc_id: r for r in docs.collect()})
    quality, lines, near, clean, coded = steps
    bad = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").collect()}
    assert len(bad & set(quality)) <= 0.05 * len(bad) and len(good - set(quality)) <= 0.02 * len(good)
    assert set(lines) == set(quality)
    assert all(set(r.text.split("\n")) <= set(quality[i].text.split("\n")) and r.n_chars == len(r.text) for i, r in lines.items())
    want = brute_components([(i, r.text) for i, r in lines.items()])
    assert set(near) == {i for i, (_, c) in want.items() if c == i}
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {i for i, r in near.items() for t in items if len(shingle_set(r.text) & t) >= 0.8 * len(t)}
    assert leaked and set(clean) == set(near) - leaked
    assert set(coded) == set(clean) and all(r.n_tokens == len(r.ids) for r in coded.values())


def test_no_text_is_lost_with_a_repeated_id(spark):
    a, b, u, v = (" ".join(f"{x}{k}" for k in range(40)) for x in "abuv")
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (5, u), (5, v), (None, u), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.text for r in pipeline.near_duplicate_removal(spark, docs, "").collect()]
    assert sorted(t for t in kept if t in (a, u, v)) == [a, u, v] and sum(t in (b, b + " more") for t in kept) == 1 and None in kept and len(kept) == 5
