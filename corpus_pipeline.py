"""The corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, encoding.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and, but for the
last, returns the columns of ``documents``.  The operators are used with the parameters of their own
queries.  No stage but the quality filter, the near-duplicate join (one document of each group
stays) and decontamination (documents that hold a test item go) drops a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinseq.llm.common import crc_mod, drop_path, materialise, table, with_row_keys, without
from kinseq.llm.decontaminate import leaks
from kinseq.llm.ngram_join import near_duplicates
from kinseq.llm.quality import keep_good
from kinseq.llm.queries import tokenizer_path
from kinseq.llm.sentencepiece_bpe import encode
from kinseq.llm.template_lines import drop_template_lines


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.  Null and empty texts are scored like any; repeated
    rows, with or without an id, score alike; without labels nothing is rejected."""
    return keep_good(docs, table(spark, sf_dir, "labels"), F.coalesce(crc_mod("doc_id", 5) != 0, F.lit(False)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates are cut; every row stays, with its new length.  Null texts stay null; a
    text all of whose lines go becomes empty."""
    out = drop_template_lines(docs)
    changed = F.size("dropped") > 0
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of near duplicates stays (of one id's texts the first by hash).
    Components are of rows, so texts that only share an id are judged apart and every distinct text stays
    once, copies without an id go like others, and rows equal in id and text are one.  Null and empty
    texts are linked with nothing."""
    rows = with_row_keys(docs, "_row")
    found = near_duplicates(rows, "_row")
    gone = materialise(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_row")).distinct(), "gone")
    return without(rows, gone, "_row").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, whatever their ids: a leak belongs to a text, and texts are
    told apart by their 64-bit hash.  Null and empty texts stay; repeated rows stay or go together."""
    rows = docs.withColumn("_text", F.xxhash64("text"))
    found = leaks(rows, table(spark, sf_dir, "benchmark"), id_col="_text")
    return without(rows, materialise(found.select(F.col("doc_id").alias("_text")).distinct(), "leaked"), "_text").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document that is left: the ids, and the digest
    of the text they are decoded to again.  Null texts are encoded as empty ones."""
    out = encode(docs, tokenizer_path(), decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate_removal),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: SQL cannot express the classifier; tests/llm/test_pipeline.py compares with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name.split()[0].lower())
        if k:
            drop_path(spark, before._path)
    return STAGES[-1][1](spark, docs, sf_dir)
