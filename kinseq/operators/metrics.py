"""Evaluation of logits and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinseq.functions.geometry import softmax


def ranked(logits: Column) -> Column:
    """(s, id) best first, ties by the smaller id."""
    pairs = F.transform(logits, lambda x, i: F.struct(x.cast("double").alias("s"), i.alias("id")))
    return F.array_sort(pairs, lambda a, b: F.when(a["s"] > b["s"], -1).when(a["s"] < b["s"], 1).otherwise(a["id"] - b["id"]))


def argmax(logits: Column) -> Column:
    """TOP1: the first of the largest."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def top_k(logits: Column, k: int = 3) -> Column:
    """TOP2: (id, score) of the k best; scores are a softmax over those k alone."""
    best = F.slice(ranked(logits), 1, k)
    scores = softmax(F.transform(best, lambda p: p["s"]))
    return F.transform(best, lambda p, i: F.struct(p["id"].alias("id"), F.get(scores, i).alias("score")))


def in_top_k(logits: Column, label: Column, k: int) -> Column:
    """TOP3: whether the label is among the k best (all classes if there are fewer)."""
    return F.array_contains(F.transform(F.slice(ranked(logits), 1, k), lambda p: p["id"]), label)


def accuracy(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """AGG4"""
    return df.agg(F.avg((F.col(pred) == F.col(label)).cast("int")).alias("accuracy"))


def top_k_accuracy(df: DataFrame, logits: str, label: str, ks=(3, 5, 10)) -> DataFrame:
    """AGG6"""
    return df.agg(*[F.avg(in_top_k(F.col(logits), F.col(label), k).cast("int")).alias(f"top_{k}") for k in ks])


def class_counts(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """(cls, tp, predicted, support) of every class in labels or predictions, in one shuffle."""
    sides = F.explode(F.array(F.struct(F.col(label).alias("cls"), F.lit(1).alias("s"), F.lit(0).alias("p")), F.struct(F.col(pred).alias("cls"), F.lit(0).alias("s"), F.lit(1).alias("p")))).alias("x")
    hit = (F.col(pred) == F.col(label)).cast("int")
    rows = df.select(sides, hit.alias("hit"))
    return rows.groupBy(F.col("x.cls").alias("cls")).agg(F.sum(F.col("hit") * F.col("x.s")).alias("tp"), F.sum("x.p").alias("predicted"), F.sum("x.s").alias("support"))


def macro_scores(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    """AGG5: macro precision, recall and F1 (the mean of the classes' F1), 0 where undefined."""
    c = class_counts(df, pred, label)
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    each = c.withColumns({"p": share("tp", "predicted"), "r": share("tp", "support")})
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
    return each.agg(F.avg("p").alias("precision"), F.avg("r").alias("recall"), F.avg(f1).alias("f1"))


def confusion_matrix(df: DataFrame, classes: int, pred: str = "pred", label: str = "label", normalise: bool = False) -> DataFrame:
    """AGG7: all classes by all classes, zeros included; or shares of the grand total."""
    spark = df.sparkSession
    ids = spark.range(classes).select(F.col("id").cast("int").alias("label"))
    cells = ids.crossJoin(ids.withColumnRenamed("label", "pred"))  # classes squared, no data
    counted = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))
    out = cells.join(counted, ["label", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if normalise:
        out = out.withColumn("n", F.col("n") / F.sum("n").over(Window.partitionBy()))
    return out


def with_glosses(df: DataFrame, vocab: DataFrame, predictions: str = "predictions", key: str = "clip_id") -> DataFrame:
    """JN3: predictions (id, score) as (gloss, score), order kept."""
    flat = df.select(key, F.posexplode(predictions).alias("at", "p")).select(key, "at", F.col("p.id").alias("gloss_id"), "p.score")
    named = flat.join(vocab, "gloss_id")
    rows = F.array_sort(F.collect_list(F.struct("at", "gloss", "score")))
    return named.groupBy(key).agg(F.transform(rows, lambda r: F.struct(r["gloss"].alias("gloss"), r["score"].alias("score"))).alias(predictions))
