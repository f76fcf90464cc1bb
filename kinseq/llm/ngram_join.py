"""N-gram Jaccard join: a grouped prefix join over word-shingle sets.

Method
------
1. A text's set holds its distinct ``SHINGLE``-word shingles (64-bit hashes, 58 of them kept).
   Shingles are totally ordered: first by how common a fixed-size count sketch over *all* rows
   says they are, then by hash.  Two sets with Jaccard >= t share one of their first
   ``n - ceil(t n) + 1`` shingles in any such order, and this one keeps what many texts share
   out of the prefixes.
2. Texts with the same set form one *class*; classes with the same prefix and size form one
   *group*.  Only one row per task and group carries a prefix, so copies never multiply rows.
3. Postings ``(shingle, group)`` are aggregated to one hub group per shingle.  Star rounds
   compare every member of a list with its hub (a linear number of pairs); what is then in one
   component needs no more comparisons.  Once few pairs are left, a last round expands the groups
   of every list that still holds several components and compares all pairs *across*
   components, so no link between different texts that could join two components is lost.
4. Pairs pass a size filter and an exact bitmap bound (xor-ed bits bound the symmetric
   difference from below), and are then verified on the full shingle sets.

Defined results: null or blank texts have the empty set and link with nothing; repeated rows and
repeated ids are separate members of one class; rows without an id are returned with what
component their text has; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinseq.llm.common import connected_components, materialise, shingles, small_batches, string_buffers, temporary_tables, word_hashes

SHINGLE, NUM, DEN = 5, 80, 100
#: Cells of the count sketch: its size, and so what is broadcast, never changes.
SKETCH_BITS, SKETCH_BLOCK = 20, 1 << 14
#: All pairs across components are compared as soon as the lists left hold at most ``PAIRED`` pairs
#: a member on average, or after ``STARS`` more star rounds.
PAIRED, STARS = 64, 6
#: Up to so many ids a filter list may be broadcast; above, the same join shuffles.
BROADCAST_IDS = 500_000


# --------------------------------------------------------------------------- the sketch


def _count_cells(batches):
    cells = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for batch in batches:
        raw, offs = string_buffers(batch.column(0))
        s, so = shingles(*word_hashes(raw, offs), SHINGLE)
        if len(s):
            # a shingle counts once a text: its repeats inside one text say nothing
            owner = np.repeat(np.arange(len(so) - 1, dtype=np.uint64), np.diff(so))
            cell = (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
            first = np.unique((owner << np.uint64(SKETCH_BITS)) | cell.astype(np.uint64))
            cells += np.bincount((first & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), minlength=len(cells))
    if cells.any():
        blocks = cells.reshape(-1, SKETCH_BLOCK)
        salt = int(np.random.default_rng(int(cells.sum())).integers(64))
        yield _cells_batch(np.arange(len(blocks)), np.full(len(blocks), salt), blocks)


def _cells_batch(block, salt, cells):
    cells = [np.minimum(c, 2**32 - 1).astype(np.uint32).tobytes() for c in cells]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(block), pa.int32()), pa.array(np.asarray(salt), pa.int32()), pa.array(cells, pa.binary())], names=["block", "salt", "cells"])


def _sum_cells(batches):
    """Rows come clustered by (block, salt): sums are streamed, one block at a time."""
    key, total = None, None
    for batch in batches:
        for b, s, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            now = np.frombuffer(c, dtype=np.uint32).astype(np.int64)
            if (b, s) == key:
                total += now
                continue
            if key is not None:
                yield _cells_batch([key[0]], [key[1]], [total])
            key, total = (b, s), now
    if key is not None:
        yield _cells_batch([key[0]], [key[1]], [total])


def shingle_levels(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How common each cell's shingles are, as a level 0-31: fixed size whatever the input."""
    schema = "block int, salt int, cells binary"
    part = docs.select(text).mapInArrow(_count_cells, schema)
    for keys in (["block", "salt"], ["block"]):  # in two steps: no task sees every task's cells
        part = part.repartition(*keys) if len(keys) == 2 else part.withColumn("salt", F.lit(0)).repartition(*keys)
        part = part.sortWithinPartitions("block", "salt").mapInArrow(_sum_cells, schema)
    counts = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, dtype=np.int64).reshape(-1, SKETCH_BLOCK)
    for row in part.collect():  # 64 rows
        counts[row.block] += np.frombuffer(row.cells, dtype=np.uint32)
    counts = counts.reshape(-1)
    mean = float(counts.mean())
    over = (counts - mean) / np.sqrt(mean + 1)  # in standard deviations of what chance puts in a cell
    return np.clip(np.where(over > 2, np.floor(2 * np.log2(np.maximum(over, 1))), 0), 0, 31).astype(np.uint8)


# --------------------------------------------------------------------------- sets and features


def ordered_keys(s: np.ndarray, so: np.ndarray, levels: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct shingles in the global order: level in the top bits, then hash."""
    level = levels[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    keys = (level << np.uint64(58)) | (s >> np.uint64(6))
    return [np.unique(keys[a:b]) for a, b in zip(so[:-1], so[1:], strict=True)]


def prefix_length(n: int, num: int, den: int) -> int:
    return n - (num * n + den - 1) // den + 1


def class_id(keys: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(keys.tobytes(), digest_size=8).digest(), "little") >> 1


def bitmap(keys: np.ndarray) -> bytes:
    """Bits toggled by each key; the number of bits, a power of two, follows the set's size."""
    bits = 64
    while bits < 2 * len(keys):
        bits *= 2
    return np.packbits(np.bincount((keys & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _features(levels, num: int, den: int):
    def run(batches):
        table = levels.value
        seen: set[int] = set()
        for batch in batches:
            raw, offs = string_buffers(batch.column(1))
            n, cid, gid, prefix, bits = [], [], [], [], []
            for keys in ordered_keys(*shingles(*word_hashes(raw, offs), SHINGLE), table):
                m = len(keys)
                n.append(m)
                if not m:
                    cid.append(None), gid.append(None), prefix.append(None), bits.append(None)
                    continue
                first = keys[: prefix_length(m, num, den)]
                c = class_id(keys)
                # hubs are picked by the largest id: those whose prefix is the most shared
                rank = min(2047, int(64 * float((first >> np.uint64(58)).mean())))
                g = (rank << 51) | (int.from_bytes(hashlib.blake2b(first.tobytes() + m.to_bytes(8, "little"), digest_size=8).digest(), "little") >> 13)
                cid.append(c), gid.append(g)
                bits.append(None if c in seen else bitmap(keys))
                prefix.append(None if g in seen else first.astype(np.int64))
                if len(seen) > 400_000:  # bounded; a prefix may then be repeated, which changes nothing
                    seen.clear()
                seen.update((c, g))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(gid, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())], names=["doc_id", "n", "cid", "gid", "prefix", "bits"])

    return run


def _sets(levels):
    def run(batches):
        table = levels.value
        for batch in batches:
            raw, offs = string_buffers(batch.column(0))
            sets = ordered_keys(*shingles(*word_hashes(raw, offs), SHINGLE), table)
            yield pa.RecordBatch.from_arrays([pa.array([class_id(k) if len(k) else None for k in sets], pa.int64()), pa.array([k.tobytes() for k in sets], pa.binary())], names=["cid", "keys"])

    return run


# --------------------------------------------------------------------------- filters on pairs


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _bitmap_filter(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b, na, nb, xa, xb = (c.to_pylist() for c in batch.columns)
            keep = []
            for m, n, x, y in zip(na, nb, xa, xb, strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                size = min(len(x), len(y))
                apart = int(np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum())
                both = (m + n - apart) // 2
                keep.append(den * both >= num * (m + n - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _verify(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


# --------------------------------------------------------------------------- the join


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``.

    The result is a written table; what led to it is removed."""
    with temporary_tables(docs.sparkSession):
        return materialise(_components(docs, id_col, text_col, num, den), "components", keep=True)


def _components(docs: DataFrame, id_col: str, text_col: str, num: int, den: int) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    levels = spark.sparkContext.broadcast(shingle_levels(source))
    features = materialise(source.mapInArrow(_features(levels, num, den), "doc_id long, n long, cid long, gid long, prefix array<long>, bits binary"), "features")

    owners = features.filter("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("low"), F.max("bits").alias("bits"), F.max("n").alias("n"), F.max("gid").alias("gid"))
    classes = materialise(owners, "classes")
    heads = classes.groupBy("gid").agg(F.min("cid").alias("head"))

    post = features.filter("prefix is not null").select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = post.groupBy("token").agg(F.max("gid").alias("hub"), F.min("gid").alias("other")).filter("hub <> other").select("token", "hub")
    lists = materialise(post.join(shared, "token").select("token", "gid", "n", "pos", "hub").distinct(), "lists")

    # round one: every group's head with the head of its lists' hubs, every class with its head
    hubs = lists.filter("gid <> hub").select("gid", "hub").distinct()
    cross = hubs.join(heads, "gid").withColumnRenamed("head", "a").join(heads.select(F.col("gid").alias("hub"), "head"), "hub").select("a", F.col("head").alias("b"))
    inner = classes.join(heads, "gid").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    links = verified(source, classes, cross.unionByName(inner), levels, num, den)

    for turn in range(STARS + 1):
        comps = materialise(connected_components(links), "comps")
        # the members of every list that still holds several components; a group is a list too
        member = classes.join(comps.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "gid", "n", F.coalesce("comp", "cid").alias("comp"))
        cells = lists.select("token", "gid", "pos").join(member, "gid").unionByName(member.select(F.col("gid").alias("token"), "gid", F.lit(0).alias("pos"), "cid", "n", "comp"))
        each = cells.groupBy("token", "comp").agg(F.max("cid").alias("h1"), F.min("cid").alias("h0"), F.count("*").cast("double").alias("m"))
        # how many pairs of the list are of different components
        span = each.groupBy("token").agg(F.count("*").alias("k"), F.max("h1").alias("h1"), F.min("h0").alias("h0"), F.sum("m").alias("s"), F.sum(F.col("m") * F.col("m")).alias("q"))
        span = span.filter("k > 1").select("token", F.col("h1" if turn % 2 == 0 else "h0").alias("hub"), ((F.col("s") * F.col("s") - F.col("q")) / 2 / F.col("s")).alias("across"))
        cells = materialise(cells.join(span, "token"), "cells")
        size, paired = cells.agg(F.count("*"), F.sum("across")).first()
        if not size:
            break
        last = turn == STARS or paired <= PAIRED * size
        if not last:
            of_hub = comps.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp"))
            pairs = cells.select("cid", "comp", "hub").distinct().join(of_hub, "hub", "left").filter(F.col("comp") != F.coalesce("hub_comp", "hub")).select(F.col("cid").alias("a"), F.col("hub").alias("b"))
        else:
            x, y = (cells.select("token", *[F.col(c).alias(c + s) for c in ("cid", "n", "comp", "pos")]) for s in "xy")
            # sets that share ``need`` elements share one among the first n - need + 1 of either
            need = F.ceil(F.lit(num) * (F.col("nx") + F.col("ny")) / F.lit(num + den))
            near = (F.lit(den) * F.least("nx", "ny") >= F.lit(num) * F.greatest("nx", "ny")) & (F.col("posx") <= F.col("nx") - need) & (F.col("posy") <= F.col("ny") - need)
            pairs = x.join(y, "token").filter("cidx < cidy and compx <> compy").filter(near).select(F.col("cidx").alias("a"), F.col("cidy").alias("b"))
        more = verified(source, classes, pairs, levels, num, den)
        links = materialise(links.unionByName(more), "links")
        if last:
            break
    comps = connected_components(links)
    of_class = classes.join(comps.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "low", F.coalesce("comp", "cid").alias("comp"))
    lowest = of_class.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = of_class.join(lowest, "comp").select("cid", "component_id")
    return features.select("doc_id", F.col("n").alias("n_shingles"), "cid").join(named, "cid", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def verified(source: DataFrame, classes: DataFrame, pairs: DataFrame, levels, num: int, den: int) -> DataFrame:
    """Those of ``pairs(a, b)`` of classes whose sets' Jaccard similarity is at least num/den."""
    spark = source.sparkSession
    pairs = pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    left, right = (classes.select(F.col("cid").alias(s), F.col("n").alias("n" + s), F.col("bits").alias("x" + s), F.col("low").alias("low" + s)) for s in "ab")
    sized = pairs.join(left, "a").join(right, "b").filter(F.lit(den) * F.least("na", "nb") >= F.lit(num) * F.greatest("na", "nb"))
    close = materialise(sized.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(_bitmap_filter(num, den), "a long, b long"), "close")
    if close.isEmpty():
        return close
    ids = classes.join(close.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "cid", "left_semi").select(F.col("low").alias("doc_id"))
    ids = materialise(ids, "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = source.join(ids, "doc_id", "left_semi").unionByName(source.filter("doc_id is null"))
    sets = texts.select("text").mapInArrow(_sets(levels), "cid long, keys binary")
    sets = materialise(sets.filter("cid is not null").dropDuplicates(["cid"]), "sets")
    first = close.join(sets.withColumnRenamed("cid", "a").withColumnRenamed("keys", "ka"), "a")
    both = first.join(sets.withColumnRenamed("cid", "b").withColumnRenamed("keys", "kb"), "b")
    return materialise(both.select("a", "b", "ka", "kb").mapInArrow(_verify(num, den), "a long, b long"), "links")
