"""Approximate nearest neighbours by shifted space-filling curves.

Equal vectors are first collapsed to one representative that keeps its smallest ids, so copies
neither fill windows nor change ties.  A bounded sample of representatives fixes a projection
(principal axes); every curve turns those axes by its own random rotation, shifts them and takes the
Hilbert index of ``DIMS`` coordinates.  Each curve orders *all* representatives by a range
partitioning; exact positions cut the order into blocks of ``BLOCK`` rows, and a query meets, on every
curve, the rows at most ``window`` places from its own.

How many places are needed depends on the vectors, so it is measured: for a bounded sample of
``PROBES`` queries the exact neighbours are found in one pass over all rows, and the window is the number
of places within which ``TARGET`` of them stand on at least one curve.  For vectors with structure it does
not grow with the table; without any (all distances alike) it grows, though slower than the table.
Should the windows together hold more rows than there are, one curve whose window is everything
takes their place: the exact search.

Along the curves a vector is a byte a coordinate, with the distance to what the bytes stand for; bounds
from it keep every row that could be among the nearest, and only these are ranked, by the exact
Euclidean distance of the original vectors in doubles; equal distances go by the smallest id.

Defined results: null, zero, non-finite vectors and those whose size is not the most frequent one
take no part (there is no distance between sizes); repeated ids count as one if their vectors are equal,
else as vectors of that id; a query with fewer candidates gets all; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinseq.llm.common import arrow_map, materialise, small_batches, temporary_tables

CURVES, DIMS, AXES, BITS = 32, 16, 64, 3
LEAST, BLOCK, SAMPLE, PROBES, TARGET = 32, 8192, 20_000, 200, 0.95


def hilbert_index(x: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points [n, d], d * bits < 64 (Skilling's method)."""
    x = x.astype(np.uint32).copy()
    d = x.shape[1]
    for b in range(bits - 1, 0, -1):
        q, p = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for i in range(d):
            turned = (x[:, i] & q) > 0
            swap = np.where(turned, np.uint32(0), (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(turned, p, swap)
            x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), dtype=np.uint32)
    for b in range(bits - 1, 0, -1):
        t ^= np.where((x[:, d - 1] >> np.uint32(b)) & np.uint32(1), np.uint32((1 << b) - 1), np.uint32(0)).astype(np.uint32)
    x ^= t[:, None]
    key = np.zeros(len(x), dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << np.uint64(1)) | ((x[:, i] >> np.uint32(b)) & np.uint32(1)).astype(np.uint64)
    return key


class Projection:
    """Principal axes of a sample and, per curve, a rotation, a shift and a range."""

    def __init__(self, sample: np.ndarray, curves: int, seed: int = 5) -> None:
        self.mean = sample.mean(axis=0)
        axes = np.linalg.svd(sample - self.mean, full_matrices=False)[2][:AXES]
        self.turns = []
        for c in range(curves):
            rng = np.random.default_rng([seed, c])
            turn = np.linalg.qr(rng.normal(size=(len(axes), len(axes))))[0][:, :DIMS]
            y = (sample - self.mean) @ (axes.T @ turn)
            low, high = y.min(axis=0), y.max(axis=0)
            self.turns.append((axes.T @ turn, low, np.maximum(high - low, 1e-12), rng.random(turn.shape[1])))
        self.scale = np.maximum(np.abs(sample - self.mean).max(axis=0), 1e-12) / 127

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A byte a coordinate, and how far each vector is from what its bytes stand for."""
        codes = np.clip(np.rint((vectors - self.mean) / self.scale), -127, 127).astype(np.int8)
        return codes, np.sqrt(((vectors - self.decode(codes)) ** 2).sum(axis=1))

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return codes * self.scale + self.mean

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        turn, low, span, shift = self.turns[curve]
        z = (np.clip(((vectors - self.mean) @ turn - low) / span, 0, 1) + shift) / 2
        return hilbert_index(np.minimum((z * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _order(projection):
    def run(batches):
        p = projection.value
        for batch in batches:
            x = _matrix(batch.column(1))
            for c in range(len(p.turns)):
                keys = p.keys(x, c).astype(np.int64) if len(x) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c, np.int32)), pa.array(keys), batch.column(0), batch.column(2)], names=["curve", "key", "rep", "is_query"])

    return run


def _code(projection):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            codes, off = projection.value.codes(x) if len(x) else (np.zeros((0, 1), np.int8), np.zeros(0))
            binary = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * codes.shape[1]).astype(np.int32)), pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), binary, pa.array(off)], names=["rep", "code", "off"])

    return run


def _exact(probes, k: int):
    """The k nearest representatives of each probe in each task: (probe, rep, score)."""

    def run(batches):
        ids, q = probes.value
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        for batch in batches:
            x, reps = _matrix(batch.column(1)), batch.column(0).to_numpy()
            if not len(x):
                continue
            near = np.maximum((q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * q @ x.T, 0)
            for i in range(len(ids)):
                some = np.argpartition(near[i], min(k, len(x)) - 1)[:k]
                some = some[reps[some] != ids[i]]
                r, d = np.append(best[i][0], reps[some]), np.append(best[i][1], near[i][some])
                keep = np.argsort(d, kind="stable")[:k]
                best[i] = r[keep], d[keep]
        n = [len(r) for r, _ in best]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(ids, np.int64), n)), pa.array(np.concatenate([r for r, _ in best])), pa.array(np.concatenate([d for _, d in best]))], names=["probe", "rep", "score"])

    return run


def _nearest(projection, k: int, half: int):
    """For each query of a block the rows of its window that may be among the k nearest: (query, rep, low, high)."""

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        p, out = projection.value, []
        order = np.argsort(block["pos"].to_numpy(), kind="stable")
        at, reps, off = (block[c].to_numpy()[order] for c in ("pos", "rep", "off"))
        codes = block["code"].combine_chunks()
        size = len(p.mean)
        x = p.decode(np.frombuffer(b"".join(codes.to_pylist()), dtype=np.int8).reshape(len(at), size)[order]) if len(at) else np.zeros((0, size))
        square = (x * x).sum(axis=1)
        for q, name, place in zip(_matrix(queries["target"]), queries["query"].to_pylist(), queries["qpos"].to_pylist(), strict=True):
            lo, hi = np.searchsorted(at, [place - half, place + half + 1])
            if lo == hi:
                continue
            d = np.sqrt(np.maximum(square[lo:hi] - 2 * (x[lo:hi] @ q) + q @ q, 0))
            slack = off[lo:hi] + 1e-7 * (1 + d)
            high = d + slack
            edge = np.partition(high, min(k, hi - lo) - 1)[min(k, hi - lo) - 1]
            some = np.flatnonzero(d - slack <= edge)
            out.append((np.full(len(some), name), reps[lo:hi][some], (d - slack)[some], high[some]))
        columns = [np.concatenate([o[c] for o in out]) if out else np.zeros(0) for c in range(4)]
        return pa.table({n: pa.array(v.astype(t)) for n, v, t in zip(("query", "rep", "least", "most"), columns, (np.int64, np.int64, float, float), strict=True)})

    return run


def _distances(batches):
    for batch in batches:
        square = (_matrix(batch.column(2)) - _matrix(batch.column(3))) ** 2 if batch.num_rows else []
        # row by row, so that a distance does not depend on which rows share its batch
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([float(np.sqrt(square[i : i + 1].sum(axis=1)[0])) for i in range(len(square))], pa.float64())], names=["query", "ids", "score"])


def _window(reps: DataFrame, placed: DataFrame, k: int, curves: int, n: int) -> int:
    """Places within which TARGET of the sampled queries' exact neighbours stand on some curve."""
    spark = reps.sparkSession
    asked = reps.filter("is_query")
    m = asked.count()
    if m > PROBES:
        asked = asked.filter(F.pmod(F.xxhash64("rep", F.lit(4)), F.lit(1 << 20)) < int((1 << 20) * 2 * PROBES / m) + 1)
    got = asked.select("rep", "embedding").orderBy(F.xxhash64("rep", F.lit(6)), "rep").limit(PROBES).toPandas()  # PROBES rows
    if not len(got) or n < 2:
        return n
    probes = spark.sparkContext.broadcast((got.rep.tolist(), np.array(got.embedding.tolist(), dtype=np.float64)))
    near = arrow_map(reps.select("rep", "embedding"), _exact(probes, k), "probe long, rep long, score double")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("probe").orderBy("score", "rep"))).filter(F.col("n") <= k).select("probe", "rep").toPandas()
    names = spark.createDataFrame([(int(r),) for r in sorted({*near.rep, *near.probe})], "rep long")
    at = placed.join(F.broadcast(names), "rep").select("curve", "rep", "pos").toPandas()  # curves * PROBES * (k + 1) rows
    places = at.pivot(index="rep", columns="curve", values="pos")
    gaps = np.abs(places.loc[near.probe].to_numpy() - places.loc[near.rep].to_numpy()).min(axis=1)
    half = max(LEAST, int(np.quantile(gaps, TARGET)))
    return n if 2 * half * curves >= n else half


def nearest_neighbours(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", curves: int = CURVES, window: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found.

    ``queries`` is a condition on the ids.  Every other vector is a candidate of each query.  ``window``:
    places each side of a query on every curve (None: measured)."""
    spark = vectors.sparkSession
    small_batches(spark)
    v = F.col("embedding")
    # floats stay floats on the way (half the bytes); all arithmetic is on their exact doubles
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("embedding"), queries.alias("asks"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    with temporary_tables(spark):
        return materialise(_search(rows.filter(F.size(v) == sizes.d), k, curves, window), "neighbours", keep=True)


def _search(rows: DataFrame, k: int, curves: int, window: int | None) -> DataFrame:
    spark, pair = rows.sparkSession, Window.partitionBy("query").orderBy("most", "rep")
    rows = materialise(rows.distinct(), "vectors")
    # one representative of equal vectors, with its k + 1 smallest ids
    low = rows.withColumn("n", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("n") <= k + 1)
    asked = rows.filter("asks").groupBy("embedding").agg(F.lit(True).alias("is_query"))
    reps = low.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).join(asked, "embedding", "left")
    reps = materialise(reps.select(F.xxhash64("embedding").alias("rep"), "embedding", "ids", F.coalesce("is_query", F.lit(False)).alias("is_query")), "reps")
    n = reps.count()
    sample = reps.select("rep", "embedding")
    if n > SAMPLE:  # by hash to little more than is wanted, so that what is sorted and sent stays bounded
        sample = sample.filter(F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 20)) < int((1 << 20) * 1.1 * SAMPLE / n) + 1)
    sample = sample.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toPandas()
    projection = spark.sparkContext.broadcast(Projection(np.array(sample.embedding.tolist(), dtype=np.float64), curves))

    parts = max(8, -(-n * curves // 200_000))
    keyed = arrow_map(reps.select("rep", "embedding", "is_query"), _order(projection), "curve int, key long, rep long, is_query boolean")
    ordered = keyed.repartitionByRange(parts, "curve", "key", "rep").sortWithinPartitions("curve", "key", "rep").drop("key")
    ordered = materialise(ordered.withColumn("pid", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ordered")
    starts = ordered.groupBy("curve", "pid").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("curve").orderBy("pid")) - F.col("rows")
    starts = starts.select("curve", "pid", (F.col("first") - before).alias("shift"))  # a row for each partition
    placed = ordered.join(F.broadcast(starts), ["curve", "pid"]).select("curve", "rep", "is_query", (F.col("at") - F.col("shift")).alias("pos"))
    half = window or _window(reps, placed, k, curves, n)
    if half >= n:
        placed = placed.filter("curve = 0")
    coded = arrow_map(reps.select("rep", "embedding"), _code(projection), "rep long, code binary, off double")
    blocks = placed.select("curve", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "rep").join(coded, "rep")  # only now the bytes, once a curve
    reach = F.sequence(F.floor(F.greatest(F.col("pos") - half, F.lit(0)) / BLOCK), F.floor(F.least(F.col("pos") + half, F.lit(n - 1)) / BLOCK))
    asks = placed.filter("is_query").join(reps.filter("is_query").select("rep", "embedding"), "rep")
    asks = asks.select(F.col("curve").alias("on_curve"), F.explode(reach).alias("in_block"), F.col("pos").alias("qpos"), F.col("rep").alias("query"), F.col("embedding").alias("target"))
    found = asks.groupBy("on_curve", "in_block").cogroup(blocks.groupBy("curve", "block")).applyInArrow(_nearest(projection, k + 1, half), "query long, rep long, least double, most double")
    found = found.groupBy("query", "rep").agg(F.min("least").alias("least"), F.min("most").alias("most"))
    edge = F.max(F.when(F.col("n") <= k + 1, F.col("most"))).over(Window.partitionBy("query"))
    found = materialise(found.withColumn("n", F.row_number().over(pair)).withColumn("edge", edge).filter("least <= edge").select("query", "rep"), "found")
    # what may be among the nearest is ranked by exact distances
    near = found.join(reps.select("rep", "embedding", "ids"), "rep").join(reps.filter("is_query").select(F.col("rep").alias("query"), F.col("embedding").alias("target")), "query")
    near = arrow_map(near.select("query", "ids", "embedding", "target"), _distances, "query long, ids array<long>, score double")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("probe").orderBy("score", "rep"))).filter(F.col("n") <= k).select("probe", "rep").toPandas()
    names = spark.createDataFrame([(int(r),) for r in sorted({*near.rep, *near.probe})], "rep long")
    at = placed.join(F.broadcast(names), "rep").select("curve", "rep", "pos").toPandas()  # curves * PROBES * (k + 1) rows
    places = at.pivot(index="rep", columns="curve", values="pos")
    gaps = np.abs(places.loc[near.probe].to_numpy() - places.loc[near.rep].to_numpy()).min(axis=1)
    half = max(LEAST, int(np.quantile(gaps, TARGET)))
    return n if 2 * half * curves >= n else half


def nearest_neighbours(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", curves: int = CURVES, window: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found.

    ``queries`` is a condition on the ids.  Every other vector is a candidate of each query.  ``window``:
    places each side of a query on every curve (None: measured)."""
    spark = vectors.sparkSession
    small_batches(spark)
    v = F.col("embedding")
    # floats stay floats on the way (half the bytes); all arithmetic is on their exact doubles
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("embedding"), queries.alias("asks"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    with temporary_tables(spark):
        return materialise(_search(rows.filter(F.size(v) == sizes.d), k, curves, window), "neighbours", keep=True)


def _search(rows: DataFrame, k: int, curves: int, window: int | None) -> DataFrame:
    spark, pair = rows.sparkSession, Window.partitionBy("query").orderBy("most", "rep")
    rows = materialise(rows.distinct(), "vectors")
    # one representative of equal vectors, with its k + 1 smallest ids
    low = rows.withColumn("n", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("n") <= k + 1)
    asked = rows.filter("asks").groupBy("embedding").agg(F.lit(True).alias("is_query"))
    reps = low.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).join(asked, "embedding", "left")
    reps = materialise(reps.select(F.xxhash64("embedding").alias("rep"), "embedding", "ids", F.coalesce("is_query", F.lit(False)).alias("is_query")), "reps")
    n = reps.count()
    sample = reps.select("rep", "embedding")
    if n > SAMPLE:  # by hash to little more than is wanted, so that what is sorted and sent stays bounded
        sample = sample.filter(F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 20)) < int((1 << 20) * 1.1 * SAMPLE / n) + 1)
    sample = sample.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toPandas()
    projection = spark.sparkContext.broadcast(Projection(np.array(sample.embedding.tolist(), dtype=np.float64), curves))

    parts = max(8, -(-n * curves // 200_000))
    keyed = arrow_map(reps.select("rep", "embedding", "is_query"), _order(projection), "curve int, key long, rep long, is_query boolean")
    ordered = keyed.repartitionByRange(parts, "curve", "key", "rep").sortWithinPartitions("curve", "key", "rep").drop("key")
    ordered = materialise(ordered.withColumn("pid", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ordered")
    starts = ordered.groupBy("curve", "pid").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("curve").orderBy("pid")) - F.col("rows")
    starts = starts.select("curve", "pid", (F.col("first") - before).alias("shift"))  # a row for each partition
    placed = ordered.join(F.broadcast(starts), ["curve", "pid"]).select("curve", "rep", "is_query", (F.col("at") - F.col("shift")).alias("pos"))
    half = window or _window(reps, placed, k, curves, n)
    if half >= n:
        placed = placed.filter("curve = 0")
    coded = arrow_map(reps.select("rep", "embedding"), _code(projection), "rep long, code binary, off double")
    blocks = placed.select("curve", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "rep").join(coded, "rep")  # only now the bytes, once a curve
    reach = F.sequence(F.floor(F.greatest(F.col("pos") - half, F.lit(0)) / BLOCK), F.floor(F.least(F.col("pos") + half, F.lit(n - 1)) / BLOCK))
    asks = placed.filter("is_query").join(reps.filter("is_query").select("rep", "embedding"), "rep")
    asks = asks.select(F.col("curve").alias("on_curve"), F.explode(reach).alias("in_block"), F.col("pos").alias("qpos"), F.col("rep").alias("query"), F.col("embedding").alias("target"))
    found = asks.groupBy("on_curve", "in_block").cogroup(blocks.groupBy("curve", "block")).applyInArrow(_nearest(projection, k + 1, half), "query long, rep long, least double, most double")
    found = found.groupBy("query", "rep").agg(F.min("least").alias("least"), F.min("most").alias("most"))
    edge = F.max(F.when(F.col("n") <= k + 1, F.col("most"))).over(Window.partitionBy("query"))
    found = materialise(found.withColumn("n", F.row_number().over(pair)).withColumn("edge", edge).filter("least <= edge").select("query", "rep"), "found")
    # what may be among the nearest is ranked by exact distances
    d = F.sqrt(F.aggregate(F.zip_with("target", "embedding", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x))
    near = found.join(reps.select("rep", "embedding", "ids"), "rep").join(reps.filter("is_query").select(F.col("rep").alias("query"), F.col("embedding").alias("target")), "query")
    near = near.select("query", "ids", d.alias("score"))
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", F.get("ids", F.lit(0))))).filter(F.col("n") <= k + 1)
    near = near.select("query", F.explode("ids").alias("vec_id"), "score")
    who = rows.filter("asks").join(reps.select("rep", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")).distinct()
    out = who.join(near, "query").filter("query_id <> vec_id").select("query_id", "vec_id", "score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
