"""Shared pieces: scratch tables, Arrow helpers, vectorised word hashing, bounded sums."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinseq.sources.code import ship_code

# --------------------------------------------------------------------------- scratch tables


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables: ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is absent (single-machine tests).
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="kinseq-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: The paths written inside the open ``temporary_tables`` blocks of this thread, innermost last.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open_blocks", default=())
#: Every path written by this process and not removed since.
_WRITTEN: set[str] = set()


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables written inside the block go when it ends, but for those written with ``keep``."""
    before, mine = _OPEN.get(), []
    _OPEN.set((*before, mine))
    try:
        yield
    finally:
        _OPEN.set(before)
        for path in mine:
            drop_path(spark, path)


def purge_scratch(spark: SparkSession) -> None:
    """Remove what results still hold: no DataFrame returned before may be used afterwards."""
    for path in list(_WRITTEN):
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _WRITTEN.discard(path)


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut and a lost
    executor costs nothing that is already written.  ``keep``: for the block around this one."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/kinseq/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.add(path)
    blocks = _OPEN.get()
    if len(blocks) > keep:
        blocks[-1 - keep].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of text that one Arrow batch to a Python worker holds at most.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of long texts can hold in a Python worker; send the code there.

    The bounds are the same for every operator and only ever lowered, so frames built earlier
    keep theirs whatever is called later; operators that want larger batches join them (``joined``)."""
    ship_code(spark)
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{name}", None) or 0)
        if not 0 < now <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def arrow_map(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` over bounded batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def joined(batches, rows: int, most: int = 8 << 20):
    """Batches of up to ``rows`` rows and ``most`` bytes out of smaller ones."""
    held, n, size = [], 0, 0
    for batch in batches:
        if held and (n + batch.num_rows > rows or size + batch.nbytes > most):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            held, n, size = [], 0, 0
        if batch.num_rows:
            held, n, size = [*held, batch], n + batch.num_rows, size + batch.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]


def return_memory(above: int = 1 << 20) -> None:
    """Let the C library give freed arrays of so many bytes back at once: workers are kept from task to
    task, and glibc would hold on to more with each larger array it has seen.  A worker that makes
    the same arrays for every batch is faster with a higher bound."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, above)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, above)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        return
    pa.set_memory_pool(pa.system_memory_pool())


return_memory()


# --------------------------------------------------------------------------- bytes and words

#: The white space that separates words: 0x20 and 0x09-0x0D.
_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SEGMENT = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix64(b + np.uint64(0x5851F42D4C957F2D))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(0, dtype=np.uint64)
        self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, _SEGMENT + (1 << 16))
            inverse = pow(_BASE, -1, 1 << 64)
            self.up = _geometric(_BASE, n)
            self.down = _geometric(inverse, n)
        return self.up, self.down


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _Powers()


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty.  No copy of the text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offs = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def word_spans(raw: np.ndarray, offs: np.ndarray):
    """Segments of about a megabyte, cut at word ends: (first byte, segment, starts, ends)."""
    total, at = len(raw), 0
    bounds = np.unique(offs)
    while at < total:
        stop = min(at + _SEGMENT, total)
        if stop < total:
            nearest = bounds[np.searchsorted(bounds, stop)]
            step = 4096
            while stop < nearest and not _WS[raw[stop]]:
                window = _WS[raw[stop : min(stop + step, nearest)]]
                hit = int(window.argmax())
                if window[hit]:
                    stop += hit
                    break
                stop += len(window)
        segment = raw[at:stop]
        inside = ~_WS[segment]
        edge = np.zeros(len(segment) + 1, dtype=bool)
        lo, hi = np.searchsorted(bounds, [at, stop])
        edge[bounds[lo : hi + 1][bounds[lo : hi + 1] <= stop] - at] = True
        edge[0] = edge[-1] = True
        before = np.empty(len(segment), dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(len(segment), dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield at, segment, starts, ends
        at = stop


def word_hashes(raw: np.ndarray, offs: np.ndarray, lower: bool = True, tails: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words ``[^\\x20\\x09-\\x0D]+`` and each text's offset among them.

    ``tails``: the last ten bits are a hash of the word's last three bytes instead."""
    values = _byte_values(lower)
    hashes, places = [], []
    for at, segment, starts, ends in word_spans(raw, offs):
        if not len(starts):
            continue
        up, down = _POWERS.get(len(segment) + 1)
        sums = np.empty(len(segment) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(values[segment] * up[: len(segment)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
        h = mix64(h)
        if tails:
            last = sum(np.where(ends - d >= starts, values[segment[np.maximum(ends - d, 0)]], 0) * np.uint64(_BASE ^ d) for d in (1, 2, 3))
            h = (h & np.uint64(_MASK ^ 1023)) | (mix64(last.astype(np.uint64)) >> np.uint64(54))
        hashes.append(h)
        places.append(starts + at)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offs), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offs)


def hash_of_words(words: list[str], lower: bool = True) -> np.ndarray:
    """The hashes ``word_hashes`` gives for single words."""
    raw, offs = string_buffers(pa.array(words, type=pa.string()))
    return word_hashes(raw, offs, lower)[0]


def shingles(words: np.ndarray, offs: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and each text's offset among them.

    A text with fewer words gives its whole sequence as one; one without words gives none.
    """
    n = np.diff(offs)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    out_offs = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(out_offs[-1], dtype=np.uint64)
    factors = _geometric(0xD1342543DE82EF95, size + 1)[1:]
    long = n >= size
    if long.any():
        m = len(words) - size + 1
        rolled = words[:m] * factors[0]
        for k in range(1, size):
            rolled = rolled + words[k : k + m] * factors[k]
        rolled = mix64(rolled)
        keep = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(keep, offs[:-1][long], 1)
        np.add.at(keep, offs[1:][long] - size + 1, -1)
        target = np.zeros(out_offs[-1] + 1, dtype=np.int64)
        np.add.at(target, out_offs[:-1][long], 1)
        np.add.at(target, out_offs[1:][long], -1)
        out[np.cumsum(target)[:-1] > 0] = rolled[np.cumsum(keep)[:m] > 0]
    for i in np.flatnonzero(~long & (n > 0)):
        h = np.uint64(n[i])
        with np.errstate(over="ignore"):
            for w in words[offs[i] : offs[i + 1]]:
                h = mix64(np.array([h * np.uint64(0x2545F4914F6CDD1D) + w], dtype=np.uint64))[0]
        out[out_offs[i]] = h
    return out, out_offs


# --------------------------------------------------------------------------- sums of bounded size


def sum_rows(df: DataFrame, keys: list[str], vector: str, width: int) -> DataFrame:
    """Sum arrays of a fixed width by key, with Spark's partial aggregation on the map side."""
    sums = df.groupBy(*keys).agg(*[F.sum(F.col(vector)[i]).alias(f"c{i}") for i in range(width)])
    return sums.select(*keys, F.array(*[f"c{i}" for i in range(width)]).alias(vector))


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def merge_counts(hashes, most: int = 1_500_000):
    """For ``mapInArrow``: (token, c) of the hashes that ``hashes(column)`` yields in arrays, counted
    together over a task; of more than ``most`` different ones what is there is sent on."""

    def run(batches):
        parts, held = [], 0

        def rows():
            keys, counts = _merged(parts)
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000].view(np.int64)), pa.array(counts[at : at + 100_000])], names=["token", "c"])

        for batch in batches:
            for found in hashes(batch.column(0)):
                parts.append(np.unique(found, return_counts=True))
                held += len(parts[-1][0])
                if held > most:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if held > most:
                        yield from rows()
                        parts, held = [], 0
        if parts:
            yield from rows()

    return run


def crc_mod(column: str, mod: int):
    """crc32 of the id as text, modulo ``mod``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(mod)


# --------------------------------------------------------------------------- connected components


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges(a, b)``; comp is the smallest node reachable.

    Alternating large-star and small-star steps: each only takes minima by key (partially
    aggregated before the shuffle) and joins them back, so no group is ever gathered.
    Steps go on until the edges no longer change (logarithmically many); each step's edges are
    written to the shared folder.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(low.hint("merge"), "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    e, last = edges.filter("a <> b").select("a", "b").distinct(), None
    while True:
        before, e = e, materialise(star(star(e, True), False), "star")
        if last is not None:  # the step before is written: the one before that is done with
            drop_path(e.sparkSession, before._path)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == last:
            break
        last = tuple(now)
    return nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("comp")), "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))


# --------------------------------------------------------------------------- dropping by id

#: Up to so many ids a filter list may be broadcast; above, the same join shuffles.
BROADCAST_IDS = 500_000


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` less the rows of the written table ``ids(id_col)``; rows without an id stay."""
    gone = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


#: Row keys from here on are hashes; ids below stand for themselves.
HASHED_KEYS = 1 << 62


def with_row_keys(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each id and text, null ids included, with a ``key`` that no other row has.

    An id is its row's key; of several texts of one id the first by hash has it.  The others, and
    rows without an id, get a hash of id and text above all ids.  Only rows of repeated or null
    ids are shuffled."""
    hashed = F.xxhash64(F.lit(1), id_col, text_col).bitwiseAND(F.lit(HASHED_KEYS - 1)).bitwiseOR(F.lit(HASHED_KEYS))
    odd = docs.groupBy(id_col).count().filter(f"count > 1 or {id_col} is null or {id_col} >= {HASHED_KEYS}").select(id_col)
    odd = materialise(odd, "repeated")
    n = odd.count()
    if not n:
        return docs.withColumn(key, F.col(id_col).cast("long"))
    same = docs[id_col].eqNullSafe(odd[id_col])
    gone = F.broadcast(odd) if n <= BROADCAST_IDS else odd
    plain = docs.join(gone, same, "left_anti").withColumn(key, F.col(id_col).cast("long"))
    rows = materialise(docs.join(gone, same, "left_semi").dropDuplicates([id_col, text_col]).withColumn(key, hashed), "odd")
    first = rows.filter(F.col(id_col) < HASHED_KEYS).groupBy(id_col).agg(F.min(key).alias("_first"))
    rows = rows.join(first, id_col, "left").withColumn(key, F.when(F.col(key) == F.col("_first"), F.col(id_col).cast("long")).otherwise(F.col(key)))
    return materialise(plain.unionByName(rows.select(*docs.columns, key)), "keyed")
