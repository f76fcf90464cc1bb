"""Substring dedup by line and paragraph hashing.

Texts are cut into units: lines, and inside them sentences (a space after ``.``, ``!`` or ``?``
ends one), or paragraphs set apart by blank lines.  A unit of at least ``MIN_UNIT`` words is normalised
(lower case, each run of 0x20/0x09-0x0D one space, ends trimmed) and hashed to 64 bits.  Digests are
grouped globally to the smallest id that holds them: its first occurrence there is the earliest
ranked, every other one is a repeat, and every repeat is removed.  A *passage* is a run of neighbouring
repeats (shorter units between two repeats belong to it and go with it); each removed unit is
returned with its span in code points of the original, its words, the id that keeps it and the words
of its passage, so chance repeats of a sentence can be told from copied passages.  ``min_passage`` spares
passages of fewer words (by default none).

Only digests, never units, are shuffled to find repeats; per digest only a minimum and a maximum
are kept, combined on the map side, so a line that a third of all texts hold costs a row per task.

Defined results: null or empty texts have no units; a text of nothing but shorter units loses nothing; rows that repeat an id count as one document, in
which each row keeps what the document keeps; a null id ranks after all others; extra columns
pass through (``n_units`` and ``removed`` are replaced).
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import materialise, small_batches

MIN_UNIT = 3
_LAST = (1 << 63) - 1
_CUT = {"line": re.compile(r"\n|(?<=[.!?]) "), "paragraph": re.compile("\n[ \t\r\f\v]*\n[ \t\r\f\v\n]*")}


def units(text: str, kind: str = "line") -> list[tuple[int, int]]:
    """(start, end) of every unit in code points, without what separates them."""
    at, out = 0, []
    for m in _CUT[kind].finditer(text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    return out


def unit_digest(unit: str, min_unit: int) -> tuple[int | None, int]:
    """(digest, or None for a short unit; words)"""
    words = unit.lower().encode("utf-8", "surrogatepass").split()
    if len(words) < min_unit:
        return None, len(words)
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True), len(words)


def passages(text: str, own, gone: dict, kind: str, min_unit: int, min_passage: int):
    """(units, [[(unit, words, id that keeps it), ...] of each passage]) of what is removed."""
    parts, seen, runs, run = units(text, kind), set(), [], []

    def close() -> None:
        if run and sum(n for _, n, _ in run) >= min_passage:
            runs.append(list(run))
        run.clear()

    for k, (start, end) in enumerate(parts):
        d, n = unit_digest(text[start:end], min_unit)
        if d is None:
            continue
        if d in gone or d in seen:
            run.append((k, n, gone.get(d, own)))
        else:
            seen.add(d)
            close()
    close()
    return parts, runs


def _digests(kind: str, min_unit: int):
    def run(batches):
        for batch in batches:
            ids, digests = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {unit_digest(text[a:b], min_unit)[0] for a, b in units(text, kind)} - {None} if text else ()
                ids += [_LAST if i is None else i] * len(found)
                digests += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.int64())], names=["doc_id", "digest"])

    return run


_REMOVED = "array<struct<start:long,end:long,words:long,kept_in:long,passage_words:long>>"


def _cut(kind: str, min_unit: int, min_passage: int, text_at: int, gone_at: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            kept, spans, counts = [], [], []
            columns = list(batch.columns)
            owner, gone = columns[gone_at].to_pylist(), columns[gone_at + 1].to_pylist()
            for text, own, shared in zip(columns[text_at].to_pylist(), owner, gone, strict=True):
                parts, runs = passages(text or "", own, {x["digest"]: x["keeper"] for x in shared or ()}, kind, min_unit, min_passage)
                out, at, cut = [], 0, []
                for run in runs:
                    first, last, words = run[0][0], run[-1][0], sum(n for _, n, _ in run)
                    out.append(text[at : parts[first][0]])
                    at = parts[last + 1][0] if last + 1 < len(parts) else len(text)
                    cut += [{"start": parts[k][0], "end": parts[k][1], "words": n, "kept_in": None if i == _LAST else i, "passage_words": words} for k, n, i in run]
                kept.append(text if not runs else "".join(out) + text[at:])
                spans.append(cut)
                counts.append(len(parts) if text else 0)
            columns = columns[:gone_at]
            columns[text_at] = pa.array(kept, schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(spans, schema.field(gone_at + 1).type)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: str = "line", min_unit: int = MIN_UNIT, min_passage: int = 0) -> DataFrame:
    """``docs`` with the text cut, ``n_units`` and ``removed``: the units cut out, as (start, end, words,
    kept_in, passage_words), ``kept_in`` being the id whose text keeps the unit."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(docs.sparkSession)
    docs = docs.drop("n_units", "removed")
    owned = materialise(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_digests(kind, min_unit), "doc_id long, digest long"), "digests")
    shared = owned.groupBy("digest").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")).filter("keeper < last").select("digest", "keeper")
    shared = materialise(shared, "shared")  # read back, it is shuffled like the other side, and AQE can split hot digests
    gone = owned.join(shared, "digest").filter("doc_id > keeper").groupBy("doc_id").agg(F.collect_set(F.struct("digest", "keeper")).alias("_gone"))
    keyed = docs.withColumn("_owner", F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)))
    joined = keyed.join(gone.withColumnRenamed("doc_id", "_owner"), "_owner", "left").select(*docs.columns, "_owner", "_gone")
    out = docs.withColumns({"n_units": F.lit(0).cast("long"), "removed": F.lit(None).cast(_REMOVED)}).schema
    at = docs.columns.index(text_col)
    return joined.mapInArrow(_cut(kind, min_unit, min_passage, at, len(docs.columns), to_arrow_schema(out)), out)
