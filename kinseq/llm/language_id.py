"""Language ID by multilingual mixture inference.

Training counts letter trigrams (bytes, lower-cased in ASCII, each word padded) by language over
all labelled training rows.  A document is a mixture: each word comes from one language with the
product of its trigrams' smoothed probabilities.  Expectation-maximisation estimates the
document's language proportions from its words' likelihoods; the language set is the one whose
likelihood less ``PENALTY * languages * log(1 + words)`` is largest among the leading one, two,
... up to all languages, each set re-estimated by EM; sizes whose penalty alone is more than the best
set loses cannot win and are not tried.  The predicted language leads the chosen set; its
proportion there is the score.

Defined results: texts that are null or have no letter get ``und`` and 0.0; with no training rows
at all every text gets ``und``; ties go to the language first in code-point order; repeated rows
are scored alike; rows whose language is null teach nothing; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import mix64, small_batches, string_buffers, sum_rows

BUCKET_BITS, WIDTH, SMOOTH = 15, 64, 0.25
ITERATIONS, PENALTY = 8, 2.0
_CHUNK = 1 << 20
_LATIN = re.compile("[A-Za-z]")

_CODES = np.zeros(256, dtype=np.uint64)
_CODES[97:123] = np.arange(97, 123)
_CODES[65:91] = np.arange(97, 123)
_CODES[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    return text is not None and (_LATIN.search(text) is not None or any(map(str.isalpha, text)))


def trigrams(raw: np.ndarray, offs: np.ndarray):
    """(bucket of each letter's trigram, word of each letter, first letter of each word, text of each word)."""
    codes = _CODES[raw]
    before, after = np.zeros_like(codes), np.zeros_like(codes)
    before[1:], after[:-1] = codes[:-1], codes[1:]
    inner = offs[(offs > 0) & (offs < len(raw))]
    before[inner] = 0
    after[inner - 1] = 0
    at = np.flatnonzero(codes)
    key = (before[at] << np.uint64(16)) | (codes[at] << np.uint64(8)) | after[at]
    bucket = (mix64(key) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(before[at] == 0)
    return bucket, first, np.searchsorted(offs, at[first], "right") - 1


def _chunks(column: pa.Array, most: int):
    """Runs of whole texts of about ``most`` bytes: (first row, bytes, offsets)."""
    raw, offs = string_buffers(column)
    at = 0
    while at < len(offs) - 1:
        stop = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield at, raw[offs[at] : offs[stop]], offs[at : stop + 1] - offs[at]
        at = stop


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for at, raw, offs in _chunks(batch.column(0), _CHUNK):
            bucket, first, owner = trigrams(raw, offs)
            owner = np.repeat(owner, np.diff(np.append(first, len(bucket))))
            of = langs[at : at + len(offs) - 1]
            for lang in sorted(set(of)):
                mine = np.flatnonzero(of == lang)
                got = np.bincount(bucket[np.isin(owner, mine)], minlength=1 << BUCKET_BITS)
                counts[lang] = counts.get(lang, 0) + got
    for lang, got in counts.items():
        blocks = got.reshape(-1, WIDTH)
        some = np.flatnonzero(blocks.any(axis=1))
        if len(some):
            flat = pa.array(blocks[some].reshape(-1), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some, pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * WIDTH, pa.int32()), flat)], names=["lang", "block", "counts"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [bucket, language]); as large as the number of languages."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(text_col, lang_col).mapInArrow(_count, "lang string, block int, counts array<long>")
    sums = sum_rows(rows, ["lang", "block"], "counts", WIDTH).collect()
    langs = sorted({r.lang for r in sums})
    table = np.zeros((len(langs), (1 << BUCKET_BITS) // WIDTH, WIDTH))
    for r in sums:
        table[langs.index(r.lang), r.block] = r.counts
    table = table.reshape(len(langs), 1 << BUCKET_BITS) + SMOOTH
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32)


def _em(like: np.ndarray, owner: np.ndarray, starts: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after EM, and each text's log-likelihood (up to what no proportion changes)."""
    words = np.diff(np.append(starts, len(owner))).astype(np.float64)[:, None]
    for _ in range(steps):
        part = like * share[owner]
        part /= part.sum(axis=1, keepdims=True)
        share = (np.add.reduceat(part, starts, axis=0) / words).astype(np.float32)
    total = np.log(np.maximum((like * share[owner]).sum(axis=1, dtype=np.float64), 1e-300))
    return share, np.add.reduceat(total, starts)


def infer(raw: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leading language or -1, its proportion in the chosen set) of each text."""
    n, k = len(offs) - 1, table.shape[1]
    best, score = np.full(n, -1), np.zeros(n)
    bucket, first, owner = trigrams(raw, offs)
    if not len(first) or not k:
        return best, score
    logs = np.add.reduceat(table[bucket], first, axis=0)
    like = np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), 1e-30).astype(np.float32)
    texts, starts = np.unique(owner, return_index=True)
    local = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, len(owner))))
    full, _ = _em(like, local, starts, np.full((len(texts), k), 1 / k, np.float32), ITERATIONS)
    order = np.argsort(-full, axis=1, kind="stable")
    words = np.diff(np.append(starts, len(owner)))
    top, value, chosen = np.full(len(texts), -np.inf), np.zeros(len(texts)), order[:, 0].copy()
    for size in range(1, k + 1):
        # a word's likelihoods are at most 1, so a set gains at most what the best one has lost
        open_ = top < -PENALTY * size * np.log1p(words)
        live = np.flatnonzero(open_)
        if not len(live):
            break
        lead = order[live, :size]
        share = np.zeros_like(full[live])
        rows = np.arange(len(live))[:, None]
        share[rows, lead] = full[live[:, None], lead] + 1e-6
        share /= share.sum(axis=1, keepdims=True)
        mine = open_[local]
        share, ll = _em(like[mine], np.repeat(np.arange(len(live)), words[live]), np.cumsum(words[live]) - words[live], share, 0 if size == 1 else 3)
        ll = ll - PENALTY * size * np.log1p(words[live])
        better = ll > top[live]
        won = live[better]
        top[won], chosen[won], value[won] = ll[better], share.argmax(axis=1)[better], share.max(axis=1)[better]
    best[texts], score[texts] = chosen, np.clip(value, 0, 1)
    return best, score


def _predict(langs: list[str], model):
    def run(batches):
        table = model.value
        most = max(1 << 16, _CHUNK * 4 // max(4, len(langs)))
        for batch in batches:
            names, scores = [], []
            texts = batch.column(1).to_pylist()
            for at, raw, offs in _chunks(batch.column(1), most):
                best, score = infer(raw, offs, table)
                for i, (b, s) in enumerate(zip(best.tolist(), score.tolist(), strict=True)):
                    known = b >= 0 and has_letter(texts[at + i])
                    names.append(langs[b] if known else "und")
                    scores.append(s if known else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, learned from the rows where ``training`` holds."""
    spark = docs.sparkSession
    small_batches(spark)
    langs, table = train(docs.filter(training), text_col, lang_col)
    model = spark.sparkContext.broadcast(table)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(_predict(langs, model), "doc_id long, lang_pred string, score double")
