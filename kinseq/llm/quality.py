"""Quality classifier: random-indexing word vectors, pooled, then a two-layer network.

Tokens are runs of letters, of digits or of other marks.  Every token has a fixed sparse ternary index
vector, drawn from its whole 64-bit hash, so there is no table of index vectors and no two words share
one.  A word's vector sums, over *all* rows, the index vectors of its neighbours (window of ``WINDOW``
each side), centred, scaled to unit length and kept to a byte a place.  The vocabulary are the words
with at least ``SHARE`` of all tokens: exact counts over all rows decide, and by that definition it
holds at most ``1 / SHARE`` words (at most 20 MB are broadcast), however large the corpus is.  Rarer words
count as neighbours like all others and bring their own index vectors, but no context of their own.
A text's features are the means of its words' vectors and index vectors, the latter's length and its size.

The network (one hidden layer of tanh, numpy, Adam) is fitted on at most ``MAX_LABELS`` labelled
training rows (all when there are fewer; chosen by hash of the id otherwise).  A tenth of them is kept
out for the temperature; its targets are those of Platt's method, (n1 + 1) / (n1 + 2) and 1 / (n0 + 2),
so a perfectly parted set does not push the temperature to zero.

Defined results: null and empty texts have zero vectors and get the score of those; without
labelled training rows of both labels the score is 0.5; repeated rows score alike; null labels teach
nothing; extra columns are ignored; texts of any length are read whole, in slices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import _POWERS, BROADCAST_IDS, _byte_values, merge_counts, materialise, mix64, arrow_map, string_buffers, sum_rows, temporary_tables

DIM, WINDOW, NONZERO, SHARE = 32, 2, 4, 2.0**-19
HIDDEN, EPOCHS, STEPS, RATE, DECAY, MAX_LABELS = 32, 60, 1500, 0.01, 1e-4, 20_000
THRESHOLD = 0.3
FEATURES = 2 * DIM + 2
_CHUNK, _SLICE = 1 << 19, 1 << 16

#: Kinds of bytes: 0 white space, 1 letters (all of UTF-8's bytes above 127), 2 digits, 3 others.
_KIND = np.full(256, 3, dtype=np.int8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2


def index_vectors(keys: np.ndarray) -> np.ndarray:
    """[keys, DIM]: a fixed sparse ternary vector of each 64-bit key, from the key alone."""
    out, rows, chosen = np.zeros((len(keys), DIM), dtype=np.int8), np.arange(len(keys)), []
    for j in range(NONZERO):  # Floyd's draw of NONZERO different places
        draw = mix64(keys * np.uint64(NONZERO) + np.uint64(j) + np.uint64(0x9E3779B97F4A7C15))
        last = DIM - NONZERO + j
        at = ((draw >> np.uint64(1)) % np.uint64(last + 1)).astype(np.int64)
        for before in chosen:
            at = np.where(at == before, last, at)
        chosen.append(at)
        out[rows, at] = 1 - 2 * (draw & np.uint64(1)).astype(np.int8)
    return out


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, text) of each token; A-Z are lower-cased."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not len(raw):
        return none
    kind = _KIND[raw]
    edge = np.ones(len(raw) + 1, dtype=bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offs] = True
    starts = np.flatnonzero(edge[:-1])
    ends = np.append(starts[1:], len(raw))
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    if not len(starts):
        return none
    up, down = _POWERS.get(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_values(True)[raw] * up[: len(raw)])])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), np.searchsorted(offs, starts, "right") - 1


def _chunks(column: pa.Array):
    raw, offs = string_buffers(column)
    at = 0
    while at < len(offs) - 1:
        stop = max(at + 1, int(np.searchsorted(offs, offs[at] + _CHUNK, "right")) - 1)
        yield at, raw[offs[at] : offs[stop]], offs[at : stop + 1] - offs[at]
        at = stop


def _hashes(column: pa.Array):
    for _, raw, offs in _chunks(column):
        yield tokens(raw, offs)[0]


class Vocabulary:
    """The frequent words' hashes, sorted, and their vectors (a last row of zeros for all others)."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.vectors = words, None

    def find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, len(self.words))

    def learn(self, places: np.ndarray, sums: np.ndarray) -> None:
        """Context vectors: centred on what is near any word, of unit length, a byte a place."""
        mean = sums[:, :DIM].sum(axis=0) / max(1.0, sums[:, DIM].sum())
        context = sums[:, :DIM] - sums[:, DIM:] * mean
        context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-12)
        self.vectors = np.zeros((len(self.words) + 1, DIM), dtype=np.int8)
        self.vectors[places] = np.rint(127 * context)


def _add_contexts(total: np.ndarray, vocabulary: Vocabulary, hashes: np.ndarray, text: np.ndarray) -> None:
    """Add what stands around each vocabulary word, and its count, to ``total[word, DIM + 1]``."""
    distinct, local = np.unique(hashes, return_inverse=True)
    place, index = vocabulary.find(distinct), index_vectors(distinct)
    for a in range(0, len(hashes), _SLICE):
        lo, b = max(0, a - WINDOW), min(len(hashes), a + _SLICE)
        hi = min(len(hashes), b + WINDOW)
        own, of = index[local[lo:hi]], text[lo:hi]
        around = np.zeros_like(own)
        for d in range(1, WINDOW + 1):
            same = (of[d:] == of[:-d])[:, None]
            around[d:] += own[:-d] * same
            around[:-d] += own[d:] * same
        at = place[local[a:b]]
        order = np.argsort(at, kind="stable")
        order = order[: np.searchsorted(at[order], len(vocabulary.words))]
        if len(order):
            at = at[order]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            total[at[first], :DIM] += np.add.reduceat(around[a - lo :][order], first, axis=0, dtype=np.int32)
            total[at[first], DIM] += np.diff(np.append(first, len(at)))


def _contexts(state):
    def run(batches):
        vocabulary = state.value
        total = np.zeros((len(vocabulary.words), DIM + 1), dtype=np.int64)
        for batch in batches:
            for _, raw, offs in _chunks(batch.column(0)):
                _add_contexts(total, vocabulary, *tokens(raw, offs))
        some = np.flatnonzero(total[:, DIM])
        for a in range(0, len(some), 4096):
            part = some[a : a + 4096]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * (DIM + 1), pa.int32()), pa.array(total[part].reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), lists], names=["place", "sums"])

    return run


def pool(raw: np.ndarray, offs: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """[texts, FEATURES]: means of vectors, the length of the mean index vector (about 1 over the root of
    how many different words a text has in effect) and the number of tokens."""
    hashes, text = tokens(raw, offs)
    distinct, local = np.unique(hashes, return_inverse=True)
    table = np.concatenate([vocabulary.vectors[vocabulary.find(distinct)], index_vectors(distinct)], axis=1)
    n = len(offs) - 1
    sums = np.zeros((n, 2 * DIM))
    for a in range(0, len(hashes), _SLICE):
        of = text[a : a + _SLICE]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        sums[of[first]] += np.add.reduceat(table[local[a : a + _SLICE]], first, axis=0, dtype=np.int32)
    count = np.bincount(text, minlength=n)[:, None]
    scale = np.repeat([1 / 127, NONZERO**-0.5], DIM)
    means = sums * scale / np.maximum(count, 1)
    return np.concatenate([means, np.log(np.linalg.norm(means[:, DIM:], axis=1, keepdims=True) + 1e-3), np.log1p(count) / 10], axis=1)


def learn_vectors(docs: DataFrame, text_col: str = "text", share: float = SHARE) -> Vocabulary:
    """The vocabulary and its vectors, from all rows of ``docs``."""
    spark, texts = docs.sparkSession, docs.select(text_col)
    counts = materialise(arrow_map(texts, merge_counts(_hashes), "token long, c long").groupBy("token").agg(F.sum("c").alias("c")), "words")
    total = counts.agg(F.sum("c")).first()[0] or 0
    words = counts.filter(F.col("c") >= max(1.0, share * total)).select("token").toArrow()  # at most 1 / share rows
    vocabulary = Vocabulary(np.sort(words["token"].to_numpy().view(np.uint64)))
    state = spark.sparkContext.broadcast(vocabulary)
    sums = sum_rows(arrow_map(texts, _contexts(state), "place int, sums array<long>"), ["place"], "sums", DIM + 1).toArrow()  # a row a word
    vocabulary.learn(sums["place"].to_numpy(), sums["sums"].combine_chunks().flatten().to_numpy().reshape(-1, DIM + 1).astype(np.float64))
    return vocabulary


class Network:
    """Two layers and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.std
        out = rng.random(len(x)) < 0.1 if len(x) >= 100 else np.zeros(len(x), bool)
        self.p = {"a": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), "b": np.zeros(HIDDEN), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1)}
        self.temperature = 1.0
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        tx, ty, step = x[~out], y[~out], 0
        for _ in range(max(EPOCHS, STEPS * 256 // max(256, len(tx)))):  # few rows are seen more often
            order = rng.permutation(len(tx))
            for at in range(0, len(tx), 256):
                bx, by = tx[order[at : at + 256]], ty[order[at : at + 256]]
                h = np.tanh(bx @ self.p["a"] + self.p["b"])
                g = (1 / (1 + np.exp(-(h @ self.p["c"] + self.p["d"]))) - by) / len(bx)
                gh = np.outer(g, self.p["c"]) * (1 - h * h)
                grads = {"a": bx.T @ gh + DECAY * self.p["a"], "b": gh.sum(axis=0), "c": h.T @ g + DECAY * self.p["c"], "d": np.array([g.sum()])}
                step += 1
                for k, gk in grads.items():
                    first[k] += 0.1 * (gk - first[k])
                    second[k] += 0.001 * (gk * gk - second[k])
                    self.p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        if out.any():
            self.temperature = temperature(self._logits(x[out]), y[out])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p["a"] + self.p["b"]) @ self.p["c"] + self.p["d"][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self._logits((x - self.mean) / self.std) / self.temperature))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least cross entropy against Platt's targets.

    The loss is convex in 1 / t; its slope is bisected, so the optimum is inside, never at a grid's end."""
    ones = y.sum()
    target = np.where(y > 0.5, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    low, high = 1e-6, 1e6  # of 1 / t
    for _ in range(80):
        mid = np.sqrt(low * high)
        slope = np.mean((0.5 * (1 + np.tanh(logits * mid / 2)) - target) * logits)
        low, high = (low, mid) if slope > 0 else (mid, high)
    return float(1 / low)


def _features(state):
    def run(batches):
        for batch in batches:
            x = [pool(raw, offs, state.value) for _, raw, offs in _chunks(batch.column(2))]
            flat = np.concatenate(x) if x else np.zeros((0, FEATURES))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()), pa.array(flat.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "label", "features"])

    return run


def fit(docs: DataFrame, labels: DataFrame, vocabulary, id_col: str, text_col: str, label_col: str, most: int = MAX_LABELS) -> Network | None:
    """A network of at most ``most`` labelled rows; only their texts are pooled."""
    rows = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).distinct()
    n = rows.count()
    if n > most:  # a little more than asked for by hash, so that what is sorted, joined and sent stays bounded
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < int((1 << 20) * 1.1 * most / n) + 1)
    rows = F.broadcast(rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("text")]
    picked = texts.join(rows, "doc_id").orderBy(*order).limit(most).select("doc_id", "label", "text")  # repeated ids bring more rows
    got = arrow_map(picked, _features(vocabulary), "doc_id long, label int, features array<double>").toArrow()
    y = got["label"].to_numpy().astype(np.float64)
    if not 0 < y.sum() < len(y):
        return None
    return Network(got["features"].combine_chunks().flatten().to_numpy().reshape(len(y), -1), y)


def _score(state, network):
    def run(batches):
        net = network.value
        for batch in batches:
            s = [np.full(len(offs) - 1, 0.5) if net is None else net.score(pool(raw, offs, state.value)) for _, raw, offs in _chunks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(np.concatenate(s or [np.zeros(0)]), 0, 1), pa.float64())], names=["key", "score"])

    return run


def _scorer(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str):
    """A function of (key, text) rows that gives (key, score)."""
    context = docs.sparkSession.sparkContext
    with temporary_tables(docs.sparkSession):
        vocabulary = context.broadcast(learn_vectors(docs, text_col))
        network = context.broadcast(fit(docs, labels.filter(training), vocabulary, id_col, text_col, label_col))
    return lambda rows: arrow_map(rows, _score(vocabulary, network), "key long, score double")


def score_quality(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, score) of every row; ``training`` is a condition on the label rows."""
    score = _scorer(docs, labels, training, id_col, text_col, label_col)
    return score(docs.select(F.col(id_col).cast("long").alias("key"), text_col)).select(F.col("key").alias("doc_id"), "score")


def keep_good(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns kept.  A score belongs to a
    text, so the texts that are rejected go by their keys."""
    score = _scorer(docs, labels, training, id_col, text_col, label_col)
    key = F.xxhash64(text_col)
    bad = score(docs.select(key.alias("key"), text_col)).filter(F.col("score") < threshold)
    bad = materialise(bad.select(F.col("key").alias("_key")).distinct(), "rejected")
    gone = F.broadcast(bad) if bad.count() <= BROADCAST_IDS else bad
    return docs.withColumn("_key", key).join(gone, "_key", "left_anti").select(*docs.columns)
