"""Language-model scoring with a log-bilinear neural model.

Tokens are words (A-Z lower-cased) and one end per text.  Exact training counts of every token are
summed over the corpus; they give the base score and the model's vocabulary: the tokens with at least
``SHARE`` of all training tokens (by that definition at most ``1 / SHARE``, however large the corpus
is), and the end.  All other tokens, those never seen included, enter contexts and are predicted through
one of ``TAILS`` symbols by their last three bytes; inside such a symbol a token has the share of its
discounted count, and the discounted mass is that of one unseen token, so that the probabilities
of the known tokens and of an unseen one for each symbol sum to one.

The log-bilinear model predicts a symbol w from the ``ORDER`` symbols before it: h = sum_i r[c_i] M_i, with a
matrix for each position.  The output is factored in groups of neighbours by frequency: group g has the
logit h q[g] + b[g] among the groups, w has h q[w] + b[w] in its group.  Both are trained in numpy by
noise-contrastive estimation on minibatches of real contexts with sampled noise (from the groups', and
from the group's own, frequencies).  The model comes from every training text: learners in parallel each
train on their part of all of them, and their rows are averaged, weighted by how often each was used.
So that these averages are of like vectors, all start from the same tables: those fitted on the driver to
at most ``FIRST`` tokens of texts drawn by hash, which the learners read again.
Scores are normalised exactly: batched matrix products of all contexts with all groups, and of
those that fall in a group with all of its symbols.

Only the ``HEAD`` most frequent tokens and their counts are broadcast.  Other tokens, a few per
text, are joined with the counts by a shuffle and their sums added to what the text's task has summed
itself; which way a token's count comes changes no result.

Defined results: null and empty texts are one end token; without training tokens the scores are
0; rows without an id teach (their remainder is not 2) and are scored; repeated rows are scored
alike; extra columns are ignored; texts of any length are scored whole, in slices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import arrow_map, joined, materialise, merge_counts, return_memory, string_buffers, sum_rows, temporary_tables, word_hashes

TAILS = 1 << 10
END = np.uint64(0x454E445F4F465000)
SHARE, HEAD, ORDER, DIM = 2.0**-17, 1 << 17, 3, 32
NOISE, BATCH, RATE, FIRST, PASSES, LEARNER, LEARNERS = 16, 4096, 0.1, 1_000_000, 4, 2_000_000, 1024
_SLICE, _BITS, _OFTEN = 1 << 14, 18, 16
_ARRAYS = 1 << 25  # the same arrays, smaller than so many bytes, come and go with every batch


def token_stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included (their last ten bits tell the symbol of their last bytes), and
    each text's offset among them."""
    words, offs = word_hashes(*string_buffers(column), tails=True)
    ends = offs[1:] + np.arange(len(offs) - 1)
    out = np.empty(len(words) + len(ends), dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[ends] = False
    out[inner] = words
    out[ends] = END
    return out, offs + np.arange(len(offs))


def _tokens(column: pa.Array):
    return_memory(above=_ARRAYS)
    yield token_stream(column)[0]


class Symbols:
    """Head tokens with their counts and symbols; the symbols' frequencies, groups and shares."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, total: int, distinct: int, once: int, twice: int, tail_mass: np.ndarray, tail_types: np.ndarray) -> None:
        self.total, self.distinct = total, distinct
        place = np.argsort(tokens)
        self.tokens, self.counts = tokens[place], counts[place]
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        known = np.flatnonzero((self.counts >= max(2.0, SHARE * total)) | (self.tokens == END))
        mass = np.append(self.counts[known], tail_mass).astype(np.float64)
        order = np.argsort(-mass, kind="stable")  # symbols by frequency
        self.k = len(mass)
        number = np.empty(self.k, dtype=np.int32)
        number[order] = np.arange(self.k)
        self.of_tail = number[len(known) :]
        self.symbol = np.full(len(tokens), -1, dtype=np.int32)
        self.symbol[known] = number[: len(known)]
        self.mass = np.maximum(mass[order], 0.5)
        self.pad = self.k  # what stands before a text
        self.kind = np.uint16 if self.k < 1 << 16 else np.int32  # the narrower are sorted faster
        # inside a tail symbol: mass, and the log10 share of an unseen token
        self.tail_mass, self.tail_types = np.maximum(tail_mass, 1.0).astype(np.float64), tail_types
        self.unseen = np.log10(np.where(tail_types > 0, self.discount * tail_types / self.tail_mass, 1.0))
        inside = np.log10(np.maximum(self.counts - self.discount, 1e-9) / self.tail_mass[(self.tokens & np.uint64(TAILS - 1)).astype(np.int64)])
        self.inside = np.append(np.where(self.symbol < 0, inside, 0.0), 0.0)  # the last for -1
        # where the search for a token starts, by its first bits
        self.first = np.searchsorted(self.tokens, np.arange(1 << _BITS, dtype=np.uint64) << np.uint64(64 - _BITS)).astype(np.int32)
        root = np.cumsum(np.sqrt(self.mass))
        groups = max(1, int(0.6 * np.sqrt(self.k)))
        self.group = np.minimum((root / root[-1] * groups).astype(np.int32), groups - 1)
        self.group = np.unique(self.group, return_inverse=True)[1].astype(np.int32)
        self.bounds = np.append(np.flatnonzero(np.append(True, self.group[1:] != self.group[:-1])), self.k)
        self.in_group = np.log(self.mass / np.add.reduceat(self.mass, self.bounds[:-1])[self.group])
        self.of_group = np.log(np.add.reduceat(self.mass, self.bounds[:-1]) / self.mass.sum())

    def base(self, c):
        return np.log10((c + 1.0) / (self.total + self.distinct + 1.0))

    def find(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the head, or -1; symbol)"""
        tail = self.of_tail[(stream & np.uint64(TAILS - 1)).astype(np.int64)]
        if not len(self.tokens):
            return np.full(len(stream), -1), tail
        tokens = np.append(self.tokens, np.uint64(2**64 - 1))
        at = self.first[stream >> np.uint64(64 - _BITS)]
        left = np.flatnonzero(tokens[at] < stream)
        while len(left):  # a few tokens have the same first bits
            at[left] += 1
            left = left[tokens[at[left]] < stream[left]]
        at = np.minimum(at, len(self.tokens) - 1)
        at = np.where(self.tokens[at] == stream, at, -1)
        own = self.symbol[at]
        return at, np.where((at >= 0) & (own >= 0), own, tail)

    def share(self, at: np.ndarray, stream: np.ndarray) -> np.ndarray:
        """log10 share of head tokens in their symbols: 0 for those with a symbol of their own."""
        return self.inside[at]


def contexts(symbols: np.ndarray, offs: np.ndarray, pad: int) -> np.ndarray:
    """[ORDER, tokens]: the symbols one, two, ... before each in its text."""
    out = np.full((ORDER, len(symbols)), pad, dtype=np.int32)
    place = np.arange(len(symbols)) - np.repeat(offs[:-1], np.diff(offs))
    for d in range(1, ORDER + 1):
        out[d - 1, d:] = symbols[:-d]
        out[d - 1, place < d] = pad
    return out


def _by_row(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the sums of their gradients and how many there were; rows met most often first."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    times = np.diff(np.append(first, len(rows)))
    by = np.argsort(-times, kind="stable")
    first, times = first[by], times[by]
    out = grads.take(order[first], axis=0)
    more = np.searchsorted(-times, -np.arange(_OFTEN + 1))  # how many are met more often than so
    often = more[_OFTEN]
    for i in range(often):
        out[i] = grads.take(order[first[i] : first[i] + times[i]], axis=0).sum(axis=0)
    for j in range(1, _OFTEN):  # the others: all second ones, all third ones, ...
        if more[j] > often:
            out[often : more[j]] += grads.take(order[first[often : more[j]] + j], axis=0)
    return rows[first], out, times


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


class LogBilinear:
    """``p``: r (contexts), m (position matrices, stacked), q and g (symbols and groups, the bias last)."""

    def __init__(self, symbols: Symbols, seed: int = 11) -> None:
        rng, s = np.random.default_rng(seed), symbols
        self.s = s
        small = lambda n: rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
        self.p = {
            "r": small(s.k + 1),
            "m": np.concatenate([np.eye(DIM, dtype=np.float32)] * ORDER),
            "q": np.column_stack([small(s.k), s.in_group]).astype(np.float32),
            "g": np.column_stack([small(len(s.of_group)), s.of_group]).astype(np.float32),
        }
        self.squares = {n: np.full(v.shape, 1e-2, dtype=np.float32) for n, v in self.p.items()}
        self._start(seed)

    def _start(self, seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.used = {n: np.zeros(len(v), dtype=np.int64) for n, v in self.p.items()}
        self.ends = np.cumsum(self.s.mass)
        self.logn_g, self.logn_q = ((x + np.log(NOISE)).astype(np.float32) for x in (self.s.of_group, self.s.in_group))

    def _update(self, name: str, rows, grads: np.ndarray, times) -> None:
        p, squares = self.p[name], self.squares[name]
        now = squares.take(rows, axis=0)
        now += grads * grads
        squares[rows] = now
        np.sqrt(now, out=now)
        np.divide(grads, now, out=now)
        now *= np.float32(RATE)
        p[rows] = p.take(rows, axis=0) - now
        self.used[name][rows] += times

    def _noise(self, low, high, size) -> np.ndarray:
        """Symbols drawn by frequency between points of the cumulated frequencies."""
        return np.minimum(np.searchsorted(self.ends, self.rng.uniform(low, high, size), "right"), self.s.k - 1)

    def step(self, ctx: np.ndarray, target: np.ndarray) -> None:
        """One minibatch of contexts [n, ORDER] and the symbols that follow them, in their order.

        The loss is NCE's, real against sampled, twice: the groups, and the symbols of each group.  Output
        vectors are used less the log of their noise in the place of the bias, which h does not see."""
        s, p, n = self.s, self.p, len(target)
        group, cuts = s.group[target], np.searchsorted(target, s.bounds)  # groups are ranges of symbols
        r = p["r"].take(ctx, axis=0).reshape(n, ORDER * DIM)
        h1 = np.ones((n, DIM + 1), dtype=np.float32)
        h1[:, :DIM] = r @ p["m"]
        # groups
        noise = s.group[self._noise(0, self.ends[-1], NOISE)]
        shifted = p["g"].copy()
        shifted[:, DIM] -= self.logn_g
        own, out = shifted.take(group, axis=0), shifted[noise]
        real, fake = _sigmoid(np.vecdot(h1, own)) - np.float32(1), _sigmoid(h1 @ out.T)
        dh = fake @ out
        own *= real[:, None]
        dh += own
        some = np.flatnonzero(np.diff(cuts))
        sums = [real[cuts[g] : cuts[g + 1]] @ h1[cuts[g] : cuts[g + 1]] for g in some]
        rows, sums, _ = _by_row(np.concatenate([some, noise]), np.concatenate([sums, fake.T @ h1]))
        self._update("g", rows, sums, np.bincount(np.concatenate([group, noise]), minlength=len(s.of_group))[rows])
        # the symbols of each group that has several
        some = some[np.diff(s.bounds)[some] > 1]
        if len(some):
            low, high = s.bounds[some], s.bounds[some + 1]
            noise = self._noise((self.ends[low] - s.mass[low])[:, None], self.ends[high - 1][:, None], (len(some), NOISE))
            own, out = p["q"].take(target, axis=0), p["q"].take(noise, axis=0)
            own[:, DIM] -= self.logn_q[target]
            out[:, :, DIM] -= self.logn_q[noise]
            real = _sigmoid(np.vecdot(h1, own)) - np.float32(1)
            real[(np.diff(s.bounds) == 1)[group]] = 0
            fake, drawn = np.zeros((n, NOISE), dtype=np.float32), np.empty_like(out)
            parts = [slice(a, b) for a, b in zip(cuts[some].tolist(), cuts[some + 1].tolist())]
            for part, vectors in zip(parts, out):
                np.matmul(h1[part], vectors.T, out=fake[part])
            _sigmoid(fake)
            for part, vectors, grads in zip(parts, out, drawn):
                dh[part] += fake[part] @ vectors
                np.matmul(fake[part].T, h1[part], out=grads)
            own *= real[:, None]
            dh += own
            self._update("q", *_by_row(np.concatenate([target, noise.reshape(-1).astype(target.dtype)]), np.concatenate([real[:, None] * h1, drawn.reshape(-1, DIM + 1)])))
        dh = np.ascontiguousarray(dh[:, :DIM])
        back = (dh @ p["m"].T).reshape(-1, DIM)
        self._update("m", np.arange(ORDER * DIM), r.T @ dh / np.float32(np.sqrt(n)), n)
        self._update("r", *_by_row(ctx.reshape(-1), back))

    def train(self, symbols: np.ndarray, offs: np.ndarray) -> None:
        """One pass over the texts' symbols in drawn order."""
        return_memory(above=_ARRAYS)
        ctx = np.ascontiguousarray(contexts(symbols, offs, self.s.pad).T.astype(self.s.kind))
        order, symbols = self.rng.permutation(len(symbols)), symbols.astype(self.s.kind)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            some = some[np.argsort(symbols[some], kind="stable")]
            self.step(ctx[some], symbols[some])

    def copy(self, seed: int) -> LogBilinear:
        """The same tables to train further, with steps as small as they have become and draws of its own."""
        out = LogBilinear.__new__(LogBilinear)
        out.s, out.p, out.squares = self.s, *({n: v.copy() for n, v in x.items()} for x in (self.p, self.squares))
        out._start(seed)
        return out

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """What scoring needs: the context vectors times their matrices, and the output vectors.  The first
    position's vectors end with a one, that the bias is counted."""

    def __init__(self, model: LogBilinear) -> None:
        p, m = model.p, model.p["m"].reshape(ORDER, DIM, DIM)
        self.s, self.q, self.g = model.s, p["q"], p["g"]
        self.r = np.stack([np.column_stack([p["r"] @ m[c], np.full(len(p["r"]), c == 0, dtype=np.float32)]) for c in range(ORDER)])

    def log_probs(self, symbols: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Natural log-probability of each symbol after those before it."""
        ctx, out, s = contexts(symbols, offs, self.s.pad), np.zeros(len(symbols)), self.s
        for at in range(0, len(symbols), _SLICE):
            order = at + np.argsort(symbols[at : at + _SLICE].astype(s.kind), kind="stable")  # groups are ranges of symbols
            target = symbols[order]
            h = sum(self.r[c].take(ctx[c].take(order), axis=0) for c in range(ORDER))
            got = _chosen(h @ self.g.T, s.group[target])
            cuts = np.searchsorted(target, s.bounds)
            for g in np.flatnonzero(np.diff(cuts)):
                lo, hi = s.bounds[g], s.bounds[g + 1]
                if hi - lo > 1:
                    step = max(1, (1 << 22) // int(hi - lo))  # bounds the product
                    for first in range(cuts[g], cuts[g + 1], step):
                        few = slice(first, min(first + step, cuts[g + 1]))
                        got[few] += _chosen(h[few] @ self.q[lo:hi].T, target[few] - lo)
            out[order] = got
        return out


def _chosen(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of the softmax at ``target`` in each row."""
    if logits.max() > 60 or logits.min() < -60:  # else no power leaves the range of the type
        logits -= logits.max(axis=1, keepdims=True)
    picked = logits[np.arange(len(target)), target]
    np.exp(logits, out=logits)
    return (picked - np.log(logits @ np.ones(logits.shape[1], dtype=np.float32))).astype(np.float64)


# --------------------------------------------------------------------------- training over the corpus


def _encode(state):
    def run(batches):
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 20
        return_memory(above=_ARRAYS)
        for batch in joined(batches, 500):
            stream, offs = token_stream(batch.column(0))
            symbols = state.value.find(stream)[1].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(symbols))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(lists), number, np.int64)), lists], names=["part", "symbols"])
            number += 1

    return run


def _streams(batches, column: int, most: int = LEARNER // 4):
    """(symbols, offsets) of about ``most`` symbols at a time."""
    held, n = [], 0
    for batch in batches:
        lists = batch.column(column)
        held.append((lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())))
        n += len(held[-1][0])
        if n >= most:
            yield np.concatenate([h[0] for h in held]), np.append(0, np.cumsum(np.concatenate([h[1] for h in held])))
            held, n = [], 0
    if n:
        yield np.concatenate([h[0] for h in held]), np.append(0, np.cumsum(np.concatenate([h[1] for h in held])))


_TABLES = ("r", "m", "q", "g")


def _learn(state):
    """A learner: trains the broadcast model on its rows; the rows of its tables, times their weight."""

    def run(batches):
        context = TaskContext.get()
        model = state.value.copy(100 + (context.partitionId() if context else 0))
        for symbols, offs in _streams(batches, 1):
            model.train(symbols, offs)
        for number, name in enumerate(_TABLES):
            some = np.flatnonzero(model.used[name])
            for at in range(0, len(some), 8192):
                rows = some[at : at + 8192]
                weight = model.used[name][rows].astype(np.float64)[:, None]
                values = np.zeros((len(rows), DIM + 2))
                values[:, : model.p[name].shape[1]] = model.p[name][rows] * weight
                values[:, DIM + 1] = weight[:, 0]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * (DIM + 2), pa.int32()), pa.array(values.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), number, np.int32)), pa.array(rows, pa.int32()), lists], names=["tab", "row", "v"])

    return run


def fit(texts: DataFrame, symbols: Symbols) -> LogBilinear:
    """The model of all training ``texts(text)``."""
    spark = texts.sparkSession
    state = spark.sparkContext.broadcast(symbols)
    mean = max(1.0, symbols.total / max(1, texts.count()))
    model, share = LogBilinear(symbols), min(1.0, FIRST / max(1, symbols.total))
    # where learners start: drawn by hash to about FIRST tokens, then as many whole texts as hold at most that many
    drawn = texts.filter(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = drawn.select("text", F.octet_length("text").alias("size")).filter(F.col("size") <= 64 * FIRST).orderBy(F.xxhash64("text", F.lit(7)), "text").limit(int(2 * FIRST / mean) + 1)
    first = arrow_map(drawn.select("text"), _encode(state), "part long, symbols array<int>").toArrow()
    parts = list(_streams(first.to_batches(), 1, FIRST))
    for _ in range(PASSES):
        for part in parts:
            model.train(*part)
    # all texts: with more tokens there are more learners, and beyond LEARNERS of them each reads more
    learners = max(1, min(LEARNERS, int(symbols.total / LEARNER)))
    dealt = arrow_map(texts, _encode(state), "part long, symbols array<int>").repartition(learners, F.xxhash64("part"))
    rows = arrow_map(dealt, _learn(spark.sparkContext.broadcast(model)), "tab int, row int, v array<double>")
    got = sum_rows(rows, ["tab", "row"], "v", DIM + 2).toArrow()  # the model's rows, whatever the input
    tab, row = got["tab"].to_numpy(), got["row"].to_numpy()
    values = got["v"].combine_chunks().flatten().to_numpy().reshape(-1, DIM + 2)
    for number, name in enumerate(_TABLES):
        mine, width = tab == number, model.p[name].shape[1]
        model.p[name][row[mine]] = values[mine, :width] / values[mine, DIM + 1 :]
    return model


# --------------------------------------------------------------------------- scoring


def _score(state):
    def run(batches):
        scorer = state.value
        symbols, context = scorer.s, TaskContext.get()
        key = (context.partitionId() if context else 0) << 40
        return_memory(above=_ARRAYS)
        base = np.append(symbols.base(symbols.counts), 0.0)
        for batch in batches:
            stream, offs = token_stream(batch.column(1))
            at, number = symbols.find(stream)
            log_p = scorer.log_probs(number, offs) / np.log(10) + symbols.share(at, stream)
            texts = len(offs) - 1
            tail = np.flatnonzero(at < 0)
            owner = np.searchsorted(offs, tail, "right") - 1
            tokens = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(texts + 1)), pa.int32()), pa.array(stream[tail].view(np.int64)))
            known = np.add.reduceat((at >= 0).astype(np.int64), offs[:-1]) if texts else np.zeros(0, np.int64)
            sums = [np.add.reduceat(x, offs[:-1]) if texts else np.zeros(0) for x in (base[at], log_p)]
            yield pa.RecordBatch.from_arrays([pa.array(key + np.arange(texts)), batch.column(0), pa.array(np.diff(offs)), pa.array(known), pa.array(sums[0]), pa.array(sums[1]), tokens], names=["key", "doc_id", "n_tokens", "n_head", "base", "log_p", "tail"])
            key += texts

    return run


def frequent(counts: DataFrame, end: int, most: int = HEAD) -> DataFrame:
    """The counts down to the band of counts in which the ``most``-th token lies, so that what is
    sorted next is little more than ``most`` rows, however many tokens there are."""
    band = F.floor(F.log2("c") * 8)
    total, low = 0, None
    for row in counts.groupBy(band.alias("band")).count().orderBy(F.desc("band")).collect():  # a few hundred bands
        total, low = total + row["count"], row.band
        if total >= most:
            break
    return counts if low is None else counts.filter((band >= low) | (F.col("token") == end))


def count_tokens(texts: DataFrame) -> tuple[DataFrame, DataFrame, Symbols, DataFrame]:
    """Written counts of all tokens of ``texts(text)``, the head's tokens, the symbols, and the tail symbols' sums."""
    counts = materialise(arrow_map(texts, merge_counts(_tokens), "token long, c long").groupBy("token").agg(F.sum("c").alias("c")), "counts")
    stats = counts.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    end = int(np.array([END]).view(np.int64)[0])
    head = frequent(counts.filter((F.col("c") >= 2) | (F.col("token") == end)), end).orderBy((F.col("token") != end), F.desc("c"), "token").limit(HEAD)
    head = materialise(head, "head")
    own = (F.col("c") >= max(2.0, SHARE * (stats[0] or 0))) | (F.col("token") == end)
    tails = counts.filter(~own).groupBy(F.col("token").bitwiseAND(F.lit(TAILS - 1)).cast("int").alias("s")).agg(F.sum("c").alias("mass"), F.count("*").alias("types"))
    tails = materialise(tails, "tails")
    mass, types = np.zeros(TAILS), np.zeros(TAILS)
    for r in tails.collect():  # TAILS rows
        mass[r.s], types[r.s] = r["mass"], r.types
    got = head.toArrow()  # HEAD rows
    tokens = got["token"].to_numpy().view(np.uint64) if len(got) else np.zeros(0, np.uint64)
    return counts, head, Symbols(tokens, got["c"].to_numpy(), stats[0] or 0, stats[1], stats[2], stats[3], mass, types), tails


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), training.alias("teach"))
    teach = source.filter("teach").select(F.coalesce("text", F.lit("")).alias("text"))
    with temporary_tables(spark):
        counts, head, symbols, tails = count_tokens(teach)
        state = spark.sparkContext.broadcast((fit(teach, symbols) if symbols.total else LogBilinear(symbols)).scorer())
        local = "key long, doc_id long, n_tokens long, n_head long, base double, log_p double, tail array<long>"
        scored = materialise(arrow_map(source.select("doc_id", "text"), _score(state), local), "scored")
        # the tail: each token's count, 0 if never seen
        tail = scored.select("key", F.explode("tail").alias("token")).groupBy("key", "token").agg(F.count("*").alias("n"))
        rare = counts.join(head.select("token"), "token", "left_anti")
        c, d = F.coalesce("c", F.lit(0)), symbols.discount
        inside = F.broadcast(tails)  # TAILS rows
        share = F.when(c > 0, (c - d) / F.greatest("mass", F.lit(1))).when(F.col("types") > 0, d * F.col("types") / F.greatest("mass", F.lit(1))).otherwise(1.0)
        found = tail.join(rare, "token", "left").withColumn("s", F.col("token").bitwiseAND(F.lit(TAILS - 1)).cast("int")).join(inside, "s", "left")
        sums = found.groupBy("key").agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("n_rare"),
            F.sum(F.col("n") * F.log10((c + 1.0) / float(symbols.total + symbols.distinct + 1))).alias("base_rare"),
            F.sum(F.col("n") * F.log10(share)).alias("log_rare"),
        )
        out = scored.drop("tail").join(sums, "key", "left")
        add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
        log_p = add("log_p", "log_rare") if symbols.total else F.lit(0.0)
        columns = ["doc_id", "n_tokens", add("n_head", "n_rare").alias("n_known"), F.lit(symbols.total).cast("long").alias("train_tokens"), add("base", "base_rare").alias("base_score"), log_p.alias("score")]
        return materialise(out.select(*columns), "scores", keep=True)
