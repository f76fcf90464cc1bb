"""Benchmark decontamination: BM25 over an inverted index of test items, by block-max WAND.

The test items are the indexed texts; every passage of every training text is a query.  With L
the longest item's words, a passage is two neighbouring runs of L words (so each run of up to L words
lies whole in some passage).  BM25 impacts are divided by what the item must at least reach: the
item's score against itself less the largest impacts that a passage could lack and still hold
``OVERLAP`` of the item's 5-word shingles.  Retrieval at that threshold therefore loses no leak.

1. Sums of block maxima bound every passage's score for each block of items (numpy, whole batch);
   passages below the threshold for all blocks are done.
2. The rest run document-at-a-time WAND inside the blocks that can reach it, with block maxima as
   the lists' bounds.
3. Retrieved pairs are verified: the shares of the item's, its question's and its answer's (its
   last sentence's) 5-word shingles that the passage holds.  A leak holds ``OVERLAP`` of the item,
   or of the question together with half of the answer.

Defined results: null or blank texts and items match nothing; repeated rows and repeated item ids
give each pair of ids once, with the largest overlap; rows without an id are not reported (no pair
names them); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import hash_of_words, shingles, small_batches, string_buffers, word_hashes

K1, B, SHINGLE, OVERLAP = 1.2, 0.75, 5, 0.8
#: Items of a block at least; blocks of an index at most (larger indexes have larger blocks).
BLOCK, MAX_BLOCKS = 4, 128
#: An index broadcast to the executors holds at most so many bytes of items; more items are
#: indexed in shards of that size, each run over all passages.
SHARD_BYTES = 4_000_000
#: Rows of block maxima that are held at once.
_GATHER = 50_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
SCHEMA = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def _item_shingles(words: np.ndarray) -> np.ndarray:
    return np.unique(shingles(words, np.array([0, len(words)]), SHINGLE)[0])


def question_and_answer(text: str) -> tuple[str, str]:
    """All sentences but the last, and the last; a single sentence is all question."""
    cuts = [m for m in _SENTENCE.finditer(text.strip())]
    body = text.strip()
    return (body[: cuts[-1].start()], body[cuts[-1].end() :]) if cuts and cuts[-1].start() and cuts[-1].end() < len(body) else (body, "")


class Index:
    """Impacts (as shares of the threshold), postings, block maxima and shingles of the items."""

    def __init__(self, items: list[tuple[int, str]], overlap: float = OVERLAP) -> None:
        rows = [(i, t, hash_of_words([w])) for i, t in items if i is not None for w in [t] if t and t.split()]
        self.ids = [i for i, _, _ in rows]
        self.texts = [t for _, t, _ in rows]
        words = [h for _, _, h in rows]
        n = len(rows)
        sizes = np.array([len(w) for w in words], dtype=float)
        self.longest = int(sizes.max(initial=1))
        df: dict[int, int] = defaultdict(int)
        for w in words:
            for t in np.unique(w).tolist():
                df[t] += 1
        self.terms = np.array(sorted(df), dtype=np.uint64)
        place = {t: k for k, t in enumerate(self.terms.tolist())}
        posts: list[list[tuple[int, float]]] = [[] for _ in place]
        self.whole, self.question, self.answer = [], [], []
        for k, w in enumerate(words):
            terms, tf = np.unique(w, return_counts=True)
            idf = np.array([np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in terms.tolist()])
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[k] / sizes.mean()))
            m = max(1, len(w) - SHINGLE + 1)
            short = min(len(w), max(_lacking(m, overlap), _lacking_parts(self.texts[k], overlap)))
            need = max(1e-9, float(np.sort(impact)[: max(0, len(impact) - short)].sum()) * (1 - 1e-9))
            for t, x in zip(terms.tolist(), (impact / need).tolist(), strict=True):
                posts[place[t]].append((k, x))
            q, a = question_and_answer(self.texts[k])
            self.whole.append(_item_shingles(w))
            self.question.append(_item_shingles(hash_of_words([q])))
            self.answer.append(_item_shingles(hash_of_words([a])) if a else None)
        block = max(BLOCK, -(-n // MAX_BLOCKS))
        self.blocks = -(-n // block)
        self.block_max = np.zeros((len(posts), max(1, self.blocks)), dtype=np.float32)
        self.local: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for t, p in enumerate(posts):
            for k, x in p:
                self.block_max[t, k // block] = max(self.block_max[t, k // block], x * (1 + 1e-6))
                self.local.setdefault((t, k // block), []).append((k, x))
        self.near = np.zeros(1 << 16, dtype=bool)
        self.near[(self.terms >> np.uint64(48)).astype(np.int64)] = True

    def lookup(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places among ``words``, term numbers) of the words that some item holds."""
        at = np.flatnonzero(self.near[(words >> np.uint64(48)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.terms, words[at]), len(self.terms) - 1)
        hit = self.terms[k] == words[at]
        return at[hit], k[hit]

    def wand(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """(item, score) of the block's items whose score against ``terms`` is at least 1.

        Document at a time: the pivot is the first item at which the block maxima of the lists
        up to it reach the threshold; lists before it jump to it; an item is scored only there.
        """
        lists = [(self.local[t, block], float(self.block_max[t, block])) for t in terms if (t, block) in self.local]
        cursors = [[post[0][0], 0, post, bound] for post, bound in lists]
        found = []
        while cursors:
            cursors.sort(key=_current)
            total, pivot = 0.0, None
            for c in cursors:
                total += c[3]
                if total >= 1:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            target = pivot
            if cursors[0][0] == pivot:
                score = sum(c[2][c[1]][1] for c in cursors if c[0] == pivot)
                if score >= 1:
                    found.append((pivot, score))
                target = pivot + 1
            alive = []
            for c in cursors:
                post, at = c[2], c[1]
                while c[0] < target:
                    at += 1
                    if at == len(post):
                        break
                    c[0] = post[at][0]
                else:
                    c[1] = at
                    alive.append(c)
            cursors = alive
        return found


def _current(cursor: list) -> int:
    return cursor[0]


def _lacking(shingle_count: int, overlap: float) -> int:
    """How many words at most a passage lacks that holds ``overlap`` of so many shingles."""
    return shingle_count - int(np.ceil(overlap * shingle_count - 1e-9))


def _lacking_parts(text: str, overlap: float) -> int:
    """The same for a passage that holds ``overlap`` of the question and half of the answer."""
    q, a = (len(x.split()) for x in question_and_answer(text))
    if not a:
        return 0
    # shingles across the seam may be missing without a word missing; a short part is one shingle
    lack = _lacking(max(1, q - SHINGLE + 1), overlap) + _lacking(max(1, a - SHINGLE + 1), 0.5)
    return lack


def _share(part, have: np.ndarray) -> float:
    return float(np.isin(part, have).mean()) if part is not None and len(part) else 0.0


def _search(index_of, overlap: float):
    def run(batches):
        index = index_of.value
        span = index.longest
        for batch in batches:
            out: dict[tuple[int, int], tuple] = {}
            ids = batch.column(0).to_pylist()
            raw, offs = string_buffers(batch.column(1))
            words, wo = word_hashes(raw, offs)
            runs = -(-np.diff(wo) // span)
            run_offs = np.concatenate([[0], np.cumsum(runs)])
            at, term = index.lookup(words)
            passing: list[tuple[int, list[int]]] = []
            if len(at):
                doc = np.searchsorted(wo, at, "right") - 1
                run_no = run_offs[doc] + (at - wo[doc]) // span
                key = np.unique((run_no.astype(np.uint64) << np.uint64(24)) | term.astype(np.uint64))
                run_no, term = (key >> np.uint64(24)).astype(np.int64), (key & np.uint64(0xFFFFFF)).astype(np.int64)
                have, first = np.unique(run_no, return_index=True)
                last = np.append(first[1:], len(term))
                run_doc = np.searchsorted(run_offs, have, "right") - 1
                # a run and the next one are a passage; one without any term adds nothing to the run before it
                paired = np.append((have[1:] == have[:-1] + 1) & (run_doc[1:] == run_doc[:-1]), False)
                lo = 0
                while lo < len(have):  # a bounded number of gathered rows of block maxima at a time
                    hi = max(lo + 1, int(np.searchsorted(first, first[lo] + _GATHER, "left")))
                    over = min(hi + 1, len(have))
                    a = first[lo]
                    sums = np.add.reduceat(index.block_max[term[a : last[over - 1]]], first[lo:over] - a, axis=0)
                    both = sums[: hi - lo].copy()
                    both[: over - lo - 1] += np.where(paired[lo : lo + over - lo - 1, None], sums[1:], 0)[: hi - lo]
                    passing.extend((lo + k, np.flatnonzero(both[k] >= 1).tolist()) for k in np.flatnonzero(both.max(axis=1) >= 1).tolist())
                    lo = hi
                for k, reached in passing:
                    d = int(run_doc[k])
                    if ids[d] is None:
                        continue
                    group = [k, k + 1] if paired[k] else [k]
                    terms = {t for g in group for t in term[first[g] : last[g]].tolist()}
                    hits = [h for block in reached for h in index.wand(list(terms), block)]
                    if not hits:
                        continue
                    a = wo[d] + (int(have[k]) - run_offs[d]) * span
                    passage = words[a : min(a + span * 2, wo[d + 1])]
                    held = _held(passage)
                    for item, score in hits:
                        whole, q, ans = _share(index.whole[item], held), _share(index.question[item], held), _share(index.answer[item], held)
                        if whole >= overlap - 1e-9 or (index.answer[item] is not None and q >= overlap - 1e-9 and ans >= 0.5):
                            row = (whole, score, q, ans)
                            pair = (ids[d], index.ids[item])
                            out[pair] = max(out.get(pair, row), row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in out], pa.int64()), pa.array([k[1] for k in out], pa.int64()), *(pa.array([v[j] for v in out.values()], pa.float64()) for j in (1, 0, 2, 3))],
                names=["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"],
            )

    return run


def _held(passage: np.ndarray) -> np.ndarray:
    """Shingles a passage holds, also those of shorter whole sequences (short items and parts)."""
    parts = [shingles(passage, np.array([0, len(passage)]), SHINGLE)[0]]
    for size in range(1, SHINGLE):
        if len(passage) >= size:
            starts = np.arange(len(passage) - size + 1)
            pieces = passage[(starts[:, None] + np.arange(size)).reshape(-1)]
            parts.append(_short(pieces, size))
    return np.concatenate(parts)


def _short(pieces: np.ndarray, size: int) -> np.ndarray:
    """Hashes that ``shingles`` gives for whole sequences of ``size`` words, many at once."""
    from kinseq.llm.common import mix64

    h = np.full(len(pieces) // size, size, dtype=np.uint64)
    for k in range(size):
        h = mix64(h * np.uint64(0x2545F4914F6CDD1D) + pieces[k::size])
    return h


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap) of every leak."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter("i is not null and t is not null")
    total = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = -(-total // shard_bytes) or 1
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null")
    found = None
    for shard in range(shards):
        rows = texts.filter(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == shard).orderBy("i", "t").collect()  # a bounded shard
        index = spark.sparkContext.broadcast(Index([(r.i, r.t) for r in rows], overlap))
        part = source.mapInArrow(_search(index, overlap), SCHEMA)
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("overlap", "score", "question_overlap", "answer_overlap")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.score", "m.overlap", "m.question_overlap", "m.answer_overlap")
