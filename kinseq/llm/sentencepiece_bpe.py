"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding follows the score-ordered agenda: among all adjacent symbol pairs whose concatenation is
a piece, the best-scored (the leftmost among equals) is merged first, until none is left; symbols
that are no piece fall back to bytes.  Where no piece holds a word mark after another character,
texts fall apart into independent chunks (a run of marks and what follows), and equal chunks are
encoded once a batch: short ones in lockstep (each step takes the head of every chunk's agenda at
once, in numpy), long ones with a heap.  Each Arrow batch is checked against the sentencepiece
library, id for id; a difference raises.

Defined results: null and empty texts are the begin and end ids alone; text of any length is
encoded whole; repeated rows are encoded alike; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseq.llm.common import _POWERS, _byte_values, joined, mix64, return_memory, small_batches, string_buffers

_MARK = "▁"
#: Chunks of more symbols go to the heap.
_LONG = 48


class Vocabulary:
    """Pieces, scores and the table of mergeable pairs of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, n = self.library, self.library.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, self.unk, dtype=np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        known = {self.pieces[i]: i for i in normal}
        if any(_MARK in p.lstrip(_MARK) for p in known):
            raise ValueError("a piece holds a word mark inside: chunks would not be independent")
        for p in list(known):  # characters that only occur inside pieces still are symbols
            for c in p:
                known.setdefault(c, len(known) + n)
        self.size = max(known.values()) + 1
        self.bare = {i: p for p, i in known.items() if i >= n}
        self.n = n
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for p, i in known.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        rank = {i: r for r, i in enumerate(sorted(normal, key=lambda i: (sp.get_score(i), -i)))}
        pairs = {}
        for p, i in known.items():
            for k in range(1, len(p)):
                left, right = known.get(p[:k]), known.get(p[k:])
                if left is not None and right is not None and i in rank:
                    pairs[left * self.size + right] = i
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ids = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.rank = np.full(self.size, -1, dtype=np.int32)
        for i, r in rank.items():
            self.rank[i] = r
        self._hash_pairs()

    def _hash_pairs(self) -> None:
        bits = 20
        while True:
            self.shift = np.uint64(64 - bits)
            slot = (mix64(self.pair_keys.astype(np.uint64)) >> self.shift).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            self.slots_keys = np.full((4, 1 << bits), -1, dtype=np.int64)
            self.slots_ids = np.zeros((4, 1 << bits), dtype=np.int32)
            sorted_slot = slot[order]
            nth = np.arange(len(order)) - np.searchsorted(sorted_slot, sorted_slot)
            if nth.max(initial=0) < 4:
                self.slots_keys[nth, sorted_slot] = self.pair_keys[order]
                self.slots_ids[nth, sorted_slot] = self.pair_ids[order]
                self.ways = int(nth.max(initial=0)) + 1
                return
            bits += 1

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece each pair makes, or -1."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2)
        slot = (mix64(key.astype(np.uint64)) >> self.shift).astype(np.int64)
        out = np.full(len(key), -1, dtype=np.int32)
        for way in range(self.ways):
            hit = self.slots_keys[way][slot] == key
            out[hit] = self.slots_ids[way][slot[hit]]
        return out

    # -- one chunk: the agenda as a heap

    def agenda(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        sym, before, after = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
        table = dict(zip(self.pair_keys.tolist(), self.pair_ids.tolist(), strict=True)) if not hasattr(self, "_table") else self._table
        self._table = table
        heap: list = []

        def push(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and sym[i] >= 0 and sym[j] >= 0 and (m := table.get(sym[i] * self.size + sym[j])) is not None:
                heapq.heappush(heap, (-int(self.rank[m]), i, j, sym[i], sym[j], m))

        for i in range(n - 1):
            push(i, i + 1)
        gone = [False] * n
        while heap:
            _, i, j, a, b, m = heapq.heappop(heap)
            if gone[i] or gone[j] or sym[i] != a or sym[j] != b or after[i] != j:
                continue
            sym[i], gone[j], after[i] = m, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        return [s for s, g in zip(sym, gone, strict=True) if not g]

    # -- many chunks in lockstep

    def lockstep(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word) after all merges; ``word`` is sorted."""
        done_sym, done_word = [], []
        made = self._pairs(sym, word)
        while len(sym):
            prio = np.where(made >= 0, self.rank[made], -1)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lengths = np.diff(np.append(starts, len(word)))
            best = np.repeat(np.maximum.reduceat(prio, starts), lengths)
            still = best >= 0
            if not still.all():
                done_sym.append(sym[~still])
                done_word.append(word[~still])
                sym, word, made, prio, best = sym[still], word[still], made[still], prio[still], best[still]
                if not len(sym):
                    break
            at = np.flatnonzero(prio == best)
            w = word[at]
            at = at[np.concatenate([[True], w[1:] != w[:-1]])]
            sym[at] = made[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            at = place[at]
            sym, word, made = sym[keep], word[keep], made[keep]
            for changed in (at, at[at > 0] - 1):
                nxt = np.minimum(changed + 1, len(sym) - 1)
                same = (changed + 1 < len(sym)) & (word[nxt] == word[changed])
                made[changed] = np.where(same, self.merged(sym[changed], sym[nxt]), -1)
        if not done_sym:
            return sym, word
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> np.ndarray:
        made = np.full(len(sym), -1, dtype=np.int32)
        if len(sym) > 1:
            made[:-1] = np.where(word[1:] == word[:-1], self.merged(sym[:-1], sym[1:]), -1)
        return made

    # -- texts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with begin and end, and each text's offset among them."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.replace_substring(texts.fill_null(""), _MARK, " ")
        raw, offs = string_buffers(texts)
        sizes = np.diff(offs)
        full = sizes > 0
        new_offs = np.concatenate([[0], np.cumsum(sizes + full)])
        data = np.full(new_offs[-1], 32, dtype=np.uint8)
        fill = np.ones(len(data), dtype=bool)
        fill[new_offs[:-1][full]] = False
        data[fill] = raw
        del fill
        space = data == 32
        lead = space.copy()
        lead[1:] &= ~space[:-1]
        lead[new_offs[:-1][full]] = True
        starts = np.flatnonzero(lead)
        if not len(starts):
            ids = np.tile(np.array([self.bos, self.eos], dtype=np.int64), len(texts))
            return ids, np.arange(len(texts) + 1) * 2
        ends = np.append(starts[1:], len(data))
        keys = _span_hashes(data, starts, ends)
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        chunk_ids, chunk_offs = self._chunks(data, starts[first], ends[first])
        lengths = np.diff(chunk_offs)[inverse]
        chunk_doc = np.searchsorted(starts, new_offs)
        per_doc = np.diff(np.concatenate([[0], np.cumsum(lengths)])[chunk_doc])
        out_offs = np.concatenate([[0], np.cumsum(per_doc + 2)])
        body = _ragged(chunk_offs[:-1][inverse], lengths)
        ids = np.empty(out_offs[-1], dtype=np.int64)
        inner = np.ones(len(ids), dtype=bool)
        inner[out_offs[:-1]] = inner[out_offs[1:] - 1] = False
        ids[inner] = chunk_ids[body]
        ids[out_offs[:-1]] = self.bos
        ids[out_offs[1:] - 1] = self.eos
        return ids, out_offs

    def _chunks(self, data, starts, ends):
        """Ids of distinct chunks and each one's offset."""
        sizes = ends - starts
        flat = data[_ragged(starts, sizes)]
        byte_offs = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer(flat.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        lead = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])
        char_offs = lead[byte_offs]
        points = np.where(points == 32, ord(_MARK), points)
        sym = self.of_char[points]
        sym = np.where(sym < 0, (-1 - points).astype(np.int32), sym)
        counts = np.diff(char_offs)
        word = np.repeat(np.arange(len(counts)), counts)
        short = np.repeat(counts <= _LONG, counts)
        syms, words = self.lockstep(sym[short].copy(), word[short])
        long_syms, long_words = [syms], [words]
        for k in np.flatnonzero(counts > _LONG):
            got = self.agenda(sym[char_offs[k] : char_offs[k + 1]].tolist())
            long_syms.append(np.array(got, dtype=np.int64))
            long_words.append(np.full(len(got), k))
        syms, words = np.concatenate(long_syms), np.concatenate(long_words)
        order = np.argsort(words, kind="stable")
        ids, repeat = self._fallback(syms[order])
        words = np.repeat(words[order], repeat)
        return ids, np.searchsorted(words, np.arange(len(counts) + 1))

    def _fallback(self, syms):
        """Ids, with bytes for symbols that are no piece; and how many ids each symbol gave."""
        odd = (syms < 0) | (syms >= self.n)
        repeat = np.ones(len(syms), dtype=np.int64)
        if not odd.any():
            return syms.astype(np.int64), repeat
        kinds, which = np.unique(syms[odd], return_inverse=True)
        texts = [(chr(-1 - int(k)) if k < 0 else self.bare[int(k)]).encode("utf-8", "surrogatepass") for k in kinds]
        sizes = np.array([len(t) for t in texts])
        repeat[odd] = sizes[which]
        ids = np.repeat(syms.astype(np.int64), repeat)
        flat = self.byte_ids[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        offs = np.concatenate([[0], np.cumsum(sizes)])
        ids[np.repeat(odd, repeat)] = flat[_ragged(offs[:-1][which], sizes[which])]
        return ids, repeat

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control ids give nothing, byte ids are joined as UTF-8."""
        if not hasattr(self, "_bytes"):
            self._bytes = [p.replace(_MARK, " ").encode() for p in self.pieces]
            for b, i in enumerate(self.byte_ids.tolist()):
                self._bytes[i] = bytes([b])
            for i in (self.bos, self.eos):
                self._bytes[i] = b""
            self._bytes[self.unk] = " ⁇ ".encode()
        return b"".join([self._bytes[i] for i in ids]).removeprefix(b" ").decode("utf-8", "replace")


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the spans (start, length), in turn."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return shift + np.arange(total)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, in pieces of bounded size."""
    values, out, at = _byte_values(False), np.empty(len(starts), dtype=np.uint64), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20), "right")))
        lo, hi = starts[at], ends[stop - 1]
        up, down = _POWERS.get(hi - lo + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[data[lo:hi]] * up[: hi - lo])])
        s, e = starts[at:stop] - lo, ends[at:stop] - lo
        out[at:stop] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _encode_batches(path: str, check: bool, decoded: bool):
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            texts = batch.column(1)
            ids, offs = vocab.encode(texts)
            lists = [ids[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)]
            if check:
                for k, theirs in enumerate(vocab.library.encode([t or "" for t in texts.to_pylist()], add_bos=True, add_eos=True, num_threads=1)):
                    if lists[k].tolist() != theirs:
                        raise ValueError(f"ids of {batch.column(0)[k]} differ from the library's")
            columns = {"doc_id": batch.column(0), "ids": pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids, pa.int32()))}
            if decoded:
                texts = [vocab.decode(x.tolist()) for x in lists]
                if check and texts != [vocab.library.decode(x.tolist()) for x in lists]:
                    raise ValueError("decoded texts differ from the library's")
                columns["decoded_sha256"] = pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in texts], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _digest_batches(path: str):
    def run(batches):
        return_memory(above=1 << 25)
        vocab = vocabulary(path)
        for batch in joined(batches, 1000):
            texts = batch.column(1)
            ids, offs = vocab.encode(texts)
            n, ids_sha, text_sha = np.diff(offs), [], []
            known = texts.to_pylist()
            for at in range(0, len(known), 256):  # the lists of ids are the largest things here
                own = [ids[a:b] for a, b in zip(offs[:-1][at : at + 256], offs[1:][at : at + 256], strict=True)]
                theirs = vocab.library.encode([t or "" for t in known[at : at + 256]], add_bos=True, add_eos=True, num_threads=1)
                for k, (x, text) in enumerate(zip(own, vocab.library.decode(theirs), strict=True)):
                    mine = x.tolist()
                    if mine != theirs[k]:
                        raise ValueError(f"ids of {batch.column(0)[at + k]} differ from the library's")
                    decoded = vocab.decode(mine)
                    if decoded != text:
                        raise ValueError(f"the decoded text of {batch.column(0)[at + k]} differs from the library's")
                    ids_sha.append(hashlib.sha256(x.astype("<u4").tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>), begin and end ids included; ``decoded`` adds the digest of the text
    that the ids are decoded to, decoded_sha256."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(_encode_batches(model, check, decoded), "doc_id long, ids array<int>" + ", decoded_sha256 string" * decoded)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of ``ids``; null ids give null."""

    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else vocab.decode(x) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), ids_col).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), each batch checked against the library."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(_digest_batches(model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
