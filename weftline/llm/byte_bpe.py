"""Byte-level BPE by matrices: encoding and decoding.

Distinct pre-tokens of a batch are laid out in padded matrices, one for each bucket of lengths. In every round each row
merges its leftmost pair of lowest rank; the pair's rank comes from an open-addressed hash table, only the two pairs
beside a merge are looked up again, and rows that can't merge any more leave the matrix.

A round costs a row's length, so a pre-token of more than `LONG_BYTES` bytes, whose rounds would be as many as its bytes,
leaves the matrices for a heap of its pairs with the same order of merges: by rank, then from the left.

Edge cases: null text is empty; an empty text has no ids, whose digest is that of the empty string; repeated rows and
null ids give a row each; ties of rank go to the left; an empty table gives an empty result; further columns, whatever
their names, are not looked at; texts and pre-tokens of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches, ready, table, texts
from .encoders import LIMIT, PieceEncoder, _slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NONE = np.int32(2**31 - 1)
#: Bytes of a pre-token above which it is merged by a heap.
LONG_BYTES = 1024


class PairTable:
    """(left id, right id) -> id of the joined bytes; open addressing with linear probing in numpy arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        self.bits = max(4, (4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        left, right = (np.fromiter((k[i] for k in pairs), np.int64, len(pairs)) for i in (0, 1))
        keys, values = left << 32 | right, np.fromiter(pairs.values(), np.int32, len(pairs))
        at, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self.keys[at] == -1)
            slots, chosen = np.unique(at[free], return_index=True)
            put = free[chosen]
            self.keys[slots], self.values[slots] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs, NONE where there is no such entry. Negative ids never match."""
        keys = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], NONE)
        open_ = np.flatnonzero((out == NONE) & (self.keys[at] != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[at[open_]]
            found = hit == keys[open_]
            out[open_[found]] = self.values[at[open_[found]]]
            open_ = open_[~found & (hit != -1)]
        return np.where((left < 0) | (right < 0), NONE, out)


class MatrixBpe(PieceEncoder):
    """Encodes as tiktoken does, and decodes."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, limit: int = LIMIT) -> None:
        super().__init__(limit)
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        ranks = self.ranks
        self.pattern = regex.compile(pattern)
        pairs = {(ranks[t[:i]], ranks[t[i:]]): r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.pairs, self.pair_ids = PairTable(pairs), {a << 32 | b: r for (a, b), r in pairs.items()}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.token = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.token[r] = t
        self.decimal = [str(i).encode() for i in range(len(self.token))]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens one after another, number of ids of each)."""
        known = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        rows, parts = [np.flatnonzero(known >= 0)], [known[known >= 0, None].astype(np.int32)]
        sizes = np.ones(len(words), np.int64)
        left = np.flatnonzero(known < 0)
        long = np.fromiter((len(words[i]) > LONG_BYTES for i in left.tolist()), bool, len(left))
        for i in left[long].tolist():
            ids = self.merge_long(words[i])
            rows.append(np.array([i]))
            parts.append(ids[None, :])
            sizes[i] = len(ids)
        left = left[~long]
        lengths = np.fromiter((len(words[i]) for i in left.tolist()), np.int64, len(left))
        buckets = np.where(lengths <= 16, lengths, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for width in np.unique(buckets).tolist():
            members = left[buckets == width]
            step = max(1, 4_000_000 // width)
            for a in range(0, len(members), step):
                at = members[a : a + step]
                for r, ids, n in self._rounds([words[i] for i in at.tolist()], at, width):
                    rows.append(r)
                    parts.append(ids)
                    sizes[r] = n
        starts = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        for r, ids in zip(rows, parts, strict=True):
            inside = np.arange(ids.shape[1]) < sizes[r, None]
            out[(starts[r, None] + np.arange(ids.shape[1]))[inside]] = ids[inside]
        return out, sizes

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long pre-token. The heap holds a pair's rank and place; pairs that are gone by their turn are passed over."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        rank = self.pairs.find(ids[:-1], ids[1:])
        at = np.flatnonzero(rank != NONE)
        heap = sorted(zip(rank[at].tolist(), at.tolist(), strict=True))
        get, n = self.pair_ids.get, len(ids)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        now = rank.tolist() + [int(NONE)]  # rank of the pair that begins at a place, NONE where there is none
        while heap:
            r, i = heapq.heappop(heap)
            if now[i] != r:
                continue
            j = after[i]
            ids[i], now[j], ids[j], k = r, int(NONE), -1, after[j]
            after[i] = k
            now[i] = int(NONE)
            if k < n:
                before[k] = i
                if (x := get(r << 32 | ids[k])) is not None:
                    now[i] = x
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0:
                x = get(ids[h] << 32 | r)
                now[h] = int(NONE) if x is None else x
                if x is not None:
                    heapq.heappush(heap, (x, h))
        return np.array([x for x in ids if x >= 0], np.int32)

    def _rounds(self, words: list[bytes], at: np.ndarray, width: int):
        """Yields (rows, their ids padded, their lengths) as rows come to their end."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[raw], np.int32(-1))
        rank = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width - 1)
        while len(ids):
            j = rank.argmin(axis=1)  # the leftmost of equal ranks
            best = rank[np.arange(len(ids)), j]
            done = best == NONE
            if done.any():
                yield at[done], ids[done], lengths[done]
                go = ~done
                if not go.any():
                    return
                width = int(lengths[go].max())
                ids, rank, at, lengths, j, best = ids[go, :width], rank[go, : width - 1], at[go], lengths[go], j[go], best[go]
            n, cols = np.arange(len(ids)), np.arange(ids.shape[1])
            # Close the gap: what stands right of a merged pair moves left by one.
            source = cols[None, :] + (cols[None, :] > j[:, None])
            padded = np.concatenate([ids, np.full((len(ids), 1), -1, np.int32)], axis=1)
            ids = np.take_along_axis(padded, source, axis=1)
            ids[n, j] = best
            padded = np.concatenate([rank, np.full((len(rank), 1), NONE, np.int32)], axis=1)
            rank = np.take_along_axis(padded, source[:, :-1], axis=1)
            lengths = lengths - 1
            more = j + 1 < ids.shape[1]
            rank[n[more], j[more]] = self.pairs.find(best[more], ids[n[more], j[more] + 1])
            more = j > 0
            rank[n[more], j[more] - 1] = self.pairs.find(ids[n[more], j[more] - 1], best[more])

    def _tokens(self, tokens: list[str], first: np.ndarray) -> list[bytes]:
        """Ids of pieces whose pre-tokens follow each other; first: where each piece begins among them."""
        number = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
        ids, sizes = self.merge([t.encode() for t in number])
        which = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        values = _slices(ids, np.cumsum(sizes) - sizes)
        ends = np.append(first[1:], len(tokens))
        single = ends - first == 1
        heads = which[first].tolist()
        return [values[h] if one else b"".join([values[k] for k in which[a:b]]) for h, one, a, b in zip(heads, single.tolist(), first.tolist(), ends.tolist(), strict=True)]

    def learn(self, pieces: list[str]) -> list[bytes]:
        plain = [bool(p) and not p[0].isspace() for p in pieces]
        easy = [p for p, ok in zip(pieces, plain, strict=True) if ok]
        got: list[bytes] = []
        if easy:
            tokens = self.pattern.findall(" " + " ".join(easy))
            got = self._tokens(tokens, np.flatnonzero(np.fromiter((t[0] == " " for t in tokens), bool, len(tokens))))
        easy_ids, hard_ids = iter(got), iter(self.whole([" " + p for p, ok in zip(pieces, plain, strict=True) if not ok]))
        return [next(easy_ids if ok else hard_ids) for ok in plain]

    def whole(self, texts: list[str]) -> list[bytes]:
        found = [self.pattern.findall(t) for t in texts]
        full = [f for f in found if f]
        got = iter(self._tokens([t for f in full for t in f], np.cumsum([0, *map(len, full[:-1])])) if full else [])
        return [next(got) if f else b"" for f in found]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))

    def written(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return b",".join(map(self.decimal.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def matrix_bpe(path: str) -> MatrixBpe:
    return MatrixBpe(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids is an array column."""

    def make():
        import pyarrow as pa

        bpe = matrix_bpe(path)

        def work(batch):
            ids = [x.astype(np.int32) for x in bpe.encode(batch.column(1)).split()]
            return [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))]

        return work

    return map_batches(texts(docs, id_col, text_col), make, "doc_id long, n_tokens long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, data): the bytes that the ids stand for."""

    def make():
        import pyarrow as pa

        bpe = matrix_bpe(path)
        return lambda batch: [batch.column(0), pa.array([bpe.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()], pa.binary())]

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id long, data binary")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode what was encoded, and keep digests of both, in one pass over the texts."""

    def make():
        bpe = matrix_bpe(path)

        def work(batch):
            got = bpe.encode(batch.column(1)).split()
            return [
                batch.column(0),
                [len(ids) for ids in got],
                [hashlib.sha256(bpe.written(ids)).hexdigest() for ids in got],
                [hashlib.sha256(bpe.decode(ids)).hexdigest() for ids in got],
            ]

        return work

    return map_batches(texts(docs, id_col, text_col), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
