"""Hierarchical Pitman-Yor bigram model, trained and applied in blocks.

Every word is a restaurant's context; all context restaurants share one parent restaurant of words, whose base is
uniform over the vocabulary and one unknown symbol. Seating is sampled by Gibbs in blocks: all customers of one dish in
one restaurant leave, and the number of tables at which they sit down again is drawn given the other tables and the
parent. Up to `EXACT` customers it is drawn from its exact conditional, by generalised Stirling numbers; above, by a
Metropolis step: customers sit down one by one by the Chinese-restaurant rule, with early new tables damped as the
conditional asks, which proposes where new tables open, and the proposal is taken or not by the weights of both paths.
The waiting time until a dish's next new table is beta-geometric, so a path takes a step for each table, not for each
customer. All dishes are updated at once from the
state after the sweep before. Predictive probabilities are averaged over the sweeps kept, and give each document's
perplexity. Discounts are estimated from counts of counts.

Draws depend on the seed, the sweep, the word and its context only: the result is the same for any number of buckets,
partitions and machines, but for the order in which a document's logarithms are added up.

Layout. Texts are cut into blocks of tokens, which are written once. From the blocks' own counts follow the words of more
than half a bucket's share of all tokens: each block names its words of at least an eighth of a share, so none above five
eighths is missed. Then tokens are dealt out by the hash of the predicted word, those of very frequent words by context too. There
is a bucket for every `BUCKET_BYTES` of text, so a bucket's memory doesn't grow with the input. A word bucket holds its
words' counts, its bigrams and its tokens, so the parent restaurant is local to it. What it needs from elsewhere are the
totals of each context: it asks the context's bucket once, and then only values in that order go back and forth, a few
bytes a context and sweep. There are a quarter as many context buckets as word buckets; messages between them are as many
as their product, so beyond a few TB `bucket_bytes` should grow with the square root of the input. Nothing of the size of
the vocabulary reaches the driver or one task. Words are identified by their 64-bit XXH64 (two words in 10^9 share one
with probability 0.03).

Edge cases: null text is empty, and an empty text is its end token; a text of any length is read whole, as part of one
block; without training documents probabilities are those of the base; an empty table gives an empty result; repeated
rows are documents each; null ids are never held out; ties don't arise; further columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, pieces_of, ready, relax, stored, table, texts

HELD_OUT = 10
SWEEPS, BURN_IN = 3, 1
CONCENTRATION = 1.0
#: Reserved hashes of the end of a text and of its beginning.
END, BEGIN = np.uint64(0), np.uint64(1)
BLOCK_TOKENS = 1_000_000
#: Bytes of text for which a word bucket is made.
BUCKET_BYTES = 16_000_000
#: Customers of a dish up to which its tables are drawn from their exact conditional.
EXACT = 2048
_DTYPES = ("<u8", "<u4", "<u2", "<i8", "<f8", "u1")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, byte planes apart and compressed; ascending uint64 as differences."""
    import zstandard

    out = [struct.pack("<B", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        kind = next(i for i, d in enumerate(_DTYPES) if np.dtype(d) == a.dtype)
        ascending = kind == 0 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        if ascending:
            a = np.diff(a, prepend=np.uint64(0))
        body = zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"")
        out.append(struct.pack("<BBQQ", kind, ascending, len(a), len(body)) + body)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    import zstandard

    out, at = [], 1
    for _ in range(data[0]):
        kind, ascending, n, size = struct.unpack_from("<BBQQ", data, at)
        at += 18
        dtype = np.dtype(_DTYPES[kind])
        if n:
            raw = zstandard.ZstdDecompressor().decompress(data[at : at + size], max_output_size=n * dtype.itemsize)
            a = np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T.copy().view(dtype).ravel()
        else:
            a = np.zeros(0, dtype)
        at += size
        out.append(np.cumsum(a, dtype=np.uint64) if ascending else a)
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """In the smallest unsigned type that holds it."""
    top = int(a.max(initial=0))
    return a.astype("u1" if top < 256 else "<u2" if top < 65536 else "<u4" if top < 1 << 32 else "<u8")


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Ascending in the hash."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class Deal:
    """The bucket of each token: by word, and for very frequent words by context as well."""

    def __init__(self, n: int, heavy: dict[int, int]) -> None:
        self.n = n
        self.words = np.array(sorted(heavy), np.uint64)
        self.parts = np.array([heavy[int(w)] for w in self.words], np.uint64)

    def buckets(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        out = bucket_of(word, self.n)
        if len(self.words):
            i = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            hit = np.flatnonzero(self.words[i] == word)
            out[hit] = (out[hit] + (context[hit] % self.parts[i[hit]]).astype(np.int64)) % self.n
        return out


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before the end of each text)."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.cast(pa.large_string())))
    ends = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.values.slice(int(ends[0]), int(ends[-1] - ends[0])).dictionary_encode()
    names = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(w) if w else 0 for w in names), np.uint64, len(names))
    h[h == 1] = 2
    number = encoded.indices.to_numpy().astype(np.int64)
    ends = ends[1:] - ends[0]
    hashed = h[number] if len(number) else np.zeros(0, np.uint64)
    solid = hashed != END  # splitting leaves empty strings at the ends of a text
    kept = np.append(0, np.cumsum(solid))
    return hashed[solid], kept[ends]


def with_ends(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, number of each token's text): an end after each text."""
    return np.insert(words, ends, END), np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0) + 1)


def contexts_of(tokens: np.ndarray) -> np.ndarray:
    """The token before each, BEGIN at the start of a text."""
    context = np.append(BEGIN, tokens[:-1])
    context[context == END] = BEGIN
    return context


def tidy(work):
    """A function of one or two groups that leaves no freed memory behind."""

    def run_one(t: pa.Table) -> pa.Table:
        try:
            return work(t)
        finally:
            relax()

    def run_two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return work(left, right)
        finally:
            relax()

    return run_one if work.__code__.co_argcount == 1 else run_two


SCHEMA = "kind string, bucket int, other long, n1 long, n2 long, payload binary"
NAMES = ["kind", "bucket", "other", "n1", "n2", "payload"]
TYPES = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def rows(items: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*items, strict=True) if items else [()] * 6, TYPES, strict=True)], names=NAMES)


def blocks(docs: DataFrame, n: int) -> DataFrame:
    """Kind D: the documents of a block; kind T: its tokens; kind H: counts of the block's words that may be very frequent.

    Tokens stand as numbers of words within the row, in order, so that contexts follow from them, and as twice the
    document's number, plus one in training.
    """

    def flush(block: int, parts: list[tuple]) -> list[tuple]:
        ids, null, train = (np.concatenate([p[i] for p in parts]) for i in range(3))
        shift = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
        tokens = np.concatenate([p[3] for p in parts])
        doc = np.concatenate([p[4] + s for p, s in zip(parts, shift, strict=True)])
        w, wi, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        hot = np.flatnonzero(counts * (8 * n) >= len(tokens))
        out = [
            ("D", 0, block, len(ids), int(train.sum()), pack(ids, null, train.astype(np.uint8), np.bincount(doc, minlength=len(ids)).astype("<u4"))),
            ("T", 0, block, len(tokens), 0, pack(w, narrow(wi), narrow(np.diff(doc * 2 + train[doc], prepend=0)))),
        ]
        return out + [("H", 0, int(w[i].view(np.int64)), int(counts[i]), 0, None) for i in hot.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        block, parts, held = TaskContext.get().partitionId() << 24, [], 0
        for batch in (x for whole in batches for x in pieces_of(whole)):
            null = np.asarray(batch.column(0).is_null().to_numpy(zero_copy_only=False), np.uint8)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            train = np.fromiter((zlib.crc32(b"%d" % i) % HELD_OUT != 0 for i in ids.tolist()), bool, len(ids)) | (null == 1)
            parts.append((ids, null, train, *with_ends(*words_of(batch.column(1)))))
            held += len(parts[-1][3])
            if held >= BLOCK_TOKENS:
                yield rows(flush(block, parts))
                block, parts, held = block + 1, [], 0
                relax()
        if parts:
            yield rows(flush(block, parts))
        del parts
        relax()

    return docs.mapInArrow(run, SCHEMA)


def dealt(tokens: DataFrame, deal: Deal) -> DataFrame:
    """Kind B: a block's tokens for a word bucket. tokens: kind T."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, payload = batch.column(2)[i].as_py(), batch.column(5)[i].as_py()
                w, wi, marks = unpack(payload)
                wi, place = wi.astype(np.int64), np.cumsum(marks, dtype=np.int64)
                u, ui = np.unique(contexts_of(w[wi]), return_inverse=True)
                to = deal.buckets(w[wi], u[ui])
                order = np.argsort(to.astype(np.uint16 if deal.n < 65536 else np.int64), kind="stable")
                out = []
                for own in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                    a, ai = np.unique(wi[own], return_inverse=True)
                    b, bi = np.unique(ui[own], return_inverse=True)
                    out.append(("B", int(to[own[0]]), block, len(own), 0, pack(w[a], u[b], narrow(ai), narrow(bi), narrow(np.diff(place[own], prepend=0)))))
                yield rows(out)
                relax()

    return tokens.mapInArrow(run, SCHEMA)


def merged(parts: DataFrame, deal: Deal) -> DataFrame:
    """Word buckets of kind B: kind G, the bucket's graph; kind K, its tokens by block; kinds N, M and H, figures.

    N: bigrams seen once and twice; M: words that follow one and two contexts; H: count and contexts of a word that is
    dealt to several buckets.
    """

    def run(t: pa.Table) -> pa.Table:
        items = t.to_pylist()
        items.sort(key=lambda r: r["other"])
        bucket, got = items[0]["bucket"], [unpack(r["payload"]) for r in items]
        words, wi = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        contexts, ui = np.unique(np.concatenate([g[1] for g in got]), return_inverse=True)
        wa, ua = (np.cumsum([0, *(len(g[i]) for g in got[:-1])]) for i in (0, 1))
        keys = np.concatenate([wi[a + g[2].astype(np.int64)] << 32 | ui[b + g[3].astype(np.int64)] for g, a, b in zip(got, wa, ua, strict=True)])
        place = [np.cumsum(g[4], dtype=np.int64) for g in got]
        bigrams, index = np.unique(keys, return_inverse=True)
        counts = np.bincount(index[np.concatenate(place) & 1 == 1], minlength=len(bigrams))
        word, context = bigrams >> 32, bigrams & 0xFFFFFFFF
        word_counts = np.bincount(word, counts, len(words)).astype(np.int64)
        follows = np.bincount(word[counts > 0], minlength=len(words))
        split = np.isin(words, deal.words)
        own = word_counts[~split]
        out = [
            ("G", bucket, 0, int(word_counts.sum()), int((own > 0).sum()), pack(words, narrow(word_counts), contexts, narrow(word), narrow(context), narrow(counts))),
            ("N", bucket, 0, int((counts == 1).sum()), int((counts == 2).sum()), None),
            ("M", bucket, 0, int((follows[~split] == 1).sum()), int((follows[~split] == 2).sum()), None),
        ]
        out += [("H", bucket, int(words[i].view(np.int64)), int(word_counts[i]), int(follows[i]), None) for i in np.flatnonzero(split).tolist()]
        at = 0
        for r, p in zip(items, place, strict=True):
            out.append(("K", bucket, r["other"], len(p), 0, pack(narrow(index[at : at + len(p)]), narrow(np.diff(p >> 1, prepend=0)))))
            at += len(p)
        return pa.Table.from_batches([rows(out)])

    return parts.groupBy("bucket").applyInArrow(tidy(run), SCHEMA)


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit digest of numbers, element by element (steps of SplitMix64)."""
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in parts:
            h = np.asarray(p).astype(np.uint64) + h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
    return h


def exact_tables(u: np.ndarray, customers: np.ndarray, parent: np.ndarray, others: np.ndarray, discount: float) -> np.ndarray:
    """Tables of dishes of 2 to EXACT customers, drawn by the uniform numbers u from their conditional distribution.

    Its weight at t tables is the product of CONCENTRATION + discount * (others + i) over i < t, times parent ** t, times
    the generalised Stirling number of the customers and t, whose rows are gone through in ascending order.
    """
    out = np.ones(len(customers), np.int64)
    order = np.argsort(customers, kind="stable")
    sizes, firsts = np.unique(customers[order], return_index=True)
    row, c = np.zeros(1), 1  # logarithms of the Stirling numbers of c customers at 1 to c tables
    for size, members in zip(sizes.tolist(), np.split(order, firsts[1:]), strict=True):
        t = np.arange(1, size + 1)
        while c < size:
            before, stay = row, row + np.log(c - discount * t[:c])
            row = np.append(stay, 0.0)
            row[1:c] = np.logaddexp(stay[1:], before[:-1])
            c += 1
        for a in range(0, len(members), step := max(1, 500_000 // size)):
            own = members[a : a + step]
            weight = np.cumsum(np.log(CONCENTRATION + discount * (others[own, None] + t - 1)) + np.log(parent[own, None]), axis=1) + row
            weight = np.exp(weight - weight.max(axis=1, keepdims=True))
            total = np.cumsum(weight, axis=1)
            out[own] = 1 + (total < u[own, None] * total[:, -1:]).sum(axis=1).clip(max=size - 1)
    return out


def _damped(seated: int, customers: int, parent: float, discount: float) -> tuple[float, int]:
    """(factor on a new table's weight when so many are seated, customers up to which it holds).

    A table takes `discount` from all customers to come, so the conditional opens fewer early tables than the sequential
    rule: by about (seated / customers) ** (discount * (1 - parent)), which is held constant between powers of two.
    """
    low = 1 << (seated.bit_length() - 1)
    return min(1.0, 1.5 * low / customers) ** (discount * (1 - parent)), min(2 * low, customers)


def path_of(rng: np.random.Generator, customers: int, parent: float, others: float, discount: float, opened: list[int] | None = None, seated: int = 1) -> list[int]:
    """A proposal: the customers that open a table, counted from 1, when customers sit down one by one after those seated."""
    out = list(opened or [1])
    while seated < customers:
        factor, limit = _damped(seated, customers, parent, discount)
        new = max((CONCENTRATION + discount * (others + len(out))) * parent * factor, 1e-300)
        p = rng.beta(new, seated - discount * len(out))
        wait = math.log(1.0 - rng.random()) / math.log1p(-p) if 1e-300 < p < 1 else 0.0 if p >= 1 else math.inf
        if wait >= limit - seated:
            seated = limit
        else:
            seated += int(wait) + 1
            out.append(seated)
    return out


def path_weight(path: list[int], customers: int, parent: float, others: float, discount: float) -> float:
    """Logarithm of a path's weight in the conditional over its probability as a proposal."""
    out = 0.0
    for t, (a, b) in enumerate(zip(path, [*path[1:], customers], strict=True), 1):
        new = (CONCENTRATION + discount * (others + t)) * parent
        while a < b:
            factor, limit = _damped(a, customers, parent, discount)
            x, to = new * factor - discount * t, min(b, limit)
            out += math.lgamma(x + to) - math.lgamma(x + a)
            a = to
            last = factor
        if t < len(path):
            out -= math.log(last)
    return out


class Seats:
    """Tables of dishes, and for those of more than EXACT customers the path that led to them."""

    def __init__(self, tables: np.ndarray, customers: np.ndarray, paths: np.ndarray, exact: int = EXACT) -> None:
        self.tables, self.customers, self.paths = tables, customers, paths
        large = np.flatnonzero(customers > exact)
        ends = np.cumsum(tables[large])
        self.path = {int(i): paths[e - t : e].tolist() for i, e, t in zip(large.tolist(), ends.tolist(), tables[large].tolist(), strict=True)}


def first_seats(customers: np.ndarray, exact: int = EXACT) -> Seats:
    return Seats(np.minimum(customers, 1).astype(np.int64), customers, np.ones(int((customers > exact).sum()), np.int64), exact)


def seat(key: tuple[int, ...], names: tuple[np.ndarray, ...], customers: np.ndarray, old: Seats, parent: np.ndarray, others: np.ndarray, discount: float, exact: int = EXACT) -> Seats:
    """The seating of each dish after its customers sat down again.

    key and names (arrays) seed the draws; parent: the dish's probability in the parent; others: tables of the restaurant
    that serve other dishes. old: the seating before, of as many customers or of others: customers that have come sit down
    behind those of old, and those that have gone are the last of them.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    some = np.flatnonzero((customers > 1) & (customers <= exact))
    if len(some):
        u = (mixed(*key, *(x[some] for x in names)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        tables[some] = exact_tables(u, customers[some], parent[some], others[some], discount)
    paths = []
    for i in np.flatnonzero(customers > exact).tolist():
        rng = np.random.default_rng([*key, *(int(x[i]) for x in names)])
        c, p, o = int(customers[i]), float(parent[i]), float(others[i])
        new = path_of(rng, c, p, o, discount)
        if (was := old.path.get(i)) is not None:
            was, seated = [k for k in was if k <= c], int(old.customers[i])
            if seated < c:
                was = path_of(rng, c, p, o, discount, was, seated)
            if math.log(1.0 - rng.random()) > path_weight(new, c, p, o, discount) - path_weight(was, c, p, o, discount):
                new = was
        tables[i] = len(new)
        paths += new
    return Seats(tables, customers, np.array(paths, np.int64), exact)


class Graph:
    """A word bucket: words, their training counts, contexts, and for each bigram its word, context and training count."""

    def __init__(self, payload: bytes) -> None:
        self.words, counts, self.contexts, word, context, bigrams = unpack(payload)
        self.word_counts, self.word, self.context, self.counts = (x.astype(np.int64) for x in (counts, word, context, bigrams))


def joined(items: list[dict], kind: str, other: int | None = None) -> np.ndarray:
    """The values that the context buckets sent, one after another; contexts are in that order."""
    parts = sorted((r["n2"], r["payload"]) for r in items if r["kind"] == kind and (other is None or r["other"] == other))
    return np.concatenate([unpack(p)[0].astype(np.int64) for _, p in parts]) if parts else np.zeros(0, np.int64)


def context_counts(graphs: DataFrame, m: int, begins: int) -> DataFrame:
    """Kind C, for word buckets: training counts of their contexts. Kind U, for context buckets: who asked for which."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                g, out = Graph(r["payload"]), []
                for kind, hashes, counts in (("R", g.contexts, None), ("W", g.words, g.word_counts)):
                    to = bucket_of(hashes, m)
                    for own in np.split(np.arange(len(to)), np.flatnonzero(np.diff(to)) + 1):
                        if len(own):
                            out.append((kind, int(to[own[0]]), r["bucket"], len(own), 0, pack(hashes[own], *([] if counts is None else [narrow(counts[own])]))))
                yield rows(out)

    def answer(t: pa.Table) -> pa.Table:
        items = sorted(t.to_pylist(), key=lambda r: r["other"])
        bucket = items[0]["bucket"]
        known = [unpack(r["payload"]) for r in items if r["kind"] == "W"] + ([[np.array([BEGIN], np.uint64), np.array([begins], "<u8")]] if bucket == 0 else [])
        words, at = np.unique(np.concatenate([k[0] for k in known]) if known else np.zeros(0, np.uint64), return_inverse=True)
        counts = np.bincount(at, np.concatenate([k[1].astype(np.int64) for k in known]) if known else None, len(words)).astype(np.int64)
        out = []
        for r in items:
            if r["kind"] == "R":
                (asked,) = unpack(r["payload"])
                i = np.minimum(np.searchsorted(words, asked), max(len(words) - 1, 0))
                hit = words[i] == asked if len(words) else np.zeros(len(asked), bool)
                out.append(("C", r["other"], 0, len(asked), bucket, pack(narrow(np.where(hit, counts[i], 0) if len(words) else np.zeros(len(asked), np.int64)))))
                out.append(("U", bucket, r["other"], len(words), 0, pack(narrow(np.where(hit, i + 1, 0)))))
        return pa.Table.from_batches([rows(out)])

    return graphs.mapInArrow(ask, SCHEMA).groupBy("bucket").applyInArrow(tidy(answer), SCHEMA)


def split_by_context(g: Graph, m: int, values: np.ndarray) -> list[tuple[int, np.ndarray]]:
    to = bucket_of(g.contexts, m)
    return [(int(to[own[0]]), values[own]) for own in np.split(np.arange(len(to)), np.flatnonzero(np.diff(to)) + 1) if len(own)]


def state_rows(bucket: int, sweep: int, g: Graph, m: int, below: Seats, parent: Seats, split: np.ndarray) -> list[tuple]:
    """Kind S: the bucket's seating; P: tables of its contexts, for the context buckets; H: tables of split words; T: totals."""
    by_word = np.bincount(g.word, below.tables, len(g.words)).astype(np.int64)
    by_context = np.bincount(g.context, below.tables, len(g.contexts)).astype(np.int64)
    state = pack(*(narrow(x) for x in (below.tables, below.paths, parent.tables, parent.customers, parent.paths)))
    out = [("S", bucket, sweep, 0, 0, state), ("T", bucket, sweep, int(below.tables.sum()), int(parent.tables[~split].sum()), None)]
    out += [("H", bucket, int(g.words[i].view(np.int64)), int(by_word[i]), 0, None) for i in np.flatnonzero(split).tolist()]
    return out + [("P", k, bucket, len(v), 0, pack(narrow(v))) for k, v in split_by_context(g, m, by_context)]


def first_seating(graphs: DataFrame, deal: Deal, m: int) -> DataFrame:
    """One table for each dish of each restaurant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                g = Graph(r["payload"])
                below = first_seats(g.counts)
                by_word = np.bincount(g.word, below.tables, len(g.words)).astype(np.int64)
                yield rows(state_rows(r["bucket"], 0, g, m, below, first_seats(by_word), np.isin(g.words, deal.words)))

    return graphs.mapInArrow(run, SCHEMA)


def context_tables(asked: DataFrame, state: DataFrame, sweep: int) -> DataFrame:
    """Kind Q, for word buckets: tables of their contexts over all buckets. asked: kind U; state: kind P."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        which = {r["other"]: (unpack(r["payload"])[0].astype(np.int64), r["n1"]) for r in left.to_pylist()}
        total, parts = None, right.to_pylist()
        for r in parts:
            at, size = which[r["other"]]
            total = np.zeros(size + 1, np.int64) if total is None else total
            total += np.bincount(at, unpack(r["payload"])[0], size + 1).astype(np.int64)
        bucket = parts[0]["bucket"] if parts else -1
        out = []
        for other, (at, _) in sorted(which.items()):
            values = np.where(at > 0, total[at], 0) if total is not None else np.zeros(len(at), np.int64)
            out.append(("Q", other, sweep, len(at), bucket, pack(narrow(values))))
        return pa.Table.from_batches([rows(out)])

    return asked.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(tidy(run), SCHEMA)


class Whole:
    """What every bucket needs of the whole model; its size is bounded by the number of buckets."""

    def __init__(self, discounts: tuple[float, float], vocabulary: int, tables: int, parent_tables: int, split: dict[int, tuple[int, int]]) -> None:
        self.discount, self.parent_discount = discounts
        self.vocabulary, self.tables, self.parent_tables = vocabulary, tables, parent_tables
        self.split = split  # of words dealt to several buckets: tables below and in the parent

    def parent(self, g: Graph, tables: np.ndarray, parent_tables: np.ndarray) -> np.ndarray:
        """Probability of each word of a bucket in the parent restaurant."""
        below, own = np.bincount(g.word, tables, len(g.words)), parent_tables.astype(np.float64)
        for w, (t, p) in self.split.items():
            i = int(np.searchsorted(g.words, np.uint64(w)))
            if i < len(g.words) and int(g.words[i]) == w:
                below[i], own[i] = t, p
        return (below - self.parent_discount * own + (CONCENTRATION + self.parent_discount * self.parent_tables) / (self.vocabulary + 1)) / (CONCENTRATION + self.tables)


def resume(items: list[dict], sweep: int, g: Graph) -> tuple[Seats, Seats, np.ndarray]:
    """(seating, parent's seating, tables of the contexts) of a bucket after a sweep."""
    tables, paths, parent, customers, parent_paths = (x.astype(np.int64) for x in unpack(next(r["payload"] for r in items if r["kind"] == "S" and r["other"] == sweep)))
    return Seats(tables, g.counts, paths), Seats(parent, customers, parent_paths), joined(items, "Q", sweep)


def sweep_once(graphs: DataFrame, before: DataFrame, deal: Deal, m: int, whole: Whole, sweep: int, seed: int) -> DataFrame:
    """A new seating of everybody, given the one before (kinds S and Q)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (r,) = left.to_pylist()
        g = Graph(r["payload"])
        old, old_parent, context = resume(right.to_pylist(), sweep - 1, g)
        p = whole.parent(g, old.tables, old_parent.tables)
        new = seat((seed, sweep, 0), (g.words[g.word], g.contexts[g.context]), g.counts, old, p[g.word], context[g.context] - old.tables, whole.discount)
        by_word = np.bincount(g.word, new.tables, len(g.words)).astype(np.int64)
        parent = parent_seats(seed, sweep, g.words, by_word, old_parent, whole)
        return pa.Table.from_batches([rows(state_rows(r["bucket"], sweep, g, m, new, parent, np.isin(g.words, deal.words)))])

    return graphs.groupBy("bucket").cogroup(before.groupBy("bucket")).applyInArrow(tidy(run), SCHEMA)


def parent_seats(seed: int, sweep: int, words: np.ndarray, customers: np.ndarray, old: Seats, whole: Whole) -> Seats:
    base = np.full(len(words), 1 / (whole.vocabulary + 1))
    return seat((seed, sweep, 1), (words,), customers, old, base, np.maximum(whole.parent_tables - old.tables, 0), whole.parent_discount)


def predictive(counts: np.ndarray, tables: np.ndarray, context_counts: np.ndarray, context_tables: np.ndarray, parent: np.ndarray, discount: float) -> np.ndarray:
    """Probability of a word after a context, by the word's customers and tables there and by its probability in the parent."""
    return (np.maximum(counts - discount * tables, 0) + (CONCENTRATION + discount * context_tables) * parent) / (CONCENTRATION + context_counts)


def text_scores(parts: DataFrame, kept: DataFrame, wholes: dict[int, Whole], tokens: int, split_counts: dict[int, int]) -> DataFrame:
    """Kind F: sums over the tokens of a bucket for the documents of a block. parts: kinds G and K; kept: C, S and Q."""
    vocabulary = next(iter(wholes.values())).vocabulary

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        mine, sent = left.to_pylist(), right.to_pylist()
        g = Graph(next(r["payload"] for r in mine if r["kind"] == "G"))
        counts = joined(sent, "C")
        p = np.zeros(len(g.word))
        for sweep, whole in wholes.items():
            below, parent, context = resume(sent, sweep, g)
            p += predictive(g.counts, below.tables, counts[g.context], context[g.context], whole.parent(g, below.tables, parent.tables)[g.word], whole.discount)
        score = np.log10(p / len(wholes))
        c = g.word_counts.copy()
        for w, total in split_counts.items():
            c[g.words == np.uint64(w)] = total
        base, known = np.log10((c + 0.1) / (tokens + 0.1 * (vocabulary + 1)))[g.word], (c > 0)[g.word]
        out = []
        for r in mine:
            if r["kind"] == "K":
                index, marks = unpack(r["payload"])
                doc, index = np.cumsum(marks, dtype=np.int64), index.astype(np.int64)
                out.append(("F", r["bucket"], r["other"], 0, 0, pack(*(np.bincount(doc, x[index]) for x in (base, score)), np.bincount(doc, known[index]).astype("<u4"))))
        return pa.Table.from_batches([rows(out)])

    return parts.groupBy("bucket").cogroup(kept.groupBy("bucket")).applyInArrow(tidy(run), SCHEMA)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def by_document(parts: DataFrame, tokens: int) -> DataFrame:
    """The sums of all buckets for each document. parts: kinds D and F, grouped by block."""

    def run(t: pa.Table) -> pa.Table:
        items = sorted(t.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        ids, null, train, sizes = unpack(items[0]["payload"])
        base, score, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for r in items[1:]:
            b, s, k = unpack(r["payload"])
            base[: len(b)] += b
            score[: len(s)] += s
            known[: len(k)] += k
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=null == 1), "held_out": pa.array(train == 0), "n_tokens": pa.array(sizes.astype(np.int64)), "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(ids), tokens)), "base_score": pa.array(base), "score": pa.array(score),
            }
        )

    return parts.groupBy("other").applyInArrow(tidy(run), RESULT)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS, burn_in: int = BURN_IN, seed: int = 1, buckets: int | None = None, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The model of the training documents, applied to all: RESULT and perplexity, 10 ** (-score / n_tokens).

    The end of a text is a token, so a null or empty text has a perplexity too; it is null only where n_tokens is 0.
    """
    d = texts(docs, id_col, text_col)
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = buckets or max(1, -(-size // bucket_bytes))
    m = -(-n // 4)
    kind = lambda df, *k: df.where(F.col("kind").isin(*k))
    unsigned = lambda x: int(np.int64(x).view(np.uint64))
    written = stored(blocks(d, n), "py-blocks", partition_by="kind")
    cut = written.select(*NAMES)
    every, begins = (x or 0 for x in kind(cut, "T", "D").agg(F.sum(F.when(F.col("kind") == "T", F.col("n1"))), F.sum("n2")).first())
    often = kind(cut, "H").groupBy("other").agg(F.sum("n1").alias("a")).where(F.col("a") * (2 * n) > every).collect()  # 2 n rows at most
    deal = Deal(n, {unsigned(r.other): min(n, -(-2 * r.a * n // every)) for r in often} if n > 1 else {})
    tables = stored(merged(dealt(kind(cut, "T"), deal), deal), "py-buckets", partition_by="kind").select(*NAMES)
    discard(written, part="kind=T")
    graphs = kind(tables, "G")
    sums = {r.kind: (r.a, r.b) for r in kind(tables, "G", "N", "M").groupBy("kind").agg(F.sum("n1").alias("a"), F.sum("n2").alias("b")).collect()}
    split = {r.other: (r.a, r.b) for r in kind(tables, "H").groupBy("other").agg(F.sum("n1").alias("a"), F.sum("n2").alias("b")).collect()}  # 2 n rows at most
    tokens, vocabulary = sums.get("G", (0, 0))
    vocabulary += sum(c > 0 for c, _ in split.values())
    discounts = _discount(*sums.get("N", (0, 0))), _discount(*(x + sum(f == k for _, f in split.values()) for k, x in enumerate(sums.get("M", (0, 0)), 1)))
    totals = stored(context_counts(graphs, m, begins), "py-contexts", partition_by="kind").select(*NAMES)
    words = np.array(sorted(unsigned(w) for w in split), np.uint64)
    above = first_seats(np.zeros(0, np.int64))
    wholes: dict[int, Whole] = {}
    kept = kind(totals, "C")
    state = seated = answers = None
    for sweep in range(sweeps + 1):
        new = first_seating(graphs, deal, m) if sweep == 0 else sweep_once(graphs, kind(state, "S").unionByName(answers), deal, m, wholes[sweep - 1], sweep, seed)
        last, seated = (seated, answers), stored(new, "py-state", partition_by="kind")
        state = seated.select(*NAMES)
        answers = stored(context_tables(kind(totals, "U"), kind(state, "P"), sweep), "py-tables")
        discard(seated, part="kind=P")
        if sweep <= burn_in + 1:
            discard(*last)
        t, p = (x or 0 for x in kind(state, "T").agg(F.sum("n1"), F.sum("n2")).first())
        below = {unsigned(r.other): r.a for r in kind(state, "H").groupBy("other").agg(F.sum("n1").alias("a")).collect()}
        customers = np.array([below[int(w)] for w in words], np.int64)
        above = first_seats(customers) if sweep == 0 else parent_seats(seed, sweep, words, customers, above, wholes[sweep - 1])
        own = dict(zip(words.tolist(), zip(customers.tolist(), above.tables.tolist(), strict=True), strict=True))
        wholes[sweep] = Whole(discounts, vocabulary, t, p + int(above.tables.sum()), own)
        if sweep > burn_in:
            kept = kept.unionByName(kind(state, "S")).unionByName(answers)
    scores = text_scores(kind(tables, "G", "K"), kept, {k: v for k, v in wholes.items() if k > burn_in}, tokens, {unsigned(w): c for w, (c, _) in split.items()})
    found = by_document(kind(cut, "D").unionByName(scores), tokens)
    return found.withColumn("perplexity", F.when(F.col("n_tokens") > 0, F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return score_texts(table(spark, sf_dir, "documents"))
