"""Token ids in files: canonical length-limited Huffman codes in independent blocks with bit-offset checkpoints.

Documents are range-partitioned and sorted by id, so a shard holds a stretch of ids and shards follow each other. Code
lengths come from the global counts of all ids by package-merge, limited to `LIMIT` bits; codes are canonical, so the
lengths alone are the code book, which is stored beside the blocks. A block starts with its documents and the bit offset
of every `EVERY`-th id, so blocks, and stretches within a block, decode independently: all stretches of a block advance
together, one id a step, by a table of 2**LIMIT entries.

The blocks are the binary rows of a Parquet table, so Spark's commit protocol makes them safe against lost executors.

Edge cases: null or empty text is the end token alone; null ids sort first; rows that share an id follow each other in
the order of their first 64 characters (of the whole texts within a shard), and may stand in several shards, so an id that
many rows share is no hot shard; a text of any length is one document of one block; an empty table gives no blocks;
further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, map_batches, partitions, pieces_of, ready, stored, table, texts
from .encoders import encoder

VOCABULARY = "word_bpe_49k.json"
IDS = 49_408
END = 2
LIMIT = 20
EVERY = 256
MAGIC = b"WFH1"
#: Documents, ids between checkpoints, ids of the shard ahead, ids, checkpoints.
HEAD = "<IIQQQ"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits, by package-merge; 0 for ids that do not occur."""
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(ids) < 2:
        out[ids] = 1
        return out
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids do not fit codes of {limit} bits")
    order = ids[np.argsort(counts[ids], kind="stable")]
    weights = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        by = np.argsort(merged, kind="stable")
        levels.append(by < len(weights))
        merged = merged[by]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, lengths = 2 * len(ids) - 2, np.zeros(len(ids), np.int64)
    for own in reversed(levels):
        symbols = int(own[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    out[order] = lengths
    return out


class Codes:
    """Canonical codes of given lengths: shorter first, then by id."""

    def __init__(self, lengths: np.ndarray, limit: int = LIMIT) -> None:
        self.lengths, self.limit = lengths.astype(np.int64), limit
        ids = np.flatnonzero(lengths)
        ids = ids[np.argsort(lengths[ids], kind="stable")]
        spans = np.int64(1) << (limit - self.lengths[ids])
        starts = np.cumsum(spans) - spans  # codes, left-aligned to limit bits
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[ids] = starts >> (limit - self.lengths[ids])
        self.symbol = np.zeros(1 << limit, np.uint32)
        self.symbol[: int(spans.sum())] = np.repeat(ids, spans)
        self.width = self.lengths[self.symbol]

    def encode(self, ids: np.ndarray, every: int = EVERY) -> tuple[np.ndarray, bytes]:
        """(bit offset of every `every`-th id, bits)."""
        width = self.lengths[ids]
        ends = np.cumsum(width)
        at = ends - width
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 32 + 3, np.uint64)
        if len(ids):
            value = self.codes[ids].astype(np.uint64) << (64 - width - (at & 31)).astype(np.uint64)
            word = at >> 5
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            spots = word[first]
            words[spots] += np.add.reduceat(value >> np.uint64(32), first)
            words[spots + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return at[::every].astype(np.uint64), words.astype(">u4").tobytes()[: -(-total // 8)]

    def decode(self, checkpoints: np.ndarray, bits: bytes, n: int, every: int = EVERY) -> np.ndarray:
        """The n ids of a block."""
        words = np.frombuffer(bits + b"\0" * (16 - len(bits) % 4), ">u4").astype(np.uint64)
        at, mask = checkpoints.astype(np.int64), np.uint64((1 << self.limit) - 1)
        out = np.zeros((len(at), every), np.uint32)
        last = (len(words) - 2) * 32  # the last stretch runs beyond its ids, over padding
        for k in range(every):
            word = at >> 5
            window = (words[word] << np.uint64(32) | words[word + 1]) >> (64 - self.limit - (at & 31)).astype(np.uint64) & mask
            out[:, k] = self.symbol[window]
            at = np.minimum(at + self.width[window], last)
        return out.ravel()[:n]


def sorted_ids(docs: DataFrame, path: str, kind: str = "word", end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of encoded documents in ascending order of id; `before` counts the ids of the shard ahead of a run."""
    spark = docs.sparkSession
    d = texts(docs, id_col, text_col).withColumn("head", F.left("text", F.lit(64))).withColumn("spot", F.xxhash64(F.monotonically_increasing_id()))
    ordered = d.repartitionByRange(partitions(spark), "doc_id", "head", "spot").sortWithinPartitions("doc_id", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, shard, before = encoder(kind, path), TaskContext.get().partitionId(), 0
        for batch in (x for whole in batches for x in pieces_of(whole)):
            got, doc = enc.encode(batch.column(1)), batch.column(0)
            ids = np.insert(got.ids, got.ends, end)
            parts = [
                doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"),
                np.asarray(doc.is_null().to_numpy(zero_copy_only=False), np.uint8),
                (got.lengths + 1).astype("<u4"),
                ids.astype("<u2"),  # the vocabulary has under 65,536 ids
            ]
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([before]), pa.array([len(ids)]), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], names=["shard", "before", "n_ids", "docs", "empty", "lens", "ids"])
            before += len(ids)

    return ordered.mapInArrow(run, "shard int, before long, n_ids long, docs binary, empty binary, lens binary, ids binary")


def id_counts(runs: DataFrame) -> np.ndarray:
    """Occurrences of every id; IDS rows at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=IDS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    out = np.zeros(IDS, np.int64)
    for r in runs.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r.id] = r.n
    return out


def write_blocks(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, code book) as stored tables. runs: a stored result of sorted_ids()."""
    spark = runs.sparkSession
    lengths = code_lengths(id_counts(runs))

    def make():
        codes = Codes(lengths)

        def work(batch):
            out = []
            for before, docs, empty, lens, ids in zip(*(batch.column(i).to_pylist() for i in (1, 3, 4, 5, 6)), strict=True):
                ids = np.frombuffer(ids, "<u2")
                checkpoints, bits = codes.encode(ids)
                out.append(MAGIC + struct.pack(HEAD, len(empty), EVERY, before, len(ids), len(checkpoints)) + docs + empty + lens + checkpoints.astype("<u8").tobytes() + bits)
            return [*batch.columns[:3], pa.array(out, pa.binary())]

        return work

    blocks = stored(map_batches(runs.select("shard", "before", "n_ids", "docs", "empty", "lens", "ids"), make, "shard int, before long, n_ids long, block binary", 8), "blocks", codec="none")
    book = stored(spark.createDataFrame([(LIMIT, lengths.tobytes())], "max_bits int, lengths binary"), "codebook")
    return blocks, book


def open_block(block: bytes, codes: Codes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of the shard ahead, doc ids, whether the id is null, lengths, token ids) of a block."""
    if block[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n_docs, every, before, n_ids, n_checkpoints = struct.unpack_from(HEAD, block, 4)
    at, parts = 4 + struct.calcsize(HEAD), []
    for dtype, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u8", n_checkpoints)):
        parts.append(np.frombuffer(block, dtype, n, at))
        at += parts[-1].nbytes
    return before, *parts[:3], codes.decode(parts[3], block[at:], n_ids, every)


def read_blocks(blocks: DataFrame, book: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    limit, lengths = book.first()
    lengths = np.frombuffer(bytes(lengths), np.uint8)
    per_shard = sorted((r.shard, r.n) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())  # a row for each shard
    base = dict(zip((k for k, _ in per_shard), np.cumsum([0, *(n for _, n in per_shard)]).tolist(), strict=False))

    def make():
        codes = Codes(lengths, limit)

        def work(batch):
            out: list[list] = [[], [], [], []]
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                before, docs, empty, lens, ids = open_block(block, codes)
                ends = np.cumsum(lens, dtype=np.int64)
                out[0] += [None if e else d for d, e in zip(docs.tolist(), empty.tolist(), strict=True)]
                out[1] += (base[shard] + before + ends - lens).tolist()
                out[2] += lens.tolist()
                raw = ids.astype("<u4").tobytes()
                out[3] += [zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), lens.tolist(), strict=True)]
            return [pa.array(c, pa.int64()) for c in out]

        return work

    return map_batches(blocks.select("shard", "block"), make, "doc_id long, start long, n_tokens long, ids_crc32 long", 8)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    runs = stored(sorted_ids(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)), "runs")
    files = write_blocks(runs)
    discard(runs)
    return read_blocks(*files)
