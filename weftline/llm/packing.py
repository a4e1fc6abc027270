"""Best-fit packing of documents into sequences by minimum bin slack.

Documents become pieces of at most `capacity` tokens; only longer documents are cut, and only their first piece may be
short of the capacity. Packing works on the histogram of piece lengths, which has at most `capacity` entries whatever
the number of pieces: take the longest length left, find by a bitset subset-sum over the lengths left the fullest
combination that fits beside it, and remove that combination as often as the counts allow. Pieces then get their places
from their rank within their length, in groups that grow in number, not in size: a piece's group comes from its place in
the stored table, so equal rows don't meet in one group.

Edge cases: null or empty text is the end token alone; a text of any length is cut as a whole; an empty table gives an
empty result; repeated rows and null ids are packed like any other; ties among lengths are settled by place in the table;
further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, ready, stored, table, texts
from .encoders import encoder

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END = 2
#: Pieces of one length that are ranked together.
GROUP = 20_000


def pieces(docs: DataFrame, path: str, kind: str = "byte", capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, mark): a row for each piece of each document; mark numbers the pieces."""

    def make():
        from itertools import count

        from pyspark import TaskContext

        enc, number = encoder(kind, path), count(TaskContext.get().partitionId() << 40)
        tail = np.array([end], np.uint32).tobytes()

        def work(batch):
            ids, rows = batch.column(0).to_pylist(), ([], [], [], [], [], [])
            for doc, got in zip(ids, enc.encode(batch.column(1)).split(), strict=True):
                got = got.tobytes() + tail
                n = len(got) // 4
                first = n % capacity or min(n, capacity)
                for k, start in enumerate([0, *range(first, n, capacity)]):
                    part = got[4 * start : 4 * (first if k == 0 else start + capacity)]
                    for column, v in zip(rows, (doc, k, start, len(part) // 4, zlib.crc32(part), next(number)), strict=True):
                        column.append(v)
            import pyarrow as pa

            return [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)]

        return work

    return map_batches(texts(docs, id_col, text_col), make, "doc_id long, piece int, start long, length long, ids_crc32 long, mark long")


@dataclass
class Pattern:
    """`copies` sequences that hold the same multiset of lengths: pairs (length, how many)."""

    copies: int
    content: list[tuple[int, int]]


def fullest(capacity: int, available: dict[int, int]) -> list[tuple[int, int]]:
    """The multiset of available lengths whose sum is the largest up to capacity, by bitset dynamic programming."""
    reach, full = 1, (1 << (capacity + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # length, how many at once, sums reached before
    for length in sorted((x for x in available if x <= capacity), reverse=True):
        left, take = min(available[length], capacity // length), 1
        while left:
            take = min(take, left)
            before, reach = reach, (reach | reach << length * take) & full
            if reach != before:
                steps.append((length, take, before))
            left -= take
            take *= 2
            if reach >> capacity:
                break
        if reach >> capacity:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return sorted(chosen.items(), reverse=True)


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that together hold exactly the pieces of the histogram {length: pieces}."""
    left, out = {k: v for k, v in histogram.items() if v}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        content = dict(fullest(capacity - longest, {k: v for k, v in left.items() if v}))
        left[longest] += 1
        content[longest] = content.get(longest, 0) + 1
        copies = min(left[k] // v for k, v in content.items())
        out.append(Pattern(copies, sorted(content.items(), reverse=True)))
        for k, v in content.items():
            left[k] -= v * copies
            if not left[k]:
                del left[k]
    return out


@dataclass
class Places:
    """For one length, the runs of ranks that go to the same pattern."""

    rank: np.ndarray
    many: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def places(patterns: list[Pattern]) -> dict[int, Places]:
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        offset = 0
        for length, many in p.content:
            runs.setdefault(length, []).append((used.get(length, 0), many, sequence, offset))
            used[length] = used.get(length, 0) + many * p.copies
            offset += length * many
        sequence += p.copies
    return {k: Places(*(np.array(c, np.int64) for c in zip(*v, strict=True))) for k, v in runs.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (a stored table) with sequence_id and offset."""
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    where = places(minimum_bin_slack(histogram, capacity))
    # Rank within a length: row numbers in groups of about GROUP pieces, plus the sizes of the groups before.
    groups = [max(1, -(-histogram.get(k, 0) // GROUP)) for k in range(capacity + 1)]
    many = F.get(F.split(F.lit(",".join(map(str, groups))), ",").cast("array<long>"), F.col("length").cast("int"))
    keyed = cut.withColumn("grp", F.pmod(F.xxhash64("mark"), many))
    sizes = keyed.groupBy("length", "grp").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("length", "grp").orderBy("mark")) - 1)
    ranked = ranked.join(sizes, ["length", "grp"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def make():
        def work(batch):
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                p = where[int(length[rows[0]])]
                run = np.searchsorted(p.rank, rank[rows], "right") - 1
                bin_, slot = np.divmod(rank[rows] - p.rank[run], p.many[run])
                sequence[rows] = p.sequence[run] + bin_
                offset[rows] = p.offset[run] + slot * length[rows]
            return [*batch.columns[:5], sequence, offset]

        return work

    return map_batches(ranked, make, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, kind: str = "byte", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    return pack(stored(pieces(docs, path, kind, capacity, end), "pieces"), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that came this far, with their places."""
    ready(spark)
    return pack_documents(docs, public_tokenizers.path(VOCABULARY))
