"""SimHash near-duplicates with a bit-sliced comparison.

Fingerprints are 64 bits by majority over the XXH64 of word shingles. Two fingerprints link at `radius` bits or fewer;
documents get the smallest id that links can reach.

Only distinct fingerprints are compared. A fingerprint is cut into radius + 1 stretches, one of which must agree between
any two that link, so it is sent once for each stretch. Groups that share a stretch and have more than `GROUP` members are
cut again along the bits that may still differ, which each row carries as a mask; each cut fixes more bits, so groups end
at a proven size, and nothing is capped. Within a task, groups stand one after another as 64 vertical bit planes, and every
member is compared with the one `shift` places on, 64 pairs to a machine word: plane by plane, differences go into
carry-save counters, and words whose pairs have all exceeded the radius are abandoned. Of a group's links only a
spanning forest is kept, so rows never grow with the square of a group.

Components are found by repeated contraction to the smallest neighbour; every round is written to the shared folder.
Documents join their fingerprint's component by a plain equi-join, which Spark splits where one fingerprint is hot.

Edge cases: null text is empty; texts without words have fingerprint zero and link like any other; repeated rows and
null ids give a row each (a null id is never a component's id unless all its ids are null); an empty table gives an
empty result; further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, map_batches, partitions, ready, row_key, spread, stored, table, texts
from .near_copies import near_copies

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Members of a group above which it is cut again.
GROUP = 2048


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    grams = [words[i:] for i in range(shingle)]
    h = np.fromiter((digest(b" ".join(g), SEED) for g in zip(*grams, strict=False)), np.uint64, len(words) - shingle + 1)
    ones = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp as a signed long."""

    def make():
        def work(batch):
            got = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            return [batch.column(0), np.array(got, np.uint64).view(np.int64)]

        return work

    return map_batches(texts(docs, id_col, text_col), make, "doc_id long, fp long")


class Forest:
    """Union of pairs in bulk; every member ends at the smallest of its tree."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while ((s := self.up[r]) != r).any():
            self.up[x] = r = s
        return r

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def planes_of(values: np.ndarray) -> np.ndarray:
    """64 bit planes over the members: uint64 [64, words], with a spare word of zeros at the end."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T
    padded = np.zeros((64, (len(values) // 64 + 2) * 64), np.uint8)
    padded[:, : len(values)] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def sliced_links(values: np.ndarray, sizes: np.ndarray, radius: int = RADIUS, block: int = 8) -> Forest:
    """A forest over the members of groups that stand one after another; members link within their group only."""
    n, forest = len(values), Forest(len(values))
    planes = planes_of(values)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # members from here to the end of the group
    last = planes.shape[1] - 1
    for shift in range(1, int(sizes.max(initial=1))):
        paired = left > shift
        words = np.unique(np.flatnonzero(paired) // 64)
        if not len(words):
            break
        room = np.zeros((len(words), 64), np.uint8)
        at = words[:, None] * 64 + np.arange(64)
        inside = at < n
        room[inside] = paired[at[inside]]
        alive = np.packbits(room, axis=1, bitorder="little").view("<u8").ravel()  # pairs within the radius so far
        step, bit = divmod(shift, 64)
        low, high = np.minimum(words + step, last), np.minimum(words + step + 1, last)
        # Carry-save counters of the differences: ones, twos, and what exceeds three.
        ones = np.zeros(len(words), np.uint64)
        twos, over = ones.copy(), ones.copy()
        for start in range(0, 64, block):
            for plane in planes[start : start + block]:
                moved = plane[low] >> np.uint64(bit)
                if bit:
                    moved |= plane[high] << np.uint64(64 - bit)
                differ = plane[words] ^ moved
                carry = ones & differ
                ones ^= differ
                over |= twos & carry
                twos ^= carry
            alive &= ~over
            if radius < 3:
                alive &= ~(ones & twos)
            keep = alive != 0
            if not keep.all():
                words, low, high, ones, twos, over, alive = (x[keep] for x in (words, low, high, ones, twos, over, alive))
                if not len(words):
                    break
        if len(words):
            hit = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
            a = (words[:, None] * 64 + np.arange(64))[hit]
            forest.link(a, a + shift)
    return forest


def stretches(mask: int, parts: int) -> list[int]:
    """The set bits of a mask in so many runs of about the same number of bits, as masks."""
    bits = [i for i in range(64) if mask >> i & 1]
    bounds = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def _sends(members: DataFrame, radius: int) -> DataFrame:
    """Each member once for each stretch of its group's free bits. members: (fp, grp, free), free as a mask."""

    def make():
        import pyarrow as pa
        import xxhash

        def work(batch):
            fp, grp, free = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            out: list[list[np.ndarray]] = [[], [], []]
            for mask in np.unique(free).tolist():
                own = np.flatnonzero(free == mask)
                for part in stretches(mask, radius + 1):
                    # A group's name is a digest of its parent's name, of the stretch and of the stretch's value.
                    key = np.stack([grp[own], np.full(len(own), part, np.uint64), fp[own] & np.uint64(part)], axis=1)
                    distinct, which = np.unique(key, axis=0, return_inverse=True)
                    name = np.array([xxhash.xxh64_intdigest(k.tobytes(), SEED) for k in distinct], np.uint64)
                    for column, v in zip(out, (fp[own], name[which.ravel()], np.full(len(own), mask & ~part, np.uint64)), strict=True):
                        column.append(v)
            return [pa.array(np.concatenate(c).view(np.int64)) for c in out]

        return work

    return map_batches(members.select("fp", "grp", "free"), make, "fp long, grp long, free long", 20_000)


def local_forests(members: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): for each member of a group that links to others there, the edge to its tree's smallest; members (fp, grp)."""
    spark = members.sparkSession

    def make():
        def work(batch):
            fp, grp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sizes = np.diff(np.append(np.flatnonzero(np.append(True, grp[1:] != grp[:-1])), len(grp)))
            forest = sliced_links(fp.view(np.uint64), sizes, radius)
            a = np.arange(len(fp))
            b = forest.roots(a)
            return [fp[a[a != b]], fp[b[a != b]]]

        return work

    def whole_groups(batches):
        import pyarrow as pa

        work, held = make(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = pa.Table.from_batches([*([held] if held is not None else []), batch]).combine_chunks().to_batches()[0]
            grp = both.column(1).to_numpy()
            cut = int(np.searchsorted(grp, grp[-1], "left"))
            held = both.slice(cut)
            if cut:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in work(both.slice(0, cut))], names=["a", "b"])
        if held is not None and held.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in work(held)], names=["a", "b"])

    dealt = members.select("fp", "grp").repartition(partitions(spark), "grp").sortWithinPartitions("grp", "fp")
    return stored(dealt.mapInArrow(whole_groups, "a long, b long").distinct(), "edges", batch_rows=20_000)


def link_edges(distinct: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Edges that connect exactly the fingerprints that links connect. distinct: a stored table (fp)."""
    members = _sends(distinct.select("fp", F.lit(0).cast("long").alias("grp"), F.lit(-1).cast("long").alias("free")), radius)
    edges, free = None, 64
    while True:
        members = stored(members, "members", batch_rows=20_000)
        free -= free // (radius + 1)  # bits that are free now, at most
        sizes = stored(members.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > 1), "groups")
        large = sizes.where(F.col("n") > group)
        again = free > 11 and not large.isEmpty()  # with 11 free bits a group has 2,048 members at most
        fit = sizes.where(F.col("n") <= group) if again else sizes
        found = local_forests(members.join(fit.select("grp"), "grp"), radius)
        edges = found if edges is None else edges.unionByName(found)
        if not again:
            return edges
        members = _sends(members.join(large.select("grp"), "grp"), radius)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that edges (a, b) can reach, for all nodes with an edge.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest neighbour, until nothing
    changes, by count and checksum. A round deals rows by node; there are as many tasks as the edges need.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    state = lambda x: tuple(x.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
    now = state(e)
    while True:
        both = spread(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))), 2 * now[0], "a")
        # Larger neighbours of a node go to its smallest neighbour, itself included.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = spread(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), now[0], "a").distinct()
        # A node and its smaller neighbours go to the smallest of them.
        low = big.groupBy("a").agg(F.min("b").alias("m"))
        small = big.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b")))
        new = stored(spread(small, 2 * now[0], "a").distinct(), "links")
        was, now = now, state(new)
        discard(e)
        e = new
        if now == was:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    marked = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(link_edges(distinct, radius))
    rooted = distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stored(rooted.join(least, "root").select(F.col("fp").alias("f"), "component_id"), "components")
    return marked.join(of, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, Jaccard similarity of 0.8).

    It is the one of the smallest id; of several texts under that id, the one of the least MD5; a null id comes after all
    others. Rows of the same id and text are one document, of which the least row in JSON stays. Rows of one id and
    different texts are documents each: only what is near to another goes.
    """
    ready(spark)
    found = near_copies(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    kept = found.groupBy("component").agg(first.alias("x")).select(F.col("x.key").alias("kept"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key(F.col("doc_id"), F.col("text")).alias("_key"))
    rows = rows.groupBy("_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return rows.join(kept, F.col("_key") == F.col("kept"), "left_semi").select(*[F.col(f"_row.`{c}`") for c in docs.columns])
