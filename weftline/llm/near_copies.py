"""Near copies by SimHash and the exact Jaccard similarity of word shingles, for the pipeline's stage.

A text's shingles are the 64-bit hashes of its runs of SHINGLE words (ASCII lower case, ASCII blanks between); a text of
fewer words is one shingle. Two texts link at a similarity of SIMILARITY or more, which is always counted on the whole
sets of shingles.

The first candidates are SimHash's: 64 bits by majority over the shingles, compared bit-sliced by simhash.link_edges.
Texts whose fingerprints are linked at three bits or fewer, or by others, are one group. Of pairs at 0.8 about ten bits
differ, so further candidates are texts that agree in one of BANDS bands of ROWS MinHashes: of pairs at 0.8 exactly,
1 - (1 - 0.8 ** ROWS) ** BANDS, or 0.99995, are candidates, and more of closer ones.

Texts of the same shingles are one. SimHash's groups go first, then FIRST bands, then the others: a later turn looks only at
groups whose members are not all linked yet, so a large family of copies is sent a few times, not once for each band.
Groups of the same members are one. Members of a group are compared unless they are linked already, whose pairs could
add nothing to components. A group of more than GROUP texts is dealt into parts of about that size, each of which gets
the group's smallest text besides. So rows grow with the texts and a task holds a part at a time. What parts may miss is
looked for in a last turn: texts of such groups that are not one component by then get FINE_BANDS bands of FINE_ROWS
further MinHashes, which tell texts of little likeness apart; 0.99998 of pairs at 0.8 agree in one of them. Only pairs
whose fine groups are above GROUP too depend on the parts, which are others in every band.

Edge cases: null text is empty; texts without words are one; texts of any length are read whole; repeated rows and null
ids give a row each; ties among ids don't matter, since texts are told apart by their shingles; an empty table gives an
empty result; further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_batches, partitions, relax, row_key, spread, stored

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS, FIRST = 25, 5, 4
FINE_BANDS, FINE_ROWS = 100, 10
#: Keys of texts that share a band, up to which they are broadcast (60 bytes each).
BROADCAST_KEYS = 200_000
#: Texts of a group above which it is dealt into parts.
GROUP = 512
SEED = 42
#: Shingles that meet all MinHashes at once.
BLOCK = 2048


def _odd(n: int, salt: int) -> np.ndarray:
    return np.random.default_rng([SEED, salt]).integers(0, 1 << 64, n, np.uint64) | np.uint64(1)


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the runs of words, in order."""
    import xxhash

    digest, words = xxhash.xxh64_intdigest, text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    w, n = np.fromiter((digest(x, SEED) for x in words), np.uint64, len(words)), len(words) - shingle + 1
    h = np.zeros(n, np.uint64)
    for i, factor in enumerate(_odd(shingle, 1)):
        h += w[i : i + n] * factor
    h = (h ^ (h >> np.uint64(32))) * _odd(1, 2)[0]
    return np.unique(h ^ (h >> np.uint64(29)))


def fingerprint(sets: np.ndarray) -> np.uint64:
    """SimHash of a set of shingles: a bit is 1 if set in over half of them; without shingles zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(sets), BLOCK):
        ones += np.unpackbits(sets[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(sets)).view(">u8")[0].astype(np.uint64)


class Bands:
    """Keys of the bands of a set of shingles; `salt` gives further MinHashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, salt: int = 3) -> None:
        self.bands, self.rows = bands, rows
        self.factors, self.shifts = _odd(bands * rows, salt), _odd(bands * rows, salt + 1)

    def keys(self, sets: np.ndarray) -> np.ndarray:
        import xxhash

        if not len(sets):
            return np.zeros(0, np.int64)
        least = np.full(len(self.factors), np.uint64(2**64 - 1))
        for at in range(0, len(sets), BLOCK):
            mixed = (sets[at : at + BLOCK] ^ self.shifts[:, None]) * self.factors[:, None]
            np.minimum(least, mixed.min(axis=1), out=least)
        parts = least.reshape(self.bands, self.rows)
        return np.array([xxhash.xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(parts)], np.uint64).view(np.int64)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(row_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, sid, fp, bands): key names id and text, sid the set of shingles, fp is their SimHash."""

    def make():
        import pyarrow as pa
        import xxhash

        bands = Bands()

        def work(batch):
            sid, fp, keys = [], [], []
            for t in batch.column(2).to_pylist():
                found = shingles(t)
                sid.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                fp.append(fingerprint(found))
                keys.append(bands.keys(found))
            relax()
            return [batch.column(0), batch.column(1), *(np.array(x, np.uint64).view(np.int64) for x in (sid, fp)), pa.array(keys, pa.list_(pa.int64()))]

        return work

    return map_batches(keyed_texts(docs, id_col, text_col), make, "key string, doc_id long, sid long, fp long, bands array<long>")


def simhash_groups(marked: DataFrame) -> DataFrame:
    """(band, sid): texts whose SimHashes links connect, by the smallest of these, as a stored table; marked: (sid, fp)."""
    from .simhash import components, link_edges

    of = stored(marked.select("sid", "fp").distinct(), "fingerprints")
    distinct = stored(of.select("fp").distinct(), "distinct")
    found = components(link_edges(distinct))
    keyed = of.join(found, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("band"), "sid")
    out = in_use(keyed)
    discard(of, distinct)
    return out


def shingle_sets(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sid, sets): the shingles, as bytes, of the texts named by chosen (key, sid), a stored table, which is broadcast up to
    BROADCAST_KEYS rows."""

    def make():
        import pyarrow as pa

        def work(batch):
            out = [shingles(t).tobytes() for t in batch.column(1).to_pylist()]
            relax()
            return [batch.column(0), pa.array(out, pa.binary())]

        return work

    few = chosen.count() <= BROADCAST_KEYS
    names = chosen.withColumnRenamed("key", "chosen")
    d = keyed_texts(docs, id_col, text_col).join(F.broadcast(names) if few else names, F.col("key") == F.col("chosen")).select("sid", "text")
    return map_batches(d.dropDuplicates(["sid"]), make, "sid long, sets binary")


def fine_bands(sets: DataFrame) -> DataFrame:
    """(sid, band): the further bands of sets (sid, sets)."""

    def make():
        import pyarrow as pa

        bands = Bands(FINE_BANDS, FINE_ROWS, 5)
        return lambda batch: [batch.column(0), pa.array([bands.keys(np.frombuffer(x, np.uint64)) for x in batch.column(1).to_pylist()], pa.list_(pa.int64()))]

    return map_batches(sets.select("sid", "sets"), make, "sid long, bands array<long>").select("sid", F.explode("bands").alias("band"))


def group_links(sets: list[np.ndarray], known: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links (i, j) that connect exactly what all links between members connect; known: the members' components so far."""
    sizes = np.array([len(x) for x in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.append(0, np.cumsum(sizes))
    comp, links, seen = np.unique(known, return_inverse=True)[1], [], np.zeros(int(codes.max(initial=-1)) + 1, bool)
    for i in range(len(sets) - 1):
        if not (comp[i + 1 :] != comp[i]).any():
            continue
        mine = codes[starts[i] : starts[i + 1]]
        seen[mine] = True
        both = np.add.reduceat(seen[codes[starts[i + 1] :]], starts[i + 1 : -1] - starts[i + 1], dtype=np.int64)
        seen[mine] = False
        near = both >= similarity * (sizes[i] + sizes[i + 1 :] - both) - 1e-9
        for j in np.flatnonzero(near) + i + 1:
            if comp[j] != comp[i]:
                links.append((i, int(j)))
                comp[comp == comp[j]] = comp[i]
    return links


def _links(batches):
    """Edges (a, b) of whole groups that stand one after another in (grp, sid, root, sets)."""
    import pyarrow as pa

    def done():
        out = group_links(sets, np.array(roots)) if len(sids) > 1 else []
        return [(sids[i], sids[j]) for i, j in out]

    now, sids, roots, sets = None, [], [], []
    for batch in batches:
        edges = []
        for grp, sid, root, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if grp != now:
                edges += done()
                now, sids, roots, sets = grp, [], [], []
            sids.append(sid)
            roots.append(root)
            sets.append(np.frombuffer(raw, np.uint64))
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], names=["a", "b"])
    if last := done():
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*last, strict=True)], names=["a", "b"])


def in_use(keyed: DataFrame) -> DataFrame:
    """Rows (band, sid) of the bands that several texts share, as a stored table."""
    shared = keyed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    return stored(keyed.join(shared, "band"), "shared")


def rooted(keyed: DataFrame, roots: DataFrame | None) -> DataFrame:
    """keyed (band, sid) with the component of each text by roots (node, root)."""
    if roots is None:
        return keyed.select("band", "sid", F.col("sid").alias("root"))
    return keyed.join(roots, F.col("sid") == F.col("node"), "left").select("band", "sid", F.coalesce("root", "sid").alias("root"))


def turn(keyed: DataFrame, sets: DataFrame, roots: DataFrame | None, group: int = GROUP) -> DataFrame:
    """(a, b): links between texts of a band that roots (node, root) doesn't connect yet. keyed: stored (band, sid); sets: (sid, sets)."""
    n = keyed.count()
    members = stored(spread(rooted(keyed, roots), n, "band"), "rooted")
    g = spread(members, n, "band").groupBy("band").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("sid")).alias("x"), F.min(F.struct("sid", "root")).alias("pivot"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    g = g.where("lo <> hi").groupBy("n", "x", "pivot").agg(F.min("band").alias("band"))
    g = stored(g.withColumn("parts", F.ceil(F.col("n") / group).cast("int")), "groups")
    part = F.pmod(F.xxhash64("sid", "band"), F.col("parts"))
    dealt = members.join(g.select("band", "parts"), "band").select("band", "sid", "root", part.alias("part"))
    pivots = g.where("parts > 1").select("band", "pivot.sid", "pivot.root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"))
    dealt = dealt.unionByName(pivots).select(F.xxhash64("band", "part").alias("grp"), "sid", "root").distinct()
    rows = dealt.join(sets, "sid").select("grp", "sid", "root", "sets")
    out = stored(rows.repartition(partitions(keyed.sparkSession), "grp").sortWithinPartitions("grp", "sid").mapInArrow(_links, "a long, b long"), "edges")
    discard(members, g)
    return out


def split_groups(keyed: DataFrame, roots: DataFrame, group: int = GROUP) -> DataFrame:
    """(sid): texts of bands of more than `group` texts that roots doesn't make one component, as a stored table."""
    large = keyed.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > group).select("band")
    members = rooted(keyed.join(large, "band"), roots)
    open_ = members.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band")
    return stored(members.join(open_, "band").select("sid").distinct(), "split")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(key, doc_id, component, component_id) of every row: a component's name, and the smallest id that links can reach.

    docs is read twice: for the signatures of all texts, then for the shingles of those that share a band.
    """
    from .simhash import components

    marked = stored(signatures(docs, id_col, text_col), "signatures")
    slots = stored(marked.select("sid", F.posexplode("bands").alias("slot", "band")).distinct(), "bands")
    keyed = in_use(slots)
    discard(slots)
    alike = simhash_groups(marked)
    needed = keyed.select("sid").unionByName(alike.select("sid")).distinct()
    chosen = stored(marked.join(needed, "sid", "left_semi").groupBy("sid").agg(F.min("key").alias("key")).select("key", "sid"), "chosen")
    sets = stored(shingle_sets(docs, chosen, id_col, text_col), "sets")
    first, second = (stored(keyed.where(c).select("band", "sid"), "turn") for c in (F.col("slot") < FIRST, F.col("slot") >= FIRST))
    edges = turn(alike, sets, None, group)
    edges = edges.unionByName(turn(first, sets, components(edges), group))
    edges = edges.unionByName(turn(second, sets, components(edges), group))
    found = components(edges)
    split = split_groups(keyed.select("band", "sid"), found, group)
    if not split.isEmpty():
        fine = in_use(fine_bands(sets.join(split, "sid", "left_semi")))
        edges = edges.unionByName(turn(fine, sets, found, group))
        found = components(edges)
    distinct = marked.groupBy("sid").agg(F.min("doc_id").alias("least"))
    of = stored(distinct.join(found, F.col("sid") == F.col("node"), "left").select("sid", "least", F.coalesce("root", "sid").alias("root")), "of")
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stored(of.join(least, "root").select(F.col("sid").alias("s"), F.col("root").alias("component"), "component_id"), "components")
    discard(keyed, alike, chosen, sets, first, second, split)
    return marked.join(of, F.col("sid") == F.col("s")).select("key", "doc_id", "component", "component_id")
