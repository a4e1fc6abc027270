"""The near-dedup stage against brute force over all pairs."""

import numpy as np
import pytest

from weftline.llm import near_copies, simhash
from weftline.llm.common import ready

SCHEMA = "doc_id long, text string, source string"


def families(rng, n, copies, words=120):
    """Texts of which copies have one to five words changed: similarities on both sides of 0.8."""
    out = []
    for _ in range(n):
        base = [f"w{x}" for x in rng.integers(0, 5000, words)]
        out.append(base)
        for _ in range(copies):
            w = list(base)
            for k in rng.integers(0, words, rng.integers(1, 6)):
                w[k] = f"v{rng.integers(0, 5000)}"
            out.append(w)
    return [" ".join(w) for w in out]


def brute(rows):
    def grams(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])

    sets, up = [grams(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                links += a != b
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(rows))], links


@pytest.fixture(scope="module")
def rows():
    made = families(np.random.default_rng(7), 6, 9)
    rows = [(100 + i, t) for i, t in enumerate(made)]
    return [*rows, rows[3], rows[3], (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three four"), (None, made[0]), (None, "no id, and no copy of it at all")]


@pytest.mark.parametrize("group", [near_copies.GROUP, 4])
def test_components_equal_all_pairs(spark, rows, group):
    ready(spark)
    docs = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA).repartition(3)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0) for r in near_copies.near_copies(docs, group=group).collect())
    wanted, links = brute(rows)
    assert links > 20
    assert got == sorted((d is None, d or 0, c or 0) for (d, _), c in zip(rows, wanted, strict=True))


def test_stage_keeps_one_of_each_component(spark, rows):
    docs = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA)
    kept = simhash.stage(spark, docs, "").collect()
    wanted, _ = brute(rows)
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for (d, _), c in zip(rows, wanted, strict=True) if d is not None})
    assert [r.text for r in kept if r.doc_id is None] == ["no id, and no copy of it at all"]
    assert simhash.stage(spark, docs.where("1 = 0"), "").count() == 0


def test_fine_turn_finds_what_parts_miss(spark):
    """Texts that all share a band and none of them the pivot: parts of two are too small to meet, further bands aren't."""
    ready(spark)
    made = families(np.random.default_rng(9), 12, 3, 60)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(made)], SCHEMA)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, group=2).collect()}
    assert [got[i] for i in range(len(made))] == brute(list(enumerate(made)))[0]


def test_links_across_a_group():
    """A chain whose ends are not similar is one component; what is linked already is not linked again."""
    sets = [np.arange(i, i + 40, dtype=np.uint64) for i in (0, 4, 8, 100)]
    assert near_copies.group_links(sets, np.arange(4)) == [(0, 1), (1, 2)]
    assert near_copies.group_links(sets, np.array([5, 5, 7, 9])) == [(1, 2)]
    assert near_copies.group_links(sets[:1], np.arange(1)) == []


def test_simhash_candidates_alone(spark, monkeypatch):
    """Without a band in use, what links at three bits of SimHash is found still, and checked: alike bits alone are no link."""
    from pyspark.sql import functions as F

    ready(spark)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join([*base[:-1], "other"]), " ".join(f"u{i}" for i in range(400)), "three words only"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)
    marked = near_copies.signatures(docs).withColumn("bands", F.array(F.col("sid")))
    prints = {r.doc_id: r.fp & (1 << 64) - 1 for r in marked.collect()}
    for i, t in enumerate(texts):
        found = near_copies.shingles(t).tolist()
        assert prints[i] == sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in found) > len(found))
    assert (prints[0] ^ prints[1]).bit_count() <= 3 and near_copies.fingerprint(np.zeros(0, np.uint64)) == 0
    monkeypatch.setattr(near_copies, "signatures", lambda *_: marked)
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == {0: 0, 1: 0, 2: 2, 3: 3}
    monkeypatch.setattr(near_copies, "signatures", lambda *_: marked.withColumn("fp", F.lit(7).cast("long")))
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == {0: 0, 1: 0, 2: 2, 3: 3}
