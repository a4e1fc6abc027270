"""Training-data operators against brute force, and on null, empty, repeated, clashing and long rows."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import byte_bpe, line_dedup, packing, pitman_yor, quality_rules, simhash, telephony, token_counts, token_files, toxicity
from weftline.llm.common import ready
from weftline.llm.encoders import ByteLevel, WordEnd

LONG = "words without an end, and then some more of them. " * 3000
BASE = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what it is that makes it so quick today"
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace("lazy", "sleepy")), (4, None), (5, ""), (6, "  \n\t "), (7, "Ünïcode 中文 <|endoftext|> don't\n\nstop  now \x1c"), (7, "Ünïcode 中文 <|endoftext|> don't\n\nstop  now \x1c"),
    (8, LONG), (None, "a row without an id"), (9, "a" * 700), (20, "one two"), (21, "x  y   z \n w"), (22, "1 22 333 4,444.5 !!! ### $$$"),
]
SCHEMA = "doc_id long, text string, score double, fp string, bucket int, grp string, _words string, kept boolean, source string, n_chars long, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    ready(spark)
    return spark.createDataFrame([(i, t, 0.5, "f", 1, "g", "w", True, f"s{k % 3}", len(t or ""), None) for k, (i, t) in enumerate(TEXTS)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("1 = 0")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (8, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def tiktoken_of(name):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("kind", "name"), [(ByteLevel, "byte_bpe_50k.json"), (WordEnd, "word_bpe_49k.json")])
def test_encoders_equal_the_library(kind, name):
    import pyarrow as pa

    rng, signs = np.random.default_rng(5), list("ab zéñ\n\t  'st123!!中　\x1c\x00\x01ÀİΣ\xa0́<|>")
    cases = [t or "" for _, t in TEXTS] + ["".join(rng.choice(signs, rng.integers(0, 50))) for _ in range(800)]
    enc, lib = kind(P.path(name), limit=50), library(name)
    for a in range(0, len(cases), 100):
        part = pa.array(cases[a : a + 100], pa.string())
        assert [x.tolist() for x in enc.encode(part).split()] == [lib(t) for t in cases[a : a + 100]]
        assert enc.count(part).tolist() == [len(lib(t)) for t in cases[a : a + 100]]


def test_byte_bpe(docs, empty):
    path, tik = P.path(byte_bpe.VOCABULARY), tiktoken_of(byte_bpe.VOCABULARY)
    want = []
    for i, t in TEXTS:
        ids = tik.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, byte_bpe.round_trip_digests(docs, path).collect()), key=repr) == sorted(want, key=repr)
    back = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, path), path)
    assert sorted((bytes(r.data).decode() for r in back.collect())) == sorted(t or "" for _, t in TEXTS)
    assert byte_bpe.round_trip_digests(empty, path).count() == 0


def test_token_counts(docs, empty):
    lib = library(token_counts.VOCABULARY)
    n = [len(lib(t)) for _, t in TEXTS]
    limits = token_counts.limit_table(token_counts.length_histogram(docs, P.path(token_counts.VOCABULARY)))
    for r in limits.collect():
        assert (r.n_docs, r.docs_at_least, r.truncated_total, r.total_tokens) == (n.count(r.context_limit), sum(x >= r.context_limit for x in n), sum(min(x, r.context_limit) for x in n), sum(n))
    for limit in (0, 1, 7, 1000, 10**6):
        assert token_counts.truncated_total(limits, limit) == sum(min(x, limit) for x in n)
    assert token_counts.quantile(limits, 0.5) == sorted(n)[math.ceil(len(n) / 2) - 1]
    assert token_counts.limit_table(token_counts.length_histogram(empty, P.path(token_counts.VOCABULARY))).count() == 0


def test_telephony(docs, empty):
    got = telephony.media_digests(telephony.text_media(docs)).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        t = next(t or "" for i, t in TEXTS if i == r.doc_id)
        p = telephony.payload_of(t)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t.encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    assert telephony.text_media(empty).count() == 0
    assert telephony.MULAW_PCM[[0x00, 0x7F, 0x80, 0xFF]].tolist() == [-32124, 0, 32124, 0] and telephony.ALAW_PCM[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]
    assert telephony.parse(b"junk") is None and telephony.to_pcm(b"RIFFxxxxWAVE") is None


def test_ima_equals_a_plain_decoder():
    rng = np.random.default_rng(2)
    blocks = rng.integers(0, 256, (3, 40), dtype=np.uint8)
    for row, got in zip(blocks, telephony.decode_ima(blocks), strict=True):
        value, index = int(np.array(row[:2]).view("<i2")[0]), min(int(row[2]), 88)
        want = [value]
        for b in row[4:].tolist():
            for code in (b & 15, b >> 4):
                step = int(telephony.STEPS[index])
                d = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
                value = max(-32768, min(32767, value - d if code & 8 else value + d))
                index = max(0, min(88, index + int(telephony.INDEX[code & 7])))
                want.append(value)
        assert got.tolist() == want
    data = bytes(blocks.ravel())
    assert len(telephony.to_pcm(telephony.container(data, telephony.IMA, block=40))) == 2 * 2 * 3 * 73


def test_packing(docs, empty):
    lib, got = library(packing.VOCABULARY), packing.pack_documents(docs, P.path(packing.VOCABULARY)).collect()
    bins, by = {}, {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by.setdefault(r.doc_id, []).append(r)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    for i, t in TEXTS:
        if i != 7:  # two rows share that id
            ids, at = [*lib(t), packing.END], 0
            for k, r in enumerate(sorted(by[i], key=lambda r: r.piece)):
                assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()))
                at += r.length
            assert at == len(ids)
    total = sum(len(lib(t)) + 1 for _, t in TEXTS)
    assert len(bins) <= -(-total // packing.CAPACITY) + 1
    assert packing.pack_documents(empty, P.path(packing.VOCABULARY)).count() == 0


def test_long_pre_tokens():
    """Pre-tokens above LONG_BYTES, by the heap, as tiktoken has them, and a megabyte of them within a minute."""
    import time

    import pyarrow as pa

    tik, bpe = tiktoken_of(byte_bpe.VOCABULARY), byte_bpe.matrix_bpe(P.path(byte_bpe.VOCABULARY))
    rng = np.random.default_rng(8)
    letters = lambda signs, n: "".join(rng.choice(list(signs), n))
    for t in ("a" * 5000, letters("abcdefgh", 20_000), letters("etaoinshr", 1024), letters("etaoinshr", 1025), "so " + "ünïé中文" * 900 + " on"):
        assert bpe.encode(pa.array([t])).ids.tolist() == tik.encode_ordinary(t)
    t, began = letters("etaoinshrdlu", 1_000_000), time.perf_counter()
    assert bpe.encode(pa.array([t])).ids.tolist() == tik.encode_ordinary(t) and time.perf_counter() - began < 60


def test_stored_pcm_and_features(spark):
    """Every number of the feature column worked out sample by sample, and the PCM column from other containers."""
    from weftline.llm.common import stored

    texts = ["", "hello wörld", "x" * 1500]
    media = stored(telephony.text_media(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "t")
    got = {r.doc_id: r.feature for r in telephony.media_digests(media).collect()}

    def mulaw(b):
        b = ~b & 255
        size = ((((b & 15) << 3) + 132) << (b >> 4 & 7)) - 132
        return -size if b & 128 else size

    def alaw(b):
        b ^= 85
        e, m = b >> 4 & 7, b & 15
        size = (m << 4) + 8 if e == 0 else ((m << 4) + 264) << (e - 1)
        return size if b & 128 else -size

    def ima(block):
        value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
        out = [value]
        for b in block[4:]:
            for code in (b & 15, b >> 4):
                step = int(telephony.STEPS[index])
                d = (step >> 3) + sum(step >> k for k, bit in ((0, 4), (1, 2), (2, 1)) if code & bit)
                value = max(-32768, min(32767, value - d if code & 8 else value + d))
                index = max(0, min(88, index + (2 * (code & 7) - 6 if code & 4 else -1)))
                out.append(value)
        return out

    def resampled(x, up, down):
        return [(lambda i, k: (x[i] * (up - k) + x[min(i + 1, len(x) - 1)] * k) // up)(*divmod(j * down, up)) for j in range(-(-len(x) * up // down))]

    for i, t in enumerate(texts):
        p = telephony.payload_of(t)
        mu, a = [mulaw(b) for b in p], [alaw(b) for b in p]
        out = resampled(mu, telephony.UP, telephony.DOWN)
        pcm = np.array(out, "<i2").tobytes()
        adpcm = [v for k in range(0, len(p), 576) for v in ima(p[k : k + 576])]
        power = lambda x: sum(v * v for v in x) // len(x)
        want = {"mulaw_power": power(mu), "alaw_power": power(a), "crossings": sum((x < 0) != (y < 0) for x, y in zip(mu, mu[1:], strict=False)), "pcm_samples": len(out), "pcm_power": power(out), "pcm_crc32": zlib.crc32(pcm), "adpcm_power": power(adpcm), "adpcm_peak": max(map(abs, adpcm))}
        assert got[i] == ";".join(f"{k}={v}" for k, v in want.items())
        assert media.where(F.col("doc_id") == i).first().pcm == pcm
    raw = bytes(range(256))
    rows = [(1, telephony.container(raw, telephony.ALAW)), (2, telephony.container(raw[:120], telephony.IMA, block=40)), (3, b"junk"), (4, None)]
    pcm = {r.doc_id: (r.rate, r.pcm) for r in telephony.pcm_column(spark.createDataFrame(rows, "doc_id long, media binary")).collect()}
    assert pcm[1] == (16_000, np.array(resampled([alaw(b) for b in raw], 2, 1), "<i2").tobytes())
    assert pcm[2][1] == np.array(resampled([v for k in (0, 40, 80) for v in ima(raw[k : k + 40])], 2, 1), "<i2").tobytes()
    assert pcm[3] == pcm[4] == (None, None)


def test_fullest_is_the_best_subset():
    rng = np.random.default_rng(3)
    for _ in range(60):
        have = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 30, 5)}
        items = [k for k, v in have.items() for _ in range(v)]
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        cap = int(rng.integers(5, 60))
        got = packing.fullest(cap, have)
        assert sum(k * v for k, v in got) == max(s for s in sums if s <= cap) and all(v <= have[k] for k, v in got)
    histogram = {int(k): int(v) for k, v in zip(rng.integers(1, 1025, 200), rng.integers(1, 50, 200), strict=True)}
    patterns = packing.minimum_bin_slack(histogram)
    used = Counter()
    for p in patterns:
        assert sum(k * v for k, v in p.content) <= 1024
        used.update({k: v * p.copies for k, v in p.content})
    assert used == histogram


def test_token_files(docs, empty):
    lib, at = library(token_files.VOCABULARY), 0
    got = sorted((r for r in token_files.read_blocks(*token_files.write_blocks(token_files.stored(token_files.sorted_ids(docs, P.path(token_files.VOCABULARY)), "t"))).collect()), key=lambda r: r.start)
    for (_, t), r in zip(sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), got, strict=True):
        ids = [*lib(t), token_files.END]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [r.doc_id for r in got][0] is None and [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])
    runs = token_files.stored(token_files.sorted_ids(empty, P.path(token_files.VOCABULARY)), "t")
    assert token_files.read_blocks(*token_files.write_blocks(runs)).count() == 0


def test_huffman_lengths_and_round_trip():
    import heapq

    rng = np.random.default_rng(4)
    counts = np.zeros(500, np.int64)
    counts[rng.choice(500, 300, replace=False)] = rng.zipf(1.3, 300) % 10**9 + 1
    lengths = token_files.code_lengths(counts, 20)
    heap = [(int(c), i, None) for i, c in enumerate(counts) if c]
    heapq.heapify(heap)
    cost, k = 0, 1000
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], k := k + 1, None))
    assert int((counts * lengths).sum()) >= cost and sum(2.0 ** -int(x) for x in lengths if x) <= 1
    tight = token_files.code_lengths(counts, 9)
    assert tight.max() <= 9 and sum(2.0 ** -int(x) for x in tight if x) <= 1
    codes, ids = token_files.Codes(lengths), rng.choice(np.flatnonzero(counts), 3000)
    marks, bits = codes.encode(ids, 64)
    assert codes.decode(marks, bits, len(ids), 64).tolist() == ids.tolist()
    assert token_files.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0]


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    plain = {}
    for i, t in TEXTS:
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        plain[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    for r in got:
        assert r.fp & (1 << 64) - 1 == plain[r.doc_id]
    reach = {i: {i} for i in plain}
    for _ in plain:
        for a in plain:
            for b in plain:
                if bin(plain[a] ^ plain[b]).count("1") <= 3:
                    reach[a] |= reach[b]
    for r in got:
        ids = [i for i in reach[r.doc_id] if i is not None]
        assert r.component_id == (min(ids) if ids else None)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("group", [2048, 24])
def test_links_equal_all_pairs(spark, group):
    ready(spark)
    rng, values = np.random.default_rng(3), [0, 1, 3, 7, 15, 2**63]
    for _ in range(12):
        base = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(40):
            x = base
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            values.append(x)
    v = np.array(list(dict.fromkeys(values)), np.uint64)
    up = list(range(len(v)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= 3) + i + 1:
            a, b = root(i), root(int(j))
            up[max(a, b)] = min(a, b)
    df = simhash.stored(spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long"), "t")
    found = {r.node: r.root for r in simhash.components(simhash.link_edges(df, 3, group)).collect()}
    classes = {}
    for i, x in enumerate(v.view(np.int64).tolist()):
        assert classes.setdefault(found.get(x, x), root(i)) == root(i)
    assert len(classes) == len({root(i) for i in range(len(v))})


def test_quality_rules(docs, empty, labels):
    model = quality_rules.fit(docs, labels)
    threshold, trusted = model.first().threshold, {r.doc_id for r in labels.where("quality = 1").where(f"pmod(xxhash64('threshold', doc_id), {quality_rules.TUNE}) <> 0").collect()}
    got = quality_rules.judge(docs.select("doc_id", "text"), model).collect()
    h = lambda *w: (lambda s: [s := xxhash.xxh64_intdigest(x, s) for x in w][-1])(42)
    signed = lambda x: (x - (1 << 64) if x >> 63 else x) % quality_rules.BUCKETS
    grams = {k: [signed(h(w)) for w in words(t)] + [signed(h(a, b)) for a, b in zip(words(t), words(t)[1:], strict=False)] for k, (_, t) in enumerate(TEXTS)}
    raw, good = Counter(), Counter()
    for k, (i, _) in enumerate(TEXTS):
        raw.update(grams[k])
        if i in trusted:
            good.update(grams[k])
    scale = good.total() / raw.total()
    by = {t: k for k, (_, t) in enumerate(TEXTS)}
    for r in got:
        w, g = words(r.text), grams[by[r.text]]
        windows, marked = Counter(zip(w, w[1:], w[2:], strict=False)), [0] * len(w)
        for i in range(len(w) - 2):
            if windows[tuple(w[i : i + 3])] > 1:
                marked[i : i + 3] = 1, 1, 1
        lines = [x for x in (r.text or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * sum(marked) > 50 * len(w)
        llr = sum(math.log((good[b] + 20) / (raw[b] * scale + 20)) for b in g) / len(g) if g else 0.0
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r.text or ""), len(lines) - len(set(lines)), sum(marked), failed)
        assert r.llr == pytest.approx(llr, abs=1e-9) and r.kept == (not failed and r.llr >= threshold)
    assert quality_rules.judge(empty.select("doc_id", "text"), quality_rules.fit(empty, labels)).count() == 0
    assert all(r.llr == 0 for r in quality_rules.judge(docs.select("doc_id", "text"), quality_rules.fit(docs, labels.where("1 = 0"))).collect())


def test_line_dedup(spark, docs, empty):
    pages = [(k, "a" if k < 20 else None, f"  menu \nown {k}\n\nmenu" if k % 2 else f"own {k}") for k in range(24)] + [(99, "a", None)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "doc_id long, source string, text string, extra int")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[1].text == "own 1\n" and (got[1]._n_lines, got[1]._n_dropped) == (3, 2) and got[2].text == "own 2"
    assert got[21].text == pages[21][2] and got[99].text is None  # two pages of the site without a name are too few
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.dedup_lines(docs).count() == len(TEXTS)


def test_line_dedup_stage_drops_rare_boilerplate(spark):
    """A line on 5 of a site's 500 pages is repeated; one on 4 may be chance; a larger site asks for more pages."""
    pages = [(k, "a", f"own {k}" + "\nfive" * (k < 5) + "\nfour" * (k < 4)) for k in range(500)]
    pages += [(1000 + k, "b", f"own {k}" + "\nfive" * (k < 5) + "\neight" * (k < 8)) for k in range(1200)]
    df = spark.createDataFrame([(i, s, t, len(t)) for i, s, t in pages], "doc_id long, source string, text string, n_chars long")
    got = {r.doc_id: r for r in line_dedup.stage(spark, df, "").collect()}
    assert got[0].text == "own 0\nfour" and got[0].n_chars == 10 and got[4].text == "own 4"
    assert got[1000].text == "own 0\nfive" and got[1007].text == "own 7" and got[499].text == "own 499"


def test_toxicity(spark, docs, empty, labels):
    assert toxicity.fold("a55 a$$! 5h1t idiot!! win7 in 2019") == " ass ass shlt ldlot wlnt ln "
    assert toxicity.fold("You 1D10T! stuрid a55hole ＩＤＩＯＴ moron###") == " you ldlot stupld asshole ldlot moron "
    rows = [(i, f"{'vile ' * 3 if i % 5 == 0 else 'fine '}text number {'abcdefgh'[i % 8]} " + ("horrid villain" if i % 5 == 0 else "pleasant day")) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(d, d.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic")))
    got = d.select("doc_id", toxicity.scored(model, F.col("text")).alias("s")).collect()
    assert all((r.s.score >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in got)
    safe = toxicity.Matcher(toxicity.Model({toxicity.fold("trash"): 4.0}, (-3.0, 2.0, 0.5)))
    assert safe.hits("into the trash can")[1] == 0 and safe.hits("you trash")[1] == 1
    model = toxicity.fit(docs, labels)
    assert docs.select(toxicity.scored(model, F.col("text")).alias("s")).where("s.score between 0 and 1").count() == len(TEXTS)
    assert empty.select(toxicity.scored(toxicity.fit(empty, labels), F.col("text"))).count() == 0


@pytest.mark.parametrize("buckets", [1, 7])
def test_pitman_yor(spark, docs, empty, buckets):
    got = pitman_yor.score_texts(docs, buckets=buckets).collect()
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in TEXTS}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter()
    for i, t in TEXTS:
        if not held[i]:
            c.update([*(t or "").encode().lower().split(), None])
    n, v = c.total(), len(c)
    assert len(got) == len(TEXTS)
    for r in got:
        want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), sum(c[w] > 0 for w in tokens[r.doc_id]), n)
        assert r.base_score == pytest.approx(want, abs=1e-6) and r.score < 0
    if buckets == 1:
        assert pitman_yor.score_texts(empty).count() == 0


def test_perplexity(docs):
    got = pitman_yor.score_texts(docs, buckets=1).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert r.n_tokens > 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) and r.perplexity >= 1


def test_parent_is_a_distribution():
    """The parent's probabilities of all words and of the unknown one sum to 1."""
    u8 = lambda *x: np.array(x, np.uint64)
    g = pitman_yor.Graph(pitman_yor.pack(u8(5, 9, 11), *(pitman_yor.narrow(np.array(x)) for x in ([4, 2, 1],)), u8(1, 5), *(pitman_yor.narrow(np.array(x)) for x in ([0, 0, 1, 2], [0, 1, 1, 0], [3, 1, 2, 1]))))
    tables, parent = np.array([2, 1, 2, 1]), np.array([2, 1, 1])
    whole = pitman_yor.Whole((0.7, 0.5), 3, int(tables.sum()), int(parent.sum()), {})
    unknown = (pitman_yor.CONCENTRATION + 0.5 * parent.sum()) / 4 / (pitman_yor.CONCENTRATION + tables.sum())
    assert whole.parent(g, tables, parent).sum() + unknown == pytest.approx(1.0)
