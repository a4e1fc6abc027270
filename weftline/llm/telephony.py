"""Telephony audio columns: G.711 and IMA ADPCM in RIFF containers, expanded and resampled.

mu-law and A-law bytes are expanded by 256-entry lookup tables built from their companding rules. ADPCM is decoded with
numpy across blocks: all blocks of a batch advance one nibble at a time together, `BLOCKS` of them at most. PCM is
resampled by a ratio of two integers with linear interpolation. All arithmetic is in integers, so equal bytes give equal
results in any batch.

The query stores each text as a mu-law file and, beside it, the PCM that the file resamples to; both are read back, and
payload, digests and features come from what was read.

Edge cases: null text is empty, and an empty payload is padded to one whole frame; a text of any length is one file; null
media gives null PCM; bytes that aren't such a container give null as well; repeated rows and null ids give a row each,
and equal texts equal values, so there are no ties to settle; an empty table gives an empty result; further columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, ready, stored, table, texts

FRAME = 576
RATE = 8000
#: Output samples for input samples of the PCM that the query stores: 8 to 6 kHz keeps a telephone's band of 3.4 kHz less its top.
UP, DOWN = 3, 4
#: Samples repeat over long distances: larger pages and a higher level make the table a tenth smaller.
DENSE = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(1 << 23)}
#: ADPCM blocks that are decoded together.
BLOCKS = 4096
ALAW, MULAW, IMA = 6, 7, 17
#: The step sizes and the index changes of IMA ADPCM.
STEPS = np.array([7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int32)
INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def _mulaw() -> np.ndarray:
    c = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((c & 15) << 3) + 132 << (c >> 4 & 7)) - 132
    return np.where(c & 128, -size, size).astype(np.int16)


def _alaw() -> np.ndarray:
    c = np.arange(256, dtype=np.int32) ^ 0x55
    exponent = c >> 4 & 7
    size = ((c & 15) << 4) + 8
    size = np.where(exponent > 0, size + 256 << np.maximum(exponent - 1, 0), size)
    return np.where(c & 128, size, -size).astype(np.int16)


MULAW_PCM, ALAW_PCM = _mulaw(), _alaw()


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """PCM of mono IMA blocks: uint8 [blocks, bytes] to int16 [blocks, 1 + 2 * (bytes - 4)]."""
    n, width = blocks.shape
    body = np.ascontiguousarray(blocks[:, 4:].T)
    out = np.empty((1 + 2 * (width - 4), n), np.int16)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2").ravel().astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32)
    out[0] = value
    # For each index and nibble: the change of the value and the next index.
    code = np.arange(16)
    step = STEPS[:, None]
    change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
    change = np.where(code & 8, -change, change).astype(np.int32).ravel()
    follow = (np.clip(np.arange(89)[:, None] + INDEX[code & 7], 0, 88) * 16).astype(np.int32).ravel()
    index *= 16
    for k in range(width - 4):
        for half in (0, 1):
            at = index + (body[k] >> 4 if half else body[k] & 15)
            value += change[at]
            np.minimum(value, 32767, out=value)
            np.maximum(value, -32768, out=value)
            index = follow[at]
            out[1 + 2 * k + half] = value
    return out.T


def resample(pcm: np.ndarray, up: int = 2, down: int = 1) -> np.ndarray:
    """`up` samples for every `down`, by linear interpolation in integers; the last sample holds on."""
    at = np.arange(-(-len(pcm) * up // down), dtype=np.int64) * down
    left, part = at // up, (at % up).astype(np.int32)
    x = np.append(pcm, pcm[-1:]).astype(np.int32)
    return ((x[left] * (up - part) + x[left + 1] * part) // up).astype("<i2")


def container(data: bytes, form: int, rate: int = RATE, block: int = 1) -> bytes:
    """A RIFF file of one channel. form: ALAW, MULAW or IMA."""
    if form == IMA:
        per = 1 + 2 * (block - 4)
        fmt = struct.pack("<HHIIHHHH", IMA, 1, rate, rate * block // per, block, 4, 2, per)
        samples = len(data) // block * per
    else:
        fmt = struct.pack("<HHIIHHH", form, 1, rate, rate, 1, 8, 0)
        samples = len(data)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def parse(media: bytes) -> tuple[int, int, int, bytes] | None:
    """(form, rate, block size, data) of a RIFF file, None if it is none."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    at, head = 12, None
    while at + 8 <= len(media):
        (size,) = struct.unpack_from("<I", media, at + 4)
        kind, at = media[at : at + 4], at + 8
        if kind == b"fmt " and size >= 16:
            head = struct.unpack_from("<HHIIHH", media, at)
        elif kind == b"data" and head:
            return head[0], head[2], head[4], media[at : at + size]
        at += size + size % 2
    return None


def to_pcm(media: bytes, up: int = 2, down: int = 1) -> bytes | None:
    """Resampled 16-bit PCM of a telephony container."""
    if (got := parse(media)) is None:
        return None
    form, _, block, data = got
    raw = np.frombuffer(data, np.uint8)
    if form in (ALAW, MULAW):
        pcm = (ALAW_PCM if form == ALAW else MULAW_PCM)[raw]
    elif form == IMA and block > 4:
        pcm = decode_ima(raw[: len(raw) // block * block].reshape(-1, block)).ravel()
    else:
        return None
    return resample(pcm, up, down).tobytes()


def pcm_column(df: DataFrame, media_col: str = "media", id_col: str = "doc_id", up: int = 2, down: int = 1) -> DataFrame:
    """(doc_id, rate, pcm): the containers of a binary column as resampled PCM."""

    def make():
        import pyarrow as pa

        def work(batch):
            media = [x or b"" for x in batch.column(1).to_pylist()]
            rates = [p[1] * up // down if (p := parse(m)) else None for m in media]
            return [batch.column(0), pa.array(rates, pa.int32()), pa.array([to_pcm(m, up, down) for m in media], pa.binary())]

        return work

    return map_batches(df.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media")), make, "doc_id long, rate int, pcm binary")


def payload_of(text: str) -> bytes:
    """UTF-8 bytes of a text, with bytes 255 up to a positive multiple of FRAME."""
    b = text.encode()
    return b + b"\xff" * (max(1, -(-len(b) // FRAME)) * FRAME - len(b))


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", up: int = UP, down: int = DOWN) -> DataFrame:
    """(doc_id, n_bytes, media, pcm): each text as the samples of a mu-law file, and that file as resampled PCM."""

    def make():
        import pyarrow as pa

        def work(batch):
            got = batch.column(1).to_pylist()
            media = [container(payload_of(t), MULAW) for t in got]
            return [batch.column(0), [len(t.encode()) for t in got], pa.array(media, pa.binary()), pa.array([to_pcm(m, up, down) for m in media], pa.binary())]

        return work

    return map_batches(texts(docs, id_col, text_col), make, "doc_id long, n_bytes long, media binary, pcm binary")


def powers(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of squares, largest size) of the samples of ADPCM blocks."""
    loud, peaks = np.empty(len(frames), np.int64), np.empty(len(frames), np.int32)
    for a in range(0, len(frames), BLOCKS):
        pcm = decode_ima(frames[a : a + BLOCKS])
        loud[a : a + BLOCKS] = np.einsum("ij,ij->i", pcm, pcm, dtype=np.int64)
        peaks[a : a + BLOCKS] = np.maximum(pcm.max(axis=1).astype(np.int32), -(pcm.min(axis=1).astype(np.int32)))
    return loud, peaks


def power(pcm: np.ndarray) -> int:
    return int(np.einsum("i,i->", pcm, pcm, dtype=np.int64)) // len(pcm)


def media_digests(media: DataFrame) -> DataFrame:
    """Payload, digests and acoustic features of stored mu-law files and their PCM."""

    def make():
        def work(batch):
            files, pcms = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            data = [parse(m)[3] for m in files]
            loud, peaks = powers(np.frombuffer(b"".join(data), np.uint8).reshape(-1, FRAME))
            ends, samples = np.cumsum([len(d) // FRAME for d in data]), 1 + 2 * (FRAME - 4)
            features = []
            for d, pcm, end in zip(data, pcms, ends, strict=True):
                raw, n = np.frombuffer(d, np.uint8), len(d) // FRAME
                mu = MULAW_PCM[raw]
                crossings = int(np.count_nonzero((mu[1:] < 0) != (mu[:-1] < 0)))
                out = np.frombuffer(pcm, "<i2")
                features.append(f"mulaw_power={power(mu)};alaw_power={power(ALAW_PCM[raw])};crossings={crossings};pcm_samples={len(out)};pcm_power={power(out)};pcm_crc32={zlib.crc32(pcm)};adpcm_power={int(loud[end - n : end].sum()) // (n * samples)};adpcm_peak={int(peaks[end - n : end].max())}")
            return [
                batch.column(0),
                batch.column(1),
                [len(d) for d in data],
                [hashlib.sha256(d).hexdigest() for d in data],
                [zlib.crc32(d[-32:]) for d in data],
                [len(m) for m in files],
                [hashlib.sha256(m).hexdigest() for m in files],
                features,
            ]

        return work

    return map_batches(media.select("doc_id", "n_bytes", "media", "pcm"), make, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op6_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return media_digests(stored(text_media(table(spark, sf_dir, "documents")), "media", **DENSE))
