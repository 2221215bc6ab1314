"""The JPEG code: exact round trips, a plain general encoder against the decoder, known samples, and the query."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.llm import jpeg, media


@pytest.mark.parametrize("blocks", [1, 2, 5, 6, 7, 24, 25, 1000])
def test_round_trip(blocks):
    payload = np.random.default_rng(blocks).integers(0, 256, blocks * 64, dtype=np.uint8).tobytes()
    assert jpeg.Picture(jpeg.encode(payload)).payload() == payload


def test_zigzag():
    assert jpeg.ZIGZAG[:10] == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24] and jpeg.ZIGZAG[-3:] == [55, 62, 63]


def test_flat_picture():
    media_ = grey(np.zeros((1, 64), dtype=int), {})
    assert jpeg.Picture(media_).rgb().tolist() == [[[128] * 3] * 8] * 8
    lit = np.zeros((1, 64), dtype=int)
    lit[0, 0] = 160
    assert (jpeg.Picture(grey(lit, {})).rgb() == 148).all()


def test_transform_against_its_formula():
    blocks = np.random.default_rng(3).integers(-40, 41, (1, 64))
    got = jpeg.Picture(grey(blocks, {})).rgb()[:, :, 0]
    plain = np.zeros((8, 8))
    plain.flat[jpeg.ZIGZAG] = blocks[0]
    c = lambda k: 0.5**0.5 if k == 0 else 1
    for y in range(8):
        for x in range(8):
            s = sum(c(u) * c(v) * plain[v, u] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) / 4
            assert abs(got[y, x] - min(255, max(0, s + 128))) <= 0.51


SYMBOLS = bytes([*range(0, 256)][:-1])  # 255 codes of eight bits: all ones stays free


def code(symbol):
    return f"{symbol:08b}"


def number(value, size):
    return f"{value if value > 0 else value + (1 << size) - 1:0{size}b}" if size else ""


def stuffed(text):
    text += "1" * (-len(text) % 8)
    return int(text or "1" * 8, 2).to_bytes(max(1, len(text) // 8), "big").replace(b"\xff", b"\xff\0")


def shifted(v, n):
    return (abs(v) >> n) * (1 if v > 0 else -1)


def ac_first(blocks, a, b, low):
    out = ""
    for block in blocks:
        zeros = 0
        for v in (shifted(int(x), low) for x in block[a : b + 1]):
            if not v:
                zeros += 1
                continue
            while zeros > 15:
                out, zeros = out + code(0xF0), zeros - 16
            size = abs(v).bit_length()
            out, zeros = out + code(zeros << 4 | size) + number(v, size), 0
        if zeros:
            out += code(0)
    return out


def ac_refine(blocks, a, b, low):
    out = ""
    for block in blocks:
        zeros, pending = 0, ""
        values = [shifted(int(x), low) for x in block[a : b + 1]]
        last = max([i for i, v in enumerate(values) if abs(v) == 1], default=-1)
        for i, v in enumerate(values):
            if abs(v) > 1:
                pending += str(abs(v) & 1)
            elif v == 0:
                zeros += 1
                if zeros == 16 and i < last:
                    out, zeros, pending = out + code(0xF0) + pending, 0, ""
            else:
                out, zeros, pending = out + code(zeros << 4 | 1) + ("1" if v > 0 else "0") + pending, 0, ""
        if zeros or pending:
            out += code(0) + pending
    return out


def grey(blocks, scans):
    """A grey picture, one row of blocks, coded plainly with end-of-block for each block; AC scans as (from, to): bits."""
    out = [b"\xff\xd8", jpeg._segment(0xFFDB, b"\0" + bytes([1] * 64)), jpeg._segment(0xFFC2, struct.pack(">BHHB", 8, 8, 8 * len(blocks), 1) + b"\1\x11\0")]
    for kind in (0x00, 0x10):
        out.append(jpeg._segment(0xFFC4, bytes([kind, 0, 0, 0, 0, 0, 0, 0, 255, *[0] * 8]) + SYMBOLS))
    text, before = "", 0
    for block in blocks:
        step = (int(block[0]) >> 1) - before
        before, size = int(block[0]) >> 1, abs(step).bit_length()
        text += code(size) + number(step, size)
    head = lambda a, b, approx: jpeg._segment(0xFFDA, bytes([1, 1, 0, a, b, approx]))
    out += [head(0, 0, 0x01), stuffed(text), head(0, 0, 0x10), stuffed("".join(str(int(x[0]) & 1) for x in blocks))]
    for (a, b), low in (scans or {(1, 63): 0}).items():
        out += [head(a, b, low), stuffed(ac_first(blocks, a, b, low))]
        for bit in range(low - 1, -1, -1):
            out += [head(a, b, (bit + 1) << 4 | bit), stuffed(ac_refine(blocks, a, b, bit))]
    return b"".join([*out, b"\xff\xd9"])


@pytest.mark.parametrize("seed", range(20))
def test_general_files(seed):
    rnd = random.Random(seed)
    blocks = np.array([[rnd.choice([0] * rnd.choice([1, 5, 60]) + [1, -1, 2, -3, 7, -90, 255]) for _ in range(64)] for _ in range(rnd.randint(1, 9))])
    scans = rnd.choice([{(1, 63): 0}, {(1, 5): 1, (6, 63): 2}, {(1, 63): 3}, {(1, 1): 0, (2, 40): 1, (41, 63): 1}])
    got = jpeg.Picture(grey(blocks, scans)).components[1]["blocks"][0]
    assert got.tolist() == blocks.tolist()


def test_query(spark, small):
    rows = {r.doc_id: r for r in media.op6_progressive_jpeg(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        text = (d.text or "").encode()
        payload, r = text + bytes(-len(text) % 64), rows[d.doc_id]
        payload = payload or bytes(64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "\x00é" * 50_000, None), (None, "a" * 64, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media string").withColumn("rgb", F.lit(1))
    got = media.read_media(media.store_media(docs)).collect()
    assert len(got) == 5 and all(len(r.rgb) == r.height * r.width * 3 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].payload == by_id[2].payload == bytes(64) and by_id[1].media == by_id[2].media
    assert by_id[3].payload.rstrip(b"\0") == rows[3][1].encode() and by_id[None].payload == b"a" * 64
    assert media.media_digests(media.store_media(docs.limit(0))).count() == 0


def plain_rgb(payload):
    """The picture of a payload by the formulas of the format, from the writer's stated layout and not from its files."""
    n = len(payload) // 64
    units = -(-n // 6)
    wide = int(np.ceil(np.sqrt(units)))
    high = -(-units // wide)
    coefficients = np.frombuffer(payload.ljust(6 * wide * high * 64, b"\0"), dtype=np.uint8).reshape(-1, 64).astype(int)
    coefficients = np.where(coefficients >= 128, coefficients, coefficients - 255)
    k, x = np.mgrid[0:8, 0:8]
    basis = np.where(k == 0, 0.5**0.5, 1) / 2 * np.cos((2 * x + 1) * k * np.pi / 16)

    def plane(blocks, per_row):
        out = np.zeros((len(blocks) // per_row * 8, per_row * 8))
        for i, block in enumerate(blocks):
            square = np.zeros(64)
            square[jpeg.ZIGZAG] = block
            out[i // per_row * 8 :, i % per_row * 8 :][:8, :8] = np.clip(np.round(basis.T @ square.reshape(8, 8) @ basis) + 128, 0, 255)
        return out

    many = 4 * wide * high
    y = plane(coefficients[:many], 2 * wide)
    blue, red = (np.kron(plane(part, wide), np.ones((2, 2))) - 128 for part in (coefficients[many : many + wide * high], coefficients[many + wide * high :]))
    return np.clip(np.round(np.stack([y + 1.402 * red, y - 0.344136 * blue - 0.714136 * red, y + 1.772 * blue], axis=2)), 0, 255)


def test_query_media_columns_against_formulas(spark, small):
    rows = {r.doc_id: r for r in media.op6_progressive_jpeg(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = media.store_media(docs.select("doc_id", "text")).select("doc_id", F.octet_length("media").alias("n"), F.sha2("media", 256).alias("sha"))
    assert all((rows[r.doc_id].media_bytes, rows[r.doc_id].media_sha256) == (r.n, r.sha) for r in kept.collect())
    short = docs.where("octet_length(text) < 3000").limit(60).collect()
    assert len(short) > 20
    for d in short:
        rgb = plain_rgb(media.padded(d.text.encode()))
        size, *means = rows[d.doc_id].feature.split()
        assert size == f"{rgb.shape[0]}x{rgb.shape[1]}"
        assert all(abs(float(m) - want) < 0.3 for m, want in zip(means, rgb.reshape(-1, 3).mean(axis=0)))
