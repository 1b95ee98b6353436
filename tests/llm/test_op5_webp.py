import random

import pytest

from quarrykit.llm import op5_webp as op
from quarrykit.llm.webp_write import encode


def image(rng, w, h, colours=None, smooth=False):
    if colours:
        table = [rng.getrandbits(32) for _ in range(colours)]
        return [rng.choice(table) for _ in range(w * h)]
    if smooth:
        return [255 << 24 | (x * 3 + rng.randrange(3)) % 256 << 16 | (y * 5) % 256 << 8 | (x + y) % 256 for y in range(h) for x in range(w)]
    return [rng.getrandbits(32) for _ in range(w * h)]


def blocks(w, h, bits):
    return ((w + (1 << bits) - 1) >> bits) * ((h + (1 << bits) - 1) >> bits)


@pytest.mark.parametrize("mode", range(16))
def test_each_predictor(mode):
    rng = random.Random(mode)
    for w, h in ((1, 1), (1, 9), (9, 1), (13, 7)):
        p = image(rng, w, h)
        assert op.decode(encode(p, w, h, [(op.PREDICT, 2, [mode] * blocks(w, h, 2))])) == (w, h, p)


@pytest.mark.parametrize("seed", range(25))
def test_round_trip(seed):
    rng = random.Random(seed)
    w, h = rng.choice([(1, 1), (5, 3), (17, 33), (64, 20), (40, 1)])
    p = image(rng, w, h, rng.choice([None, 1, 2, 3, 4, 9, 16, 17, 200]), rng.random() < 0.4)
    transforms, width = [], w
    if rng.random() < 0.5 and len(set(p)) <= 256:
        transforms.append((op.PALETTE,))
        n = len(set(p))
        packed = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
        width = (w + (1 << packed) - 1) >> packed
    rest = [(op.GREEN,)] if rng.random() < 0.5 else []
    bits = rng.randrange(2, 6)
    if rng.random() < 0.6:
        rest.append((op.PREDICT, bits, [rng.randrange(14) for _ in range(blocks(width, h, bits))]))
    if rng.random() < 0.6:
        rest.append((op.CROSS, bits, [rng.getrandbits(32) for _ in range(blocks(width, h, bits))]))
    rng.shuffle(rest)
    groups = (bits, [rng.randrange(5) for _ in range(blocks(width, h, bits))]) if rng.random() < 0.5 else None
    data = encode(p, w, h, transforms + rest, rng.choice([0, 1, 5, 11]), rng.random() < 0.6, groups)
    assert op.decode(data) == (w, h, p)


def test_a_known_file():
    """A one-pixel file written out by hand: signature, 1 x 1, no transforms, five one-symbol codes (opaque red)."""
    bits = [(0x2F, 8), (0, 14), (0, 14), (0, 1), (0, 3), (0, 1), (0, 1), (0, 1)]
    for symbol in (0, 255, 0, 255):
        bits += [(1, 1), (0, 1), (1, 1), (symbol, 8)]
    bits += [(1, 1), (0, 1), (0, 1), (0, 1)]
    value = at = 0
    for v, n in bits:
        value |= v << at
        at += n
    data = value.to_bytes((at + 7) // 8, "little")
    file = b"RIFF" + (12 + len(data)).to_bytes(4, "little") + b"WEBPVP8L" + len(data).to_bytes(4, "little") + data
    assert op.decode(file) == (1, 1, [0xFFFF0000])


def test_rows(spark):
    rng = random.Random(3)
    p = image(rng, 9, 4)
    good = encode(p, 9, 4, [(op.GREEN,)], 3, True)
    extra = good[:12] + b"EXIF" + (3).to_bytes(4, "little") + b"abc\0" + good[12:] + b"tail"
    bad = [b"", b"RIFF", b"x" * 100, good[: len(good) // 2], good[:20] + b"\0" + good[21:], good[:12] + b"VP8 " + good[16:]]
    bad += [good[:k] + bytes([good[k] ^ 0x5A]) + good[k + 1 :] for k in range(25, len(good), 7)]
    rows = [(0, None), (1, good), (1, good), (None, extra), *((10 + i, b) for i, b in enumerate(bad))]
    media = spark.createDataFrame([(i, bytearray(d) if d is not None else None, 5) for i, d in rows], "id long, data binary, width int")
    out = op.decode_media(media).collect()
    assert len(out) == len(rows)
    rgba = bytes(op.to_rgba(p))
    for r in out:
        if r.id == 0:
            assert r.pixels is None and r.error is None
        elif r.id in (1, None):
            assert (r.width, r.height, bytes(r.pixels), r.error) == (9, 4, rgba, None)
        else:
            assert (r.pixels is None) == (r.error is not None)
    assert all(r.error for r in out if r.id is not None and 10 <= r.id < 16)
    assert op.decode_media(media.limit(0)).count() == 0


def test_embeddings(spark):
    rows = [(i, [((i * 37 + k * 11) % 97) / 97 - 0.5 for k in range(64)]) for i in range(100)] + [(100, None)]
    made = op.decode_media(op.embedding_media(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))).collect()
    assert sum(r.error is not None for r in made) == 0 and sum(r.pixels is None for r in made) == 1


def test_more_pixels_than_two_to_the_26():
    p = [0xFF102030]
    data = bytearray(encode(p, 1, 1))
    at = data.index(b"VP8L") + 9  # after the signature: 14 bits of width - 1, 14 of height - 1
    size = int.from_bytes(data[at : at + 4], "little") | 8199 | 8199 << 14
    data[at : at + 4] = size.to_bytes(4, "little")
    width, height, pixels = op.decode_compact(bytes(data))
    assert (width, height, len(pixels)) == (8200, 8200, 8200 * 8200) and pixels[0] == pixels[-1] == p[0]
    rgba = op.to_rgba(pixels)
    assert len(rgba) == 4 * len(pixels) and rgba[:4] == rgba[-4:] == bytes([0x10, 0x20, 0x30, 0xFF])


def test_strips_and_batches_do_not_change_results(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    cases = []
    for w, h, colours in ((33, 17, None), (40, 9, 3), (21, 30, 200)):
        p = image(rng, w, h, colours)
        rest = [(op.PALETTE,)] if colours else [(op.GREEN,), (op.CROSS, 2, [rng.getrandbits(32) for _ in range(blocks(w, h, 2))])]
        cases.append((encode(p, w, h, rest), w, h, p))
    monkeypatch.setattr(op, "STRIP", 50)
    monkeypatch.setattr(op, "MOST_HELD", 2000)
    datas = [c[0] for c in cases] + [None, b"x"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(datas, pa.binary())], names=["id", "data"])
    got = pa.Table.from_batches(op._decoded([batch])).to_pylist()
    assert [r["id"] for r in got] == list(range(5)) and got[3]["error"] is None and got[4]["error"]
    for r, (_, w, h, p) in zip(got, cases):
        assert (r["width"], r["height"]) == (w, h) and r["pixels"] == bytes(v for x in p for v in (x >> 16 & 255, x >> 8 & 255, x & 255, x >> 24))
