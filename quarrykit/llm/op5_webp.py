"""Media columns: lossless WebP to pixel arrays.

A VP8L stream is read bit by bit, least significant first: transforms, colour
cache size, meta prefix codes, then one symbol after another: a literal pixel, a
back-reference (with the two-dimensional short distances), or a place in the
colour cache. The transforms are then undone in reverse order: palette (with
packed pixels), green subtraction, cross-colour, and the fourteen predictors.

Pixels are numbers 0xAARRGGBB. The column that is written has them as
bytes R, G, B, A, row by row.

Defined results: null bytes give nulls and no error. Bytes that are no
lossless WebP, are cut short, or break the format give null pixels and say why
in ``error``; no row fails the job. Extra chunks are skipped; trailing bytes are ignored.
Images may have all the pixels that the format can state, 2^28. Repeated rows repeat; other columns are not looked at.

The public tables hold no images. ``op5_webp`` makes one of each embedding,
8 x 8 pixels, by the encoder in ``webp_write`` with transforms that change with vec_id, and decodes the
whole column; its SQL gives the pixels from the embeddings.
"""

from __future__ import annotations

import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pixels that are turned to bytes at once.
STRIP = 1 << 20
#: Bytes of pixels in a batch of several images.
MOST_HELD = 1 << 26
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: (x, y) of the 120 short distances.
NEAR = [(0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1), (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7)]
PREDICT, CROSS, GREEN, PALETTE = 0, 1, 2, 3
CACHE_HASH = 0x1E35A7BD
_PRIMARY = 9


class BadImage(ValueError):
    pass


class _Bits:
    """A bit reader; ``have`` bits wait in ``held``."""

    def __init__(self, data: bytes):
        self.data, self.at, self.held, self.have = data, 0, 0, 0

    def fill(self) -> None:
        more = self.data[self.at : self.at + 32]
        self.held |= int.from_bytes(more, "little") << self.have
        self.have += 8 * len(more)
        self.at += len(more)

    def read(self, n: int) -> int:
        if self.have < n:
            self.fill()
            if self.have < n:
                raise BadImage("the data ends early")
        v = self.held & ((1 << n) - 1)
        self.held >>= n
        self.have -= n
        return v


class _Code:
    """A canonical prefix code: a table over the next bits, and longer codes by (length, bits)."""

    def __init__(self, lengths: list[int]):
        used = [(n, s) for s, n in enumerate(lengths) if n]
        if not used:
            raise BadImage("a prefix code without symbols")
        if len(used) == 1:
            self.bits, self.table, self.long = 0, [(used[0][1], 0)], {}
            return
        used.sort()
        most = used[-1][0]
        if sum(1 << (most - n) for n, _ in used) != 1 << most:
            raise BadImage("a prefix code that is not complete")
        self.bits = min(most, _PRIMARY)
        self.table = [None] * (1 << self.bits)
        self.long = {}
        self.most = most
        code, last = 0, used[0][0]
        for n, s in used:
            code <<= n - last
            last = n
            back = int(format(code, f"0{n}b")[::-1], 2)
            if n <= self.bits:
                self.table[back :: 1 << n] = [(s, n)] * (1 << (self.bits - n))
            else:
                self.long[n, back] = s
            code += 1

    def read(self, r: _Bits) -> int:
        if r.have < 15:
            r.fill()
        hit = self.table[r.held & ((1 << self.bits) - 1)]
        if hit is None:
            for n in range(self.bits + 1, self.most + 1):
                s = self.long.get((n, r.held & ((1 << n) - 1)))
                if s is not None:
                    hit = s, n
                    break
        s, n = hit
        if n > r.have:
            raise BadImage("the data ends early")
        r.held >>= n
        r.have -= n
        return s


def _read_code(r: _Bits, size: int) -> _Code:
    lengths = [0] * size
    if r.read(1):
        two, wide = r.read(1), r.read(1)
        symbols = [r.read(8 if wide else 1)] + ([r.read(8)] if two else [])
        for s in symbols:
            if s >= size:
                raise BadImage("a symbol outside its alphabet")
            lengths[s] = 1
        return _Code(lengths)
    first = [0] * 19
    for i in range(4 + r.read(4)):
        first[LENGTH_ORDER[i]] = r.read(3)
    code = _Code(first)
    tokens = 2 + r.read(2 + 2 * r.read(3)) if r.read(1) else size
    if tokens > size:
        raise BadImage("more code lengths than symbols")
    at, before = 0, 8
    while at < size and tokens:
        tokens -= 1
        s = code.read(r)
        if s < 16:
            lengths[at] = s
            at += 1
            before = s or before
            continue
        n, value = (3 + r.read(2), before) if s == 16 else (3 + r.read(3), 0) if s == 17 else (11 + r.read(7), 0)
        if at + n > size:
            raise BadImage("code lengths beyond the alphabet")
        lengths[at : at + n] = [value] * n
        at += n
    return _Code(lengths)


def _number(r: _Bits, s: int) -> int:
    """The length or distance that a prefix symbol and its extra bits stand for."""
    if s < 4:
        return s + 1
    extra = (s - 2) >> 1
    return ((2 + (s & 1)) << extra) + r.read(extra) + 1


def _image(r: _Bits, width: int, height: int, main: bool) -> array:
    """An entropy-coded image; only the main one may have meta prefix codes."""
    cache_bits = r.read(4) if r.read(1) else 0
    if cache_bits > 11:
        raise BadImage("the colour cache is too large")
    groups, meta, meta_bits, across = 1, None, 0, 0
    if main and r.read(1):
        meta_bits = r.read(3) + 2
        across = (width + (1 << meta_bits) - 1) >> meta_bits
        meta = array("H", ((p >> 8) & 0xFFFF for p in _image(r, across, (height + (1 << meta_bits) - 1) >> meta_bits, False)))
        groups = max(meta) + 1
    cache = [0] * (1 << cache_bits) if cache_bits else None
    shift = 32 - cache_bits
    sizes = (280 + (len(cache) if cache else 0), 256, 256, 256, 40)
    codes = [[_read_code(r, n) for n in sizes] for _ in range(groups)]
    total = width * height
    out = array("I")
    cached = 0  # pixels that are in the cache
    green, red, blue, alpha, dist = codes[0]
    if meta is None and not (green.bits or red.bits or blue.bits or alpha.bits) and green.table[0][0] < 256:
        # no pixel takes a bit
        return array("I", [alpha.read(r) << 24 | red.read(r) << 16 | green.read(r) << 8 | blue.read(r)]) * total
    y, x = 0, 0
    while len(out) < total:
        if meta is not None:
            y, x = divmod(len(out), width)
            green, red, blue, alpha, dist = codes[meta[(y >> meta_bits) * across + (x >> meta_bits)]]
        s = green.read(r)
        if s < 256:
            rd, bl = red.read(r), blue.read(r)
            out.append(alpha.read(r) << 24 | rd << 16 | s << 8 | bl)
        elif s < 280:
            n = _number(r, s - 256)
            d = _number(r, dist.read(r))
            if d > 120:
                d -= 120
            else:
                dx, dy = NEAR[d - 1]
                d = max(1, dx + dy * width)
            if d > len(out) or len(out) + n > total:
                raise BadImage("a back-reference outside the image")
            if d >= n:
                out += out[len(out) - d : len(out) - d + n]
            else:
                out += (out[-d:] * (n // d + 1))[:n]
        else:
            if cache is None:
                raise BadImage("a cache symbol without a cache")
            for p in out[cached:]:
                cache[(CACHE_HASH * p & 0xFFFFFFFF) >> shift] = p
            cached = len(out)
            out.append(cache[s - 280])
    return out


def _average(a: int, b: int) -> int:
    return (((a ^ b) & 0xFEFEFEFE) >> 1) + (a & b)


def _add(a: int, b: int) -> int:
    return ((a & 0xFF00FF00) + (b & 0xFF00FF00)) & 0xFF00FF00 | ((a & 0x00FF00FF) + (b & 0x00FF00FF)) & 0x00FF00FF


def _bytes(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _pack(v) -> int:
    a, r, g, b = (0 if x < 0 else 255 if x > 255 else x for x in v)
    return a << 24 | r << 16 | g << 8 | b


def _select(left: int, top: int, corner: int) -> int:
    by_left = by_top = 0
    for a, b, c in zip(_bytes(left), _bytes(top), _bytes(corner)):
        by_left += abs(b - c)
        by_top += abs(a - c)
    return left if by_left < by_top else top


def _half(v: int) -> int:
    return v // 2 if v >= 0 else -(-v // 2)


def predict(mode: int, left: int, top: int, corner: int, right: int) -> int:
    """The predicted pixel from its neighbours: left, above, above left, above right."""
    if mode == 1:
        return left
    if mode == 2:
        return top
    if mode == 3:
        return right
    if mode == 4:
        return corner
    if mode == 5:
        return _average(_average(left, right), top)
    if mode == 6:
        return _average(left, corner)
    if mode == 7:
        return _average(left, top)
    if mode == 8:
        return _average(corner, top)
    if mode == 9:
        return _average(top, right)
    if mode == 10:
        return _average(_average(left, corner), _average(top, right))
    if mode == 11:
        return _select(left, top, corner)
    if mode == 12:
        return _pack(a + b - c for a, b, c in zip(_bytes(left), _bytes(top), _bytes(corner)))
    if mode == 13:
        return _pack(a + _half(a - c) for a, c in zip(_bytes(_average(left, top)), _bytes(corner)))
    return 0xFF000000


def _unpredict(p: array, width: int, height: int, bits: int, modes: bytes) -> array:
    across = (width + (1 << bits) - 1) >> bits
    p[0] = _add(p[0], 0xFF000000)
    for x in range(1, width):
        p[x] = _add(p[x], p[x - 1])
    for y in range(1, height):
        at = y * width
        p[at] = _add(p[at], p[at - width])
        row = (y >> bits) * across
        for x in range(1, width):
            i = at + x
            # above right of the last column is the first pixel of this row, as in memory
            p[i] = _add(p[i], predict(modes[row + (x >> bits)], p[i - 1], p[i - width], p[i - width - 1], p[i - width + 1]))
    return p


def _signed(v: np.ndarray) -> np.ndarray:
    return v.astype(np.uint8).view(np.int8).astype(np.int32)


def _strips(p: array, width: int):
    """(first row, rows) of views of ``p`` with at most ``STRIP`` pixels, or one row."""
    px, step = np.frombuffer(p, np.uint32).reshape(-1, width), max(1, STRIP // width)
    for y in range(0, len(px), step):
        yield y, px[y : y + step]


def _uncross(p: array, width: int, height: int, bits: int, table: array) -> array:
    across = (width + (1 << bits) - 1) >> bits
    blocks = np.frombuffer(table, np.uint32).reshape(-1, across)
    for y, px in _strips(p, width):
        t = blocks[np.arange(y, y + len(px)) >> bits].repeat(1 << bits, axis=1)[:, :width]
        green = _signed(px >> 8 & 255)
        red = (px >> 16 & 255).astype(np.int32) + ((_signed(t & 255) * green) >> 5) & 255
        blue = (px & 255).astype(np.int32) + ((_signed(t >> 8 & 255) * green) >> 5) + ((_signed(t >> 16 & 255) * _signed(red)) >> 5) & 255
        px[:] = px & np.uint32(0xFF00FF00) | red.astype(np.uint32) << 16 | blue.astype(np.uint32)
    return p


def _ungreen(p: array, width: int) -> array:
    for _, px in _strips(p, width):
        green = px >> 8 & 255
        px[:] = px & np.uint32(0xFF00FF00) | ((px >> 16) + green & 255) << 16 | px + green & 255
    return p


def _unpalette(p: array, width: int, height: int, packed: int, table: array) -> array:
    """``packed``: log2 of the pixels in one."""
    narrow, bits = (width + (1 << packed) - 1) >> packed, 8 >> packed
    full = np.zeros(256, np.uint32)
    full[: len(table)] = table
    out = array("I", [0]) * (width * height) if packed else p
    wide = np.frombuffer(out, np.uint32).reshape(height, width)
    for y, px in _strips(p, narrow):
        index = px >> 8 & 255
        if packed:
            index = np.stack([index >> k * bits & (1 << bits) - 1 for k in range(1 << packed)], axis=2).reshape(len(px), -1)[:, :width]
        wide[y : y + len(px)] = full[index]
    return out


def _lossless_chunk(data: bytes) -> bytes:
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise BadImage("not a WebP file")
    at = 12
    while at + 8 <= len(data):
        name, n = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"VP8L":
            if at + 8 + n > len(data):
                raise BadImage("the data ends early")
            return data[at + 8 : at + 8 + n]
        if name == b"VP8 ":
            raise BadImage("a lossy image")
        at += 8 + n + (n & 1)
    raise BadImage("no lossless image")


def decode(data: bytes) -> tuple[int, int, list[int]]:
    """(width, height, pixels) of a lossless WebP file."""
    width, height, pixels = decode_compact(data)
    return width, height, pixels.tolist()


def decode_compact(data: bytes) -> tuple[int, int, array]:
    """``decode`` with four bytes for a pixel."""
    r = _Bits(_lossless_chunk(data))
    if r.read(8) != 0x2F:
        raise BadImage("no lossless signature")
    width, height = r.read(14) + 1, r.read(14) + 1
    r.read(1)
    if r.read(3):
        raise BadImage("an unknown version")
    undo, seen, now = [], set(), width
    while r.read(1):
        kind = r.read(2)
        if kind in seen:
            raise BadImage("a transform twice")
        seen.add(kind)
        if kind in (PREDICT, CROSS):
            bits = r.read(3) + 2
            size = 1 << bits
            table = _image(r, (now + size - 1) >> bits, (height + size - 1) >> bits, False)
            if kind == PREDICT:
                table = bytes(v >> 8 & 15 for v in table)
            undo.append((_unpredict if kind == PREDICT else _uncross, now, bits, table))
        elif kind == GREEN:
            undo.append((_ungreen, now, 0, None))
        else:
            n = r.read(8) + 1
            table = _image(r, n, 1, False)
            for i in range(1, n):
                table[i] = _add(table[i], table[i - 1])
            packed = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append((_unpalette, now, packed, table))
            now = (now + (1 << packed) - 1) >> packed
    pixels = _image(r, now, height, True)
    for f, w, bits, table in reversed(undo):
        pixels = f(pixels, w) if f is _ungreen else f(pixels, w, height, bits, table)
    return width, height, pixels


def to_rgba(pixels) -> bytes:
    return b"".join(_rgba(np.array(pixels[at : at + STRIP], np.uint32)) for at in range(0, len(pixels), STRIP))


def _rgba(px: np.ndarray) -> bytes:
    return np.stack([px >> 16, px >> 8, px, px >> 24], axis=1).astype(np.uint8).tobytes()


def _decoded(batches):
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            rows, held, start = [], 0, 0
            for k, data in enumerate(part.column(1)):
                got = (None, None, None, None)
                if (data := data.as_py()) is not None:
                    try:
                        width, height, pixels = decode_compact(data)
                        got = width, height, to_rgba(pixels), None
                    except BadImage as bad:
                        got = None, None, None, str(bad)
                if held and held + len(got[2] or b"") > MOST_HELD:
                    yield _batch(part.column(0).slice(start, len(rows)), rows)
                    rows, held, start = [], 0, k
                rows.append(got)
                held += len(got[2] or b"")
            yield _batch(part.column(0).slice(start, len(rows)), rows)


def _batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    w, h, px, err = zip(*rows)
    return pa.RecordBatch.from_arrays([ids, pa.array(w, pa.int32()), pa.array(h, pa.int32()), pa.array(px, pa.binary()), pa.array(err, pa.string())], names=["id", "width", "height", "pixels", "error"])


def decode_media(media: DataFrame, id_col: str = "id", data_col: str = "data") -> DataFrame:
    """(id, width, height, pixels, error) for every row; ``pixels`` are R, G, B, A bytes, row by row."""
    schema = T.StructType([T.StructField("id", media.schema[id_col].dataType), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("pixels", T.BinaryType()), T.StructField("error", T.StringType())])
    return media.select(F.col(id_col).alias("id"), F.col(data_col).cast("binary").alias("data")).mapInArrow(_decoded, schema)


def embedding_media(embeddings: DataFrame) -> DataFrame:
    """(id, data): each embedding as a lossless WebP of 8 x 8 pixels, a level for each number."""

    def run(batches):
        from quarrykit.llm.webp_write import embedding_image

        for b in batches:
            data = [None if v is None else embedding_image(i, v) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=["id", "data"])

    return embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "id long, data binary")


def op5_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = decode_media(embedding_media(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return made.select(F.col("id").alias("vec_id"), "width", "height", F.hex("pixels").alias("pixels"), "error")


_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(least(255.0, greatest(0.0, CAST(x AS DOUBLE) * 512 + 128))) AS INTEGER)) AS q FROM embeddings)
SELECT vec_id, CAST(8 AS INTEGER) AS width, CAST(8 AS INTEGER) AS height,
  array_to_string(list_transform(range(1, 65), lambda i: printf('%02X%02X%02XFF', q[i], (q[i] // 2 + i) % 256, 255 - q[i])), '') AS pixels,
  CAST(NULL AS VARCHAR) AS error FROM v
"""

QUERIES = {"op5_webp": op5_webp}
ORACLE = {"op5_webp": _SQL}
