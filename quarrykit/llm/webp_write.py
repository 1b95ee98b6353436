"""A lossless WebP writer, which makes media columns to decode where the tables have none.

It picks nothing by itself: transforms, colour cache, back-references and groups of
prefix codes are arguments, so that a test can ask for any of them.
"""

from __future__ import annotations

import heapq
import struct

from quarrykit.llm.op5_webp import CACHE_HASH, CROSS, GREEN, LENGTH_ORDER, NEAR, PALETTE, PREDICT, predict


class _Writer:
    def __init__(self):
        self.held, self.have = 0, 0

    def put(self, value: int, n: int) -> None:
        self.held |= value << self.have
        self.have += n

    def bytes(self) -> bytes:
        return self.held.to_bytes((self.have + 7) // 8, "little")


def _subtract(a: int, b: int) -> int:
    return ((a | 0x00FF00FF) - (b & 0xFF00FF00)) & 0xFF00FF00 | ((a | 0xFF00FF00) - (b & 0x00FF00FF)) & 0x00FF00FF


def _lengths(counts: list[int], most: int) -> list[int]:
    """Huffman code lengths of at most ``most`` bits."""
    used = [s for s, c in enumerate(counts) if c]
    out = [0] * len(counts)
    if len(used) == 1:
        out[used[0]] = 1
        return out
    weights = {s: counts[s] for s in used}
    while True:
        heap = [(w, s, (s,)) for s, w in weights.items()]
        heapq.heapify(heap)
        depth = dict.fromkeys(used, 0)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(depth.values()) <= most:
            for s, d in depth.items():
                out[s] = d
            return out
        weights = {s: w // 2 + 1 for s, w in weights.items()}


def _codes(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """symbol -> (bits as they are sent, how many)."""
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    if len(used) == 1:
        return {used[0][1]: (0, 0)}
    made, code, last = {}, 0, used[0][0] if used else 0
    for n, s in used:
        code <<= n - last
        last = n
        made[s] = int(format(code, f"0{n}b")[::-1], 2), n
        code += 1
    return made


def _put_code(w: _Writer, counts: list[int]) -> dict[int, tuple[int, int]]:
    used = [s for s, c in enumerate(counts) if c]
    if not used:
        w.put(1, 4)  # simple, one symbol of one bit, 0
        return {}
    if len(used) <= 2 and used[-1] < 256:
        w.put(1, 1)
        w.put(len(used) - 1, 1)
        wide = used[0] > 1
        w.put(wide, 1)
        w.put(used[0], 8 if wide else 1)
        if len(used) == 2:
            w.put(used[1], 8)
        return _codes([int(s in used) for s in range(len(counts))])
    lengths = _lengths(counts, 15)
    tokens, i, before = [], 0, 8
    while i < len(lengths):
        n = lengths[i]
        j = i
        while j < len(lengths) and lengths[j] == n:
            j += 1
        run = j - i
        if n == 0 and run >= 3:
            k = min(run, 138)
            tokens.append((18, k - 11, 7) if k >= 11 else (17, k - 3, 3))
        elif n and n == before and run >= 3:
            k = min(run, 6)
            tokens.append((16, k - 3, 2))
        else:
            k = 1
            tokens.append((n, 0, 0))
            before = n or before
        i += k
    trimmed = list(tokens)
    while trimmed and trimmed[-1][0] in (0, 17, 18):
        trimmed.pop()
    short = 2 <= len(trimmed) < len(tokens)
    tokens = trimmed if short else tokens
    first = [0] * 19
    for s, _, _ in tokens:
        first[s] += 1
    first = _lengths(first, 7)
    n = max(4, max(i + 1 for i, s in enumerate(LENGTH_ORDER) if first[s]))
    w.put(0, 1)
    w.put(n - 4, 4)
    for s in LENGTH_ORDER[:n]:
        w.put(first[s], 3)
    w.put(short, 1)
    if short:
        k = max(0, (max(2, (len(tokens) - 2).bit_length()) - 1) // 2)
        w.put(k, 3)
        w.put(len(tokens) - 2, 2 + 2 * k)
    code = _codes(first)
    for s, extra, bits in tokens:
        w.put(*code[s])
        w.put(extra, bits)
    return _codes(lengths)


def _prefix(v: int) -> tuple[int, int, int]:
    """(symbol, extra bits, how many) of a length or distance."""
    n = v - 1
    if n < 4:
        return n, 0, 0
    high = n.bit_length() - 1
    return 2 * high + (n >> (high - 1) & 1), n & ((1 << (high - 1)) - 1), high - 1


def _put_image(w: _Writer, pixels: list[int], width: int, main: bool, cache_bits: int = 0, copies: bool = False, groups: tuple[int, list[int]] | None = None) -> None:
    w.put(bool(cache_bits), 1)
    if cache_bits:
        w.put(cache_bits, 4)
    bits, across, of = 0, 0, None
    if main:
        w.put(groups is not None, 1)
        if groups:
            bits, of = groups
            across = (width + (1 << bits) - 1) >> bits
            w.put(bits - 2, 3)
            _put_image(w, [g << 8 for g in of], across, False)
    near = {}
    for i, (dx, dy) in enumerate(NEAR):
        near.setdefault(max(1, dx + dy * width), i + 1)
    cache, seen, tokens, i = {}, {}, [], 0
    n_groups = max(of) + 1 if of else 1
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    counts = [[[0] * n for n in sizes] for _ in range(n_groups)]

    def remember(k):
        p = pixels[k]
        if cache_bits:
            cache[(CACHE_HASH * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
        if k >= 1:
            seen[pixels[k - 1], p] = k - 1

    while i < len(pixels):
        g = of[(i // width >> bits) * across + (i % width >> bits)] if of else 0
        c = counts[g]
        p = pixels[i]
        n = 0
        if copies and i + 1 < len(pixels) and (p, pixels[i + 1]) in seen:
            at = seen[p, pixels[i + 1]]
            while i + n < len(pixels) and n < 4096 and pixels[at + n] == pixels[i + n]:
                n += 1
        place = (CACHE_HASH * p & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else 0
        if n >= 3:
            d = i - at
            a, b = _prefix(n), _prefix(near.get(d, d + 120))
            tokens.append((g, [(0, 256 + a[0]), a[1:], (4, b[0]), b[1:]]))
            c[0][256 + a[0]] += 1
            c[4][b[0]] += 1
        elif cache_bits and cache.get(place) == p:
            n = 1
            tokens.append((g, [(0, 280 + place)]))
            c[0][280 + place] += 1
        else:
            n = 1
            channels = (p >> 8 & 255, p >> 16 & 255, p & 255, p >> 24)
            tokens.append((g, list(enumerate(channels))))
            for k, v in enumerate(channels):
                c[k][v] += 1
        for k in range(i, i + n):
            remember(k)
        i += n
    codes = [[_put_code(w, c) for c in group] for group in counts]
    for g, parts in tokens:
        if len(parts) == 4 and parts[2][0] == 4 and parts[0][1] >= 256:
            w.put(*codes[g][0][parts[0][1]])
            w.put(*parts[1])
            w.put(*codes[g][4][parts[2][1]])
            w.put(*parts[3])
        else:
            for k, v in parts:
                w.put(*codes[g][k][v])


def _signed(v: int) -> int:
    v &= 255
    return v - 256 if v > 127 else v


def encode(pixels: list[int], width: int, height: int, transforms=(), cache_bits: int = 0, copies: bool = False, groups: tuple[int, list[int]] | None = None) -> bytes:
    """A lossless WebP file. ``transforms``, in their order: (PREDICT, bits, modes), (CROSS, bits, table), (GREEN,), (PALETTE,)."""
    w = _Writer()
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(any(p >> 24 != 255 for p in pixels), 1)
    w.put(0, 3)
    p, now = list(pixels), width
    for kind, *more in transforms:
        w.put(1, 1)
        w.put(kind, 2)
        if kind == PREDICT:
            bits, modes = more
            across = (now + (1 << bits) - 1) >> bits
            w.put(bits - 2, 3)
            _put_image(w, [m << 8 for m in modes], across, False)
            out = []
            for i, v in enumerate(p):
                y, x = divmod(i, now)
                if i == 0:
                    guess = 0xFF000000
                elif y == 0:
                    guess = p[i - 1]
                elif x == 0:
                    guess = p[i - now]
                else:
                    guess = predict(modes[(y >> bits) * across + (x >> bits)], p[i - 1], p[i - now], p[i - now - 1], p[i - now + 1])
                out.append(_subtract(v, guess))
            p = out
        elif kind == CROSS:
            bits, table = more
            across = (now + (1 << bits) - 1) >> bits
            w.put(bits - 2, 3)
            _put_image(w, table, across, False)
            out = []
            for i, v in enumerate(p):
                y, x = divmod(i, now)
                t = table[(y >> bits) * across + (x >> bits)]
                g, r = _signed(v >> 8), v >> 16 & 255
                red = r - (_signed(t) * g >> 5) & 255
                blue = (v & 255) - (_signed(t >> 8) * g >> 5) - (_signed(t >> 16) * _signed(r) >> 5) & 255
                out.append(v & 0xFF00FF00 | red << 16 | blue)
            p = out
        elif kind == GREEN:
            p = [v & 0xFF00FF00 | ((v >> 16) - (v >> 8) & 255) << 16 | (v - (v >> 8) & 255) for v in p]
        else:
            colours = sorted(set(p))
            w.put(len(colours) - 1, 8)
            _put_image(w, [colours[0]] + [_subtract(b, a) for a, b in zip(colours, colours[1:])], len(colours), False)
            packed = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
            place = {c: i for i, c in enumerate(colours)}
            each, out = 8 >> packed, []
            for y in range(height):
                row = [place[v] for v in p[y * now : (y + 1) * now]]
                for x in range(0, now, 1 << packed):
                    out.append(0xFF000000 | sum(v << (k * each) for k, v in enumerate(row[x : x + (1 << packed)])) << 8)
            p, now = out, (now + (1 << packed) - 1) >> packed
    w.put(0, 1)
    _put_image(w, p, now, True, cache_bits, copies, groups)
    data = w.bytes()
    chunk = b"VP8L" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk




def embedding_image(vec_id: int, values: list[float]) -> bytes:
    """64 numbers as 8 x 8 pixels; vec_id turns the transforms over."""
    levels = [int(min(255.0, max(0.0, v * 512 + 128))) for v in values]
    pixels = [255 << 24 | q << 16 | (q // 2 + i) % 256 << 8 | (255 - q) for i, q in enumerate(levels, 1)]
    kind = vec_id % 6
    modes = [(vec_id // 6 + k) % 14 for k in range(4)]
    cross = [255 << 24 | (vec_id * 7 + k) % 256 << 16 | (vec_id * 3) % 256 << 8 | (vec_id + 11 * k) % 256 for k in range(4)]
    if kind == 0:
        return encode(pixels, 8, 8)
    if kind == 1:
        return encode(pixels, 8, 8, [(GREEN,), (PREDICT, 2, modes)])
    if kind == 2:
        return encode(pixels, 8, 8, [(CROSS, 2, cross), (GREEN,)], cache_bits=4)
    if kind == 3:
        return encode(pixels, 8, 8, [(PREDICT, 2, modes), (CROSS, 2, cross), (GREEN,)], copies=True)
    if kind == 4:
        return encode(pixels, 8, 8, [(PALETTE,)], copies=True)
    return encode(pixels, 8, 8, [(PREDICT, 2, modes)], cache_bits=6, copies=True, groups=(2, [0, 1, 2, 1]))
