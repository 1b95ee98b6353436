"""Secret scans by a linear-chain conditional random field.

A text is its runs of non-whitespace (ASCII whitespace). Each is tagged B
(a secret begins), I (it goes on) or O. The score of a tag sequence is the sum
of learned weights for each token's shape features, the features of the two
words before it and the one after, three features of the whole text (its
length, its shares of tokens with digits and of tokens with symbols), and for
each pair of neighbouring tags. Viterbi decoding gives the best sequence.

Decoding is exact but mostly skipped: where O leads both other tags at a
position by more than any two transitions could make up, every best sequence
has O there. Those tests are array operations; the steps of Viterbi run over
what is left between such positions.

Fitting. The tables label no secrets, so the field is trained on sequences
made here: windows of at most ``SAMPLE`` texts of the corpus (those with the
least digest of their doc_id; a documented bound), into which secrets of many
formats and contexts, and things that only look like secrets (checksums,
commit ids, card and phone numbers, addresses), are put at known places.
Windows that already hold long runs of mixed letters and digits are not used.

Defined results: a null or empty text has no secret. An I that follows an O
begins a secret. Spans are code-point offsets, half open, without the quotes
and punctuation around the token and without a ``key=`` before it. Repeated
rows repeat. Other columns are not looked at by the scan and kept by the
redaction, which replaces each span by ``<secret>``.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrykit.llm.sampling import least_digests
from quarrykit.llm.words import trimmed

SAMPLE, SEQUENCES, LENGTH, STEPS, RIDGE = 300, 3000, 28, 160, 2e-4
B, I, O = 0, 1, 2
MARK = "<secret>"
REMEMBERED = 400_000
_EDGES = re.compile(r"""^[\s"'`(\[{<|]*(.*?)["'`)\]}>.,;:!?#$%&*|]*$""", re.S)
_KEYED = re.compile(r"""^["']?([A-Za-z_][\w.-]+)["']?(?:=|:)(?!//)["']?(.+)$""", re.S)
_TOKEN = re.compile(rb"[^ \t\n\r\x0b\x0c]+")
_WORDS = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_LENGTHS = (0, 4, 8, 12, 16, 20, 32, 40, 64)


def _size(n: int) -> int:
    return sum(n >= k for k in _LENGTHS)


def parts(token: str) -> tuple[str, str]:
    """(key, value) of a token without the punctuation around it; the key is empty unless the token is ``key=value`` or ``key:value``."""
    core = _EDGES.match(token).group(1)
    m = _KEYED.match(core)
    return (m.group(1), _EDGES.match(m.group(2)).group(1)) if m else ("", core)


def _class(v: str) -> str:
    if not v:
        return "none"
    if not v.isascii():
        return "wide"
    digit, alpha = any(c.isdigit() for c in v), any(c.isalpha() for c in v)
    plain = v.isalnum()
    if plain and not digit:
        return "lower" if v.islower() else "upper" if v.isupper() else "title" if v[1:].islower() else "mixed"
    if plain and not alpha:
        return "digits"
    if plain:
        return "hex" if all(c in string.hexdigits for c in v) and (v == v.lower() or v == v.upper()) else "alnum"
    if all(c.isalnum() or c in "+/_-=." for c in v):
        return "base" if digit and alpha else "joined"
    return "marks+" if digit and alpha else "marks"


def features(token: str, known: frozenset[str] | None = None) -> tuple[str, ...]:
    """Shape and identity features of a token; with ``known``, identities only of words in it."""
    key, v = parts(token)
    kind, n = _class(v), _size(len(v))
    found = [f"c={kind}", f"n={n}", f"cn={kind}{n}"]
    if kind not in ("lower", "title", "upper", "wide", "none", "digits"):
        switch = sum(a.isdigit() != b.isdigit() for a, b in zip(v, v[1:]))
        found.append(f"s={min(4, (switch + 1) // 3)}")
        found.append(f"rate={min(4, 10 * switch // len(v))}")
        found.append(f"set={min(4, len(set(v)) // 6)}")
        if n >= 4:
            found.append(f"p={v[:4]}")
            found.append(f"p3={v[:3]}")
        for c, name in (("@", "at"), ("://", "url"), ("/", "slash"), ("-----", "fence")):
            if c in token:
                found.append(name)
        if v.count(".") >= 3 or v.count("-") == 4:
            found.append("parted")
    if token[:1] in "\"'`":
        found.append("quote")
    if key:
        found.append("keyed")
        if known is None or key.lower() in known:
            found.append(f"k={key.lower()}")
    elif token[-1:] in "=:":
        found.append("opens")
    word = (v or token).lower()
    if len(word) <= 16 and (known is None or word in known):
        found.append(f"w={word}")
    return tuple(found)


# --- made training sequences -------------------------------------------------------------

_KEYS = ["token", "secret", "api_key", "apikey", "api-key", "access_token", "auth_token", "password", "passwd", "pwd", "secret_key", "client_secret", "private_key", "aws_secret_access_key", "access_key", "credential", "bearer", "auth"]
_OTHER = ["commit", "sha256", "sha1", "md5", "checksum", "digest", "etag", "revision", "hash", "uuid", "id", "version", "build", "order", "isbn", "card", "phone", "ref"]
_JUNK = ["", "", "", "", ".", ",", "!!", "###", "%%%", "&&&", "***", "$$$", ";"]


def _random(rng, letters, lo, hi=None):
    return "".join(rng.choice(letters) for _ in range(rng.randint(lo, hi or lo)))


def _value(rng: random.Random) -> tuple[str, bool]:
    """(a secret, whether it shows what it is without a key before it)."""
    an, hx = string.ascii_letters + string.digits, "0123456789abcdef"
    kind = rng.randrange(12)
    if kind < 4:
        v = _random(rng, hx, rng.choice([16, 18, 20, 24, 32, 40, 40, 40, 64]))
        return (v.upper() if rng.random() < 0.15 else v), False
    if kind < 6:
        return _random(rng, an, 20, 48), False
    if kind == 6:
        return "AKIA" + _random(rng, string.ascii_uppercase + string.digits, 16), True
    if kind == 7:
        return rng.choice(["ghp_", "gho_", "sk_live_", "sk-", "glpat-", "xoxb-", "npm_"]) + _random(rng, an, 24, 40), True
    if kind == 8:
        return "AIza" + _random(rng, an + "-_", 35), True
    if kind == 9:
        return ".".join(["eyJ" + _random(rng, an, 16, 30), "eyJ" + _random(rng, an, 20, 60), _random(rng, an + "-_", 30, 43)]), True
    if kind == 10:
        return _random(rng, an + "+/", 40), False
    return _random(rng, string.ascii_lowercase, 3, 5) + _random(rng, string.digits, 2, 4) + _random(rng, an + "!@#%^", 5, 9), False


def _secret(rng: random.Random) -> list[tuple[str, int]]:
    if rng.random() < 0.06:
        kind = rng.choice(["RSA ", "", "EC ", "OPENSSH "])
        lines = [_random(rng, string.ascii_letters + string.digits + "+/", 64) for _ in range(rng.randint(2, 5))]
        head, tail = f"-----BEGIN {kind}PRIVATE KEY-----".split(), f"-----END {kind}PRIVATE KEY-----".split()
        words = head + lines + tail
        return [(w, B if i == 0 else I) for i, w in enumerate(words)]
    v, bare = _value(rng)
    key = rng.choice(_KEYS)
    key = key.upper() if rng.random() < 0.25 else key
    junk = rng.choice(_JUNK)
    q = rng.choice(['"', '"', "'"])
    form = rng.randrange(9 if bare else 8)
    if form <= 2:
        return [(key, O), ("=", O), (f"{q}{v}{q}{junk}", B)]
    if form == 3:
        return [(f"{key}:", O), (v + junk, B)]
    if form == 4:
        return [(f"{key}={rng.choice(['', q])}{v}{junk}", B)]
    if form == 5:
        return [(f'"{key}":', O), (f'"{v}"' + rng.choice(["", ",", "}"]), B)]
    if form == 6:
        return [("Authorization:", O), (rng.choice(["Bearer", "Basic", "token"]), O), (v + junk, B)]
    if form == 7:
        return [(key, O), (rng.choice(["is", "=", "was", "->"]), O), (v + junk, B)]
    return [(v + junk, B)]


def _lookalike(rng: random.Random) -> list[tuple[str, int]]:
    hx, dg = "0123456789abcdef", string.digits
    kind, key, junk = rng.randrange(9), rng.choice(_OTHER), rng.choice(_JUNK)
    if kind <= 2:
        v = _random(rng, hx, rng.choice([32, 40, 64]))
        words = rng.choice([[key, v], [key, "=", f'"{v}"'], [f"{key}:", v], [f"{key}={v}"], [key, "is", v]])
    elif kind == 3:
        words = [rng.choice([key, "of", "the"]), _random(rng, dg, 16)]
    elif kind == 4:
        words = ["+1", f"({_random(rng, dg, 3)})", f"555-{_random(rng, dg, 4)}"]
    elif kind == 5:
        words = [rng.choice([".".join(str(rng.randrange(256)) for _ in range(4)), _random(rng, string.ascii_lowercase, 4, 9) + f".{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"])]
    elif kind == 6:
        words = [key, "-".join(_random(rng, hx, n) for n in (8, 4, 4, 4, 12))]
    elif kind == 7:
        words = [f"https://www.example.com/{_random(rng, string.ascii_lowercase, 3, 8)}/{_random(rng, dg, 2, 6)}"]
    else:
        words = [rng.choice(_KEYS), rng.choice(["of", "is", "for", "the", "=", "policy"]), rng.choice(["the", "required", "empty", "none", "null", '""', "changed"])]
    words[-1] += junk
    return [(w, O) for w in words]


def sequences(texts: list[str], n: int, rng: random.Random):
    """(tokens, tags, text features) of made sequences; each window comes from one of ``texts``."""
    pool = [w for t in texts if (w := _WORDS.findall(t or ""))]
    pool = [(w, text_features(w)) for w in pool] or [(["the", "text"], (0, 0, 0))]
    for _ in range(n):
        words, about = rng.choice(pool)
        at = rng.randrange(max(1, len(words) - LENGTH))
        row = [(w, O) for w in words[at : at + LENGTH] if not (len(w) >= 16 and any(c.isdigit() for c in w) and any(c.isalpha() for c in w))][: LENGTH - 12]
        if rng.random() < 0.15:  # text of broken marks
            row = [(w + rng.choice(_JUNK), y) for w, y in row]
        for make, p in ((_secret, 0.6), (_lookalike, 0.6), (_lookalike, 0.3)):
            if rng.random() < p:
                k = rng.randint(0, len(row))
                # a secret may stand right beside what only looks like one
                row[k:k] = make(rng) + (_lookalike(rng) if make is _secret and rng.random() < 0.25 else [])
        row = row[:LENGTH]
        if row:
            yield [w for w, _ in row], [y for _, y in row], about


def text_features(tokens: list) -> tuple[int, int, int]:
    """Classes of a whole text: its length, its shares of tokens with a digit and of tokens of symbols alone (over all its tokens)."""
    n = max(1, len(tokens))
    joined = (b" " if tokens and isinstance(tokens[0], bytes) else " ").join(tokens) if tokens else ""
    digits, marks = _runs(joined)
    return min(5, int(math.log10(n))), min(3, int(20 * digits / n)), min(3, int(20 * marks / n))


def _runs(joined) -> tuple[int, int]:
    """How many runs of digits and of equals signs and braces, in one pass each."""
    if isinstance(joined, bytes):
        return len(_DIGITS_B.findall(joined)), len(_CODE_B.findall(joined))
    return len(_DIGITS.findall(joined)), len(_CODE.findall(joined))


_DIGITS, _CODE = re.compile(r"[0-9]+"), re.compile(r"[={};]+")
_DIGITS_B, _CODE_B = re.compile(rb"[0-9]+"), re.compile(rb"[={};]+")


# --- the field -----------------------------------------------------------------------------


class Field:
    """Weights: for each offset (own, one before, two before, one after) a table of feature -> three scores; for text features; for tag pairs; for first tags."""

    def __init__(self, offsets, about, pairs, first):
        self.offsets, self.about, self.pairs, self.first = offsets, about, pairs, first
        self.known = frozenset(f[2:] for t in offsets for f in t if f[:2] in ("w=", "k="))
        # what the two transitions at one position could gain by B or I in place of O, at most
        before, after = np.vstack([pairs, first]), np.hstack([pairs, np.zeros((3, 1))])
        self.reach = np.array([(before[:, s] - before[:, O]).max() + (after[s] - after[O]).max() for s in (B, I)])

    def rows(self, token: str) -> np.ndarray:
        """(4, 3): what this token adds to the position itself, the one after, the second after, the one before."""
        fs = features(token, self.known)
        return np.array([sum((np.array(t.get(f, (0.0, 0.0, 0.0))) for f in fs), np.zeros(3)) for t in self.offsets])

    def emissions(self, tokens: list[str]) -> np.ndarray:
        e = np.zeros((len(tokens), 3))
        for i, k in enumerate(text_features(tokens)):
            e += self.about[i][k]
        for t, w in enumerate(tokens):
            r = self.rows(w)
            e[t] += r[0]
            if t + 1 < len(tokens):
                e[t + 1] += r[1]
            if t + 2 < len(tokens):
                e[t + 2] += r[2]
            if t:
                e[t - 1] += r[3]
        return e


def viterbi(e: np.ndarray, pairs: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list[int], float]:
    """Best tags and their score."""
    best, back = start + e[0], []
    for row in e[1:]:
        all_ = best[:, None] + pairs
        how = all_.argmax(axis=0)
        back.append(how)
        best = all_[how, range(3)] + row
    best = best + end
    y = [int(best.argmax())]
    for how in reversed(back):
        y.append(int(how[y[-1]]))
    return y[::-1], float(best.max())


def fit(made, steps: int = STEPS) -> Field:
    """Adam on the penalised conditional log-likelihood; forward and backward sums over all sequences at once."""
    made = list(made)
    ids: dict[tuple[str, ...], int] = {(): 0}
    counts: dict[str, int] = {}
    near: dict[str, int] = {}
    for tokens, tags, _ in made:
        for t, w in enumerate(tokens):
            for f in features(w):
                counts[f] = counts.get(f, 0) + 1
                if any(y != O for y in tags[max(0, t - 1) : t + 3]):
                    near[f] = near.get(f, 0) + 1
    keep = {f for f, n in counts.items() if n >= 4 and (f[:2] not in ("w=", "k=", "p=") and f[:3] != "p3=" or near.get(f, 0) >= 4 and near[f] >= 0.2 * n)} | {f"w={k}" for k in _OTHER if counts.get(f"w={k}", 0) >= 4} | {f"k={k}" for k in _OTHER if counts.get(f"k={k}", 0) >= 4}
    names = {f: i for i, f in enumerate(sorted(keep))}
    n, most = len(made), max(len(t) for t, _, _ in made)
    tok, tag, real = np.zeros((n, most), np.int64), np.full((n, most), O), np.zeros((n, most), bool)
    about = np.array([a for _, _, a in made])
    for i, (tokens, tags, _) in enumerate(made):
        for t, w in enumerate(tokens):
            fs = tuple(sorted(names[f] for f in features(w) if f in names))
            tok[i, t] = ids.setdefault(fs, len(ids))
        tag[i, : len(tags)], real[i, : len(tags)] = tags, True
    rowi = np.repeat(np.arange(len(ids)), [len(f) for f in ids])
    feat = np.array([x for f in ids for x in f], np.int64)
    nf, ns = len(names), len(ids)
    w = {"off": np.zeros((4, nf, 3)), "about": np.zeros((3, 6, 3)), "pairs": np.zeros((3, 3)), "first": np.zeros(3)}
    m1, m2 = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    shift = [(0, slice(None), slice(None)), (1, slice(1, None), slice(None, -1)), (2, slice(2, None), slice(None, -2)), (3, slice(None, -1), slice(1, None))]
    onehot = np.eye(3)[tag] * real[..., None]
    seen = onehot[:, :-1, :, None] * onehot[:, 1:, None, :]
    for step in range(1, steps + 1):
        e = np.zeros((n, most, 3))
        for k, to, frm in shift:
            table = np.stack([np.bincount(rowi, w["off"][k][feat, c], minlength=ns) for c in range(3)], axis=1)
            e[:, to] += table[tok[:, frm]] * real[:, frm][..., None]
        for j in range(3):
            e += w["about"][j][about[:, j]][:, None, :]
        # scaled sums: the scale of each step cancels in the two kinds of posterior
        lift, turn = np.exp(e - e.max(axis=2, keepdims=True)), np.exp(w["pairs"])
        alpha, beta = np.empty((n, most, 3)), np.ones((n, most, 3))
        alpha[:, 0] = np.exp(w["first"]) * lift[:, 0]
        for t in range(1, most):
            x = (alpha[:, t - 1] @ turn) * lift[:, t]
            alpha[:, t] = x / x.sum(axis=1, keepdims=True)
        for t in range(most - 2, -1, -1):
            x = (lift[:, t + 1] * beta[:, t + 1]) @ turn.T
            beta[:, t] = np.where(real[:, t + 1][:, None], x / x.sum(axis=1, keepdims=True), 1.0)
        p = alpha * beta
        p *= (real / p.sum(axis=2))[..., None]
        d = (p - onehot) / n
        pp = alpha[:, :-1, :, None] * turn * (lift * beta)[:, 1:, None, :]
        pp *= (real[:, 1:] / pp.sum(axis=(2, 3)))[..., None, None]
        g = {"pairs": (pp - seen).sum(axis=(0, 1)) / n, "first": d[:, 0].sum(axis=0), "off": np.zeros((4, nf, 3)), "about": np.zeros((3, 6, 3))}
        for k, to, frm in shift:
            part = (d[:, to] * real[:, frm][..., None]).reshape(-1, 3)
            at = tok[:, frm].ravel()
            for c in range(3):
                g["off"][k][:, c] = np.bincount(feat, np.bincount(at, part[:, c], minlength=ns)[rowi], minlength=nf)
        ds = d.sum(axis=1)
        for j in range(3):
            for c in range(3):
                g["about"][j][:, c] = np.bincount(about[:, j], ds[:, c], minlength=6)
        rate = 0.25 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k in w:
            gk = g[k] + RIDGE * w[k]
            m1[k] = 0.9 * m1[k] + 0.1 * gk
            m2[k] = 0.98 * m2[k] + 0.02 * gk * gk
            w[k] = w[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.98**step)) + 1e-8)
    tables = [{f: tuple(float(x) for x in w["off"][k][i]) for f, i in names.items()} for k in range(4)]
    return Field(tables, w["about"], w["pairs"], w["first"])


class _Rows(dict):
    """token -> its row in the tables of margins, for the tokens that a worker has met. Row 0 is outside the text."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field
        self.by_sign: dict = {}
        self.full = [np.zeros((4, 3))]
        self.arrays: tuple = ()
        self.flush = False

    def __missing__(self, token: bytes) -> int:
        text = token.decode("utf-8", "replace")
        sign = features(text, self.field.known)
        row = self.by_sign.get(sign)
        if row is None:
            row = self.by_sign[sign] = len(self.full)
            self.full.append(self.field.rows(text))
        if len(token) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[token] = row
        return row

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.arrays or len(self.arrays[0]) != len(self.full):
            full = np.array(self.full)
            lead = full[:, :, O : O + 1] - full[:, :, :O]  # how far O leads B and I
            self.arrays = full, lead
        return self.arrays


class Scanner:
    def __init__(self, field: Field):
        self.field, self.rows = field, _Rows(field)

    def tags(self, token_lists: list[list[bytes]]) -> list[list[tuple[int, int, float]]]:
        """For each text its secrets as (first token, one past the last, lead over all-O)."""
        f = self.field
        found: list[list[tuple[int, int, float]]] = [[] for _ in token_lists]
        n = np.array([len(t) for t in token_lists])
        # two empty places between texts stand for what is outside them
        total = int(n.sum()) + 2 * len(n) + 2
        ids = np.zeros(total, np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        begin = np.cumsum(n + 2) - n
        at = 2
        for t in token_lists:
            ids[at : at + len(t)] = np.fromiter(map(self.rows.__getitem__, t), np.int64, len(t))
            at += len(t) + 2
        full, lead = self.rows.tables()
        place = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        about = np.zeros((len(n), 3))
        for i, t in enumerate(token_lists):
            if t:
                for j, k in enumerate(text_features(t)):
                    about[i] += f.about[j][k]
        m = lead[:, 0][ids[place]] + lead[:, 1][ids[place - 1]] + lead[:, 2][ids[place - 2]] + lead[:, 3][ids[np.minimum(place + 1, total - 1)]]
        m += (about[:, O : O + 1] - about[:, :O])[owner]
        open_ = np.flatnonzero((m <= f.reach).any(axis=1))
        k = 0
        while k < len(open_):
            j = k
            while j + 1 < len(open_) and open_[j + 1] == open_[j] + 1 and owner[open_[j + 1]] == owner[open_[k]]:
                j += 1
            lo, hi = int(open_[k]), int(open_[j]) + 1
            d = int(owner[lo])
            p = place[lo:hi]
            after = np.where(p + 1 < total, ids[np.minimum(p + 1, total - 1)], 0)
            e = full[ids[p], 0] + full[ids[p - 1], 1] + full[ids[p - 2], 2] + full[after, 3] + about[d]
            first, last = int(place[lo] - begin[d]), int(place[hi - 1] - begin[d])
            start = f.first if first == 0 else f.pairs[O]
            end = np.zeros(3) if last == n[d] - 1 else f.pairs[:, O]
            y, _ = viterbi(e, f.pairs, start, end)
            t = 0
            while t < len(y):
                if y[t] == O:
                    t += 1
                    continue
                u = t + 1
                while u < len(y) and y[u] == I:
                    u += 1
                # against O all along this span, its neighbours as they are
                def path(tags, left=(start if t == 0 else f.pairs[y[t - 1]]), right=(end if u == len(y) else f.pairs[:, y[u]]), t=t, u=u):
                    s = left[tags[0]] + right[tags[-1]] + sum(e[t + i, c] for i, c in enumerate(tags))
                    return s + sum(f.pairs[a, b] for a, b in zip(tags, tags[1:]))

                found[d].append((first + t, first + u, float(path(y[t:u]) - path([O] * (u - t)))))
                t = u
            k = j + 1
        return found

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, float]]]:
        """For each text its secrets as (start, end, lead) in code points."""
        raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        made = []
        for text, data, hits in zip(texts, raw, self.tags([r.split() for r in raw])):
            row = []
            if hits:
                where = [m.span() for m in _TOKEN.finditer(data)]
                for a, b, lead in hits:
                    lo, hi = where[a][0], where[b - 1][1]
                    start, end = len(data[:lo].decode("utf-8", "replace")), len(data[:hi].decode("utf-8", "replace"))
                    if b == a + 1:
                        token = text[start:end]
                        v = parts(token)[1]
                        if v:
                            start += token.rindex(v)
                            end = start + len(v)
                    row.append((start, end, lead))
            made.append(row)
        return made


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit on sequences made over at most ``sample`` texts of ``docs``."""
    some = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    texts = [r.t for r in least_digests(some, "i", sample, "t").collect() if r.t is not None]
    return fit(sequences(texts, SEQUENCES, random.Random(3)))


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, lead) for each secret of each row. ``lead`` is the log-odds over no secret there. The field, of a size that the sample bounds, goes out with the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        s = Scanner(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = [(i, *hit) for i, hits in enumerate(s.spans(part.column(1).to_pylist())) for hit in hits]
                if rows:
                    k, lo, hi, lead = zip(*rows)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(k)), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(lead, pa.float64())], names=["doc_id", "start", "end", "lead"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lead", T.DoubleType())])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(trimmed(run), schema)


def redact_text(text: str, spans) -> str:
    out, at = [], 0
    for lo, hi, _ in spans:
        out += [text[at:lo], MARK]
        at = hi
    return "".join(out) + text[at:]


def redact(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with each secret replaced; all rows and columns stay, in order. A column ``n_chars``, if there is one, is counted again."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def redacted(batches):
        scanner = Scanner(shared.value)
        for texts in batches:
            out = []
            for at in range(0, len(texts), 256):
                part = texts.slice(at, 256).to_pylist()
                out += [redact_text(t, s) if s else t for t, s in zip(part, scanner.spans(part))]
            yield pa.array(out, pa.string())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from trimmed(redacted)(batches)

    clean = docs.withColumn(text_col, F.arrow_udf(run, "string").asNondeterministic()(F.col(text_col).cast("string")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return clean


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs, train(docs))


QUERIES = {"op3_secrets": op3_secrets}
ORACLE: dict[str, str] = {}
