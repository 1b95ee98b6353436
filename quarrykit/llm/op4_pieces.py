"""SentencePiece encoding and decoding by a single-pass Viterbi.

An Aho-Corasick automaton over the vocabulary's pieces reads a segment once.
At each character the automaton's state names, through its output links,
every piece that ends there, longest first; each relaxes the best score of
that position. A character that no piece covers costs ``min score - 10`` and
is spelled in byte pieces.

No piece of such a vocabulary has a word mark after its first other
character, so no piece crosses the place before a mark or beside a line
break, and a text's best path is the join of its segments' best paths. The
distinct words of some hundred texts are looked up once. Words come again and
again, so each worker keeps the ids of short ones, up to a fixed number, in two Arrow arrays;
that is a memory of exact results. New
ones are solved side by side: one array operation moves all their automata on
by a character, and each output link is one more relaxation of all of them.

Scores. A unigram file holds log-probabilities, which are used as they are
(``scores="file"``). A merge-based file holds minus the merge rank, which is
no log-probability: sums of ranks shred words into frequent short pieces. For
it ``scores="zipf"`` takes ``-log(rank + 2)``, in steps of 1/1024 so that sums
are exact. Ties go to the longer last piece.

Defined results: a null text has null ids, an empty text none. Texts of any
length are encoded whole. U+2581, the word mark itself, decodes to a space, as
in the public library. Repeated rows repeat. Columns other than the two named
are not looked at.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrykit.llm.words import kept, trimmed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNK_PENALTY = 10.0
#: Words of each generation that a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST_REMEMBERED = 100_000, 48
#: Texts, and bytes of them, that are encoded at once; one longer text alone.
TEXTS, TEXT_BYTES = 512, 2 << 20
#: Words that are solved side by side.
TOGETHER = 8_192
MOST_EDGES = 300_000
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        elif kind == 5:
            value, at = struct.unpack("<f", data[at : at + 4])[0], at + 4
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id, from a SentencePiece model file.

    Files whose texts are changed before they are encoded (a character map, rules, blanks taken out, no blank put before), and those with
    user-defined pieces, which go before all scores, are refused: their ids would be others.
    """
    with open(path, "rb") as f:
        data = f.read()
    found, way = [], {}
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for k, v in _fields(value):
                if k == 1:
                    piece = v.decode("utf-8")
                elif k == 2:
                    score = v
                elif k == 3:
                    kind = v
            found.append((piece, score, kind))
        elif number == 3:
            way = dict(_fields(value))
    if way.get(2) or way.get(6) or not way.get(3, 1) or way.get(4, 1) or not way.get(5, 1):
        raise ValueError(f"{path}: a normaliser that is not supported")
    if any(kind == USER for _, _, kind in found):
        raise ValueError(f"{path}: user-defined pieces are not supported")
    return found


def zipf_scores(pieces: list[tuple[str, float, int]]) -> list[tuple[str, float, int]]:
    """Merge ranks (the negated scores) as log-probabilities of a Zipf law."""
    return [(p, round(-math.log(max(0.0, -s) + 2.0) * 1024) / 1024 if k == NORMAL else s, k) for p, s, k in pieces]


#: Characters that the automaton has a complete table for; class 0 is every other one.
_CLASSES = [chr(c) for c in (10, *range(32, 127), *range(161, 256))] + [MARK]
_CLASS_OF = {ch: i for i, ch in enumerate(_CLASSES, 1)}
_KIND = np.zeros(ord(MARK) + 2, np.uint8)
for _ch, _k in _CLASS_OF.items():
    _KIND[ord(_ch)] = _k


class Automaton:
    """Aho-Corasick over the pieces: goto edges, failure links, and for each state its outputs, longest first."""

    def __init__(self, words: dict[str, tuple[float, int]]):
        self.goto: list[dict[str, int]] = [{}]
        own: list[tuple[int, float, int] | None] = [None]
        for word, (score, i) in words.items():
            at = 0
            for ch in word:
                nxt = self.goto[at].get(ch)
                if nxt is None:
                    nxt = self.goto[at][ch] = len(self.goto)
                    self.goto.append({})
                    own.append(None)
                at = nxt
            own[at] = (len(word), score, i)
        n = len(self.goto)
        self.fail = [0] * n
        self.out: list[tuple[tuple[int, float, int], ...]] = [()] * n
        ready = list(self.goto[0].values())
        for at in ready:
            self.out[at] = (own[at],) if own[at] else ()
        for at in ready:
            for ch, nxt in self.goto[at].items():
                back = self.fail[at]
                while back and ch not in self.goto[back]:
                    back = self.fail[back]
                self.fail[nxt] = self.goto[back].get(ch, 0)
                # the output link: whatever ends at the failure state ends here too
                self.out[nxt] = ((own[nxt],) if own[nxt] else ()) + self.out[self.fail[nxt]]
                ready.append(nxt)
        self._arrays(own)
        self.added = 0

    def _arrays(self, own: list) -> None:
        """The same automaton as arrays: a complete table over ``_CLASSES``, goto edges of other characters by key, outputs and output links."""
        n = len(self.goto)
        self.fails = np.array(self.fail, np.int32)
        self.table = np.zeros((n, len(_CLASSES) + 1), np.uint16 if n <= 1 << 16 else np.int32)
        seen = {ch for g in self.goto for ch in g if ch not in _CLASS_OF}
        self.code = {ch: i for i, ch in enumerate(sorted(seen))}
        keys, to = [], []
        level = [0]
        while level:
            at = np.array(level)
            if level != [0]:
                self.table[at] = self.table[self.fails[at]]
            below = []
            for s in level:
                for ch, nxt in self.goto[s].items():
                    k = _CLASS_OF.get(ch)
                    if k is None:
                        keys.append(s * len(self.code) + self.code[ch])
                        to.append(nxt)
                    else:
                        self.table[s, k] = nxt
                    below.append(nxt)
            level = below
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.to = np.array(keys, np.int64)[order], np.array(to, np.int32)[order]
        self.length, self.score, self.piece = np.zeros(n, np.int32), np.zeros(n), np.full(n, -1, np.int32)
        for i, o in enumerate(own):
            if o:
                self.length[i], self.score[i], self.piece[i] = o
        # the nearest state along failure links, itself included, where a piece ends
        self.first, self.link = np.zeros(n, np.int32), np.zeros(n, np.int32)
        for i, o in enumerate(self.out):
            if o:
                at = i
                while not own[at]:
                    at = self.fail[at]
                self.first[i] = at
                if len(o) > 1:
                    back = self.fail[at]
                    while not own[back]:
                        back = self.fail[back]
                    self.link[at] = back
        self.covers = np.array([bool(o) and o[-1][0] == 1 for o in self.out])

    def moved(self, state: np.ndarray, kinds: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The next states of many automata."""
        nxt = self.table[state, kinds].astype(np.int32)
        rest = np.flatnonzero(kinds == 0)
        if len(rest):
            code = np.array([self.code.get(chr(c), -1) for c in chars[rest].tolist()])
            at, open_ = state[rest].astype(np.int64), np.flatnonzero(code >= 0)
            nxt[rest] = 0
            while len(open_) and len(self.keys):
                key = at[open_] * len(self.code) + code[open_]
                k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[k] == key
                nxt[rest[open_[hit]]] = self.to[k[hit]]
                open_ = open_[~hit & (at[open_] > 0)]
                at[open_] = self.fails[at[open_]]
        return nxt

    def step(self, state: int, ch: str) -> int:
        """Along failure links to the next state. The way is kept as an edge, so a common one is walked once; their number is bounded."""
        at, nxt = state, self.goto[state].get(ch)
        while nxt is None and at:
            at = self.fail[at]
            nxt = self.goto[at].get(ch)
        nxt = nxt or 0
        if self.added < MOST_EDGES:
            self.added += 1
            self.goto[state][ch] = nxt
        return nxt


class Codec:
    def __init__(self, pieces: list[tuple[str, float, int]]):
        words = {p: (s, i) for i, (p, s, k) in enumerate(pieces) if k in (NORMAL, USER)}
        if any(MARK in p.lstrip(MARK) for p in words):
            raise ValueError("a piece has a word mark inside: segments would not be independent")
        if any("\n" in p for p in words):
            raise ValueError("a piece holds a line break")
        self.auto = Automaton(words)
        self.unk_score = min(s for s, _ in words.values()) - UNK_PENALTY
        self.byte_ids = [0] * 256
        self.plain = [b""] * len(pieces)
        for i, (p, _, k) in enumerate(pieces):
            if k == BYTE:
                b = int(p[3:5], 16)
                self.byte_ids[b] = i
                self.plain[i] = bytes([b])
            elif k in (NORMAL, USER):
                self.plain[i] = p.replace(MARK, " ").encode()
        self.plain_array = pa.array(self.plain, pa.binary())
        self.has_bytes = any(k == BYTE for _, _, k in pieces)
        self.unk_id = next(i for i, (_, _, k) in enumerate(pieces) if k == UNKNOWN)
        self.memory = _Memory(self)

    def spelled(self, ch: str) -> list[int]:
        """An uncovered character, last byte first."""
        return [self.byte_ids[b] for b in reversed(ch.encode("utf-8", "replace"))] if self.has_bytes else [self.unk_id]

    def viterbi(self, s: str) -> list[int]:
        """Ids of the best path over ``s``, which is escaped already."""
        goto, out, unk = self.auto.goto, self.auto.out, self.unk_score
        best, back = [0.0], [(0, 0)]
        state = 0
        for i, ch in enumerate(s):
            nxt = goto[state].get(ch)
            state = self.auto.step(state, ch) if nxt is None else nxt
            top, how, single = -math.inf, None, False
            for n, score, k in out[state]:
                if n == 1:
                    single = True
                score += best[i + 1 - n]
                if score > top:
                    top, how = score, (n, k)
            if not single:
                score = best[i] + unk
                if score > top:
                    top, how = score, (1, -1)
            best.append(top)
            back.append(how)
        ids: list[int] = []
        i = len(s)
        while i:
            n, k = back[i]
            if k >= 0:
                ids.append(k)
            else:
                ids.extend(self.spelled(s[i - 1]))
            i -= n
        ids.reverse()
        return ids

    def solved(self, words: pa.Array) -> pa.ListArray:
        """The ids of the best path over each word, which comes without its mark."""
        marked = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise(MARK, words, ""))
        sizes = pc.utf8_length(words).to_numpy()
        order = np.argsort(-sizes, kind="stable")
        long = int((sizes > LONGEST_REMEMBERED).sum())  # side by side they would take much memory
        made = [pa.array([self.viterbi(w) for w in marked.take(pa.array(order[:long])).to_pylist()], _IDS)]
        made += [self.solve(marked.take(pa.array(order[at : at + TOGETHER]))) for at in range(long, len(order), TOGETHER)]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return pa.concat_arrays(made).take(pa.array(back))

    def solve(self, words: pa.Array) -> pa.ListArray:
        """The ids of the best path over each escaped word; all take their next character at once. The longest come first."""
        sizes = pc.utf8_length(words).to_numpy().astype(np.int64)
        order = None if (sizes[1:] <= sizes[:-1]).all() else np.argsort(-sizes, kind="stable")
        if order is not None:  # a line break has no mark before it
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            return self.solve(words.take(pa.array(order))).take(pa.array(back))
        a, n, most = self.auto, len(words), int(sizes[0]) if len(words) else 0
        flat = np.frombuffer(_joined(words).encode("utf-32-le"), np.uint32)
        starts = np.cumsum(sizes) - sizes
        kinds = _KIND[np.minimum(flat, len(_KIND) - 1)]
        best, how, took = np.zeros((most + 1, n)), np.full((most + 1, n), -1, np.int32), np.ones((most + 1, n), np.int32)
        state = np.zeros(n, np.int32)
        row = np.arange(n)
        for i in range(most):
            m = int(np.searchsorted(-sizes, -i, "left"))  # words with a character at i
            at = starts[:m] + i
            state = a.moved(state[:m], kinds[at], flat[at])
            top, which, size = np.full(m, -np.inf), np.full(m, -1, np.int32), np.ones(m, np.int32)
            k = np.flatnonzero(a.first[state])
            now = a.first[state[k]]
            while len(k):
                score = best[i + 1 - a.length[now], k] + a.score[now]
                better = score > top[k]
                kb, nb = k[better], now[better]
                top[kb], which[kb], size[kb] = score[better], a.piece[nb], a.length[nb]
                now = a.link[now]
                more = now > 0
                k, now = k[more], now[more]
            bare = best[i, :m] + self.unk_score
            alone = ~a.covers[state] & (bare > top)
            top[alone], which[alone], size[alone] = bare[alone], -1, 1
            best[i + 1, :m], how[i + 1, :m], took[i + 1, :m] = top, which, size
        single = np.array([*(self.byte_ids[:128] if self.has_bytes else [self.unk_id] * 128), -1], np.int32)
        # back along the best paths, all at once, the last piece first
        pos, live, path, plain = sizes.copy(), row, [], np.ones(n, bool)
        live = live[pos > 0]
        while len(live):
            p = pos[live]
            ids = how[p, live]
            bare = np.flatnonzero(ids < 0)
            if len(bare):
                char = flat[starts[live[bare]] + p[bare] - 1]
                ids[bare] = single[np.minimum(char, 128)]
                plain[live[bare[char >= 128]]] = False
            path.append((live, ids))
            pos[live] = p - took[p, live]
            live = live[pos[live] > 0]
        depth = np.zeros(n, np.int64)
        for live, _ in path:
            depth[live] += 1
        ends = np.cumsum(depth)
        table = np.empty(int(ends[-1]) if n else 0, "<i4")
        for back, (live, ids) in enumerate(path, 1):
            table[ends[live] - back] = ids
        out = _lists(table, ends)
        odd = np.flatnonzero(~plain)
        if len(odd):  # an uncovered character is spelled in several bytes
            row[odd] = n + np.arange(len(odd))
            out = pa.concat_arrays([out, pa.array([self.viterbi(w) for w in words.take(pa.array(odd)).to_pylist()], _IDS)]).take(pa.array(row))
        return out

    def encode_many(self, texts: list[str | None], column: pa.Array | None = None) -> list[bytes | None]:
        """The ids of each text as little-endian int32. ``column`` holds the same texts."""
        column = pa.array(texts, pa.string()) if column is None else column
        spaced = pc.replace_substring(column, "\n", " \n")
        # runs of spaces, or a space at an end: segments hold a run and what follows it
        odd = [pc.match_substring(spaced, "  "), pc.starts_with(spaced, " "), pc.ends_with(spaced, " "), pc.match_substring(spaced, MARK), pc.equal(pc.binary_length(spaced), 0)]
        plain = pc.fill_null(pc.invert(reduce(pc.or_, odd)), False)
        made: list[bytes | None] = [None] * len(texts)
        simple = np.asarray(plain)
        if simple.any():
            parts = pc.split_pattern(spaced.filter(plain), " ")
            # each word of these texts once
            coded = parts.flatten().dictionary_encode()
            source, at = self.memory.look_up(coded.dictionary)
            got = source.take(pa.array(at[coded.indices.to_numpy()]))
            cuts = (4 * got.offsets.to_numpy()[parts.offsets.to_numpy()].astype(np.int64)).tolist()
            data = got.values.to_numpy().tobytes()
            for i, x, y in zip(np.flatnonzero(simple).tolist(), cuts, cuts[1:]):
                made[i] = data[x:y]
        for i in np.flatnonzero(~simple).tolist():
            if texts[i] is not None:
                made[i] = b"".join([self.memory.of(p) for p in _SEGMENT.findall(MARK + texts[i].replace(" ", MARK))]) if texts[i] else b""
        return made

    def encode_bytes(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode(self, ids) -> str:
        raw = b"".join(map(self.plain.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_SEGMENT = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


_IDS = pa.list_(pa.int32())


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat.astype(np.int32, copy=False)))


def _joined(words: pa.Array) -> str:
    """All words as one text."""
    return "" if not len(words) else pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "")[0].as_py()


class _Memory:
    """Words and their ids, side by side in Arrow arrays: ``old`` ones, which were used in the generation before, and then those of this one.
    A word comes without its mark, or is a line break and the word after it. When a generation is full, the most used words of both are the next one's old ones."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.clear()

    def clear(self) -> None:
        self.words, self.ids, self.uses = pa.array([], pa.string()), pa.array([], _IDS), np.zeros(0, np.float32)
        self.old = self.words

    def __len__(self) -> int:
        """Words of this generation."""
        return len(self.words) - len(self.old)

    def look_up(self, words: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """Lists of ids, and for each of ``words``, which are distinct, which list is its own."""
        found = pc.index_in(words, value_set=self.words)
        at = pc.fill_null(found, -1).to_numpy().astype(np.int32)
        gaps = np.flatnonzero(at < 0)
        self.uses[at[at >= 0]] += 1
        if not len(gaps):
            return self.ids, at
        new = words.take(pa.array(gaps))
        ids = self.codec.solved(new)
        source = pa.concat_arrays([self.ids, ids])
        at[gaps] = len(self.ids) + np.arange(len(gaps))
        self.learn(new, ids)
        return source, at

    def learn(self, words: pa.Array, ids: pa.ListArray) -> None:
        short = pc.less_equal(pc.utf8_length(words), LONGEST_REMEMBERED)
        words, ids = words.filter(short).slice(0, REMEMBERED), ids.filter(short).slice(0, REMEMBERED)
        if len(self) + len(words) > REMEMBERED:
            keep = np.flatnonzero(self.uses)
            if len(keep) > REMEMBERED:
                keep = np.sort(keep[np.argpartition(-self.uses[keep], REMEMBERED)[:REMEMBERED]])
            self.words, self.ids, self.uses = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.uses[keep] / 2
            self.old = self.words
        self.words, self.ids, self.uses = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids]), np.append(self.uses, np.zeros(len(words), np.float32))

    def of(self, segment: str) -> bytes:
        ids = self.codec.viterbi(segment)
        return struct.pack(f"<{len(ids)}i", *ids)


def codec(pieces_key, make) -> Codec:
    """One codec for each worker process and vocabulary; it goes when the worker runs another operator."""
    return kept(pieces_key, lambda: Codec(make()))


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of the parts of a column that are encoded at once."""
    done = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)))
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(done, done[at] + TEXT_BYTES, "right")) - 1
        end = max(at + 1, min(at + TEXTS, end))
        yield at, end - at
        at = end


def encode_column(texts: pa.Array, c: Codec, check: bool = True) -> tuple[pa.Array, pa.Array]:
    """(ids, whether decoding them gives the text again) for a column of texts; without ``check`` the second is null."""
    rows = texts.to_pylist()
    made = c.encode_many(rows, texts)
    ends = np.cumsum([0] + [len(b) // 4 if b else 0 for b in made])
    flat = np.frombuffer(b"".join([b for b in made if b]), "<i4")
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat), mask=texts.is_null() if texts.null_count else None)
    return ids, decodes_to(texts, rows, flat, ends, c) if check else pa.nulls(len(texts), pa.bool_())


def decodes_to(texts: pa.Array, rows: list[str | None], flat: np.ndarray, ends: np.ndarray, c: Codec) -> pa.Array:
    """Whether each row's ids decode to its text. The pieces of all rows are laid out at once and held against the texts' bytes."""
    spelled = c.plain_array.take(pa.array(flat))
    cuts = np.frombuffer(spelled.buffers()[1], np.int32)[spelled.offset : spelled.offset + len(flat) + 1].astype(np.int64) if len(flat) else np.zeros(1, np.int64)
    data = np.frombuffer(spelled.buffers()[2], np.uint8) if len(flat) and spelled.buffers()[2] else np.zeros(0, np.uint8)
    lo, hi = cuts[ends[:-1]], cuts[ends[1:]]
    lo = lo + ((hi > lo) & (data[np.minimum(lo, max(0, len(data) - 1))] == 32) if len(data) else 0)  # the dummy space goes
    ok = []
    for t, a, b in zip(rows, lo.tolist(), hi.tolist()):
        if t is None:
            ok.append(None)
            continue
        got, raw = data[a:b].tobytes(), t.encode("utf-8", "replace")
        ok.append(got == raw or got.decode("utf-8", "replace") == t)
    return pa.array(ok, pa.bool_())


def encode_documents(docs: DataFrame, model: str = MODEL, scores: str = "zipf", id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip) for every row of ``docs``; ``round_trip`` says whether the decoded ids are the text, null without ``check``. The vocabulary, of fixed size, goes out with the tasks."""
    pieces = read_model(model)
    if scores == "zipf":
        pieces = zipf_scores(pieces)
    elif scores != "file":
        raise ValueError(scores)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    key = (model, scores)

    def run(batches):
        c = codec(key, lambda: shared.value)
        for b in batches:
            for at, rows in slices(b.column(1)):
                part = b.slice(at, rows)
                ids, ok = encode_column(part.column(1), c, check)
                n = pc.list_value_length(ids)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, n, ok], names=["doc_id", "ids", "n_tokens", "round_trip"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.IntegerType()), T.StructField("round_trip", T.BooleanType())])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(trimmed(run, key), schema)


def decode_documents(encoded: DataFrame, model: str = MODEL, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) from ids. Ids outside the vocabulary raise; null ids give a null text."""
    pieces = read_model(model)
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        c = codec((model, "decode"), lambda: shared.value)
        for b in batches:
            texts = [None if x is None else c.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    schema = T.StructType([T.StructField("doc_id", encoded.schema[id_col].dataType), T.StructField("text", T.StringType())])
    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, schema)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_sentencepiece": op4_sentencepiece}
ORACLE: dict[str, str] = {}
