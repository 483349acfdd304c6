"""Token counts by a compiled finite-state transducer.

The tokenizer file (byte-level BPE behind its word-splitting pattern) is compiled, transition by
transition as texts need them, into a deterministic transducer over characters.  A state holds
what of the text before still matters: the kind of run it is in, and for the open word the last
bytes that may become part of a longer token, with the last token and the token count at each of those
places.  Every transition is annotated with the change of the number of emitted tokens (a merge makes
it negative), so a text's count is the sum along its path, and no token is ever built.

Texts are cut into chunks.  A chunk's *state map* gives, for the few states that its beginning can have, the state
at its end and the count between.  Those states come from the characters before the chunk: a space followed by a
letter leads to the same state from every state; without such a place the transducer runs over what lies before, from
several starts.  States that some chunk ends in and the next one does not know yet are run in further rounds, in all
chunks of that text, until the maps are closed; a text that still is not (none known) is run in one go.
Maps compose associatively, by a prefix scan in three levels of up to 1,024 neighbours each, more than a string can hold.
Work is linear in the text, also for digits, blanks, ideographs and words that never end.

Special strings in texts are handled as the tokenizer file's default does: one token each, and a
cut.  Null and empty texts have no tokens; ids may be null or repeat; an empty table gives an empty
table; only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import json
from ast import literal_eval
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, start, table, text_or_empty, written

CHUNK = 1 << 16  # characters
FAN = 1024
LOOK = 2048  # characters before a chunk that its first states are guessed from
STARTS = 4
ROUNDS, STATES = 6, 64  # of closing the maps, and new states of a text in one; beyond them the text is run in one go
TRANSITION_LIMIT = 500_000  # kept by a worker; beyond it they are compiled anew
TABLE_BITS = 18
LANES, FEW = 4096, 16
END = 0x110000  # stands behind each text
_SPREAD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1

# The endings that the word-splitting pattern cuts off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4


class Bpe:
    """Merge rules of a byte-level tokenizer file, over bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_of_symbol()
        raw = lambda s: bytes(to_byte[c] for c in s)
        self.rank, self.made, self.halves = {}, {}, {}
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            pair = raw(a), raw(b)
            self.rank[pair] = k
            self.made.setdefault(pair[0] + pair[1], k)  # by the first rule that makes the token
            self.halves.setdefault(pair[0] + pair[1], pair)
        self.special = [t["content"] for t in spec["added_tokens"]]
        known = {raw(t) for t in spec["model"]["vocab"] if all(c in to_byte for c in t)}
        # tokens that a text can reach: those that encode to themselves
        self.tokens = {t: t for t in known if self.split(t) == (t,)}
        self.prefixes = {t[:k] for t in self.tokens for k in range(len(t))}
        self.fits = lru_cache(1 << 18)(self._fits)

    def split(self, word: bytes) -> tuple[bytes, ...]:
        """The tokens of ``word`` by applying the lowest-ranked merge until none is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            pair = parts[best], parts[best + 1]
            if pair not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return tuple(parts)

    def _fits(self, a: bytes, b: bytes) -> bool:
        """Do the two tokens stay side by side when their text is encoded?

        Undo the merges that built them, latest first: no pair that ever met at the border may have
        had a rank below that of the merge by which one of the two was used up (on the left the same rank wins)."""
        limit = 1 << 30
        while True:
            if self.rank.get((a, b), 1 << 30) < limit:
                return False
            x, y = self.made.get(a, -1), self.made.get(b, -1)
            if x < 0 and y < 0:
                return True
            if x > y:
                limit, a = x, self.halves[a][1]
            else:
                limit, b = y + 1, self.halves[b][0]


def byte_of_symbol() -> dict[str, int]:
    """Byte-level symbols: printable Latin-1 stands for itself, the other bytes for 256 and up, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def character_kinds() -> bytes:
    """Letter, number, white space or other for every code point, as the tokenizer library's own patterns see it."""
    from tokenizers import Regex
    from tokenizers.normalizers import Replace

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    kinds = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        left = Replace(Regex(pattern), "").normalize_str(every)
        inside = np.ones(0x110000, bool)
        inside[np.frombuffer(left.encode("utf-32-le"), np.uint32)] = False
        inside[0xD800:0xE000] = False
        kinds[inside] = kind
    return kinds.tobytes()


# A word state: (bytes that may still be joined, per place from there to the end: (last token, count less the current)).
Word = tuple[bytes, tuple]
NEW: Word = (b"", ((None, 0),))
BEGIN = ("0", NEW, "", ())
StateMap = dict[str, tuple[str, int]]  # by the state at the beginning: the state at the end, and the count between


class Transducer:
    """Keys are ``(mode, word, extra, specials)``.

    Modes: ``0`` fresh (the next character starts a word), ``L N O`` in a run, ``A`` after an apostrophe that
    starts a word, ``E`` inside an ending that needs one more letter (extra: that letter), ``W`` white space
    with its last character (extra) still open.  ``specials`` lists the special strings that may be
    under way: (characters seen, key before, count since)."""

    def __init__(self, bpe: Bpe, kinds: bytes) -> None:
        self.bpe, self.kinds = bpe, kinds
        self.letters = np.append(np.frombuffer(kinds, np.uint8) == LETTER, False)
        self.long = {e[0]: e[1] for e in ENDINGS if len(e) > 1}
        self.short = {e for e in ENDINGS if len(e) == 1}
        self.byte = lru_cache(1 << 15)(self._byte)
        self.shape = lru_cache(1 << 16)(self._shape)
        self.clear()

    def clear(self) -> None:
        """Forget the compiled transitions (between batches, when no lane is in any state)."""
        self.keys: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.size = 0
        self.at = np.full(1 << TABLE_BITS, -1, np.int64)
        self.to = np.zeros(1 << TABLE_BITS, np.int64)
        self.begin = self.state(BEGIN)
        self.after: dict[int, int] = {}
        self.one: dict[int, int] = {}  # transitions of single runs

    def state(self, key: tuple) -> int:
        n = self.ids.setdefault(key, len(self.keys))
        if n == len(self.keys):
            self.keys.append(key)
        return n

    # ---- words

    def _shape(self, tail: bytes) -> tuple[tuple, int, tuple]:
        """Tokens that end ``tail`` (longest first), where its longest suffix that may go on begins, and at
        which places from there a token may begin that is longer than what is left."""
        n = len(tail)
        ends = tuple((i, self.bpe.tokens[tail[i:]]) for i in range(n) if tail[i:] in self.bpe.tokens)
        cut = next(i for i in range(n + 1) if tail[i:] in self.bpe.prefixes)
        return ends, cut, tuple(tail[i:] in self.bpe.prefixes for i in range(cut, n + 1))

    def _byte(self, word: Word, b: bytes) -> tuple[Word, int]:
        """One more byte of the open word."""
        tail, places = word
        tail += b
        ends, cut, useful = self.shape(tail)
        for i, token in ends:
            place = places[i]
            if place is not None and (place[0] is None or self.bpe.fits(place[0], token)):
                change = place[1] + 1
                break
        else:
            raise AssertionError("every byte is a token")
        places = (*places, (token, change))
        return (tail[cut:], tuple([(places[i][0], places[i][1] - change) if u else None for i, u in enumerate(useful, cut)])), change

    def char(self, word: Word, c: str) -> tuple[Word, int]:
        total = 0
        for b in c.encode("utf-8", "surrogatepass"):
            word, d = self.byte(word, bytes((b,)))
            total += d
        return word, total

    # ---- runs

    def kind(self, c: str) -> str:
        return " LNWO"[self.kinds[ord(c)]]

    def fresh(self, c: str) -> tuple[tuple, int]:
        kind = self.kind(c)
        if kind == "W":
            return ("W", NEW, c), 0
        word, change = self.char(NEW, c)
        return ("A" if c == "'" else kind, word, ""), change

    def core(self, key: tuple, c: str) -> tuple[tuple, int]:
        mode, word, extra = key
        if mode == "0":
            return self.fresh(c)
        kind = self.kind(c)
        if mode == "W":
            if kind == "W":
                word, change = self.char(word, extra)
                return ("W", word, c), change
            if extra == " ":  # the last space goes with the next word
                word, one = self.char(NEW, " ")
                word, two = self.char(word, c)
                return (kind, word, ""), one + two
            _, one = self.char(NEW, extra)
            key, two = self.fresh(c)
            return key, one + two
        if mode == "A":
            if c in self.short:
                _, change = self.char(word, c)
                return ("0", NEW, ""), change
            if c in self.long:
                first, change = self.char(NEW, c)
                return ("E", first, c), change
            mode = "O"
        elif mode == "E":
            if c == self.long[extra]:
                before = 1 + self.char(NEW, extra)[1]  # the apostrophe and the letter, counted apart so far
                whole, total = NEW, 0
                for x in "'" + extra + c:
                    whole, d = self.char(whole, x)
                    total += d
                return ("0", NEW, ""), total - before
            mode = "L"
        if kind == mode:
            word, change = self.char(word, c)
            return (mode, word, ""), change
        return self.fresh(c)

    def end(self, key: tuple) -> int:
        """Tokens still to be counted if the text ends here."""
        mode, word, extra = key[:3]
        return self.char(word, extra)[1] if mode == "W" else 0

    def step(self, key: tuple, c: str) -> tuple[tuple, int]:
        core, change = self.core(key[:3], c)
        begun = []
        for seen, before, since in (*key[3], ("", key[:3], 0)):
            now = seen + c
            for special in self.bpe.special:
                if special == now:  # as if the text had ended before it
                    return BEGIN, self.end(before) + 1 - since
                if special.startswith(now):
                    begun.append((now, before, since + change))
                    break
        return (*core, tuple(begun)), change

    # ---- texts

    def compiled(self, place: int) -> int:
        """Fill in the transition of ``place`` (state and character): next state and change of the count."""
        state, code = place >> 21, place & 0x1FFFFF
        key = self.keys[state]
        after, change = (BEGIN, self.end(key)) if code == END else self.step(key, chr(code))
        value = (self.state(after) << 16) | (change + 32768)
        if 2 * self.size >= len(self.at):
            self._grow()
        self._put(place, value)
        self.size += 1
        return value

    def _put(self, place: int, value: int) -> None:
        i = ((place * _SPREAD) & _MASK) >> (64 - len(self.at).bit_length() + 1)
        while self.at[i] != -1:
            i = (i + 1) % len(self.at)
        self.at[i], self.to[i] = place, value

    def _grow(self) -> None:
        at, to = self.at, self.to
        self.at, self.to = np.full(2 * len(at), -1, np.int64), np.zeros(2 * len(at), np.int64)
        for i in np.flatnonzero(at != -1).tolist():
            self._put(int(at[i]), int(to[i]))

    def look_up(self, places: np.ndarray) -> np.ndarray:
        shift = np.uint64(64 - len(self.at).bit_length() + 1)
        i = ((places.view(np.uint64) * np.uint64(_SPREAD)) >> shift).view(np.int64)
        found = self.at[i]
        out = self.to[i]
        open_ = np.flatnonzero(found != places)
        while len(open_):
            empty = found[open_] == -1
            new = open_[empty]
            open_ = open_[~empty]
            if len(new):
                known: dict[int, int] = {}
                for k, place in zip(new.tolist(), places[new].tolist(), strict=True):
                    if place not in known:
                        known[place] = self.compiled(place)
                    out[k] = known[place]
                return self._rest(places, out, open_)
            i[open_] = (i[open_] + 1) % len(self.at)
            found[open_], out[open_] = self.at[i[open_]], self.to[i[open_]]
            open_ = open_[found[open_] != places[open_]]
        return out

    def _rest(self, places: np.ndarray, out: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """The table has changed: look the others up anew."""
        if len(open_):
            out[open_] = self.look_up(places[open_])
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if self.size > TRANSITION_LIMIT:
            self.clear()
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        ends = np.cumsum(lengths)
        codes = np.full(int(ends[-1]) if len(texts) else 0, END, np.int64)
        inner = np.ones(len(codes), bool)
        inner[ends - 1] = False
        codes[inner] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        changes = np.zeros(len(codes), np.int16)
        starts, states = self._lanes(codes, ends)
        sizes = np.diff(np.append(starts, len(codes)))
        order = np.argsort(-sizes, kind="stable")
        starts, states, sizes = starts[order], states[order], sizes[order]
        j, n = 0, len(starts)
        while n:
            n = int(np.searchsorted(-sizes, -j, side="left"))  # lanes longer than j
            if n < FEW:
                break
            here = starts[:n] + j
            got = self.look_up((states[:n] << 21) | codes[here])
            states[:n] = got >> 16
            changes[here] = (got & 0xFFFF) - 32768
            j += 1
        for k in range(n):  # the few long lanes left (words that never end) one by one
            state, lo, hi = int(states[k]), int(starts[k] + j), int(starts[k] + sizes[k])
            for p, c in enumerate(codes[lo:hi].tolist(), lo):
                got = self.one.get((state << 21) | c)
                if got is None:
                    got = self._one((state << 21) | c)
                state = got >> 16
                changes[p] = (got & 0xFFFF) - 32768
        total = np.concatenate([[0], np.cumsum(changes, dtype=np.int64)])
        return total[ends] - total[ends - lengths]

    def _lanes(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places from which the state is known (text starts, behind landmarks), near even distances."""
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        marks = np.flatnonzero((codes[:-1] == 32) & self.letters[codes[1:]]) + 2
        known = np.concatenate([marks[marks < len(codes)], ends[:-1]])
        known.sort()
        lanes = max(1, min(LANES, len(codes) // 64))
        want = np.arange(1, lanes) * (len(codes) // lanes)
        at = np.searchsorted(known, want)
        starts = np.unique(np.concatenate([[0], known[at[at < len(known)]]]).astype(np.int64))
        states = np.full(len(starts), self.begin, np.int64)
        texts = np.zeros(len(codes) + 1, bool)
        texts[ends] = texts[0] = True
        for k in np.flatnonzero(~texts[starts]).tolist():
            c = int(codes[starts[k] - 1])
            if c not in self.after:
                key, _ = self.step(BEGIN, " ")
                self.after[c] = self.state(self.step(key, chr(c))[0])
            states[k] = self.after[c]
        return starts, states

    def landmark(self, text: str, backwards: bool = False) -> int:
        """Where a space is followed by a letter (the index of the space), first or last; -1 if nowhere."""
        find = text.rfind if backwards else text.find
        i = find(" ")
        while i >= 0:
            if i + 1 < len(text) and self.kinds[ord(text[i + 1])] == LETTER:
                return i
            i = find(" ", 0, i) if backwards else find(" ", i + 1)
        return -1

    def _one(self, place: int) -> int:
        got = self.one[place] = int(self.look_up(np.array([place], np.int64))[0])
        return got

    def run(self, state: int, text: str) -> tuple[int, int]:
        """State after the text, and the change of the count."""
        one, total = self.one, 0
        for c in text:
            place = (state << 21) | ord(c)
            got = one.get(place)
            if got is None:
                got = self._one(place)
            state = got >> 16
            total += (got & 0xFFFF) - 32768
        return state, total

    def name(self, state: int) -> str:
        """A state as text, the same in every worker."""
        return repr(self.keys[state])

    def named(self, name: str) -> int:
        return self.state(literal_eval(name))

    def entries(self, before: str, whole: bool) -> list[str]:
        """States that a chunk may begin in, by the text before it (``whole``: all of it)."""
        i = self.landmark(before, backwards=True)
        if i >= 0 or whole:
            return [self.name(self.run(self.begin, before[max(i, 0) :])[0])]
        states = {self.begin}
        for k, c in enumerate(before):
            states = {self.run(s, c)[0] for s in states} | ({self.begin} if k < STARTS else set())
        return sorted(map(self.name, states))

    def chunk_maps(self, chunks: list[str], entries: list[list[str]]) -> list[StateMap]:
        """The maps of chunks from the states they may begin in."""
        marks = [(self.landmark(c), self.landmark(c, backwards=True)) for c in chunks]
        middles = [c[i : k + 2] if i >= 0 else "" for c, (i, k) in zip(chunks, marks, strict=True)]
        counts, leads = self.counts(middles).tolist(), self.counts([m[:2] for m in middles]).tolist()
        maps = []
        for chunk, (i, k), known, n, lead in zip(chunks, marks, entries, counts, leads, strict=True):
            if i < 0:
                runs = {e: self.run(self.named(e), chunk) for e in known}
                maps.append({e: (self.name(s), x) for e, (s, x) in runs.items()})
                continue
            state, tail = self.run(self.begin, chunk[k:])
            rest = n - lead + tail - self.run(self.begin, chunk[k : k + 2])[1]
            maps.append({e: (self.name(state), self.run(self.named(e), chunk[: i + 2])[1] + rest) for e in known})
        return maps

    def state_maps(self, chunks: list[str]) -> list[StateMap]:
        """Closed maps of the chunks of one text, in order."""
        begin = self.name(self.begin)
        maps = self.chunk_maps(chunks, [[begin], *[self.entries(c[-LOOK:], False) for c in chunks[:-1]]])
        for k in range(1, len(chunks)):
            missing = sorted({x for x, _ in maps[k - 1].values()} - maps[k].keys())
            maps[k] |= self.chunk_maps([chunks[k]], [missing])[0]
        return maps

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        """The map of two neighbouring stretches."""
        return {e: (b[x][0], n + b[x][1]) for e, (x, n) in a.items()}

    def total(self, m: StateMap) -> int:
        """Tokens of a whole text by its map."""
        state, n = m[repr(BEGIN)]
        return n + self.end(literal_eval(state))


_MACHINES: dict[str, Transducer] = {}


def machine(path: str, kinds: bytes) -> Transducer:
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(Bpe(path), kinds)
    return _MACHINES[path]


def _count_whole(path: str, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine(path, shared.value)
        for b in batches:
            for part in slices(b):
                counts = m.counts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64())], ["row", "n_bytes", "n_tokens"])

    return run


_PIECE = "id long, n_bytes long, place long, chunks long, before string, piece string"
_MAP = "id long, n_bytes long, place long, chunks long, entry string, exit string, n long"
_MAP_TYPES = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]


def _cut(chunk: int) -> Callable:
    """Texts in chunks, each with what lies before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, n_bytes, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                text = text.as_py()
                n = -(-len(text) // chunk)
                for lo in range(0, n, 16):
                    places = range(lo, min(lo + 16, n))
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array([x] * len(places), pa.int64()) for x in (key, n_bytes)], pa.array(places, pa.int64()), pa.array([n] * len(places), pa.int64()),
                         pa.array([text[max(0, k * chunk - LOOK) : k * chunk] for k in places], pa.string()),
                         pa.array([text[k * chunk : (k + 1) * chunk] for k in places], pa.string())], [x.split()[0] for x in _PIECE.split(", ")])

    return run


def _map_rows(heads: list[tuple], maps: list[StateMap]) -> pa.RecordBatch:
    rows = [(*head, e, x, n) for head, m in zip(heads, maps, strict=True) for e, (x, n) in m.items()]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(_MAP_TYPES)], [x.split()[0] for x in _MAP.split(", ")])


def _map_chunks(path: str, shared, chunk: int) -> Callable:
    """Maps of chunks from the given states, or from those that the text before suggests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine(path, shared.value)
        for b in batches:
            for part in slices(b, "piece"):
                heads = list(zip(*(part.column(k).to_pylist() for k in range(4)), strict=True))
                if "entries" in part.schema.names:
                    known = part.column("entries").to_pylist()
                else:
                    known = [m.entries(t, h[2] * chunk <= LOOK) for h, t in zip(heads, part.column(4).to_pylist(), strict=True)]
                yield _map_rows(heads, m.chunk_maps(part.column(5).to_pylist(), known))

    return run


def _compose(path: str, shared, last: bool) -> Callable:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        m = machine(path, shared.value)
        rows = rows.to_pylist()
        by_place: dict[int, StateMap] = {}
        for r in rows:
            by_place.setdefault(r["place"], {})[r["entry"]] = r["exit"], r["n"]
        first, *others = (by_place[k] for k in sorted(by_place))
        for other in others:
            first = m.compose(first, other)
        r = rows[0]
        if last:
            return pa.table({"id": pa.array([r["id"]], pa.int64()), "n_bytes": pa.array([r["n_bytes"]], pa.int64()), "n_tokens": pa.array([m.total(first)], pa.int64())})
        return pa.Table.from_batches([_map_rows([(r["id"], r["n_bytes"], r["place"] // FAN, r["chunks"])], [first])])

    return run


def _count_at_once(path: str, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine(path, shared.value)
        for b in batches:
            found = []
            for text in b.column(2):
                state, n = m.run(m.begin, text.as_py())
                found.append(n + m.end(m.keys[state]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.int64())], ["id", "n_bytes", "n_tokens"])

    return run


def _gaps(maps: DataFrame) -> DataFrame:
    """Per text the states that a chunk ends in and the next one does not know."""
    ends = maps.where("place + 1 < chunks").select("id", (F.col("place") + 1).alias("place"), F.col("exit").alias("entry")).distinct()
    return ends.join(maps.select("id", "place", "entry"), ["id", "place", "entry"], "left_anti").groupBy("id").agg(F.collect_set("entry").alias("entries"))


def _long_counts(texts: DataFrame, path: str, shared, chunk: int) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` of distinct long texts ``(id, n_bytes, text)``."""
    spark = texts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = texts.mapInArrow(_cut(chunk), _PIECE).repartition(tasks, "id", "place")
    of_states = _map_chunks(path, shared, chunk)
    maps = written(pieces.mapInArrow(of_states, _MAP), "maps")
    out = "id long, n_bytes long, n_tokens long"
    rest = None
    for k in range(ROUNDS + 1):
        gaps = written(_gaps(maps), "gaps")
        few = gaps.where(F.size("entries") <= STATES)
        if not gaps.count():
            break
        if k == ROUNDS or not few.count():  # no state maps of use: these texts in one go
            rest = texts.join(gaps.select("id"), "id", "left_semi").select("id", "n_bytes", "text").mapInArrow(_count_at_once(path, shared), out)
            maps = maps.join(gaps.select("id"), "id", "left_anti")
            break
        maps = written(maps.unionAll(pieces.join(few, "id").mapInArrow(of_states, _MAP)).dropDuplicates(["id", "place", "entry"]), "maps")
    for _ in range(2):
        maps = maps.groupBy("id", F.floor(F.col("place") / FAN)).applyInArrow(_compose(path, shared, False), _MAP)
    totals = maps.groupBy("id").applyInArrow(_compose(path, shared, True), out)
    return totals if rest is None else totals.unionAll(rest)


def token_counts(docs: DataFrame, path: str, text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``(row, n_bytes, n_tokens)`` for every row; ``row`` is a struct of the row's columns but the text."""
    spark = docs.sparkSession
    start(spark)
    shared = spark.sparkContext.broadcast(character_kinds())  # one byte per code point
    others = [c for c in docs.columns if c != text_col] or [F.lit(None).cast("int").alias("none")]
    texts = docs.select(F.struct(*others).alias("row"), text_or_empty(text_col).alias("text"))
    texts = texts.select("row", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    row_type = texts.schema["row"].dataType.simpleString()
    short = texts.where(F.length("text") <= chunk).mapInArrow(_count_whole(path, shared), f"row {row_type}, n_bytes long, n_tokens long")
    long = texts.where(F.length("text") > chunk).withColumn("id", F.xxhash64("text"))
    # equal texts have one id and are counted once
    distinct = long.groupBy("id").agg(F.min(F.struct("text", "n_bytes")).alias("t")).select("id", "t.n_bytes", "t.text")
    totals = _long_counts(distinct, path, shared, chunk)
    return short.unionAll(long.select("row", "n_bytes", "id").join(totals.select("id", "n_tokens"), "id").select("row", "n_bytes", "n_tokens"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
