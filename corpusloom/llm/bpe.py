"""Byte-level BPE as a lazily determinised finite-state transducer, and its streaming decoder.

The merges are compiled into a transducer over bytes. A state is the last
token that was emitted together with the bytes still pending; reading a byte
either prolongs the pending bytes or emits the tokens that no later byte can
change. Which token ends at a position follows from two facts about merge
ranks: the encoding of a prefix ends in one token only, and a sequence of
tokens is the encoding of its bytes exactly if every neighbouring pair is. A
later token can start only at a position from which the pending bytes are the
beginning of some token, so all tokens before the last boundary that the
chains of those positions share are final: the lookahead is bounded by the
longest token. States and transitions are made when first met and are kept in
a table of bounded size, which starts anew when it is full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import filterfalse, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches, table, whole_texts
from .tokenizer import public_path, ranks_of, split_pattern

SPACE = r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


class Transducer:
    """The transducer's states and transitions, in arrays, and pieces run through it side by side.

    A transition is a row of ``table`` (state) and a column (class of a byte)
    and holds the number of a move: the state it leads to and the tokens it
    emits. Whether two tokens can stand side by side is found by taking them
    apart by their merges, the later one first (the pair test of the published
    linear-time encoders for byte-pair merges).
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = 300_000):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for i, t in self.tokens.items()}
        self.starts = {t[:n] for t in ranks for n in range(1, len(t))}  # proper beginnings of tokens
        self.pairs: dict[tuple[int, int], bool] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.clear()

    def clear(self) -> None:
        self.index: dict[tuple[int, bytes], int] = {}
        self.known: list[tuple] = []  # last token, pending bytes, token that ends at each position, boundaries before it as bits, live starts
        self.classes = np.full(256, -1, np.int64)
        self.n_classes = self.moves = self.n_out = 0
        self.table = np.full((1024, 32), -1, np.int32)
        self.final = np.full(1024, -1, np.int32)
        self.to, self.first, self.count = (np.zeros(4096, np.int32) for _ in range(3))
        self.out = np.zeros(4096, np.uint32)
        self.state(-1, b"", (-1,), (1,), ())

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens that a token was merged from; a byte's are itself."""
        found = self.split.get(token)
        if found is None:
            data = self.tokens[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                _, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.split[token] = (self.ranks[parts[0]], self.ranks[parts[-1]])
        return found

    def fits(self, a: int, b: int) -> bool:
        """Whether two neighbours stay apart: no merge across them comes before those that made them."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > 400_000:
                self.pairs.clear()
            found = self.pairs[a, b] = self.apart(a, b)
        return found

    def apart(self, a: int, b: int) -> bool:
        ranks, tokens, limit = self.ranks, self.tokens, 1 << 60
        while True:
            if ranks.get(tokens[a] + tokens[b], limit) < limit:
                return False
            if a > b:
                limit, a = a, self.halves(a)[1]
                if a == limit:
                    limit, b = b + 1, self.halves(b)[0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.halves(b)[0]
                if b + 1 == limit:
                    limit, a = a, self.halves(a)[1]
                    if a == limit:
                        return True

    def state(self, last: int, pending: bytes, ends: tuple, bounds: tuple, live: tuple) -> int:
        if pending and (not live or live[0]):
            last = -2  # no later token starts right after it: it no longer matters
        key = (last, pending)
        found = self.index.get(key)
        if found is None:
            found = self.index[key] = len(self.known)
            self.known.append((last, pending, ends, bounds, live))
            if found >= len(self.table):
                more = len(self.table) // 2
                self.table = np.concatenate([self.table, np.full_like(self.table[:more], -1)])
                self.final = np.concatenate([self.final, np.full_like(self.final[:more], -1)])
        return found

    def chain(self, ends: tuple, at: int) -> list[int]:
        """The tokens up to a position."""
        out: list[int] = []
        while at:
            out.append(ends[at])
            at -= self.size[ends[at]]
        return out[::-1]

    def move(self, to: int, done: list[int]) -> int:
        """The number of a new move to a state that emits tokens."""
        t, at = self.moves, self.n_out
        if t == len(self.to):
            self.to, self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.to, self.first, self.count))
        while at + len(done) > len(self.out):
            self.out = np.concatenate([self.out, np.zeros_like(self.out)])
        self.to[t], self.first[t] = to, at
        if done:
            self.count[t] = len(done)
            self.out[at : at + len(done)] = done
        self.moves, self.n_out = t + 1, at + len(done)
        return t

    def step(self, s: int, byte: int) -> None:
        """Determinises one transition."""
        last, pending, ends, bounds, live = self.known[s]
        n, data, ranks, starts = len(pending), pending + bytes((byte,)), self.ranks, self.starts
        live = (*live, n)
        tails = [data[p:] for p in live]
        for start, tail in zip(live, tails):
            token = ranks.get(tail)
            if token is not None:
                before = ends[start] if start else last
                if before == -1 or self.fits(before, token):
                    break
        ends, bounds = (*ends, token), (*bounds, bounds[start] | 1 << n + 1)
        live = tuple([p for p, tail in zip(live, tails) if tail in starts])
        shared = bounds[-1]
        for p in live:
            shared &= bounds[p]
        commit = shared.bit_length() - 1
        done: list[int] = []
        if commit:
            done = self.chain(ends, commit)
            last, data, ends = done[-1], data[commit:], (-1, *ends[commit + 1 :])
            bounds, live = (1, *[b >> commit | 1 for b in bounds[commit + 1 :]]), tuple([p - commit for p in live])
        to = self.state(last, data, ends, bounds, live)
        self.table[s, self.classes[byte]] = self.move(to, done)

    def admit(self, data: np.ndarray) -> None:
        """Columns for bytes that weren't met before."""
        for b in np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self.classes < 0)).tolist():
            if self.n_classes == self.table.shape[1]:
                self.table = np.concatenate([self.table, np.full_like(self.table[:, :16], -1)], axis=1)
            self.classes[b] = self.n_classes
            self.n_classes += 1

    def run(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has; they go through the states together, a byte of each at a time."""
        if len(self.known) > self.max_states:
            self.clear()
        data = np.frombuffer(b"".join(pieces), np.uint8)
        self.admit(data)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        start = np.cumsum(size) - size
        slot = start + np.arange(len(pieces))  # a move for each byte and a last one
        order = np.argsort(-size, kind="stable")
        begin, into, falling = start[order], slot[order], -size[order]
        moves = np.zeros(len(data) + len(pieces), np.int32)
        states = np.zeros(len(pieces), np.int64)
        for k in range(int(size.max(initial=0))):
            n = int(np.searchsorted(falling, -k))  # pieces longer than k
            byte, at = data[begin[:n] + k], states[:n]
            got = self.table[at, self.classes[byte]]
            new = np.flatnonzero(got < 0)
            if len(new):
                for key in np.unique(at[new] << 8 | byte[new]).tolist():
                    self.step(key >> 8, key & 255)
                got = self.table[at, self.classes[byte]]
            moves[into[:n] + k] = got
            states[:n] = self.to[got]
        got = self.final[states]
        new = np.flatnonzero(got < 0)
        if len(new):
            for s in np.unique(states[new]).tolist():
                self.final[s] = self.move(0, self.chain(self.known[s][2], len(self.known[s][1])))
            got = self.final[states]
        moves[into + size[order]] = got
        count = self.count[moves].astype(np.int64)
        total = np.cumsum(count)
        ids = self.out[np.repeat(self.first[moves] - (total - count), count) + np.arange(total[-1] if len(total) else 0)]
        ends = total[slot + size] if len(total) else total
        return ids, np.diff(ends, prepend=0)

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        return self.run([piece])[0].tolist()


class Utf8Stream:
    """Incremental UTF-8: a state machine over bytes, determinised over whole tokens when they are first met.

    A state is the bytes of an unfinished character. Bytes that can't go on are
    replaced by U+FFFD, as Python's decoder does with ``errors="replace"``.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.moves = tokens, {}
        n = max(tokens, default=-1) + 1
        self.whole, self.open = np.full(n, "", object), np.ones(n, bool)  # from the state between characters: what a token gives, and whether it doesn't lead back to it
        for i, token in tokens.items():
            text, rest = self.advance(b"", token)
            if not rest and "\ufffd" not in text:
                self.whole[i], self.open[i] = text, False

    @staticmethod
    def advance(pending: bytes, data: bytes) -> tuple[str, bytes]:
        data, out, at = pending + data, [], 0
        while at < len(data):
            b = data[at]
            need = 1 if b < 0x80 else 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
            if not need:
                out.append("\ufffd")
                at += 1
                continue
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(b, (0x80, 0xBF))
            n = 1
            while n < need and at + n < len(data) and low <= data[at + n] <= high:
                n, low, high = n + 1, 0x80, 0xBF
            if n == need:
                out.append(data[at : at + n].decode("utf-8"))
            elif at + n == len(data):
                return "".join(out), data[at:]
            else:
                out.append("\ufffd")
            at += n
        return "".join(out), b""

    def text(self, ids: np.ndarray) -> str:
        """The text of all tokens: whole ones at once, the machine runs from each other one until it is between characters again."""
        out, n, done = self.whole[ids], len(ids), 0
        for at in np.flatnonzero(self.open[ids]).tolist():
            if at < done:
                continue
            pending, done = b"", at
            while done == at or pending and done < n:
                out[done], pending = self.move(pending, int(ids[done]))
                done += 1
            if pending:
                out[n - 1] += "\ufffd"
        return "".join(out.tolist())

    def move(self, pending: bytes, i: int) -> tuple[str, bytes]:
        found = self.moves.get((pending, i))
        if found is None:
            if len(self.moves) > 200_000:
                self.moves.clear()
            found = self.moves[pending, i] = self.advance(pending, self.tokens[i])
        return found

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of each token as far as its characters are complete; what is left at the end comes last."""
        pending = b""
        for i in ids:
            text, pending = self.move(pending, int(i))
            yield text
        if pending:
            yield "\ufffd"


class Encoder:
    """Whole texts: split by the pattern, each match through the transducer.

    Between a space and what follows it the pattern never joins across the
    space unless white space stands on both sides of it, so texts are first cut
    before their spaces. The ids of short frequent words are remembered; all
    new words of a group of texts go through the transducer together.
    """

    #: Characters of texts that are encoded together, and pieces that go through the transducer together, about.
    GROUP, PIECES = 1 << 21, 50_000

    def __init__(self, path: str, memo: int = 200_000):
        import regex

        self.machine, self.memo, self.old, self.size = Transducer(ranks_of(path)), {}, {}, memo
        self.pattern = regex.compile(split_pattern().replace(r"[^\s", "[^" + SPACE[1:-1]).replace(r"\s", SPACE).replace(r"(?!\S)", f"(?!{'[^' + SPACE[1:]})"))
        self.joined = regex.compile(f"{SPACE} {SPACE}").search

    def straight(self, text: str) -> bytes:
        """A text by its matches alone."""
        out, found = [], (m[0].encode("utf-8") for m in self.pattern.finditer(text))
        while pieces := list(islice(found, self.PIECES)):
            out.append(self.machine.run(pieces)[0].astype("<u4").tobytes())
        return b"".join(out)

    def learn(self, words: list[str], lead: str) -> Iterator[tuple[str, bytes]]:
        """Words with the ids that they have after ``lead``."""
        find = self.pattern.findall
        for k in range(0, len(words), self.PIECES):
            some, pieces, ends = words[k : k + self.PIECES], [], []
            for w in some:
                if w.isascii() and w.isalpha():
                    pieces.append((lead + w).encode())
                else:
                    pieces += [x.encode("utf-8") for x in find(lead + w)]
                ends.append(len(pieces))
            ids, count = self.machine.run(pieces)
            raw, stop = ids.astype("<u4").tobytes(), (np.concatenate([[0], np.cumsum(count)])[ends] * 4).tolist()
            yield from zip(some, (raw[a:z] for a, z in zip([0, *stop], stop)))

    def together(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        memo, new, parts = self.memo, set(), []
        for text in texts:
            parts.append(None if not text or self.joined(text) else text.split(" "))
            if parts[-1]:
                new.update(filterfalse(memo.__contains__, islice(parts[-1], 1, None)))
        for w in new & self.old.keys():
            memo[w] = self.old[w]
        memo.update(self.learn([w for w in new if w not in memo], " "))
        opening = dict(self.learn(list({words[0] for words in parts if words}), ""))
        get = memo.__getitem__
        out = [b"".join((opening[words[0]], *map(get, islice(words, 1, None)))) if words else self.straight(text) for text, words in zip(texts, parts)]
        for w in new:
            if len(w) >= 32:
                del memo[w]
        if len(memo) > self.size:  # what wasn't met for a whole generation is forgotten
            self.old, self.memo = memo, {}
        return out

    def packed(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in groups of a bounded size; a long text is cut before spaces."""
        held: list[str] = []
        room = self.GROUP
        for text in texts:
            if len(text) > self.GROUP and not self.joined(text):
                yield from self.together(held)
                held, room, out, at = [], self.GROUP, [], 0
                while at < len(text):
                    stop = text.find(" ", at + self.GROUP)
                    stop = len(text) if stop < 0 else stop
                    out += self.together([text[at:stop]])
                    at = stop
                yield b"".join(out)
                continue
            held.append(text)
            room -= len(text)
            if room < 0:
                yield from self.together(held)
                held, room = [], self.GROUP
        yield from self.together(held)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(next(self.packed([text])), "<u4").tolist()


@lru_cache(maxsize=2)
def machines(path: str) -> tuple[Encoder, Utf8Stream]:
    encoder = Encoder(path)
    return encoder, Utf8Stream(encoder.machine.tokens)


ROUND_TRIP = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """Encode every whole text and decode its ids again.

    Null and empty texts have no tokens (digests of no bytes); repeated rows
    and null ids give a row each; an empty table gives none.
    """
    path = ranks or public_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream = machines(path)
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for raw in encoder.packed(batch.column(1).to_pylist()):
                counts.append(len(raw) // 4)
                ids_hex.append(hashlib.sha256(raw).hexdigest())
                text_hex.append(hashlib.sha256(stream.text(np.frombuffer(raw, "<u4")).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    small_batches(docs.sparkSession)
    return whole_texts(docs).mapInArrow(run, ROUND_TRIP)


def op9_bpe_transducer(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
