"""Byte-level BPE: the merges compiled into a lazily determinised transducer, and a streaming decoder.

What a byte string's last token is depends on little: on each start of a possible last token, the token before that start
and the bytes since. A state of the transducer is exactly this set, ``(vocabulary prefix, token before it)`` for every start
that some token could still complete, so states are few, shared by all texts, and built when first met. Reading a byte
moves every start on, drops those that no token continues, and finds the one token that ends here: the pair (token before,
token) must be one that the merges leave alone. Tokens are emitted once every start that is still alive agrees on them; a
start is never older than the longest token, which bounds the lookahead.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of (base64 token, rank)."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class Transducer:
    """Encodes byte strings by merge ranks, a state at a time. ``most_states`` and ``most_pairs`` bound the memory: past
    them the tables are forgotten and built anew, which changes no result."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = 200_000, most_pairs: int = 1_000_000):
        self.ranks, self.tokens = ranks, {i: t for t, i in ranks.items()}
        self.most_states, self.most_pairs = most_states, most_pairs
        self.prefixes = {t[:n] for t in ranks for n in range(1, len(t) + 1)}
        self.longest = max(map(len, ranks), default=1)
        self.pairs: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[int, tuple[int, int]]] = []
        self.start = self._state(((b"", -1),))

    def _state(self, key: tuple) -> int:
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return found

    def merged(self, piece: bytes) -> list[int]:
        """The merges applied one by one, lowest rank first, leftmost first: the definition, for short strings."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _stays(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side."""
        if left < 0:
            return self.merged(self.tokens[right]) == [right]
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, token that ends here); a state's starts are ordered from the oldest."""
        c, alive, last = bytes((byte,)), [], -1
        for read, before in self.states[state]:
            grown = read + c
            if grown in self.prefixes:
                alive.append((grown, before))
                token = self.ranks.get(grown)
                if last < 0 and token is not None and self._stays(before, token):
                    last = token
        if last < 0:
            raise ValueError(f"byte {byte} has no token")
        alive.append((b"", last))
        move = self.moves[state][byte] = self._state(tuple(alive)), last
        return move

    def encode(self, piece: bytes, out: list[int]) -> None:
        """Append the tokens of one piece. A piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            out.append(whole)
            return
        if len(self.states) > self.most_states:
            self._forget()
        moves, state, ends, sent = self.moves, self.start, [], 0  # ends[i]: the token that ends after byte sent + i
        for byte in piece:
            move = moves[state].get(byte) or self._move(state, byte)
            state, token = move
            ends.append(token)
            if len(ends) >= 4096:
                sent += self._settle(state, ends, out)
                if len(self.states) > self.most_states:  # keep this state while forgetting the others
                    key = self.states[state]
                    self._forget()
                    moves, state = self.moves, self._state(key)
        out.extend(self._back(ends, len(ends)))

    def _back(self, ends: list[int], at: int) -> list[int]:
        found = []
        while at > 0:
            token = ends[at - 1]
            found.append(token)
            at -= len(self.tokens[token])
        return found[::-1]

    def _settle(self, state: int, ends: list[int], out: list[int]) -> int:
        """Emit the tokens that every live start agrees on; return how many bytes they were."""
        n = len(ends)
        at = {n - len(read) for read, _ in self.states[state]}
        while len(at) > 1:  # step the latest start back until all meet
            late = max(at)
            at.remove(late)
            at.add(late - len(self.tokens[ends[late - 1]]))
        meet = at.pop()
        out.extend(self._back(ends, meet))
        del ends[:meet]
        return meet


class Codec:
    """Texts to ids and back, with the pieces of ``pattern`` encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_units: int = 300_000):
        self.transducer, self.pattern = Transducer(ranks), regex.compile(pattern)
        self.table = {i: t for t, i in ranks.items()}
        self.most_units, self.units, self.older = most_units, {}, {}

    def _encode(self, text: str) -> bytes:
        out: list[int] = []
        for piece in self.pattern.findall(text):
            self.transducer.encode(piece.encode(), out)
        return np.array(out, "<u4").tobytes()

    def _unit(self, unit: str) -> bytes | None:
        """Ids of a blank and the unit after it; None if a unit's edge is blank, when it can't stand alone.

        Two generations are remembered: a full one becomes the older one, from which what is met again moves back.
        """
        if unit in self.older:
            ids = self.older[unit]
        else:
            ids = None if not unit or unit[0].isspace() or unit[-1].isspace() else self._encode(" " + unit)
        if len(unit) <= 64:
            if len(self.units) >= self.most_units:
                self.older = dict(self.units)
                self.units.clear()
            self.units[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A single blank between two characters that are not blank always begins a piece, so what follows it up to the
        next one is encoded once and remembered. Units with a blank at an edge are joined with their neighbours first.
        """
        if not text:
            return b""
        head, *rest = text.split(" ")
        if not rest or not head or head[-1].isspace():
            return self._encode(text)
        units, find = self.units, self._unit
        try:
            return self._encode(head) + b"".join([units[u] if u in units else find(u) for u in rest])
        except TypeError:  # a unit that can't stand alone: join it with its neighbours
            return self._mended(head, rest)

    def _mended(self, head: str, rest: list[str]) -> bytes:
        parts, waiting = [], head
        for u in rest:
            if u and waiting and not u[0].isspace() and not waiting[-1].isspace():
                parts.append(waiting)
                waiting = u
            else:
                waiting += " " + u
        parts.append(waiting)
        units, find = self.units, self._unit
        out = [self._encode(parts[0])]
        for u in parts[1:]:
            ids = units[u] if u in units else find(u)
            out.append(self._encode(" " + u) if ids is None else ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Utf8Stream:
    """An incremental UTF-8 state machine: feed bytes in any cuts, get the text that is complete so far.

    The state is the unfinished sequence (at most three bytes). Bytes that can't be UTF-8 become U+FFFD one maximal part at a time.
    """

    # Lead byte to (bytes still to come, least and most of the next byte): the fixed table of well-formed sequences.
    _LEADS = [*((range(0xC2, 0xE0), 1, 0x80, 0xBF),), (range(0xE0, 0xE1), 2, 0xA0, 0xBF), (range(0xE1, 0xED), 2, 0x80, 0xBF),
              (range(0xED, 0xEE), 2, 0x80, 0x9F), (range(0xEE, 0xF0), 2, 0x80, 0xBF), (range(0xF0, 0xF1), 3, 0x90, 0xBF),
              (range(0xF1, 0xF4), 3, 0x80, 0xBF), (range(0xF4, 0xF5), 3, 0x80, 0x8F)]
    LEAD = {b: (more, low, high) for leads, more, low, high in _LEADS for b in leads}

    def __init__(self):
        self.kept = b""

    def _unfinished(self, data: bytes) -> int:
        """How many bytes at the end begin a sequence that further bytes could finish."""
        for n in range(1, min(3, len(data)) + 1):
            byte = data[-n]
            if 0x80 <= byte <= 0xBF:
                continue
            more, low, high = self.LEAD.get(byte, (0, 0, 0))
            fits = n <= more and (n == 1 or low <= data[-n + 1] <= high)
            return n if fits else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.kept + data
        n = self._unfinished(data)
        self.kept = data[len(data) - n:]
        return data[:len(data) - n].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.kept = self.kept, b""
        return rest.decode("utf-8", "replace")


def decode_stream(table: dict[int, bytes], ids: Iterable[int], at_once: int = 65_536) -> Iterator[str]:
    """Text for a stream of ids, ``at_once`` ids at a time; characters that span tokens come out whole."""
    state, some = Utf8Stream(), []
    for i in ids:
        some.append(table[i])
        if len(some) >= at_once:
            yield state.feed(b"".join(some))
            some = []
    yield state.feed(b"".join(some))
    yield state.close()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One per Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
                     with_ids: bool = False, slice_ids: int = 65_536) -> DataFrame:
    """One row per input row: (doc_id, n_tokens, ids_sha256, decoded_sha256), and the ids if asked for.

    The decoded digest is taken from the ids, decoded slice by slice through the UTF-8 state machine. Null and
    empty texts have no ids. Repeated rows give repeated results; other columns are ignored; an empty table gives none.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            counts, digests, decoded, kept = [], [], [], []
            for text in batch.column("text"):
                ids = own.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                seen, state = hashlib.sha256(), Utf8Stream()
                for a in range(0, len(ids), 4 * slice_ids):
                    seen.update(state.feed(own.decode(ids[a:a + 4 * slice_ids])).encode())
                seen.update(state.close().encode())
                decoded.append(seen.hexdigest())
                kept.append(ids if with_ids else None)
            arrays = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                                + (", ids binary" if with_ids else ""))
