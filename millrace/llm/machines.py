"""The machines that ``transducer`` composes: normaliser, pieces with byte fallback, and merging.

Each has states and arcs. An arc reads symbols, writes symbols and has a weight (0 where none is said); weights add along a path and the least total wins.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator

SPACE = "▁"


class Rewriting:
    """A table of rewritings as a longest-match machine over UTF-8 bytes.

    The table is a double array behind its size, then the texts, each ended by a zero byte. A state is a place of the double array; an arc
    on a byte leads to another, and a state with a text may write it. Arcs are looked up in the array as they are asked for.
    """

    def __init__(self, table: bytes):
        size = int.from_bytes(table[:4], "little")
        self.units = array("I", table[4 : 4 + size])
        self.texts = table[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """End and text of the longest entry that starts at ``at``, or None."""
        units, found = self.units, None
        state = self._first(units[0])
        while at < len(data):
            state ^= data[at]
            if state >= len(units) or (unit := units[state]) & 0x800000FF != data[at]:
                break
            at += 1
            state ^= self._first(unit)
            if unit & 0x100:
                begin = units[state] & 0x7FFFFFFF
                found = at, self.texts[begin : self.texts.index(b"\0", begin)].decode()
        return found

    @staticmethod
    def _first(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Normaliser:
    """Text to the symbols that pieces spell. Sequential: each input has one path, so the composition with it is a chain.

    Its arcs read a user symbol (kept as it is), else the longest entry of the table, else one code point. States: ``START``, nothing but
    dropped spaces was read; ``INSIDE``; ``SPACES``, spaces were read whose one mark is written before the next symbol, if there is one.
    """

    START, INSIDE, SPACES = range(3)

    def __init__(self, spec, suffix: bool, user: list[str]):
        self.squeeze, self.mark = spec.remove_extra_whitespaces, SPACE if spec.escape_whitespaces else " "
        self.before, self.behind = ("" if suffix else self.mark, self.mark if suffix else "") if spec.add_dummy_prefix else ("", "")
        self.table = Rewriting(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.user = re.compile("|".join(re.escape(u) for u in sorted(user, key=len, reverse=True))) if user else None
        self.plain = self.table is None and self.user is None and not self.squeeze

    def rewritten(self, text: str) -> Iterator[str]:
        """What the arcs on the path of ``text`` write, before spaces are looked at."""
        if self.table is None and self.user is None:
            yield from text
            return
        data, at, place = text.encode("utf-8", "surrogatepass"), 0, 0
        while place < len(text):
            kept = self.user and self.user.match(text, place)
            found = None if kept or self.table is None else self.table.longest(data, at)
            if found:
                read, out = data[at : found[0]].decode("utf-8", "surrogatepass"), found[1]
            else:
                read = out = kept[0] if kept else text[place]
            yield out
            place, at = place + len(read), at + len(read.encode("utf-8", "surrogatepass"))

    def run(self, text: str, state: int = START) -> tuple[str, int]:
        """What the path of ``text`` from ``state`` writes, and the state where it ends."""
        if self.plain and state == self.INSIDE:  # arcs of single code points, each back to this state
            return text.replace(" ", self.mark), state
        out = []
        for unit in self.rewritten(text):
            if state == self.START and not self.squeeze:
                out.append(self.before)
                state = self.INSIDE
            for c in unit:
                if c == " " and self.squeeze:
                    state = state if state == self.START else self.SPACES
                    continue
                if state != self.INSIDE:
                    out.append(self.before if state == self.START else self.mark)
                    state = self.INSIDE
                out.append(self.mark if c == " " else c)
        return "".join(out), state

    def whole(self, text: str) -> str:
        """What the path of a whole text writes, with what its end adds or takes."""
        out, state = self.run(text)
        if self.squeeze:
            while out.endswith(self.mark):
                out = out[: -len(self.mark)]
        return out + self.behind if out else ""


class Pieces:
    """Symbols to pieces: a trie whose states are beginnings of pieces. The arc into a state that ends a piece may also lead back to the
    root, write the piece and weigh ``weights[piece]``. A symbol that is no piece has an arc from root to root, the fallback."""

    def __init__(self, ids: dict[str, int], weights: dict[int, float], fallback: float):
        self.ids, self.weights, self.fallback = ids, weights, fallback
        self.root: list = [{}, -1]  # arcs, piece that ends here
        for text, i in ids.items():
            state = self.root
            for c in text:
                state = state[0].setdefault(c, [{}, -1])
            state[1] = i


class Anything:
    """The one-state machine: any piece may follow any other."""

    start = -1
    arcs: dict[int, bool] = {}
    single = struct.Struct("f")

    def held(self, total: float) -> float:
        """In single precision, as the model's scores are."""
        return self.single.unpack(self.single.pack(total))[0]

    def next(self, state: int, piece: int) -> int | None:
        return -1


class Merging:
    """Sequences of pieces that merging leaves as they are.

    A state is the last piece, or -1 at the start and behind a symbol that is no piece. There is an arc to a piece if merging the two pieces'
    symbols gives just these two; whether it does is found when first asked and kept. Merging takes the best adjacent pair that is a piece,
    the leftmost among equals, until none is left.
    """

    start, KEPT = -1, 2_000_000
    held = None  # weights don't decide here

    def __init__(self, pieces: list[str], scores: list[float], ids: dict[str, int]):
        self.pieces, self.scores, self.ids = pieces, scores, ids
        self.arcs: dict[int, bool] = {}

    def next(self, state: int, piece: int) -> int | None:
        ok = self.arcs.get(state << 32 | piece)
        if ok is None:
            a, b = self.pieces[state] if state >= 0 else "", self.pieces[piece]
            ok = self.merged(a + b) == [x for x in (a, b) if x]
            if len(self.arcs) < self.KEPT:
                self.arcs[state << 32 | piece] = ok
        return piece if ok else None

    def merged(self, text: str) -> list[str]:
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (p := parts[i] + parts[j]) in self.ids:
                heapq.heappush(heap, (-self.scores[self.ids[p]], i, p))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, p = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= len(parts) or parts[i] + parts[j] != p:
                continue
            parts[i], parts[j], after[i] = p, None, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]


def shortest(chain: str, pieces: Pieces, follow: Anything | Merging) -> list[tuple[int, int, int]]:
    """(begin, end, piece) along the shortest path of ``chain`` composed with both machines; piece -1 is the fallback.

    States of the composition (place, trie state, state of ``follow``) are made as they are reached, those of one begin after another; arcs of
    ``follow`` that were asked for before are in ``follow.arcs``. Of paths of equal weight the one whose last piece began first is taken.
    """
    size = len(chain)
    # per place: state of ``follow`` -> (weight, begin of the last piece, state there, piece)
    reached: list[dict[int, tuple] | None] = [None] * (size + 1)
    reached[0] = {follow.start: (0.0, 0, follow.start, -1)}
    root, single, weights, arcs, ask, held = pieces.root, pieces.ids, pieces.weights, follow.arcs, follow.next, follow.held
    for at in range(size):
        if (here := reached[at]) is None:
            continue
        for state, path in here.items():
            # totals are compared as added and held as ``follow`` holds them
            weight, node, end = path[0] if held is None else held(path[0]), root, at
            while end < size and (node := node[0].get(chain[end])) is not None:
                end += 1
                if (piece := node[1]) < 0 or (ok := arcs.get(state << 32 | piece)) is False:
                    continue
                to = piece if ok else ask(state, piece)
                if to is None:
                    continue
                total = weight + weights[piece]
                if (there := reached[end]) is None:
                    reached[end] = {to: (total, at, state, piece)}
                elif to not in there or total < there[to][0]:
                    there[to] = (total, at, state, piece)
            if chain[at] not in single:
                total = weight + pieces.fallback
                there = reached[at + 1]
                if there is None:
                    reached[at + 1] = {-1: (total, at, state, -1)}
                elif -1 not in there or total < there[-1][0]:
                    there[-1] = (total, at, state, -1)
    out, at = [], size
    last = reached[size]
    state = min(last, key=lambda s: last[s][0])
    while at:
        _, begin, before, piece = reached[at][state]
        out.append((begin, at, piece))
        at, state = begin, before
    return out[::-1]
