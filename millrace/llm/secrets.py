"""Secret scanning with a trigram inverted index.

Method: each rule's regex is turned into a Boolean query over trigrams that any match must contain. A shard (one
batch of documents) gets an inverted index: postings of the trigrams that the queries name, over its case-folded bytes. A
query's postings are intersected and united, and only the documents left are verified with the regex. A rule
whose regex forces no trigram scans every document. Shards are independent, so nothing is shuffled.

Cases: a null text is empty; a null id stays null; repeated rows are scanned again; an empty table gives an empty
result; extra columns are ignored or, by ``redact``, kept as they are. Offsets count code points.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import small_batches

#: Most strings that stand for one part of a regex; beyond that, the part only forces what its prefixes and suffixes do.
EXACT = 24
#: Bytes of the texts of a shard (one text, if it is longer); its index takes eight times as much on texts of check_l.
SHARD = 1_000_000

# A trigram query: None (no restriction), a trigram as bytes, or ("and" | "or", parts).


def _join(op: str, parts: list) -> object:
    if op == "or":
        if any(p is None for p in parts):
            return None
    else:
        parts = [p for p in parts if p is not None]
    flat: list = []
    for p in parts:
        flat += p[1] if isinstance(p, tuple) and p[0] == op else [p]
    flat = list(dict.fromkeys(flat))
    return None if not flat else flat[0] if len(flat) == 1 else (op, tuple(flat))


def _of_string(s: str) -> object:
    b = s.encode()
    return _join("and", [b[i : i + 3] for i in range(len(b) - 2)])


def _of_strings(strings: frozenset[str]) -> object:
    return _join("or", [_of_string(s) for s in sorted(strings)])


@dataclass
class _Info:
    """What is known of a part of a regex: all its strings if few, else what its matches must contain."""

    exact: frozenset[str] | None
    query: object

    def forced(self) -> object:
        return self.query if self.exact is None else _of_strings(self.exact)


def trigram_query(pattern: str, flags: int = 0) -> object:
    """The Boolean trigram query, over lower-case ASCII text, of a Python regex."""
    parser, const = re._parser, re._constants

    def sequence(items) -> _Info:
        run, known = frozenset({""}), []
        whole = True
        for op, arg in items:
            info = node(op, arg)
            if info.exact is not None and len(run) * len(info.exact) <= EXACT:
                run = frozenset(a + b for a in run for b in info.exact)
                continue
            known += [_of_strings(run), info.forced()]
            whole, run = False, info.exact if info.exact is not None else frozenset({""})
        if whole:
            return _Info(run, None)
        return _Info(None, _join("and", [*known, _of_strings(run)]))

    def node(op, arg) -> _Info:
        if op == const.LITERAL:
            return _Info(frozenset({chr(arg).lower()}), None) if arg < 128 else _Info(None, None)
        if op == const.IN:
            chars: set[str] = set()
            for kind, x in arg:
                if kind == const.LITERAL and x < 128:
                    chars.add(chr(x).lower())
                elif kind == const.RANGE and x[1] < 128 and x[1] - x[0] < 8:
                    chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return _Info(None, None)
            return _Info(frozenset(chars), None) if len(chars) <= 8 else _Info(None, None)
        if op == const.SUBPATTERN:
            return sequence(arg[3])
        if op == const.BRANCH:
            infos = [sequence(x) for x in arg[1]]
            if all(i.exact is not None for i in infos) and len(all_ := frozenset().union(*[i.exact for i in infos])) <= EXACT:
                return _Info(all_, None)
            return _Info(None, _join("or", [i.forced() for i in infos]))
        if op in (const.MAX_REPEAT, const.MIN_REPEAT, const.POSSESSIVE_REPEAT):
            least, most, body = arg
            info = sequence(body)
            if most == 1 and info.exact is not None:
                return _Info(info.exact | {""}, None) if least == 0 else info
            if least == most and info.exact is not None and len(info.exact) ** least <= EXACT:
                out = frozenset({""})
                for _ in range(least):
                    out = frozenset(a + b for a in out for b in info.exact)
                return _Info(out, None)
            return _Info(None, info.forced() if least else None)
        if op == const.AT:
            return _Info(frozenset({""}), None)
        return _Info(None, None)

    return sequence(parser.parse(pattern, flags)).forced()


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` that pass ``test`` are secrets; leftmost, non-overlapping."""

    kind: str
    pattern: str
    test: Callable[[re.Match], bool] = lambda m: True
    flags: int = re.ASCII

    @property
    def query(self) -> object:
        return trigram_query(self.pattern, self.flags)


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the same as runs [0-9a-f]+ of which those under 24 fail: a run is taken whole
)
#: What the method finds besides: well-known public token formats.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _trigrams(query: object) -> set[bytes]:
    return set() if query is None else {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class Scanner:
    """Rules with their compiled regexes and queries, and the trigrams that the queries name.

    A trigram is looked up by its last two bytes first, as a table of all trigrams would take 32 MB in each worker.
    """

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, r.flags), r.query) for r in rules]
        self.grams = sorted(set().union(*[_trigrams(q) for _, _, q in self.rules]))
        self.codes = np.array([int.from_bytes(g, "big") for g in self.grams], np.uint32)
        self.ends = np.zeros(1 << 16, bool)
        self.ends[self.codes & 0xFFFF] = True
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def index(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        """Postings: numbers of the shard's documents that hold a trigram."""
        size = np.array([len(t) + 1 for t in texts])
        data = self.fold[np.frombuffer(b"\0".join(texts) + b"\0\0\0", np.uint8)].astype(np.uint16)
        ends = (data[1:-1] << 8) | data[2:]
        at = np.flatnonzero(self.ends[ends])
        code = data[at].astype(np.uint32) << 16 | ends[at]
        found = np.searchsorted(self.codes, code)
        named = np.flatnonzero(np.append(self.codes, 0)[found] == code) if self.grams else found[:0]
        doc = np.searchsorted(np.cumsum(size), at[named], side="right")
        both = np.unique(found[named].astype(np.int64) << 32 | doc)
        grams, docs = both >> 32, both & 0xFFFFFFFF
        cut = np.searchsorted(grams, np.arange(len(self.grams) + 1))
        return {g: docs[cut[k] : cut[k + 1]] for k, g in enumerate(self.grams)}

    def candidates(self, query: object, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if query is None:
            return np.arange(n)
        if isinstance(query, bytes):
            return postings[query]
        op, parts = query
        out = self.candidates(parts[0], postings, n)
        for p in parts[1:]:
            out = (np.intersect1d if op == "and" else np.union1d)(out, self.candidates(p, postings, n))
        return out

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule number, end), by start and then rule."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        step = 0
        while step < len(texts):
            last, total = step, 0
            while last < len(texts) and (last == step or total < SHARD):
                total += len(texts[last])
                last += 1
            shard = texts[step:last]
            postings = self.index(shard)
            decoded: dict[int, str] = {}
            for k, (rule, regex, query) in enumerate(self.rules):
                for d in self.candidates(query, postings, len(shard)).tolist():
                    if query is None and not self._worth(rule, shard[d]):
                        continue
                    if d not in decoded:
                        decoded[d] = shard[d].decode("utf-8", "replace")
                    out[step + d] += [(m.start(), k, m.end()) for m in regex.finditer(decoded[d]) if rule.test(m)]
            step = last
        for spans in out:
            spans.sort()
        return out

    @staticmethod
    def _worth(rule: Rule, text: bytes) -> bool:
        """A scan of the bytes; for plain ASCII rules it says whether any match passes, and spares decoding the rest."""
        regex = _on_bytes(rule.pattern, rule.flags)
        return any(rule.test(m) for m in regex.finditer(text))


@lru_cache(maxsize=64)
def _on_bytes(pattern: str, flags: int) -> re.Pattern:
    return re.compile(pattern.encode(), flags & ~re.ASCII)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id and spans ``array<struct<kind, start, end>>`` (code points, end exclusive), per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner(rules)
        for batch in batches:
            found = s.scan([t or b"" for t in batch.column(1).to_pylist()])
            spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "spans"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None, mark: str = "[SECRET]", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``docs`` with each secret in the text replaced by ``mark``, and the text's length anew where it changed; rows without one are untouched."""
    names, at = docs.columns, docs.columns.index(text_col)
    length_at = names.index(length_col) if length_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner(rules)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = s.scan([(t or "").encode() for t in texts])
            lengths = batch.column(length_at).to_pylist() if length_at is not None else None
            for i, spans in enumerate(found):
                if spans:
                    parts, last = [], 0
                    for a, _, b in spans:
                        if a >= last:
                            parts += [texts[i][last:a], mark]
                        last = max(last, b)
                    texts[i] = "".join(parts) + texts[i][last:]
                    if lengths is not None:
                        lengths[i] = len(texts[i])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            if lengths is not None:
                columns[length_at] = pa.array(lengths, columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
