"""Turtle files as a table of triples: a Python data source with one partition per file."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "s string, p string, o string, o_kind string, datatype string, lang string, src string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD = "http://www.w3.org/2001/XMLSchema#"
TOKEN = re.compile(
    r"""\s*(?:\#[^\n]*\n?\s*)*(?:
    (?P<iri><[^>\s]*>)|(?P<text>\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|
    (?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)|(?P<number>[+-]?(?:[0-9]+\.[0-9]*|\.?[0-9]+)(?:[eE][+-]?[0-9]+)?(?=[\s;,.\])]))|
    (?P<blank>_:[\w-]+)|(?P<name>(?:[A-Za-z][\w.-]*)?:(?:[\w%-]|\.(?=[\w%-])|\\.)*|a(?=\s)|true\b|false\b|PREFIX\b|BASE\b|prefix\b|base\b)|(?P<mark>[.;,\[\]()]))""",
    re.VERBOSE | re.DOTALL,
)
ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


class TurtleError(ValueError):
    pass


def unescaped(s: str) -> str:
    if "\\" not in s:
        return s
    return re.sub(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else ESCAPES.get(m[3], m[3]), s)


def parse(text: str, src: str = "") -> Iterator[tuple]:
    """Triples of a document: prefixes, base, ``a``, lists by ``;`` and ``,``, literals with language or type, numbers, booleans, blank nodes and collections."""
    tokens, at = [], 0
    text = text.rstrip() + "\n"
    for m in iter(TOKEN.scanner(text).match, None):
        if m.end() == at:
            break
        tokens.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    if not re.fullmatch(r"\s*(?:#[^\n]*\n?\s*)*", text[at:]):
        raise TurtleError(f"unexpected {text[at : at + 20]!r}")
    ends = len(tokens)
    prefixes, base, fresh, i = {}, "", 0, 0
    out: list[tuple] = []

    def peek() -> tuple[str, str]:
        return tokens[i] if i < ends else ("end", "")

    def take() -> tuple[str, str]:
        nonlocal i
        i += 1
        if i > ends:
            raise TurtleError("the document ends within a statement")
        return tokens[i - 1]

    def expect(mark: str) -> None:
        if take()[1] != mark:
            raise TurtleError(f"{mark!r} is missing")

    def iri(kind: str, value: str) -> str:
        if kind == "iri":
            value = unescaped(value[1:-1])
            return value if re.match(r"[A-Za-z][\w+.-]*:", value) else base + value
        prefix, _, local = value.partition(":")
        if prefix not in prefixes:
            raise TurtleError(f"no prefix {prefix!r}")
        return prefixes[prefix] + (re.sub(r"\\(.)", r"\1", local) if "\\" in local else local)

    def blank() -> str:
        nonlocal fresh
        fresh += 1
        return f"_:{src}#{fresh}"

    def node() -> tuple[str, str, str | None, str | None]:
        """(value, kind, datatype, lang)"""
        kind, value = take()
        if kind in ("iri",) or kind == "name" and ":" in value:
            return iri(kind, value), "iri", None, None
        if kind == "blank":
            return value, "blank", None, None
        if kind == "number":
            return value, "literal", XSD + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer"), None
        if kind == "name" and value in ("true", "false"):
            return value, "literal", XSD + "boolean", None
        if kind == "text":
            cut = 3 if value[:3] in ('"""', "'''") else 1
            value = unescaped(value[cut:-cut])
            if peek()[0] == "lang":
                return value, "literal", None, take()[1][1:].lower()
            if peek()[0] == "type":
                take()
                return value, "literal", iri(*take()), None
            return value, "literal", XSD + "string", None
        if value == "[":
            b = blank()
            if peek()[1] != "]":
                properties(b)
            expect("]")
            return b, "blank", None, None
        if value == "(":
            first = last = None
            rdf = TYPE[: -len("type")]
            while peek()[1] != ")":
                b = blank()
                if last:
                    out.append((last, rdf + "rest", b, "blank", None, None, src))
                out.append((b, rdf + "first", *node(), src))
                first, last = first or b, b
            take()
            if last:
                out.append((last, rdf + "rest", rdf + "nil", "iri", None, None, src))
            return (first, "blank", None, None) if first else (rdf + "nil", "iri", None, None)
        raise TurtleError(f"unexpected {value!r}")

    def properties(subject: str) -> None:
        while True:
            kind, value = take()
            p = TYPE if value == "a" else iri(kind, value)
            while True:
                out.append((subject, p, *node(), src))
                if peek()[1] != ",":
                    break
                take()
            while peek()[1] == ";":
                take()
            if peek()[1] in (".", "]") or peek()[0] == "end":
                return

    while i < ends:
        kind, value = peek()
        if value.lower() in ("@prefix", "prefix"):
            take()
            name = take()[1].partition(":")[0]
            prefixes[name] = iri(*take())
            if value[0] == "@":
                expect(".")
        elif value.lower() in ("@base", "base"):
            take()
            base = iri(*take())
            if value[0] == "@":
                expect(".")
        else:
            lone = value == "["
            subject = node()[0]
            if not (lone and peek()[1] == "."):
                properties(subject)
            expect(".")
    return iter(out)


class FilePart(InputPartition):
    def __init__(self, path: str):
        self.path = path


class TurtleReader(DataSourceReader):
    """Reads files on a file system that all executors mount; ``triples`` below reads any store through Spark."""

    def __init__(self, options: dict):
        self.pattern, self.skip_bad = options["path"], options.get("skipBad", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        import glob
        import os

        pattern = os.path.join(self.pattern, "*.ttl") if os.path.isdir(self.pattern) else self.pattern
        return [FilePart(p) for p in sorted(glob.glob(pattern))] or [FilePart("")]

    def read(self, partition: FilePart) -> Iterator[tuple]:
        if partition.path:
            with open(partition.path, encoding="utf-8") as f:
                text = f.read()
            try:
                yield from parse(text, partition.path.rsplit("/", 1)[-1])
            except TurtleError:
                if not self.skip_bad:
                    raise


class TurtleSource(DataSource):
    """``spark.read.format("turtle").load(folder)`` after ``spark.dataSource.register(TurtleSource)``."""

    @classmethod
    def name(cls) -> str:
        return "turtle"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TurtleReader:
        return TurtleReader(self.options)


def triples(spark: SparkSession, path: str, skip_bad: bool = True) -> DataFrame:
    """Triples of all Turtle files under a path of any store; files that can't be parsed are skipped unless asked otherwise."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("src"))
    return triples_of(files, skip_bad)


def triples_of(files: DataFrame, skip_bad: bool = True) -> DataFrame:
    """Triples of rows (value, src)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, src in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows += parse(text, src)
                except TurtleError:
                    if not skip_bad:
                        raise
            columns = zip(*rows, strict=True) if rows else [()] * len(NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=NAMES)

    return files.select("value", "src").mapInArrow(run, SCHEMA)
