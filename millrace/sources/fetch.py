"""Sources that are fetched: files over HTTP into a folder that Spark reads, and rows of a REST service.

A fetcher gets an address and headers and returns bytes; without a network, ``offline`` stands in for it and raises.
"""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import records
from . import entities

Fetcher = Callable[[str, dict[str, str]], bytes]


@dataclass(frozen=True)
class Source:
    """A file by its name in the landing folder, where it is fetched, and what form of it is wanted."""

    name: str
    url: str
    accept: str = "*/*"


#: Public graphs of SI units and of unit vocabularies.
SI_BASE = "https://raw.githubusercontent.com/TheBIPM/SI_Digital_Framework/main/knowledge_graphs/SI_Reference_Point"
SI = tuple(Source(f, f"{SI_BASE}/{f}") for f in ("si.ttl", "units.ttl", "constants.ttl", "prefixes.ttl"))
VOCABULARIES = tuple(Source(f"{x}.ttl", f"https://qudt.org/2.1/vocab/{x}", "text/turtle") for x in ("unit", "quantitykind", "dimensionvector", "prefix"))


def offline(url: str, headers: dict[str, str]) -> bytes:
    raise ConnectionError(f"no network: {url}")


def over_http(url: str, headers: dict[str, str]) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=45) as answer:
        return answer.read()


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a small file to any store that Spark reads: whole under another name, then renamed."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, part = make(path), make(path + ".part")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = store.create(part, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    store.delete(target, False)
    if not store.rename(part, target):
        raise OSError(f"{path} was not written")


def download(spark: SparkSession, sources: Iterable[Source], to: str, fetcher: Fetcher = offline) -> tuple[list[str], dict[str, str]]:
    """Paths of what was fetched, and by name why the others were not; one failure does not stop the rest."""
    done, failed = [], {}
    for s in sources:
        try:
            put(spark, f"{to}/{s.name}", fetcher(s.url, {"Accept": s.accept}))
            done.append(f"{to}/{s.name}")
        except Exception as e:  # noqa: BLE001  a fetcher may raise anything; the caller sees it
            failed[s.name] = str(e)
    return done, failed


def ensure(spark: SparkSession, sources: Iterable[Source], to: str, fetcher: Fetcher = offline) -> tuple[list[str], dict[str, str]]:
    """Fetches those of ``sources`` that are not in the folder yet."""
    sources = list(sources)
    found = records.present(spark, [f"{to}/{s.name}" for s in sources])
    return download(spark, [s for s in sources if not found[f"{to}/{s.name}"]], to, fetcher)


def constants_of_year(spark: SparkSession, service: str, year: int, to: str, fetcher: Fetcher = offline) -> DataFrame | None:
    """Constants of a REST service that answers with a JSON array, by way of a file; None if it does not answer."""
    done, _ = download(spark, [Source(f"constants-{year}.json", f"{service}?year={year}", "application/json")], to, fetcher)
    return entities.constants_from_json(spark, done[0], year) if done else None
