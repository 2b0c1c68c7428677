"""ZIP archives made by tasks: members are deflated where they lie, and only the directory passes through the driver.

Members are dealt by ranges of their order, about ``PART`` bytes a part. A task deflates its members, checks that they inflate to the same bytes, and writes them once; their
places follow from sums of sizes within parts and over parts. Each part is then one file of the store, in which a line feed follows each member (readers
find members by the directory, so bytes between them do no harm), and the store joins the parts and the directory to one file. A store that cannot
join files is read and written through the driver's stream, a buffer at a time.

Cases: a member is a row, so smaller than 2 GB; archives beyond 4 GB or 65,535 members get the long forms of the directory; a null content is empty; a path that repeats is a
member each time; an empty site is an empty archive; all times are 1980-01-01, so equal sites give equal archives.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.selection import written

PART = 128 << 20
MEMBERS = "rank int, relative_path string, byte_size long, compressed_size long, crc32 long, entry binary"
#: Fixed values of the format: marks of a member, a directory entry and the directory's ends; versions, flags (UTF-8 names), method (deflate), time and date.
MEMBER, ENTRY, END, END_64, LOCATE_64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
PLAIN, LONG, UTF8, DEFLATE, TIME, DATE = 20, 45, 0x800, 8, 0, 0x21
FULL_16, FULL_32 = 0xFFFF, 0xFFFFFFFF


def deflate(content: bytes) -> bytes:
    press = zlib.compressobj(9, zlib.DEFLATED, -15)
    out = press.compress(content) + press.flush()
    if zlib.decompress(out, -15) != content:
        raise ValueError("a member does not inflate to what was deflated")
    return out


def member(name: bytes, content: bytes) -> tuple[bytes, int, int]:
    """Header and data of a member, with the data's size and checksum."""
    data, crc = deflate(content), zlib.crc32(content)
    return struct.pack("<IHHHHHIIIHH", MEMBER, PLAIN, UTF8, DEFLATE, TIME, DATE, crc, len(data), len(content), len(name), 0) + name + data, len(data), crc


def directory_entry(name: bytes, size: int, packed: int, crc: int, offset: int) -> bytes:
    far = offset >= FULL_32
    extra = struct.pack("<HHQ", 1, 8, offset) if far else b""
    return struct.pack("<IHHHHHHIIIHHHHHII", ENTRY, LONG if far else PLAIN, LONG if far else PLAIN, UTF8, DEFLATE, TIME, DATE, crc, packed, size, len(name), len(extra), 0, 0, 0, 0, FULL_32 if far else offset) + name + extra


def directory_end(count: int, size: int, offset: int) -> bytes:
    out = b""
    if count >= FULL_16 or size >= FULL_32 or offset >= FULL_32:
        out = struct.pack("<IQHHIIQQQQ", END_64, 44, LONG, LONG, 0, 0, count, count, size, offset) + struct.pack("<IIQI", LOCATE_64, 0, offset + size, 1)
    return out + struct.pack("<IHHHHIIH", END, 0, 0, min(count, FULL_16), min(count, FULL_16), min(size, FULL_32), min(offset, FULL_32), 0)


def deflated(site: DataFrame) -> DataFrame:
    """The members of a site (relative_path, content, and a rank if it has one): sizes, checksum and the bytes of their entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a batch of its own for each, as it may be large
                rank, path, content = (batch.column(c)[k].as_py() for c in range(3))
                entry, packed, crc = member(path.encode(), content or b"")
                cols = [pa.array([rank], pa.int32()), pa.array([path]), *[pa.array([x], pa.int64()) for x in (len(content or b""), packed, crc)], pa.array([entry], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["rank", "relative_path", "byte_size", "compressed_size", "crc32", "entry"])

    rank = F.col("rank").cast("int") if "rank" in site.columns else F.lit(0)
    return site.select(rank.alias("rank"), "relative_path", F.col("content").cast("binary").alias("content")).mapInArrow(run, MEMBERS)


def placed(site: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their part, written once, and the directory: part, rank, relative_path, sizes, crc32 and offset."""
    total = site.agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0))).first()[0]
    parts = max(1, -(-total // PART))
    by_order = site.repartitionByRange(parts, *[c for c in ("rank", "relative_path") if c in site.columns])
    members = written(deflated(by_order).withColumn("part", F.spark_partition_id()))
    long = F.octet_length("entry").cast("long") + 1
    inside = Window.partitionBy("part").orderBy("rank", "relative_path", "crc32", "byte_size").rowsBetween(Window.unboundedPreceding, 0)  # a part is of bounded size
    told = members.select("part", "rank", "relative_path", "byte_size", "compressed_size", "crc32", long.alias("long")).withColumn("upto", F.sum("long").over(inside))
    starts = told.groupBy("part").agg(F.sum("long").alias("all"))
    starts = starts.withColumn("start", F.sum("all").over(Window.orderBy("part")) - F.col("all"))  # a row per part
    directory = told.join(F.broadcast(starts.select("part", "start")), "part").withColumn("offset", F.col("start") + F.col("upto") - F.col("long"))
    return members, directory.select("part", "rank", "relative_path", "byte_size", "compressed_size", "crc32", "offset")


def joined_by_store(spark: SparkSession, parts: list[str], target: str) -> None:
    """The files one behind the other as ``target``; they are gone afterwards."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    make, conf = hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    store, first, to = make(target).getFileSystem(conf), make(parts[0]), make(target)
    store.delete(to, False)
    rest = spark.sparkContext._gateway.new_array(make, len(parts) - 1)
    for k, p in enumerate(parts[1:]):
        rest[k] = make(p)
    try:
        store.concat(first, rest)
        if not store.rename(first, to):
            raise OSError(f"{target} was not written")
    except UnsupportedOperationException:  # a store that cannot join
        out = store.create(to, True)
        try:
            for p in parts:
                source = store.open(make(p))
                hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                source.close()
        finally:
            out.close()


def package(site: DataFrame, target: str) -> DataFrame:
    """Writes the ZIP of a site (relative_path, content, and rank for the order); returns its directory, in order."""
    spark = site.sparkSession
    members, directory = placed(site)
    directory = written(directory)
    held = f"{target}.parts-{uuid.uuid4().hex}"
    order = ["part", "rank", "relative_path", "crc32", "byte_size"]
    n = max(1, directory.agg(F.count_distinct("part")).first()[0])
    rows = members.repartition(n, "part").sortWithinPartitions(*order)
    rows.select(F.col("entry").cast("string").alias("entry"), "part").write.partitionBy("part").option("lineSep", "\n").text(held)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    store = hadoop.Path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, start = [], 0
    for r in directory.groupBy("part").agg(F.sum(F.col("compressed_size") + F.octet_length("relative_path") + 31).alias("size")).orderBy("part").collect():
        [found] = [f for f in store.listStatus(hadoop.Path(f"{held}/part={r['part']}")) if f.getPath().getName().startswith("part-")]
        if found.getLen() != r["size"]:
            raise OSError(f"{found.getPath()} has {found.getLen()} bytes, not {r['size']}")
        files.append(found.getPath().toString())
        start += r["size"]
    end = store.create(hadoop.Path(f"{held}/directory"), True)
    count = size = 0
    for r in directory.orderBy("offset").toLocalIterator():
        entry = directory_entry(r["relative_path"].encode(), r["byte_size"], r["compressed_size"], r["crc32"], r["offset"])
        end.write(bytearray(entry))
        count, size = count + 1, size + len(entry)
    end.write(bytearray(directory_end(count, size, start)))
    end.close()
    joined_by_store(spark, [*files, f"{held}/directory"], target)
    store.delete(hadoop.Path(held), True)
    return directory.drop("part").orderBy("offset")


def totals(directory: DataFrame) -> DataFrame:
    """files, bytes, packed, and savings: the share of bytes that packing spares."""
    out = directory.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("byte_size"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("compressed_size"), F.lit(0)).alias("packed"))
    return out.withColumn("savings", F.coalesce(F.round(1 - F.try_divide("packed", "bytes"), 4), F.lit(0.0)))
