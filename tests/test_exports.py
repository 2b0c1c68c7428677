"""Archives and partitioned exports, read back by others."""

import json
import random
import zipfile
import zlib
from collections import Counter

import pytest
from millrace.sources import archive, jsonio


def files():
    r = random.Random(4)
    out = [("index.html", b"<html>" * 50), ("empty.txt", b""), ("é/ü.json", '{"a": "ß"}'.encode()), ("null.bin", None), ("raw.bin", bytes(range(256)) * 9), ("lines.txt", b"\n\r\n\x00\xff\xfe" * 40)]
    return out + [(f"by_persona/{k:03}.jsonl", r.randbytes(r.randint(0, 900)) + b"x" * r.randint(0, 3000)) for k in range(60)]


@pytest.mark.parametrize("part", [1 << 27, 4000])
def test_archive_is_read_by_others(spark, tmp_path, monkeypatch, part):
    """In one part and in many; the order is by rank and path, members are whole, and the directory is right."""
    monkeypatch.setattr(archive, "PART", part)
    rows = [(p, c, 0 if "/" not in p else 2) for p, c in files()]
    site = spark.createDataFrame(rows, "relative_path string, content binary, rank int").repartition(5)
    told = archive.package(site, str(tmp_path / "site.zip")).collect()
    want = sorted((rank, p, c or b"") for p, c, rank in rows)
    with zipfile.ZipFile(tmp_path / "site.zip") as z:
        assert z.testzip() is None and [i.filename for i in z.infolist()] == [p for _, p, _ in want]
        assert [z.read(p) for _, p, _ in want] == [c for *_, c in want]
        assert [(r.relative_path, r.byte_size, r.compressed_size, r.crc32, r.offset) for r in told] == [(i.filename, i.file_size, i.compress_size, i.CRC, i.header_offset) for i in z.infolist()]
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["site.zip"]
    sums = archive.totals(spark.createDataFrame(told)).first()
    packed = sum(len(archive.deflate(c)) for *_, c in want)
    assert (sums.files, sums.bytes, sums.packed) == (len(rows), sum(len(c) for *_, c in want), packed) and abs(sums.savings - (1 - packed / sums.bytes)) < 1e-4


def test_empty_archive_and_repeated_paths(spark, tmp_path):
    none = spark.createDataFrame([], "relative_path string, content binary")
    assert archive.package(none, str(tmp_path / "none.zip")).collect() == [] and zipfile.ZipFile(tmp_path / "none.zip").namelist() == []
    twice = spark.createDataFrame([("a", b"one"), ("a", b"two")], "relative_path string, content binary")
    archive.package(twice, str(tmp_path / "twice.zip"))
    with zipfile.ZipFile(tmp_path / "twice.zip") as z:
        assert sorted(z.read(i) for i in z.infolist()) == [b"one", b"two"]


def test_long_forms_of_the_directory():
    entry = archive.directory_entry(b"a", 1, 3, zlib.crc32(b"x"), 5 << 32)
    assert entry.endswith((5 << 32).to_bytes(8, "little")) and archive.directory_end(70_000, 10, 20).startswith(b"PK\x06\x06") and archive.directory_end(3, 10, 20).startswith(b"PK\x05\x06")


def test_more_members_than_the_short_form_counts(tmp_path):
    """65,600 entries by hand, as another reader sees them."""
    data = bytearray()
    entries = bytearray()
    for k in range(65_600):
        body, packed, crc = archive.member(str(k).encode(), b"")
        entries += archive.directory_entry(str(k).encode(), 0, packed, crc, len(data))
        data += body + b"\n"
    (tmp_path / "many.zip").write_bytes(bytes(data) + entries + archive.directory_end(65_600, len(entries), len(data)))
    assert len(zipfile.ZipFile(tmp_path / "many.zip").namelist()) == 65_600


def test_one_pass_of_exports(spark, tmp_path):
    """One scan in the plan, counters of the same pass, a null key, a frequent key, and names that folders escape."""
    rows = [(f"i{k}", "hot" if k % 3 else ["a/b", "ü", None][k % 4 % 3], f"arch{k % 2}", "units", "train" if k % 10 else "val") for k in range(400)]
    cols = "id string, persona string, archetype string, category string, split string"
    spark.createDataFrame(rows, cols).write.parquet(str(tmp_path / "records"))
    records = spark.read.parquet(str(tmp_path / "records"))
    counters = jsonio.write_partitions(records, str(tmp_path / "out"))
    plan = jsonio.fanned(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    want = Counter()
    for _, persona, archetype, category, split in rows:
        want.update([("by_archetype", archetype), ("by_category", category)] + ([("by_persona", persona)] + ([("by_persona_train", persona)] if split == "train" else []) if persona else []))
    back = jsonio.read_partitions(spark, str(tmp_path / "out"), cols)
    assert {(r.export, r.key): r["count"] for r in back.groupBy("export", "key").count().collect()} == want
    by = Counter()
    for (export, _), n in want.items():
        by[export] += n
    assert counters == {"records": 400, **by}
    assert {json.dumps(tuple(r)) for r in back.where("export = 'by_category'").select(*cols.replace(" string", "").split(", ")).collect()} == {json.dumps(r) for r in rows}
