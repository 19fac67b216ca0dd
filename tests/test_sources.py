"""CSV records over splits, ZIP members and checksums."""

import csv
import hashlib
import io
import random
import tracemalloc
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardline.sources import archives, extracts, files, records

FIELDS = ["", "a", "b,c", "two\nlines", 'q"uote', "\n", '"', "x\r\ny", "é", " ", '5" pipe', '"",\n"', "end"]


def rows(count, seed, width=3):
    rng = random.Random(seed)
    return [[f"{k}", *(rng.choice(FIELDS) for _ in range(width - 1))] for k in range(count)]


def as_csv(table, header, end="\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    writer.writerows(table)
    return out.getvalue()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(FIELDS), min_size=2, max_size=4), min_size=1, max_size=6))
def test_records_of_a_stream(table):
    text = as_csv(table, ["h", "i"])
    found = list(records.whole_records(text.removesuffix("\n").split("\n")))
    assert len(found) == len(table) + 1
    assert [next(csv.reader(io.StringIO(r, newline=""))) for r in found[1:]] == table


@pytest.mark.parametrize(
    "line, inside, after",
    [
        ("a,b", False, False), ("a,b", True, True), ('a,"b', False, True), ('b",c', True, False), ('b"",c', True, True),
        ('5" pipe,x', False, False), ('5" pipe,"x', False, True), ('"a"x,"b', False, True), ('""', False, False), ('"', True, False),
        ('a","b', True, True), ('"a""', False, True), ("", True, True),
    ],
)
def test_state_behind_a_line(line, inside, after):
    assert records.ends_inside(line, inside) == after


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_splits_do_not_change_the_rows(spark, tmp_path, end):
    """Splits of 64 KB over files with breaks, and one field longer than several splits."""
    tables = {"a.csv": rows(4000, 1), "b c.csv": rows(3000, 2), "none.csv": [[str(k), "x", "y"] for k in range(9000)]}
    tables["a.csv"][100][1] = "long\n" * 60_000
    tables["a.csv"][101][2] = 'tail\n"'
    for name, table in tables.items():
        (tmp_path / name).write_bytes(as_csv(table, ["id", "one", "two"], end).encode())
    (tmp_path / "other.csv").write_bytes(as_csv([["1", "z"]], ["id", "thr\nee"], end).encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "bare.csv").write_bytes(b"id,one,two\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = extracts.read_csv_text(spark, extracts.list_files(spark, str(tmp_path), ".csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    def blank(x):
        return None if x in ("", None) else x

    by_file = {}
    for r in sorted(found, key=lambda r: (r["_file"], r["_block"], r["_line"])):
        by_file.setdefault(r["_file"], []).append(r)
    for name, table in tables.items():
        mine = [[r.id, r.one, r.two] for r in by_file[name]]
        assert len(mine) == len(table)
        # The JVM parser reads a carriage return in a field as a line feed.
        wanted = [[blank(x.replace("\r\n", "\n")) for x in row] for row in table]
        assert [[blank((x or "").replace("\r\n", "\n")) for x in row] for row in mine] == wanted
    assert [(r.id, r["thr\nee"]) for r in by_file["other.csv"]] == [("1", "z")]
    assert set(by_file) == {*tables, "other.csv"}


def test_a_field_that_never_closes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,one\n1,a\n2,"open\nto the end\n')
    found = extracts.read_csv_text(spark, [str(tmp_path / "x.csv")]).collect()
    assert sorted(r.id for r in found) == ["1", "2"]


def test_many_files_take_two_passes(spark, tmp_path):
    for k in range(100):
        (tmp_path / f"f{k:03d}.csv").write_text(f'id,one\n{k},"a\nb"\n')
    paths = sorted(str(p) for p in tmp_path.glob("*.csv"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "two passes")
    try:
        raw = extracts.read_csv_text(spark, paths)
        before = len(tracker.getJobIdsForGroup("headers"))
        found = raw.collect()
        after = len(tracker.getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(int(r.id) for r in found) == list(range(100)) and {r.one for r in found} == {"a\nb"}
    # Two listings of many paths, the header pass as a map and a reduce job; then the rows.
    assert before <= 4 and after - before <= 1


# --- archives --------------------------------------------------------------------------


def test_members_stream_in_bounded_memory(tmp_path):
    path = tmp_path / "large.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("big.csv", "w") as member:
        member.write(b"id,text\n")
        for k in range(400):
            member.write(b"".join(b"%d,%s\n" % (k * 1000 + i, b"x" * 150) for i in range(1000)))
    reader = archives.ZipRecordReader([(str(path), "big.csv")])
    tracemalloc.start()
    count = sum(b.num_rows for b in reader.read(reader.partitions()[0]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 400_000 and peak < 24 << 20 < 400_000 * 150


def test_one_partition_per_member_and_quoted_breaks(spark, tmp_path):
    paths = []
    for k in range(3):
        paths.append(str(tmp_path / f"z{k}.zip"))
        with zipfile.ZipFile(paths[-1], "w") as z:
            z.writestr("notes.txt", "no")
            z.writestr("first.csv", as_csv([[f"{k}", "two\nlines", "café"]], ["id", "one", "two"], "\r\n").encode("latin-1"))
            z.writestr("second.csv", "id\nnot read\n")
    members = archives.csv_members(spark, paths)
    assert [(m.member, m.place) for m in members] == [("first.csv", 0), ("second.csv", 1)] * 3
    every = archives.read_members(spark, [(m.path, m.member) for m in members])
    assert every.rdd.getNumPartitions() == 6 and every.count() == 6
    found = extracts.read_zip_text(spark, paths).collect()
    assert sorted((r.id, r.one, r.two, r["_line"]) for r in found) == [(f"{k}", "two\nlines", "café", 0) for k in range(3)]


def test_archive_without_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("readme.txt", "no")
    with pytest.raises(ValueError, match="a.zip"):
        extracts.read_zip_text(spark, [str(tmp_path / "a.zip")])


# --- checksums -------------------------------------------------------------------------


def test_digest_is_streamed():
    content = bytes(range(256)) * 1000

    class Counted(io.BytesIO):
        asked = []

        def read(self, size=-1):
            self.asked.append(size)
            return super().read(size)

    assert files.digest(Counted(content), 1000) == hashlib.sha256(content).hexdigest()
    assert set(Counted.asked) == {1000}


def test_a_file_over_two_gigabytes(spark, tmp_path):
    """A sparse file: larger than a cell of a table may be."""
    size = (2 << 30) + 4096
    with open(tmp_path / "big.csv", "wb") as out:
        out.truncate(size)
    (tmp_path / "small.csv").write_text("x")
    (tmp_path / "other.csv").write_text("y")
    whole, zeros = hashlib.sha256(), bytes(1 << 20)
    for _ in range(size >> 20):
        whole.update(zeros)
    whole.update(bytes(size & ((1 << 20) - 1)))
    manifest = spark.createDataFrame(
        [("big.csv", whole.hexdigest().upper()), ("small.csv", hashlib.sha256(b"z").hexdigest())], "file_name string, sha256 string"
    )
    found = extracts.verify_checksums(spark, str(tmp_path), manifest)
    assert {r.file_name: r.status for r in found.collect()} == {"big.csv": "ok", "small.csv": "mismatch", "other.csv": "skipped"}


def test_digests_of_nothing(spark, tmp_path):
    (tmp_path / "d").mkdir()
    assert files.file_digests(spark, str(tmp_path / "d")).count() == 0


def test_store_names_map_to_the_clients(monkeypatch):
    asked = []

    class Client:
        class FileSystem:
            @staticmethod
            def from_uri(uri):
                asked.append(uri)
                return Client, "bucket/k.csv"

        @staticmethod
        def open_input_file(path):
            return path

    monkeypatch.setattr(files, "arrow_fs", Client)
    assert files.open_stream("s3a://bucket/k.csv") == "bucket/k.csv" and asked == ["s3://bucket/k.csv"]
