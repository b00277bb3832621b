"""Files in one piece written by several tasks, their hashes, and the scans that read them."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from folioworks.errors import ExportError
from folioworks.plans import files
from folioworks.sources import ivtff, sinks
from folioworks.sources.ordered import digest_of_lines, write_lines
from folioworks.sources.shared import splits_of, stored


def test_one_file_of_many_parts(spark, tmp_path):
    rows = spark.range(5000).select("id", F.concat(F.lit("é "), F.col("id") * 7919 % 5000).alias("text")).repartition(7)
    path = str(tmp_path / "new" / "x.txt")
    write_lines(rows, F.col("text"), path, F.col("id").desc(), lines=300)
    want = "".join(f"é {i * 7919 % 5000}\n" for i in reversed(range(5000))).encode()
    assert open(path, "rb").read() == want
    assert os.listdir(tmp_path / "new") == ["x.txt"] or set(os.listdir(tmp_path / "new")) == {"x.txt", ".x.txt.crc"}
    got = digest_of_lines(spark, path).first()
    assert (got.sha256, got.n_bytes, got.n_lines) == (hashlib.sha256(want).hexdigest(), len(want), 5000)
    # Written again, over the old one.
    write_lines(rows.limit(0), F.col("text"), path)
    assert open(path, "rb").read() == b"" and digest_of_lines(spark, path).first().sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("data", [b"a\r\nb\n\xff\xfe\n\n", b"no end", b"\n", b"a\n\nb"])
def test_digest_of_any_bytes(spark, tmp_path, data):
    (tmp_path / "f").write_bytes(data)
    got = digest_of_lines(spark, str(tmp_path / "f")).first()
    assert (got.sha256, got.n_bytes) == (hashlib.sha256(data).hexdigest(), len(data))


def test_digest_over_splits(spark, tmp_path):
    data = b"".join(b"%d %s\n" % (i, b"x" * (i % 90)) for i in range(4000))[:-1]
    (tmp_path / "f").write_bytes(data)
    with splits_of(spark, 10_000):
        assert digest_of_lines(spark, str(tmp_path / "f")).first().sha256 == hashlib.sha256(data).hexdigest()


def test_scan_of_splits_without_a_final_line_feed(spark, tmp_path):
    lines = ["#=IVTFF Eva- 2.0", "# c", "<f1r> <! $Q=A>", *(f"<f1r.{i},@P0;H> qo.{'da' * (i % 20)}iin" for i in range(1, 900)), "<f2v>", "<f2v.1,@P0;H> last"]
    data = "\r\n".join(lines).encode().replace(b"# c", b"# \xff")
    (tmp_path / "t.txt").write_bytes(data)
    with splits_of(spark, 5000):
        read = stored(ivtff.read_lines(spark, str(tmp_path / "t.txt")))
    assert read.select("split").distinct().count() > 3
    assert [r.line for r in read.orderBy("line_no").collect()] == [x.replace("# c", "# �") for x in lines]
    loci = ivtff.loci(read).orderBy("line_no").collect()
    assert [r.line_index for r in loci] == [*range(1, 900), 1] and loci[-1].text == "last" and {r.page_ord for r in loci} == {1, 2}


def test_failing_writes(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(ExportError):
        sinks.write_canonical_jsonl(spark.range(3), str(tmp_path / "file" / "x.jsonl"), "id")


def test_volume_digests(spark):
    sf = "/root/testdata/sf0.001"
    for path in files.volumes(spark, sf):
        local = path.removeprefix("file:")
        assert digest_of_lines(spark, path).first().sha256 == hashlib.sha256(open(local, "rb").read()).hexdigest()



def test_no_task_copies_or_reads_a_whole_file(spark, tmp_path, monkeypatch):
    """Parts go to their places each by itself, sizes need no ordered scan, and splits do not grow in number with the file."""
    from folioworks.sources import ordered

    def whole(*_):
        raise AssertionError("a whole file in one task")

    monkeypatch.setattr(ordered, "lines_in_order", whole)
    path = str(tmp_path / "a b%20é" / "x.txt")
    write_lines(spark.range(1000), F.col("id"), path, "id", lines=100)
    want = "".join(f"{i}\n" for i in range(1000)).encode()
    assert open(path, "rb").read() == want
    path = str(tmp_path / "plain.txt")
    write_lines(spark.range(1000), F.col("id"), path, "id", lines=100)
    got = ordered.size_of_lines(spark, path).first()
    assert (got.n_bytes, got.n_lines) == (len(want), 1000)
    assert all(r.n_lines > 0 and r.n_bytes > 0 for r in files.file_sizes(spark, "/root/testdata/sf0.001").collect())
    files.mismatch_jsonl(spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(files, "PIECES", 8)
    lines = files.lines_of_volumes(spark, "/root/testdata/sf0.001")
    assert lines.select("file", "split").distinct().count() <= 11


def test_lines_stay_where_they_are_read(spark, tmp_path):
    """Numbering the lines of splits shuffles no line, though nothing says that a file is small."""
    (tmp_path / "t.txt").write_bytes(b"".join(b"line %d\n" % i for i in range(5000)))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        with splits_of(spark, 5000):
            lines = ivtff.read_lines(spark, str(tmp_path / "t.txt"))
            rows = lines.collect()
            plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert sorted((r.line_no, r.line) for r in rows) == [(i + 1, f"line {i}") for i in range(5000)]
    assert len({r.split for r in rows}) > 3
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
