from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.sources import accepted, csv_lines, quoted_feed, rejected, whole_records
from sluiceworks.streaming import finish, start

SCHEMA = T.StructType().add("id", T.LongType()).add("note", T.StringType()).add("n", T.IntegerType())
CHUNK = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=[97, 1000, 1 << 20])
def chunk_bytes(spark, request):
    names = {CHUNK: str(request.param), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def notes(seed, n):
    rng = random.Random(seed)
    signs = ["a", "é", ",", '"', "\n", "\n\n", '""', ' "x", ', "\r\n", "long " * 30]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(9))) for _ in range(n)]


def written(path, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end).writerows(rows)
    path.write_bytes(out.getvalue().encode())


def test_records_of_many_chunks(spark, tmp_path, chunk_bytes):
    """Line breaks, quotes and empty lines in fields; two files; a field larger than several chunks."""
    want = []
    for f in range(2):
        rows = [(1000 * f + i, note, i) for i, note in enumerate(notes(f, 150))]
        rows[70] = (1000 * f + 70, "big\n" * 900 + '"end"', 70)
        written(tmp_path / f"{f}.csv", rows)
        want += rows
    feed = quoted_feed(csv_lines(spark, str(tmp_path)), SCHEMA)
    found = sorted(tuple(r) for r in accepted(feed, ("id",)).collect())
    assert [(i, note or "", n) for i, note, n in found] == sorted(want)
    assert rejected(feed, ("id",)).count() == 0


def test_the_other_way_of_placing_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sluiceworks.sources.records.MOST_CHUNKS", 0)
    spark.conf.set(CHUNK, "200")
    try:
        rows = [(i, note, i) for i, note in enumerate(notes(5, 200))]
        written(tmp_path / "a.csv", rows)
        records = whole_records(csv_lines(spark, str(tmp_path))).collect()
    finally:
        spark.conf.unset(CHUNK)
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\0").writerows(rows)
    assert sorted(r["record"] for r in records) == sorted(out.getvalue().split("\0")[:-1])


def test_damaged_and_open_records(spark, tmp_path, chunk_bytes):
    (tmp_path / "a.csv").write_text('1,"a\nb",2\n\nx,"c\n,d",3\n4,"e",no\n5,"f,g\n\nh')
    (tmp_path / "b.csv").write_text('6,"i",6\n')
    (tmp_path / "c.csv").write_text("")
    feed = quoted_feed(csv_lines(spark, str(tmp_path)), SCHEMA)
    assert sorted(tuple(r) for r in accepted(feed).collect()) == [(1, "a\nb", 2), (6, "i", 6)]
    assert sorted(r["line"] for r in rejected(feed).collect()) == ['4,"e",no', '5,"f,g\n\nh', 'x,"c\n,d",3']


def test_line_ends_of_two_characters(spark, tmp_path, chunk_bytes):
    written(tmp_path / "a.csv", [(i, f"a\nb{i}", i) for i in range(50)], "\r\n")
    found = accepted(quoted_feed(csv_lines(spark, str(tmp_path)), SCHEMA)).collect()
    assert sorted(tuple(r) for r in found) == [(i, f"a\nb{i}", i) for i in range(50)]


def test_files_that_arrive_in_a_stream(spark, tmp_path):
    seen = []
    (tmp_path / "in").mkdir()
    for f in range(2):
        written(tmp_path / "in" / f"{f}.csv", [(10 * f + i, f'"{i}"\n,', f) for i in range(3)])

        def write(batch, batch_id):
            seen.append([tuple(r) for r in accepted(quoted_feed(batch, SCHEMA)).collect()])

        lines = csv_lines(spark, str(tmp_path / "in"), streaming=True)
        finish(start(lines, str(tmp_path / "checkpoint"), each_batch=write))
    assert [sorted(s) for s in seen] == [[(10 * f + i, f'"{i}"\n,', f) for i in range(3)] for f in range(2)]


def test_no_files_with_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\n")
    assert whole_records(csv_lines(spark, str(tmp_path))).count() == 0
    assert whole_records(csv_lines(spark, str(tmp_path)).where(F.lit(False))).count() == 0


@pytest.mark.parametrize("chunk_bytes", [97, 1000], indirect=True)
def test_small_chunks_share_tasks(spark, tmp_path, chunk_bytes):
    rows = [(i, f'a\n"{i}",\n', i) for i in range(3000)]
    written(tmp_path / "a.csv", rows)
    lines = csv_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 8 * spark.sparkContext.defaultParallelism
    records = whole_records(lines)
    # those of whole records, and those of the pieces' shuffle
    assert records.rdd.getNumPartitions() <= 5 * spark.sparkContext.defaultParallelism
    found = accepted(quoted_feed(lines, SCHEMA)).collect()
    assert sorted(tuple(r) for r in found) == rows


@pytest.mark.parametrize("chunk_bytes", [97], indirect=True)
def test_other_chunks_than_summed_up_are_an_error(spark, tmp_path, chunk_bytes):
    written(tmp_path / "a.csv", [(i, f"a\n{i}", i) for i in range(100)])
    found = whole_records(csv_lines(spark, str(tmp_path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "37")
    with pytest.raises(Exception, match="other chunks"):
        found.collect()
