"""The parallel scan of quoted CSV against Spark's own reader of whole files and against the csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tabular_spark import csv_scan, storage


@pytest.fixture
def small_blocks(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(tmp_path, text, name="a.csv"):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def table_of(rows, terminator):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=terminator).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [31, 100_000])
@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_every_block_size_gives_the_same_records(spark, tmp_path, small_blocks, size, terminator):
    draw = random.Random(size)
    values = ["plain", 'a "quoted" word', "two\nlines", "\n\n", '"', '""\n"', ",", "été\nß", "x" * 90, "line\n" * 9, "end\r\n", "0"]
    rows = [[str(i), draw.choice(values), draw.choice(values)] for i in range(25)]
    path = written(tmp_path, table_of([["id", "one", "two"], *rows], terminator))
    small_blocks(size)
    got = csv_scan.read_csv_blocks(spark, path, "id string, one string, two string")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    path = written(tmp_path, table_of([["id", "t"], *([str(i), f"line\nnext {i}"] for i in range(500))], "\n"))
    small_blocks(1000)
    assert csv_scan.lines(spark, path).rdd.getNumPartitions() > 5
    assert csv_scan.block_states(csv_scan.lines(spark, path)).where("inside = 1").count() > 0
    assert csv_scan.read_csv_blocks(spark, path).count() == 500


def test_a_record_over_many_blocks_and_one_that_never_closes(spark, tmp_path, small_blocks):
    long = "\n".join(f"row {i}" for i in range(200))
    path = written(tmp_path, f'id,t\n1,"{long}"\n2,b\n3,"open\nend')
    small_blocks(200)
    got = {r.id: r.t for r in csv_scan.read_csv_blocks(spark, path, "id int, t string").collect()}
    assert got[1] == long and got[2] == "b" and set(got) == {1, 2, 3}


def test_many_blocks_are_joined_by_a_shuffle(spark, tmp_path, small_blocks, monkeypatch):
    rows = [[str(i), "a\nb" * (i % 7)] for i in range(40)]
    path = written(tmp_path, table_of([["id", "t"], *rows], "\n"))
    small_blocks(90)
    monkeypatch.setattr(csv_scan, "BROADCAST_BLOCKS", 0)
    assert sorted((str(r.id), r.t or "") for r in csv_scan.read_csv_blocks(spark, path, "id int, t string").collect()) == sorted(map(tuple, rows))


def test_several_files_empty_lines_short_records_and_no_header(spark, tmp_path):
    path = written(tmp_path, "id,t\n1,a\n\n2\n")
    written(tmp_path, 'id,t\n3,"c\nd"\n', "b.csv")
    assert sorted(map(tuple, csv_scan.read_csv_blocks(spark, path).collect())) == [(1, "a"), (2, None), (3, "c\nd")]
    bare = str(tmp_path / "bare.csv")
    (tmp_path / "bare.csv").write_text("1,x\n2,y\n")
    assert [tuple(r) for r in csv_scan.read_csv_blocks(spark, bare, header=False).orderBy("_c0").collect()] == [(1, "x"), (2, "y")]


def test_escape_by_backslash(spark, tmp_path, small_blocks):
    path = written(tmp_path, 'id,t\n1,"a \\" quote\nand line"\n2,"\\"\\"\n\\""\n')
    small_blocks(9)
    assert sorted(map(tuple, csv_scan.read_csv_blocks(spark, path, escape="\\").collect())) == [(1, 'a " quote\nand line'), (2, '""\n"')]


def test_empty_files(spark, tmp_path):
    path = written(tmp_path, "")
    assert csv_scan.read_csv_blocks(spark, path).collect() == []
    assert csv_scan.read_csv_blocks(spark, path, "a int").collect() == []
    written(tmp_path, "id,t\n")
    only = csv_scan.read_csv_blocks(spark, path)
    assert only.columns == ["id", "t"] and only.collect() == []


def test_types(spark, tmp_path):
    header = "i,l,d,f,t,n,b,s,z,mixed"
    rows = ["1,9999999999,2020-01-31,1.5,2020-01-31 10:00:00,-3,TRUE,x,\\N,1", "-2,1,2021-12-01,1e3,2020-02-01T00:00:00.5,+4,false,1,\\N,2.5", "\\N,\\N,\\N,\\N,\\N,\\N,\\N,\\N,\\N,x"]
    found = csv_scan.read_csv_blocks(spark, written(tmp_path, "\n".join([header, *rows])))
    assert [t for _, t in found.dtypes] == ["int", "bigint", "date", "double", "timestamp_ntz", "int", "boolean", "string", "string", "string"]
    assert found.agg(F.sum("i"), F.sum("f"), F.count("t"), F.count("z")).first() == (-1, 1001.5, 2, 0)


def test_what_is_written_comes_back(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    storage.write_csv(docs.coalesce(1), str(tmp_path / "one"))
    assert csv_scan.read_csv_blocks(spark, str(tmp_path / "one"), "doc_id long, text string").exceptAll(docs).count() == 0
