"""Shapes that once hung, and repeated rows in a mix."""

import base64
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabular_spark.llm import exact_dedup, mixing, secrets, sharding

DOCS = "doc_id long, text string, lang string, source string"
SHAPES = {
    "wrapped run": lambda n: "a\n" + "Ab3d" * (n // 4), "wrapped run, url": lambda n: "a\n" + "Ab-_" * (n // 4), "zlib marks": lambda n: "%41" + "x^" * (n // 2), "gzip marks": lambda n: "%41" + "%1f%8b%08" * (n // 9),
    "zstd marks": lambda n: "%41" + "%28%b5%2f%fd" * (n // 12), "bzip2 marks": lambda n: "%41" + "BZh91AY&SY" * (n // 10), "percent of percent": lambda n: "%" + "25" * (n // 2), "entity of entity": lambda n: "&" + "#38;" * (n // 4),
    "backslash of backslash": lambda n: "\\" + "u005c" * (n // 5), "percents": lambda n: "%41%42" * (n // 6), "named of named": lambda n: "&" + "amp;" * (n // 4), "base64 zlib marks": lambda n: base64.b64encode(b"x^" * (n // 2)).decode(), "entities": lambda n: "&#65;" * (n // 5),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_time_grows_with_the_text(shape):
    def seconds(n):
        began = time.process_time()
        secrets.find(SHAPES[shape](n))
        return time.process_time() - began

    small, large = seconds(100_000), seconds(400_000)
    assert large < 10 * max(small, 0.05)


def test_a_megabyte_in_one_run():
    began = time.process_time()
    secrets.find("x\n" + "Ab3d" * (1 << 20))
    assert time.process_time() - began < 20


@pytest.mark.parametrize("text,secret", [("%252525%70assword=abcdef12", "password=abcdef12"), ("&#38;#38;#112;assword=abcdef12", "password=abcdef12"), ("\\u005cu005cu0070assword=abcdef12", "password=abcdef12"), ("%2570%2561ssword=abcdef12", "password=abcdef12")])
def test_marks_escaped_many_times_over(text, secret):
    spans, _ = secrets.find(text)
    assert [(k, e) for k, _, e, _, _ in spans if k == "assign"] == [("assign", len(text))]


def test_a_mix_with_repeated_rows_meets_its_target(spark):
    rows = [(i, "w " * (i % 5 + 1), "en", "a") for i in range(3000)] + [(None, "one two three", "en", "a")] * 1500 + [(i, "w " * 4, "en", "b") for i in range(9000, 9900)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = mixing.op10(docs).collect()
    assert len(got) == len(rows)
    for source_size in {r.source_size for r in got}:
        mine = [r for r in got if r.source_size == source_size]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 3
        assert all(0 <= r.taken <= 3 * r["size"] for r in mine)
    repeated = sorted(r.taken for r in got if r.doc_id is None)
    assert repeated[-1] - repeated[0] <= 3  # rows of one item differ by one copy at most
    words = sum(len(r.text.split()) for r in mixing.mixed(docs).collect())
    assert words == sum(r.taken for r in got)


def test_shards_depend_on_records_and_seed_alone(spark, monkeypatch):
    monkeypatch.setattr(sharding, "REPEATS", 64)
    rows = [(i, f"text {i} " * 20, None, "a") for i in range(2000)] + [(None, "same", None, "b")] * 700 + [(7, "same", "b", None), (7, "same", None, "b")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("odd", F.create_map(F.lit("k"), F.struct(F.lit(0.0), F.col("doc_id")))).select("*", F.lit(1).alias("bucket"), F.lit(2).alias("ordinal"))
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    monkeypatch.setattr(sharding, "PARTS", 5)
    for partitions, parts in ((8, 13), (5, 3), (3, 1)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = sharding.shuffled(docs.orderBy("text").repartition(parts), 7, bucket_bytes=20_000).select("record.*", "shard", "slot").orderBy("shard", "slot").collect()
        found.append([(*r[:4], r["shard"], r["slot"]) for r in got])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    assert Counter(x[:4] for x in found[0]) == Counter(rows)
    assert [x[4:] for x in found[0]] == [(s, i) for s in range(7) for i in range(sum(x[4] == s for x in found[0]))]
    in_shards = Counter(x[4] for x in found[0] if x[1] == "same")
    assert len(in_shards) == 7 and max(in_shards.values()) < 200  # not in one bucket
    other = sharding.shuffled(docs, 7, seed=43, bucket_bytes=20_000).select("record.*").collect()
    assert [tuple(r[:4]) for r in other] != [x[:4] for x in found[0]]


def test_counters_grow_with_the_shuffle_partitions(spark):
    docs, before = spark.createDataFrame([(1, "a", None, None)], DOCS), spark.conf.get("spark.sql.shuffle.partitions")
    assert exact_dedup.counters_for(docs) == 1000
    spark.conf.set("spark.sql.shuffle.partitions", 3000)
    assert exact_dedup.counters_for(docs) == 12000
    spark.conf.set("spark.sql.shuffle.partitions", before)
