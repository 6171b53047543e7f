"""Tables and models written and read again, in a new folder each time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark import checks, clean, csv_scan, model, split, storage, versions
from tabular_spark.queries.profiling import all_checks, checked_sql
from tabular_spark.queries.registry import OFFERS, offers, query, table
from tabular_spark.queries.splitting import THREE, choice_sql


@query("SELECT doc_id, lang, text FROM documents")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    path = storage.new_folder(spark, "csv")
    storage.write_csv(docs, path)
    return csv_scan.read_csv_blocks(spark, path, "doc_id long, lang string, text string")


@query(f"WITH {OFFERS} SELECT id, zone, reply, seats, rooms, min_days, rating, nullif(price_text, '') AS price_text FROM offers")
def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = storage.new_folder(spark, "csv")
    storage.write_csv(offers(spark, sf).withColumn("price_text", F.nullif("price_text", F.lit(""))), path)
    return csv_scan.read_csv_blocks(spark, path)


@query("SELECT * FROM (VALUES ('l_orderkey', 'int'), ('l_quantity', 'double'), ('l_returnflag', 'string'), ('l_shipdate', 'timestamp_ntz'), ('is_late', 'boolean'), ('nothing', 'string')) t(name, type)")
def csv_types(spark: SparkSession, sf: str) -> DataFrame:
    path = storage.new_folder(spark, "csv")
    late = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate", (F.col("l_tax") > 0.05).alias("is_late"), F.lit(None).cast("string").alias("nothing"))
    storage.write_csv(late, path)
    found = csv_scan.read_csv_blocks(spark, path)
    return clean.schema_frame(found, clean.type_table(found), "name string, type string")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0")
def snapshot_write(spark: SparkSession, sf: str) -> DataFrame:
    orders, base = table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), storage.new_folder(spark, "orders")
    versions.write_version(orders, base)
    versions.write_version(orders.where("o_orderkey % 2 = 0"), base)
    return versions.read_version(spark, base)


def evolved(spark: SparkSession, sf: str) -> str:
    orders, base = table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), storage.new_folder(spark, "orders")
    versions.write_version(orders, base)
    versions.write_version(versions.read_version(spark, base, 0).withColumn("log_price", F.ln("o_totalprice")), base, "add log_price")
    return base


@query("SELECT o_orderkey, o_totalprice FROM orders")
def snapshot_read(spark: SparkSession, sf: str) -> DataFrame:
    return versions.read_version(spark, evolved(spark, sf), 0)


@query("SELECT 0 AS version, o_orderkey, o_totalprice, NULL::double AS log_price FROM orders UNION ALL SELECT 1, o_orderkey, o_totalprice, round(ln(o_totalprice), 6) FROM orders")
def snapshot_evolve(spark: SparkSession, sf: str) -> DataFrame:
    return versions.read_versions(spark, evolved(spark, sf)).withColumn("log_price", F.round("log_price", 6))


@query("SELECT 0 AS version, count(*) AS n, 0::bigint AS with_log FROM orders UNION ALL SELECT 1, count(*), count(ln(o_totalprice)) FROM orders")
def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    return versions.history(spark, evolved(spark, sf)).select(F.col("version").cast("int").alias("version"), "n", versions.values_in("log_price").alias("with_log"))


def changed(spark: SparkSession, sf: str) -> str:
    """Three versions: one loses a column and gains one, one has a wider type and only later orders."""
    orders, base = table(spark, sf, "orders"), storage.new_folder(spark, "orders")
    first = orders.select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderstatus")
    versions.write_version(first, base)
    versions.write_version(first.drop("o_orderstatus").withColumn("is_odd", F.col("o_orderkey") % 2 == 1), base, "drop o_orderstatus")
    versions.write_version(orders.where("o_orderkey > 700").select("o_orderkey", (F.col("o_custkey") + 5_000_000_000).alias("o_custkey")), base, "widen o_custkey")
    return base


CHANGED = """SELECT 0 AS version, o_orderkey, o_custkey, o_orderstatus, NULL::boolean AS is_odd FROM orders
    UNION ALL SELECT 1, o_orderkey, o_custkey, NULL, o_orderkey % 2 = 1 FROM orders
    UNION ALL SELECT 2, o_orderkey, o_custkey + 5000000000, NULL, NULL FROM orders WHERE o_orderkey > 700"""


@query(CHANGED)
def snapshot_widen(spark: SparkSession, sf: str) -> DataFrame:
    return versions.read_versions(spark, changed(spark, sf))


@query(f"SELECT version, count(*) AS n, sum(o_custkey)::bigint AS customers FROM ({CHANGED}) WHERE o_orderkey BETWEEN 100 AND 650 GROUP BY version")
def snapshot_within(spark: SparkSession, sf: str) -> DataFrame:
    found = versions.read_versions(spark, changed(spark, sf), {"o_orderkey": (100, 650)})
    return found.groupBy("version").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("customers"))


@query("SELECT * FROM (VALUES (0, 'overwrite', 'o_orderkey,o_custkey,o_orderstatus'), (1, 'drop o_orderstatus', 'o_orderkey,o_custkey,is_odd'), (2, 'widen o_custkey', 'o_orderkey,o_custkey')) t(version, operation, columns)")
def snapshot_log(spark: SparkSession, sf: str) -> DataFrame:
    return versions.history(spark, changed(spark, sf)).select(F.col("version").cast("int").alias("version"), "operation", F.array_join(F.col("columns.name"), ",").alias("columns"))


@query(f"SELECT name, passed::int::double AS value FROM ({checked_sql()})")
def results_log(spark: SparkSession, sf: str) -> DataFrame:
    path, found = storage.new_folder(spark, "results"), all_checks(spark, sf)
    for part in (found.where(F.col("name").like("orders%")), found.where(~F.col("name").like("orders%"))):
        storage.write_csv(part.select("name", F.col("passed").cast("double").alias("value")), path, mode="append")
    return storage.read_csv(spark, path, "name string, value double")


@query(f"""WITH s AS (SELECT *, {choice_sql('l_orderkey', THREE)} AS split FROM lineitem),
    m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM s WHERE split = 'train')
    SELECT split, count(*) AS n, round(sum(a * l_quantity + b), 2) AS predicted FROM s, m GROUP BY split""")
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.with_split(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice"), "l_orderkey", THREE)
    path = storage.new_folder(spark, "model")
    train = rows.where("split = 'train'")
    storage.save_model(model.fit_columns(train, ["l_quantity"], "l_extendedprice"), path, train)
    again = storage.load_model(path).transform(rows)
    return again.groupBy("split").agg(F.count("*").alias("n"), F.round(F.sum("prediction"), 2).alias("predicted"))


@query("SELECT n_regionkey, count(*)::double AS n FROM nation GROUP BY n_regionkey")
def counts_overwritten(spark: SparkSession, sf: str) -> DataFrame:
    path = storage.new_folder(spark, "counts")
    nations = table(spark, sf, "nation")
    nations.write.mode("overwrite").parquet(path)
    counts = clean.with_types(nations.groupBy("n_regionkey").agg(F.count("*").alias("n")), of=("bigint",))
    counts.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query(f"SELECT name, passed FROM ({checked_sql()}) WHERE NOT passed")
def log_cleared(spark: SparkSession, sf: str) -> DataFrame:
    base = storage.new_folder(spark, "checks")
    versions.write_version(all_checks(spark, sf), base)
    versions.write_version(checks.open_checks(versions.read_version(spark, base)), base, "clear passed")
    return versions.read_version(spark, base)
