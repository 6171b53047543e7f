"""Type repair, filters and missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark import clean
from tabular_spark.queries.registry import CLEAN, OFFERS, PRICED, offers, query, table


def priced(spark: SparkSession, sf: str) -> DataFrame:
    return offers(spark, sf).withColumn("price", clean.amount("price_text"))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return priced(spark, sf).where("price > 0 AND min_days <= 365")


@query(f"""WITH {CLEAN}, m AS (SELECT quantile_disc(rooms, 0.5) AS mid FROM clean)
    SELECT zone, count(*) AS n, round(avg(price), 4) AS mean_price, CAST(sum(CASE WHEN rooms IS NULL THEN 1 ELSE 0 END) AS bigint) AS rooms_filled,
    CAST(sum(coalesce(rooms, mid)) AS bigint) AS rooms FROM clean, m GROUP BY zone""")
def clean_summary(spark: SparkSession, sf: str) -> DataFrame:
    full = clean.imputed_with_flags(cleaned(spark, sf), ["rooms"])
    return full.groupBy("zone").agg(F.count("*").alias("n"), F.round(F.avg("price"), 4).alias("mean_price"), F.sum("rooms_na").cast("long").alias("rooms_filled"), F.sum("rooms").alias("rooms"))


@query(f"WITH {CLEAN} SELECT id, zone, nullif(reply, 'N/A') AS reply, price, CAST(rooms AS double) AS rooms, CASE WHEN rooms IS NULL THEN 1.0::double ELSE 0.0::double END AS rooms_na FROM clean")
def clean_offers(spark: SparkSession, sf: str) -> DataFrame:
    flagged = clean.missing_flags(cleaned(spark, sf).withColumn("reply", clean.marker_to_null("reply", "N/A")), ["rooms"])
    return clean.with_types(flagged.drop("price_text", "seats", "min_days", "rating")).select("id", "zone", "reply", "price", "rooms", "rooms_na")


@query(f"WITH {PRICED} SELECT id, price FROM priced")
def money_to_double(spark: SparkSession, sf: str) -> DataFrame:
    return priced(spark, sf).select("id", "price")


@query(f"WITH {OFFERS} SELECT id, nullif(reply, 'N/A') AS reply FROM offers")
def token_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return offers(spark, sf).select("id", clean.marker_to_null("reply", "N/A").alias("reply"))


@query(f"WITH {OFFERS} SELECT id, CASE WHEN rooms IS NULL THEN 1.0::double ELSE 0.0::double END AS rooms_na, CASE WHEN rating IS NULL THEN 1.0::double ELSE 0.0::double END AS rating_na FROM offers")
def missing_flags(spark: SparkSession, sf: str) -> DataFrame:
    return clean.missing_flags(offers(spark, sf), ["rooms", "rating"]).select("id", "rooms_na", "rating_na")


@query(f"WITH {OFFERS} SELECT id, CAST(seats AS double) AS seats, CAST(rooms AS double) AS rooms, CAST(min_days AS double) AS min_days FROM offers")
def ints_to_double(spark: SparkSession, sf: str) -> DataFrame:
    return clean.with_types(offers(spark, sf).select("id", "seats", "rooms", "min_days"))


@query(f"WITH {PRICED} SELECT count(*) AS n FROM priced WHERE price = 0")
def zero_price_count(spark: SparkSession, sf: str) -> DataFrame:
    return priced(spark, sf).where(F.col("price") == 0).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def positive_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select("c_custkey", "c_acctbal")


@query(f"WITH {OFFERS} SELECT id, min_days FROM offers WHERE min_days <= 365")
def range_filter(spark: SparkSession, sf: str) -> DataFrame:
    return offers(spark, sf).where(F.col("min_days") <= 365).select("id", "min_days")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 400000")
def outlier_cap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_totalprice") < 400000).select("o_orderkey", "o_totalprice")


@query("SELECT count(*) AS n FROM orders WHERE o_totalprice > 400000")
def outlier_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_totalprice") > 400000).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 25 AND l_returnflag = 'R'")
def sql_predicate(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where("l_quantity < 25 AND l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


@query(f"WITH {OFFERS} SELECT count(*) AS n_before, count(*) FILTER (WHERE rooms IS NOT NULL AND rating IS NOT NULL) AS n_after FROM offers")
def drop_nulls(spark: SparkSession, sf: str) -> DataFrame:
    full = offers(spark, sf)
    whole = clean.without_nulls(full, ["rooms", "rating"]).agg(F.count("*").alias("n_after"))
    return full.agg(F.count("*").alias("n_before")).join(F.broadcast(whole), F.lit(True)).select("n_before", "n_after")


@query(f"WITH {OFFERS}, m AS (SELECT quantile_disc(rooms, 0.5) AS a, quantile_disc(rating, 0.5) AS b FROM offers) SELECT id, coalesce(rooms, a) AS rooms, coalesce(rating, b) AS rating, CASE WHEN rooms IS NULL THEN 1.0::double ELSE 0.0::double END AS rooms_na FROM offers, m")
def impute_median(spark: SparkSession, sf: str) -> DataFrame:
    return clean.imputed_with_flags(offers(spark, sf), ["rooms", "rating"]).select("id", "rooms", "rating", "rooms_na")


@query(f"WITH {PRICED} SELECT quantile_disc(rooms, 0.5)::double AS rooms, quantile_disc(rating, 0.5) AS rating, quantile_disc(price, 0.5) AS price FROM priced")
def impute_values(spark: SparkSession, sf: str) -> DataFrame:
    found = clean.medians(priced(spark, sf), ["rooms", "rating", "price"])
    return spark.createDataFrame([tuple(float(x) for x in found.values())], "rooms double, rating double, price double")


@query(f"WITH {OFFERS}, m AS (SELECT avg(rating) AS a FROM offers) SELECT id, round(coalesce(rating, a), 6) AS rating FROM offers, m")
def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    full = offers(spark, sf)
    return clean.filled(full, clean.means(full, ["rating"])).select("id", F.round("rating", 6).alias("rating"))


@query(f"""WITH {OFFERS}, o AS (SELECT id, nullif(reply, 'N/A') AS reply, rooms FROM offers),
    a AS (SELECT reply AS v FROM o WHERE reply IS NOT NULL GROUP BY reply ORDER BY count(*) DESC, reply LIMIT 1),
    b AS (SELECT rooms AS w FROM o WHERE rooms IS NOT NULL GROUP BY rooms ORDER BY count(*) DESC, rooms LIMIT 1)
    SELECT id, coalesce(reply, v) AS reply, coalesce(rooms, w) AS rooms FROM o, a, b""")
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    full = offers(spark, sf).withColumn("reply", clean.marker_to_null("reply", "N/A"))
    return clean.filled(full, clean.modes(full, ["reply", "rooms"])).select("id", "reply", "rooms")


@query(f"WITH {OFFERS} SELECT id, coalesce(nullif(reply, 'N/A'), 'unknown') AS reply FROM offers")
def fill_category(spark: SparkSession, sf: str) -> DataFrame:
    full = offers(spark, sf).withColumn("reply", clean.marker_to_null("reply", "N/A"))
    return clean.filled(full, {"reply": "unknown"}).select("id", "reply")


@query(f"WITH {PRICED} SELECT id, CASE WHEN price > 0 THEN round(ln(price), 6) END AS log_price FROM priced")
def log_price(spark: SparkSession, sf: str) -> DataFrame:
    return priced(spark, sf).select("id", F.round(F.ln("price"), 6).alias("log_price"))
