"""Schemas, counts, frequencies and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark import checks, clean, profile, storage
from tabular_spark.queries.registry import OFFERS, offers, query, table

#: SQL for the types of a table, in the names that Spark gives them.
TYPES = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END"


def types_sql(name: str) -> str:
    return f"SELECT DISTINCT column_name AS name, {TYPES} AS type FROM information_schema.columns WHERE table_name = '{name}'"


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def select_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@query(types_sql("orders"))
def schema_table(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders")
    return clean.schema_frame(df, clean.type_table(df), "name string, type string")


@query(f"SELECT type, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM ({types_sql('lineitem')}) GROUP BY type")
def columns_by_type(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    rows = [(t, len(c := sorted(clean.columns_of(df, t))), ",".join(c)) for t in dict.fromkeys(t for _, t in df.dtypes)]
    return clean.schema_frame(df, rows, "type string, n long, names string")


@query(f"""SELECT coalesce(a.name, b.name) AS name, coalesce(a.type, b.type) AS type, a.name IS NOT NULL AS in_first FROM
    (SELECT regexp_replace(name, '^._', '') AS name, type FROM ({types_sql('customer')})) a FULL JOIN
    (SELECT regexp_replace(name, '^._', '') AS name, type FROM ({types_sql('supplier')})) b ON a.name = b.name AND a.type = b.type WHERE a.name IS NULL OR b.name IS NULL""")
def schema_diff(spark: SparkSession, sf: str) -> DataFrame:
    first, second = table(spark, sf, "customer"), table(spark, sf, "supplier")
    a, b = ({(n[2:], t) for n, t in clean.type_table(df)} for df in (first, second))
    return clean.schema_frame(first, [(n, t, (n, t) in a) for n, t in sorted(a ^ b)], "name string, type string, in_first boolean")


@query("SELECT count(*) AS n_rows, 11::bigint AS n_columns FROM lineitem")
def table_shape(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_distinct, count(*) = count(DISTINCT l_orderkey) AS is_unique FROM lineitem")
def key_unique(spark: SparkSession, sf: str) -> DataFrame:
    return profile.key_uniqueness(table(spark, sf, "lineitem"), "l_orderkey")


@query(f"WITH {OFFERS} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM offers" for c in ("id", "zone", "reply", "seats", "rooms", "min_days", "rating", "price_text")))
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_counts(offers(spark, sf))


@query(f"WITH {OFFERS} SELECT count(*) AS n FROM offers WHERE rating IS NULL")
def null_rows(spark: SparkSession, sf: str) -> DataFrame:
    return offers(spark, sf).where(F.col("rating").isNull()).agg(F.count("*").alias("n"))


@query(f"WITH {OFFERS} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c}::varchar = 'N/A') AS marked FROM offers" for c in ("id", "zone", "reply", "seats", "rooms", "min_days", "rating", "price_text")))
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.marker_counts(offers(spark, sf), "N/A")


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def freq_table(spark: SparkSession, sf: str) -> DataFrame:
    return profile.frequencies(table(spark, sf, "part"), "p_type")


@query("SELECT p_size, p_type, count(*) AS n FROM part GROUP BY p_size, p_type ORDER BY n DESC, p_size, p_type")
def freq_table_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return profile.frequencies(table(spark, sf, "part"), "p_size", "p_type").orderBy(F.desc("n"), "p_size", "p_type")


@query("SELECT c_mktsegment, count(*) AS n, CAST(grouping(c_mktsegment) AS int) AS total FROM customer GROUP BY CUBE (c_mktsegment)")
def freq_cube(spark: SparkSession, sf: str) -> DataFrame:
    return profile.cube_frequencies(table(spark, sf, "customer"), "c_mktsegment")


@query(f"WITH {OFFERS} SELECT rooms, count(*) AS n FROM offers WHERE rooms IS NOT NULL GROUP BY rooms")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(offers(spark, sf), "rooms")


@query("SELECT DISTINCT p_brand FROM part")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_brand").distinct()


@query(f"WITH {OFFERS} SELECT count(*) AS groups FROM (SELECT rooms FROM offers GROUP BY rooms)")
def group_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return profile.cardinality(offers(spark, sf), "rooms")


def described(columns: tuple[str, ...], name: str, more: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS deviation, min({c})::double AS low, max({c})::double AS high{more.format(c=c)} FROM {name}" for c in columns)


@query(f"WITH {OFFERS} " + described(("seats", "rooms", "min_days", "rating"), "offers"))
def describe_typed(spark: SparkSession, sf: str) -> DataFrame:
    return profile.describe(offers(spark, sf), ["seats", "rooms", "min_days", "rating"])


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, min({c}) AS low, max({c}) AS high FROM part" for c in ("p_name", "p_brand", "p_type")))
def describe_strings(spark: SparkSession, sf: str) -> DataFrame:
    return profile.describe_texts(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@query(f"WITH {OFFERS} " + described(("seats", "rating", "min_days"), "offers", "".join(f", quantile_disc({{c}}, {p})::double AS q{int(100 * p)}" for p in (0.25, 0.5, 0.75))))
def summary_typed(spark: SparkSession, sf: str) -> DataFrame:
    return profile.summary(offers(spark, sf), ["seats", "rating", "min_days"])


def profiled(columns: dict[str, str]) -> str:
    parts = []
    for c, kind in columns.items():
        empty = f"count(*) FILTER (WHERE {c} = 0)" if kind == "number" else f"count(*) FILTER (WHERE {c} = '')"
        stats = f"round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS deviation, min({c})::double AS low, max({c})::double AS high" if kind == "number" else "NULL::double AS mean, NULL::double AS deviation, NULL::double AS low, NULL::double AS high"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulls, {empty} AS empties, {stats} FROM offers")
    return " UNION ALL ".join(parts)


@query(f"WITH {OFFERS} " + profiled({"id": "number", "zone": "text", "reply": "text", "seats": "number", "rooms": "number", "min_days": "number", "rating": "number", "price_text": "text"}))
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    # the approximate distinct count is tested against its error instead
    return profile.profile(offers(spark, sf)).drop("distinct_about")


OFFER_KINDS = {"id": "number", "zone": "text", "reply": "text", "seats": "number", "rooms": "number", "min_days": "number", "rating": "number", "price_text": "text"}
QUARTILES = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", quantile_disc({c}, 0.25)::double AS q25, quantile_disc({c}, 0.5)::double AS q50, quantile_disc({c}, 0.75)::double AS q75 FROM offers" for c, k in OFFER_KINDS.items() if k == "number")


@query(f"WITH {OFFERS}, p AS ({profiled(OFFER_KINDS)}), q AS ({QUARTILES}) SELECT * FROM p LEFT JOIN q USING (\"column\")")
def profile_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_with_quartiles(offers(spark, sf)).drop("distinct_about")


def merged_states(spark: SparkSession, sf: str) -> DataFrame:
    """The sketches of three parts of the table, one of them told twice, merged without their rows."""
    path, rows = storage.new_folder(spark, "states"), offers(spark, sf)
    for part in (0, 1, 1, 2):
        profile.append_state(rows.where(F.col("id") % 3 == part), path, f"part-{part}")
    return profile.merged(profile.states(spark, path))


@query(f"WITH {OFFERS}, p AS ({profiled(OFFER_KINDS)}) SELECT \"column\", n, nulls, empties, round(mean, 2) AS mean, round(deviation, 2) AS deviation, low, high FROM p")
def profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.profile_of(merged_states(spark, sf))
    return found.select("column", "n", "nulls", "empties", F.round("mean", 2).alias("mean"), F.round("deviation", 2).alias("deviation"), "low", "high")


@query(f"WITH {OFFERS} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c}::varchar AS value, count(*) AS n FROM offers WHERE {c} IS NOT NULL GROUP BY ALL" for c in ("zone", "reply", "seats", "rooms")))
def profile_frequent(spark: SparkSession, sf: str) -> DataFrame:
    found = profile.profile_of(merged_states(spark, sf).where(F.col("column").isin("zone", "reply", "seats", "rooms")), top=10)
    return found.select("column", F.explode("top").alias("t")).select("column", "t.value", F.col("t.count").alias("n"))


@query("""SELECT CAST(CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice >= 400000 THEN 11 ELSE floor((o_totalprice - 100000) / 30000) + 1 END AS int) AS bucket, count(*) AS n
    FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1""")
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profile.histogram(table(spark, sf, "orders"), F.col("o_totalprice"), 100000.0, 400000.0, 10)


@query("""SELECT CAST(CASE WHEN v < 8 THEN 0 WHEN v >= 13 THEN 6 ELSE floor(v - 8) + 1 END AS int) AS bucket, count(*) AS n
    FROM (SELECT ln(o_totalprice) AS v FROM orders WHERE o_totalprice > 0) GROUP BY 1""")
def histogram_log(spark: SparkSession, sf: str) -> DataFrame:
    return profile.histogram(table(spark, sf, "orders").where("o_totalprice > 0"), F.ln("o_totalprice"), 8.0, 13.0, 5)


@query("SELECT c_custkey, (('0x' || substr(md5(c_name), 1, 8))::bigint >> 1) AS text_hash FROM customer")
def text_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", checks.text_hash(F.col("c_name")).alias("text_hash"))


SCHEMAS = {"orders": {"o_orderkey": "bigint", "o_totalprice": "double", "o_comment": "string"}, "customer": {"c_custkey": "bigint", "c_nationkey": "bigint"}}


@query(" UNION ALL ".join(f"SELECT '{t}.{c}' AS name, (SELECT count(*) FROM ({types_sql(t)}) WHERE name = '{c}' AND type = '{k}') > 0 AS passed FROM (SELECT 1)" for t, x in SCHEMAS.items() for c, k in x.items()))
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    frames = {t: table(spark, sf, t) for t in SCHEMAS}
    return clean.schema_frame(frames["orders"], [r for t, x in SCHEMAS.items() for r in checks.schema_checks(frames[t], t, x)], "name string, passed boolean")


def answer_sql(name: str, column: str) -> str:
    return f"SELECT '{name}.{column}' AS name, count(*) AS n, CAST(sum(('0x' || substr(md5(coalesce({column}::varchar, 'None')), 1, 8))::bigint >> 1) % 2147483648 AS bigint) AS answer FROM {name}"


ANSWERS = (("part", "p_name"), ("customer", "c_mktsegment"), ("nation", "n_name"))


@query(" UNION ALL ".join(answer_sql(t, c) for t, c in ANSWERS))
def answer_check(spark: SparkSession, sf: str) -> DataFrame:
    parts = [checks.answer(table(spark, sf, t), c).withColumn("name", F.lit(f"{t}.{c}")) for t, c in ANSWERS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


CHECKED = {"orders": ("o_orderkey", {"o_orderstatus": ["F", "O"]}), "lineitem": ("l_orderkey", {"l_linestatus": ["F", "O"]}), "part": ("p_partkey", {})}


def checked_sql() -> str:
    parts = []
    for t, (key, allowed) in CHECKED.items():
        parts.append(f"SELECT '{t}.unique' AS name, count(*) = count(DISTINCT {key}) AS passed FROM {t}")
        parts.append(f"SELECT '{t}.filled', count(*) FILTER (WHERE {key} IS NULL) = 0 FROM {t}")
        parts += [f"SELECT '{t}.allowed_{c}', count(*) FILTER (WHERE {c} IS NULL OR {c} NOT IN ({', '.join(map(repr, v))})) = 0 FROM {t}" for c, v in allowed.items()]
    return " UNION ALL ".join(parts)


def all_checks(spark: SparkSession, sf: str) -> DataFrame:
    parts = [checks.table_checks(table(spark, sf, t), t, key, allowed) for t, (key, allowed) in CHECKED.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"SELECT name, passed, count(*) FILTER (WHERE passed) OVER () AS n_passed, count(*) OVER () AS n_all FROM ({checked_sql()}) ORDER BY name")
def check_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = all_checks(spark, sf)
    totals = found.agg(F.count_if("passed").alias("n_passed"), F.count("*").alias("n_all"))
    return found.join(F.broadcast(totals), F.lit(True)).orderBy("name")


@query(f"SELECT name FROM ({checked_sql()}) WHERE NOT passed")
def checks_left(spark: SparkSession, sf: str) -> DataFrame:
    return checks.open_checks(all_checks(spark, sf)).select("name")
