"""Events read as a log of runs and as the life of model versions: a user is a run, or a version of the model user_id % 15."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark import model, registry, runs, split, storage
from tabular_spark.queries.registry import query, table
from tabular_spark.queries.splitting import TWO, choice_sql

KINDS = ["view", "signup", "error", "click", "purchase"]
LAST = "arg_max({0}, (ts, event_id))"
WIDE = "wide AS (SELECT user_id, " + ", ".join(f"{LAST.format('value')} FILTER (WHERE event_type = '{k}') AS {k}" for k in KINDS) + " FROM events GROUP BY user_id)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("model", F.col("user_id") % 15)


def wide(spark: SparkSession, sf: str) -> DataFrame:
    return runs.wide(table(spark, sf, "events"), "user_id", "event_type", "value", KINDS, "ts", "event_id")


@query("SELECT o_orderkey AS run_id, 'o_totalprice' AS key, o_totalprice AS value FROM orders UNION ALL SELECT o_orderkey, 'o_custkey', o_custkey::double FROM orders")
def runs_long(spark: SparkSession, sf: str) -> DataFrame:
    return runs.record(table(spark, sf, "orders"), "o_orderkey", ["o_totalprice", "o_custkey"])


@query(f"WITH {WIDE} SELECT * FROM wide")
def runs_wide(spark: SparkSession, sf: str) -> DataFrame:
    return wide(spark, sf)


@query(f"WITH {WIDE} SELECT user_id, view FROM wide WHERE view > 20")
def runs_filter(spark: SparkSession, sf: str) -> DataFrame:
    return wide(spark, sf).where(F.col("view") > 20).select("user_id", "view")


@query("SELECT user_id, max(ts) AS last FROM events GROUP BY user_id ORDER BY last DESC, user_id LIMIT 5")
def runs_latest(spark: SparkSession, sf: str) -> DataFrame:
    return model.top(table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last")), "last", 5, "user_id")


@query("SELECT user_id % 15 AS model, count(*) AS n, count(DISTINCT user_id) AS runs, max(ts) AS last FROM events GROUP BY 1")
def experiments(spark: SparkSession, sf: str) -> DataFrame:
    each = events(spark, sf).groupBy("model", "user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    return each.groupBy("model").agg(F.sum("n").alias("n"), F.count("*").alias("runs"), F.max("last").alias("last"))


@query(f"WITH {WIDE} SELECT user_id % 2 AS data_version, arg_min(user_id, (error, user_id)) AS best, min(error) AS error FROM wide WHERE error IS NOT NULL GROUP BY 1")
def runs_best(spark: SparkSession, sf: str) -> DataFrame:
    full = wide(spark, sf).where(F.col("error").isNotNull()).withColumn("data_version", F.col("user_id") % 2)
    return full.groupBy("data_version").agg(F.min_by("user_id", F.struct("error", "user_id")).alias("best"), F.min("error").alias("error"))


@query("SELECT user_id % 15 AS model, max(user_id) AS version FROM events GROUP BY 1")
def latest_version(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).groupBy("model").agg(F.max("user_id").alias("version"))


@query(f"SELECT user_id % 15 AS model, user_id AS version, {LAST.format('props')} AS description FROM events GROUP BY 1, 2")
def latest_description(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).groupBy("model", F.col("user_id").alias("version")).agg(runs.latest("props", "ts", "event_id").alias("description"))


STAGES = f"SELECT user_id % 15 AS model, user_id AS version, {LAST.format('event_type')} AS stage, max(ts) AS since FROM events GROUP BY 1, 2"


@query(STAGES)
def stage_current(spark: SparkSession, sf: str) -> DataFrame:
    return runs.stages(events(spark, sf).withColumnRenamed("user_id", "version"), "model", "version", "event_type", "ts", "event_id")


@query(f"""SELECT s.model, s.version, CASE WHEN stage = 'purchase' AND since < newest THEN 'archived' ELSE stage END AS stage FROM ({STAGES}) s
    LEFT JOIN (SELECT user_id % 15 AS model, max(ts) AS newest FROM events WHERE event_type = 'purchase' GROUP BY 1) p ON s.model = p.model""")
def stage_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    return runs.exclusive_stages(events(spark, sf).withColumnRenamed("user_id", "version"), "model", "version", "event_type", "purchase", "archived", "ts", "event_id")


@query("""SELECT event_id, coalesce(before = 'purchase', false) AS allowed FROM
    (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE event_type = 'error'""")
def delete_allowed(spark: SparkSession, sf: str) -> DataFrame:
    seen = runs.previous(table(spark, sf, "events"), "user_id", "event_type", "ts", "event_id")
    return seen.where(F.col("event_type") == "error").select("event_id", F.coalesce(F.col("previous") == "purchase", F.lit(False)).alias("allowed"))


@query("""SELECT (o_custkey % 50)::varchar AS run, max(o_orderpriority) AS priority, count(*)::double AS n, max(o_totalprice) AS highest, 2.0 AS again FROM orders GROUP BY 1""")
def runs_appended(spark: SparkSession, sf: str) -> DataFrame:
    path = storage.new_folder(spark, "runs")
    found = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 50).alias("id")).agg(F.max("o_orderpriority").alias("priority"), F.count("*").alias("n"), F.max("o_totalprice").alias("highest"), F.max("o_orderdate").alias("at"))
    first = runs.logged(found, "id", "at", {"priority": F.col("priority")}, {"n": F.col("n"), "highest": F.col("highest"), "again": F.lit(1.0)})
    later = runs.logged(found.withColumn("at", F.expr("at + interval 1 day")), "id", "at", {}, {"again": F.lit(2.0)})
    for write_id, rows in (("a", first), ("b", later), ("a", first)):  # the first write is repeated
        runs.append(rows, path, write_id)
    return runs.run_table(runs.run_log(spark, path), ["priority"], ["n", "highest", "again"])


def deltas(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The events in three parts, each with events that are older than some of the parts before."""
    log = events(spark, sf).withColumnRenamed("user_id", "version")
    return [log.where(F.col("event_id") % 3 == part) for part in (2, 0, 1)]


def folded(spark: SparkSession, sf: str) -> runs.LifeCycle:
    state = None
    for delta in deltas(spark, sf):
        state = runs.fold(state, delta, "model", "version", "event_type", "purchase", "ts", "event_id")
    return state


@query(STAGES)
def stage_folded(spark: SparkSession, sf: str) -> DataFrame:
    return folded(spark, sf).last.select(F.col("name").alias("model"), "version", "stage", F.col("order.ts").alias("since"))


@query(f"""SELECT s.model, s.version, CASE WHEN stage = 'purchase' AND since < newest THEN 'archived' ELSE stage END AS stage FROM ({STAGES}) s
    LEFT JOIN (SELECT user_id % 15 AS model, max(ts) AS newest FROM events WHERE event_type = 'purchase' GROUP BY 1) p ON s.model = p.model""")
def exclusive_folded(spark: SparkSession, sf: str) -> DataFrame:
    return runs.current(folded(spark, sf), "purchase", "archived").withColumnRenamed("name", "model")


@query("""SELECT version, event_id, coalesce(before = 'purchase', false) AS allowed FROM
    (SELECT user_id AS version, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE event_type = 'error'""")
def delete_folded(spark: SparkSession, sf: str) -> DataFrame:
    def allowed(log: DataFrame) -> DataFrame:
        seen = runs.previous(log, "version", "event_type", "ts", "event_id")
        return seen.where(F.col("event_type") == "error").select("version", "event_id", F.coalesce(F.col("previous") == "purchase", F.lit(False)).alias("allowed"))

    log, answers = None, None
    for delta in deltas(spark, sf):
        log = delta if log is None else log.unionByName(delta)
        answers = runs.refreshed(answers, log, delta, "version", allowed)
    return answers


def fit_sql(name: str, feature: str) -> str:
    return f"{name} AS (SELECT regr_slope(l_extendedprice, {feature}) AS a, regr_intercept(l_extendedprice, {feature}) AS b FROM s WHERE split = 'train')"


@query(f"""WITH s AS (SELECT *, {choice_sql('l_orderkey', TWO)} AS split FROM lineitem), {fit_sql('m0', 'l_quantity')}, {fit_sql('m1', 'l_discount')}
    SELECT 0 AS version, count(*) AS n, round(sqrt(avg(pow(l_extendedprice - a * l_quantity - b, 2))), 1) AS rmse FROM s, m0 WHERE split = 'test'
    UNION ALL SELECT 1, count(*), round(sqrt(avg(pow(l_extendedprice - a * l_discount - b, 2))), 1) FROM s, m1 WHERE split = 'test'""")
def versions_compared(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.with_split(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_extendedprice"), "l_orderkey", TWO)
    base, train = storage.new_folder(spark, "models"), rows.where("split = 'train'").drop("split", "l_orderkey")
    chosen = [registry.register(model.fit_columns(train, [x], "l_extendedprice"), "price", base, train.select(x, "l_extendedprice"), label="l_extendedprice") for x in ("l_quantity", "l_discount")]
    scored = registry.scored(rows.where("split = 'test'"), base, "price", chosen)
    each = scored.select("l_extendedprice", F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.col(f"prediction_{v}").alias("prediction")) for v in chosen])).alias("p"))
    error = F.round(F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - F.col("p.prediction"), 2))), 1).alias("rmse")
    return each.groupBy(F.col("p.version").alias("version")).agg(F.count("*").alias("n"), error)
