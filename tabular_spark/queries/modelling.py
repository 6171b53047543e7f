"""Features, regressions and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark import features, linear, model, split
from tabular_spark.queries.cleaning import cleaned
from tabular_spark.queries.registry import CLEAN, query, table
from tabular_spark.queries.splitting import THREE, TWO, choice_sql

INDEX = "SELECT {c} AS label, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS double) AS index FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"


@query(INDEX.format(c="o_orderpriority", t="orders"))
def index_labels(spark: SparkSession, sf: str) -> DataFrame:
    return features.label_index(table(spark, sf, "orders"), "o_orderpriority")


@query(f"""WITH t AS (SELECT * FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderpriority <> '3-MEDIUM'), i AS ({INDEX.format(c='o_orderpriority', t='t')})
    SELECT o_orderkey, index FROM orders JOIN i ON o_orderpriority = label WHERE o_orderkey % 4 = 0""")
def index_unseen(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    labels = features.label_index(orders.where("o_orderkey % 4 <> 0 AND o_orderpriority <> '3-MEDIUM'"), "o_orderpriority")
    return features.indexed(orders.where("o_orderkey % 4 = 0"), labels, "o_orderpriority", "index").select("o_orderkey", "index")


@query(f"SELECT CAST(index AS int) AS slot, n::double AS total FROM ({INDEX.format(c='o_orderpriority', t='orders')}) WHERE index < (SELECT count(DISTINCT o_orderpriority) - 1 FROM orders)")
def one_hot_totals(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderpriority")
    return features.slot_counts(features.one_hot(orders, ["o_orderpriority"]))


@query("""WITH p AS (SELECT l_partkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, l_partkey) - 1 AS slot FROM lineitem GROUP BY 1),
    f AS (SELECT l_returnflag, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS slot FROM lineitem GROUP BY 1)
    SELECT slot::int AS slot, n::double AS total FROM p WHERE slot < (SELECT count(*) - 1 FROM p)
    UNION ALL SELECT (slot + (SELECT count(*) - 1 FROM p))::int, n::double FROM f WHERE slot < (SELECT count(*) - 1 FROM f)""")
def one_hot_wide(spark: SparkSession, sf: str) -> DataFrame:
    return features.slot_counts(features.one_hot(table(spark, sf, "lineitem").select("l_partkey", "l_returnflag"), ["l_partkey", "l_returnflag"]))


@query("SELECT 0 AS slot, round(sum(l_quantity), 4) AS total FROM lineitem UNION ALL SELECT 1, round(sum(l_discount), 4) FROM lineitem UNION ALL SELECT 2, round(sum(l_tax), 4) FROM lineitem")
def assemble(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return features.slot_sums(features.assembler(["l_quantity", "l_discount", "l_tax"]).transform(lines), "features")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")


def terms(spark, found: linear.Moments, names: list[str], digits: int = 4) -> DataFrame:
    intercept, slopes = linear.solved(found, "l_extendedprice", names)
    _, mse, r2 = linear.errors(found, "l_extendedprice", intercept, slopes)
    rows = [("intercept", round(intercept, digits)), *((n, round(v, digits)) for n, v in slopes.items()), ("r2", round(r2, 8)), ("rmse", round(mse**0.5, digits))]
    return spark.createDataFrame(rows, "term string, value double")


@query("""WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b, regr_r2(l_extendedprice, l_quantity) AS r FROM lineitem),
    e AS (SELECT sqrt(avg(pow(l_extendedprice - a * l_quantity - b, 2))) AS e FROM lineitem, m)
    SELECT 'intercept' AS term, round(b, 4) AS value FROM m UNION ALL SELECT 'l_quantity', round(a, 4) FROM m UNION ALL SELECT 'r2', round(r, 8) FROM m UNION ALL SELECT 'rmse', round(e, 4) FROM e""")
def ols_one(spark: SparkSession, sf: str) -> DataFrame:
    return terms(spark, linear.moments(lines(spark, sf), ["l_extendedprice", "l_quantity"]), ["l_quantity"])


TWO_FEATURES = """c AS (SELECT covar_pop(l_extendedprice, l_quantity) AS yx, covar_pop(l_extendedprice, l_discount) AS yz, covar_pop(l_quantity, l_discount) AS xz,
    var_pop(l_quantity) AS xx, var_pop(l_discount) AS zz, avg(l_extendedprice) AS y, avg(l_quantity) AS x, avg(l_discount) AS z, var_pop(l_extendedprice) AS yy FROM lineitem),
    m AS (SELECT *, (yx * zz - yz * xz) / (xx * zz - xz * xz) AS a, (yz * xx - yx * xz) / (xx * zz - xz * xz) AS b FROM c)"""


@query(f"""WITH {TWO_FEATURES}, k AS (SELECT *, y - a * x - b * z AS i FROM m), e AS (SELECT avg(pow(l_extendedprice - a * l_quantity - b * l_discount - i, 2)) AS e, any_value(yy) AS yy FROM lineitem, k)
    SELECT 'intercept' AS term, round(i, 3) AS value FROM k UNION ALL SELECT 'l_quantity', round(a, 3) FROM k UNION ALL SELECT 'l_discount', round(b, 3) FROM k
    UNION ALL SELECT 'r2', round(1 - e / yy, 8) FROM e UNION ALL SELECT 'rmse', round(sqrt(e), 3) FROM e""")
def ols_two(spark: SparkSession, sf: str) -> DataFrame:
    return terms(spark, linear.moments(lines(spark, sf), ["l_extendedprice", "l_quantity", "l_discount"]), ["l_quantity", "l_discount"], 3)


@query("""WITH c AS (SELECT covar_pop(l_extendedprice, l_quantity) * count(*) AS yx, var_pop(l_quantity) * count(*) AS xx, avg(l_extendedprice) AS y, avg(l_quantity) AS x FROM lineitem)
    SELECT 'intercept' AS term, round(y - x * yx / (xx + 1000000), 3) AS value FROM c UNION ALL SELECT 'l_quantity', round(yx / (xx + 1000000), 3) FROM c""")
def ridge_fit(spark: SparkSession, sf: str) -> DataFrame:
    intercept, slopes = linear.solved(linear.moments(lines(spark, sf), ["l_extendedprice", "l_quantity"]), "l_extendedprice", ["l_quantity"], alpha=1_000_000.0)
    return spark.createDataFrame([("intercept", round(intercept, 3)), ("l_quantity", round(slopes["l_quantity"], 3))], "term string, value double")


PENALTIES = (0, 1000, 1_000_000, 1_000_000_000)


@query("WITH c AS (SELECT covar_pop(l_extendedprice, l_quantity) * count(*) AS yx, var_pop(l_quantity) * count(*) AS xx, avg(l_extendedprice) AS y, avg(l_quantity) AS x FROM lineitem) " + " UNION ALL ".join(
    f"SELECT {a}::double AS alpha, round(y - x * yx / (xx + {a}), 3) AS intercept, round(yx / (xx + {a}), 3) AS slope FROM c" for a in PENALTIES))
def ridge_path(spark: SparkSession, sf: str) -> DataFrame:
    found = linear.moments(lines(spark, sf), ["l_extendedprice", "l_quantity"])  # one scan for all penalties
    fits = ((a, *linear.solved(found, "l_extendedprice", ["l_quantity"], alpha=float(a))) for a in PENALTIES)
    return spark.createDataFrame([(float(a), round(i, 3), round(b["l_quantity"], 3)) for a, i, b in fits], "alpha double, intercept double, slope double")


LINE = f"""s AS (SELECT *, {choice_sql('l_orderkey', THREE)} AS split FROM lineitem),
    m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM s WHERE split = 'train'),
    p AS (SELECT s.*, a * l_quantity + b AS prediction FROM s, m)"""


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.with_split(lines(spark, sf), "l_orderkey", THREE)
    return model.fit_columns(rows.where("split = 'train'"), ["l_quantity"], "l_extendedprice").transform(rows)


@query(f"WITH {LINE} SELECT l_orderkey, l_linenumber, l_extendedprice, round(prediction, 4) AS prediction FROM p WHERE split = 'test'")
def predict_rows(spark: SparkSession, sf: str) -> DataFrame:
    return predicted(spark, sf).where("split = 'test'").select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("prediction", 4).alias("prediction"))


@query(f"WITH {LINE} SELECT l_orderkey, l_linenumber, round(pow(l_extendedprice - prediction, 2) / 1000000, 4) AS error FROM p WHERE split = 'test'")
def squared_error(spark: SparkSession, sf: str) -> DataFrame:
    return predicted(spark, sf).where("split = 'test'").select("l_orderkey", "l_linenumber", F.round(model.squared_error("l_extendedprice", "prediction") / 1000000, 4).alias("error"))


METRICS = "count(*) AS n, round(avg(pow(l_extendedprice - prediction, 2)), 1) AS mse, round(sqrt(avg(pow(l_extendedprice - prediction, 2))), 1) AS rmse, round(1 - avg(pow(l_extendedprice - prediction, 2)) / var_pop(l_extendedprice), 6) AS r2"


@query(f"WITH {LINE} SELECT {METRICS} FROM p WHERE split = 'test'")
def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    return model.metrics(predicted(spark, sf).where("split = 'test'"), "l_extendedprice", "prediction", digits=1)


@query(f"WITH {LINE} SELECT split, {METRICS} FROM p GROUP BY split")
def evaluate_by_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.with_split(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice"), "l_orderkey", THREE)
    found = linear.moments_by(rows, ["l_extendedprice", "l_quantity"], "split")
    fitted = linear.solved(found["train"], "l_extendedprice", ["l_quantity"])
    errors = ((name, *linear.errors(m, "l_extendedprice", *fitted)) for name, m in found.items())
    return spark.createDataFrame([(name, n, round(mse, 1), round(mse**0.5, 1), round(r2, 6)) for name, n, mse, r2 in errors], "split string, n long, mse double, rmse double, r2 double")


def grouped_fit(label: str) -> str:
    """One slope within zones, an intercept per zone: what the formula label ~ zone + seats fits."""
    return f"""g AS (SELECT zone, avg(seats) AS mx, avg({label}) AS my FROM t GROUP BY zone),
    d AS (SELECT t.*, mx, my FROM t JOIN g ON t.zone = g.zone), k AS (SELECT sum((seats - mx) * ({label} - my)) / sum(pow(seats - mx, 2)) AS a FROM d),
    p AS (SELECT d.*, my + a * (seats - mx) AS prediction, a FROM d, k)"""


@query(f"""WITH {CLEAN}, t AS (SELECT * FROM clean), {grouped_fit('price')}
    SELECT round(any_value(a), 4) AS slope, round(sqrt(avg(pow(price - prediction, 2))), 4) AS rmse, round(1 - avg(pow(price - prediction, 2)) / var_pop(price), 8) AS r2 FROM p""")
def formula_fit(spark: SparkSession, sf: str) -> DataFrame:
    found = linear.fit(cleaned(spark, sf).select("zone", "seats", "price"), "price ~ .")
    return spark.createDataFrame([(round(found.slopes["seats"], 4), round(found.rmse, 4), round(found.r2, 8))], "slope double, rmse double, r2 double")


def log_model(spark: SparkSession, sf: str):
    rows = cleaned(spark, sf).select("id", "zone", "seats", "price", F.ln("price").alias("log_price"))
    return rows, linear.fit(rows, "log_price ~ . - price - id")


LOGGED = f"WITH {CLEAN}, t AS (SELECT *, ln(price) AS log_price FROM clean), {grouped_fit('log_price')}"


@query(f"{LOGGED} SELECT round(any_value(a), 8) AS slope, round(sqrt(avg(pow(log_price - prediction, 2))), 6) AS rmse FROM p")
def log_fit(spark: SparkSession, sf: str) -> DataFrame:
    found = log_model(spark, sf)[1]
    return spark.createDataFrame([(round(found.slopes["seats"], 8), round(found.rmse, 6))], "slope double, rmse double")


@query(f"{LOGGED} SELECT id, round(exp(prediction), 3) AS prediction FROM p")
def exp_prediction(spark: SparkSession, sf: str) -> DataFrame:
    rows, fitted = log_model(spark, sf)
    return fitted.transform(rows, "log_prediction").select("id", F.round(F.exp("log_prediction"), 3).alias("prediction"))


@query(f"{LOGGED} SELECT count(*) AS n, round(avg(pow(price - exp(prediction), 2)), 0) AS mse, round(sqrt(avg(pow(price - exp(prediction), 2))), 0) AS rmse, round(1 - avg(pow(price - exp(prediction), 2)) / var_pop(price), 6) AS r2 FROM p")
def log_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    rows, fitted = log_model(spark, sf)
    return model.metrics(fitted.transform(rows, "log_prediction").withColumn("prediction", F.exp("log_prediction")), "price", "prediction", digits=0)


FEATURES = ["l_quantity", "l_discount", "l_tax"]


def best_split(name: str, rows: str) -> str:
    """The cut of the rows that lowers the squared error most: CTE ``name`` with one row f, cut, gain, n, s."""
    values = " UNION ALL ".join(f"SELECT '{f}' AS f, {f} AS v, count(*) AS n, sum(l_extendedprice) AS s FROM {rows} GROUP BY {f}" for f in FEATURES)
    return f"""{name}_v AS ({values}),
    {name}_c AS (SELECT f, v, lead(v) OVER w AS up, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER (PARTITION BY f) AS an, sum(s) OVER (PARTITION BY f) AS al FROM {name}_v WINDOW w AS (PARTITION BY f ORDER BY v)),
    {name} AS (SELECT f, (v + up) / 2 AS cut, s * s / n + (al - s) * (al - s) / (an - n) - al * al / an AS gain, n, s, an, al FROM {name}_c WHERE up IS NOT NULL ORDER BY gain DESC LIMIT 1)"""


def value_of(node: str) -> str:
    return f"CASE {node}.f " + " ".join(f"WHEN '{f}' THEN {f}" for f in FEATURES) + " END"


def tree(spark: SparkSession, sf: str, depth: int):
    rows = lines(spark, sf)
    return rows, model.fit_tree(rows, FEATURES, "l_extendedprice", depth, bins=64)


STUMP = best_split("top", "lineitem")


@query(f"WITH {STUMP} SELECT count(*) AS n, round(CASE WHEN {value_of('top')} <= cut THEN s / n ELSE (al - s) / (an - n) END, 3) AS prediction FROM lineitem, top GROUP BY 2")
def tree_stump(spark: SparkSession, sf: str) -> DataFrame:
    rows, fitted = tree(spark, sf, 1)
    return fitted.transform(rows).groupBy(F.round("prediction", 3).alias("prediction")).agg(F.count("*").alias("n"))


DEEP = f"""{STUMP}, lower AS (SELECT lineitem.* FROM lineitem, top WHERE {value_of('top')} <= cut), higher AS (SELECT lineitem.* FROM lineitem, top WHERE {value_of('top')} > cut),
    {best_split('one', 'lower')}, {best_split('two', 'higher')},
    leaves AS (SELECT CASE WHEN {value_of('one')} <= cut THEN s / n ELSE (al - s) / (an - n) END AS prediction, l_extendedprice FROM lower, one
    UNION ALL SELECT CASE WHEN {value_of('two')} <= cut THEN s / n ELSE (al - s) / (an - n) END, l_extendedprice FROM higher, two)"""


@query(f"WITH {DEEP} SELECT round(prediction, 3) AS prediction, count(*) AS n FROM leaves GROUP BY 1")
def tree_depth2(spark: SparkSession, sf: str) -> DataFrame:
    rows, fitted = tree(spark, sf, 2)
    return fitted.transform(rows).groupBy(F.round("prediction", 3).alias("prediction")).agg(F.count("*").alias("n"))


GAINS = "gains AS (SELECT f, gain FROM top UNION ALL SELECT f, gain FROM one UNION ALL SELECT f, gain FROM two), total AS (SELECT sum(gain) AS t FROM gains)"
IMPORTANCE = " UNION ALL ".join(f"SELECT '{f}' AS feature, round(coalesce((SELECT sum(gain) FROM gains WHERE f = '{f}'), 0) / t, 5) AS importance FROM total" for f in FEATURES)


@query(f"WITH {DEEP}, {GAINS} {IMPORTANCE}")
def tree_importance(spark: SparkSession, sf: str) -> DataFrame:
    rows, fitted = tree(spark, sf, 2)
    return model.importances(fitted, fitted.transform(rows)).withColumn("importance", F.round("importance", 5))


@query(f"WITH {DEEP}, {GAINS} SELECT * FROM ({IMPORTANCE}) ORDER BY importance DESC, feature LIMIT 2")
def top_k_features(spark: SparkSession, sf: str) -> DataFrame:
    return model.top(tree_importance(spark, sf), "importance", 2, "feature")


@query(f"WITH {DEEP} SELECT round(min(prediction), 3) AS low, round(max(prediction), 3) AS high, min(l_extendedprice) AS label_low, max(l_extendedprice) AS label_high FROM leaves")
def tree_range(spark: SparkSession, sf: str) -> DataFrame:
    rows, fitted = tree(spark, sf, 2)
    low, high = F.round(F.min("prediction"), 3).alias("low"), F.round(F.max("prediction"), 3).alias("high")
    return fitted.transform(rows).agg(low, high, F.min("l_extendedprice").alias("label_low"), F.max("l_extendedprice").alias("label_high"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS groups, count(DISTINCT {c}) <= 40 AS fits FROM part" for c in ("p_name", "p_brand", "p_type")))
def max_bins_check(spark: SparkSession, sf: str) -> DataFrame:
    return model.bins_needed(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"], 40)


@query(f"""WITH s AS (SELECT *, {choice_sql('o_orderkey', TWO)} AS split FROM orders),
    m AS (SELECT o_orderpriority, avg(o_totalprice) AS prediction FROM s WHERE split = 'train' GROUP BY 1)
    SELECT count(*) AS n, round(sum(prediction), 1) AS predicted FROM s JOIN m USING (o_orderpriority) WHERE split = 'test'""")
def one_hot_fit(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.with_split(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderkey", TWO)
    fitted = linear.fit(rows.where("split = 'train'").select("o_orderpriority", "o_totalprice"), "o_totalprice ~ o_orderpriority")
    return fitted.transform(rows.where("split = 'test'")).agg(F.count("*").alias("n"), F.round(F.sum("prediction"), 1).alias("predicted"))


@query(f"""WITH s AS (SELECT *, {choice_sql('l_orderkey', TWO)} AS split FROM lineitem),
    g AS (SELECT l_partkey, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM s WHERE split = 'train' GROUP BY 1),
    k AS (SELECT sum((l_quantity - mx) * (l_extendedprice - my)) / sum(pow(l_quantity - mx, 2)) AS a FROM s JOIN g USING (l_partkey) WHERE split = 'train')
    SELECT split, count(*) AS n, round(sqrt(avg(pow(l_extendedprice - my - a * (l_quantity - mx), 2))), 2) AS rmse FROM s JOIN g USING (l_partkey), k GROUP BY split""")
def wide_category_fit(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.with_split(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"), "l_orderkey", TWO).withColumn("l_partkey", F.col("l_partkey").cast("string"))
    fitted = linear.fit(rows.where("split = 'train'").select("l_partkey", "l_quantity", "l_extendedprice"), "l_extendedprice ~ .")
    error = F.round(F.sqrt(F.avg(model.squared_error("l_extendedprice", "prediction"))), 2).alias("rmse")
    return fitted.transform(rows).groupBy("split").agg(F.count("*").alias("n"), error)


BINS = 16
ORDERED = f"""o AS (SELECT p_name, count(*) AS n, avg(p_retailprice) AS mean FROM part GROUP BY p_name),
    b AS (SELECT p_name, n, mean, CAST(floor({BINS} * (sum(n) OVER (ORDER BY mean, p_name) - n) / sum(n) OVER ()) AS int) AS bin FROM o)"""


@query(f"WITH {ORDERED} SELECT p_name AS label, n, bin FROM b")
def ordered_bins(spark: SparkSession, sf: str) -> DataFrame:
    return features.ordered_bins(table(spark, sf, "part"), "p_name", "p_retailprice", BINS).select("label", "n", "bin")


@query(f"""WITH {ORDERED}, v AS (SELECT bin, sum(n) AS n, sum(n * mean) AS s FROM b GROUP BY bin),
    c AS (SELECT bin, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER () AS an, sum(s) OVER () AS al FROM v WINDOW w AS (ORDER BY bin)),
    t AS (SELECT *, s * s / n + (al - s) * (al - s) / (an - n) AS gain FROM c WHERE n < an ORDER BY gain DESC LIMIT 1)
    SELECT round(CASE WHEN b.bin <= t.bin THEN s / t.n ELSE (al - s) / (an - t.n) END, 3) AS prediction, sum(b.n)::bigint AS n FROM b, t GROUP BY 1""")
def tree_wide(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_name", "p_retailprice")
    rows = features.binned(parts, features.ordered_bins(parts, "p_name", "p_retailprice", BINS), "p_name", "p_name_bin")
    fitted = model.fit_tree(rows, ["p_name_bin"], "p_retailprice", 1, bins=BINS)
    return fitted.transform(rows).groupBy(F.round("prediction", 3).alias("prediction")).agg(F.count("*").alias("n"))
