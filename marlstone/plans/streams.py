"""Queries over event streams, claims and set operations, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores
from ..operators import series
from ..sources.tables import table
from .registry import query


def _seconds(column: str) -> F.Column:
    return F.unix_micros(F.col(column).cast("timestamp")) / 1_000_000


@query("SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def daily_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Additive daily counters, as a tumbling window keeps them."""
    rows = table(spark, folder, "events")
    return rows.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


_GRID = """c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
g AS (SELECT t.event_type, CAST(d.day AS DATE) AS day FROM (SELECT DISTINCT event_type FROM c) t, (SELECT unnest(generate_series((SELECT min(day) FROM c), (SELECT max(day) FROM c), INTERVAL 1 DAY)) AS day) d),
f AS (SELECT g.event_type, g.day, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (event_type, day))"""


@query(f"WITH {_GRID} SELECT * FROM f")
def gap_filled_days(spark: SparkSession, folder: str) -> DataFrame:
    return series.gap_filled(series.daily(table(spark, folder, "events"), ["event_type"]), ["event_type"])


@query(f"""WITH {_GRID}, s AS (SELECT *, count(*) OVER w - 1 AS k, sum(n) OVER w - n AS t, sum(n * n) OVER w - n * n AS q FROM f WINDOW w AS (PARTITION BY event_type)),
m AS (SELECT *, t / k AS mean, sqrt(greatest((q - k * (t / k) * (t / k)) / (k - 1), 0)) AS spread FROM s WHERE k > 1)
SELECT event_type, day, CAST(n AS BIGINT) AS n, round(mean, 4) AS mean, round(spread, 4) AS spread FROM m WHERE CASE WHEN spread < 1e-9 THEN n > mean + 1 ELSE n > mean + 1.5 * spread END""")
def day_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    found = series.anomalies(gap_filled_days(spark, folder), ["event_type"], 1.5)
    return found.select("event_type", "day", "n", F.round("mean", 4).alias("mean"), F.round("spread", 4).alias("spread"))


@query("""SELECT user_id, event_id, round(value, 6) AS value, round(before, 6) AS before FROM (SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM events)
WHERE before > 0 AND (value - before) / before <= -0.1""")
def metric_regressions(spark: SparkSession, folder: str) -> DataFrame:
    found = series.regressions(table(spark, folder, "events"), ["user_id", "event_type"], "value", ["ts", "event_id"])
    return found.select("user_id", "event_id", F.round("value", 6).alias("value"), F.round("before", 6).alias("before"))


@query("""WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM events), l AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) > 86400 THEN 1 ELSE 0 END AS fresh FROM e),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY s, event_id) AS session FROM l)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS events, round(max(s) - min(s), 3) AS seconds FROM n GROUP BY ALL""")
def user_sessions(spark: SparkSession, folder: str) -> DataFrame:
    rows = series.sessions(table(spark, folder, "events"), "user_id", _seconds("ts"), 86400)
    return rows.groupBy("user_id", "session").agg(F.count("*").alias("events"), F.round(F.max(_seconds("ts")) - F.min(_seconds("ts")), 3).alias("seconds"))


@query("""SELECT event_id FROM (SELECT event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS gap FROM events) WHERE gap IS NULL OR gap > 86400000000""")
def sliding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """A key is new if 24 hours have passed since it was last seen, kept or not."""
    before = F.lag(F.unix_micros(F.col("ts").cast("timestamp"))).over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id"))
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - before
    return table(spark, folder, "events").where("ts IS NOT NULL").withColumn("gap", gap).where("gap IS NULL OR gap > 86400000000").select("event_id")


@query("""SELECT event_id, n FROM (SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS n FROM events) WHERE n > 3""")
def rate_limited(spark: SparkSession, folder: str) -> DataFrame:
    """Events beyond three of their type within an hour: range frames over time, an hour's stretch each."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return series.counted_within(table(spark, folder, "events").select("event_id", "event_type", "ts"), ["event_type"], at, 3_600_000_000, "n").where("n > 3").select("event_id", "n")


@query("""SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY ALL""")
def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"))


_CLAIMS = """(SELECT o_custkey AS holder, (o_totalprice % 1000) / 1000 AS weight, CASE o_orderstatus WHEN 'F' THEN 'correct' WHEN 'O' THEN 'incorrect' WHEN 'P' THEN 'partial' END AS outcome FROM orders)"""


def _claims(spark: SparkSession, folder: str) -> DataFrame:
    """Orders read as weighted claims: the stand-in of this data for bets with outcomes."""
    status = F.col("o_orderstatus")
    outcome = F.when(status == "F", "correct").when(status == "O", "incorrect").when(status == "P", "partial")
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("holder"), ((F.col("o_totalprice") % 1000) / 1000).alias("weight"), outcome.alias("outcome"))


@query(f"""SELECT holder, count(*) AS claims, count(outcome) AS resolved, count(*) FILTER (outcome = 'correct') AS correct, count(*) FILTER (outcome = 'partial') AS partial,
round(avg(CASE outcome WHEN 'correct' THEN 1.0 WHEN 'incorrect' THEN 0.0 END), 6) AS hit_rate, round(avg(pow(weight - CASE outcome WHEN 'correct' THEN 1.0 WHEN 'incorrect' THEN 0.0 END, 2)), 6) AS brier FROM {_CLAIMS} GROUP BY 1""")
def claim_scorecard(spark: SparkSession, folder: str) -> DataFrame:
    out = series.scorecard(_claims(spark, folder), ["holder"])
    return out.withColumn("hit_rate", F.round("hit_rate", 6)).withColumn("brier", F.round("brier", 6))


@query(f"""SELECT CAST(least(floor(weight * 10), 9) AS INT) AS bucket, count(*) AS n, round(avg(weight), 6) AS predicted, round(avg(CASE WHEN outcome = 'correct' THEN 1.0 ELSE 0.0 END), 6) AS observed
FROM {_CLAIMS} WHERE outcome IN ('correct', 'incorrect') GROUP BY 1""")
def claim_calibration(spark: SparkSession, folder: str) -> DataFrame:
    out = series.calibration(_claims(spark, folder))
    return out.withColumn("predicted", F.round("predicted", 6)).withColumn("observed", F.round("observed", 6))


@query("""WITH n AS (SELECT o_orderpriority AS arm, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS k FROM orders GROUP BY 1), z AS (SELECT *, k / n AS p, 1.959963984540054 AS z FROM n)
SELECT arm, n, k AS hits, round(greatest((p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4.0 * n * n))) / (1 + z * z / n), 0), 6) AS low, round(least((p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4.0 * n * n))) / (1 + z * z / n), 1), 6) AS high FROM z""")
def arm_precision(spark: SparkSession, folder: str) -> DataFrame:
    """Precision of each arm with its Wilson interval."""
    rows = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("arm")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("hits"))
    low, high = scores.wilson(F.col("hits"), F.col("n"))
    return rows.select("arm", "n", "hits", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("""SELECT o_custkey AS holder, o_orderkey AS claim FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def top_claims(spark: SparkSession, folder: str) -> DataFrame:
    """The three largest of each holder: a ranked window that Spark cuts before the shuffle as well."""
    place = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    rows = table(spark, folder, "orders").where("o_orderstatus = 'F'").withColumn("r", F.row_number().over(place)).where("r <= 3")
    return rows.select(F.col("o_custkey").alias("holder"), F.col("o_orderkey").alias("claim"))


@query("""SELECT user_id FROM events WHERE event_type = 'view' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'""")
def viewers_who_bought(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    return rows.where("event_type = 'view'").select("user_id").intersect(rows.where("event_type = 'purchase'").select("user_id"))


@query("""SELECT user_id FROM events WHERE event_type = 'signup' EXCEPT SELECT user_id FROM events WHERE event_type = 'error'""")
def pending_users(spark: SparkSession, folder: str) -> DataFrame:
    """Pending = all less completed."""
    rows = table(spark, folder, "events")
    return rows.where("event_type = 'signup'").select("user_id").subtract(rows.where("event_type = 'error'").select("user_id"))


@query("""SELECT n_name AS nation, 'customer' AS kind, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
UNION ALL SELECT n_name, 'supplier', count(*) FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1""")
def parties_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    """Union of two scans, each counted by key before it meets the names."""
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("nation"))
    one = lambda name, key, kind: table(spark, folder, name).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).join(nation, "key").select("nation", F.lit(kind).alias("kind"), "n")
    return one("customer", "c_nationkey", "customer").union(one("supplier", "s_nationkey", "supplier"))


@query("""SELECT l_returnflag AS link_type, l_linestatus AS link_source, count(*) AS edges, count(DISTINCT l_suppkey) AS targets, round(sum(l_extendedprice * (1 - l_discount)), 2) AS weight
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def edge_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Typed multigraph edges folded by type and source."""
    rows = table(spark, folder, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02 00:00:00'")
    weight = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return rows.groupBy(F.col("l_returnflag").alias("link_type"), F.col("l_linestatus").alias("link_source")).agg(F.count("*").alias("edges"), F.countDistinct("l_suppkey").alias("targets"), weight.alias("weight"))


@query("""SELECT s_suppkey AS target, count(DISTINCT o_custkey) AS sources FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def customer_reach(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct customers that reach each supplier through orders."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("target")).distinct()
    pairs = lines.join(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").select("target", "o_custkey").distinct()
    known = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("target"))
    return pairs.join(known, "target", "left_semi").groupBy("target").agg(F.count("*").alias("sources"))
