"""Windows, sessions and attributes of events, hierarchies and set operations, and SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequence as q
from ..operators import ranking
from ..sources import driver_tables as t
from ..streaming import windows


def hourly_counts(spark, sf):
    found = windows.windowed_counts(t.table(spark, sf, "events"))
    return found.select(F.unix_timestamp("window_start").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


def user_sessions(spark, sf):
    found = windows.sessions(t.table(spark, sf, "events"), "6 hours")
    return found.select("user_id", F.unix_timestamp("session_start").alias("start"), F.unix_timestamp("session_end").alias("end"), "n")


def event_attributes(spark, sf):
    events = t.table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return events.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("total"), F.count_distinct("k").alias("kinds"))


def hierarchy_lookup(spark, sf):
    region, nation, customer, orders = (t.table(spark, sf, n) for n in ("region", "nation", "customer", "orders"))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def host_of_pages(spark, sf):
    pages = t.table(spark, sf, "pages")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    return pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page"))


def accession_versions(spark, sf):
    """The latest version of each accession, made of a supplier and the year of a part's line."""
    lines = t.table(spark, sf, "lineitem").select(F.concat(F.lit("S"), "l_suppkey", F.lit("."), F.year("l_shipdate")).alias("accession")).distinct()
    keyed = lines.withColumns({"stem": q.without_version(F.col("accession")), "version": F.element_at(F.split("accession", r"\."), -1).cast("int")})
    return ranking.deduplicated(keyed, ["stem"], [F.desc("version")]).select("stem", "accession", "version")


def hits_in_both_sets(spark, sf):
    hits = t.features(spark, sf)
    of = lambda flag: hits.filter(F.col("flag") == flag).select("region", "hit").distinct()
    return of("A").intersect(of("R"))


def hits_in_one_set(spark, sf):
    hits = t.features(spark, sf)
    of = lambda flag: hits.filter(F.col("flag") == flag).select("region", "hit").distinct()
    return of("A").join(of("R"), ["region", "hit"], "left_anti")


def nearest_previous_event(spark, sf):
    """For each purchase the user's last event of another kind before it."""
    events = t.table(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    order = Window.partitionBy("user_id").orderBy("at", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    kinds = F.when(F.col("event_type") != "purchase", F.struct("event_id", "at"))
    found = events.withColumn("last", F.last(kinds, ignorenulls=True).over(order)).filter("event_type = 'purchase'")
    return found.select("event_id", F.col("last.event_id").alias("previous_id"), (F.col("at") - F.col("last.at")).alias("gap"))


def conversation_models(spark, sf):
    turns = t.table(spark, sf, "conversations")
    parts = F.array_sort(F.collect_list(F.struct("turn", "role", F.char_length("text").alias("n"))))
    whole = turns.groupBy("conv_id").agg(parts.alias("parts"))
    return whole.select("conv_id", F.size("parts").cast("long").alias("turns"), F.array_join(F.transform("parts", lambda p: p["role"]), ",").alias("roles"), F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + p["n"]).alias("chars"))


QUERIES = {f.__name__: f for f in (hourly_counts, user_sessions, event_attributes, hierarchy_lookup, host_of_pages, accession_versions, hits_in_both_sets, hits_in_one_set, nearest_previous_event, conversation_models)}

ORACLE_SQL = {
    "hourly_counts": """SELECT epoch(date_trunc('hour', ts))::BIGINT AS "start", event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""",
    "user_sessions": """WITH marked AS (
  SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events), runs AS (
  SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM marked)
SELECT user_id, floor(epoch(min(ts)))::BIGINT AS "start", floor(epoch(max(ts) + INTERVAL 6 HOUR))::BIGINT AS "end", count(*) AS n FROM runs GROUP BY user_id, run""",
    "event_attributes": """WITH k AS (SELECT event_type, json_extract_string(props, '$.k')::BIGINT AS k FROM events)
SELECT event_type, count(k) AS n, sum(k)::BIGINT AS total, count(DISTINCT k) AS kinds FROM k GROUP BY 1""",
    "hierarchy_lookup": """SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "host_of_pages": "SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, count(*) AS n, min(page_id) AS first_page FROM pages GROUP BY 1",
    "accession_versions": """WITH v AS (SELECT 'S' || l_suppkey AS stem, max(year(l_shipdate))::INTEGER AS version FROM lineitem GROUP BY 1)
SELECT stem, stem || '.' || version AS accession, version FROM v""",
    "hits_in_both_sets": f"""WITH {t.FEATURES} SELECT region, hit FROM features WHERE flag = 'A' INTERSECT SELECT region, hit FROM features WHERE flag = 'R'""",
    "hits_in_one_set": f"""WITH {t.FEATURES} SELECT region, hit FROM features WHERE flag = 'A' EXCEPT SELECT region, hit FROM features WHERE flag = 'R'""",
    "nearest_previous_event": """WITH p AS (
  SELECT event_id, event_type, epoch_us(ts) AS t, last_value(CASE WHEN event_type <> 'purchase' THEN event_id END IGNORE NULLS) OVER w AS previous_id,
    last_value(CASE WHEN event_type <> 'purchase' THEN epoch_us(ts) END IGNORE NULLS) OVER w AS before
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, previous_id, t - before AS gap FROM p WHERE event_type = 'purchase'""",
    "conversation_models": "SELECT conv_id, count(*) AS turns, string_agg(role, ',' ORDER BY turn, role, length(text)) AS roles, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1",
}
