"""Queries on lineage, the quality gate and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.values import masked_fields
from tidemark.operators import audit, lineage, publish, quality
from tidemark.plans.common import RUN, scratch, table


def lineage_columns(spark, sf):
    stamped = lineage.stamp(table(spark, sf, "orders"), RUN)
    return stamped.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


LINEAGE_SQL = f"""SELECT '{RUN.run_id}' AS run_id, '{RUN.source_id}' AS source_id, '{RUN.source_name}' AS source_name, '{RUN.environment}' AS environment,
 '{RUN.family}' AS strategy_family, '{RUN.variant}' AS strategy_variant, TIMESTAMP '2026-01-01 00:00:00' AS ingestion_timestamp, DATE '2026-01-01' AS ingestion_date, * FROM orders"""


def gappy(spark, sf):
    """Events with gaps: no type for errors, blank properties for every tenth user."""
    return table(spark, sf, "events").withColumn("event_type", F.nullif("event_type", F.lit("error"))).withColumn("props", F.when(F.col("user_id") % 10 == 0, F.lit("  ")).otherwise(F.col("props")))


def required_violations(spark, sf):
    return quality.required_violations(gappy(spark, sf), ["event_id", "event_type", "props", "value"])


REQUIRED_SQL = """WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type, CASE WHEN user_id % 10 = 0 THEN '  ' ELSE props END AS props, value FROM events),
c AS (SELECT count(*) FILTER (event_id IS NULL) AS a, count(*) FILTER (event_type IS NULL OR trim(event_type) = '') AS b, count(*) FILTER (props IS NULL OR trim(props) = '') AS p, count(*) FILTER (value IS NULL) AS v FROM e)
SELECT 'event_id' AS column_name, a AS violations FROM c UNION ALL SELECT 'event_type', b FROM c UNION ALL SELECT 'props', p FROM c UNION ALL SELECT 'value', v FROM c"""


def duplicate_keys(spark, sf):
    return quality.duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumnRenamed("__n", "n_rows")


DUPLICATE_SQL = "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"


def duplicate_key_groups(spark, sf):
    found = quality.duplicate_groups(table(spark, sf, "documents").select("text"), ["text"])
    return found.select(F.sha2("text", 256).alias("text_sha256"), F.col("__n").alias("n_rows"))


GROUPS_SQL = "SELECT sha256(text) AS text_sha256, count(*) AS n_rows FROM documents GROUP BY text HAVING count(*) > 1"


def report(spark, sf):
    df = gappy(spark, sf)
    return quality.checks(df, ["event_id", "event_type", "props"], [["event_id"], ["user_id", "event_type"], ["absent"]], ["event_id", "ts", "kind"], strict=True, outputs=True)


def quality_report(spark, sf):
    return report(spark, sf)


REPORT_SQL = """WITH e AS (SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, CASE WHEN user_id % 10 = 0 THEN '  ' ELSE props END AS props FROM events),
req AS (SELECT CAST(count(*) FILTER (event_id IS NULL) + count(*) FILTER (event_type IS NULL) + count(*) FILTER (trim(props) = '' OR props IS NULL) AS BIGINT) AS n FROM e),
told AS (SELECT nullif(array_to_string([x FOR x IN [CASE WHEN count(*) FILTER (event_id IS NULL) > 0 THEN 'event_id=' || count(*) FILTER (event_id IS NULL) END, CASE WHEN count(*) FILTER (event_type IS NULL) > 0 THEN 'event_type=' || count(*) FILTER (event_type IS NULL) END,
 CASE WHEN count(*) FILTER (trim(props) = '' OR props IS NULL) > 0 THEN 'props=' || count(*) FILTER (trim(props) = '' OR props IS NULL) END] IF x IS NOT NULL], ', '), '') AS d FROM e),
k1 AS (SELECT '{"event_id":' || event_id || '}' AS k FROM e GROUP BY event_id HAVING count(*) > 1),
k2 AS (SELECT '{"user_id":' || user_id || coalesce(',"event_type":"' || event_type || '"', '') || '}' AS k FROM e GROUP BY user_id, event_type HAVING count(*) > 1),
u1 AS (SELECT count(*) AS n, (SELECT string_agg(k, ', ' ORDER BY k) FROM (FROM k1 ORDER BY k LIMIT 5)) AS d FROM k1),
u2 AS (SELECT count(*) AS n, (SELECT string_agg(k, ', ' ORDER BY k) FROM (FROM k2 ORDER BY k LIMIT 5)) AS d FROM k2)
SELECT 'data' AS phase, 'required_fields' AS name, CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END AS outcome, n AS n_failures, d AS details FROM req, told
UNION ALL SELECT 'data', 'unique_fields', CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END, n, d FROM u1
UNION ALL SELECT 'data', 'unique_fields', CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END, n, d FROM u2
UNION ALL SELECT 'data', 'unique_fields', 'failed', 1, 'missing: absent'
UNION ALL SELECT 'data', 'schema_expectations', 'failed', 5, 'missing: kind; unexpected: user_id, event_type, value, props'
UNION ALL SELECT 'output', 'output_columns', 'failed', 8, 'missing: run_id, source_id, source_name, environment, strategy_family, strategy_variant, ingestion_timestamp, ingestion_date'"""


def quality_summary(spark, sf):
    return quality.summary(report(spark, sf))


SUMMARY_SQL = f"""SELECT count(*) FILTER (outcome = 'passed') AS passed, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped,
count(*) FILTER (outcome = 'failed') = 0 AS successful FROM ({REPORT_SQL})"""


def schema_diff(spark, sf):
    """Null rates of the expected customer columns, next to what the schema check says of them."""
    df = table(spark, sf, "customer")
    missing, unexpected = quality.schema_difference(df.columns, ["c_custkey", "c_name", "c_phone", "c_nationkey"], strict=True)
    counts = quality.required_violations(df, df.columns)
    marked = counts.withColumn("status", F.when(F.col("column_name").isin(unexpected), "unexpected").otherwise("expected"))
    absent = df.agg(F.count(F.lit(1)).alias("violations")).select(F.explode(F.array(*[F.lit(m) for m in missing])).alias("column_name"), "violations", F.lit("missing").alias("status"))
    return marked.unionByName(absent)


SCHEMA_SQL = """SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS column_name,
unnest([count(*) FILTER (c_custkey IS NULL), count(*) FILTER (c_name IS NULL OR trim(c_name) = ''), count(*) FILTER (c_nationkey IS NULL), count(*) FILTER (c_acctbal IS NULL), count(*) FILTER (c_mktsegment IS NULL OR trim(c_mktsegment) = '')]) AS violations,
unnest(['expected', 'expected', 'expected', 'unexpected', 'unexpected']) AS status FROM customer
UNION ALL SELECT 'c_phone', count(*), 'missing' FROM customer"""


def output_checks(spark, sf):
    """The writes that orders of each status would make, checked against their zone."""
    orders = table(spark, sf, "orders")
    log = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("records")).select(F.concat(F.when(F.col("o_orderstatus") == "F", "/raw/").otherwise("/bronze/"), "o_orderstatus").alias("path"), F.when(F.col("o_orderstatus") == "P", "csv").otherwise("parquet").alias("format"), "records")
    return quality.check_outputs(log, "/bronze", "parquet").select("phase", "name", "outcome", "details")


OUTPUT_SQL = """SELECT 'output' AS phase, 'materialized_outputs' AS name, CASE WHEN o_orderstatus IN ('F', 'P') THEN 'failed' ELSE 'passed' END AS outcome,
CASE o_orderstatus WHEN 'F' THEN 'outside the zone' WHEN 'P' THEN 'format' END AS details FROM (SELECT DISTINCT o_orderstatus FROM orders)"""


def publish_modes(spark, sf):
    """Overwrite, append and ignore; counts by mode, and what the target holds."""
    orders, at = table(spark, sf, "orders"), scratch(spark)
    stamped = lineage.stamp(orders, RUN)
    first = publish.write_path(stamped, f"{at}/orders", mode="overwrite", partition_by=["ingestion_date"])
    again = publish.write_path(stamped.where("o_orderstatus = 'O'"), f"{at}/orders", mode="append", partition_by=["ingestion_date"])
    ignored = publish.write_path(stamped, f"{at}/orders", mode="ignore")
    held = spark.read.parquet(f"{at}/orders")
    return held.groupBy("o_orderstatus", "ingestion_date").agg(F.count(F.lit(1)).alias("n_rows")).select("*", *[F.lit(w.records).cast("long").alias(n) for w, n in ((first, "overwritten"), (again, "appended"), (ignored, "ignored"))])


PUBLISH_SQL = """SELECT o_orderstatus, DATE '2026-01-01' AS ingestion_date, count(*) * CASE o_orderstatus WHEN 'O' THEN 2 ELSE 1 END AS n_rows,
(SELECT count(*) FROM orders) AS overwritten, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS appended, CAST(0 AS BIGINT) AS ignored FROM orders GROUP BY o_orderstatus"""


def table_diff(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    other = orders.where("o_orderkey % 100 != 1").unionByName(orders.where("o_orderkey % 250 = 3"))
    return audit.table_difference(orders, other)


DIFF_SQL = """SELECT o_orderkey, o_orderstatus, 'left' AS side FROM orders WHERE o_orderkey % 100 = 1
UNION ALL SELECT o_orderkey, o_orderstatus, 'right' FROM orders WHERE o_orderkey % 250 = 3 AND o_orderkey % 100 != 1"""


def run_log(spark, sf):
    """Runs read off the events: a user's events of a day are a run's log."""
    events = table(spark, sf, "events")
    log = events.select(F.concat_ws("/", F.to_date("ts").cast("string"), F.col("user_id").cast("string")).alias("run_id"), F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "succeeded").otherwise("running").alias("status"), F.col("ts").cast("timestamp").alias("at"), F.when(F.col("event_type") == "error", F.col("props")).alias("reason"))
    out = lineage.run_states(log)
    return out.select("run_id", F.col("started_at").cast("timestamp_ntz").alias("started_at"), F.col("ended_at").cast("timestamp_ntz").alias("ended_at"), "n_events", "status", "duration_seconds")


RUN_SQL = """WITH l AS (SELECT strftime(ts, '%Y-%m-%d') || '/' || user_id AS run_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'succeeded' ELSE 'running' END AS status, ts FROM events)
SELECT run_id, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS n_events, arg_max(status, (ts, status)) AS status, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration_seconds FROM l GROUP BY run_id"""


def masked_columns(spark, sf):
    """Customers with sensitive names: of a column, in a struct, in a list of structs, in a map and in a map of structs."""
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_mktsegment").alias("session_token"),
        F.when(F.col("c_custkey") % 3 != 0, F.struct("c_name", F.struct(F.col("c_name").alias("api_token"), F.col("c_nationkey").alias("nation")).alias("inner"))).alias("auth_info"),
        F.array(F.struct(F.col("c_nationkey").alias("k"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("Client-Secret"))).alias("items"),
        F.create_map(F.lit("X_API_KEY"), "c_name", F.lit("plain"), "c_name").alias("headers"),
        F.create_map(F.lit("a"), F.struct(F.col("c_name").alias("password"), "c_custkey"), F.lit("cookie"), F.struct(F.col("c_name").alias("password"), "c_custkey")).alias("nested"),
    )
    at = lambda key: F.element_at("nested", key)
    out = df.select(*masked_fields(df.schema))
    return out.select("c_custkey", "session_token", F.col("auth_info.c_name").alias("name"), F.col("auth_info.inner.api_token").alias("inner_token"), F.col("auth_info.inner.nation").alias("inner_nation"), F.element_at("items", 1)["Client-Secret"].alias("item_secret"), F.element_at("items", 1)["k"].alias("item_k"), F.element_at("headers", "X_API_KEY").alias("header_key"), F.element_at("headers", "plain").alias("header_plain"), at("a")["password"].alias("map_password"), at("a")["c_custkey"].alias("map_key"), at("cookie").isNull().alias("map_hidden"))


MASKED_SQL = """SELECT c_custkey, CASE WHEN c_mktsegment IS NOT NULL THEN '***' END AS session_token, CASE WHEN c_custkey % 3 != 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 != 0 THEN '***' END AS inner_token, CASE WHEN c_custkey % 3 != 0 THEN c_nationkey END AS inner_nation,
CASE WHEN c_mktsegment != 'BUILDING' THEN '***' END AS item_secret, c_nationkey AS item_k, '***' AS header_key, c_name AS header_plain, '***' AS map_password, c_custkey AS map_key, TRUE AS map_hidden FROM customer"""


def lineage_record(spark, sf):
    """What each market segment's output adds to the run's lineage row, unnested."""
    outputs = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("records")).select(F.concat(F.lit("bronze/"), "c_mktsegment").alias("path"), F.lit("parquet").alias("format"), "records")
    landed = outputs.select(F.concat(F.lit("raw/"), "path").alias("path"), F.lit("csv").alias("format"), F.sha2("path", 256).alias("checksum"))
    rows = lineage.lineage_rows(outputs, RUN, "config", landed, "2026-01-01")
    return rows.select("run_id", "config_hash", "checkpoint", F.col("records").alias("total"), F.inline(F.transform("outputs", lambda o, i: F.struct(o["path"].alias("path"), o["format"].alias("format"), o["records"].alias("records"), F.get("artifacts", i)["path"].alias("artifact"), F.get("artifacts", i)["checksum"].alias("checksum")))))


RECORD_SQL = f"""SELECT '{RUN.run_id}' AS run_id, sha256('config') AS config_hash, '2026-01-01' AS checkpoint, (SELECT count(*) FROM customer) AS total, 'bronze/' || c_mktsegment AS path, 'parquet' AS format, count(*) AS records,
'raw/bronze/' || c_mktsegment AS artifact, sha256('bronze/' || c_mktsegment) AS checksum FROM customer GROUP BY c_mktsegment"""

QUERIES = {
    "lineage_columns": lineage_columns, "required_violations": required_violations, "duplicate_keys": duplicate_keys, "duplicate_key_groups": duplicate_key_groups,
    "quality_report": quality_report, "quality_summary": quality_summary, "schema_diff": schema_diff, "output_checks": output_checks, "publish_modes": publish_modes,
    "table_diff": table_diff, "run_log": run_log, "masked_columns": masked_columns, "lineage_record": lineage_record,
}
ORACLES = {
    "lineage_columns": LINEAGE_SQL, "required_violations": REQUIRED_SQL, "duplicate_keys": DUPLICATE_SQL, "duplicate_key_groups": GROUPS_SQL, "quality_report": REPORT_SQL,
    "quality_summary": SUMMARY_SQL, "schema_diff": SCHEMA_SQL, "output_checks": OUTPUT_SQL, "publish_modes": PUBLISH_SQL, "table_diff": DIFF_SQL, "run_log": RUN_SQL,
    "masked_columns": MASKED_SQL, "lineage_record": RECORD_SQL,
}
