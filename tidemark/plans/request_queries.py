"""Queries on request planning and incremental state."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.values import lookback, strftime
from tidemark.operators import increment, requests
from tidemark.plans.common import table


def spans(spark, sf):
    """The dates that orders of each status span, from mid-month on."""
    orders = table(spark, sf, "orders")
    return orders.groupBy("o_orderstatus").agg(F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end"))


SPANS = "(SELECT o_orderstatus, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1)"


def day_windows(spark, sf):
    return requests.day_windows(spans(spark, sf))


DAY_SQL = f"SELECT o_orderstatus, CAST(d AS DATE) AS window_start, CAST(d AS DATE) AS window_end FROM (SELECT o_orderstatus, unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM {SPANS})"


def month_windows(spark, sf):
    return requests.month_windows(spans(spark, sf))


MONTH_SQL = f"""SELECT o_orderstatus, greatest(CAST(m AS DATE), s) AS window_start, least(last_day(CAST(m AS DATE)), e) AS window_end
FROM (SELECT o_orderstatus, s, e, unnest(generate_series(CAST(date_trunc('month', s) AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM {SPANS})"""


def format_dates(spark, sf):
    at = F.col("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", *[strftime(at, f).alias(n) for f, n in (("%d/%m/%Y", "day"), ("%m/%Y", "month"), ("%Y-%j", "day_of_year"), ("%F at %T", "iso"), ("%b %d, %y", "short"))])


FORMAT_SQL = """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS "day", strftime(o_orderdate, '%m/%Y') AS "month", strftime(o_orderdate, '%Y-%j') AS day_of_year,
strftime(o_orderdate, '%Y-%m-%d at %H:%M:%S') AS iso, strftime(o_orderdate, '%b %d, %y') AS short FROM orders"""


def request_rows(spark, sf):
    nested = table(spark, sf, "customer").select(F.struct("c_nationkey", F.struct(F.col("c_mktsegment").alias("code")).alias("segment")).alias("payload"))
    return requests.request_rows(nested, {"nation": "payload.c_nationkey", "segment": "payload.segment.code"})


ROWS_SQL = "SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer"


def distinct_inputs(spark, sf):
    nested = table(spark, sf, "customer").select(F.struct("c_nationkey", F.struct(F.col("c_mktsegment").alias("code")).alias("segment")).alias("payload"))
    return requests.request_rows(nested, {"nation": "payload.c_nationkey", "segment": "payload.segment.code"}, distinct=True)


def request_plan(spark, sf):
    rows = requests.request_rows(table(spark, sf, "supplier"), {"nation": "s_nationkey"}, distinct=True, ordered=False)
    months = requests.month_windows(table(spark, sf, "events").agg(F.date_add(F.to_date(F.min("ts")), 14).alias("start"), F.date_add(F.to_date(F.max("ts")), 100).alias("end")))
    return requests.product(rows, months)


PLAN_SQL = """WITH b AS (SELECT CAST(min(ts) AS DATE) + 14 AS s, CAST(max(ts) AS DATE) + 100 AS e FROM events),
w AS (SELECT greatest(CAST(m AS DATE), s) AS window_start, least(last_day(CAST(m AS DATE)), e) AS window_end FROM (SELECT s, e, unnest(generate_series(CAST(date_trunc('month', s) AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM b))
SELECT s_nationkey AS nation, window_start, window_end FROM (SELECT DISTINCT s_nationkey FROM supplier), w"""


def request_params(spark, sf):
    plan = request_plan(spark, sf)
    params = requests.parameters({"nation": ("nation", None), "from": ("window_start", "%d/%m/%Y"), "to": ("window_end", "%d/%m/%Y")}, {"pageSize": "100"})
    return plan.select("nation", "window_start", requests.url("https://api.example.org/v1/{nation}/bids", params).alias("url"))


PARAMS_SQL = f"""SELECT nation, window_start, 'https://api.example.org/v1/' || nation || '/bids?from=' || replace(strftime(window_start, '%d/%m/%Y'), '/', '%2F') || '&pageSize=100&to=' || replace(strftime(window_end, '%d/%m/%Y'), '/', '%2F') AS url FROM ({PLAN_SQL})"""


def pending_requests(spark, sf):
    plan = request_plan(spark, sf)
    keyed = plan.withColumn("request_key", requests.content_key(plan.columns))
    done = keyed.where("nation % 3 = 0")
    dead = keyed.where("nation % 5 = 1 AND month(window_start) = 2")
    return requests.pending(keyed, done, dead)


PENDING_SQL = f"""SELECT *, 'nation=' || nation || '|window_end=' || window_end || '|window_start=' || window_start AS request_key FROM ({PLAN_SQL}) WHERE nation % 3 != 0 AND NOT (nation % 5 = 1 AND month(window_start) = 2)"""


def page_continuity(spark, sf):
    """Conversations as paged requests: a turn is a page, its text's length the number of records; every seventh turn is lost."""
    pages = table(spark, sf, "conversations").where("(conv_id + turn) % 7 != 3").groupBy("conv_id", "turn").agg(F.sum(F.length("text")).alias("records"))
    return requests.page_continuity(pages, "conv_id", "turn", "records", 120)


CONTINUITY_SQL = """WITH p AS (SELECT conv_id, turn, sum(length(text)) AS records FROM conversations WHERE (conv_id + turn) % 7 != 3 GROUP BY 1, 2),
w AS (SELECT *, records < 120 AS final, lag(turn) OVER o AS b, lead(turn) OVER o AS a FROM p WINDOW o AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT conv_id, count(*) AS n_pages, max(turn) AS last_page, CAST(sum(greatest(turn - coalesce(b, -1) - 1, 0)) AS BIGINT) AS n_missing, count(*) FILTER (final AND a IS NOT NULL) AS n_premature, arg_max(final, turn) AS stopped FROM w GROUP BY 1)
SELECT *, stopped AND n_missing = 0 AS complete, CASE WHEN NOT stopped THEN last_page + 1 END AS next_page FROM s"""


def offset_continuity(spark, sf):
    """Customers' orders read by offsets of 4, the page of every eleventh order lost: gaps and the next offset."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("i"))
    pages = orders.groupBy("o_custkey", F.expr("i DIV 4 * 4").alias("offset")).agg(F.count(F.lit(1)).alias("records"), F.min("o_orderkey").alias("first")).where("first % 11 != 0")
    return requests.page_continuity(pages, "o_custkey", "offset", "records", 4, step=4)


OFFSET_SQL = """WITH o AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 * 4 AS "offset" FROM orders),
p AS (SELECT o_custkey, "offset", count(*) AS records FROM o GROUP BY ALL HAVING min(o_orderkey) % 11 != 0),
w AS (SELECT *, records < 4 AS final, lag("offset") OVER o AS b, lead("offset") OVER o AS a FROM p WINDOW o AS (PARTITION BY o_custkey ORDER BY "offset")),
s AS (SELECT o_custkey, count(*) AS n_pages, max("offset") AS last_page, CAST(sum(("offset" - coalesce(b, -4)) // 4 - 1) AS BIGINT) AS n_missing, count(*) FILTER (final AND a IS NOT NULL) AS n_premature, arg_max(final, "offset") AS stopped FROM w GROUP BY 1)
SELECT *, stopped AND n_missing = 0 AS complete, CASE WHEN NOT stopped THEN last_page + 4 END AS next_page FROM s"""


def pattern_checkpoints(spark, sf):
    """Months of the orders as checkpoints spelt month first: 01/1997 comes after 12/1996; one status has texts of another kind."""
    month = F.date_format("o_orderdate", "MM/yyyy")
    months = table(spark, sf, "orders").select("o_orderstatus", F.to_date(F.trunc("o_orderdate", "MM")).alias("recorded_at"), F.when((F.col("o_orderstatus") != "P") | (F.month("o_orderdate") != 4), month).otherwise(F.lit("later")).alias("mark")).distinct()
    found = increment.decisions(months, ["o_orderstatus"], "mark", "recorded_at", pattern="%m/%Y")
    fresh = increment.newer(months, "mark", "11/1996", "pattern:%m/%Y").select("o_orderstatus", "recorded_at", "mark", F.lit(True).alias("is_new"))
    top = increment.max_checkpoint(months, "mark", ["o_orderstatus"], "%m/%Y").select("o_orderstatus", "kind", F.col("value").alias("greatest"))
    return found.join(fresh, ["o_orderstatus", "recorded_at", "mark"], "left").join(top, "o_orderstatus").withColumn("is_new", F.coalesce("is_new", F.lit(False)))


PATTERN_SQL = """WITH m AS (SELECT DISTINCT o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS recorded_at, CASE WHEN o_orderstatus != 'P' OR month(o_orderdate) != 4 THEN strftime(o_orderdate, '%m/%Y') ELSE 'later' END AS mark FROM orders),
k AS (SELECT *, bool_or(mark = 'later') OVER (PARTITION BY o_orderstatus) AS is_text FROM m),
t AS (SELECT *, CASE WHEN is_text THEN mark ELSE strftime(recorded_at, '%Y-%m') END AS key FROM k),
w AS (SELECT *, max(key) OVER o AS top, arg_max(mark, key) OVER o AS previous_value FROM t WINDOW o AS (PARTITION BY o_orderstatus ORDER BY recorded_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_orderstatus, recorded_at, mark, previous_value, CASE WHEN top IS NULL OR key > top THEN 'advanced' WHEN key = top THEN 'reused' ELSE 'retained' END AS decision, mark = 'later' OR recorded_at > DATE '1996-11-01' AS is_new,
CASE WHEN is_text THEN 'text' ELSE 'pattern' END AS kind, arg_max(mark, key) OVER (PARTITION BY o_orderstatus) AS greatest FROM w"""


def marked_events(spark, sf):
    """Events with a checkpoint value as text: an instant for most types, a number for views, plain text for clicks."""
    events = table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    number = F.get_json_object("props", "$.k")
    mark = F.when(F.col("event_type") == "view", number).when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd")).otherwise(iso)
    return events.withColumn("mark", mark)


MARKED = """(SELECT *, CASE event_type WHEN 'view' THEN json_extract_string(props, '$.k') WHEN 'click' THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS mark FROM events)"""


def max_checkpoint(spark, sf):
    return increment.max_checkpoint(marked_events(spark, sf), "mark", ["event_type"])


MAX_SQL = f"""SELECT event_type, CASE event_type WHEN 'view' THEN 'decimal' WHEN 'click' THEN 'text' ELSE 'datetime' END AS kind,
CASE event_type WHEN 'view' THEN CAST(max(TRY_CAST(mark AS BIGINT)) AS VARCHAR) ELSE max(mark) END AS value FROM {MARKED} GROUP BY event_type"""


def incremental_filter(spark, sf):
    events = table(spark, sf, "events").withColumn("mark", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).withColumn("mark", F.when(F.col("event_id") % 50 != 0, F.col("mark")))
    stored = spark.range(1).select(lookback(F.lit("2024-01-20T00:00:00Z"), 3).alias("s")).first()["s"]
    return increment.newer(events, "mark", stored, "datetime").select("event_id", "mark")


FILTER_SQL = "SELECT event_id, CASE WHEN event_id % 50 != 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS mark FROM events WHERE event_id % 50 = 0 OR date_trunc('second', ts) > TIMESTAMP '2024-01-17 00:00:00'"


def checkpoint_decisions(spark, sf):
    """A user's daily maximum of the event value, as candidates for a checkpoint; every thirteenth user is unknown."""
    known = table(spark, sf, "events").withColumn("user_id", F.when(F.col("user_id") % 13 != 0, F.col("user_id")))
    daily = known.groupBy("user_id", F.to_date("ts").alias("recorded_at")).agg(F.floor(F.max("value")).cast("long").alias("candidate"))
    given = daily.withColumn("candidate", F.when(F.col("candidate") % 11 != 0, F.col("candidate")).cast("string"))
    return increment.decisions(given, ["user_id"], "candidate", "recorded_at").select("user_id", "recorded_at", "candidate", "previous_value", "decision")


DECISION_SQL = """WITH d AS (SELECT CASE WHEN user_id % 13 != 0 THEN user_id END AS user_id, CAST(ts AS DATE) AS recorded_at, CAST(floor(max(value)) AS BIGINT) AS c FROM events GROUP BY 1, 2),
g AS (SELECT user_id, recorded_at, CASE WHEN c % 11 != 0 THEN c END AS c FROM d),
w AS (SELECT *, max(c) OVER (PARTITION BY user_id ORDER BY recorded_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM g)
SELECT user_id, recorded_at, CAST(c AS VARCHAR) AS candidate, CAST(p AS VARCHAR) AS previous_value, CASE WHEN c IS NULL THEN 'skipped' WHEN p IS NULL OR c > p THEN 'advanced' WHEN c = p THEN 'reused' ELSE 'retained' END AS decision FROM w"""


def stored_checkpoints(spark, sf):
    return increment.current_checkpoints(checkpoint_decisions(spark, sf), ["user_id"], "candidate")


STORED_SQL = f"SELECT user_id, arg_max(candidate, recorded_at) AS checkpoint, max(recorded_at) AS advanced_at FROM ({DECISION_SQL}) WHERE decision = 'advanced' GROUP BY 1"


def checkpoint_history(spark, sf):
    """The candidates of the later days, added to a history of the earlier ones."""
    daily = checkpoint_decisions(spark, sf).select("user_id", "recorded_at", "candidate")
    early = F.dayofmonth("recorded_at") <= 15
    return increment.appended(daily.where(early), daily.where(~early), ["user_id"], "candidate", "recorded_at").select("user_id", "recorded_at", "candidate", "previous_value", "decision")


HISTORY_SQL = f"SELECT * FROM ({DECISION_SQL}) WHERE day(recorded_at) > 15"


def resume_plan(spark, sf):
    """Pages left of a plan over all lines by return flag, whose first half is done, one flag not begun."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    half = lines.where("l_orderkey % 2 = 0 AND l_returnflag != 'R' AND l_orderkey < 3000")
    keys = ["l_returnflag", "l_orderkey", "l_linenumber"]
    return requests.resumed(lines, requests.progress(half, *keys), *keys)


RESUME_SQL = """WITH m AS (SELECT l_returnflag, max(l_orderkey * 100 + l_linenumber) AS mark FROM lineitem WHERE l_orderkey % 2 = 0 AND l_returnflag != 'R' AND l_orderkey < 3000 GROUP BY 1)
SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem LEFT JOIN m USING (l_returnflag) WHERE mark IS NULL OR l_orderkey * 100 + l_linenumber > mark"""


def first_wins(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return increment.upsert(docs, ["text"], [F.col("doc_id")]).select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"))


FIRST_SQL = "SELECT doc_id, lang, source, sha256(text) AS text_sha256 FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"


def latest_wins(spark, sf):
    events = table(spark, sf, "events")
    return increment.upsert(events, ["user_id"], [F.col("ts"), F.col("event_id")], keep="latest")


LATEST_SQL = "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


def latest_version(spark, sf):
    """Files named for each status and month of the orders; P has none with a date."""
    months = table(spark, sf, "orders").select("o_orderstatus", F.date_format("o_orderdate", "yyyy_MM").alias("m")).distinct()
    files = months.withColumn("filename", F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("orders_"), F.regexp_replace("m", "[0-9_]+", "x"), F.lit(".csv"))).otherwise(F.concat(F.lit("orders_"), "m", F.lit(".csv"))))
    return increment.latest_version(increment.with_version(files.select("o_orderstatus", "filename")), ["o_orderstatus"])


VERSION_SQL = """WITH f AS (SELECT DISTINCT o_orderstatus, strftime(o_orderdate, '%Y_%m') AS m FROM orders)
SELECT o_orderstatus, count(*) AS n_files, o_orderstatus = 'P' AND count(*) > 1 AS ambiguous, CASE WHEN NOT (o_orderstatus = 'P' AND count(*) > 1) THEN CASE WHEN o_orderstatus = 'P' THEN 'orders_x.csv' ELSE 'orders_' || max(m) || '.csv' END END AS filename, CASE WHEN o_orderstatus != 'P' THEN replace(max(m), '_', '-') END AS version FROM f GROUP BY 1"""


def selected_files(spark, sf):
    """Files of five groups, with versions of text, numbers, instants, two kinds, and one missing: the latest of each, and the first group's new ones."""
    months = table(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).alias("g"), F.date_format("o_orderdate", "yyyy-MM").alias("m")).distinct()
    g, number = F.col("g"), F.replace("m", F.lit("-"), F.lit(""))
    even = F.substring("m", 6, 2).cast("int") % 2 == 0
    version = F.when(g == "1", F.col("m")).when(g == "2", number).when(g == "3", F.concat("m", F.lit("-01T00:00:00Z"))).when(g == "4", F.when(even, number).otherwise(F.concat(F.lit("v"), "m"))).otherwise(F.when(F.col("m") != "1996-01", F.col("m")))
    files = months.select("g", F.concat("g", F.lit("/"), "m").alias("path"), version.alias("version"))
    latest = increment.selected_files(files, ["g"]).withColumn("mode", F.lit("latest"))
    fresh = increment.selected_files(files.where("g = '1'"), ["g"], "incremental", "1996-06").withColumn("mode", F.lit("incremental"))
    return latest.unionByName(fresh)


SELECTED_SQL = """WITH m AS (SELECT DISTINCT o_orderpriority[1] AS g, strftime(o_orderdate, '%Y-%m') AS m FROM orders),
f AS (SELECT g, g || '/' || m AS path, CASE g WHEN '1' THEN m WHEN '2' THEN replace(m, '-', '') WHEN '3' THEN m || '-01T00:00:00Z' WHEN '4' THEN CASE WHEN CAST(m[6:7] AS INTEGER) % 2 = 0 THEN replace(m, '-', '') ELSE 'v' || m END ELSE CASE WHEN m != '1996-01' THEN m END END AS version FROM m),
a AS (SELECT *, count(*) OVER (PARTITION BY g) > 1 AND count(*) FILTER (version IS NULL) OVER (PARTITION BY g) > 0 AS ambiguous FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY version IS NOT NULL AND starts_with(version, 'v') DESC, version DESC) AS i FROM a)
SELECT g, path, version, ambiguous, 'latest' AS mode FROM r WHERE ambiguous OR i = 1 UNION ALL SELECT g, path, version, ambiguous, 'incremental' FROM r WHERE g = '1' AND version > '1996-06'"""


def latest_run(spark, sf):
    runs = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"), F.to_date("o_orderdate").alias("ingestion_date"), F.col("o_orderpriority").alias("run_id"))
    return increment.latest_run(runs, ["o_orderstatus"])


LATEST_RUN_SQL = """SELECT o_orderstatus, d AS ingestion_date, p AS run_id, o_orderkey FROM (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p FROM orders)
QUALIFY (d, p) = max((d, p)) OVER (PARTITION BY o_orderstatus)"""

QUERIES = {
    "selected_files": selected_files, "offset_continuity": offset_continuity, "pattern_checkpoints": pattern_checkpoints,
    "day_windows": day_windows, "month_windows": month_windows, "format_dates": format_dates, "request_rows": request_rows, "distinct_inputs": distinct_inputs, "request_plan": request_plan,
    "request_params": request_params, "pending_requests": pending_requests, "page_continuity": page_continuity, "max_checkpoint": max_checkpoint, "incremental_filter": incremental_filter,
    "checkpoint_history": checkpoint_history, "resume_plan": resume_plan, "checkpoint_decisions": checkpoint_decisions, "stored_checkpoints": stored_checkpoints, "first_wins": first_wins, "latest_wins": latest_wins, "latest_version": latest_version, "latest_run": latest_run,
}
ORACLES = {
    "selected_files": SELECTED_SQL, "offset_continuity": OFFSET_SQL, "pattern_checkpoints": PATTERN_SQL,
    "day_windows": DAY_SQL, "month_windows": MONTH_SQL, "format_dates": FORMAT_SQL, "request_rows": ROWS_SQL, "distinct_inputs": ROWS_SQL.replace("SELECT", "SELECT DISTINCT"), "request_plan": PLAN_SQL,
    "request_params": PARAMS_SQL, "pending_requests": PENDING_SQL, "page_continuity": CONTINUITY_SQL, "max_checkpoint": MAX_SQL, "incremental_filter": FILTER_SQL,
    "checkpoint_history": HISTORY_SQL, "resume_plan": RESUME_SQL, "checkpoint_decisions": DECISION_SQL, "stored_checkpoints": STORED_SQL, "first_wins": FIRST_SQL, "latest_wins": LATEST_SQL, "latest_version": VERSION_SQL, "latest_run": LATEST_RUN_SQL,
}
