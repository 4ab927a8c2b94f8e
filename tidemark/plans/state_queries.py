"""Queries on versions, checkpoints, gated loads, replays, hooks, payloads and archives of any size."""

from __future__ import annotations

import io
import tarfile
import zipfile

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions.values import field
from tidemark.operators import audit, documents, hooks, increment, payloads, publish, quality, versioned
from tidemark.plans.common import scratch, table
from tidemark.sources import archive_source, scan
from tidemark.streaming.landing import load_available


def _published(spark, sf):
    """Orders of even keys; then some twice, which the gate stops; then those of odd keys, added: the folder, and the version after each."""
    orders, at = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), scratch(spark)
    check = lambda df: quality.checks(df, ["o_orderkey"], [["o_orderkey"]])
    failed, versions = orders.where("o_orderstatus = 'F'"), []
    for df, mode in ((orders.where("o_orderkey % 2 = 0"), "overwrite"), (failed.unionAll(failed), "overwrite"), (orders.where("o_orderkey % 2 = 1"), "append")):
        try:
            publish.publish(df, at, check, mode=mode)
        except quality.QualityError:
            pass
        versions.append(versioned.current(spark, at))
    return at, versions


def published_versions(spark, sf):
    """What readers of each version see; a failed publication makes none, and an old version stays as it was."""
    at, versions = _published(spark, sf)
    seen = [versioned.read(spark, at, v).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(step).alias("step"), F.lit(v.number).cast("long").alias("version"), "o_orderstatus", "n_rows") for step, v in enumerate(versions, 1)]
    return seen[0].unionAll(seen[1]).unionAll(seen[2])


VERSIONS_SQL = """SELECT step, version, o_orderstatus, count(*) AS n_rows FROM orders, (VALUES (1, CAST(1 AS BIGINT)), (2, 1), (3, 2)) v(step, version) WHERE step = 3 OR o_orderkey % 2 = 0 GROUP BY ALL"""


def gate_reports(spark, sf):
    """The reports that these publications left, of the failed one, too."""
    at, _ = _published(spark, sf)
    return publish.reports(spark, at).select("version", "records", "phase", "name", "outcome", "n_failures", "details")


GATE_SQL = """WITH p AS (SELECT 1 AS i, CAST(1 AS BIGINT) AS version, count(*) AS records, CAST(0 AS BIGINT) AS n, NULL AS d FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 3, 2, count(*), 0, NULL FROM orders WHERE o_orderkey % 2 = 1
UNION ALL SELECT 2, 2, 2 * count(*), count(*), (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT '{"o_orderkey":' || o_orderkey || '}' AS k FROM orders WHERE o_orderstatus = 'F' ORDER BY k LIMIT 5)) FROM orders WHERE o_orderstatus = 'F')
SELECT version, records, 'data' AS phase, 'required_fields' AS name, 'passed' AS outcome, CAST(0 AS BIGINT) AS n_failures, NULL AS details FROM p UNION ALL SELECT version, records, 'data', 'unique_fields', CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END, n, d FROM p
UNION ALL SELECT version, records, 'data', 'schema_expectations', 'skipped', 0, NULL FROM p"""


def checkpoint_states(spark, sf):
    """Checkpoints after three batches of a user's daily runs: a day with an error is a run that failed, and moves none."""
    known = table(spark, sf, "events").withColumn("user_id", F.when(F.col("user_id") % 13 != 0, F.col("user_id")))
    daily = known.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.floor(F.max("value")).cast("long").cast("string").alias("candidate"), (F.count_if(F.col("event_type") == "error") == 0).alias("succeeded"))
    at, version = scratch(spark), None
    for part in ("day(day) <= 10", "day(day) BETWEEN 11 AND 20", "day(day) > 20"):
        version = increment.advance(spark, at, daily.where(part), ["user_id"], "candidate", "day", "succeeded", after=version)
    return versioned.read(spark, at, version).select("user_id", "checkpoint", F.to_date("advanced_at").alias("advanced_on"))


STATES_SQL = """WITH d AS (SELECT CASE WHEN user_id % 13 != 0 THEN user_id END AS user_id, CAST(ts AS DATE) AS day, CAST(floor(max(value)) AS BIGINT) AS c, count(*) FILTER (event_type = 'error') = 0 AS ok FROM events GROUP BY 1, 2),
o AS (SELECT user_id, c, CASE WHEN day(day) <= 10 THEN 1 WHEN day(day) <= 20 THEN 2 ELSE 3 END AS part, day FROM d WHERE ok)
SELECT user_id, CAST(max(c) AS VARCHAR) AS checkpoint, arg_min(day, (-c, part, day)) AS advanced_on FROM o GROUP BY user_id"""


def gated_load(spark, sf):
    """Events landed in two parts; the second lacks types and does not pass the gate until that is allowed, and is then loaded once."""
    events, at = table(spark, sf, "events"), scratch(spark)
    events = events.withColumn("event_type", F.when((F.col("event_id") % 3 == 0) | (F.col("event_id") % 40 != 7), F.col("event_type")))
    strict = lambda df: quality.checks(df, ["event_id", "event_type"], [["event_id"]])
    lenient = lambda df: quality.checks(df, ["event_id"], [["event_id"]])

    def load(checks):
        try:
            return load_available(spark, f"{at}/landed", events.schema, f"{at}/loaded", f"{at}/state", checks=checks)
        except StreamingQueryException:
            return -1

    counts = []
    for part, checks in (("event_id % 3 = 0", strict), ("event_id % 3 != 0", strict), (None, strict), (None, lenient), (None, strict)):
        if part:
            publish.write_path(events.where(part), f"{at}/landed", mode="append")
        counts.append(load(checks))
    loaded = versioned.read(spark, f"{at}/loaded")
    return loaded.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_ids")).select("*", *[F.lit(n).cast("long").alias(f"load_{i}") for i, n in enumerate(counts, 1)])


GATED_SQL = """SELECT CASE WHEN event_id % 3 = 0 OR event_id % 40 != 7 THEN event_type END AS event_type, count(*) AS n_rows, count(DISTINCT event_id) AS n_ids, (SELECT count(*) FROM events WHERE event_id % 3 = 0) AS load_1, CAST(-1 AS BIGINT) AS load_2, CAST(-1 AS BIGINT) AS load_3,
(SELECT count(*) FROM events WHERE event_id % 3 != 0) AS load_4, CAST(0 AS BIGINT) AS load_5 FROM events GROUP BY 1"""


def replayed_catalog(spark, sf):
    """Catalog pages of two requests that overlap, landed and replayed: the entities, and how many differ from those of the live pages."""
    customers = table(spark, sf, "customer").withColumn("page", F.expr("c_custkey DIV 500"))
    both = customers.where("c_custkey % 3 != 0").withColumn("request_index", F.lit(1)).unionByName(customers.withColumn("request_index", F.lit(2)).withColumn("c_name", F.lower("c_name")))
    # five hundred customers in a page at most
    listed = F.array_sort(F.collect_list(F.struct(F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("title"))))
    pages = both.groupBy("request_index", "page").agg(F.to_json(F.struct(listed.alias("datasets"))).alias("text"))
    landed = pages.select("request_index", F.format_string("response/page-%06d.json", "page").alias("artifact"), "text")
    at = scratch(spark)
    publish.write_path(landed, f"{at}/landed", "jsonl", "overwrite")
    replayed = documents.replayed(scan.read_paths(spark, [f"{at}/landed"], "jsonl", landed.schema)).select("entity_type", "entity_key", "request_index", "page_number", "payload")
    live = documents.merged(documents.entity_tree(documents.parsed(pages.select("request_index", F.col("page").alias("page_number"), "text"), "text").drop("text"), levels=1), ["request_index", "page_number", "position"]).select(*replayed.columns)
    differing = audit.table_difference(replayed, live).agg(F.count(F.lit(1)).alias("n_differing"))
    return replayed.crossJoin(F.broadcast(differing))  # one row


REPLAY_SQL = """SELECT 'dataset' AS entity_type, 'd' || c_custkey AS entity_key, CAST(CASE WHEN c_custkey % 3 != 0 THEN 1 ELSE 2 END AS INTEGER) AS request_index, c_custkey // 500 AS page_number,
'{"id":"d' || c_custkey || '","title":"' || CASE WHEN c_custkey % 3 != 0 THEN c_name ELSE lower(c_name) END || '"}' AS payload, CAST(0 AS BIGINT) AS n_differing FROM customer"""


HOOKS = hooks.Hooks()


@HOOKS.register("plan", "large_only")
def _large_only(df):
    return df.where("c_acctbal > 0")


@HOOKS.register("request", "with_format")
def _with_format(df):
    return df.withColumn("url", F.concat("url", F.lit("&format=json")))


@HOOKS.register("checkpoint", "a_step_back")
def _a_step_back(df):
    return df.withColumn("checkpoint", F.col("checkpoint") - 1)


@HOOKS.register("payload", "unwrap")
def _unwrap(df):
    return df.withColumn("payload", F.coalesce(F.try_variant_get("payload", "$.body", "variant"), F.col("payload")))


@HOOKS.register("cursor", "from_last")
def _from_last(df):
    return df.withColumn("next_cursor", F.coalesce("next_cursor", F.concat(F.lit("k"), F.col("request_key").cast("string"))))


@HOOKS.register("records", "even")
def _even(df):
    return df.where("record_index % 2 = 0")


@HOOKS.register("metadata", "segment")
def _segment(df):
    return df.unionByName(df.select("request_key", F.lit("hook").alias("key"), F.lit("applied").alias("value")).distinct())


def api_hooks(spark, sf):
    """Requests of customers through hooks of every point of a paged source."""
    plan = HOOKS.apply(table(spark, sf, "customer").select(F.col("c_custkey").alias("request_key"), "c_acctbal", "c_nationkey"), "plan", ["large_only"])
    asked = HOOKS.apply(plan.select("*", F.concat(F.lit("https://api.example.org/c?k="), "request_key").alias("url"), F.col("request_key").alias("checkpoint")), "request", ["with_format"])
    asked = HOOKS.apply(asked, "checkpoint", ["a_step_back"])
    body = F.format_string('{"body":{"cursor":%s,"records":[{"n":%d},{"n":%d},{"n":%d}]}}', F.when(F.col("request_key") % 2 == 0, F.lit("null")).otherwise(F.lit('"c"')), "request_key", F.col("request_key") + 1, F.col("request_key") + 2)
    got = HOOKS.apply(asked.withColumn("payload", F.parse_json(body)), "payload", ["unwrap"])
    paged = HOOKS.apply(got.withColumn("next_cursor", field(F.col("payload"), "cursor")), "cursor", ["from_last"])
    each = HOOKS.apply(documents.records(paged, "payload"), "records", ["even"])
    notes = HOOKS.apply(each.select("request_key", F.lit("nation").alias("key"), F.col("c_nationkey").cast("string").alias("value")).distinct(), "metadata", ["segment"])
    told = notes.groupBy("request_key").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "key", "value"))), ",").alias("metadata"))
    return each.select("request_key", "url", "checkpoint", "next_cursor", "record_index", field(F.col("record"), "n", "bigint").alias("n")).join(told, "request_key")


API_HOOKS_SQL = """SELECT c_custkey AS request_key, 'https://api.example.org/c?k=' || c_custkey || '&format=json' AS url, c_custkey - 1 AS checkpoint, CASE WHEN c_custkey % 2 = 0 THEN 'k' || c_custkey ELSE 'c' END AS next_cursor,
CAST(i AS INTEGER) AS record_index, c_custkey + i AS n, 'hook=applied,nation=' || c_nationkey AS metadata FROM customer, (VALUES (0), (2)) r(i) WHERE c_acctbal > 0"""


@HOOKS.register("discovered", "drop_drafts")
def _drop_drafts(df):
    return df.where("NOT path LIKE '%.draft'")


@HOOKS.register("version", "of_size")
def _of_size(df):
    return df.withColumn("version", F.coalesce("version", F.concat(F.lit("size-"), F.col("p_size").cast("string"))))


@HOOKS.register("checksum", "of_name")
def _of_name(df):
    return df.withColumn("expected", F.coalesce("expected", F.sha2("path", 256)))


@HOOKS.register("links", "mirror")
def _mirror(df):
    return df.withColumn("url", F.concat(F.lit("https://mirror.example.org/"), "path"))


@HOOKS.register("download", "upper")
def _upper(df):
    return df.withColumn("content", F.upper("content"))


def file_hooks(spark, sf):
    """Files named for parts through hooks of every point of a file source, the rows of those that keep them compared."""
    parts = table(spark, sf, "part")
    found = parts.select(F.concat("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.lit(".draft")).otherwise(F.lit(".csv"))).alias("path"), "p_size", "p_name", F.when(F.col("p_partkey") % 2 == 0, F.lit("2024")).alias("version"), F.when(F.col("p_partkey") % 3 == 0, F.sha2("p_name", 256)).alias("expected"), F.lit(None).cast("string").alias("url"), F.lower("p_name").alias("content"))
    found = HOOKS.apply(HOOKS.apply(found, "discovered", ["drop_drafts"]), "links", ["mirror"])
    for family, name in (("version", "of_size"), ("checksum", "of_name"), ("download", "upper")):
        found = HOOKS.checked(found, family, [name], ["path"])
    return found.select("path", "version", "expected", "url", F.sha2("content", 256).alias("content_hash"))


FILE_HOOKS_SQL = """SELECT p_partkey || '.csv' AS path, CASE WHEN p_partkey % 2 = 0 THEN '2024' ELSE 'size-' || p_size END AS version, CASE WHEN p_partkey % 3 = 0 THEN sha256(p_name) ELSE sha256(p_partkey || '.csv') END AS expected,
'https://mirror.example.org/' || p_partkey || '.csv' AS url, sha256(upper(p_name)) AS content_hash FROM part WHERE p_partkey % 5 != 0"""


@HOOKS.register("entities", "titled")
def _titled(df):
    return df.where(field(F.col("data"), "title").isNotNull())


def catalog_hooks(spark, sf):
    """Suppliers as entities of a catalog, of which a hook keeps those that have a title."""
    suppliers = table(spark, sf, "supplier")
    made = suppliers.select("s_suppkey", F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("id"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("title"))).alias("datasets"))).alias("text"))
    tree = documents.entity_tree(documents.parsed(made, "text").drop("text"), levels=1, transform=lambda df: HOOKS.apply(df, "entities", ["titled"]))
    return tree.select("s_suppkey", "entity_type", "entity_key", "record_path")


CATALOG_HOOKS_SQL = "SELECT s_suppkey, 'dataset' AS entity_type, 'd' || s_suppkey AS entity_key, 'payload.datasets[0]' AS record_path FROM supplier WHERE s_suppkey % 4 != 0"


def decoded_payloads(spark, sf):
    """Customers' names as payloads of four kinds and five charsets, with unknown charsets, broken bytes and broken JSON among them."""
    key = F.col("c_custkey")
    kind = F.element_at(F.array(*map(F.lit, payloads.KINDS)), (key % 4 + 1).cast("int"))
    charset = F.element_at(F.array(*map(F.lit, ("utf-8", "ISO-8859-1", "utf-16le", "us-ascii", "klingon"))), (key % 5 + 1).cast("int"))
    name = F.concat(F.when(key % 5 != 3, F.lit("ã")).otherwise(F.lit("")), "c_name")
    one = F.concat(F.lit('{"n":"'), name, F.lit('"}'))
    text = F.when(key % 4 == 2, F.when(key % 7 == 2, F.substr(one, F.lit(1), F.lit(5))).otherwise(one)).when(key % 4 == 3, F.concat(one, F.lit("\n\n{oops\n[1]"))).otherwise(name)
    content = F.when(key % 5 == 1, F.encode(text, "ISO-8859-1")).when(key % 5 == 2, F.encode(text, "UTF-16LE")).otherwise(F.encode(text, "UTF-8"))
    broken = F.when(key % 11 == 3, F.concat(content, F.unhex(F.lit("80")))).otherwise(content)
    landed = table(spark, sf, "customer").select("c_custkey", kind.alias("kind"), payloads.declared_charset(F.concat(F.lit("text/plain; Charset="), charset)).alias("charset"), broken.alias("content"))
    return payloads.decoded(landed).select("c_custkey", "kind", "charset", "position", "text", F.to_json("document").alias("document"), "error")


DECODED_SQL = """WITH c AS (SELECT c_custkey, ['binary', 'text', 'json', 'jsonl'][c_custkey % 4 + 1] AS kind, ['utf-8', 'iso-8859-1', 'utf-16le', 'us-ascii', 'klingon'][c_custkey % 5 + 1] AS charset, CASE WHEN c_custkey % 5 != 3 THEN 'ã' ELSE '' END || c_name AS name FROM customer),
e AS (SELECT *, '{"n":"' || name || '"}' AS one, CASE WHEN kind = 'binary' THEN NULL WHEN charset = 'klingon' THEN 'charset' WHEN c_custkey % 11 = 3 AND charset != 'iso-8859-1' THEN 'encoding' END AS failure,
 CASE WHEN c_custkey % 11 = 3 AND charset = 'iso-8859-1' THEN chr(128) ELSE '' END AS tail FROM c)
SELECT c_custkey, kind, charset, 0 AS position, NULL AS text, NULL AS document, failure AS error FROM e WHERE kind = 'binary' OR failure IS NOT NULL
UNION ALL SELECT c_custkey, kind, charset, 0, name || tail, NULL, NULL FROM e WHERE kind = 'text' AND failure IS NULL
UNION ALL SELECT c_custkey, kind, charset, 0, CASE WHEN c_custkey % 7 = 2 THEN one[1:5] ELSE one END || tail, CASE WHEN c_custkey % 7 != 2 AND tail = '' THEN one END, CASE WHEN c_custkey % 7 = 2 OR tail != '' THEN 'json' END FROM e WHERE kind = 'json' AND failure IS NULL
UNION ALL SELECT c_custkey, kind, charset, p, CASE p WHEN 1 THEN one WHEN 3 THEN '{oops' ELSE '[1]' || tail END, CASE WHEN p = 1 THEN one WHEN p = 4 AND tail = '' THEN '[1]' END, CASE WHEN p = 3 OR p = 4 AND tail != '' THEN 'json' END FROM e, (VALUES (1), (3), (4)) l(p) WHERE kind = 'jsonl' AND failure IS NULL"""


def _zipped(folder):
    """Each row's texts as the members of a zip or tar archive, written to the shared folder."""

    def write(frames):
        system, at = archive_source.file_system(folder)
        system.create_dir(at)
        for frame in frames:
            rows = []
            for number, members in zip(frame.number, frame.members):
                out, name = io.BytesIO(), f"{number}.{'tar' if number % 2 else 'zip'}"
                if number % 2:
                    with tarfile.open(fileobj=out, mode="w") as t:
                        for m in members:
                            info = tarfile.TarInfo(m["name"])
                            info.size = len(m["text"])
                            t.addfile(info, io.BytesIO(m["text"]))
                else:
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                        for m in members:
                            z.writestr(m["name"], m["text"])
                # whole at once, under a name of its own: a task that is tried again writes the same
                with system.open_output_stream(f"{at}/{name}") as stream:
                    stream.write(out.getvalue())
                rows.append((name, len(out.getvalue())))
            yield pd.DataFrame(rows, columns=["name", "length"])

    return write


def _archives(spark, sf):
    """Archives of a hundred documents each: their folder, and what was written."""
    docs, at = table(spark, sf, "documents"), f"{scratch(spark)}/archives"
    member = F.struct(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("text"))
    groups = docs.groupBy(F.expr("doc_id DIV 100").alias("number")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return at, groups.mapInPandas(_zipped(at), "name string, length long")


def streamed_members(spark, sf):
    """Members of archives in parts of 700 bytes, archives in ranges of 20,000: parts put together again have the checksum that the last part tells."""
    at, written = _archives(spark, sf)
    written.write.format("noop").mode("overwrite").save()
    parts = archive_source.streamed_members(spark, at, cell=700, span=20_000)
    whole = F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", F.hex("payload").alias("payload")))), lambda p: p["payload"]), ""))
    each = parts.groupBy("archive", "member").agg(F.count(F.lit(1)).alias("n_parts"), F.max("length").alias("length"), F.max("checksum").alias("checksum"), whole.alias("content"), F.max(F.length("payload")).alias("largest"), F.max("error").alias("error"))
    return each.select("archive", "member", "n_parts", "length", "checksum", (F.sha2("content", 256) == F.col("checksum")).alias("whole"), (F.col("largest") <= 700).alias("bounded"), "error")


STREAMED_SQL = """SELECT doc_id // 100 || CASE WHEN doc_id // 100 % 2 = 1 THEN '.tar' ELSE '.zip' END AS archive, doc_id || '.txt' AS member, greatest(1, (strlen(text) + 699) // 700) AS n_parts, CAST(strlen(text) AS BIGINT) AS length, sha256(text) AS checksum, TRUE AS whole, TRUE AS bounded, NULL AS error
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)"""


def file_digests(spark, sf):
    """The archives' digests, streamed, next to their lengths as written and those of their bytes read as cells."""
    at, written = _archives(spark, sf)
    publish.write_path(written, f"{at}-log", mode="overwrite")
    found = archive_source.file_digests(spark, at).withColumn("name", F.element_at(F.split("path", "/"), -1))
    cells = audit.checksums(scan.inventory(spark, at, content=True)).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("checksum").alias("of_cell"))
    log = spark.read.parquet(f"{at}-log").select("name", F.col("length").alias("written"))
    return found.join(log, "name").join(cells, "name").select("name", (F.col("length") == F.col("written")).alias("same_length"), (F.col("checksum") == F.col("of_cell")).alias("same_checksum"))


DIGESTS_SQL = "SELECT DISTINCT doc_id // 100 || CASE WHEN doc_id // 100 % 2 = 1 THEN '.tar' ELSE '.zip' END AS name, TRUE AS same_length, TRUE AS same_checksum FROM documents"

QUERIES = {
    "published_versions": published_versions, "gate_reports": gate_reports, "checkpoint_states": checkpoint_states, "gated_load": gated_load, "replayed_catalog": replayed_catalog,
    "api_hooks": api_hooks, "file_hooks": file_hooks, "catalog_hooks": catalog_hooks, "decoded_payloads": decoded_payloads, "streamed_members": streamed_members, "file_digests": file_digests,
}
ORACLES = {
    "published_versions": VERSIONS_SQL, "gate_reports": GATE_SQL, "checkpoint_states": STATES_SQL, "gated_load": GATED_SQL, "replayed_catalog": REPLAY_SQL,
    "api_hooks": API_HOOKS_SQL, "file_hooks": FILE_HOOKS_SQL, "catalog_hooks": CATALOG_HOOKS_SQL, "decoded_payloads": DECODED_SQL, "streamed_members": STREAMED_SQL, "file_digests": DIGESTS_SQL,
}
