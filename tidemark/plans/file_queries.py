"""Queries on files, links and archives.  Files are written from the tables and read back."""

from __future__ import annotations

import io
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.values import disposition_filename, file_format, identifier, is_direct_file, path_segment, redacted_url, type_format, url_filename
from tidemark.operators import audit, increment, publish, versioned
from tidemark.plans.common import scratch, table
from tidemark.sources import archives, links, scan, schema
from tidemark.streaming.landing import load_available


def page_links(spark, sf):
    found = links.page_links(table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.groupBy("page_id", "href", "target", "filename", "format").agg(F.count(F.lit(1)).alias("n_links"))


LINKS_SQL = r"""SELECT page_id, href, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS target, coalesce(nullif(regexp_extract(href, '([^/]*)/?$', 1), ''), 'download.bin') AS filename, 'text' AS format, count(*) AS n_links FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages)
WHERE href != '' AND NOT regexp_matches(lower(href), '^(#|javascript:|mailto:)') GROUP BY ALL"""


def relative_links(spark, sf):
    """Links with steps upwards and to the same folder, against each page's address."""
    steps = F.element_at(F.array(*[F.lit(x) for x in ("../../x.csv", "p/./q", "/p/../q.json?a=../b", "../../../up/", "./..")]), (F.col("page_id") % 5 + 1).cast("int"))
    base = F.concat(F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1), F.lit("/a/b/c.html?x=/y"))
    return table(spark, sf, "pages").select("page_id", links.resolved(base, steps).alias("target"))


RELATIVE_SQL = r"""SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || ['/x.csv', '/a/b/p/q', '/q.json?a=../b', '/up/', '/a/'][page_id % 5 + 1] AS target FROM pages"""


def header_names(spark, sf):
    """File names and formats of responses, by their headers."""
    header = F.concat(F.lit("attachment; filename"), F.when(F.col("page_id") % 3 == 0, F.lit("*=UTF-8''dir%2Fa%20")).when(F.col("page_id") % 3 == 1, F.lit('="b')), F.col("page_id").cast("string"), F.lit(".csv"))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("text/csv; charset=utf-8", "Application/JSON", "image/png", "application/zip")]), (F.col("page_id") % 4 + 1).cast("int"))
    return table(spark, sf, "pages").select("page_id", disposition_filename(F.coalesce(header, F.lit("inline"))).alias("filename"), type_format(kind).alias("format"))


HEADER_SQL = """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'a ' || page_id || '.csv' WHEN 1 THEN 'b' || page_id || '.csv' END AS filename, ['csv', 'json', NULL, 'binary'][page_id % 4 + 1] AS format FROM pages"""


def resolved_versions(spark, sf):
    """The version of each document as a downloaded file: by its name, its tag, its date, or its content."""
    i = F.col("doc_id") % 4
    files = table(spark, sf, "documents").select("doc_id", F.when(i == 0, F.concat(F.lit("data_2024_0"), F.col("doc_id") % 9 + 1, F.lit(".csv"))).otherwise("data.csv").alias("filename"), F.when(i == 1, F.concat(F.lit('"t'), "doc_id", F.lit('"'))).alias("etag"), F.when(i == 2, F.lit("Mon, 01 Jan 2024 00:00:00 GMT")).alias("last_modified"), F.col("text").alias("content"))
    return increment.resolved_version(files).select("doc_id", "version")


RESOLVED_SQL = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '2024-0' || (doc_id % 9 + 1) WHEN 1 THEN 't' || doc_id WHEN 2 THEN 'Mon, 01 Jan 2024 00:00:00 GMT' ELSE sha256(text) END AS version FROM documents"


def url_format(spark, sf):
    """The pages' URLs with file names added to them."""
    urls = table(spark, sf, "pages").select("page_id", F.concat(F.regexp_replace("url", "[?#].*$", ""), F.element_at(F.array(*[F.lit(x) for x in ("/a%20b.CSV?x=1", "/d.ndjson#f", "/e.tar.gz", "/f", "/g.xlsx")]), (F.col("page_id") % 5 + 1).cast("int"))).alias("url"))
    name = url_filename(F.col("url"))
    return urls.select("page_id", name.alias("filename"), file_format(name).alias("format"), is_direct_file(F.col("url")).alias("is_file"))


FORMAT_SQL = """SELECT page_id, ['a b.CSV', 'd.ndjson', 'e.tar.gz', 'f', 'g.xlsx'][page_id % 5 + 1] AS filename, ['csv', 'jsonl', 'binary', 'binary', 'binary'][page_id % 5 + 1] AS format, page_id % 5 != 3 AS is_file FROM pages"""


def redact_urls(spark, sf):
    url = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.when(F.col("page_id") % 2 == 0, F.lit("/index.php/s/AbC")).otherwise(F.lit("/x")), F.lit("?page=1&access_token="), F.col("page_id").cast("string"), F.lit("&My-Session-Id=9&q=key"))
    return table(spark, sf, "pages").select("page_id", redacted_url(url).alias("url"))


REDACT_SQL = """SELECT page_id, regexp_replace(url, '[?#].*$', '') || CASE WHEN page_id % 2 = 0 THEN '/index.php/s/***' ELSE '/x' END || '?page=1&access_token=***&My-Session-Id=***&q=key' AS url FROM pages"""


def html_rejects(spark, sf):
    """Bodies that are pages or empty: by their media type where the response names one, else by how they begin."""
    kind = F.when(F.col("page_id") % 3 == 0, "Text/HTML; charset=utf-8").when(F.col("page_id") % 3 == 1, "application/octet-stream")
    pages = table(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("path"), F.col("html").alias("body"), kind.alias("kind"))
    docs = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("path"), F.when(F.col("doc_id") % 50 != 0, F.col("text")).otherwise(F.lit("")).alias("body"), F.lit(None).cast("string").alias("kind"))
    return pages.unionByName(docs).select("path", links.looks_like_page(F.col("body"), F.col("kind")).alias("rejected"))


HTML_SQL = """SELECT path, body = '' OR CASE kind WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE regexp_matches(lower(ltrim(body)), '^(<!doctype html|<html|<head|<body)') END AS rejected FROM
(SELECT 'p' || page_id AS path, html AS body, page_id % 3 AS kind FROM pages UNION ALL SELECT 'd' || doc_id, CASE WHEN doc_id % 50 != 0 THEN text ELSE '' END, 2 FROM documents)"""


def content_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("checksum"))


HASH_SQL = "SELECT doc_id, sha256(text) AS checksum FROM documents"


def checksum_verify(spark, sf):
    docs = table(spark, sf, "documents")
    actual = docs.select(F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("checksum"))
    told = docs.where("doc_id % 3 != 0").select(F.col("doc_id").cast("string").alias("path"), F.upper(F.sha2(F.when(F.col("doc_id") % 20 == 1, F.lit("changed")).otherwise(F.col("text")), 256)).alias("checksum"))
    return audit.verify_checksums(actual, told).select("path", "status")


VERIFY_SQL = "SELECT CAST(doc_id AS VARCHAR) AS path, CASE WHEN doc_id % 3 = 0 THEN 'unverified' WHEN doc_id % 20 = 1 THEN 'mismatch' ELSE 'verified' END AS status FROM documents"


def extraction_summary(spark, sf):
    status = checksum_verify(spark, sf).join(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("path"), F.octet_length("text").alias("length")), "path")
    return audit.extraction_summary(status.withColumn("selected", F.col("status") != "mismatch"))


EXTRACTION_SQL = f"""SELECT count(*) AS discovered, count(*) FILTER (status != 'mismatch') AS selected, count(*) FILTER (status = 'verified') AS verified, count(*) FILTER (status = 'mismatch') AS skipped, CAST(sum(strlen(text)) AS BIGINT) AS bytes
FROM ({VERIFY_SQL}) JOIN documents ON path = CAST(doc_id AS VARCHAR)"""


def broken_events(spark, sf):
    return table(spark, sf, "events").withColumn("props", F.when(F.col("event_id") % 40 == 3, F.lit("{oops")).otherwise(F.col("props")))


def dead_letter_split(spark, sf):
    """Good and bad events of each type, and whether a budget of 40 lets the run go on."""
    return audit.within_budget(broken_events(spark, sf), F.try_parse_json("props").isNotNull(), 40, ["event_type"])


DEAD_SQL = """SELECT event_type, count(*) AS n_rows, count(*) FILTER (event_id % 40 != 3) AS n_good, count(*) FILTER (event_id % 40 = 3) AS n_bad,
count(*) FILTER (event_id % 40 = 3) = 0 OR (count(*) > 1 AND count(*) FILTER (event_id % 40 = 3) <= 40) AS continues FROM events GROUP BY 1"""


def dead_letters(spark, sf):
    """Dead letters that the registry of user 3's does not hold yet, one for each user and type."""
    _, bad = audit.split(broken_events(spark, sf), F.try_parse_json("props").isNotNull())
    return audit.new_dead_letters(bad.select("user_id", "event_type"), bad.where("user_id % 5 = 3").select("user_id", "event_type").distinct(), ["user_id", "event_type"])


LETTERS_SQL = "SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 40 = 3 AND user_id % 5 != 3"


def sanitize_ident(spark, sf):
    parts = table(spark, sf, "part")
    odd = F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_brand", F.lit("#"), "p_type")
    return parts.select("p_partkey", identifier(F.col("p_name")).alias("name"), identifier(odd).alias("odd"), path_segment(odd).alias("segment"))


IDENT_SQL = """SELECT p_partkey, regexp_replace(lower(trim(p_name)), '[^a-z0-9_]', '_', 'g') AS name, 't_' || regexp_replace(lower(p_size || ' ' || p_brand || '#' || p_type), '[^a-z0-9_]', '_', 'g') AS odd,
regexp_replace(regexp_replace(p_size || ' ' || p_brand || '#' || p_type, '[^A-Za-z0-9._-]+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g') AS segment FROM part"""


def csv_contract_read(spark, sf):
    """Customers written as CSV with a header, read back under a contract of another order, and headerless by position."""
    df, at = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), scratch(spark)
    publish.write_path(df, f"{at}/named", "csv", options={"header": "true", "sep": ";"})
    publish.write_path(df, f"{at}/plain", "csv", options={"header": "false", "sep": ";"})
    contract = schema.from_contract({"type": "struct", "fields": [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in (("c_acctbal", "double"), ("c_custkey", "long"))]})
    named = scan.read_csv(spark, [f"{at}/named"], contract, header=True)
    plain = scan.read_csv(spark, [f"{at}/plain"], schema.from_contract(["key", "name", "balance"]), header=False)
    return named.join(plain.select(F.col("key").cast("long").alias("c_custkey"), "name", F.col("_corrupt_record").isNull().alias("clean")), "c_custkey")


CSV_SQL = "SELECT c_custkey, c_acctbal, c_name AS name, TRUE AS clean FROM customer"


def json_modes_read(spark, sf):
    """Orders as JSON lines, read back."""
    df, at = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), scratch(spark)
    publish.write_path(df, f"{at}/lines", "jsonl")
    lines = scan.read_paths(spark, [f"{at}/lines"], "jsonl", df.schema)
    by_status = lines.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_lines"))
    return lines.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows")).join(by_status, "o_orderstatus")


JSON_SQL = "SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows, CAST(sum(count(*)) OVER (PARTITION BY o_orderstatus) AS BIGINT) AS n_lines FROM orders GROUP BY 1, 2"


def json_documents_read(spark, sf):
    """Orders as documents that span lines, a hundred records in each, read back whole, as a table of their type, and as the table of an inventory's files."""
    df, at = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), scratch(spark)
    page = F.col("o_orderkey") - F.col("o_orderkey") % 100
    records = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus")))
    # the time goes by files, not by bytes: as many tasks write them as a shuffle has parts
    spread = df.withColumn("page", page).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page")
    pages = spread.groupBy("page").agg(F.to_json(F.struct(records.alias("records")), {"pretty": "true"}).alias("text"))
    # a file for each document, in at most a hundred folders
    folder, name = F.coalesce(F.expr("pmod(page DIV 100, 100)"), F.lit(0)), F.concat(F.coalesce(F.col("page").cast("string"), F.lit("none")), F.lit(".json"))
    publish.write_documents(pages.select(folder.alias("folder"), name.alias("name"), "text"), f"{at}/pages")
    kind = "records array<struct<o_orderkey:bigint,o_orderstatus:string>>"
    whole = scan.read_documents(spark, [f"{at}/pages"]).select(F.explode(F.from_json("text", kind)["records"]).alias("r"))
    typed = scan.read_paths(spark, [f"{at}/pages"], "json", StructType.fromDDL(kind)).select(F.explode("records").alias("r"))
    files = scan.inventory(spark, f"{at}/pages", "part-*").withColumn("format", F.lit("json"))
    listed = scan.read_inventory(files, "json", StructType.fromDDL(kind)).select(F.explode("records").alias("r"))
    count = lambda rows, name: rows.groupBy(F.col("r.o_orderstatus").alias("o_orderstatus")).agg(F.count(F.lit(1)).alias(name), F.sum("r.o_orderkey").alias(f"sum_{name}"))
    return count(whole, "whole").join(count(typed, "typed"), "o_orderstatus").join(count(listed, "listed"), "o_orderstatus")


DOCUMENTS_SQL = "SELECT o_orderstatus, count(*) AS whole, CAST(sum(o_orderkey) AS BIGINT) AS sum_whole, count(*) AS typed, CAST(sum(o_orderkey) AS BIGINT) AS sum_typed, count(*) AS listed, CAST(sum(o_orderkey) AS BIGINT) AS sum_listed FROM orders GROUP BY 1"


def rehydrated(spark, sf):
    """Customers' names as plain files and as members of archives, one inventory of both."""
    texts = table(spark, sf, "customer").groupBy(F.expr("c_custkey DIV 100").alias("c_nationkey")).agg(F.array_join(F.array_sort(F.collect_list("c_name")), "\n").alias("text"))
    made = texts.mapInPandas(_archived, "path string, content binary")
    plain = texts.select(F.concat(F.lit("plain/"), "c_nationkey", F.lit(".csv")).alias("path"), F.col("text").cast("binary").alias("content"))
    return archives.rehydrated(made.unionByName(plain), "*.csv").select("path", F.sha2("content", 256).alias("checksum"))


REHYDRATED_SQL = """WITH t AS (SELECT c_custkey // 100 AS k, string_agg(c_name, chr(10) ORDER BY c_name) AS text FROM customer GROUP BY 1)
SELECT 'plain/' || k || '.csv' AS path, sha256(text) AS checksum FROM t
UNION ALL SELECT 'downloads/2024/' || k || CASE WHEN k % 2 = 1 THEN '.tar.gz' ELSE '.zip' END || '!nested/records.csv', sha256(text) FROM t WHERE k % 9 != 8"""


def _archived(frames):
    """A zip or a tar archive for each row's text, with a note and, at times, an unsafe member; every ninth is broken."""
    for frame in frames:
        rows = []
        for key, text in zip(frame.c_nationkey, frame.text):
            out = io.BytesIO()
            names = {"nested/records.csv": text.encode(), "notes/readme.txt": b"note"} | ({"../up.csv": b"x"} if key % 4 == 0 else {})
            if key % 2:
                with tarfile.open(fileobj=out, mode="w:gz") as t:
                    for name, body in names.items():
                        info = tarfile.TarInfo(name)
                        info.size = len(body)
                        t.addfile(info, io.BytesIO(body))
            else:
                with zipfile.ZipFile(out, "w") as z:
                    for name, body in names.items():
                        z.writestr(name, body)
            content = out.getvalue()
            rows.append((f"downloads/2024/{key}.{'tar.gz' if key % 2 else 'zip'}", content[: len(content) // 2] if key % 9 == 8 else content))
        yield pd.DataFrame(rows, columns=["path", "content"])


def archive_members(spark, sf):
    """Archives of a hundred customers each, their CSV members found and hashed, and what went wrong."""
    texts = table(spark, sf, "customer").groupBy(F.expr("c_custkey DIV 100").alias("c_nationkey")).agg(F.array_join(F.array_sort(F.collect_list("c_name")), "\n").alias("text"))
    made = texts.mapInPandas(_archived, "path string, content binary")
    return archives.members(made, "*.csv").select("archive", "member", "length", "checksum", "error")


MEMBERS_SQL = """WITH t AS (SELECT c_custkey // 100 AS k, string_agg(c_name, chr(10) ORDER BY c_name) AS text FROM customer GROUP BY 1),
a AS (SELECT *, 'downloads/2024/' || k || CASE WHEN k % 2 = 1 THEN '.tar.gz' ELSE '.zip' END AS archive FROM t)
SELECT archive, 'nested/records.csv' AS member, CAST(strlen(text) AS BIGINT) AS length, sha256(text) AS checksum, NULL AS error FROM a WHERE k % 9 != 8
UNION ALL SELECT archive, '../up.csv', NULL, NULL, 'unsafe path' FROM a WHERE k % 4 = 0 AND k % 9 != 8
UNION ALL SELECT archive, NULL, NULL, NULL, CASE WHEN k % 2 = 1 THEN 'unreadable: EOFError' ELSE 'unreadable: BadZipFile' END FROM a WHERE k % 9 = 8"""


def listing_files(spark, sf):
    """Folder listings in XML, of a hundred suppliers each: their CSV files, with dates and public addresses."""
    key = F.col("s_suppkey").cast("string")
    suffix = F.when(F.col("s_suppkey") % 5 == 0, "/").when(F.col("s_suppkey") % 5 == 1, ".json").otherwise(".csv")
    entry = F.concat(F.lit("<d:response><d:href>/dav/s"), key, suffix, F.lit("</d:href><d:propstat><d:prop><d:getcontentlength>"), key, F.lit("</d:getcontentlength><d:getlastmodified>Mon, 01 Jan 2024 0"), (F.col("s_suppkey") % 9).cast("string"), F.lit(':00:00 GMT</d:getlastmodified><d:getetag>"e'), key, F.lit('"</d:getetag></d:prop></d:propstat></d:response>'))
    xml = table(spark, sf, "supplier").groupBy(F.expr("s_suppkey DIV 100").alias("folder")).agg(F.concat(F.lit("<d:multistatus>"), F.array_join(F.array_sort(F.collect_list(entry)), ""), F.lit("</d:multistatus>")).alias("listing"))
    found = links.listing_files(xml, formats=["csv"], public_root="https://files.example.org/share/")
    return found.select("folder", "filename", "length", F.unix_seconds("modified_at").alias("modified_seconds"), "etag", "format", "url")


LISTING_SQL = """SELECT CAST(s_suppkey // 100 AS BIGINT) AS folder, 's' || s_suppkey || '.csv' AS filename, CAST(s_suppkey AS BIGINT) AS length, CAST(1704067200 + 3600 * (s_suppkey % 9) AS BIGINT) AS modified_seconds, 'e' || s_suppkey AS etag, 'csv' AS format,
'https://files.example.org/share/s' || s_suppkey || '.csv' AS url FROM supplier WHERE s_suppkey % 5 > 1"""


def artifact_rows(spark, sf):
    """Suppliers' names landed as text, a hundred in a file: what is recorded of each file, and the lines that a re-read of the zone finds."""
    at = scratch(spark)
    pages = table(spark, sf, "supplier").groupBy(F.expr("s_suppkey DIV 100").alias("page")).agg(F.array_join(F.array_sort(F.collect_list("s_name")), "\n").alias("value"))
    pages.select("page", "value").write.partitionBy("page").text(f"{at}/raw")
    made = scan.artifacts(scan.handoff(scan.inventory(spark, f"{at}/raw", content=True), "text"))
    lines = scan.read_zone(spark, f"{at}/raw", "text").groupBy(F.col("page").cast("long").alias("page")).agg(F.count(F.lit(1)).alias("n_lines"))
    return made.withColumn("page", F.regexp_extract("path", "page=([0-9]+)", 1).cast("long")).drop("path").join(lines, "page")


ARTIFACTS_SQL = """SELECT CAST(s_suppkey // 100 AS BIGINT) AS page, 'text' AS format, 'overwrite' AS mode, CAST(1 AS BIGINT) AS records_written, sha256(string_agg(s_name, chr(10) ORDER BY s_name) || chr(10)) AS checksum, count(*) AS n_lines FROM supplier GROUP BY s_suppkey // 100"""


def available_now_load(spark, sf):
    """Events landed in two parts and loaded after each; a third call finds nothing new."""
    events, at = table(spark, sf, "events"), scratch(spark)
    load = lambda: load_available(spark, f"{at}/landed", events.schema, f"{at}/loaded", f"{at}/state")
    counts = []
    for part in ("event_id % 3 = 0", "event_id % 3 != 0", None):
        if part:
            publish.write_path(events.where(part), f"{at}/landed", mode="append")
        counts.append(load())
    loaded = versioned.read(spark, f"{at}/loaded")
    return loaded.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_ids")).select("*", *[F.lit(n).cast("long").alias(f"load_{i}") for i, n in enumerate(counts, 1)])


LOAD_SQL = """SELECT event_type, count(*) AS n_rows, count(DISTINCT event_id) AS n_ids, (SELECT count(*) FROM events WHERE event_id % 3 = 0) AS load_1, (SELECT count(*) FROM events WHERE event_id % 3 != 0) AS load_2, CAST(0 AS BIGINT) AS load_3 FROM events GROUP BY 1"""


def discovered_files(spark, sf):
    """Files linked from several pages: of each target, the last page that names it."""
    found = links.page_links(table(spark, sf, "pages").select("page_id", "url", "html")).select(F.lit("link").alias("kind"), F.col("href").alias("location"), "page_id", (F.col("page_id") * 100_000 + F.col("position")).alias("seq"))
    return increment.last_discovered(found).select("kind", "location", "page_id")


DISCOVERED_SQL = r"""SELECT 'link' AS kind, href AS location, max(page_id) AS page_id FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages)
WHERE href != '' AND NOT regexp_matches(lower(href), '^(#|javascript:|mailto:)') GROUP BY ALL"""


def landed_inventory(spark, sf):
    """The files of a partitioned write, by format, with their bytes read back: rows of each partition."""
    at = scratch(spark)
    publish.write_path(table(spark, sf, "orders"), f"{at}/orders", partition_by=["o_orderstatus"])
    files = scan.inventory(spark, f"{at}/orders", "*.parquet")
    status = F.regexp_extract("path", "o_orderstatus=([A-Z])", 1)
    held = spark.read.parquet(f"{at}/orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))
    return files.groupBy(status.alias("o_orderstatus"), "format").agg((F.sum("length") > 0).alias("has_bytes")).join(held, "o_orderstatus")


INVENTORY_SQL = "SELECT o_orderstatus, 'parquet' AS format, TRUE AS has_bytes, count(*) AS n_rows FROM orders GROUP BY 1"

QUERIES = {
    "artifact_rows": artifact_rows,
    "relative_links": relative_links, "header_names": header_names, "resolved_versions": resolved_versions, "json_documents_read": json_documents_read, "rehydrated": rehydrated,
    "page_links": page_links, "url_format": url_format, "redact_urls": redact_urls, "html_rejects": html_rejects, "content_hash": content_hash, "checksum_verify": checksum_verify,
    "extraction_summary": extraction_summary, "dead_letter_split": dead_letter_split, "dead_letters": dead_letters, "sanitize_ident": sanitize_ident, "csv_contract_read": csv_contract_read,
    "json_modes_read": json_modes_read, "archive_members": archive_members, "listing_files": listing_files, "available_now_load": available_now_load, "discovered_files": discovered_files,
    "landed_inventory": landed_inventory,
}
ORACLES = {
    "artifact_rows": ARTIFACTS_SQL,
    "relative_links": RELATIVE_SQL, "header_names": HEADER_SQL, "resolved_versions": RESOLVED_SQL, "json_documents_read": DOCUMENTS_SQL, "rehydrated": REHYDRATED_SQL,
    "page_links": LINKS_SQL, "url_format": FORMAT_SQL, "redact_urls": REDACT_SQL, "html_rejects": HTML_SQL, "content_hash": HASH_SQL, "checksum_verify": VERIFY_SQL,
    "extraction_summary": EXTRACTION_SQL, "dead_letter_split": DEAD_SQL, "dead_letters": LETTERS_SQL, "sanitize_ident": IDENT_SQL, "csv_contract_read": CSV_SQL,
    "json_modes_read": JSON_SQL, "archive_members": MEMBERS_SQL, "listing_files": LISTING_SQL, "available_now_load": LOAD_SQL, "discovered_files": DISCOVERED_SQL,
    "landed_inventory": INVENTORY_SQL,
}
