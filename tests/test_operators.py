from __future__ import annotations

import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, documents, flatview, increment, lineage, publish, quality, requests, versioned
from tidemark.plans.common import RUN
from tidemark.sources import archives, links, scan, schema
from tidemark.streaming.landing import load_available


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- lineage and quality ---------------------------------------------------------------------


def test_lineage_comes_first_and_replaces(spark):
    df = spark.createDataFrame([(1, "old", 2)], ["a.b", "run_id", "z"])
    out = lineage.stamp(df, RUN)
    assert out.columns == [*lineage.LINEAGE, "a.b", "z"]
    assert out.select("run_id").first()[0] == RUN.run_id
    assert lineage.stamp(df.limit(0), RUN).count() == 0


def test_gate_finds_duplicates_and_blanks(spark):
    df = spark.createDataFrame([("1", "a"), ("1", " "), ("2", None), (None, "\t"), (None, "b")], "id string, `up.at` string")
    report = {(r["name"], r["outcome"], r["n_failures"]) for r in quality.checks(df, ["id", "up.at"], [["id"]], ["id", "up.at", "x"]).collect()}
    assert report == {("required_fields", "failed", 4), ("unique_fields", "failed", 2), ("schema_expectations", "failed", 1)}
    with pytest.raises(quality.QualityError, match="unique_fields"):
        quality.gate(quality.checks(df, [], [["id"]]))
    assert quality.duplicate_summary(df, ["id"]).first() == (2, ['{"id":"1"}', "{}"])
    assert quality.duplicate_summary(df.limit(0), ["id"]).first()["n_keys"] in (0, None)


def test_gate_on_an_empty_frame_passes(spark):
    df = spark.createDataFrame([], "id long, count long")
    report = quality.checks(lineage.stamp(df, RUN), ["id"], [["count"]], ["id", "count"], strict=True, outputs=True)
    assert {r["outcome"] for r in report.collect()} == {"passed"}
    assert quality.summary(report).first() == (4, 0, 0, True)
    skipped = quality.summary(quality.checks(df)).first()
    assert (skipped["skipped"], skipped["successful"]) == (3, True)


def test_strict_schema_exempts_lineage():
    assert quality.schema_difference([*lineage.LINEAGE, "a", "b"], ["a", "c"], strict=True) == (["c"], ["b"])
    assert quality.schema_difference(["a", "b"], ["a"]) == ([], [])


def test_publish_leaves_the_target_alone_when_the_gate_fails(spark, tmp_path):
    good, bad = spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(3,), (3,)], "id long")
    check = lambda df: quality.checks(df, ["id"], [["id"]])
    at = str(tmp_path / "t")
    publish.publish(good, at, check)
    first = versioned.current(spark, at)
    with pytest.raises(quality.QualityError):
        publish.publish(bad, at, check)
    assert versioned.current(spark, at) == first and rows(versioned.read(spark, at)) == [(1,), (2,)]
    assert not any("data-" in p.name and p.name not in first.folders for p in (tmp_path / "t").iterdir())
    written, report = publish.publish(bad, at, check, warn_only=True)
    assert written.records == 2 and versioned.read(spark, at).count() == 4 and quality.summary(report).first()["failed"] == 1
    assert rows(versioned.read(spark, at, first)) == [(1,), (2,)]
    assert publish.publish(good, at, check, name="n")[0].records == 2 and publish.publish(good, at, check, name="n")[0].records == 0
    assert publish.reports(spark, at).where("outcome = 'failed'").count() == 2


def test_two_writers_cannot_follow_the_same_version(spark, tmp_path):
    at = str(tmp_path / "state")
    runs = spark.createDataFrame([("a", "5", "2024-01-01", True), ("a", "9", "2024-01-02", False), (None, "3", "2024-01-01", True), ("b", None, "2024-01-01", True)], "source string, v string, at string, ok boolean")
    made = increment.advance(spark, at, runs, ["source"], "v", "at", "ok")
    state = lambda: rows(versioned.read(spark, at).select("source", "checkpoint"))
    assert made.number == 1 and state() == [("a", "5"), (None, "3")]
    later = spark.createDataFrame([("a", "7", "2023-01-01", True)], runs.schema)
    increment.advance(spark, at, later, ["source"], "v", "at", "ok", after=made)
    with pytest.raises(versioned.Conflict):
        increment.advance(spark, at, later.withColumn("v", F.lit("99")), ["source"], "v", "at", "ok", after=made)
    assert state() == [("a", "7"), (None, "3")]
    increment.advance(spark, at, later.withColumn("v", F.lit("6")), ["source"], "v", "at", "ok")
    assert state() == [("a", "7"), (None, "3")] and versioned.current(spark, at).number == 3


def test_table_modes(spark):
    spark.sql("DROP TABLE IF EXISTS landing_test")
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    assert publish.write_table(df, "landing_test").records == 1
    assert publish.write_table(df.select(F.lit("b").alias("name"), F.lit(2).cast("long").alias("id")), "landing_test").records == 1
    assert rows(spark.table("landing_test").select("id", "name")) == [(1, "a"), (2, "b")]
    assert publish.write_table(df, "landing_test", "ignore").records == 0
    with pytest.raises(ValueError):
        publish.write_table(df.withColumn("x", F.lit(1)), "landing_test")
    assert publish.write_table(df.withColumn("x", F.lit(1)), "landing_test", "overwrite").records == 1
    assert spark.table("landing_test").columns == ["id", "name", "x"]
    spark.sql("DROP TABLE landing_test")
    with pytest.raises(ValueError):
        scan.read_table(spark, "landing_test")


# -- increments ------------------------------------------------------------------------------


def test_decisions(spark):
    history = spark.createDataFrame([("s", 1, "5"), ("s", 2, "40"), ("s", 3, "6"), ("s", 4, "40.0"), ("s", 5, " "), ("t", 1, None)], "source string, recorded_at int, candidate string")
    got = increment.decisions(history, ["source"], "candidate", "recorded_at")
    assert [(r["decision"], r["previous_value"]) for r in got.where("source = 's'").orderBy("recorded_at").collect()] == [("advanced", None), ("advanced", "5"), ("retained", "40"), ("reused", "40"), ("skipped", "40.0")]  # of equal values the latest text
    assert got.where("source = 't'").first()["decision"] == "skipped"
    assert rows(increment.current_checkpoints(got, ["source"], "candidate")) == [("s", "40", 2)]


def test_upsert_and_filter(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (None, "c", 5), (None, "d", 4)], "k int, v string, o int")
    assert rows(increment.upsert(df, ["k"], [F.col("o")])) == [(1, "a", 10), (None, "d", 4)]
    assert rows(increment.upsert(df, ["k"], [F.col("o")], "latest")) == [(1, "b", 20), (None, "c", 5)]
    marked = spark.createDataFrame([("9",), ("10",), ("11",), (None,)], "m string")
    assert rows(increment.newer(marked, "m", "10", "decimal")) == [("11",), (None,)]
    assert increment.newer(marked, "m", None, "decimal").count() == 4


def test_equal_order_is_told_apart_by_values(spark):
    df = spark.createDataFrame([(1, v, 0) for v in "cab"] * 3, "k int, v string, o int").repartition(5)
    assert rows(increment.upsert(df, ["k"], [F.col("o")])) == [(1, "a", 0)]
    assert rows(increment.upsert(df, ["k"], [F.col("o")], "latest")) == [(1, "c", 0)]


def test_latest_version(spark):
    files = spark.createDataFrame([("g", "a_2024-02.zip"), ("g", "a_2023.zip"), ("h", "x.zip"), ("h", "y.zip"), ("i", "z.zip")], "g string, filename string")
    got = {r["g"]: (r["filename"], r["ambiguous"]) for r in increment.latest_version(increment.with_version(files), ["g"]).collect()}
    assert got == {"g": ("a_2024-02.zip", False), "h": (None, True), "i": ("z.zip", False)}


# -- requests --------------------------------------------------------------------------------


def test_windows(spark):
    df = spark.sql("SELECT 1 AS id, DATE '2024-01-15' AS start, DATE '2024-03-02' AS end UNION ALL SELECT 2, DATE '2024-03-02', DATE '2024-01-15' UNION ALL SELECT 3, NULL, DATE '2024-01-15'")
    assert [(str(r[1]), str(r[2])) for r in rows(requests.month_windows(df))] == [("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-02")]
    assert requests.day_windows(df).count() == 48


def test_requests(spark):
    df = spark.createDataFrame([("a b", 1), (None, 2)], "q string, n int")
    params = requests.parameters({"q": ("q", None), "n": ("n", None)}, {"size": "5"})
    assert df.where("n = 1").select(requests.url("https://h/{n}", params)).first()[0] == "https://h/1?q=a+b&size=5"
    with pytest.raises(Exception, match="has no value"):
        df.select(params).collect()
    with pytest.raises(Exception, match="(?i)duplicate"):
        df.where("n = 1").select(requests.parameters({"q": ("q", None)}, {"q": "x"})).collect()
    with pytest.raises(ValueError, match="named twice"):
        requests.product(df, df)
    with pytest.raises(ValueError, match="not found"):
        requests.request_rows(df, {"a": "missing.id"})
    assert df.select(requests.content_key(["q", "n"])).first()[0] == "n=1|q=a b"
    assert df.select(requests.content_key([])).first()[0] == "__none__"


def test_page_continuity(spark):
    pages = spark.createDataFrame([("a", 0, 5), ("a", 1, 2), ("b", 0, 5), ("b", 2, 5), ("c", 0, 1), ("c", 1, 5)], "r string, p int, n int")
    got = {r["r"]: (r["n_missing"], r["n_premature"], r["complete"], r["next_page"]) for r in requests.page_continuity(pages, "r", "p", "n", 5).collect()}
    assert got == {"a": (0, 0, True, None), "b": (1, 0, False, 3), "c": (0, 1, False, 2)}


# -- documents -------------------------------------------------------------------------------


def parsed(spark, *texts):
    return documents.parsed(spark.createDataFrame([*enumerate(texts)], "id int, text string"), "text").drop("text")


def test_records(spark):
    docs = parsed(spark, '[{"a":1},{"a":2}]', '{"items":[{"a":3}],"value":[{"a":4}]}', '{"a":5}', "7", "{broken")
    got = documents.records(docs).select("id", "record_index", F.to_json("record"))
    assert rows(got) == [(0, 0, '{"a":1}'), (0, 1, '{"a":2}'), (1, 0, '{"a":3}'), (2, 0, '{"a":5}')]


def test_walk_skips_object_fields_and_lists_in_lists(spark):
    doc = '{"b":[{"x":[{"y":1}]},[{"no":1}],3],"a":[{"k":1}],"o":{"l":[{"no":2}]}}'
    got = documents.walk(parsed(spark, doc)).orderBy("position")
    assert [(r["path"], r["collection_path"]) for r in got.collect()] == [("payload", "payload"), ("payload.a[0]", "payload.a"), ("payload.b[0]", "payload.b"), ("payload.b[0].x[0]", "payload.b[0].x")]
    assert [r["path"] for r in documents.walk(parsed(spark, '[{"a":1},5]')).collect()] == ["payload[0]"]
    assert sorted(r["path"] for r in documents.walk(parsed(spark, doc), depth=1).collect()) == sorted(r["path"] for r in got.collect())


def test_catalog_pages_give_entities_once(spark):
    page = '{"help":"","success":true,"result":{"count":1,"results":[{"id":"ds-1","title":"T","owner_org":"o","organization":{"id":"org-1"},"groups":[{"id":"g-1"}],"resources":[{"id":"r-1","format":"CSV"},{"name":" r-2 "}]}]}}'
    tree = documents.entity_tree(parsed(spark, page, page), levels=2)
    kinds = increment.upsert(tree, ["entity_type", "entity_key"], [F.col("id"), F.col("level"), F.col("position")])
    assert rows(kinds.select("entity_type", "entity_key", "parent_entity_key")) == [("dataset", "ds-1", None), ("group", "g-1", "ds-1"), ("organization", "org-1", "ds-1"), ("resource", "r-1", "ds-1"), ("resource", "r-2", "ds-1")]
    assert {r["record_path"] for r in kinds.collect()} >= {"payload.result.results[0]", "payload.result.results[0].resources[1]"}
    assert documents.edges(tree).count() == 4


def test_collections_of_every_shape(spark):
    """Objects in place of lists, scalars, wrappers around documents and in records, bare records."""
    docs = [
        '{"result":{"data":{"payload":{"datasets":{"id":"d1","result":{"resources":["a",5,null]}}}}}}',
        '[{"id":"x","notes":"n"},{"id":"y","notes":"n","organization":{"id":"o"}}]',
        '{"id":"alone","format":"CSV","mimetype":"t"}',
        '{"datasets":[],"items":[{"id":"g","notes":"n"}]}',
        "{}",
    ]
    tree = documents.entity_tree(parsed(spark, *docs)).select("id", "entity_type", "entity_key", "parent_entity_key", "record_path", "level")
    assert rows(tree) == sorted([
        (0, "dataset", "d1", None, "payload.result.data.payload.datasets[0]", 0),
        (0, "resource", "a", "d1", "payload.result.data.payload.datasets[0].result.resources[0]", 1),
        (0, "resource", "5", "d1", "payload.result.data.payload.datasets[0].result.resources[1]", 1),
        (1, "dataset", "x", None, "payload[0]", 0),
        (1, "dataset", "y", None, "payload[1]", 0),
        (1, "organization", "o", "y", "payload[1].organization[0]", 1),
        (2, "resource", "alone", None, "payload[0]", 0),
        (3, "dataset", "g", None, "payload.items[0]", 0),
    ], key=repr)


def test_classification(spark):
    nodes = parsed(spark, '{"format":"x","mimetype":"y"}', '{"notes":"n"}', '{"packages":[1],"image_url":"u"}', '{"x":1}', '{"packages":[1]}').withColumnRenamed("document", "data")
    got = [(r["entity_type"], r["confidence"], r["signals"]) for r in documents.classify(nodes).orderBy("id").collect()]
    assert got == [("resource", "high", ["format", "mimetype"]), ("dataset", "heuristic", ["notes"]), ("organization", "high", ["packages", "image_url"]), ("unknown", "low", []), ("organization", "heuristic", ["packages"])]
    inside = documents.classify(nodes.withColumn("p", F.lit("dataset")), parent_type="p").orderBy("id").collect()
    assert [(r["entity_type"], r["confidence"]) for r in inside[:2]] == [("resource", "high"), ("resource", "heuristic")]
    assert inside[1]["signals"] == ["parent:dataset"]


def test_coerced(spark):
    values = parsed(spark, '[{"a":1},"x\\"y",5,null]', '{"b":2}', "3").withColumnRenamed("document", "value")
    got = documents.coerced(values).select("id", F.to_json("record"))
    assert rows(got) == [(0, '{"a":1}'), (0, '{"name":"5","value":5}'), (0, '{"name":"x\\"y","value":"x\\"y"}'), (1, '{"b":2}')]


def test_flat_view(spark):
    doc = '[{"NC":"Nível (Código)","V":"Valor","D1C":"Ano (Código)","D1N":"Ano","D2N":"Variável"},{"NC":"1","V":" 10.50 ","D1C":"2023","D1N":"2023","D2N":"PIB","MN":"Reais"}]'
    docs = spark.createDataFrame([(1, doc), (2, '[{"V":"1","D1C":"x"}]'), (3, '[{"V":"valor"},{"V":"2"}]'), (4, None)], "id int, document string")
    (row,) = flatview.flat_view(docs).collect()
    assert (row["value"], row["value_label"], row["period_code"], row["variable_name"]) == ("10.50", "Valor", "2023", "PIB")
    assert [tuple(a) for a in row["attributes"]] == [("MN", "", "Reais"), ("NC", "Nível (Código)", "1")]
    assert [tuple(d) for d in row["dimensions"]] == [("D1", 1, "2023", "2023", "Ano (Código)", "Ano"), ("D2", 2, "", "PIB", "", "Variável")]
    assert spark.range(1).select(flatview.aggregate_id(F.lit("https://h/api/agregados/5938/v?x"))).first()[0] == "5938"


# -- files -----------------------------------------------------------------------------------


def test_contracts():
    assert schema.from_contract(["a", {"name": "b"}]).simpleString() == "struct<a:string,b:string>"
    assert schema.from_contract({"schema": {"fields": ["a"]}}).simpleString() == "struct<a:string>"
    struct = {"type": "struct", "fields": [{"name": "a", "type": "long", "nullable": True, "metadata": {}}]}
    assert schema.from_contract(struct).simpleString() == "struct<a:bigint>"
    for bad in ([], ["a", "a"], [" "], "x", {"other": 1}):
        with pytest.raises(ValueError):
            schema.from_contract(bad)


def test_reads(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"id":1,\n"v":"x"},{"id":2}]')
    (tmp_path / "l.jsonl").write_text('{"id":1}\n{"id":2}\n')
    (tmp_path / "c.csv").write_bytes("12345678;ACME LTDA;São;1\n1;2\n".encode("iso-8859-1"))
    (tmp_path / "x.csv.sha256").write_text("0")
    assert scan.read_paths(spark, [str(tmp_path / "d.json")], "json").count() == 2
    assert scan.read_paths(spark, [str(tmp_path / "l.jsonl")], "jsonl").count() == 2
    plain = scan.read_csv(spark, [str(tmp_path / "c.csv")], schema.from_contract(["a", "b", "c", "d"]), False, encoding="ISO-8859-1")
    got = plain.collect()
    assert got[0]["c"] == "São" and got[0]["_corrupt_record"] is None and got[1]["_corrupt_record"] == "1;2"
    files = scan.inventory(spark, str(tmp_path))
    assert rows(files.select("filename", "format")) == [("c.csv", "csv"), ("d.json", "json"), ("l.jsonl", "jsonl")]
    with pytest.raises(ValueError, match="several formats"):
        scan.read_inventory(files)
    assert scan.read_inventory(files, "jsonl").count() == 2
    for call in (lambda: scan.read_paths(spark, [], "csv"), lambda: scan.read_paths(spark, ["x"], "orc")):
        with pytest.raises(ValueError):
            call()


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "package_2026-04.zip", "w") as z:
        z.writestr("nested/records.csv", "a")
        z.writestr("notes/readme.txt", "b")
        z.writestr("../evil.csv", "c")
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("in.csv")
        info.size = 1
        t.addfile(info, io.BytesIO(b"x"))
    (tmp_path / "broken.zip").write_bytes(b"no")
    (tmp_path / "other.csv").write_bytes(b"1")
    found = archives.members(scan.inventory(spark, str(tmp_path), content=True), "*.csv")
    assert sorted((r["archive"].rpartition("/")[2], r["member"] or "", r["error"] or "") for r in found.collect()) == [
        ("broken.zip", "", "unreadable: BadZipFile"),
        ("package_2026-04.zip", "../evil.csv", "unsafe path"),
        ("package_2026-04.zip", "nested/records.csv", ""),
        ("t.tar.gz", "in.csv", ""),
    ]


def test_broken_members_are_rows(spark):
    """A member that is corrupt or encrypted, between good ones."""
    def zipped(change):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name in ("a.csv", "b.csv", "c.csv"):
                z.writestr(name, name * 200)
        content = bytearray(out.getvalue())
        change(content, content.index(b"b.csv"))
        return bytes(content)

    def corrupt(content, at):
        content[at + 5 : at + 15] = b"\xff" * 10

    def encrypted(content, at):
        content[at - 24] |= 1
        entry = content.rindex(b"b.csv")
        content[entry - 38] |= 1

    files = spark.createDataFrame([("corrupt.zip", zipped(corrupt)), ("locked.zip", zipped(encrypted))], "path string, content binary")
    found = {(r["archive"], r["member"]): r["error"] for r in archives.members(files).collect()}
    assert len(found) == 6 and all((error is not None) == (member == "b.csv") for (_, member), error in found.items())
    assert found["locked.zip", "b.csv"] == "unreadable: RuntimeError"


@pytest.mark.parametrize(
    "base, link, told",
    [
        ("http://h/a/b/c.html", "../../x.csv", "http://h/x.csv"),
        ("http://h/a/b/c.html", "../../../x.csv", "http://h/x.csv"),
        ("http://h/a/b/c.html", "p/./q", "http://h/a/b/p/q"),
        ("http://h/a/b/c.html", "/p/../q?r=../s", "http://h/q?r=../s"),
        ("http://h/a/b/c.html?x=/y", "..", "http://h/a/"),
        ("http://h", "x", "http://h/x"),
        ("http://h/a/b", "#f", "http://h/a/b#f"),
        ("http://h/a/b", "//o/p", "http://o/p"),
    ],
)
def test_resolved(spark, base, link, told):
    assert spark.range(1).select(links.resolved(F.lit(base), F.lit(link))).first()[0] == told


def test_links(spark):
    html = """<!-- <a href="no"> --><script>'<a href="no2">'</script><A class=x HREF='b.csv?x=1&amp;y=2'>b</a> <a href="/c">c</a><a href=../d.zip><a href="#f"><a href="mailto:x"><a href="JavaScript:x"><a data-href="n" href="https://o/e">"""
    pages = spark.createDataFrame([("https://h/p/q/r.html", html)], "url string, html string")
    got = links.page_links(pages).orderBy("position")
    assert [(r["target"], r["format"], r["is_file"]) for r in got.collect()] == [
        ("https://h/p/q/b.csv?x=1&y=2", "csv", True),
        ("https://h/c", "text", False),
        ("https://h/p/d.zip", "binary", True),
        ("https://o/e", "text", False),
    ]


def test_audits(spark):
    actual = spark.createDataFrame([("a", "X1"), ("b", "y"), ("c", "z")], "path string, checksum string")
    told = spark.createDataFrame([("a", "x1"), ("b", "n")], "path string, checksum string")
    assert {r["path"]: r["status"] for r in audit.verify_checksums(actual, told).collect()} == {"a": "verified", "b": "mismatch", "c": "unverified"}
    left, right = spark.createDataFrame([(1,), (1,), (None,)], "x int"), spark.createDataFrame([(1,), (2,)], "x int")
    assert rows(audit.table_difference(left, right)) == [(1, "left"), (2, "right"), (None, "left")]
    one = spark.createDataFrame([("bad",)], "x string")
    assert not audit.within_budget(one, F.lit(False), 5).first()["continues"]
    many = spark.createDataFrame([("bad",), ("good",)], "x string")
    assert audit.within_budget(many, F.col("x") == "good", 1).first()["continues"]
    good, bad = audit.split(spark.createDataFrame([(True,), (False,), (None,)], "ok boolean"), F.col("ok"))
    assert (good.count(), bad.count()) == (1, 2)


def test_available_now_loads_each_file_once(spark, tmp_path):
    at = {k: str(tmp_path / k) for k in ("landed", "loaded", "state")}
    load = lambda: load_available(spark, at["landed"], spark.range(0).schema, at["loaded"], at["state"])
    spark.range(5).write.parquet(at["landed"])
    assert load() == 5 and load() == 0
    spark.range(5, 8).write.mode("append").parquet(at["landed"])
    assert load() == 3 and versioned.read(spark, at["loaded"]).distinct().count() == 8


# -- payloads, hooks and archives of any size ------------------------------------------------


def test_decoding_tells_what_is_broken(spark):
    cases = [
        ("text", "utf-8", "é".encode()), ("text", "utf-8", b"\xc3"), ("text", "us-ascii", b"ok"), ("text", "ascii", b"\x80"), ("text", "Latin-1 ", b"\xe9"), ("text", "utf-16le", "é\U0001f600".encode("utf-16-le")), ("text", "utf-16le", b"\x00\xd8"), ("text", "utf-16", b"\xff\xfe" + "a".encode("utf-16-le")),
        ("text", "utf-16be", b"\x00"), ("text", None, b"x"), ("text", "utf-8", None), ("binary", "none", b"\x80"), ("odd", "utf-8", b"x"), ("json", "utf-8", b"\xef\xbb\xbf{\"a\":1}"), ("json", "utf-8", b'{"a":1} x'), ("json", "utf-8", b"1],[2"), ("json", "utf-8", b"1},{"), ("json", "utf-8", b""), ("jsonl", "utf-8", b"1\r\n\n{x\n[2]"), ("jsonl", "utf-8", b""),
    ]
    from tidemark.operators import payloads

    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, kind string, charset string, content binary")
    got = rows(payloads.decoded(df).select("i", "position", "text", F.to_json("document"), "error"))
    assert got == sorted([
        (0, 0, "é", None, None), (1, 0, None, None, "encoding"), (2, 0, "ok", None, None), (3, 0, None, None, "encoding"), (4, 0, "é", None, None), (5, 0, "é\U0001f600", None, None), (6, 0, None, None, "encoding"), (7, 0, "a", None, None),
        (8, 0, None, None, "encoding"), (9, 0, None, None, "charset"), (10, 0, None, None, "encoding"), (11, 0, None, None, None), (12, 0, "x", None, "kind"), (13, 0, '{"a":1}', '{"a":1}', None), (14, 0, '{"a":1} x', None, "json"), (15, 0, "1],[2", None, "json"), (16, 0, "1},{", None, "json"), (17, 0, "", None, "json"),
        (18, 1, "1", "1", None), (18, 3, "{x", None, "json"), (18, 4, "[2]", "[2]", None),
    ], key=repr)


def test_hooks_keep_what_their_family_keeps(spark):
    from tidemark.operators.hooks import Hooks

    known, df = Hooks(), spark.createDataFrame([(1, "u"), (2, "v")], "request_key int, url string")
    known.register("request", "same")(lambda d: d)
    known.register("request", "dropping")(lambda d: d.drop("url"))
    known.register("request", "emptying")(lambda d: d.withColumn("request_key", F.nullif("request_key", F.lit(2))))
    known.register("request", "halving")(lambda d: d.where("request_key = 1"))
    known.register("plan", "halving")(lambda d: d.where("request_key = 1"))
    stamped = lineage.stamp(df, RUN)
    known.register("plan", "unstamping")(lambda d: d.drop("run_id"))
    assert known.apply(df, "request", ["same"]).count() == 2 and known.apply(df, "plan", ["halving"]).count() == 1
    for family, name, frame in (("request", "dropping", df), ("request", "absent", df), ("plan", "unstamping", stamped), ("request", "same", df.drop("url"))):
        with pytest.raises(ValueError):
            known.apply(frame, family, [name])
    with pytest.raises(Exception, match="leaves request_key empty"):
        known.apply(df, "request", ["emptying"]).collect()
    with pytest.raises(ValueError, match="change the rows"):
        known.checked(df, "request", ["halving"], ["request_key"])
    with pytest.raises(ValueError, match="known already"):
        known.register("plan", "halving")(lambda d: d)


def test_archives_beyond_a_cell_are_read_in_several_tasks(spark, tmp_path):
    import hashlib
    import os

    from tidemark.sources import archive_source

    bodies = {f"m{i}.bin": os.urandom(3000) for i in range(40)} | {"empty": b"", "../up": b"x"}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z, tarfile.open(tmp_path / "b.tar", "w") as t, tarfile.open(tmp_path / "c.tar.gz", "w:gz") as g:
        for name, body in bodies.items():
            z.writestr(name, body)
            for out in (t, g):
                info = tarfile.TarInfo(name)
                info.size = len(body)
                out.addfile(info, io.BytesIO(body))
    (tmp_path / "d.zip").write_bytes((tmp_path / "a.zip").read_bytes()[:5000])
    (tmp_path / "a.zip.sha256").write_text("x")
    parts = archive_source.streamed_members(spark, str(tmp_path), cell=1000, span=10_000).withColumn("task", F.spark_partition_id()).collect()
    for archive in ("a.zip", "b.tar", "c.tar.gz"):
        mine = [p for p in parts if p.archive == archive]
        for name, body in bodies.items():
            each = sorted((p for p in mine if p.member == name), key=lambda p: p.part)
            if name == "../up":
                assert [p.error for p in each] == ["unsafe path"]
                continue
            assert b"".join(p.payload for p in each) == body and [p.part for p in each] == list(range(max(1, -(-len(body) // 1000))))
            assert all(len(p.payload) <= 1000 and p.length == len(body) for p in each)
            assert [p.checksum for p in each] == [None] * (len(each) - 1) + [hashlib.sha256(body).hexdigest()]
        assert (len({p.task for p in mine}) > 5) == (archive != "c.tar.gz")
    assert [(p.member, p.error) for p in parts if p.archive == "d.zip"] == [(None, "unreadable: BadZipFile")]
    same = archives.members(spark.read.format("binaryFile").load(str(tmp_path / "b.tar")).select("path", "content"))
    assert sorted((r.member, r.checksum) for r in same.where("error IS NULL").collect()) == sorted((p.member, p.checksum) for p in parts if p.archive == "b.tar" and p.checksum)
    assert rows(archive_source.file_digests(spark, str(tmp_path)).select("length", "checksum")) == sorted(((p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in tmp_path.iterdir() if p.suffix != ".sha256"), key=repr)
    assert archive_source.streamed_members(spark, str(tmp_path / "none"), 5, 5).count() == 0 if (tmp_path / "none").mkdir() is None else None


def test_documents_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A file for each document, and no task that writes them all, however few bytes they are."""
    from tidemark.plans import file_queries

    monkeypatch.setattr(file_queries, "scratch", lambda spark: str(tmp_path))
    rows = file_queries.json_documents_read(spark, "/root/testdata/sf0.001").collect()
    files = list((tmp_path / "pages").rglob("part-*"))
    assert sum(r.whole for r in rows) == sum(r.typed for r in rows) == sum(r.listed for r in rows) == 1500
    assert len(files) == 15 and len({f.name.split("-")[1] for f in files}) > 1


def test_documents_are_written_by_the_tasks(spark, tmp_path):
    """A file for each row under its name, none half written, no checksum beside it; elsewhere Spark writes the same texts."""
    docs = spark.createDataFrame([(i % 7, f"{i}.json", f"é{i}\nb" if i else None) for i in range(50)], "folder long, name string, text string").repartition(4)
    publish.write_documents(docs, str(tmp_path / "own"))
    publish.spread_documents(docs, str(tmp_path / "spark"))
    own = [p for p in (tmp_path / "own").rglob("*") if p.is_file()]
    assert sorted(p.name.split("-")[2] for p in own) == sorted(f"{i}.json" for i in range(50))
    assert {int(p.parent.name.split("=")[1]) for p in own} == set(range(7))
    texts = sorted([f"é{i}\nb\n" for i in range(1, 50)] + ["\n"])
    assert sorted(p.read_text() for p in own) == texts
    assert sorted(p.read_text() for p in (tmp_path / "spark").rglob("part-*")) == texts
    publish.write_documents(docs, str(tmp_path / "own"))
    assert len([p for p in (tmp_path / "own").rglob("*") if p.is_file()]) == 50


def test_inventories_of_whole_folders_are_read_as_folders(spark, tmp_path, monkeypatch):
    """Folders go to the reader where all of their files are the inventory's; files beside others go one by one; no row is lost, added or doubled."""
    monkeypatch.setattr(scan, "BY_PATH", 2)
    for at, n in (("a", 3), ("a/deep", 2), ("b", 4), ("b/k=1", 2), ("c", 2), ("d", 1)):
        (tmp_path / at).mkdir()
        for i in range(n):
            (tmp_path / at / f"{i}.jsonl").write_text(f'{{"v":"{at}{i}"}}\n')
    (tmp_path / "c" / "x.csv").write_text("not json")
    handed, load = [], scan.read_paths
    monkeypatch.setattr(scan, "read_paths", lambda spark, paths, *more: handed.append(sorted(str(p).removeprefix(f"file:{tmp_path}/") for p in paths)) or load(spark, paths, *more))
    inventory = scan.inventory(spark, str(tmp_path))
    every = [f"{at}{i}" for at, n in (("a", 3), ("a/deep", 2), ("b", 4), ("b/k=1", 2), ("c", 2), ("d", 1)) for i in range(n)]
    found = scan.read_inventory(inventory, "jsonl")
    assert found.columns == ["v"] and sorted(r.v for r in found.collect()) == sorted(every)
    assert handed.pop() == ["a", "b", "c/0.jsonl", "c/1.jsonl", "d"]
    # a file of a folder below that is not listed, and one that is gone
    some = inventory.where("NOT path LIKE '%deep/1.jsonl'")
    assert sorted(r.v for r in scan.read_inventory(some, "jsonl").collect()) == sorted(v for v in every if v != "a/deep1")
    assert handed.pop() == ["a/0.jsonl", "a/1.jsonl", "a/2.jsonl", "a/deep/0.jsonl", "b", "c/0.jsonl", "c/1.jsonl", "d"]
    gone = inventory.unionByName(inventory.where("path LIKE '%d/0.jsonl'").withColumn("path", F.concat("path", F.lit(".jsonl"))))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan.read_inventory(gone, "jsonl").collect()
