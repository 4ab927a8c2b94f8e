"""Files named by pages and listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import file_format, is_direct_file, url_filename

_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def hrefs(html: Column) -> Column:
    """The link targets of a page, in order; comments and scripts don't count."""
    plain = F.regexp_replace(F.regexp_replace(html, "(?s)<!--.*?-->", ""), r"(?is)<script\b.*?</script\s*>", "")
    each = F.arrays_zip(*[F.regexp_extract_all(plain, F.lit(_HREF), F.lit(i)).alias(f"g{i}") for i in (1, 2, 3)])
    return F.transform(each, lambda m: F.trim(F.replace(F.coalesce(F.nullif(m["g1"], F.lit("")), F.nullif(m["g2"], F.lit("")), m["g3"]), F.lit("&amp;"), F.lit("&"))))


def _without_dots(path: Column) -> Column:
    """A path with its steps to the same folder and upwards taken."""
    parts = F.split(path, "/")
    step = lambda s, x: F.when(x == "..", F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(1)))).when(x == ".", s).otherwise(F.concat(s, F.array(x)))
    walked = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.slice(parts, 1, 1), step)
    folder = F.element_at(parts, -1).isin(".", "..")  # what ends in such a step is a folder
    return F.array_join(F.when(folder, F.concat(walked, F.array(F.lit("")))).otherwise(walked), "/")


def resolved(base: Column, link: Column) -> Column:
    """A link's URL against its page's."""
    root = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    plain = F.regexp_replace(base, "[?#].*$", "")
    own = F.substr(plain, F.length(root) + 1)
    folder = F.when(own == "", F.lit("/")).otherwise(F.regexp_replace(own, "[^/]*$", ""))
    path, rest = F.regexp_extract(link, "^([^?#]*)", 1), F.regexp_extract(link, "([?#].*)$", 1)
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("?"), F.concat(plain, link))
        .when(link.startswith("#") | (link == ""), F.concat(F.regexp_replace(base, "#.*$", ""), link))
        .when(link.startswith("/"), F.concat(root, _without_dots(path), rest))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, path)), rest))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """A row per link of each page: position, href, target, filename and format; fragments, scripts and mail addresses aside."""
    others = [c for c in pages.columns if c != html]
    each = pages.select(*others, F.posexplode(hrefs(F.col(html))).alias("position", "href"))
    real = each.where(~F.lower("href").rlike("^(#|javascript:|mailto:)") & (F.col("href") != ""))
    target = resolved(F.col(url), F.col("href"))
    return real.withColumn("target", target).withColumn("filename", url_filename(F.col("target"))).withColumn("is_file", is_direct_file(F.col("target"))).withColumn("format", file_format(F.col("filename"), "text"))


LISTING = "response array<struct<href:string,propstat:struct<prop:struct<getcontentlength:bigint,getlastmodified:string,getetag:string,resourcetype:struct<collection:string>>>>>"


def listing_files(listings: DataFrame, xml: str = "listing", formats: Sequence[str] = (), public_root: str | None = None) -> DataFrame:
    """The files of folder listings in XML, collections aside, with length, date, tag and format.

    Of some formats only, if these are named; ``public_root`` adds ``url``, where the file can be had.
    """
    plain = F.regexp_replace(F.col(xml), r"(</?)[A-Za-z]\w*:", "$1")
    others = [c for c in listings.columns if c != xml]
    each = listings.select(*others, F.explode(F.from_xml(plain, LISTING)["response"]).alias("r"))
    prop = F.col("r.propstat.prop")
    files = each.where(~F.col("r.href").endswith("/"))
    stamp = F.regexp_extract(prop["getlastmodified"], r"(\d{1,2} \w{3} \d{4} \d\d:\d\d:\d\d)", 1)
    modified = F.try_to_timestamp(F.concat(stamp, F.lit(" +0000")), F.lit("d MMM yyyy HH:mm:ss Z"))
    found = files.select(*others, F.col("r.href").alias("href"), url_filename(F.concat(F.lit("dav://x"), F.col("r.href"))).alias("filename"), prop["getcontentlength"].alias("length"), prop["getlastmodified"].alias("last_modified"), modified.alias("modified_at"), F.replace(prop["getetag"], F.lit('"'), F.lit("")).alias("etag")).withColumn("format", file_format(F.col("filename")))
    chosen = found.where(F.col("format").isin(*formats)) if formats else found
    return chosen.withColumn("url", F.concat(F.lit(public_root.rstrip("/") + "/"), F.element_at(F.split("href", "/"), -1))) if public_root else chosen


#: Media types of pages.
PAGE_TYPES = ("text/html", "application/xhtml+xml")


def looks_like_page(body: Column, content_type: Column | None = None, told_length: Column | None = None) -> Column:
    """A page, or nothing, where a file was expected.

    A response that names its media type is judged by that alone, and is empty
    amiss only if a length above zero was told.  One that doesn't is a page if it
    begins like one, and is amiss if it is empty.
    """
    sniffed = F.lower(F.substring(F.ltrim(body), 1, 16)).rlike("^(<!doctype html|<html|<head|<body)")
    kind = F.lower(F.trim(F.substring_index(content_type, ";", 1))) if content_type is not None else F.lit(None).cast("string")
    empty = F.coalesce(F.length(body) == 0, F.lit(True))
    missing = empty & ((told_length > 0) if told_length is not None else F.lit(True))
    return F.coalesce(F.coalesce(kind.isin(*PAGE_TYPES), sniffed, F.lit(False)) | F.coalesce(missing, F.lit(False)), F.lit(True))
