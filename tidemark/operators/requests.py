"""Request planning from tables and date windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.values import col, field, strftime
from tidemark.sources.shared import cut

#: Rows up to which the smaller side of a request product may be; it is checked before it is sent to all tasks.
SMALL_SIDE = 100_000


def request_rows(df: DataFrame, fields: Mapping[str, str], distinct: bool = False, ordered: bool = True) -> DataFrame:
    """Request fields from (nested) columns, optionally distinct, in order of all fields."""
    absent = [p for p in fields.values() if p.split(".")[0] not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(sorted(absent))}")
    rows = df.select(*[F.col(p).alias(name) for name, p in fields.items()])
    rows = rows.distinct() if distinct else rows
    return rows.orderBy(*[F.asc_nulls_first(n) for n in fields]) if ordered else rows


def numbered(rows: DataFrame, fields: Sequence[str], index: str = "request_index") -> DataFrame:
    """Request rows with their number from 1 in order of ``fields``, NULLs first.

    Rows are ranked within the ranges of a sort, and the ranges' counts, a few numbers, are
    added up: no single task sees all rows, as a window without partitions would have it.
    """
    ordered = rows.repartitionByRange(*[F.asc_nulls_first(f) for f in fields]).sortWithinPartitions(*[F.asc_nulls_first(f) for f in fields])
    # the place within a partition follows its order; equal rows may be in any
    placed = cut(ordered.withColumn("__at", F.monotonically_increasing_id())).withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # a row for each partition
    number = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(before), "__part").select(number.alias(index), *[col(c) for c in rows.columns])


def day_windows(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """A row for each day from start to end, both included; none if the start is later, or either is NULL."""
    days = df.where(F.col(start) <= F.col(end)).withColumn("day", F.explode(F.sequence(F.to_date(start), F.to_date(end), F.expr("INTERVAL 1 DAY"))))
    return days.withColumn("window_start", F.col("day")).withColumn("window_end", F.col("day")).drop("day", start, end)


def month_windows(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """A row for each month, the first from start, the last up to end."""
    months = df.where(F.col(start) <= F.col(end)).withColumn("month", F.explode(F.sequence(F.trunc(F.to_date(start), "MM"), F.to_date(end), F.expr("INTERVAL 1 MONTH"))))
    first, last = F.greatest("month", F.to_date(start)), F.least(F.last_day("month"), F.to_date(end))
    return months.withColumn("window_start", first).withColumn("window_end", last).drop("month", start, end)


def product(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Every row with every window, which is what the operator is for; both sides are request lists, and one must be small.

    The smaller side's size is checked; two large sides are refused.
    """
    clash = set(rows.columns) & set(windows.columns)
    if clash:
        raise ValueError(f"fields named twice: {', '.join(sorted(clash))}")
    if windows.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE:
        return rows.crossJoin(F.broadcast(windows))
    if rows.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE:
        return windows.crossJoin(F.broadcast(rows)).select(*rows.columns, *windows.columns)
    raise ValueError(f"both sides of the request product have more than {SMALL_SIDE} rows")


def parameters(bound: Mapping[str, tuple[str, str | None]], static: Mapping[str, str] | None = None, dtypes: Mapping[str, str] | None = None) -> Column:
    """A map of request parameters, from columns (with a strftime format or none) and constants.

    A NULL or blank bound value is an error; so is a name that is bound twice.
    """
    made = []
    for name, (column, fmt) in bound.items():
        value = strftime(col(column), fmt) if fmt else col(column).cast("string")
        usable = F.coalesce(F.trim(value) != "", F.lit(False))
        made += [F.lit(name), F.when(usable, value).otherwise(F.raise_error(F.lit(f"parameter {name} has no value")).cast("string"))]
    pairs = F.create_map(*made)
    fixed = F.create_map(*[F.lit(x) for pair in (static or {}).items() for x in pair]) if static else F.create_map().cast("map<string,string>")
    return F.map_concat(fixed, pairs)


def url(template: str, params: Column) -> Column:
    """The template with its ``{name}`` places filled in, and the other parameters as a query string, by name."""
    import re

    places = re.findall(r"\{(\w+)\}", template)
    filled = F.lit(template)
    for p in places:
        filled = F.replace(filled, F.lit("{" + p + "}"), F.url_encode(F.element_at(params, p)))
    rest = F.map_filter(params, lambda k, v: ~k.isin(places)) if places else params
    pairs = F.array_sort(F.map_entries(rest))
    query = F.array_join(F.transform(pairs, lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"]))), "&")
    return F.when(F.size(pairs) > 0, F.concat(filled, F.lit("?"), query)).otherwise(filled)


def content_key(columns: Sequence[str]) -> Column:
    """What identifies a request: its fields by name, ``k=v`` joined by a bar; ``__none__`` if there is none."""
    if not columns:
        return F.lit("__none__")
    return F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.coalesce(col(c).cast("string"), F.lit(""))) for c in sorted(columns)])


def pending(plan: DataFrame, done: DataFrame, dead: DataFrame | None = None, key: str = "request_key") -> DataFrame:
    """Requests that are neither completed nor dead-lettered."""
    left = plan.join(done.select(key), key, "left_anti")
    return left if dead is None else left.join(dead.select(key), key, "left_anti")


def page_continuity(pages: DataFrame, request: str, page: str, records: str, page_size: int, step: int = 1, start: int = 0) -> DataFrame:
    """A row per request of landed pages: how many, how many are missing before the last, whether it stopped, and the next page.

    Pages are ``step`` apart: 1 for page numbers, the page size for offsets; the first is ``start``.

    A page with fewer records than ``page_size`` is final.  ``premature``: a page
    follows a final one.  ``complete``: no page is missing and the last is final.
    """
    along = W.partitionBy(request).orderBy(page)
    final = F.col(records) < page_size
    each = pages.select(request, page, records).withColumn("final", final).withColumn("before", F.lag(page).over(along)).withColumn("after", F.lead(page).over(along))
    gap = F.floor((F.col(page) - F.coalesce("before", F.lit(start - step))) / step) - 1
    seen = each.groupBy(request).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.max(page).alias("last_page"),
        F.sum(F.greatest(gap, F.lit(0))).cast("long").alias("n_missing"),
        F.count_if(F.col("final") & F.col("after").isNotNull()).alias("n_premature"),
        F.max_by("final", page).alias("stopped"),
    )
    complete = F.col("stopped") & (F.col("n_missing") == 0)
    return seen.withColumn("complete", complete).withColumn("next_page", F.when(~F.col("stopped"), F.col("last_page") + step))


def next_cursor(payload: Column) -> Column:
    """The cursor of the next page, at the top or in the usual envelopes."""
    names = ("next_cursor", "nextCursor", "cursor")
    return F.coalesce(*[F.nullif(F.trim(field(payload, f"{at}{n}")), F.lit("")) for at in ("", "meta.", "metadata.", "pagination.") for n in names])


def sequence_number(order: Sequence[Column], by: Sequence[str]) -> Column:
    """1, 2, ... within a group."""
    return F.row_number().over(W.partitionBy(*[col(b) for b in by]).orderBy(*order))


def progress(log: DataFrame, source: str, inputs: str, page: str) -> DataFrame:
    """M5: how far each source has come: the last input and page of its log of pages done, and how many inputs are complete before it."""
    last = F.max(F.struct(F.col(inputs).alias("input"), F.col(page).alias("page"))).alias("last")
    return log.groupBy(source).agg(last, (F.count_distinct(inputs) - 1).alias("n_complete")).select(source, F.col("last.input").alias("current_input"), F.col("last.page").alias("last_page"), "n_complete")


def resumed(plan: DataFrame, done: DataFrame, source: str, inputs: str, page: str) -> DataFrame:
    """M5: the pages of ``plan`` that are left after the ``progress`` of each source; all of a source without any."""
    at = F.struct(F.col(inputs).alias("input"), F.col(page).alias("page"))
    # a row for each source
    marks = done.select(source, F.struct(F.col("current_input").alias("input"), F.col("last_page").alias("page")).alias("__mark"))
    return plan.join(marks, source, "left").where(F.col("__mark").isNull() | (at > F.col("__mark"))).drop("__mark")
