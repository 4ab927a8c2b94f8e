"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``vnodes`` points of a ring of 2**16 cells; a document hashes to
a cell and belongs to the first point clockwise.  Shards hold at most their
capacity: at each point the documents that hash to its arc go in first, what
does not fit travels on clockwise, first come first served, and fills the next
shards that have room.  Capacities are the row count over the shards, rounded
so that they add up to it, hence the law ``rows``: counts differ by one at most.

Only counts per arc (at most shards x vnodes of them, a fixed bound) meet in one
row, where a SQL fold walks the ring; documents are ranked within salted parts of
their arc and placed by joins on arc and on blocks of the overflow sequence.  The
law leaves no slack in the capacities, so that a document moves on just where its
own shard is full.

Defined cases: a null text has size 16 and crc 0; a null id hashes like any
other value; repeated rows are separate rows; a very long text counts by its bytes; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table

RING_BITS = 16
OVERFLOW_BLOCKS = 4096
#: Rows of an arc are ranked in so many parts, as an arc may hold a third of all rows (those of a null id, say).
SALTS = 32


def ring(spark, shards: int, vnodes: int) -> DataFrame:
    """(cell, arc, shard) for each of the 2**16 cells; arcs are numbered clockwise.

    Points that fall on a taken cell are dropped, the lowest shard stays.
    """
    points = (
        spark.range(shards * vnodes)
        .select((F.col("id") % shards).cast("int").alias("shard"), F.pmod(F.xxhash64(F.lit("point"), "id"), F.lit(1 << RING_BITS)).alias("at"))
        .groupBy("at")
        .agg(F.min("shard").alias("shard"))
    )
    around = W.orderBy("at")
    arcs = points.select(
        "at",
        "shard",
        (F.row_number().over(around) - 1).alias("arc"),
        F.coalesce(F.lag("at").over(around) + 1, F.lit(0)).alias("since"),
        F.lead("at").over(around).isNull().alias("last"),
        F.first("shard").over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("first_shard"),
    )
    # cells after the last point belong to the first one
    wrapped = arcs.where("last").select(F.lit(0).alias("arc"), F.col("first_shard").alias("shard"), (F.col("at") + 1).alias("since"), F.lit((1 << RING_BITS) - 1).cast("long").alias("at"))
    spans = arcs.select("arc", "shard", "since", "at").unionByName(wrapped).where("since <= at")
    return spans.select(F.explode(F.sequence("since", "at")).alias("cell"), "arc", "shard")


def walk(loads: DataFrame, shards: int) -> DataFrame:
    """One row: the placements that the walk around the ring makes.

    ``loads`` has (arc, shard, n) for every arc.  Homes: the first ``home`` rows
    of an arc go to slots from ``slot``, the others get numbers from ``queue``.
    Moves: queue numbers from ``queue``, ``n`` of them, go to slots from ``slot``.
    """
    one = loads.agg(F.array_sort(F.collect_list(F.struct("arc", "shard", "n"))).alias("arcs"), F.sum("n").alias("total"))
    return one.selectExpr(
        "total",
        f"""aggregate(
          concat(arcs, transform(arcs, a -> named_struct('arc', a.arc, 'shard', a.shard, 'n', 0L))),
          named_struct(
            'used', array_repeat(0L, {shards}), 'seen', 0L, 'moved', 0L,
            'homes', array(named_struct('arc', -1, 'shard', -1, 'slot', 0L, 'home', 0L, 'queue', 0L)),
            'moves', array(named_struct('shard', -1, 'slot', 0L, 'n', 0L, 'queue', 0L))),
          (s, a) -> transform(array(named_struct(
              'cap', total div {shards} + if(a.shard < total % {shards}, 1L, 0L) - s.used[a.shard])),
            c -> transform(array(least(a.n, c.cap)),
              h -> transform(array(least(s.seen - s.moved, c.cap - h)),
                m -> named_struct(
                  'used', if(h + m = 0, s.used, transform(s.used, (u, i) -> if(i = a.shard, u + h + m, u))),
                  'seen', s.seen + a.n - h,
                  'moved', s.moved + m,
                  'homes', if(a.n = 0, s.homes, concat(s.homes, array(named_struct(
                      'arc', a.arc, 'shard', a.shard, 'slot', s.used[a.shard], 'home', h, 'queue', s.seen)))),
                  'moves', if(m = 0, s.moves, concat(s.moves, array(named_struct(
                      'shard', a.shard, 'slot', s.used[a.shard] + h, 'n', m, 'queue', s.moved)))))
              )[0])[0])[0],
          s -> named_struct('homes', s.homes, 'moves', s.moves)) AS placed""",
    )


def assign(docs: DataFrame, shards: int = 40, vnodes: int = 128) -> DataFrame:
    """A row per document: doc_id, size, text_crc32, arc, shard, slot."""
    spark = docs.sparkSession
    cell = F.shiftrightunsigned(F.xxhash64(F.col("doc_id")), 64 - RING_BITS)
    cells = F.broadcast(ring(spark, shards, vnodes))  # 2**RING_BITS rows
    arcs = ring(spark, shards, vnodes).select("arc", "shard").distinct()
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        cell.alias("cell"),
    ).join(cells.drop("shard"), "cell")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(SALTS)))
    # shards x vnodes x SALTS rows at most
    parts = cut(rows.groupBy("arc", "salt").agg(F.count(F.lit(1)).alias("n")))
    earlier = F.sum("n").over(W.partitionBy("arc").orderBy("salt").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    bases = parts.select("arc", "salt", earlier.alias("base"))
    counted = parts.groupBy("arc").agg(F.sum("n").alias("n"))
    loads = arcs.join(counted, "arc", "left").select("arc", "shard", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    placed = cut(walk(loads, shards))  # one row; read twice below

    width = F.greatest(F.expr(f"total div {OVERFLOW_BLOCKS}"), F.lit(1)).alias("width")
    homes = placed.select(width, F.inline("placed.homes")).select("width", "arc", F.col("shard").alias("home_shard"), F.col("slot").alias("home_slot"), "home", F.col("queue").alias("home_queue"))
    moves = placed.select(width, F.inline("placed.moves")).where("n > 0")
    moves = moves.select(
        F.explode(F.expr("sequence(queue div width, (queue + n - 1) div width)")).alias("block"),
        F.col("shard").alias("move_shard"),
        F.col("slot").alias("move_slot"),
        F.col("queue").alias("move_queue"),
        F.col("n").alias("move_n"),
    )
    within = F.row_number().over(W.partitionBy("arc", "salt").orderBy("cell", F.xxhash64("doc_id"), "doc_id", "size", "text_crc32")) - 1
    ranked = rows.withColumn("within", within).join(F.broadcast(bases), ["arc", "salt"]).select("doc_id", "size", "text_crc32", "arc", (F.col("base") + F.col("within")).alias("rank"))
    # homes and moves hold at most a few times shards x vnodes + OVERFLOW_BLOCKS rows
    at_home = ranked.join(F.broadcast(homes), "arc")
    queue = F.when(F.col("rank") >= F.col("home"), F.col("home_queue") + F.col("rank") - F.col("home"))
    queued = at_home.withColumn("queue", queue).withColumn("block", F.expr("queue div width"))
    fits = (F.col("queue") >= F.col("move_queue")) & (F.col("queue") < F.col("move_queue") + F.col("move_n"))
    both = queued.join(F.broadcast(moves.withColumnRenamed("block", "move_block")), (F.col("block") == F.col("move_block")) & fits, "left")
    return both.select(
        "doc_id",
        "size",
        "text_crc32",
        "arc",
        F.coalesce("move_shard", "home_shard").alias("shard"),
        F.when(F.col("queue").isNull(), F.col("home_slot") + F.col("rank")).otherwise(F.col("move_slot") + F.col("queue") - F.col("move_queue")).alias("slot"),
        F.col("queue").isNotNull().alias("overflowed"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    out = assign(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "arc", "overflowed")
