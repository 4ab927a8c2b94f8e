"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; a folder of this machine will do only where all of Spark is in this process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    with_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared checkpoint folder and read from there, with its folder.

    For loops: a checkpointed frame keeps the size that was estimated for the plan
    that made it, and joins multiply these round by round; a file has its own size.
    """
    spark = df.sparkSession
    with_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``stored`` that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def id_crc(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id's decimal text."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"))


def held_out(divisor: int, remainder: int) -> Column:
    """True for the fold that no model learns from; a null id is never learned from."""
    return F.coalesce(id_crc() % divisor == remainder, F.lit(True))


#: Runs of these are words once A-Z is lower-cased: digits, a-z and all that is not ASCII.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def alnum_words(text: Column) -> Column:
    """The lower-cased words of a text.

    ``lower`` also turns two letters that are not ASCII into ASCII ones, so these
    are replaced first; other letters stay outside ASCII, whatever their case.
    """
    kept = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("µ")), F.lit("İ"), F.lit("µ"))
    return F.regexp_extract_all(F.lower(kept), F.lit(f"({ALNUM})"), F.lit(1))


def same_row(left: str, right: str, *more: str) -> Column:
    """The join of a document's rows on its id (null equals null) and text hash."""
    keys = ["doc_id", "text_hash", *more]
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


#: The words of 64 bits in a bitmap of keys.
_BITMAP_BITS = 20


def maybe_among(rows: DataFrame, hashed: str, keys: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false for those whose hash in the column ``hashed`` is surely not among the longs of ``keys``.

    The bitmap has 2 ** 20 rows of two numbers at most, however many keys, and is
    broadcast; beyond some 60 million keys it tells little, and is no less right.
    """
    key = keys.columns[0]
    word = lambda c: F.shiftrightunsigned(c, 64 - _BITMAP_BITS)
    bit = lambda c: F.expr(f"shiftleft(1L, int(`{c}` & 63))")
    bitmap = keys.groupBy(word(key).alias("_word")).agg(F.bit_or(bit(key)).alias("_bits"))
    joined = rows.withColumn("_word", word(hashed)).join(F.broadcast(bitmap), "_word", "left")
    return joined.withColumn("maybe", F.coalesce(F.col("_bits").bitwiseAND(bit(hashed)) != 0, F.lit(False))).drop("_word", "_bits")
