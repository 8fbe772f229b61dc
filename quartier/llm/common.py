"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The bytes that separate words.
ASCII_SPACE = r"[\x20\x09-\x0D]"

#: Ids of at most this many rows are broadcast: with its hash table an id takes
#: some 50 bytes of the driver, several times over while it is built. Beyond it
#: a table of bits is broadcast, and rows whose bit is set meet the ids in a
#: shuffled join.
BROADCAST_IDS = 500_000

#: Bits that stand for a set of ids, however many (8 MB).
ID_BITS = 1 << 26
_BUCKET_BITS = 1 << 15     # of one value of bitmap_construct_agg

#: Stands for a null doc_id inside operators: larger than every real id.
NO_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows per Arrow batch. Spark's default of 10000 suits narrow rows; of texts it
#: would hold tens of megabytes in the JVM and in every Python worker.
BATCH_ROWS = 2000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session has chosen a size itself."""
    if spark.conf.get(_BATCH_KEY) == "10000":
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone (null text: empty); other columns are ignored."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id: of empty text)."""
    as_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(as_text.cast("binary")), F.lit(modulus)).cast("int")


def without_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose key is not in ``ids`` (one column, named ``key``)."""
    return _by_ids(df, ids, key, "left_anti")


def with_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` (one column, named ``key``)."""
    return _by_ids(df, ids, key, "left_semi")


def _by_ids(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return df.join(F.broadcast(ids), key, how)
    likely = likely_ids(df, ids, key).join(ids, key, how)
    if how == "left_semi":
        return likely
    return _by_bits(df, ids, key, "left_anti").unionByName(likely)


def likely_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` and some others, whose keys share a
    bit with one. What reaches the driver does not grow with the ids."""
    return _by_bits(df, ids, key, "left_semi")


def _by_bits(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join with the bits of the ids; a null key has none."""
    at = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(ID_BITS))
    bucket, place = F.floor(at / _BUCKET_BITS), at % _BUCKET_BITS
    bits = (ids.filter(F.col(key).isNotNull()).select(bucket.alias("_bucket"), place.alias("_place"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bits")))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.floor(byte.cast("int") / F.pow(F.lit(2), place % 8)) % 2 == 1
    return df.join(F.broadcast(bits), F.col(key).isNotNull() & (bucket == F.col("_bucket")) & is_set,
                   how)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(df: DataFrame, weight: str, limit: int) -> Iterator[list]:
    """Rows in driver-sized blocks: each holds at most ``limit`` of ``weight``
    (or a single row), so that no block grows with the table."""
    block: list = []
    total = 0
    for row in df.toLocalIterator():
        w = int(row[weight] or 0)
        if block and total + w > limit:
            yield block
            block, total = [], 0
        block.append(row)
        total += w
    if block:
        yield block


def most_frequent(counts: DataFrame, key: str, n: str, limit: int) -> DataFrame:
    """The at most ``limit`` rows of the largest counts, without a sort of all.

    Counts fall into levels of an eighth of a power of two: whole levels are
    taken from the top, and of the first level that does not fit the hash buckets
    of the key that do. So many equal counts never leave the result empty, and
    only the levels and one level's buckets reach the driver.
    """
    level = F.floor(8 * F.log2(F.col(n)))
    bucket = F.pmod(F.xxhash64(key), F.lit(4096))
    held, cut = 0, None
    for r in sorted(counts.groupBy(level.alias("l")).count().collect(), reverse=True):
        if held + r["count"] > limit:
            cut = r["l"]
            break
        held += r["count"]
    if cut is None:
        return counts
    last = 0
    for r in sorted(counts.filter(level == cut).groupBy(bucket.alias("b")).count().collect()):
        held += r["count"]
        if held > limit:
            break
        last = r["b"] + 1
    return counts.filter((level > cut) | ((level == cut) & (bucket < last)))


def lean(work):
    """A group's function that gives its memory back when it is done."""
    def run(pdf):
        out = work(pdf)
        release()
        return out
    return run


def lean_pair(work):
    """The same for a function of two groups."""
    def run(left, right):
        out = work(left, right)
        release()
        return out
    return run


def release() -> None:
    """Give freed memory of a worker back to the system: Python workers outlive
    their tasks, and what they keep is counted against their executor."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):    # another C library
        pass
