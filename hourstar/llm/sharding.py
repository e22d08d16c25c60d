"""Shards by a keyed permutation of global row numbers: a reproducible shuffle with computable places.

Law ``rows``: rows get numbers 0..N-1, a Feistel network permutes them, and the permuted number p gives
``shard = p mod n`` and ``slot = p div n``. Counts differ by one at most and slots have no gaps. Where a
row goes follows from its number, N and the seed alone; :func:`feistel` computes it without the data.

Rows are numbered by (bucket of the id, id, size, checksum). Texts are not shuffled: they are reduced to
size and checksum in the scan. Equal texts have different ids, so a large group of copies is spread.

Defined results. Null or empty text: size 16, checksum 0. Null ids: one bucket, numbered first. Rows equal
in id, size and checksum are interchangeable: they get different slots in no stated order. Empty table:
no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERHEAD_BYTES = 16
ROUNDS = 8
# Steps of cycle walking. At most a - 1 < sqrt(N) + 1 of the a * b numbers lie outside 0..N-1: for N up to
# 3,900 a walk always ends within these steps, beyond that it fails to with a chance below 62 ** -64.
WALK = 64
# Buckets of ids for numbering; also the rows of the one broadcast table.
BUCKETS = 8192


def feistel(number: Column, a: Column, b: Column, rows: Column, seed: int) -> Column:
    """The place of ``number`` in a permutation of 0..rows-1, where ``a * b >= rows``.

    The halves live in 0..a-1 and 0..b-1; each round adds a hash of one to the other, which can be undone.
    Results outside 0..rows-1 are permuted again.
    """

    def mixed(half: Column, turn: Column, size: Column) -> Column:
        return F.pmod(F.xxhash64(half, turn, F.lit(seed)), size)

    def one_round(state: Column, turn: Column) -> Column:
        left = F.pmod(state["l"] + mixed(state["r"], turn, a), a)
        return F.named_struct(
            F.lit("l"), left, F.lit("r"), F.pmod(state["r"] + mixed(left, turn + ROUNDS, b), b)
        )

    def once(value: Column) -> Column:
        start = F.named_struct(F.lit("l"), F.pmod(value, a), F.lit("r"), F.floor(value / a).cast("long"))
        turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        return F.aggregate(turns, start, one_round, lambda s: s["r"] * a + s["l"])

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), once(number), lambda v, _: F.when(v < rows, v).otherwise(once(v))
    )
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("the walk did not end")).cast("long"))


def shard_rows(df: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row; see the module's text."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    ids = df.select(F.col(id_col).alias("id"))
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int")
    # Of the first scan only the ids are read; one row per bucket, so the running sum is small.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = ids.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        "bucket",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(everything).alias("rows"),
    )
    side = F.ceil(F.sqrt(F.col("rows"))).cast("long")
    offsets = offsets.select(
        "bucket", "before", "rows", side.alias("a"), F.ceil(F.col("rows") / side).cast("long").alias("b")
    )
    facts = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("bucket", bucket)
    inside = Window.partitionBy("bucket").orderBy("id", "size", "text_crc32")
    numbered = (
        facts.withColumn("within", F.row_number().over(inside).cast("long") - 1)
        .join(F.broadcast(offsets), "bucket")  # BUCKETS rows at most
        .withColumn("place", feistel(F.col("before") + F.col("within"), F.col("a"), F.col("b"), F.col("rows"), seed))
    )
    return numbered.select(
        F.col("id").alias(id_col), "size", "text_crc32",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
    )
