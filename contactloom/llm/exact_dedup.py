"""Exact duplicates by two passes with a Bloom filter.

Pass 1 hashes every normalised text to two slots and keeps the slots that were hit twice, packed into
bitmaps.  Pass 2 tests every row against the broadcast bitmaps: a row with a slot that was hit once has
no copy and passes straight through; only the others shuffle and are grouped by their full SHA-256.
The filter never misses a copy, so results are exact at any fill; a fuller filter only sends more
rows through the shuffle.

``filter_bits`` fixes the size of what is broadcast (bits / 8 bytes).  By default it is 16 bits per row,
rounded up to a power of two, and at most ``MAX_BITS`` (32 MB).

A hot group of copies is combined before every shuffle; the one join back to its rows is a join on a
table with one row per group, which adaptive execution splits.

Defined cases: a null text counts as empty; a null id sorts last and is kept only if its whole group
has none; rows repeated with one id and one text are each listed, and one of them stays; further
columns are carried by ``deduplicate`` untouched; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.common import free_name, spaced, texts
from contactloom.sources.staging import stage

MAX_BITS = 1 << 28
BITS_PER_ROW = 16
SLOTS = 2


def normalised(text: Column) -> Column:
    """Each run of white space as one blank; only texts with such runs meet the regular expression."""
    flat = spaced(text)
    return F.when(F.contains(flat, F.lit("  ")), F.regexp_replace(flat, " +", " ")).otherwise(flat)


def text_hash(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def filter_bits(n_rows: int) -> int:
    return min(MAX_BITS, max(1 << 16, 1 << (BITS_PER_ROW * max(n_rows, 1) - 1).bit_length()))


def _slot(key: Column, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits).cast("long")) + 1


def repeat_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap): the slots that two or more rows of ``keys`` hit; at most bits / 32768 rows of 4 KB."""
    slots = keys.select(F.explode(F.array(*[_slot(F.col(key), i, bits) for i in range(SLOTS)])).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )


def maybe_repeated(df: DataFrame, key: str, bitmaps: DataFrame, bits: int, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: false is certain, true is possible.  No row of ``df`` moves."""
    hit = F.lit(True)
    for i in range(SLOTS):
        bucket, bitmap = f"_bucket{i}", f"_bitmap{i}"
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap)))
        slot = _slot(F.col(key), i, bits)
        df = df.join(side, F.bitmap_bucket_number(slot) == F.col(bucket), "left")
        place = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.getbit(byte, (place % 8).cast("int")) == 1
        hit = hit & F.coalesce(bit, F.lit(False))
    return df.withColumn(flag, hit).drop(*[f"_{n}{i}" for i in range(SLOTS) for n in ("bucket", "bitmap")])


def decisions(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Hashes are staged once, so that texts are read a single time and only (id, hash) is read again.
    """
    hashed = stage(texts(docs).select("doc_id", text_hash(F.col("text")).alias("text_sha256")))
    bits = filter_bits(hashed.count())
    tested = maybe_repeated(hashed, "text_sha256", repeat_filter(hashed, "text_sha256", bits), bits, "again")
    alone = tested.where(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    rows = tested.where("again").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = rows.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    each = rows.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.posexplode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("copy", "_"),
    )
    met = each.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"), "text_sha256",
    )
    return alone.unionByName(met)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; rows without a copy never shuffle."""
    key, flag, row, rank = (free_name(docs, n) for n in ("_key", "_again", "_row", "_rank"))
    hashed = docs.withColumn(key, text_hash(F.col(text_col)))
    bits = filter_bits(docs.count())
    tested = maybe_repeated(hashed, key, repeat_filter(hashed, key, bits), bits, flag)
    comparable = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.xxhash64(*comparable))
    first = (
        tested.where(flag)
        .select(key, F.struct(*[F.col(c) for c in docs.columns]).alias(row), order.alias(rank))
        .groupBy(key)
        .agg(F.min_by(row, rank).alias(row))
        .select(f"{row}.*")
    )
    return tested.where(~F.col(flag)).select(*docs.columns).unionByName(first)
