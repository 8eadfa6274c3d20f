"""Exact dedup by progressive refinement: texts of equal length, then of equal prefix, then of equal full hash.

Texts are never shuffled. One scan writes the length and the hash of a short prefix of every text as a narrow table; rows whose length
occurs once leave before prefixes are compared. What is left is a set of repeated (length, prefix hash) pairs. It reaches the second scan as
a bitmap, which hashes the full content of those texts only. A foreign text that falls on a set bit is hashed for nothing and found alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import free_name, scratch_table, settle, sha256_hex, whole

#: Code points that the second step compares.
PREFIX = 64
#: Up to this many lengths or groups of copies (under 100 bytes each) are sent to all executors, more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Bits for each repeated pair, the most bits of the bitmap (64 MB), and the bits of one of its rows.
BITS_EACH, MOST_BITS, ROW_BITS = 16, 1 << 29, 32_768


def one_space(text: Column) -> Column:
    """A text with each run of ASCII white space replaced by one space; a null text is an empty one."""
    return F.regexp_replace(whole(text), r"[\x20\x09-\x0D]+", " ")


def sized(small: DataFrame) -> DataFrame:
    """``small``, to be broadcast if it has few rows, which must be of fixed width. It is read twice: give a settled one."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def repeated_pairs(texts: DataFrame, prefix: int) -> DataFrame:
    """The hashes of those (length, prefix) pairs that more than one row of ``texts`` (__same) has."""
    n, head = F.octet_length("__same"), F.substring("__same", 1, prefix)
    keys = scratch_table(texts.select(n.alias("n"), F.xxhash64(n, head).alias("pair")))
    lengths = settle(keys.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("n"))
    alike = keys.join(sized(lengths), "n")
    return settle(alike.groupBy("pair").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("pair"))


def bitmap(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(slot, bits): a bitmap of 64-bit hashes in rows of ROW_BITS, and its size in bits: 16 for each hash, up to MOST_BITS. Beyond that more
    and more foreign texts pass, to no harm but time."""
    size = ROW_BITS
    while size < min(BITS_EACH * pairs.count(), MOST_BITS):
        size *= 2
    at = F.pmod("pair", F.lit(size).cast("long"))
    rows = pairs.groupBy(F.floor(at / ROW_BITS).cast("int").alias("slot")).agg(F.bitmap_construct_agg(at % ROW_BITS).alias("bits"))
    return settle(rows), size


def with_full_hash(texts: DataFrame, pairs: DataFrame, prefix: int) -> DataFrame:
    """Adds __full, the SHA-256 of __same where its pair may be repeated, else null."""
    bits, size = bitmap(pairs)
    at = F.pmod(F.xxhash64(F.octet_length("__same"), F.substring("__same", 1, prefix)), F.lit(size).cast("long"))
    bits = bits.select(F.col("slot").alias("__slot"), F.col("bits").alias("__bits"))
    both = texts.withColumn("__at", at).join(F.broadcast(bits), F.floor(F.col("__at") / ROW_BITS).cast("int") == F.col("__slot"), "left")
    place = (F.col("__at") % ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))
    return both.withColumn("__full", F.when(hit, F.unhex(sha256_hex(F.col("__same"))))).drop("__at", "__slot", "__bits")


def find_copies(docs: DataFrame, text: Column | None = None, prefix: int = PREFIX, returns: list[Column] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): keep_id, group_size, kept. ``returns``: the columns to give back, all by default;
    without the text, rows stay narrow. ``text`` (``one_space`` of the column text by default) is what is compared.

    Of rows with equal texts the one with the smallest doc_id stays; rows without doc_id come last, and keep_id is null if no row of the group
    has one. Of rows that repeat the smallest doc_id too, one stays. Null and empty texts are equal. Any number of copies may share a
    text: groups are counted before they are shuffled, and rows only look their group up. Empty tables give empty tables."""
    name = free_name(docs, "copies")
    texts = docs.withColumn("__same", one_space(F.col("text")) if text is None else text)
    hashed = with_full_hash(texts, repeated_pairs(texts, prefix), prefix)
    rest = returns or [F.col(f"`{c}`") for c in docs.columns]
    # the place settles which of several equal rows stays; it is written, so that it is the same for all readers
    rows = scratch_table(hashed.select(F.struct(*rest).alias("row"), F.col("doc_id").alias("id"), F.col("__full").alias("full"), F.monotonically_increasing_id().alias("place")))
    one = rows.filter("full IS NOT NULL").groupBy("full").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("id").isNull(), "id", "place")).alias("first"))
    groups = settle(one.filter("n > 1").select(F.col("full").alias("same"), "n", F.col("first.id").alias("keep"), F.col("first.place").alias("stays")))
    alone = F.struct(F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    member = F.struct(F.col("keep").alias("keep_id"), F.col("n").alias("group_size"), (F.col("place") == F.col("stays")).alias("kept"))
    found = rows.filter("full IS NOT NULL").join(sized(groups), F.col("full") == F.col("same"), "left")
    out = rows.filter("full IS NULL").select("row", alone.alias(name)).unionByName(found.select("row", F.when(F.col("n").isNull(), alone).otherwise(member).alias(name)))
    return out.select("row.*", name), name


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``find_copies`` keeps."""
    out, name = find_copies(docs, **options)
    return out.filter(F.col(name)["kept"]).drop(name)
