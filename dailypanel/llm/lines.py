"""Line dedup: content-defined chunks of lines, of which repeated ones are removed but for the first.

A text is cut after every line at which a rolling hash over the last lines' hashes is lower than one line before and not higher than one line after, so
an inserted or removed line moves only the boundaries near it. No chunk has one line, unless its text has, and few have more
than five. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import folded, free_name, scratch_table, settle, unfolded, whole

WINDOW = 2
#: Up to this many repeated hashes (8 bytes each) are sent to all executors, more are joined by shuffle.
BROADCAST_HASHES = 1_000_000
#: Multiplier and modulus of the rolling hash.
FACTOR, MODULUS = 31, 4_294_967_291


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _plus(factor: int):
    return lambda a, b: a + b * F.lit(factor).cast("long")


def with_chunks(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds __chunks, the chunks of ``text`` in order, as strings of coded lines. Rolling hash of line i: the sum of FACTOR^k times the
    hash of line i - k for k below ``window``, modulo MODULUS; lines before the first count as 0. There is no cut after the first line and after the last but one.

    A coded line begins with an x, so two line ends in a row stand between chunks only. Every step goes over the arrays once, without
    looking up elements; ``inline`` keeps Spark from computing an array once for each use."""
    lines = lines_of(F.col("text"))
    cut = docs.select("*", F.inline(F.array(F.struct(lines.alias("__lines"), F.transform(lines, line_hash).alias("__hashes")))))
    rolled = F.col("__hashes")
    for k in range(1, window):
        before = F.slice(F.concat(F.array_repeat(F.lit(0).cast("long"), k), "__hashes"), F.lit(1), F.size("__hashes"))
        rolled = F.zip_with(rolled, before, _plus(FACTOR ** k))
    rolled = F.transform(rolled, lambda r: r % F.lit(MODULUS).cast("long"))
    cut = cut.select("*", F.inline(F.array(F.struct(rolled.alias("__rolled")))))
    rolled, n = F.col("__rolled"), F.size("__rolled")
    # zip_with fills the shorter array up with nulls: no value before the first, none after the last but one
    falls = F.zip_with(F.slice(F.concat(F.array(F.lit(None).cast("long")), rolled), F.lit(1), n), rolled, lambda before, r: before > r)
    rises = F.zip_with(rolled, F.slice(rolled, F.lit(2), F.greatest(n - 2, F.lit(0))), lambda r, after: r <= after)
    ends = F.zip_with(falls, rises, lambda falls, rises: falls & rises)
    coded = F.zip_with("__lines", ends, lambda line, end: F.concat(F.lit("x"), line, F.when(end, "\n").otherwise("")))
    chunks = F.split(F.rtrim(F.array_join(coded, "\n"), F.lit("\n")), "\n\n", -1)
    return cut.select("*", F.inline(F.array(F.struct(chunks.alias("__chunks"))))).drop("__lines", "__hashes", "__rolled")


def decoded(chunk: Column) -> Column:
    """The lines of a chunk, or of chunks joined by line ends, as they were."""
    return F.replace(F.substring(chunk, 2, 2 ** 31 - 1), F.lit("\nx"), F.lit("\n"))


def line_count(chunk: Column) -> Column:
    return F.length(chunk) - F.length(F.replace(chunk, F.lit("\n"), F.lit(""))) + 1


def repeated(docs: DataFrame, window: int = WINDOW, min_lines: int = 2) -> DataFrame:
    """(doc_id, mark, gone): positions of the chunks to remove, for documents that have any.

    The chunks are written once. Their hashes are counted first, without texts. The chunks of repeated hashes are then grouped by their bytes, so equal hashes
    of different chunks don't count. The first of equal chunks, by doc_id (null last) and position, stays; rows
    that share a doc_id and position share the place, so none of them is removed."""
    chunks = with_chunks(docs.select("doc_id", F.xxhash64("text").alias("mark"), "text"), window)
    chunks = chunks.select("doc_id", "mark", F.posexplode("__chunks").alias("pos", "body"))
    chunks = chunks.filter((line_count(F.col("body")) >= min_lines) & decoded(F.col("body")).rlike(r"[^\x20\x09-\x0D]"))
    last = F.lit("9223372036854775807").cast("decimal(20,0)")
    place = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), last) * F.lit(1_000_000_000).cast("decimal(10,0)") + F.col("pos")
    chunks = scratch_table(chunks.select("doc_id", "mark", "pos", place.alias("place"), F.xxhash64("body").alias("h"), "body"))
    twice = settle(chunks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"))
    rows = chunks.join(F.broadcast(twice) if twice.count() <= BROADCAST_HASHES else twice, "h")
    # written, so that the join below reads two exchanges and a hot chunk's partition can be split
    first = settle(rows.groupBy("body").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).filter("n > 1").select(F.col("body").alias("same"), "first"))
    extra = rows.join(first, (F.col("body") == F.col("same")) & (F.col("place") > F.col("first")))
    return extra.groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, window: int = WINDOW, min_lines: int = 2) -> tuple[DataFrame, str]:
    """``docs`` with repeated chunks cut from their texts, and one struct column (its name is returned): n_lines,
    n_chunks, n_removed (lines).

    A null text becomes an empty one of one line; a text without repeated chunks stays as it is, byte for byte; a text of which every
    chunk is removed becomes empty. Rows without doc_id take part like others, as the last ones. Empty tables give empty tables."""
    gone = repeated(docs, window, min_lines)
    name = free_name(docs, "line_dedup")
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("gone").alias("__gone"))
    both = folded(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__mark")), "left")
    cut = with_chunks(both, window).withColumn("__gone", F.coalesce("__gone", F.array().cast("array<int>")))
    left = F.filter("__chunks", lambda chunk, k: ~F.array_contains("__gone", k))
    n_lines = lambda chunks: F.aggregate(chunks, F.lit(0), lambda n, chunk: n + line_count(chunk))
    some = F.size("__gone") > 0
    cut = cut.withColumn(name, F.struct(F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"), F.size("__chunks").cast("long").alias("n_chunks"),
                                        F.when(some, n_lines(F.col("__chunks")) - n_lines(left)).otherwise(0).cast("long").alias("n_removed")))
    cut = cut.withColumn("text", F.when(some, decoded(F.array_join(left, "\n"))).otherwise(whole(F.col("text"))))
    return unfolded(cut, docs, name), name
