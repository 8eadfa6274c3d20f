"""Mixing sources to target weights: Efraimidis-Spirakis sampling without replacement to word budgets.

Every source takes whole epochs of its documents first and then the documents with the smallest exponential keys, -ln(u) / weight, up
to the rest of its budget. Where a source's budget ends is found by narrowing, from sums per key range, so no source is ever ordered
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.llm.common import folded, free_name, settle, unfolded, whole

WEIGHTS = (5, 2, 1)
MOST = 3.0
#: Key ranges in an octave, and finer ranges in each of them.
STEPS, FINE = 64, 4096
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: the more of a text's characters are symbols, the less likely it is drawn early."""
    symbols = F.regexp_count(whole(text), F.lit(r"[#*$%&|<>]"))
    return F.greatest(F.lit(0.05), 1 - 4 * symbols / F.greatest(F.length(whole(text)), F.lit(1)))


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in (0, 1] that depends on the id alone, or on the text where there is no id."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(whole(text))))
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 12), 16, 10)
    return (digits.cast("double") + 1) / F.lit(float(16 ** 12))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, target, epochs, budget from (source, size) rows. Sources in code point order, null last, take ``weights`` in turn.

    With caps c = most x size, every target is min(level x weight, c). The level at which the targets sum to the total is the largest of
    (total - caps of the sources before) / (weights from here on) over the sources in order of c / weight. One row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])[(F.row_number().over(order) - 1) % len(weights)]
    per = per.withColumn("weight", turn).withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(every) - (F.sum("cap").over(by_ratio) - F.col("cap"))) / (F.sum("weight").over(every) - (F.sum("weight").over(by_ratio) - F.col("weight")))
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(every))
    target = F.least(F.col("level") * F.col("weight"), F.col("cap"))
    per = per.withColumn("target", F.coalesce(target, F.lit(0.0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(F.lit(0)).cast("long")
    per = per.withColumn("epochs", epochs)
    return per.select("source", "source_size", "target", "epochs", F.greatest(F.lit(0), F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")).alias("budget"))


def with_keys(docs: DataFrame, seed: str, weight: Column | None) -> DataFrame:
    """Adds __size and __at, where a document stands in its source: key range, finer range, key, doc_id, hash of the text.

    Ranges are steps of the key's logarithm, so a weight only shifts them: whatever the weights, no range holds more than 0.4 % of a source's
    documents, and no finer one more than about a millionth, but for rows that share an id."""
    w = quality_weight(F.col("text")) if weight is None else weight
    key = -F.log(uniform(F.col("doc_id"), F.col("text"), seed)) / w
    octave = F.log2(F.greatest(key, F.lit(1e-300))) * STEPS
    b1 = F.floor(octave).cast("int")
    b2 = F.least(F.floor((octave - b1) * FINE), F.lit(FINE - 1)).cast("int")
    at = F.struct(b1.alias("b1"), b2.alias("b2"), key.alias("key"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark"))
    return docs.withColumn("__size", word_count(F.col("text"))).withColumn("__at", at)


def _edge(sums: DataFrame, by: list[str]) -> DataFrame:
    """The row of each source in which its running sum passes ``rest``; ``rest`` then is what is left of it before that row."""
    running = Window.partitionBy("source").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = sums.withColumn("upto", F.sum("total").over(running)).filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("total") <= F.col("rest")))
    return passed.withColumn("rest", F.col("rest") - (F.col("upto") - F.col("total"))).drop("upto", "total")


def cut_points(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source that has words: cut (the place of the document at which its budget ends), share (words of it that are taken)."""
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    flat = rows.filter("size > 0").select("source", "size", "at.*")
    sums = flat.groupBy("source", "b1").agg(F.sum("size").alias("total"))
    t = targets.select(F.col("source").alias("s"), F.col("budget").alias("rest"))
    one = settle(_edge(sums.join(t, same("source", "s")).drop("s"), ["b1"])).select(F.col("source").alias("s"), F.col("b1").alias("c1"), "rest")
    inner = flat.join(one, same("source", "s") & (F.col("b1") == F.col("c1"))).drop("s", "c1")
    sums = inner.groupBy("source", "b1", "b2").agg(F.sum("size").alias("total"), F.min("rest").alias("rest"))
    two = settle(_edge(sums, ["b2"])).select(F.col("source").alias("s"), F.col("b1").alias("c1"), F.col("b2").alias("c2"), "rest")
    last = flat.join(two, same("source", "s") & (F.col("b1") == F.col("c1")) & (F.col("b2") == F.col("c2")))
    sums = last.groupBy("source", "b1", "b2", "key", "id", "mark").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("alike"), F.min("rest").alias("rest"))
    edge = _edge(sums, ["key", "id", "mark"])
    return edge.select("source", F.struct("b1", "b2", "key", "id", "mark").alias("cut"), F.floor(F.col("rest") / F.col("alike")).cast("long").alias("share"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, seed: str = SEED, weight: Column | None = None) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): size, source_size, target, epochs (times that it is taken whole),
    rest (words taken once more from its start, if it isn't taken whole again), taken (words in all).

    A null text has no words and is never taken; a null source is a source, the last one; a row without doc_id is drawn by its text. Rows
    equal in doc_id and text share the budget's last words evenly. The same input gives the same result."""
    name = free_name(docs, "mix")
    rows = settle(with_keys(docs.select("doc_id", "source", "text"), seed, weight).select("source", F.col("__size").alias("size"), F.col("__at").alias("at")))
    targets = settle(source_targets(rows, weights, most))
    plan = targets.join(cut_points(rows, targets).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    plan = plan.select(F.col("source").alias("__source"), F.struct("source_size", "target", "epochs", "cut", "share").alias("__plan"))
    out = with_keys(folded(docs, "source"), seed, weight).join(settle(plan), F.col("source").eqNullSafe(F.col("__source")), "left")
    size, at, p = F.col("__size"), F.col("__at"), F.col("__plan")
    again = (size > 0) & (at < p["cut"])
    rest = F.when(again | (size == 0), F.lit(0)).when(at == p["cut"], p["share"]).otherwise(F.lit(0)).cast("long")
    epochs = F.when(size == 0, F.lit(0)).otherwise(p["epochs"] + F.coalesce(again, F.lit(False)).cast("long")).cast("long")
    out = out.withColumn(name, F.struct(size.alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"), epochs.alias("epochs"),
                                        F.coalesce(rest, F.lit(0)).cast("long").alias("rest")))
    m = F.col(name)
    out = out.withColumn(name, m.withField("taken", m["epochs"] * m["size"] + m["rest"]))
    return unfolded(out, docs, name), name


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each time that a document is taken; the one at which a budget ends also appears cut to its first words."""
    out, name = mix(docs, **options)
    m = F.col(name)
    copies = F.transform(F.sequence(F.lit(1), m["epochs"]), lambda i: F.lit(None).cast("long"))
    copies = F.when(m["epochs"] > 0, copies).otherwise(F.array().cast("array<bigint>"))
    copies = F.concat(copies, F.when(m["rest"] > 0, F.array(m["rest"])).otherwise(F.array().cast("array<bigint>")))
    words = free_name(docs, "words_taken")
    rows = out.withColumn(words, F.explode(copies)).drop(name)
    head = F.array_join(F.slice(F.split(F.regexp_replace(whole(F.col("text")), r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"), F.lit(1), F.col(words).cast("int")), "")
    return rows.withColumn("text", F.when(F.col(words).isNull(), F.col("text")).otherwise(F.regexp_replace(head, r"[\x20\x09-\x0D]+$", ""))).drop(words)
