"""Document fingerprints by I-Match: terms of middling document frequency, hashed over randomised lexicons.

The lexicon is the terms that stand in at least LEAST and at most MOST of all documents. A document's distinct lexicon terms are sorted and
hashed, once in full and once for each of LEXICONS random subsets of the lexicon, so a few changed terms leave most subset hashes as they
were. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.llm.common import scratch_table, settle, sha256_hex, whole

#: Document shares of lexicon terms. There are at most (mean distinct terms of a document) / LEAST such terms.
LEAST, MOST = 0.002, 0.2
#: EACH subsets hold one lexicon term in RATES[0], EACH others one in RATES[1] and so on: large subsets still hold terms of short texts, small ones tell
#: long texts apart by degrees. Bits of a term's hash say which subsets it is in: a stretch of bits for each rate, of which the values below EACH are subsets.
RATES, EACH = (16, 64, 256, 1024), 16
SHIFTS = (0, 4, 10, 18)
LEXICONS = len(RATES) * EACH
#: A document with fewer lexicon terms than this takes all of its terms instead.
FEW = 3
#: A lexicon of more terms than this is joined by shuffle.
BROADCAST_TERMS = 1_000_000
ID_BITS, ID_LEVELS = 12, 6
#: Texts are dealt in runs of 2^RUN_BITS ids, so that most next documents lie beside their own.
RUN_BITS = 8
#: Up to this many documents whose next one lies elsewhere are asked for by broadcast (32 bytes each), more by shuffle.
BROADCAST_ASKED = 1_000_000
#: Stands for a missing doc_id, below all others, and for a subset without terms.
NO_ID, NOTHING = -9223372036854775808, 0


def terms_of(text: Column) -> Column:
    """Hashes of a text's distinct terms: its words in lower case."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(texts: Column, docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """The terms in the band, and the row 0, which is no term."""
    total = docs.count()
    terms = docs.select(F.explode(terms_of(texts)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    band = terms.filter((F.col("df") >= max(2.0, least * total)) & (F.col("df") <= max(2.0, most * total)) & (F.col("term") != 0)).select("term")
    return band.union(docs.sparkSession.range(1).select(F.lit(0).cast("long")))


def next_lower(ids: DataFrame) -> DataFrame:
    """(k, next) for distinct longs k: the next smaller one, for the smallest the largest.

    Ids are grouped by their leading bits, level over level, so that no task ever orders more than 2^ID_BITS rows."""
    levels = [ids.select("k", F.col("k").alias("top"), F.shiftright("k", ID_BITS).alias("up"))]
    for n in range(1, ID_LEVELS):
        level = levels[-1].groupBy(F.col("up").alias("k")).agg(F.max("top").alias("top"))
        levels.append(settle(level.withColumn("up", F.shiftright("k", ID_BITS) if n < ID_LEVELS - 1 else F.lit(0).cast("long"))))
    above = None
    for level in reversed(levels):
        inside = F.lead("top").over(Window.partitionBy("up").orderBy(F.col("k").desc()))
        here = level.withColumn("lower", inside)
        if above is None:
            here = here.withColumn("next", F.coalesce("lower", F.max("top").over(Window.partitionBy("up"))))
        else:
            here = here.join(above.select(F.col("k").alias("up"), F.col("next").alias("beyond")), "up").withColumn("next", F.coalesce("lower", "beyond"))
        above = here.select("k", "next")
    return above


def with_parts(df: DataFrame, name: str) -> DataFrame:
    """Replaces the sorted terms in ``name`` by 16-bit parts: two that hash all terms, and one above 0 for each subset, NOTHING where it has no term.

    ``inline`` keeps the terms of a rate's subsets from being made anew for every subset."""
    field = lambda c: lambda t: F.shiftright(t, SHIFTS[c]).bitwiseAND(F.lit(RATES[c] - 1))
    some = lambda c: lambda t: field(c)(t) < EACH
    inside = [F.filter(name, some(c)) if rate > EACH else F.col(name) for c, rate in enumerate(RATES)]
    df = df.select("*", F.inline(F.array(F.struct(*[x.alias(f"__in{c}") for c, x in enumerate(inside)]))))
    digest = lambda x: F.when(F.size(x) == 0, F.lit(NOTHING)).otherwise(F.hash(x).bitwiseAND(F.lit(0x3FFF)) + 1).cast("short")
    every = F.hash(name)
    halves = [F.shiftright(every, 16).cast("short"), F.shiftright(F.shiftleft(every, 16), 16).cast("short")]
    subsets = lambda c: F.transform(F.sequence(F.lit(0), F.lit(EACH - 1)), lambda k: digest(F.filter(f"__in{c}", lambda t: field(c)(t) == k)))
    parts = F.concat(F.array(*halves), *[subsets(c) for c in range(len(RATES))])
    return df.withColumn(name, parts).drop(*[f"__in{c}" for c in range(len(RATES))])


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets that either of two fingerprints (arrays of parts) has terms of, the share in which both hashes agree; equal fingerprints have 1."""
    subsets = lambda x: F.slice(x, 3, LEXICONS)
    both = F.zip_with(subsets(a), subsets(b), lambda x, y: F.when((x == NOTHING) & (y == NOTHING), 0).when(x == y, 1001).otherwise(1))
    sums = F.aggregate(both, F.lit(0), lambda s, x: s + x)  # agreeing ones in thousands, all in units
    either, agree = sums % 1000, F.floor(sums / 1000)
    return F.when(a == b, 1.0).when(either == 0, 0.0).otherwise(agree / either).cast("double")


def as_text(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.lower(F.right(F.concat(F.lit("000"), F.hex(p.cast("int").bitwiseAND(F.lit(0xFFFF)))), F.lit(4)))), "")


def pair_terms(rows: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
    """k, mark, rows, n_chars, edited_sha256, own, new: the sorted terms that know ``text`` and ``edited``, for rows dealt by some of up, k and mark.

    Rows alike in k and mark are one. Both texts' terms are looked up and gathered where the texts are: they are not shuffled again."""
    sha, n = F.unhex(sha256_hex(F.col("edited"))), F.length("text")
    known = rows.select("up", "k", "mark", F.inline(F.array(F.struct(n.alias("n"), sha.alias("sha"), terms_of(F.col("text")).alias("t0"), terms_of(F.col("edited")).alias("t1")))))
    none = F.lit(None)
    term = lambda kind: lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term"), none.cast("struct<n:int,sha:binary,t0:array<bigint>,t1:array<bigint>>").alias("rest"))
    # one more row per text carries what is not a term, and all terms for texts with few of the lexicon's
    rest = F.struct(F.lit(2).alias("kind"), F.lit(0).cast("long").alias("term"), F.struct("n", "sha", "t0", "t1").alias("rest"))
    terms = known.select("up", "k", "mark", F.inline(F.concat(F.transform("t0", term(0)), F.transform("t1", term(1)), F.array(rest))))
    found = terms.join(F.broadcast(words) if n_words <= BROADCAST_TERMS else words, "term")
    terms_in = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("term")))
    one = found.groupBy("up", "k", "mark").agg(terms_in(0).alias("c0"), terms_in(1).alias("c1"), F.first("rest", True).alias("rest"), F.count_if(F.col("kind") == 2).alias("rows"))
    chosen = lambda c, t: F.sort_array(F.when(F.size(c) >= FEW, F.col(c)).otherwise(F.col("rest")[t]))
    one = one.select("k", "mark", "rows", F.col("rest.n").cast("long").alias("n_chars"), F.lower(F.hex("rest.sha")).alias("edited_sha256"),
                     F.inline(F.array(F.struct(chosen("c0", "t0").alias("own"), chosen("c1", "t1").alias("new")))))
    return one


def fingerprint_edits(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) characters replaced by the first as many, or all, of the next document, that with the next
    smaller doc_id (after the last: the first). Null texts count as empty, a null doc_id as the smallest. Rows that share a doc_id have the same next
    document; of several with its id, that with the smallest text hash. Equal texts have equal fingerprints. Other columns are not returned. The id -2^63
    counts as missing."""
    k, text = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long")), whole(F.col("text"))
    keyed = docs.select(k.alias("k"), F.shiftright(k, RUN_BITS).alias("up"), F.xxhash64(text).alias("mark"), text.alias("text"))
    words = settle(lexicon(F.col("text"), keyed.select("text"), least, most))
    n_words = words.count()
    per_id = settle(keyed.groupBy("up", "k").agg(F.count(F.lit(1)).alias("n"), F.max(F.floor(F.length("text") / 2)).cast("int").alias("need"), F.min("mark").alias("first")))
    after = settle(next_lower(per_id.select("k")))
    beside, apart = neighbours(keyed, per_id, after)
    terms = reduce(DataFrame.unionByName, [pair_terms(p, words, n_words) for p in (beside, *apart)])
    prints = scratch_table(with_parts(with_parts(terms, "own"), "new"))
    firsts = prints.select("k", "mark", "own").join(per_id.select(F.col("k").alias("f"), "first"), (F.col("k") == F.col("f")) & (F.col("mark") == F.col("first")))
    following = after.withColumnRenamed("k", "before").join(firsts.select(F.col("k").alias("next"), F.col("own").alias("following")), "next").select(F.col("before"), "following")
    full = prints.join(following, F.col("k") == F.col("before")).withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return full.select(F.when(F.col("k") != NO_ID, F.col("k")).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_chars", "edited_sha256",
                       as_text(F.col("own")).alias("fingerprint"), as_text(F.col("new")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))


def neighbours(keyed: DataFrame, per_id: DataFrame, after: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """up, k, mark, text, edited of documents whose next one lies in their run of ids, and of the others: with a next one elsewhere, an id that
    several rows have, or none.

    Texts are dealt once, in runs. The beginnings of next documents travel only for the others, which are few where ids are dense."""
    edited = F.concat(F.expr("left(text, cast(length(text) - floor(length(text) / 2) AS int))"), F.expr("left(start, cast(floor(length(text) / 2) AS int))"))
    columns = ["up", "k", "mark", "text"]
    run = Window.partitionBy("up").orderBy(F.col("k").desc(), "mark")
    placed = keyed.filter(F.col("k") != NO_ID).select(columns).repartition("up").select(*columns, F.lead("k").over(run).alias("below"), F.lag("k").over(run).alias("above"), F.lead("text").over(run).alias("start"))
    inside = (F.col("below") != F.col("k")) & (F.coalesce(F.col("above"), F.col("below")) != F.col("k"))
    beside = placed.filter(inside).select(*columns, edited.alias("edited"))

    last = per_id.groupBy("up").agg(F.min("k").alias("least"))
    asking = per_id.join(last, "up").filter((F.col("k") == F.col("least")) | (F.col("n") > 1)).select(F.col("k").alias("asker"), "need")
    asked = asking.join(after.withColumnRenamed("k", "asker"), "asker").join(per_id.select(F.col("k").alias("next"), "first"), "next")
    asked = settle(asked.select(F.col("next").alias("k"), F.col("first").alias("mark"), "asker", "need"))
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_ASKED else asked
    starts = keyed.select("k", "mark", "text").join(asked, ["k", "mark"]).select(F.col("asker").alias("k"), F.expr("left(text, need)").alias("start"))
    starts = settle(starts)
    first = starts.filter(F.col("k") != NO_ID).groupBy("k").agg(F.min("start").alias("start"))
    elsewhere = placed.filter(~F.coalesce(inside, F.lit(False))).select(columns).join(first, "k").select(*columns, edited.alias("edited"))
    # rows without doc_id, however many, all follow on one text
    alone = starts.filter(F.col("k") == NO_ID).select("start").limit(1)
    lost = keyed.filter(F.col("k") == NO_ID).select(columns).repartition("k", "mark").join(F.broadcast(alone)).select(*columns, edited.alias("edited"))
    return beside, [elsewhere, lost]
