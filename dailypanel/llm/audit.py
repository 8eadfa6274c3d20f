"""Filter interaction audit: what each filter removes in every order in which the filters can run.

A state is the set of filters that have run. From a state an edge leads to each state with one filter more, and an order is a path from the empty set to
the full one. What an edge removes depends on its state alone, so documents are only counted by the set of filters that they fail. Counting the
paths that reach a state (forward) and that leave it (backward) gives each edge the number of orders that take it: a filter's removals over all
orders are a weighted sum over edges, and an order's steps are read from the same edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import WORD, scratch_table, settle, whole
from dailypanel.llm.exact import sized

LETTERS = "ABCDE"
#: Orders grow with the factorial of the number of filters; 7 filters have 5040.
MOST_FILTERS = 7


def text_failures(text: Column, words: Column, distinct: Column) -> list[Column]:
    """The filters on one text: A short, B repetitive, C capitals, D symbols."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [words < 100, 100 * distinct < 80 * words, 100 * capitals > 10 * F.length(text), text.rlike(r"[#$%&*|]")]


def with_failures(docs: DataFrame) -> DataFrame:
    """(part, doc_id, fails) of all ``docs``: fails has bit k if filter k of LETTERS fails. E: a smaller doc_id has the identical text."""
    text = whole(F.col("text"))
    cut = docs.select(F.coalesce("lang", F.lit("")).alias("part"), "doc_id", text.alias("text"), F.inline(F.array(F.struct(F.regexp_extract_all(text, F.lit(WORD), 0).alias("words")))))
    counted = cut.select("part", "doc_id", "text", F.size("words").cast("long").alias("n"), F.size(F.array_distinct("words")).cast("long").alias("d"))
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(text_failures(F.col("text"), F.col("n"), F.col("d")))]
    rows = scratch_table(counted.select("part", "doc_id", sum(bits[1:], bits[0]).alias("fails"), F.unhex(F.sha2("text", 256)).alias("full")))
    one = rows.groupBy("full").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    firsts = settle(one.filter("n > 1").select(F.col("full").alias("same"), "first"))
    found = rows.join(sized(firsts), F.col("full") == F.col("same"), "left")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return found.select("part", "doc_id", (F.col("fails") + F.when(later, 16).otherwise(0)).alias("fails"))


def cells(failures: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, docs, good, toxic): documents by the set of filters that they fail, at most 2^filters rows a part.

    A document is good, or toxic, if any of its label rows says 1; one without doc_id has no label."""
    marks = labels.filter("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    both = failures.join(marks, F.col("doc_id") == F.col("id"), "left")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return both.groupBy("part", "fails").agg(F.count(F.lit(1)).alias("docs"), count("good"), count("toxic"))


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """For each state (bit set): the orders that reach it from the empty set, and those that leave it to the full set."""
    states, full = range(1 << filters), (1 << filters) - 1
    forward, backward = [int(s == 0) for s in states], [int(s == full) for s in states]
    for s in states:
        for k in range(filters):
            if not s >> k & 1:
                forward[s | 1 << k] += forward[s]
    for s in reversed(states):
        for k in range(filters):
            if not s >> k & 1:
                backward[s] += backward[s | 1 << k]
    return forward, backward


def lattice(filters: int) -> list[tuple[int, int, int]]:
    """All edges: (state, bit of the filter that runs next, orders that take the edge)."""
    forward, backward = path_counts(filters)
    return [(s, 1 << k, forward[s] * backward[s | 1 << k]) for s in range(1 << filters) for k in range(filters) if not s >> k & 1]


def order_steps(letters: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """All steps of all orders: (order, step from 1, state before it, bit of its filter)."""
    out = []
    for order in permutations(range(len(letters))):
        state = 0
        for step, k in enumerate(order, 1):
            out.append(("".join(letters[i] for i in order), step, state, 1 << k))
            state |= 1 << k
    return out


def edge_counts(counted: DataFrame, filters: int) -> DataFrame:
    """What every edge of the lattice keeps and removes in each part, from ``cells``: a row per part and edge, zeros included."""
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(bit).alias("bit"), F.lit(n).cast("long").alias("orders")) for s, bit, n in lattice(filters)])
    rows = counted.select("*", F.inline(edges))
    here = F.col("fails").bitwiseAND(F.col("bit")) != 0
    before = F.col("fails").bitwiseAND(F.col("state")) != 0
    total = lambda which, what="docs": F.sum(F.when(which, F.col(what)).otherwise(0)).cast("long")
    return rows.groupBy("part", "state", "bit", "orders").agg(
        total(~here & ~before).alias("kept"), total(here & ~before).alias("removed"), total(here & before).alias("redundant"),
        total(F.col("fails") == F.col("bit")).alias("unique_fails"), total(here & ~before, "good").alias("good_lost"), total(here & ~before, "toxic").alias("toxic_lost"))


def interactions(counted: DataFrame, letters: Sequence[str] = LETTERS) -> DataFrame:
    """A row for each part, order and step of ``cells``. Nothing here grows with the documents, only with the number of parts."""
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    edges = settle(edge_counts(counted, len(letters)))
    shapley = edges.groupBy(F.col("part").alias("p"), F.col("bit").alias("b")).agg(F.sum(F.col("orders") * F.col("removed")).cast("long").alias("shapley"))
    steps = edges.sparkSession.createDataFrame(order_steps(letters), "filter_order string, step int, s int, k int")
    rows = edges.join(shapley, (F.col("part") == F.col("p")) & (F.col("bit") == F.col("b"))).join(F.broadcast(steps), (F.col("state") == F.col("s")) & (F.col("bit") == F.col("k")))
    return rows.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step (1 to 5), kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of the five filters of LETTERS.

    A null text is an empty one: it fails A, and E if a smaller doc_id is empty too. A null lang is the part ''. Rows without doc_id count, have no
    label, never fail E and make no other fail it; rows that repeat a doc_id count each. Other columns are ignored. No documents, no rows."""
    return interactions(cells(with_failures(docs), labels))
