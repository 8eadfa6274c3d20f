"""Quality rules: a decision list of threshold conjunctions learned by sequential covering.

Statistics of whole texts are computed on the executors; a bounded sample of labelled documents teaches the rules;
the rules are an ordered Spark conditional expression, so judging a document is a comparison of a few numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import free_name, ship

#: Labelled documents that teach the rules, at most about.
SAMPLE_ROWS = 20_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share",
          "distinct_share", "bare_share")
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + ", ".join(f"{x} double" for x in SHARES)
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


def repeat_words(words: list, n: int = 5) -> int:
    """Words that lie in a window of ``n`` words which the text holds twice or more."""
    windows = list(zip(*(words[k:] for k in range(n))))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    total, reach = 0, 0
    for at, w in enumerate(windows):
        if w in twice:
            total += at + n - max(at, reach)
            reach = at + n
    return total


def text_statistics(text: str | None) -> tuple:
    """The numbers of ``STATS`` for one whole text; a null text counts as an empty one."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen, lines, dups = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dups += line in seen
            seen.add(line)
    n, repeats = len(words), repeat_words(words)
    some, letters = max(chars, 1), max(len(text), 1)
    low = text.lower()
    upper = sum(a != b for a, b in zip(text, low)) if len(low) == len(text) and low != text else 0
    bare = sum(len(w) == 1 and not w.isalnum() for w in words)
    marks = sum(text.count(c) for c in "!?")
    digits = sum(text.count(c) for c in "0123456789")
    return (n, chars, symbols, dups, repeats, chars / max(n, 1), symbols / some, dups / max(lines, 1), repeats / max(n, 1),
            upper / letters, digits / some, marks / some, len(set(words)) / max(n, 1), bare / max(n, 1))


def statistics(text: Column) -> Column:
    """A struct of ``STATS``; evaluated once per row, wherever its fields are used."""

    @F.pandas_udf(STATS)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_statistics(t) for t in texts], columns=[*BASE, *SHARES])

    return of.asNondeterministic()(text)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def on(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self, s: Column) -> Column:
        return s[self.feature] > self.threshold if self.above else s[self.feature] <= self.threshold


def _covers(rule: list[Test], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for test in rule:
        hit &= test.on(x)
    return hit


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """FOIL's gain of covering p bad and n good rows instead of p0 and n0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, g, -np.inf)


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray, cuts: int) -> tuple[float, Test | None]:
    p0, n0 = bad.sum(), (~bad).sum()
    best, found = 1e-9, None
    for name in SHARES:
        v = x[name]
        edges = np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1)))
        middles = (edges[:-1] + edges[1:]) / 2
        for above in (True, False):
            hit = v[:, None] > middles[None, :] if above else v[:, None] <= middles[None, :]
            g = _gain(hit[bad].sum(0).astype(float), hit[~bad].sum(0).astype(float), p0, n0)
            if len(g) and g.max() > best:
                k = int(g.argmax())
                best, found = float(g[k]), Test(name, above, float(middles[k]))
    return best, found


def learn(sample: pd.DataFrame, min_precision: float = 0.95, max_rules: int = 24, max_tests: int = 5, cuts: int = 128) -> list[list[Test]]:
    """Rules that reject, in order: each is grown test by test on two thirds of the rows still uncovered, pruned from its
    end on the other third, and accepted while at least ``min_precision`` of the rows that it covers there are bad.
    Without rows of both kinds there are no rules."""
    order = np.argsort(np.array([hash_of(i) for i in range(len(sample))]), kind="stable")
    sample = sample.iloc[order].reset_index(drop=True)
    x = {c: sample[c].to_numpy(float) for c in SHARES}
    bad = sample["bad"].to_numpy(bool)
    grows = np.arange(len(sample)) % 3 != 2
    left, rules = np.ones(len(sample), bool), []
    while len(rules) < max_rules:
        g, v = left & grows, left & ~grows
        if bad[g].sum() < 3 or (~bad[g]).sum() == 0:
            break
        rule, now = [], g.copy()
        while len(rule) < max_tests and (~bad[now]).any():
            _, test = _best_test({c: a[now] for c, a in x.items()}, bad[now], cuts)
            if test is None:
                break
            rule.append(test)
            now &= test.on(x)
        worth = []
        for k in range(1, len(rule) + 1):
            hit = _covers(rule[:k], {c: a[v] for c, a in x.items()}, int(v.sum()))
            p, n = bad[v][hit].sum(), (~bad[v])[hit].sum()
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k))
        if not worth:
            break
        rule = rule[: -max(worth)[1]]
        all_hit = left & _covers(rule, x, len(sample))
        on_v = all_hit & v
        if bad[all_hit].sum() < 3 or bad[all_hit].mean() < min_precision or (on_v.any() and bad[on_v].mean() < min_precision):
            break
        rules.append(rule)
        left &= ~all_hit
    return rules


def hash_of(i: int) -> int:
    return (i * 2654435761) % 4294967296


def verdict(rules: list[list[Test]], s: Column) -> Column:
    """1, 2, ... for the first rule that rejects the document, 0 if none does: one ordered conditional expression."""
    out = None
    for k, rule in enumerate(rules, 1):
        every = rule[0].column(s)
        for test in rule[1:]:
            every = every & test.column(s)
        out = F.when(every, k) if out is None else out.when(every, k)
    return F.lit(0) if out is None else out.otherwise(0)


def labelled(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> pd.DataFrame:
    """Statistics of about ``rows`` labelled documents at most, chosen by a hash of their id. The bound holds at any size."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).withColumn("bad", F.col("quality") == 0)
    s = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "bad")), "doc_id").select("doc_id", "bad", statistics(F.col("text")).alias("s"))
    return s.select("doc_id", "bad", "s.*").toPandas().sort_values(["doc_id", *SHARES], ignore_index=True)


def judge(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): the statistics, base_failed, rule (0: none) and kept.

    Null texts count as empty and fail the base rule; repeated rows are judged alike; without labels only the base rule
    rejects. Other columns stay as they are, whatever their names."""
    ship(docs.sparkSession)
    rules = learn(labelled(docs, labels, rows))
    name = free_name(docs, "quality_verdict")
    with_stats = docs.withColumn(name, statistics(F.col("text")))
    s = F.col(name)
    full = F.struct(*[s[c].alias(c) for c in (*BASE, *SHARES)], base_failed(s).alias("base_failed"), verdict(rules, s).alias("rule"),
                    (~base_failed(s) & (verdict(rules, s) == 0)).alias("kept"))
    return with_stats.withColumn(name, full), name


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that are kept, with their own columns only."""
    judged, name = judge(docs, labels, rows)
    return judged.filter(F.col(name)["kept"]).drop(name)
