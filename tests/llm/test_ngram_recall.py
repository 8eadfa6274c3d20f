"""The n-gram join with repeated ids, chains, and its recall against all pairs of a table."""

import random

import pytest

from dailypanel.llm import components as C
from dailypanel.llm import ngram_join as J
from dailypanel.llm.common import read


def prose(seed, n=120):
    r = random.Random(seed)
    return [f"w{r.randint(0, 3000)}" for _ in range(n)]


def changed(words, at):
    out = list(words)
    out[at] = "changed"
    return " ".join(out)


def test_one_id_with_two_texts(spark):
    a, b = prose(1), prose(2)
    rows = [(1, " ".join(a), "x"), (1, " ".join(b), "y"), (2, changed(a, 60), "x"), (3, changed(b, 60), "x"), (4, " ".join(prose(3)), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted(tuple(r) for r in J.join_ngrams(docs).collect())
    assert got == [(1, 1, 1, 1), (1, 1, 1, 1), (2, 1, 1, 1), (3, 1, 1, 1), (4, 4, 0, 1)]
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(1, rows[0][1]), (1, rows[1][1]), (4, rows[4][1])])


def test_near_texts_of_one_id_are_one_class(spark):
    a = prose(5)
    docs = spark.createDataFrame([(7, " ".join(a)), (7, changed(a, 40)), (8, changed(a, 80))], "doc_id long, text string")
    assert {tuple(r)[1:3] for r in J.join_ngrams(docs).collect()} == {(7, 2)}
    assert [r["doc_id"] for r in J.one_of_each(docs).collect()] == [7]


def test_a_chain_of_rising_ids(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(300, 200), (200, 250)], "a long, b long")
    assert {(r["node"], r["label"]) for r in C.components(edges).collect()} == {(k, 0) for k in range(101)} | {(k, 200) for k in (200, 250, 300)}


def test_planned_size_of_components_does_not_grow_with_the_steps(spark):
    order = random.Random(3).sample(range(200), 200)
    found = C.components(spark.createDataFrame(list(zip(order, order[1:])), "a long, b long"))
    assert {(r["node"], r["label"]) for r in found.collect()} == {(k, 0) for k in range(200)}
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2 ** 40


@pytest.mark.parametrize("block", [J.BLOCK, 7])
def test_recall_against_all_pairs(spark, small, block):
    docs = read(spark, small, "documents")
    texts = {(r["doc_id"]): r["text"] or "" for r in docs.collect()}
    links = dict.fromkeys(set(texts.values()), 0)
    distinct = list(links)
    of = {t: frozenset(tuple(t.split()[k:k + 5]) for k in range(max(1, len(t.split()) - 4))) if t.split() else frozenset() for t in distinct}
    holds = {}
    for k, t in enumerate(distinct):
        for g in of[t]:
            holds.setdefault(g, []).append(k)
    both = {}
    for ks in holds.values():
        for x, i in enumerate(ks):
            for j in ks[x + 1:]:
                both[i, j] = both.get((i, j), 0) + 1
    for (i, j), n in both.items():
        if n >= 0.8 * (len(of[distinct[i]]) + len(of[distinct[j]]) - n) - 1e-9:
            links[distinct[i]] += 1
            links[distinct[j]] += 1
    want = sum(links.values())
    found = {r["doc_id"]: r["n_links"] for r in J.join_ngrams(docs, block=block).collect()}
    assert all(found[i] <= links[t] for i, t in texts.items())
    got = sum(dict((t, found[i]) for i, t in texts.items()).values())
    assert want > 0 and got >= 0.99 * want
