"""Exact dedup, filter audit and vector codes on awkward rows and empty tables, against plain versions."""

import hashlib
import math
import re
from collections import Counter
from itertools import permutations

import awkward as A
import numpy as np
import pytest
from pyspark.sql import functions as F

from dailypanel.llm import audit, codes, exact
from dailypanel.llm.common import WORD


@pytest.fixture(scope="module")
def docs(spark):
    return A.table(spark).cache()


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def check_copies(rows, out, name):
    groups = {}
    for i, t in rows:
        groups.setdefault(squeezed(t), []).append(i)
    kept = Counter()
    for r in out.collect():
        ids = groups[squeezed(r["text"])]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        assert r[name]["keep_id"] == keep and r[name]["group_size"] == len(ids)
        assert not r[name]["kept"] or r["doc_id"] == keep
        kept[squeezed(r["text"])] += r[name]["kept"]
    assert set(kept) == set(groups) and set(kept.values()) <= {1}


def test_copies_on_awkward_rows(docs):
    out, name = exact.find_copies(docs)
    assert out.columns == [*docs.columns, name] and out.count() == docs.count()
    check_copies([(r["doc_id"], r["text"]) for r in docs.collect()], out, name)
    assert exact.drop_copies(docs).columns == docs.columns


def test_copies_refine_step_by_step(spark, monkeypatch):
    """Equal lengths, then equal prefixes, then full texts; one text holds a third of the rows; all joins also without broadcast."""
    long = "x" * 500
    rows = [(i, "hot  text\n" if i % 2 else "hot text ") for i in range(300)]
    rows += [(1000 + i, f"{i:04d}" + "y" * (i % 7)) for i in range(300)]  # many of one length
    rows += [(2000 + i, long + f"{i // 2:03d}") for i in range(100)]  # one prefix and length, pairs of texts
    rows += [(None, "nobody"), (None, "nobody"), (7000, "again"), (7000, "again")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for bound in (exact.BROADCAST_ROWS, 0):
        monkeypatch.setattr(exact, "BROADCAST_ROWS", bound)
        check_copies(rows, *exact.find_copies(table))
    pairs = exact.repeated_pairs(table.withColumn("__same", exact.one_space(F.col("text"))), 64)
    hashed = exact.with_full_hash(table.withColumn("__same", exact.one_space(F.col("text"))), pairs, 64)
    read = {r["doc_id"] for r in hashed.filter("__full IS NOT NULL").collect()}
    assert set(range(300)) | set(range(2000, 2100)) | {7000} <= read and len(read) < 450  # few texts are read for nothing


def test_a_full_bitmap_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(exact, "MOST_BITS", 1)
    monkeypatch.setattr(exact, "ROW_BITS", 8)
    rows = [(i, f"text {i % 70}") for i in range(100)]
    check_copies(rows, *exact.find_copies(spark.createDataFrame(rows, "doc_id long, text string")))


def plain_audit(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = {}
    for i, t, lang in rows:
        s = t or ""
        w = re.findall(WORD, s)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", s)) > 10 * len(s), "D": bool(re.search(r"[#$%&*|]", s)),
                 "E": i is not None and s in first and i > first[s]}
        parts.setdefault(lang or "", []).append(({k for k, v in fails.items() if v}, i is not None and i in good, i is not None and i in toxic))
    out, sums = {}, Counter()
    for part, found in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = found
            for step, f in enumerate(order, 1):
                stay, gone = [d for d in left if f not in d[0]], [d for d in left if f in d[0]]
                failing = sum(f in d[0] for d in found)
                out[part, order, step] = [len(stay), len(gone), failing - len(gone), sum(d[0] == {f} for d in found), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                sums[part, f] += len(gone)
                left = stay
    return {(p, o, k): (*v, sums[p, o[k - 1]]) for (p, o, k), v in out.items()}


def test_filter_audit_on_awkward_rows(spark):
    rows = [(i, t, (None, "en", "de", "")[k % 4]) for k, (i, t) in enumerate(A.texts())]
    rows += [(100 + i, t, "en") for i, t in enumerate(["ABC DEF " * 60, "ABC DEF " * 60, "a$b", "a$b", None, "Word " * 120])]
    labels = [(1, 1, 0), (1, None, 1), (100, 0, 1), (101, 1, 1), (None, 1, 1), (4, 1, 0), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, fails string, n int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.audit_filters(docs, marks).collect()}
    assert got == plain_audit(rows, labels)


def test_path_counts():
    forward, backward = audit.path_counts(5)
    assert all(f * b == math.factorial(s.bit_count()) * math.factorial(5 - s.bit_count()) for s, (f, b) in enumerate(zip(forward, backward)))
    assert len(audit.lattice(5)) == 80 and sum(n for s, bit, n in audit.lattice(5) if bit == 1) == 120
    assert len(audit.order_steps("ABCDE")) == 600


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows of (vec_id, list of integers): code and error of each, and the codebooks."""
    w = len(rows[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v in rows]
    first = sorted(range(len(rows)), key=lambda k: rows[k])[:entries]
    books = [[list(cut[k][p]) for k in first] for p in range(parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for c in cut:
                mine.setdefault(near(c[p], books[p])[0], []).append(c[p])
            books[p] = [[sum(v) // len(v) for v in zip(*mine[e])] if e in mine else b for e, b in enumerate(books[p])]
    last = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    return ["".join(f"{e:02x}" for e, _ in x) for x in last], [sum(d for _, d in x) for x in last], books


def test_codes_on_awkward_rows(spark):
    r = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in np.float32(r.normal(0, 0.3, 16))], None if i % 5 == 0 else i % 3) for i in range(120)]
    vectors += [(200 + i, vectors[0][1], 1) for i in range(60)]  # many copies
    vectors += [(5, [0.25] * 16, 2), (None, [-0.5] * 16, 0), (300, [0.0] * 16, 0), (301, [-1e-5] * 16, 0)]
    odd = [(400, None, 1), (401, [1.0] * 15 + [None], 1), (402, [math.nan] * 16, 1), (403, [math.inf] + [0.0] * 15, 1), (404, [], 1), (405, [1.0] * 15, 1)]
    table = spark.createDataFrame([(*v, "x", 3) for v in vectors + odd], "vec_id long, embedding array<float>, label int, v string, codes int")
    out, name, books = codes.encode_vectors(table)
    assert out.columns == [*table.columns, name] and name != "codes"
    whole = [(math.inf if i is None else i, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, v, _ in vectors]
    hexes, errors, plain = plain_codes(whole)
    assert books.tolist() == plain
    per = Counter()
    for (_, _, label), e in zip(vectors, errors):
        per[label] += e
    want = Counter((i, h, e, per[label]) for (i, _, label), h, e in zip(vectors, hexes, errors))
    assert Counter((x["vec_id"], x[name]["code"], x[name]["error"], x[name]["label_error"]) for x in out.collect()) == want


def test_codes_of_few_and_of_no_vectors(spark):
    table = spark.createDataFrame([(1, [0.5, 1.0, 7.0], 1), (2, [0.5, 2.0, 1e9], 1)], "vec_id long, embedding array<double>, label int")
    out, name, books = codes.encode_vectors(table)
    assert books.shape == (8, 2, 1) and books[2].tolist() == [[7 * 4096], [codes.LARGEST]]
    assert sorted((r["vec_id"], r[name]["error"]) for r in out.collect()) == [(1, 0), (2, 0)]
    out, name, books = codes.encode_vectors(table.limit(0))
    assert out.count() == 0 and books.shape == (8, 0, 1)


@pytest.mark.parametrize("entries", [1, 16, 64, 65, 200])
def test_box_search_is_exact_for_any_radius(entries):
    r = np.random.default_rng(entries)
    book, x = r.integers(-40, 40, (entries, 3)), r.integers(-60, 60, (500, 3))
    distance = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    slices = codes.Slices(book)
    for radius in (0, 1, 7, 1000):
        got, far = slices.nearest(x, radius)
        assert (got == distance.argmin(axis=1)).all() and (far == distance.min(axis=1)).all()
    masks = slices.candidates(x, np.full(500, 9))
    inside = (np.abs(x[:, None, :] - book[None]) <= 9).all(axis=2)
    bits = np.array([[int(m[e // 64]) >> (e % 64) & 1 for e in range(entries)] for m in masks], bool)
    assert (bits == inside).all()


def test_empty_tables(spark):
    none = A.empty(spark)
    assert exact.find_copies(none)[0].count() == 0 and exact.drop_copies(none).count() == 0
    assert audit.audit_filters(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_codes_reach_the_sum_of_labels_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST_ROWS", 0)
    table = spark.createDataFrame([(i, [float(i)] * 8, None if i % 2 else 1) for i in range(40)], "vec_id long, embedding array<double>, label int")
    out, name, _ = codes.encode_vectors(table)
    rows = out.collect()
    for label in (None, 1):
        assert {r[name]["label_error"] for r in rows if r["label"] == label} == {sum(r[name]["error"] for r in rows if r["label"] == label)}
