"""Every operator on awkward rows and on empty tables, against plain versions."""

import hashlib
import re
import zlib
from collections import Counter
from math import log10

import awkward as A
import pytest
from pyspark.sql import functions as F

from dailypanel.llm import ctw, fingerprints, fm_index, licenses, lines, mixing, ngram_join, page_text, pieces, rules
from dailypanel.llm.queries import model_path


@pytest.fixture(scope="module")
def docs(spark):
    return A.table(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return A.empty(spark)


def labels(spark, rows=((1, 1, 0), (17, 0, 0), (None, 0, 0), (3, None, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def keyed(df):
    return [((r["doc_id"], r["text"]), r) for r in df.collect()]


def words(text):
    return (text or "").encode().split()


def test_every_operator_takes_empty_tables(spark, none):
    assert rules.keep_good(none, labels(spark)).count() == 0
    assert lines.dedup_lines(none)[0].count() == 0
    assert ngram_join.join_ngrams(none).count() == 0 and ngram_join.one_of_each(none).count() == 0
    assert mixing.mix(none)[0].count() == 0 and mixing.mixed(none).count() == 0
    assert pieces.encode_documents(none, model_path())[0].count() == 0
    assert fingerprints.fingerprint_edits(none).count() == 0
    assert licenses.scan_documents(none)[0].count() == 0
    assert ctw.score_documents(none).count() == 0
    assert fm_index.dedup_substrings(none).count() == 0
    assert page_text.extract_pages(spark.createDataFrame([], "page_id long, html string, text string"))[0].count() == 0


def test_quality_statistics(docs, spark):
    out, name = rules.judge(docs, labels(spark))
    assert out.columns[:-1] == docs.columns and out.count() == docs.count()
    for (_, text), r in keyed(out):
        w, t, s = words(text), text or "", r[name]
        windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
        full = [x for x in t.split("\n") if x.strip(rules.SPACES)]
        assert s["n_words"] == len(w) and s["word_chars"] == sum(len(x.decode()) for x in w)
        assert s["n_symbols"] == sum(t.count(c) for c in rules.SYMBOLS)
        assert s["n_dup_lines"] == sum(x in full[:k] for k, x in enumerate(full)) and s["n_repeat_words"] == len(covered)
        assert s["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (s["base_failed"] and s["kept"])


def test_line_dedup(docs):
    out, name = lines.dedup_lines(docs)
    assert out.columns == [*docs.columns, name]

    def chunks(text):
        all_lines = (text or "").split("\n")
        h = [0] + [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in all_lines]
        r = [(b + lines.FACTOR * a) % lines.MODULUS for a, b in zip(h, h[1:])]
        ends = [i + 1 for i in range(1, len(r) - 2) if r[i - 1] > r[i] <= r[i + 1]] + [len(r)]
        return [all_lines[a:b] for a, b in zip([0] + ends, ends)]

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    first = {}
    many = lambda c: len(c) >= 2 and re.search(r"[^\x20\x09-\x0d]", "\n".join(c))
    for i, t in rows:
        for pos, c in enumerate(chunks(t)):
            if many(c):
                place = (i if i is not None else 2**63, pos)
                first["\n".join(c)] = min(place, first.get("\n".join(c), place))
    want = Counter()
    for i, t in rows:
        left = [c for pos, c in enumerate(chunks(t)) if not many(c) or first["\n".join(c)] == (i if i is not None else 2**63, pos)]
        want[i, "\n".join("\n".join(c) for c in left)] += 1
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want
    assert any(r[name]["n_removed"] for r in out.collect())


def test_most_of_repeated_runs_goes_and_every_line_stays_once(spark):
    """Runs of 4 to 12 lines that many texts share: of their lines in later texts 0.64 go; no line is lost, and a line added before moves little."""
    import random

    rng = random.Random(4)
    runs = [[f"shared {k} {rng.random()}" for _ in range(rng.randint(4, 12))] for k in range(40)]
    texts, shared = [], 0
    for d in range(400):
        run, own = rng.choice(runs), [f"own {rng.random()}" for _ in range(rng.randint(2, 9))]
        at = rng.randint(0, len(own))
        texts.append(own[:at] + run + own[at:])
        shared += len(run)
    first = sum(len(run) for run in runs if any(run[0] in t for t in texts))
    table = spark.createDataFrame([(d, "\n".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    out, name = lines.dedup_lines(table)
    rows = out.collect()
    assert sum(r[name]["n_removed"] for r in rows) >= 0.6 * (shared - first)
    assert {x for r in rows for x in r["text"].split("\n")} >= {x for t in texts for x in t}
    assert all(sorted(x for x in r["text"].split("\n") if x[:3] == "own") == sorted(x for x in texts[r["doc_id"]] if x[:3] == "own") for r in rows)
    many = table.withColumn("text", F.concat(F.lit("one more\n"), F.lit("and one\n"), "text"))
    cut = [{r["doc_id"]: r["__chunks"] for r in lines.with_chunks(t).collect()} for t in (table, many)]
    moved = [len(set(a) - set(cut[1][d])) for d, a in cut[0].items()]
    assert max(moved) <= 2


def test_pieces_round_trip(docs):
    out, name = pieces.encode_documents(docs, model_path())
    p = pieces.load(model_path())
    for (_, text), r in keyed(out):
        assert r[name]["round_trip"]
        if len(text or "") < 2000:
            assert r[name]["ids"] == pieces.encode_stream(p, text or "")
    again = out.select(pieces.decode(out[name]["ids"], pieces.broadcast_pieces(docs.sparkSession, model_path())).alias("t"), "text")
    assert all(r["t"] == (r["text"] or "") for r in again.collect())


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_finds_the_best_path(seed):
    import random

    import pyarrow as pa

    r = random.Random(seed)
    made = sorted({pieces.SPACE, *"abc", *("".join(r.choice("abc" + pieces.SPACE if k == 0 else "abc") for k in range(r.randint(1, 5))) for _ in range(25))})
    p = pieces.Pieces(made, [float(-r.randint(1, 30)) for _ in made], ["normal"] * len(made))
    for _ in range(40):
        text = "".join(r.choice("abc  ") for _ in range(r.randint(0, 60)))
        full = pieces.SPACE + text.replace(" ", pieces.SPACE)
        best = [0.0] + [-1e18] * len(full)
        for e in range(1, len(full) + 1):
            for s in range(max(0, e - p.longest), e):
                if full[s:e] in p.ids:
                    best[e] = max(best[e], best[s] + p.score[p.ids[full[s:e]]])
        ids = pieces.encode_stream(p, text)
        assert not text or sum(p.score[i] for i in ids) == pytest.approx(best[-1])
        assert "".join(p.pieces[i] for i in ids) == (full if text else "")
        assert pieces.encode_batch(p, pa.array([text])).to_pylist()[0] == ids


def test_streaming_window_stays_small():
    p = pieces.load(model_path())
    reader, most = pieces.StreamingViterbi(p), 0
    for _ in range(300):
        reader.feed("thingandtheother")
        most = max(most, len(reader.text))
    assert most < 8 * p.longest


def test_ngram_join(docs):
    got = ngram_join.join_ngrams(docs, block=2)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    sets = {}
    for _, t in rows:
        w = words(t)
        sets[t] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    linked = {t: {u for u in sets if u != t and sets[t] and sets[u] and len(sets[t] & sets[u]) >= 0.8 * len(sets[t] | sets[u])} for t in sets}
    label = dict.fromkeys(sets)
    for t in sets:
        todo, seen = [t], {t}
        while todo:
            for u in linked[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        label[t] = min((i for i, u in rows if u in seen and i is not None), default=None)
    want = Counter((i, label[t], len(linked[t]), sum(u == t for _, u in rows)) for i, t in rows)
    have = Counter((r["doc_id"], r["class_id"] if r["class_id"] < 2**62 else None, r["n_links"], r["n_copies"]) for r in got.collect())
    assert have == want and any(r[2] for r in have)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label.values()) - {None}) + sum(v is None for v in label.values())


def test_hot_group_of_near_copies_in_blocks(spark):
    import random

    r = random.Random(3)
    base = A.prose(9, 200).split()
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"x{k}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = {r["doc_id"]: r["n_links"] for r in ngram_join.join_ngrams(df, block=16).collect()}
    b = {r["doc_id"]: r["n_links"] for r in ngram_join.join_ngrams(df).collect()}
    sets = {t: {tuple(t.split()[i:i + 5]) for i in range(196)} for _, t in rows}
    want = {i: sum(u != t and len(sets[t] & sets[u]) >= 0.8 * len(sets[t] | sets[u]) for u in sets) for i, t in rows}
    assert a == b == want


def test_mixing(docs):
    out, name = mixing.mix(docs)
    rows = out.collect()
    sizes = Counter()
    for r in rows:
        assert r[name]["size"] == len(words(r["text"])) and r[name]["taken"] <= 3 * r[name]["size"]
        sizes[r["source"]] += r[name]["size"]
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, total = {}, set(order), float(sum(sizes.values()))
    while True:  # targets stop at three times the size, the rest is shared anew
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= over
    for s in order:
        own = [r for r in rows if r["source"] == s]
        assert own[0][name]["target"] == pytest.approx(target[s]) and own[0][name]["source_size"] == sizes[s]
        assert abs(sum(r[name]["taken"] for r in own) - target[s]) <= len(own)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3))[0].collect()))
    made = mixing.mixed(docs)
    assert made.columns == docs.columns
    assert sum(len(words(r["text"])) for r in made.collect()) == sum(r[name]["taken"] for r in rows)


@pytest.mark.parametrize("weight", [1e-6, 0.05, 0.2, 1.0, 1e4])
def test_key_ranges_are_small_at_any_weight(spark, weight):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    ids = ids.union(spark.range(20_000).select(F.lit(None).cast("long"), F.concat(F.lit("b"), F.col("id").cast("string"))))
    at = mixing.with_keys(ids, "s", F.lit(weight)).select("doc_id", "__at.*").toPandas()
    assert at.groupby("b1").size().max() < 0.006 * len(at) and at.groupby(["b1", "b2"]).size().max() <= 3
    by_key = at.sort_values("key")
    assert by_key[["b1", "b2"]].apply(tuple, axis=1).is_monotonic_increasing


def test_license_scan(docs):
    out, name = licenses.scan_documents(docs)
    for (_, text), r in keyed(out):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        s = r[name]
        assert (s["n_words"], s["n_base"]) == (len(w), len(found))
        assert (s["first_word"], s["last_word"]) == (min((i for i, _ in found), default=None), max((i for i, _ in found), default=None))
        assert s["base_labels"] == ",".join(sorted({x for _, x in found})) and set(filter(None, s["base_labels"].split(","))) <= set(s["labels"].split(","))


@pytest.mark.parametrize("text,label", [
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"), ("This is licensed under the terms of the GNU Lesser General Public License, version 2.1", "gpl-notice"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc-by"), ("Permission is hereby granted, free of charge", None), ("SPDX-License-Identifier: MIT", "spdx-id"), ("All rights are reserved", None)])
def test_templates(text, label):
    got = licenses.scan(text, licenses.compiled(tuple(licenses.TEMPLATES.items())), licenses.BASE)
    assert (label in got[5].split(",")) if label else got[6] < 1


def test_scores(docs):
    rows = docs.collect()
    counts = Counter()
    token = lambda t: [*(w.lower() for w in words(t)), None]
    outside = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    for r in rows:
        if not outside(r["doc_id"]):
            counts.update(token(r["text"]))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(r["doc_id"]), outside(r["doc_id"]), len(t := token(r["text"])), sum(counts[x] > 0 for x in t), round(sum(log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), 4)) for r in rows)
    for head in (1, 500_000):  # most tokens joined, or all looked up
        got = ctw.score_documents(docs, head=head).collect()
        assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == want
        assert all(r["train_tokens"] == n and r["score"] < 0 for r in got)


def test_tree_is_context_tree_weighting():
    """The tree's predictions against the weighted probability written out by recursion."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    text, depth = b"abracadabra abracadabra", 2
    grams, n = ctw.gram_counts(*ctw.padded(pa.array([text]), depth), depth)
    frames = []
    for d in range(depth + 1):
        frames.append(pd.DataFrame({"ctx": (grams >> 8) & ((1 << 8 * d) - 1), "next": grams & 255, "n": n}).groupby(["ctx", "next"], as_index=False).sum())
    tree = ctw.Tree(frames)
    table = [{c: f[f.ctx == c].set_index("next").n for c in f.ctx.unique()} for f in frames]

    def bit(counts, prefix, b):  # zeros and ones at a decision
        z = [sum(k for x, k in counts.items() if x >> (7 - b) == (prefix << 1) + y) for y in (0, 1)]
        return np.array(z, float)

    def weighted(d, c, prefix, b):
        own = ctw.log_kt(bit(table[d][c], prefix, b))
        kids = [k for k in table[d + 1] if k & ((1 << 8 * d) - 1) == c] if d < depth else []
        return np.logaddexp(own, sum(weighted(d + 1, k, prefix, b) for k in kids)) - np.log(2) if kids else own

    def predict(d, path, prefix, b, y):
        c = path[d]
        z = bit(table[d][c], prefix, b)
        kt = (z[y] + 0.5) / (z.sum() + 1)
        kids = [k for k in table[d + 1] if k & ((1 << 8 * d) - 1) == c] if d < depth else []
        if not kids:
            return kt
        w = np.exp(ctw.log_kt(z) - np.log(2) - weighted(d, c, prefix, b))
        below = predict(d + 1, path, prefix, b, y) if d + 1 <= depth and path[d + 1] in table[d + 1] else 0.5
        return w * kt + (1 - w) * below

    full = bytes([255] * depth) + text + bytes([255])
    total = 0.0
    for at in range(depth, len(full)):
        path = [int.from_bytes(full[at - d:at], "big") for d in range(depth + 1)]
        for b in range(8):
            y = full[at] >> (7 - b) & 1
            total += log10(predict(0, path, full[at] >> (8 - b), b, y))
    assert tree.score(*ctw.padded(pa.array([text]), depth))[0] == pytest.approx(total, rel=1e-5)
    assert np.allclose((10.0 ** tree.log10.astype(float)).sum(1), 1, atol=1e-4)


def test_every_context_is_kept(docs, spark, small):
    """Scores against the tree of all contexts made in one process, with frequent grams broadcast and rare ones joined."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    for rows in (spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text"), docs):
        local = [(r["doc_id"], (r["text"] or "").encode()) for r in rows.collect()]
        held = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 5 == 1
        grams, n = ctw.gram_counts(*ctw.padded(pa.array([t for i, t in local if not held(i)]), ctw.DEPTH), ctw.DEPTH)
        frames = []
        for d in range(ctw.DEPTH + 1):
            frames.append(pd.DataFrame({"ctx": (grams >> 8) & ((1 << 8 * d) - 1), "next": grams & 255, "n": n}).groupby(["ctx", "next"], as_index=False).sum())
        want = sorted(zip([i if i is not None else -1 for i, _ in local], ctw.Tree(frames).score(*ctw.padded(pa.array([t for _, t in local]), ctw.DEPTH))))
        for grams_sent in (ctw.GRAMS, 1000, 0):
            got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["score"]) for r in ctw.score_documents(rows, grams=max(1, grams_sent)).collect())
            assert [i for i, _ in got] == [i for i, _ in want]
            assert np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-5, atol=1e-4)


def test_substrings(docs):
    for options in ({}, {"hot": 1, "shard_words": 300}):
        got = fm_index.dedup_substrings(docs, **options)
        rows = [(r["doc_id"], words(r["text"])) for r in docs.collect()]
        seen = Counter(tuple(w[i:i + 35]) for _, w in rows for i in range(len(w) - 34))
        want = Counter()
        for i, w in rows:
            gone = {p + k for p in range(len(w) - 34) if seen[tuple(w[p:p + 35])] > 1 for k in range(35)}
            want[i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()] += 1
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()) == want


@pytest.mark.parametrize("seed", range(30))
def test_fm_index_windows(seed):
    import random

    import numpy as np

    r = random.Random(seed)
    window, letters = r.choice([3, 5, 8]), r.choice([2, 4, 30])
    base = [r.randint(1, letters) for _ in range(40)]
    made = []
    for _ in range(r.choice([1, 3, 10, 30])):
        at = r.randrange(30)
        p = base[at:at + r.randint(window, window + 12)] + [r.randint(1, letters) for _ in range(r.randrange(6))]
        p = [x if r.random() > 0.05 else r.randint(1, letters) for x in p]
        made.append(np.array(p + [1] * max(0, window - len(p))))
    times = Counter(tuple(p[i:i + window]) for p in made for i in range(len(p) - window + 1))
    asked = np.array([r.random() < 0.8 for _ in made])
    for p, mask, a in zip(made, fm_index.repeated_windows(made, asked, window), asked):
        assert int(mask) == (sum(1 << i for i in range(len(p) - window + 1) if times[tuple(p[i:i + window])] > 1) if a else 0)


def test_fingerprints(docs):
    got = fingerprints.fingerprint_edits(docs, least=0.05, most=0.6)
    assert got.count() == docs.count()
    rows = sorted(((r["doc_id"] if r["doc_id"] is not None else -(2**63), r["text"] or "") for r in docs.collect()), key=lambda x: -x[0])
    ids = sorted({i for i, _ in rows}, reverse=True)
    same = {}
    for r in got.collect():
        k = r["doc_id"] if r["doc_id"] is not None else -(2**63)
        follow = ids[(ids.index(k) + 1) % len(ids)]
        edits = set()
        for i, t in rows:
            for j, u in rows:
                if i == k and j == follow and len(t) == r["n_chars"]:
                    edits.add(hashlib.sha256((t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode()).hexdigest())
        assert r["edited_sha256"] in edits and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        same.setdefault((k if k in (1, 2) else None, r["n_chars"]), set()).add(r["fingerprint"])
    prints = {r["doc_id"]: r["fingerprint"] for r in got.collect()}
    assert prints[1] == prints[2] != prints[14]


def test_next_lower_ids(spark):
    ids = [5, 4097, -3, 2**40, 2**62, -(2**63), 4096, 6]
    got = {r["k"]: r["next"] for r in fingerprints.next_lower(spark.createDataFrame([(i,) for i in ids], "k long")).collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: b for a, b in zip(order, order[1:] + order[:1])}


PAGE = """<html><body><div class="cookie-notice">We use cookies. Accept them now, please.</div><nav><ul><li><a href=x>One</a></ul></nav>
<div class=sidebar><p>A long teaser about many things that happen. Really long.</p></div>
<div class="post"><h1>Title &eacute;</h1><p>First   paragraph is long, with many words. It goes on.<p>Short &amp; sweet.<br>Next line.
<form><label>Name</label><input></form><script>var a = "<p>no</p>";</script><ul><li>point one<li>point two</ul>
<div class="comments"><p>I think this is a very good long article. Thank you so much.</p></div></div><footer>&copy; Firm. All rights reserved.</footer>"""
TEXT = "Title é\nFirst paragraph is long, with many words. It goes on.\nShort & sweet. Next line.\npoint one\npoint two"


def test_page_text(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    model = page_text.train(pages)
    assert model.extract(PAGE) == TEXT
    assert [model.extract(x) for x in (None, "", "<", "<p>", "<!-- only")] == [""] * 5
    rows = spark.createDataFrame([(1, PAGE, "t"), (1, PAGE, "t"), (2, None, None), (3, "<div>" * 3000 + "deep text, as deep as it gets.", "t")], "page_id long, html string, text string")
    out, name = page_text.extract_pages(rows, model)
    assert name != "text" and [r[name] for r in out.orderBy("page_id").collect()][:3] == [TEXT, TEXT, ""]


def test_pages_that_name_their_article(spark, small):
    import html

    pages = spark.read.parquet(f"{small}/pages.parquet")
    out, name = page_text.extract_pages(pages)
    for r in out.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in re.split(r"</?p>|</?h1>", inner)]
        assert r[name] == "\n".join(b for b in blocks if b)


def test_rules_learn_and_spare_the_good(spark, small):
    docs, known = spark.read.parquet(f"{small[:-5]}0.01/documents.parquet"), spark.read.parquet(f"{small[:-5]}0.01/labels.parquet")
    out, name = rules.judge(docs, known)
    rows = out.join(known, "doc_id").select("quality", out[name]["kept"].alias("kept")).collect()
    bad, good = [r for r in rows if r["quality"] == 0], [r for r in rows if r["quality"] == 1]
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad) and sum(r["kept"] for r in good) >= 0.95 * len(good)
