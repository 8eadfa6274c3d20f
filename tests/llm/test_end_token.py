"""The end of a text is a token that no word equals."""

import math
from collections import Counter

from dailypanel.llm import ctw


def test_a_word_that_looks_like_an_end(spark):
    rows = [(2, "a \x00end b"), (3, "a b c"), (4, " end end")]
    rows = [(i, t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in ctw.score_documents(docs).collect()}
    held = {i for i, r in got.items() if r["held_out"]}
    counts = Counter(w for i, t in rows if i not in held for w in [*t.lower().split(" "), " end"] if w)
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        tokens = [*filter(None, t.split(" ")), " end"]
        assert got[i]["n_tokens"] == len(tokens) and got[i]["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert math.isclose(got[i]["base_score"], sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens), rel_tol=1e-9)
