"""Words of batches that are taken in several slices."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from dailypanel.llm import ctw
from dailypanel.llm.common import slices


def texts(n: int) -> list:
    return [None if k % 97 == 5 else f"Word{k % 53} THE x{k} \n Größe" * (1 + k % 7) for k in range(n)]


def test_lowered_words_of_every_slice():
    want = texts(900)
    batch = pa.RecordBatch.from_arrays([pa.array(want, pa.string())], ["text"])
    at = 0
    for part in slices([batch], "text", 5_000):
        words, starts = ctw.lower_words(part.column("text"))
        found = words.to_pylist()
        assert [found[a:b] for a, b in zip(starts[:-1], starts[1:])] == [(t or "").lower().split() for t in want[at:at + part.num_rows]]
        assert len(set(words.dictionary.to_pylist())) == len(words.dictionary) and np.diff(starts).sum() == len(words)
        at += part.num_rows
    assert at == 900


def test_scores_of_a_batch_of_several_slices(spark):
    """More than two slices of 4 MB in one partition."""
    rows = [(k, t and f"{t} " * 400) for k, t in enumerate(texts(400))]
    assert sum(len(t or "") for _, t in rows) > 9_000_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in ctw.score_documents(docs, depth=1).collect()}
    tokens = {i: (t or "").lower().split() + [" end"] for i, t in rows}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 5 == 1}
    c = Counter(w for i, words in tokens.items() if i not in held for w in words)
    n, v = sum(c.values()), len(c)
    for i, words in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(words), sum(c[w] > 0 for w in words), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), rel_tol=1e-9)
