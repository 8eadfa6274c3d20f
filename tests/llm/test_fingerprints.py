"""Fingerprints and likeness against a plain version that hashes as Spark does."""

import re
import struct
from collections import Counter

import awkward as A
import pytest
import xxhash

from dailypanel.llm import fingerprints as P

MASK = 0xFFFFFFFF


def signed(x, bits=64):
    return x - (1 << bits) if x >> (bits - 1) else x


def word_hash(word):
    return signed(xxhash.xxh64_intdigest(word.encode(), 42))


def murmur(values, seed=42):
    h = seed
    for v in values:
        for word in struct.unpack("<II", struct.pack("<q", v)):
            k = word * 0xCC9E2D51 & MASK
            k = ((k << 15 | k >> 17) & MASK) * 0x1B873593 & MASK
            h = ((h ^ k) << 13 | (h ^ k) >> 19) & MASK
            h = h * 5 + 0xE6546B64 & MASK
        h ^= 8
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ h >> shift) * factor & MASK
        h ^= h >> 16
    return h


def terms(text):
    return {word_hash(w) for w in re.split(r"[\x20\x09-\x0d]+", (text or "").lower()) if w}


def plain(texts, least, most):
    """A function from a text to its parts, with the lexicon of ``texts``."""
    df, n = Counter(t for x in texts for t in terms(x)), len(texts)
    band = {t for t, c in df.items() if max(2.0, least * n) <= c <= max(2.0, most * n)}

    def parts(text):
        own = terms(text) & band
        chosen = sorted(own if len(own) >= P.FEW else terms(text))
        whole, out = murmur(chosen), []
        for rate, shift in zip(P.RATES, P.SHIFTS):
            for k in range(P.EACH):
                inside = [t for t in chosen if t >> shift & rate - 1 == k]
                out.append((murmur(inside) & 0x3FFF) + 1 if inside else P.NOTHING)
        return [whole >> 16, whole & 0xFFFF, *out]

    return parts


def like(a, b):
    if a == b:
        return 1.0
    either = [(x, y) for x, y in zip(a[2:], b[2:]) if x or y]
    return sum(x == y for x, y in either) / len(either) if either else 0.0


def test_every_part_and_likeness(spark):
    docs = A.table(spark)
    rows = [(i, t or "") for i, t in A.texts() if i is not None] + [(None, t or "") for i, t in A.texts() if i is None]
    parts = plain([t for _, t in rows], 0.05, 0.6)
    ids = sorted({i for i, _ in rows if i is not None}, reverse=True)
    shown = lambda p: "".join(f"{x:04x}" for x in p)
    got = P.fingerprint_edits(docs, least=0.05, most=0.6).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, t in rows:
        after = ids[(ids.index(i) + 1) % len(ids)] if i is not None and i != ids[-1] else None if i is not None else ids[0]
        follow = [u for j, u in rows if j == after]
        follow = min(follow, key=lambda u: signed(xxhash.xxh64_intdigest(u.encode(), 42)))
        half = len(t) // 2
        edited = t[:len(t) - half] + follow[:half]
        want[i, len(t), shown(parts(t)), shown(parts(edited)), round(like(parts(t), parts(edited)), 9), round(like(parts(t), parts(follow)), 9)] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == want


@pytest.mark.parametrize("n", [4, 30, 300])
def test_a_changed_term_leaves_most_parts(spark, n):
    words = [f"w{k}" for k in range(n)]
    rows = [(0, " ".join(words)), (1, " ".join(words[1:] + ["other"])), (2, "something else entirely"), (3, "x")]
    parts = plain([t for _, t in rows], 0.002, 1.0)
    assert like(parts(rows[0][1]), parts(rows[1][1])) > 0.3 and like(parts(rows[0][1]), parts(rows[2][1])) == 0


def test_many_rows_without_an_id_and_a_repeated_id(spark):
    rows = [(None, f"lost text number {k}") for k in range(40)] + [(1, f"same id {k}") for k in range(40)] + [(2, "the last")]
    got = P.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r["doc_id"] for r in got) == {None: 40, 1: 40, 2: 1}
