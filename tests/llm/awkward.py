"""Tables that every operator has to get through: nulls, empty and very long texts, repeated rows, ties, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size int, kept int, ids string, s string, __id int, lines array<int>"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(("an", "er", "th", "ing", "on", "re")) for _ in range(r.randint(1, 4))) for _ in range(words))


def texts() -> list:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    lines = "\n".join(prose(k, 6) for k in range(12))
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "one"), (8, prose(2, 40_000)),
        (9, "Released under the MIT License.\n" + prose(3, 60)), (10, lines), (11, "new first line\n" + lines), (12, "the " * 200),
        (13, "é è  ß 日本語 \x0b x\ry\x85z w"), (None, base), (None, prose(4, 30)), (14, prose(5, 50)), (14, prose(5, 50)), (15, "a\n\n\nb\n"),
        (16, "word " * 34 + "end"), (17, "# $ % & | < > *" * 30), (18, prose(6, 35)), (19, prose(6, 36)),
    ]


def table(spark):
    rows = [(i, t, "en", None if k % 5 == 4 else f"src{k % 3}", None if t is None else len(t), "x", 1, None, "y", None, 2, [3]) for k, (i, t) in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
