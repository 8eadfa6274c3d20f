"""License scans: template markup compiled into token automata.

A template is wording with two kinds of markup: ``<<beginOptional>>...<<endOptional>>`` may be missing, and ``<<var;name=...;most=n>>``
stands for up to n words of any kind. It becomes a nondeterministic automaton over words. A text matches where the automaton, started
at a word, accepts: all mandatory wording is there, in order and exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import free_name, ship, whole

#: Phrases that name a license by themselves.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public wording of notices and licenses, by label.
TEMPLATES = {
    "mit-license": "released under <<beginOptional>>the terms of <<endOptional>>the <<beginOptional>>expat <<endOptional>>mit license",
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
        <<beginOptional>>the software <<endOptional>>to deal in the software without restriction including without limitation the rights to use copy modify merge publish
        distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following
        conditions the above copyright notice and this permission notice <<beginOptional>>including the next paragraph <<endOptional>>shall be included in all copies or
        substantial portions of the software""",
    "mit-warranty": """the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
        fitness for a particular purpose and noninfringement""",
    "isc-text": """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above
        copyright notice and this permission notice appear in all copies""",
    "bsd-text": """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
        <<beginOptional>>1 <<endOptional>>redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
        <<beginOptional>>2 <<endOptional>>redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
        in the documentation and or other materials provided with the distribution""",
    "bsd-warranty": "this software is provided by <<var;name=holder;most=16>> as is and any express or implied warranties including but not limited to the implied warranties",
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-header": """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may
        obtain a copy of the license at <<beginOptional>>http <<endOptional>><<beginOptional>>https <<endOptional>><<beginOptional>>www <<endOptional>>apache org licenses license 2 0
        <<beginOptional>>html <<endOptional>>unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is
        basis without warranties or conditions of any kind either express or implied""",
    "gpl-notice": """licensed under the <<beginOptional>>terms of the <<endOptional>>gnu <<beginOptional>>lesser <<endOptional>><<beginOptional>>affero <<endOptional>>general
        public license <<beginOptional>>as published by the free software foundation either <<endOptional>>version <<var;name=version;most=1>>""",
    "gpl-header": """this program is free software you can redistribute it and or modify it under the terms of the gnu <<beginOptional>>lesser <<endOptional>>
        <<beginOptional>>affero <<endOptional>>general public license as published by the free software foundation either version <<var;name=version;most=2>> of the license
        or at your option any later version""",
    "gpl-warranty": """this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of
        merchantability or fitness for a particular purpose""",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc": """licensed under <<beginOptional>>a <<endOptional>><<beginOptional>>the <<endOptional>>creative commons <<var;name=terms;most=6>> license""",
    "cc-by": "licensed under cc by <<beginOptional>>nc <<endOptional>><<beginOptional>>nd <<endOptional>><<beginOptional>>sa <<endOptional>><<var;name=major;most=1>> 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "spdx-id": "spdx license identifier <<var;name=id;most=4>>",
    "all-rights-reserved": "all rights reserved",
    "copyright-notice": "copyright <<beginOptional>>c <<endOptional>><<beginOptional>>© <<endOptional>><<var;name=years;most=3>> <<var;name=holder;most=8>> all rights reserved",
}

#: Everything but digits, letters and what isn't ASCII separates words; A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MARKUP = re.compile(r"<<(.*?)>>", re.S)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass
class Automaton:
    """States 0..n with word and any-word steps; ``skips`` are steps without a word. State n accepts."""

    label: str
    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    anything: list[int | None] = field(default_factory=lambda: [None])
    skips: list[set[int]] = field(default_factory=lambda: [set()])
    #: Mandatory words passed on the way to each state.
    depth: list[int] = field(default_factory=lambda: [0])
    start: bytes = b""

    def state(self, depth: int) -> int:
        self.words.append({})
        self.anything.append(None)
        self.skips.append(set())
        self.depth.append(depth)
        return len(self.words) - 1

    def close(self, states: set[int]) -> frozenset[int]:
        """With all states that steps without a word reach."""
        todo, out = list(states), set(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return frozenset(out)

    def run(self, words: list[bytes], at: int) -> tuple[int | None, int]:
        """The end of the longest match that begins at word ``at``, if any, and the mandatory words that any run has passed."""
        now, end, far, last = self.close({0}), None, 0, len(self.words) - 1
        while now:
            if last in now:
                end = at
            far = max(far, max(self.depth[s] for s in now))
            if at == len(words):
                break
            w, new = words[at], set()
            for s in now:
                if (t := self.words[s].get(w)) is not None:
                    new.add(t)
                if (t := self.anything[s]) is not None:
                    new.add(t)
            now, at = self.close(new), at + 1
        return end, far


def compile_template(label: str, template: str) -> Automaton:
    a, here, depth, optional, first, started = Automaton(label), 0, 0, [], [], True
    for k, piece in enumerate(_MARKUP.split(template)):
        if k % 2 == 0:
            for w in words_of(piece):
                depth += not optional
                new = a.state(depth)
                a.words[here][w] = new
                here = new
                if started and not optional:
                    first.append(w)
        elif piece == "beginOptional":
            started = False
            optional.append(here)
        elif piece == "endOptional":
            a.skips[optional.pop()].add(here)
            new = a.state(depth)  # so that what follows is not mixed up with what was skipped
            a.skips[here].add(new)
            here = new
        else:
            started = False
            fields = dict(f.split("=") for f in piece.split(";")[1:])
            new, low, end = here, int(fields.get("least", 1)), None
            ends = []
            for n in range(int(fields["most"]) + 1):
                if n >= low:
                    ends.append(new)
                if n < int(fields["most"]):
                    step = a.state(depth)
                    a.anything[new] = step
                    new = step
            end = a.state(depth)
            for e in ends:
                a.skips[e].add(end)
            here = end
    final = a.state(depth)
    a.skips[here].add(final)
    a.start = b" " + b" ".join(first) + b" "
    if not first:
        raise ValueError(f"template {label} must begin with mandatory wording")
    return a


@lru_cache(maxsize=4)
def compiled(templates: tuple) -> list[Automaton]:
    return [compile_template(k, t) for k, t in templates]


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which ``phrase`` (words with a space on either side) stands in words joined by and put between spaces."""
    out, at, counted, n = [], joined.find(phrase), 0, 0
    while at >= 0:
        n += joined.count(b" ", counted, at)
        counted = at
        out.append(n)
        at = joined.find(phrase, at + 1)
    return out


def scan(text: str | None, automata: list[Automaton], base: dict[str, str]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score. The score is 1 if a template accepts, else the largest share of a
    template's mandatory words that a run of its automaton passes, and one half at least where a base phrase stands."""
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    found: list[int] = []
    names = set()
    for phrase, label in base.items():
        if at := places(joined, f" {phrase} ".encode()):
            names.add(label)
            found += at
    labels, score = set(names), 0.5 if names else 0.0
    for a in automata:
        if a.start in joined:
            for at in places(joined, a.start):
                end, far = a.run(words, at)
                if end is not None:
                    labels.add(a.label)
                    score = 1.0
                    break
                score = max(score, far / a.depth[-1])
    return len(words), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(names)), ",".join(sorted(labels)), score


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_column(text: Column, templates: dict[str, str] | None = None, base: dict[str, str] | None = None) -> Column:
    given, phrases = tuple((TEMPLATES if templates is None else templates).items()), BASE if base is None else base

    @F.pandas_udf(SCHEMA)
    def of(texts: pd.Series) -> pd.DataFrame:
        automata = compiled(given)
        out = pd.DataFrame([scan(t, automata, phrases) for t in texts], columns=[c.split()[0] for c in SCHEMA.split(", ")])
        return out.astype({"first_word": "Int64", "last_word": "Int64", "base_labels": object, "labels": object})

    return of.asNondeterministic()(text)


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None, base: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned) of SCHEMA's fields.

    Null texts count as empty: no words, no labels, score 0. Other columns stay as they are; repeated rows are scanned alike."""
    ship(docs.sparkSession)
    name = free_name(docs, "license")
    return docs.withColumn(name, scan_column(whole(F.col("text")), templates, base)), name
