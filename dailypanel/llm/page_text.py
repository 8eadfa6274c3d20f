"""Main text of web pages by a tree-structured graphical model.

A page's block elements are the nodes of a tree; each is content or not. A node has potentials of its own from what it is and how
its text looks, and one with its parent. Sum-product messages up and down the tree give every node's marginal. The numbers are
counts over a bounded sample of pages that label themselves (their markup names the article), mixed with prior tables, so that markup the
sample lacks still counts for something.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from math import exp, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import free_name, ship, whole

#: Pages that teach the model, at most about.
SAMPLE_PAGES = 2_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video head title select option optgroup datalist textarea button".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption label".split())
#: A start tag of the key's elements closes an open element of these, unless one of the fences stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "thead": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
          "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"})}
SCOPE = frozenset("table td th caption button object html".split())

TOKEN = re.compile(r"<!--(.*?)(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDES = re.compile(r"""(?:^|[\s"'/])hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
SPACES = re.compile(r"\s+")

#: Words of class, id and role names that say what an element is for.
CUES = {
    "comment": "comment comments commentlist commentform disqus reply replies reactions",
    "ad": "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsors sponsored promo promos promotion affiliate taboola outbrain",
    "notice": "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription paywall toast disclaimer",
    "menu": "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar tabs skip skiplink sitemap toc",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular complementary",
    "share": "share sharing social follow",
    "form": "form login signin signup search searchform",
    "foot": "footer foot colophon copyright legal contentinfo",
    "head": "masthead header topbar banner logo",
    "main": "article main content post entry story articlebody",
}
CUE_OF = {word: cue for cue, words in CUES.items() for word in words.split()}
#: Words that a name may hold beside those without saying something else: "left-sidebar-2" is a sidebar, "has-sidebar" and "related-work" are not.
BESIDE = frozenset("site page left right top bottom primary secondary global js section box module block wrapper container wrap area list inner outer bar item items link links "
                   "title group row col column posts news blog thread body wide sticky fixed mobile desktop".split())
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_]+")
ROLE = {"nav": "menu", "menu": "menu", "aside": "side", "footer": "foot", "header": "head", "form": "form", "fieldset": "form", "dialog": "notice", "search": "form", "label": "form", "legend": "form",
        "article": "main", "main": "main", "p": "text", "blockquote": "text", "pre": "text", "li": "list", "ul": "list", "ol": "list", "dl": "list", "dt": "list", "dd": "list", "html": "wrap",
        "body": "wrap", "div": "wrap", "section": "wrap", "center": "wrap"} | {f"h{k}": "title" for k in range(1, 7)}
AGAINST = frozenset("comment ad notice menu side share form foot head".split())
#: Prior shares of the features' values in content and elsewhere, and how much the prior weighs against the counts.
PRIOR = {
    "role": (0.3, {"menu": (0.002, 0.08), "side": (0.002, 0.05), "foot": (0.002, 0.05), "head": (0.02, 0.05), "form": (0.002, 0.05), "notice": (0.002, 0.03), "main": (0.1, 0.01),
                   "text": (0.4, 0.15), "list": (0.14, 0.17), "wrap": (0.15, 0.2), "title": (0.1, 0.05), "other": (0.08, 0.03)}),
    "cue": (0.3, {"comment": (0.002, 0.05), "ad": (0.002, 0.05), "notice": (0.004, 0.04), "menu": (0.002, 0.05), "side": (0.002, 0.05), "share": (0.002, 0.03), "form": (0.004, 0.03),
                  "foot": (0.002, 0.04), "head": (0.02, 0.04), "main": (0.15, 0.02), "none": (0.81, 0.6)}),
    "links": (0.5, {"none": (0.75, 0.3), "few": (0.17, 0.1), "some": (0.04, 0.1), "most": (0.02, 0.4), "empty": (0.02, 0.1)}),
    "words": (0.5, {0: (0.02, 0.1), 1: (0.1, 0.4), 2: (0.18, 0.25), 3: (0.3, 0.15), 4: (0.4, 0.1)}),
    "sentence": (0.5, {0: (0.25, 0.7), 1: (0.75, 0.3)}),
}
#: Parent label, kind of parent -> prior share of content children.
STEP = {(1, "shut"): 0.5, (0, "shut"): 0.0, (1, "wrap"): 0.4, (1, "main"): 0.95, (1, "block"): 0.97, (0, "wrap"): 0.02, (0, "main"): 0.01, (0, "block"): 0.001}
STEP_WEIGHT = 0.1
#: A node's features say much the same thing, so each counts for less than if they were independent.
EVIDENCE = 0.6
SURE = 40.0


class Node:
    __slots__ = ("tag", "parent", "cue", "hidden", "texts", "chars", "linked", "ends", "has_title")

    def __init__(self, tag: str, parent: int, cue: str, hidden: bool):
        self.tag, self.parent, self.cue, self.hidden = tag, parent, cue, hidden
        self.texts: list[str] = []
        self.chars = self.linked = self.ends = 0
        self.has_title = False


def cue_of_name(name: str) -> str:
    """What one name says, if all of its words are known: a word against the article counts before one for it ("post-comments"); "none" if it says nothing."""
    words = [w.lower() for w in NAME_WORDS.findall(name)]
    if name.lower() == "text":
        return "main"
    if not words or any(w not in CUE_OF and w not in BESIDE for w in words):
        return "none"
    said = [CUE_OF[w] for w in words if w in CUE_OF]
    return next((c for c in said if c != "main"), "main" if said else "none")


def cue_of(attributes: str) -> str:
    """What an element's id and role say, or else its classes, of which one for the article counts before others ("content sidebar-left")."""
    if not attributes:
        return "none"
    said: dict[bool, list[str]] = {True: [], False: []}
    for m in ATTRIBUTE.finditer(attributes):
        said[m[1].lower() == "class"] += [c for c in map(cue_of_name, (m[2] or m[3] or m[4] or "").split()) if c != "none"]
    own, classes = said[False], said[True]
    return next((c for c in own if c != "main"), None) or ("main" if own or "main" in classes else classes[0] if classes else "none")


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements in page order, each with its parent's number, and (node, text) for each block of text in page order.

    Unclosed and stray tags are mended as browsers do for blocks: a block's start closes an open p, an end tag closes all inside it
    and is ignored if nothing of its name is open."""
    nodes = [Node("html", -1, "none", False)]
    stack: list[tuple[str, int, bool, bool]] = [("html", 0, False, False)]  # tag, its block, hidden, in a link
    blocks: list[tuple[int, str]] = []
    run: list[str] = []
    places: dict[str, list[int]] = {"html": [0]}  # where each open tag stands in the stack, so that nothing is searched for
    at = 0

    def above(tags: frozenset | set, fence: int) -> int:
        """The lowest place of an open element of ``tags`` above ``fence``, 0 if there is none."""
        found = [p[k] for p in (places.get(t) for t in tags) if p and (k := bisect_right(p, fence)) < len(p)]
        return min(found, default=0)

    def last(tags: frozenset | set) -> int:
        return max((p[-1] for p in (places.get(t) for t in tags) if p), default=0)

    def push(tag: str, node: int, hidden: bool, linked: bool) -> None:
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, node, hidden, linked))

    def flush() -> None:
        if run:
            text = SPACES.sub(" ", html.unescape("".join(run))).strip()
            run.clear()
            if text:
                node = stack[-1][1]
                blocks.append((node, text))
                n = nodes[node]
                n.texts.append(text)

    def say(text: str) -> None:
        tag, node, hidden, linked = stack[-1]
        if not hidden and text:
            run.append(text)
            if (size := len(text.strip())):
                nodes[node].chars += size
                nodes[node].linked += size if linked else 0

    def close(depth: int) -> None:
        if any(t in BLOCK for t, *_ in stack[depth:]):
            flush()
        for t, *_ in stack[depth:]:
            places[t].pop()
        del stack[depth:]

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag == "br":
                run.append(" ")
            if depth := last({tag}):
                close(depth)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif not stack[-1][2]:
                run.append(" " if tag in ("br", "img", "wbr", "input") and tag != "wbr" else "")
            continue
        if tag in ("html", "body") and places.get(tag):
            continue
        if tag in BLOCK and (depth := above({"p"}, last(SCOPE))):
            close(depth)
        if tag in CLOSES:
            shut, fence = CLOSES[tag]
            if depth := above(shut, last(fence)):
                close(depth)
        if tag == "option" and stack[-1][0] == "option":
            close(len(stack) - 1)
        attributes = m[4] or ""
        hidden = stack[-1][2] or tag in HIDDEN or (HIDES.search(attributes) is not None if attributes else False)
        if tag in BLOCK:
            flush()
            nodes.append(Node(tag, stack[-1][1], cue_of(attributes), hidden))
            push(tag, len(nodes) - 1, hidden, stack[-1][3])
        elif attributes.rstrip().endswith("/") and tag in HIDDEN:
            continue
        else:
            push(tag, stack[-1][1], hidden, stack[-1][3] or tag == "a")
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = stop.start() if stop else end
    flush()
    return nodes, blocks


def features(nodes: list[Node]) -> list[tuple]:
    """(role, cue, links, words, sentence) for each node; counts of text are those of its whole subtree."""
    n = len(nodes)
    chars, linked, words, title = [x.chars for x in nodes], [x.linked for x in nodes], [0] * n, [x.tag in ("h1", "main") for x in nodes]
    ends = [any(t[-1] in ".!?…。:;\"”»" or ". " in t for t in x.texts) for x in nodes]
    for k, x in enumerate(nodes):
        words[k] = sum(t.count(" ") + 1 for t in x.texts)
    for k in range(n - 1, 0, -1):
        up = nodes[k].parent
        chars[up] += chars[k]
        linked[up] += linked[k]
        words[up] += words[k]
        ends[up] |= ends[k]
        title[up] |= title[k]
    out = []
    for k, x in enumerate(nodes):
        share = linked[k] / chars[k] if chars[k] else -1
        links = "empty" if share < 0 else "none" if share == 0 else "few" if share < 0.3 else "some" if share < 0.7 else "most"
        w = words[k]
        x.has_title = title[k] and x.tag not in ("h1", "main")
        out.append((ROLE.get(x.tag, "other"), x.cue, links, 0 if w == 0 else 1 if w < 5 else 2 if w < 15 else 3 if w < 50 else 4, int(ends[k])))
    return out


def against(node: Node) -> bool:
    """Markup says that this isn't the article; not believed of what holds the page's title or main element."""
    role = ROLE.get(node.tag, "other")
    return (role in AGAINST or node.cue in AGAINST and node.tag not in ("html", "body", "main", "h1")) and not node.has_title


def kind(node: Node) -> str:
    return "shut" if against(node) else "main" if node.tag in ("article", "main") or node.cue == "main" else "wrap" if ROLE.get(node.tag) == "wrap" else "block"


def own_labels(nodes: list[Node]) -> list[int] | None:
    """1 for nodes in the page's article and those around it, 0 elsewhere; None if its markup names no article."""
    inside, n = [0] * len(nodes), len(nodes)
    for k, x in enumerate(nodes):
        up = x.parent
        inside[k] = -1 if up >= 0 and inside[up] == -1 or against(x) else 1 if x.tag in ("article", "main") or up >= 0 and inside[up] == 1 else 0
    if 1 not in inside:
        return None
    labels = [int(v == 1) for v in inside]
    for k in range(n - 1, 0, -1):
        if labels[k] and inside[nodes[k].parent] == 0:
            labels[nodes[k].parent] = 1
    return labels


NAMES = tuple(PRIOR)


class Model:
    """Potentials: counts of (feature, value, label) and (parent label, parent kind, label), mixed with the prior tables."""

    def __init__(self, seen: dict[tuple, float]):
        self.own: dict[tuple, tuple[float, float]] = {}
        for name, (weight, table) in PRIOR.items():
            totals = [sum(c for (f, v, y), c in seen.items() if f == name and y == label) for label in (0, 1)]
            for value, prior in table.items():
                p = []
                for label in (0, 1):
                    share = prior[0 if label else 1]
                    counted = seen.get((name, value, label), 0) / totals[label] if totals[label] else share
                    p.append(EVIDENCE * log(weight * share + (1 - weight) * counted))
                self.own[name, value] = (p[0], p[1])
        self.step = {}
        for (up, of), share in STEP.items():
            yes, no = seen.get(("step", (up, of), 1), 0), seen.get(("step", (up, of), 0), 0)
            p = STEP_WEIGHT * share + (1 - STEP_WEIGHT) * (yes / (yes + no) if yes + no else share)
            p = min(max(p, 1e-9 if of == "shut" else 1e-4), 1 - 1e-3)
            self.step[up, of] = (1 - p, p)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of each node by messages up and then down the tree; parents come before their children."""
        n, seen = len(nodes), features(nodes)
        up0, up1 = [0.0] * n, [0.0] * n
        for k, values in enumerate(seen):
            a = b = 0.0
            for name, v in zip(NAMES, values):
                x, y = self.own[name, v]
                a += x
                b += y
            up0[k], up1[k] = (a, b - SURE) if against(nodes[k]) else (a, b)
        to0, to1 = [0.0] * n, [0.0] * n
        steps = [None, *((self.step[0, c], self.step[1, c]) for c in (kind(nodes[x.parent]) for x in nodes[1:]))]
        for k in range(n - 1, 0, -1):
            if against(nodes[k]):
                continue  # its label is known from its markup alone and says nothing about what is around it
            (s00, s01), (s10, s11) = steps[k]
            top = max(up0[k], up1[k])
            e0, e1 = exp(up0[k] - top), exp(up1[k] - top)
            to0[k], to1[k] = log(s00 * e0 + s01 * e1) + top, log(s10 * e0 + s11 * e1) + top
            up0[nodes[k].parent] += to0[k]
            up1[nodes[k].parent] += to1[k]
        all0, all1 = up0[:], up1[:]
        for k in range(1, n):
            (s00, s01), (s10, s11) = steps[k]
            up = nodes[k].parent
            d0, d1 = all0[up] - to0[k], all1[up] - to1[k]
            top = max(d0, d1)
            e0, e1 = exp(d0 - top), exp(d1 - top)
            all0[k] += log(e0 * s00 + e1 * s10) + top
            all1[k] += log(e0 * s01 + e1 * s11) + top
        return [1 / (1 + exp(min(700.0, max(-700.0, a - b)))) for a, b in zip(all0, all1)]

    def extract(self, page: str | None) -> str:
        if not page:
            return ""
        nodes, blocks = parse(page)
        p = self.marginals(nodes)
        return "\n".join(text for node, text in blocks if p[node] > 0.5)


def count_page(page: str) -> dict[tuple, float]:
    nodes, _ = parse(page)
    values, labels, out = features(nodes), None, {}
    labels = own_labels(nodes)
    if labels is None:
        return out
    shut = [False] * len(nodes)
    for k, x in enumerate(nodes):
        if k:
            shut[k] = shut[x.parent] or against(nodes[x.parent])
        if shut[k]:
            continue  # its label follows from what it stands in, whatever it looks like
        for name, v in zip(NAMES, values[k]):
            out[name, v, labels[k]] = out.get((name, v, labels[k]), 0) + 1
        if k:
            key = ("step", (labels[x.parent], kind(nodes[x.parent])), labels[k])
            out[key] = out.get(key, 0) + 1
    return out


def train(pages: DataFrame, rows: int = SAMPLE_PAGES) -> Model:
    """The model of about ``rows`` pages at most, chosen by a hash of their html; pages that don't name their article teach nothing.
    Each task returns its counts, of which there are at most as many as table entries."""
    share = min(1.0, rows / max(1, pages.count()))
    chosen = pages.filter(F.col("html").isNotNull() & (F.pmod(F.xxhash64("html"), F.lit(1_000_000)) < int(share * 1_000_000))).select("html")

    def run(batches):
        total: dict[tuple, float] = {}
        for batch in batches:
            for page in batch["html"]:
                for key, n in count_page(page).items():
                    total[key] = total.get(key, 0) + n
        if total:
            yield pd.DataFrame({"key": pd.Series([repr(k) for k in total], dtype=object), "n": np.array(list(total.values()), float)})

    counted = chosen.mapInPandas(run, "key string, n double").groupBy("key").agg(F.sum("n").alias("n")).collect()
    import ast

    return Model({ast.literal_eval(r["key"]): r["n"] for r in sorted(counted, key=lambda r: r["key"])})


def extract_pages(pages: DataFrame, model: Model | None = None) -> tuple[DataFrame, str]:
    """``pages`` with a text column (its name is returned): the main text, blocks joined by line ends.

    Null and empty pages give an empty text, so do pages without content; broken markup is mended; character references become their
    characters; repeated rows are treated alike; other columns stay as they are."""
    ship(pages.sparkSession)
    model = model or train(pages)
    name = free_name(pages, "text")

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pd.Series([model.extract(p) for p in pages], dtype=object)

    return pages.withColumn(name, text.asNondeterministic()(whole(F.col("html")))), name
