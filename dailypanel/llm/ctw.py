"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each has a tree of contexts, the bytes before it. Every context estimates the decision by
Krichevsky-Trofimov counts, and weighting mixes the estimates of all depths: a context's weighted probability is half its own estimate and half
the product of those of its children. The counts come from all training texts and every context is kept, so the tree grows with the corpus: it is a
table of grams (a context and its next byte). Contexts of up to CUT - 1 bytes, bounded by the alphabet, are weighted on the driver; the
subtrees below them on the executors. The probabilities of the most frequent grams are broadcast, those of the others joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import batch_of, scratch_table, settle, ship, slices, split_words, whole

DEPTH = 4
#: Subtrees of contexts of so many bytes are weighted by one task each: of at most 65536 grams at a depth of one byte more.
CUT = 3
#: So many of the most frequent grams are looked up on the executors. Others are joined.
GRAMS = 2_000_000
#: Tokens at least this frequent (one in so many) are looked up on the executors: at most this many. Others are joined.
HEAD = 500_000
#: Begins and ends texts; no UTF-8 text has it.
EDGE = 255
#: The end of a text among the tokens: no word holds a space.
END = " end"


def lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x > 0: Stirling's series above 10, reached by the recurrence."""
    x, shift = x.astype(np.float64), np.zeros(x.shape)
    for _ in range(10):
        small = x < 10
        shift = np.where(small, shift + np.log(np.where(small, x, 1)), shift)
        x = np.where(small, x + 1, x)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5) - shift


def decisions(counts: np.ndarray) -> np.ndarray:
    """Counts of (0, 1) at the 255 binary decisions that lead to a byte, for rows of 256 byte counts: shape (rows, 255, 2)."""
    rows = len(counts)
    return np.concatenate([counts.reshape(rows, 1 << b, 2, 128 >> b).sum(-1) for b in range(8)], axis=1)


def log_kt(n: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n[..., 0] zeros and n[..., 1] ones."""
    a, b = n[..., 0], n[..., 1]
    return lgamma(a + 0.5) + lgamma(b + 0.5) - np.log(np.pi) - lgamma(a + b + 1)


def next_kt(n: np.ndarray) -> np.ndarray:
    """The estimate of a one to follow."""
    return (n[..., 1] + 0.5) / (n[..., 0] + n[..., 1] + 1)


class Tree:
    """The tree in one process, which the tests hold the tables of grams against. Frozen predictions: for each kept context the log10 probability of each next byte, and tables that find the deepest kept context."""

    def __init__(self, counted: list[pd.DataFrame]):
        """counted[d]: columns ctx (d bytes, the last byte lowest), next, n; kept contexts only. counted[0] has the root."""
        self.depth = len(counted) - 1
        contexts, counts = [], []
        for frame in counted:
            ctx = np.unique(frame["ctx"].to_numpy(np.int64))
            table = np.zeros((len(ctx), 256))
            np.add.at(table, (np.searchsorted(ctx, frame["ctx"].to_numpy(np.int64)), frame["next"].to_numpy(np.int64)), frame["n"].to_numpy(float))
            contexts.append(ctx)
            counts.append(table)
        if not len(contexts[0]):
            contexts[0], counts[0] = np.zeros(1, np.int64), np.zeros((1, 256))
        parent = [None] + [np.searchsorted(contexts[d - 1], contexts[d] & ((1 << 8 * (d - 1)) - 1)) for d in range(1, self.depth + 1)]
        rests, kids = [], []
        for d in range(self.depth + 1):
            rest, has = counts[d].copy(), np.zeros(len(counts[d]), bool)
            if d < self.depth and len(contexts[d + 1]):
                np.add.at(rest, parent[d + 1], -counts[d + 1])
                has[parent[d + 1]] = True
            rests.append(np.maximum(rest, 0))
            kids.append(has)
        weights, below = [None] * (self.depth + 1), None
        for d in range(self.depth, -1, -1):
            own = log_kt(decisions(counts[d]))
            split = log_kt(decisions(rests[d]))
            if below is not None and len(below):
                np.add.at(split, parent[d + 1], below)
            both = np.where(kids[d][:, None], np.logaddexp(own, split) - np.log(2), own)
            weights[d] = np.where(kids[d][:, None], np.exp(own - np.log(2) - both), 1.0)
            below = both
        self.first, tables, above, left = [], [], None, None
        total = 0
        for d in range(self.depth + 1):
            kt, rest = next_kt(decisions(counts[d])), next_kt(decisions(rests[d]))
            a = above[parent[d]] if d else np.zeros_like(kt)
            b = left[parent[d]] if d else np.ones_like(kt)
            w = weights[d]
            tables.append(self._bytes(a + b * (w * kt + (1 - w) * rest)))
            above, left = a + b * w * kt, b * (1 - w)
            self.first.append(total)
            total += len(kt)
        self.log10 = np.concatenate(tables).astype(np.float32)
        # down[d][i * 256 + byte]: number (from 1) of the kept context of d + 1 bytes that is context i (from 1; 0: none) with the byte before it
        self.down = []
        for d in range(self.depth):
            table = np.zeros((len(contexts[d]) + 1) * 256, np.int32)
            table[(parent[d + 1] + 1) * 256 + (contexts[d + 1] >> 8 * d)] = np.arange(len(contexts[d + 1])) + 1
            self.down.append(table)

    @staticmethod
    def _bytes(ones: np.ndarray) -> np.ndarray:
        """log10 probabilities of 256 bytes from those of a one at the 255 decisions."""
        out, at = np.zeros((len(ones), 256)), 0
        for b in range(8):
            p = ones[:, at:at + (1 << b)]
            both = np.log10(np.stack([1 - p, p], axis=2)).reshape(len(ones), 2 << b)
            out += np.repeat(both, 256 >> b + 1, axis=1)
            at += 1 << b
        return out

    def score(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each text; ``data`` has each text's bytes after ``depth`` edges and before one, ``starts`` where these begin."""
        n = len(data) - self.depth
        now, state = np.ones(n, np.int64), np.zeros(n, np.int64)
        for d in range(self.depth):
            now = self.down[d][now * 256 + data[self.depth - 1 - d:self.depth - 1 - d + n]].astype(np.int64)
            state = np.where(now > 0, self.first[d + 1] + now - 1, state)
        logs = self.log10[state, data[self.depth:]].astype(np.float64)
        sums = np.concatenate([[0.0], np.cumsum(logs)])
        # between texts stand the edges of the next one: they are no part of either
        ends = np.append(starts[1:], len(data))
        return sums[ends - self.depth] - sums[starts]


def weigh(gram: np.ndarray, n: np.ndarray, low: int, high: int, below: tuple | None = None) -> list[tuple]:
    """For contexts of ``low`` to ``high`` bytes: the decisions (context * 256 + number) that the grams (of ``high`` + 1 bytes) pass, the place among them
    of each gram's eight, the log weighted probability, the weight of a decision's own estimate, and that estimate of a one.

    Decisions not listed have no counts: their estimates, and all below them, are 1/2. ``below``: decisions at ``high`` and the summed log
    weighted probabilities of their children; without it these are leaves."""
    shift = np.arange(8)[:, None]
    number, one = (1 << shift) | ((gram & 255) >> 8 - shift), ((gram & 255) >> 7 - shift) & 1
    found, under = [], below
    for d in range(high, low - 1, -1):
        nodes, place = np.unique(((gram >> 8) & ((1 << 8 * d) - 1)) << 8 | number, return_inverse=True)
        place = place.reshape(8, -1)
        ones = np.bincount(place.ravel(), (one * n).ravel(), len(nodes))
        counts = np.stack([np.bincount(place.ravel(), np.broadcast_to(n, one.shape).ravel(), len(nodes)) - ones, ones], axis=-1)
        own = both = log_kt(counts)
        weight = np.ones(len(nodes))
        if under is not None:
            keys, sums = under
            up = ((keys >> 8) & ((1 << 8 * d) - 1)) << 8 | keys & 255
            split = np.bincount(np.searchsorted(nodes, up), sums, len(nodes))
            both = np.logaddexp(own, split) - np.log(2)
            weight = np.exp(own - np.log(2) - both)
        under = nodes, both
        found.append((nodes, place, both, weight, next_kt(counts)))
    return found[::-1]


def mix(levels: list[tuple], low: int, above: tuple | None) -> tuple:
    """Decisions of the deepest level, what the contexts so far add to the probability of a one, and the weight left. ``above``: the same for contexts of ``low`` - 1 bytes."""
    for d, (nodes, _, _, weight, kt) in enumerate(levels, low):
        if above is None:
            a, left = np.zeros(len(nodes)), np.ones(len(nodes))
        else:
            at = np.searchsorted(above[0], ((nodes >> 8) & ((1 << 8 * (d - 1)) - 1)) << 8 | nodes & 255)
            a, left = above[1][at], above[2][at]
        above = nodes, a + left * weight * kt, left * (1 - weight)
    return above


def subtrees(batches: Iterator[pa.RecordBatch], cut: int, size: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(gram, n, m) of whole subtrees, about ``size`` grams together; the rows of a subtree follow each other."""
    rest = None
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in ("gram", "n", "m")])
        rest = rows if rest is None else np.concatenate([rest, rows], axis=1)
        if rest.shape[1] >= size:
            of = (rest[0] >> 8) & ((1 << 8 * cut) - 1)
            ends = np.flatnonzero(of[1:] != of[:-1]) + 1
            if len(ends):
                yield tuple(rest[:, :ends[-1]])
                rest = rest[:, ends[-1]:]
    if rest is not None and rest.shape[1]:
        yield tuple(rest)


def weigh_subtrees(cut: int, depth: int):
    """For mapInArrow over grams: (decision of cut - 1 bytes, sum of its children's log weighted probabilities)."""
    schema = pa.schema([("node", pa.int64()), ("below", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n, _ in subtrees(batches, cut):
            nodes, _, both, _, _ = weigh(gram, n, cut, depth)[0]
            up, place = np.unique(((nodes >> 8) & ((1 << 8 * (cut - 1)) - 1)) << 8 | nodes & 255, return_inverse=True)
            yield batch_of([up, np.bincount(place, both, len(up))], schema)

    return run


def predict_grams(top, cut: int, depth: int):
    """For mapInArrow over grams: (gram, m, log10 probability of its last byte after the others). ``top``: what ``mix`` gives of the contexts above, broadcast."""
    schema = pa.schema([("gram", pa.int64()), ("m", pa.int64()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n, m in subtrees(batches, cut):
            levels = weigh(gram, n, cut, depth)
            ones = mix(levels, cut, top.value)[1][levels[-1][1]]
            bits = ((gram & 255) >> 7 - np.arange(8)[:, None]) & 1
            yield batch_of([gram, m, np.log10(np.where(bits == 1, ones, 1 - ones)).sum(0)], schema)

    return run


def padded(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with ``depth`` edges before each text and one after it, and where each text's edges begin."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
    raw = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + depth + 1)])[:-1]
    out = np.full(int((sizes + depth + 1).sum()), EDGE, np.uint8)
    out[np.arange(len(raw)) + np.repeat(starts + depth - (np.cumsum(sizes) - sizes), sizes)] = raw
    return out, starts


def gram_counts(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of depth + 1 bytes that end at a text's byte or end, and how often each is there."""
    return np.unique(grams_of(data, starts, depth), return_counts=True)


def grams_of(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Runs of depth + 1 bytes that end at a text's byte or end, in order."""
    n = len(data) - depth
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.zeros(n, np.int64)
    for k in range(depth + 1):
        key = (key << 8) | data[k:k + n]
    real = np.ones(n, bool)
    for k in range(depth):  # runs that end in the edges before the next text
        later = starts[1:] - depth + k
        real[later[later < n]] = False
    return key[real]


def lower_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """``split_words`` with A-Z lowered. Lowered are the distinct words: Arrow's ascii_lower shifts the texts of a slice that was cast."""
    words, starts = split_words(texts)
    lowered = pc.ascii_lower(words.dictionary).dictionary_encode()
    return pa.DictionaryArray.from_arrays(lowered.indices.take(words.indices), lowered.dictionary), starts


def gather(depth: int):
    """For mapInArrow over (held, text): (token, null, n, n) rows of training texts, and (null, gram, n, m) rows of all: n times in training texts, m in all. Summed within a slice."""
    schema = pa.schema([("token", pa.string()), ("gram", pa.int64()), ("n", pa.int64()), ("m", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            texts, held = batch.column("text"), batch.column("held")
            known = texts.filter(pc.invert(held))
            if len(known):
                words, _ = lower_words(known)
                times = np.append(np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary)), len(known))
                tokens = pa.concat_arrays([words.dictionary.cast(pa.string()), pa.array([END])])
                yield batch_of([tokens, pa.nulls(len(tokens), pa.int64()), times, times], schema)
            for part, train in ((known, 1), (texts.filter(held), 0)):
                if len(part):
                    grams, m = gram_counts(*padded(part, depth), depth)
                    yield batch_of([pa.nulls(len(grams), pa.string()), grams, m * train, m], schema)

    return run


def apply_model(model, depth: int):
    """For mapInArrow over (doc_id, mark, text): sizes, sums over frequent tokens and frequent grams, and the other tokens and grams with their counts. ``model``:
    a broadcast (frequent grams in order, their log10 probabilities, hashes of the frequent tokens in order, their log10 shares)."""
    import xxhash

    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "mark", "n_tokens", "n_bytes", "head_n")] + [("head_sum", pa.float64()), ("score", pa.float64()), ("tails", pa.list_(pa.string())), ("tail_n", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64())), ("gram_n", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs, hashes, shares = model.value
        for batch in slices(batches, "text", 4_000_000):
            words, starts = lower_words(batch.column("text"))
            rows, size = batch.num_rows, max(1, len(words.dictionary))
            owner = np.repeat(np.arange(rows), np.diff(starts))
            pair, n = np.unique(owner * size + words.indices.to_numpy(), return_counts=True)
            owner, code = pair // size, pair % size
            own = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in words.dictionary.cast(pa.large_binary())), np.uint64, len(words.dictionary))
            at = np.minimum(np.searchsorted(hashes, own), max(0, len(hashes) - 1))
            frequent = hashes[at] == own if len(hashes) else np.zeros(len(own), bool)
            head = frequent[code]
            head_n = np.bincount(owner[head], n[head], rows).astype(np.int64)
            head_sum = np.bincount(owner[head], n[head] * shares[at[code[head]]], rows)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[~head], minlength=rows))]).astype(np.int32)
            tails = words.dictionary.cast(pa.string()).take(pa.array(code[~head]))
            data, begins = padded(batch.column("text"), depth)
            n_bytes = np.diff(np.append(begins, len(data))) - depth - 1
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (tails, pa.array(n[~head], pa.int64()))]
            grams, code = np.unique(grams_of(data, begins, depth), return_inverse=True)
            at = np.minimum(np.searchsorted(known, grams), max(0, len(known) - 1))
            frequent = known[at] == grams if len(known) else np.zeros(len(grams), bool)
            p = np.where(frequent, logs[at], 0.0) if len(known) else np.zeros(len(grams))
            score = np.add.reduceat(p[code], np.concatenate([[0], np.cumsum(n_bytes + 1)[:-1]]))
            rare = ~frequent[code]
            pair, n = np.unique(np.repeat(np.arange(rows), n_bytes + 1)[rare] * len(grams) + code[rare], return_counts=True)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(pair // len(grams), minlength=rows))]).astype(np.int32)
            lists += [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (grams[pair % len(grams)], n)]
            yield batch_of([batch.column("doc_id"), batch.column("mark"), np.diff(starts) + 1, n_bytes, head_n, head_sum, score, *lists], schema)

    return run


def held_out(doc_id: Column) -> Column:
    """One document in five, by its id; a missing id counts as an empty text, which is for training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def train(docs: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, int, int]:
    """A table of the grams of all texts (gram, m, p: how often in all texts, and the log10 probability by the tree of the training texts), a table of token counts
    (token, c), and the training tokens: all (N) and distinct (V). Everything is counted over all training texts."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(held_out(F.col("doc_id")).alias("held"), whole(F.col("text")).alias("text"))
    counted = texts.mapInArrow(gather(depth), "token string, gram long, n long, m long").groupBy("token", "gram").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    counted = scratch_table(counted)
    tokens = counted.filter("token IS NOT NULL").select("token", F.col("n").alias("c"))
    n_all, n_distinct = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    cut = min(CUT, depth)
    subtree = F.expr(f"shiftright(gram, 8) & {(1 << 8 * cut) - 1}L")
    grams = counted.filter("gram IS NOT NULL").select("gram", "n", "m", subtree.alias("subtree")).repartition("subtree")
    grams = settle(grams.sortWithinPartitions("subtree").select("gram", "n", "m"))
    top = None
    if cut:
        sums = grams.mapInArrow(weigh_subtrees(cut, depth), "node long, below double").groupBy("node").agg(F.sum("below").alias("below")).toArrow()
        counts = grams.groupBy(F.expr(f"gram & {(1 << 8 * cut) - 1}L").alias("gram")).agg(F.sum("n").alias("n")).toArrow()
        column = lambda table, name: table.column(name).to_numpy()
        levels = weigh(column(counts, "gram"), column(counts, "n"), 0, cut - 1, (column(sums, "node"), column(sums, "below")))
        top = mix(levels, 0, None)
    found = grams.mapInArrow(predict_grams(spark.sparkContext.broadcast(top), cut, depth), "gram long, m long, p double")
    return scratch_table(found), tokens, int(n_all), int(n_distinct)


def least_count(grams: DataFrame, most: int) -> int:
    """The least number of times that leaves at most ``most`` grams. One in ``most`` of all is often enough, so only smaller numbers are looked at."""
    total, distinct = grams.agg(F.coalesce(F.sum("m"), F.lit(0)), F.count(F.lit(1))).first()
    if distinct <= most:
        return 0
    bound = -(-total // most)
    fewer = sorted(grams.filter(F.col("m") < bound).groupBy("m").count().collect(), reverse=True)
    least, n = bound, distinct - sum(r["count"] for r in fewer)
    for r in fewer:
        n += r["count"]
        if n > most:
            break
        least = r["m"]
    return least


def score_documents(docs: DataFrame, depth: int = DEPTH, head: int = HEAD, grams: int = GRAMS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text's bytes and end),
    bits_per_byte (code length by byte; the end counts as one).

    Null texts count as empty: one token, the end. Repeated rows are scored alike and all count in training. Without training texts
    every byte has the same probability."""
    spark = docs.sparkSession
    table, tokens, n_all, n_distinct = train(docs, depth)
    log_all = float(np.log10(n_all + 0.5 * (n_distinct + 1)))
    least = max(1.0, n_all / head)
    frequent = tokens.filter((F.col("c") >= least) & (F.col("token") != END)).toPandas()  # at most ``head`` rows
    import xxhash

    hashes = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in frequent["token"]], np.uint64)
    order = np.argsort(hashes)
    shares = np.log10(frequent["c"].to_numpy(float)[order] + 0.5) - log_all
    often = least_count(table, grams)
    known = table.filter(F.col("m") >= often).select("gram", "p").toArrow().sort_by("gram")  # at most ``grams`` rows
    model = spark.sparkContext.broadcast((known.column("gram").to_numpy(), known.column("p").to_numpy(), hashes[order], shares))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), whole(F.col("text")).alias("text"))
    rows = scratch_table(keyed.mapInArrow(apply_model(model, depth), "doc_id long, mark long, n_tokens long, n_bytes long, head_n long, head_sum double, score double, tails array<string>, tail_n array<long>, grams array<long>, gram_n array<long>"))
    ends = tokens.filter(F.col("token") == END).select("c").first()
    end_share = float(np.log10((ends[0] if ends else 0) + 0.5)) - log_all
    tails = rows.select("doc_id", "mark", F.explode(F.arrays_zip("tails", "tail_n")).alias("t")).select("doc_id", "mark", F.col("t.tails").alias("token"), F.col("t.tail_n").alias("n"))
    rare = tokens.filter(F.col("c") < least)
    tails = tails.join(rare, "token", "left").groupBy("doc_id", "mark").agg(
        F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - log_all)).alias("tail_sum"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("tail_n"))
    rare = rows.select("doc_id", "mark", F.explode(F.arrays_zip("grams", "gram_n")).alias("g")).select("doc_id", "mark", F.col("g.grams").alias("gram"), F.col("g.gram_n").alias("k"))
    rare = rare.join(table.filter(F.col("m") < often).select("gram", "p"), "gram").groupBy("doc_id", "mark").agg(F.sum(F.col("k") * F.col("p")).alias("gram_sum"))
    # rows alike in id and text were summed together
    alike = rows.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("alike")).filter("alike > 1")
    same = lambda name: F.col("doc_id").eqNullSafe(F.col(f"{name}.d")) & (F.col("mark") == F.col(f"{name}.m"))
    out = rows.drop("tails", "tail_n", "grams", "gram_n").join(tails.withColumnsRenamed({"doc_id": "d", "mark": "m"}).alias("t"), same("t"), "left")
    out = out.join(rare.withColumnsRenamed({"doc_id": "d", "mark": "m"}).alias("g"), same("g"), "left")
    out = out.join(alike.withColumnsRenamed({"doc_id": "d", "mark": "m"}).alias("a"), same("a"), "left")
    times = F.coalesce("alike", F.lit(1))
    score = F.col("score") + F.coalesce(F.col("gram_sum"), F.lit(0.0)) / times
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("head_n") + F.coalesce(F.col("tail_n"), F.lit(0)) / times + (1 if ends else 0)).cast("long").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce(F.col("tail_sum"), F.lit(0.0)) / times + end_share).alias("base_score"), score.alias("score"),
        (-score / float(np.log10(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
