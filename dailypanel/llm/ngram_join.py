"""N-gram Jaccard self join of documents: MinHash banding finds candidates, full n-gram sets verify them.

Equal texts are one node. Bands are compared by hash; every bucket gives edges to its first node only, never all pairs. Each
connected group of candidates is then verified whole, in blocks of at most ``BLOCK`` texts against each other, so that every pair of its
different texts is compared on full sets and none is emitted: a task returns each text's number of links and a spanning edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import folded, mix64, settle, shingle_hashes, ship, slices, split_words, text_key, unfolded, whole, word_hashes
from dailypanel.llm.components import components

WORDS, LIKE = 5, 0.8
#: Texts compared with each other in one task hold at most twice as many rows as this.
BLOCK = 1024
COLUMNS = 8192


def nameless(text: Column) -> Column:
    """Stands for a missing doc_id: a number above 2^62 that depends on the text."""
    return F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(2 ** 62))


def banding(like: float = LIKE, recall: float = 0.9999, rows: int = 5) -> tuple[int, int]:
    """(bands, rows): the fewest bands of ``rows`` hashes that find a pair of likeness ``like`` with at least this chance."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - like ** rows))), rows


def sketches(words: int, bands: int, rows: int):
    """For mapInArrow over (node, h1, h2, text): node, h1, h2 and a hash for each band (none for a text without words)."""
    rng = np.random.default_rng(20_240_601)
    factors = rng.integers(1, 2 ** 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, starts = split_words(batch.column("text"))
            hashes, offsets = shingle_hashes(word_hashes(codes), starts, words)
            some = np.diff(offsets) > 0
            at = offsets[:-1][some]
            out = np.zeros((int(some.sum()), bands), np.uint64)
            if len(at):
                for k in range(bands * rows):
                    low = np.minimum.reduceat(hashes * factors[k] + shifts[k], at)
                    out[:, k // rows] = out[:, k // rows] * np.uint64(0x100000001B3) + mix64(low)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32), pa.array(out.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("h1"), batch.column("h2"), lists], ["node", "h1", "h2", "bands"])

    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 4096) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``: many small groups together, or one large group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        last = [table.column(k)[-1] for k in keys]
        same = np.ones(table.num_rows, bool)
        for k, v in zip(keys, last):
            same &= table.column(k).to_numpy() == v.as_py()
        cut = int(np.argmax(same))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of every two sets."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    times = np.bincount(column)
    shared = times[column] > 1
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column.max()) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, int(column[b - 1]) - low + 1)), np.float32)
        m[owner[a:b], column[a:b] - low] = 1
        out += m @ m.T
    out[np.arange(len(sets)), np.arange(len(sets))] = sizes
    return out


def verify(words: int, like: float):
    """For mapInArrow over (part, i, j, mine, node, text) sorted by part, i, j: node, part, links and low, the smallest node that a
    chain of links inside the block reaches. A block i, j compares texts of block i with those of j; i, i compares all its texts."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])

    def block(nodes: np.ndarray, mine: np.ndarray, sets: list[np.ndarray], cross: bool) -> tuple[np.ndarray, np.ndarray]:
        both = overlaps(sets)
        sizes = np.array([len(s) for s in sets], np.float64)
        linked = both >= like * (sizes[:, None] + sizes[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        if cross:
            linked &= mine[:, None] != mine[None, :]
        low = nodes.copy()
        while True:  # every text takes the smallest label among its neighbours until nothing changes
            near = np.where(linked, low[None, :], np.iinfo(np.int64).max).min(1)
            new = np.minimum(low, near)
            if (new == low).all():
                return linked.sum(1), low
            low = new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["part", "i", "j"]):
            codes, starts = split_words(table.column("text").combine_chunks())
            hashes, offsets = shingle_hashes(word_hashes(codes), starts, words)
            part, i, j, mine, node = (table.column(c).to_numpy() for c in ("part", "i", "j", "mine", "node"))
            new = np.concatenate([[True], (part[1:] != part[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            edges = np.concatenate([np.flatnonzero(new), [len(new)]])
            out = []
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a > 1:
                    sets = [np.unique(hashes[offsets[k]:offsets[k + 1]]) for k in range(a, b)]
                    out.append((node[a:b], *block(node[a:b], mine[a:b], sets, i[a] != j[a])))
                else:
                    out.append((node[a:b], np.zeros(1, np.int64), node[a:b]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], schema=schema)

    return run


def classes(keyed: DataFrame, words: int, like: float, recall: float, block: int) -> DataFrame:
    """One row per text of ``keyed`` (id, h1, h2, text): h1, h2, first (its smallest id), n_copies, n_links, class_id, leads (it is the text of its
    class that stays: the one with the smallest id, of several the one with the smallest hash)."""
    bands, rows = banding(like, recall)
    sketched = keyed.select(F.col("id").alias("node"), "h1", "h2", "text").mapInArrow(sketches(words, bands, rows), "node long, h1 long, h2 long, bands array<long>")
    texts = sketched.groupBy("h1", "h2").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands"))
    # a text's own number, not an id: rows may share an id and differ in text. It is written, so that it stays
    texts = settle(texts.withColumn("rep", F.monotonically_increasing_id()))

    spread = texts.select("rep", F.posexplode("bands").alias("band", "bucket"))
    full = spread.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("lead")).filter("n > 1")
    stars = spread.join(full.drop("n"), ["band", "bucket"]).filter("rep > lead").select(F.col("rep").alias("a"), F.col("lead").alias("b"))
    parts = components(stars).select(F.col("node").alias("rep"), F.col("label").alias("part"))

    n_blocks = parts.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    members = settle(parts.join(n_blocks, "part").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks"))))
    asked = members.join(texts.select("rep", F.col("first").alias("id"), "h1", "h2"), "rep")
    # of a text's copies only those with its smallest id travel
    own = keyed.select("id", "h1", "h2", "text").join(asked, ["id", "h1", "h2"]).select(F.col("rep").alias("node"), "part", "blocks", "mine", "text").dropDuplicates(["node"])
    met = own.withColumn("k", F.explode(F.expr("sequence(0L, blocks - 1)")))
    met = met.select("part", F.least("mine", "k").alias("i"), F.greatest("mine", "k").alias("j"), "mine", "node", "text")
    met = met.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")
    seen = settle(met.mapInArrow(verify(words, like), "node long, links long, low long"))
    links = seen.groupBy("node").agg(F.sum("links").alias("n_links"), F.min("low").alias("low"))
    # a part of one block is whole after its task; only those of more blocks are drawn together here
    wide = seen.join(members.filter("blocks > 1").select(F.col("rep").alias("node")), "node", "left_semi")
    drawn = components(wide.select(F.col("node").alias("a"), F.col("low").alias("b")))
    joined = links.join(drawn, "node", "left").select(F.col("node").alias("rep"), F.coalesce("label", "low").alias("class"), "n_links")

    known = texts.drop("bands").join(joined, "rep", "left")
    known = settle(known.select("h1", "h2", "first", "n_copies", F.coalesce("class", "rep").alias("class"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    lead = settle(known.groupBy("class").agg(F.min(F.struct("first", "h1", "h2")).alias("lead")))
    known = known.join(lead, "class")
    same = (F.col("lead.h1") == F.col("h1")) & (F.col("lead.h2") == F.col("h2"))
    return settle(known.select("h1", "h2", "first", "n_copies", "n_links", F.col("lead.first").alias("class_id"), same.alias("leads")))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, id (that of the document, or one of its text), h1, h2, text."""
    text = whole(F.col("text"))
    number = F.col("doc_id").cast("long")
    return docs.select(number.alias("doc_id"), F.coalesce(number, nameless(text)).alias("id"), *text_key(text), text.alias("text"))


def join_ngrams(docs: DataFrame, words: int = WORDS, like: float = LIKE, recall: float = 0.9999, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of the documents that links connect), n_links (other texts whose
    word n-gram sets are at least ``like`` similar), n_copies (documents of the same text, itself included).

    Null texts count as empty. Texts without words have no links. Texts of fewer words than the n-gram are one n-gram. A document without
    doc_id has a number of its text's hash, above 2^62, as its id here. Repeated rows are copies. Rows that share a doc_id and differ in text are
    compared like any others, and each has its own text's links. Other columns are not returned. Empty in, empty out."""
    ship(docs.sparkSession)
    keyed = identified(docs)
    return keyed.select("doc_id", "h1", "h2").join(classes(keyed, words, like, recall, block), ["h1", "h2"]).select("doc_id", "class_id", "n_links", "n_copies")


def one_of_each(docs: DataFrame, words: int = WORDS, like: float = LIKE, recall: float = 0.9999, block: int = BLOCK) -> DataFrame:
    """The first document of each class, with its own columns. Rows that share a doc_id and text are one document."""
    ship(docs.sparkSession)
    text = whole(F.col("text"))
    firsts = classes(identified(docs), words, like, recall, block).filter("leads").select(F.col("first").alias("node"), F.col("h1").alias("t1"), F.col("h2").alias("t2"))
    h1, h2 = (c.alias(f"t{k}") for k, c in enumerate(text_key(text), 1))
    chosen = folded(docs).withColumn("node", F.coalesce(F.col("doc_id").cast("long"), nameless(text))).select("*", h1, h2).join(firsts, ["node", "t1", "t2"], "left_semi")
    return unfolded(chosen.dropDuplicates(["node", "t1", "t2"]), docs)
