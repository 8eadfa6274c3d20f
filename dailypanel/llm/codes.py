"""Vector code compression: product codes whose nearest entries are found by slicing and intersecting bitmasks.

For every dimension the entries' coordinates are sorted and carry, at each place, the set of all entries before it as uint64 words. A radius
around a coordinate selects a range of places; the sets at its two ends differ in the entries within the range. ANDed over the dimensions
they give the entries within a box, which holds all entries within the radius. Only these are compared in full. A part whose nearest found entry
is farther away than the radius, or that found none, is sliced again with a larger one, so results are exact whatever the first radius.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import free_name, scratch_table, settle, ship
from dailypanel.llm.exact import sized

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
#: Components are held within this, so that no squared distance of 512 dimensions leaves 64 bits. |x| below 16384 is never touched.
LARGEST = 1 << 26
#: Vectors that a task compares at a time.
SLICE = 65_536


class Slices:
    """The entries (rows of an integer matrix) of one part position, prepared for box queries."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries.astype(np.int64)
        n, dims = entries.shape
        words = (n + 63) // 64
        own = np.zeros((n, words), np.uint64)
        own[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        self.all = np.bitwise_or.reduce(own, axis=0)
        self.sorted, self.before = [], []
        for d in range(dims):
            order = np.argsort(self.entries[:, d], kind="stable")
            self.sorted.append(self.entries[order, d])
            self.before.append(np.concatenate([np.zeros((1, words), np.uint64), np.bitwise_or.accumulate(own[order], axis=0)]))

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row of ``x``: the entries that differ by ``radius`` at most in every dimension, as bits."""
        masks = np.tile(self.all, (len(x), 1))
        for d, (places, before) in enumerate(zip(self.sorted, self.before)):
            low = np.searchsorted(places, x[:, d] - radius, "left")
            high = np.searchsorted(places, x[:, d] + radius, "right")
            masks &= before[high] ^ before[low]
        return masks

    def closest(self, x: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of each row's candidates, the lowest of several, and its squared distance (-1 if there is none)."""
        best, far = np.zeros(len(x), np.int64), np.full(len(x), -1, np.int64)
        for e, entry in enumerate(self.entries):
            rows = np.flatnonzero(masks[:, e // 64] >> np.uint64(e % 64) & np.uint64(1))
            gap = x[rows] - entry
            distance = np.einsum("ij,ij->i", gap, gap)
            nearer = (far[rows] < 0) | (distance < far[rows])
            best[rows[nearer]], far[rows[nearer]] = e, distance[nearer]
        return best, far

    def nearest(self, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for each row of ``x``, exact for any first ``radius``."""
        entry, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        rows, reach = np.arange(len(x)), np.full(len(x), max(1, radius), np.int64)
        while len(rows):
            best, far = self.closest(x[rows], self.candidates(x[rows], reach))
            done = (far >= 0) & (far <= reach * reach)
            entry[rows[done]], distance[rows[done]] = best[done], far[done]
            # what was found bounds the nearest one; else the box doubles
            wider = np.where(far >= 0, np.ceil(np.sqrt(np.maximum(far, 0).astype(np.float64))).astype(np.int64) + 1, 2 * reach)
            rows, reach = rows[~done], wider[~done]
        return entry, distance


def first_radius(book: np.ndarray) -> int:
    """Half of the root mean squared distance between the entries of a part position, where most rows' nearest entry is."""
    spread = float(((book - book.mean(axis=0)) ** 2).sum(axis=1).mean()) * 2
    return int(np.sqrt(spread) / 2)


def assign(books: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries and squared distances (rows x parts) of ``vectors`` by codebooks (parts x entries x width)."""
    parts, _, width = books.shape
    entry, distance = np.zeros((len(vectors), parts), np.int64), np.zeros((len(vectors), parts), np.int64)
    for p in range(parts):
        entry[:, p], distance[:, p] = Slices(books[p]).nearest(vectors[:, p * width:(p + 1) * width], first_radius(books[p]))
    return entry, distance


def matrices(vectors: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """A column of integer lists of length ``dims`` as matrices of SLICE rows at most."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
    yield from (flat[a:a + SLICE] for a in range(0, len(flat), SLICE))


def entry_sums(books: np.ndarray, dims: int) -> Callable:
    """For mapInArrow over (v): (part, entry, n, sums) of the parts that fall to each entry, summed within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for x in matrices(batch.column("v"), dims):
                entry, _ = assign(books, x)
                for p in range(parts):
                    n[p] += np.bincount(entry[:, p], minlength=entries)
                    np.add.at(sums[p], entry[:, p], x[:, p * width:(p + 1) * width])
        p, e = np.nonzero(n)
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return run


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """``vectors`` without rows whose vector is null, empty or holds null or non-finite components; adds __v, the components as integers."""
    x = F.col(f"`{column}`")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole_number = lambda c: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), c.cast("double") * SCALE))).cast("int")
    return vectors.filter(x.isNotNull() & (F.size(x) > 0) & ~odd).withColumn("__v", F.transform(x, whole_number))


def train(rows: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width) from ``rows`` (id, v). A round is one pass whose tasks return a sum per part and entry, so
    the driver gets parts x entries rows whatever the table. Fewer rows than ``entries`` make fewer entries."""
    first = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(entry_sums(books, dims), "part int, entry int, n long, sums array<long>")
        total = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims // parts)]).alias("sums"))
        for r in total.collect():
            books[r["part"], r["entry"]] = np.array(r["sums"], np.int64) // r["n"]
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, column: str = "embedding", id_column: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
                   rounds: int = ROUNDS) -> tuple[DataFrame, str, np.ndarray]:
    """The usable rows of ``vectors`` with one struct column (its name is returned): code, error, label_error; and the codebooks.

    Null vectors, empty ones and those with null or non-finite components are dropped, and so are vectors of another length than most have
    (of equally frequent lengths the shorter one counts). A length that ``parts`` does not divide is filled up with zeros, which changes no distance. Components
    beyond 16384 count as 16384. Rows without id come last among the first codebook's; of a repeated id the smaller vector comes first.
    Repeated rows are rows like others. Null labels make one group. label_error is null if it leaves 64 bits. Empty tables give empty tables."""
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries, as two hex digits can say")
    ship(vectors.sparkSession)
    name = free_name(vectors, "codes")
    good = usable(vectors, column)
    rows = scratch_table(good.select(F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("row"), F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col("__v").alias("v")))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    size = common["d"] if common else parts
    dims = -(-size // parts) * parts
    rows = rows.filter(F.size("v") == size).withColumn("v", F.concat("v", F.array_repeat(F.lit(0), dims - size)))
    books = train(rows, dims, parts, entries, rounds)

    @F.arrow_udf("code string, error long")
    def coded(v: pa.Array) -> pa.Array:
        hexes, errors = [pa.array([], pa.string())], [np.zeros(0, np.int64)]
        for x in matrices(v, dims):
            entry, distance = assign(books, x)
            digits = entry.astype(np.uint8).tobytes().hex()
            hexes.append(pa.array([digits[k:k + 2 * parts] for k in range(0, len(digits), 2 * parts)], pa.string()))
            errors.append(distance.sum(axis=1))
        return pa.StructArray.from_arrays([pa.concat_arrays(hexes), pa.array(np.concatenate(errors), pa.int64())], ["code", "error"])

    out = scratch_table(rows.select("row", "label", coded("v").alias("c")))
    per = settle(out.groupBy("label").agg(F.try_sum("c.error").alias("label_error")).withColumnRenamed("label", "of"))
    joined = out.join(sized(per), F.col("label").eqNullSafe(F.col("of")))
    return joined.select("row.*", F.struct("c.code", "c.error", "label_error").alias(name)), name, books
