"""Substring dedup with FM-indexes: windows of words that start anywhere else are removed.

Equal windows have the same minimizer, the smallest hash of a run of ``GRAM`` words in them, so a text's windows are dealt to shards by
minimizer, in pieces that overlap as little as they can. Each shard gets an FM-index of its distinct pieces: the Burrows-Wheeler transform of their
words in a wavelet matrix of plain bits with counts per 64. The pieces are then streamed through it: backward search extends a match to the left while
it has two or more places, which gives the matching statistics, and windows inside matches of the window's length are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import mix64, scratch_table, settle, ship, slices, split_words, text_key, whole, word_hashes
from dailypanel.llm.ngram_join import groups

WINDOW = 35
GRAM = 8
#: A minimizer with more pieces than this has its windows dealt one by one, by their own hash.
HOT = 4096
#: Words of a shard, about.
SHARD_WORDS = 1_000_000


#: Words to the right of a match's left border at which trials begin.
TRIALS = np.array([1, 3, 9])


class FMIndex:
    """Backward search over sequences of codes (0 ends a sequence). Exact for patterns of up to ``depth`` codes."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.n = n
        order = self._suffixes(text.astype(np.int64), depth)
        last = text[order - 1].astype(np.uint32)  # the code before each suffix; the text is a circle
        self.levels = max(1, int(text.max()).bit_length()) if n else 1
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.levels))])
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (last >> np.uint32(level)) & np.uint32(1)
            words = np.packbits(np.pad(bit.astype(np.uint8), (0, -n % 64 + 64)), bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int32))
            self.zeros.append(int(n - bit.sum()))
            last = np.concatenate([last[bit == 0], last[bit == 1]])

    @staticmethod
    def _suffixes(text: np.ndarray, depth: int) -> np.ndarray:
        """Positions in the order of their first ``depth`` codes, by doubling; only ties are sorted again."""
        n = len(text)
        _, rank = np.unique(text, return_inverse=True)
        rank, order, width = rank.astype(np.int64), None, 1
        while True:
            following = rank[(np.arange(n) + width) % n]
            key = rank * (n + 1) + following
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            width *= 2
            if width >= depth or rank[order[-1]] == n - 1:
                return order

    def _rank(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones before ``at`` in level k."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[k][word] + np.bitwise_count(self.bits[k][word] & below)

    def extend(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``code`` followed by what the intervals stand for."""
        start = np.zeros(len(code), np.int64)  # where the level's block of the code so far begins
        for k in range(self.levels):
            one = (code >> (self.levels - 1 - k)) & 1 == 1
            a, b, c = self._rank(k, low), self._rank(k, high), self._rank(k, start)
            z = self.zeros[k]
            low, high, start = np.where(one, z + a, low - a), np.where(one, z + b, high - b), np.where(one, z + c, start - c)
        first = self.starts[code]
        return first + low - start, first + high - start


def repeated_windows(pieces: list[np.ndarray], asked: np.ndarray, window: int) -> np.ndarray:
    """For each piece (codes from 1) a number whose bit i says that the window from word i on stands more than once in the pieces. Only
    pieces that are ``asked`` for are streamed; the others have 0."""
    masks = np.zeros(len(pieces), np.uint64)
    if not asked.any():
        return masks
    sizes = np.array([len(p) for p in pieces])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.zeros(int(sizes.sum() + len(sizes)), np.int64)
    keep = np.ones(len(text), bool)
    keep[begins + sizes] = False
    text[keep] = np.concatenate(pieces)
    index = FMIndex(text, window)
    lane = np.flatnonzero(asked)
    base = begins[lane]
    # end: last word of the match that is tried; at: the next word to its left; far: the last end that is left; goal: where a short trial
    # stops (-1: no trial). After a match has ended at a word, short trials around this word soon show how much cannot be in any match.
    end = sizes[lane] - 1
    far, goal, step = end.copy(), np.full(len(lane), -1), np.zeros(len(lane), np.int64)
    first = text[base + end]
    low, high, at = index.starts[first], index.starts[first + 1], end - 1
    while len(lane):
        few = high - low < 2  # [at + 1, end] stands once only
        reached = ~few & (goal >= 0) & (at < goal)
        failed = few | ((at < 0) & (goal < 0))
        k = np.flatnonzero(~failed & ~reached)
        if len(k):
            low[k], high[k] = index.extend(text[base[k] + at[k]], low[k], high[k])
            at[k] -= 1
            if len(k) == len(lane):
                continue
        k = np.flatnonzero(failed & (goal < 0))
        if len(k):
            # the match is [left + 1, end]: its windows are repeated; others begin at left or before and end before end
            left = np.where(few[k], at[k] + 1, -1)
            for j, a, b in zip(lane[k], left + 1, end[k] - window + 1):
                if b >= a:
                    masks[j] |= np.uint64((1 << int(b) + 1) - (1 << int(a)))
            far[k] = np.minimum(left + window - 1, end[k] - 1)
            step[k] = 0
            short = (left >= 0) & (left + TRIALS[0] < far[k])
            goal[k], end[k] = np.where(short, left, -1), np.where(short, left + TRIALS[0], far[k])
        k2 = np.flatnonzero(failed & (goal >= 0) & few) if not len(k) else np.setdiff1d(np.flatnonzero(few & (goal >= 0)), k)
        if len(k2):  # a trial that failed: no window that is left reaches its end
            far[k2] = end[k2] - 1
            end[k2], goal[k2] = far[k2], -1
        k3 = np.flatnonzero(reached)
        if len(k3):  # a trial that says nothing: try a longer one, or else all
            step[k3] += 1
            ends = goal[k3] + TRIALS[np.minimum(step[k3], len(TRIALS) - 1)]
            more = (step[k3] < len(TRIALS)) & (ends < far[k3])
            end[k3], goal[k3] = np.where(more, ends, far[k3]), np.where(more, goal[k3], -1)
        k = np.concatenate([k, k2, k3])
        k = k[end[k] >= 0]
        c = text[base[k] + end[k]]
        low[k], high[k], at[k] = index.starts[c], index.starts[c + 1], end[k] - 1
        done = far < window - 1
        if done.any():
            stay = ~done
            lane, base, end, far, goal, step, low, high, at = (x[stay] for x in (lane, base, end, far, goal, step, low, high, at))
    return masks


def pieces_of(hashes: np.ndarray, starts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window's word, windows, minimizer) of the pieces of a batch of texts: runs of windows of one text that have their minimizer at the same
    place, so a piece has window - gram + 1 windows at most."""
    counts = np.maximum(np.diff(starts) - window + 1, 0)
    if not counts.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.full(len(hashes), np.uint64(0x243F6A8885A308D3))
    for k in range(gram):
        grams = grams * np.uint64(0x100000001B3) + np.concatenate([hashes[k:], np.zeros(k, np.uint64)])
    low, width = mix64(grams), window - gram + 1
    spot = np.arange(len(low))

    def smaller(by: int) -> None:
        """Every place takes the smallest of its grams and of those ``by`` words on; the left one of equals."""
        nonlocal low, spot
        other = np.concatenate([low[by:], np.full(by, np.iinfo(np.uint64).max)])
        there = np.concatenate([spot[by:], np.zeros(by, np.int64)])
        less = other < low
        low, spot = np.where(less, other, low), np.where(less, there, spot)

    size = 1
    while size * 2 <= width:
        smaller(size)
        size *= 2
    if width > size:
        smaller(width - size)
    at = np.arange(counts.sum()) + np.repeat(starts[:-1] - np.cumsum(counts) + counts, counts)
    place = spot[at]
    begin = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)]))
    return at[begin], np.diff(np.append(begin, len(at))), low[at[begin]]


def minimizers(window: int, gram: int):
    """For mapInArrow over (h1, text): h1, key, twice (the text has the minimizer in two or more pieces)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, starts = split_words(batch.column("text"))
            first, _, key = pieces_of(word_hashes(codes), starts, window, gram)
            owner = np.searchsorted(starts, first, side="right") - 1
            order = np.lexsort((key, owner))
            owner, key = owner[order], key[order]
            new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])])[: len(key)]
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(key)))
            h1 = batch.column("h1").to_numpy()[owner[at]]
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(key[at].view(np.int64)), pa.array((times > 1).astype(np.int32))], ["h1", "key", "twice"])

    return run


def cut_pieces(window: int, gram: int):
    """For mapInArrow over (h1, text, keys, hots): h1, first, windows, shard_key, s1, s2, words of the pieces whose minimizer is in keys. Pieces
    whose minimizer is in hots are cut into single windows, with their own hash as shard_key."""
    import xxhash

    schema = pa.schema([("h1", pa.int64()), ("first", pa.int64()), ("windows", pa.int32()), ("shard_key", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4_000_000):
            codes, starts = split_words(batch.column("text"))
            first, windows, key = pieces_of(word_hashes(codes), starts, window, gram)
            key = key.view(np.int64)
            owner = np.searchsorted(starts, first, side="right") - 1
            wanted, hot = np.zeros(len(key), bool), np.zeros(len(key), bool)
            edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            for name, out in (("keys", wanted), ("hots", hot)):
                lists = batch.column(name)
                flat, offs = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                for k in range(batch.num_rows):
                    a, b = edges[k], edges[k + 1]
                    if b > a and offs[k + 1] > offs[k]:
                        out[a:b] = np.isin(key[a:b], flat[offs[k]:offs[k + 1]])
            hot &= wanted
            plain = np.flatnonzero(wanted & ~hot)
            single = np.flatnonzero(hot)
            at = np.repeat(first[single], windows[single]) + (np.arange(windows[single].sum()) - np.repeat(np.cumsum(windows[single]) - windows[single], windows[single]))
            first_, windows_ = np.concatenate([first[plain], at]), np.concatenate([windows[plain], np.ones(len(at), np.int64)])
            owner_ = np.concatenate([owner[plain], np.repeat(owner[single], windows[single])])
            words = np.array(codes.dictionary.to_pylist(), object)
            index = codes.indices.to_numpy()
            texts = [" ".join(words[index[a:a + w + window - 1]]) for a, w in zip(first_, windows_)]
            ids = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts), np.int64).reshape(-1, 2)
            keys = np.concatenate([key[plain], ids[len(plain):, 0]])
            columns = [batch.column("h1").to_numpy()[owner_], first_ - starts[owner_], windows_.astype(np.int32), keys, ids[:, 0], ids[:, 1]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(texts, pa.string())], schema=schema)

    return run


def search_shards(window: int):
    """For mapInArrow over (shard, s1, s2, n, words) sorted by shard: s1, s2, mask (bit i: window i of the piece is repeated)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["shard"]):
            shard = table.column("shard").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
            for a, b in zip(edges[:-1], edges[1:]):
                part = table.slice(a, b - a)
                codes, starts = split_words(part.column("words").combine_chunks())
                flat = codes.indices.to_numpy().astype(np.int64) + 1
                pieces = np.split(flat, starts[1:-1])
                n, size = part.column("n").to_numpy(), np.diff(starts) - window + 1
                masks = np.where(n > 1, (np.uint64(1) << size.astype(np.uint64)) - np.uint64(1), np.uint64(0))
                masks |= repeated_windows(pieces, n == 1, window)
                yield pa.RecordBatch.from_arrays([part.column("s1").combine_chunks(), part.column("s2").combine_chunks(), pa.array(masks.view(np.int64))], ["s1", "s2", "mask"])

    return run


def remove_words(window: int):
    """For mapInArrow over (doc_id, text, copies, firsts, masks): doc_id, n_words, n_removed, kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids, counts, removed, kept = batch.column("doc_id"), [], [], []
            copies = batch.column("copies").to_numpy()
            for k in range(batch.num_rows):
                words = (batch.column("text")[k].as_py() or "").encode("utf-8", "surrogatepass").split()
                n = len(words)
                if copies[k] > 1 and n >= window:
                    words = []
                elif (firsts := batch.column("firsts")[k].as_py()):
                    gone = np.zeros(n + 1, np.int64)
                    for first, mask in zip(firsts, batch.column("masks")[k].as_py()):
                        mask &= (1 << 64) - 1
                        while mask:
                            bit = (mask & -mask).bit_length() - 1
                            gone[first + bit] += 1
                            gone[min(n, first + bit + window)] -= 1
                            mask &= mask - 1
                    stays = np.cumsum(gone[:-1]) == 0
                    words = [w for w, s in zip(words, stays) if s]
                counts.append(n)
                removed.append(n - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A word goes if a window of ``window`` words around it starts anywhere else, in the same text or another; windows are judged on
    the input. Null texts have no words; texts of fewer words than a window keep all; texts that stand in two rows lose every word if they have a window;
    null ids are kept as they are."""
    ship(docs.sparkSession)
    text = whole(F.col("text"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(text), text.alias("text"))
    copies = settle(keyed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies")))

    seen = keyed.select("h1", "text").mapInArrow(minimizers(window, gram), "h1 long, key long, twice int")
    # a minimizer matters if two different texts have it, or one text has it in two pieces
    keys = seen.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.max("twice").alias("twice"), F.count(F.lit(1)).alias("n"))
    keys = keys.filter("a <> b OR twice = 1").select("key", (F.col("n") > hot).alias("hot"))
    wanted = seen.select("h1", "key").join(keys, "key").groupBy("h1").agg(F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hots"))
    one = keyed.join(wanted, "h1")
    owner = keyed.groupBy("h1").agg(F.min(F.coalesce("doc_id", F.lit(0))).alias("own"))
    one = one.join(owner.withColumnRenamed("h1", "o1"), (F.col("h1") == F.col("o1")) & (F.coalesce("doc_id", F.lit(0)) == F.col("own")))
    places = scratch_table(one.select("h1", "text", "keys", "hots").mapInArrow(
        cut_pieces(window, gram), "h1 long, first long, windows int, shard_key long, s1 long, s2 long, words string"))

    distinct = places.groupBy("s1", "s2", "shard_key", "windows", "words").agg(F.count(F.lit(1)).alias("n"))
    total = places.agg(F.sum(F.col("windows") + window)).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("shard_key"), F.lit(shards))).select("shard", "s1", "s2", "n", "words")
    dealt = dealt.repartition(int(shards), "shard").sortWithinPartitions("shard")
    masks = dealt.mapInArrow(search_shards(window), "s1 long, s2 long, mask long").filter("mask <> 0")
    hits = places.select("h1", "first", "s1", "s2").join(masks, ["s1", "s2"])
    per_text = hits.groupBy("h1").agg(F.collect_list(F.struct("first", "mask")).alias("hits"))
    per_text = settle(per_text.select("h1", F.col("hits.first").alias("firsts"), F.col("hits.mask").alias("masks")))
    full = keyed.join(copies, ["h1", "h2"]).join(per_text, "h1", "left")
    return full.select("doc_id", "text", "copies", "firsts", "masks").mapInArrow(remove_words(window), "doc_id long, n_words long, n_removed long, kept string")
