"""SentencePiece encoding and decoding by Viterbi over piece scores.

The best segmentation is the one with the largest sum of piece scores; among equal ones the piece that starts first wins at every
boundary. Characters without a piece become byte pieces. ``StreamingViterbi`` reads characters and keeps a window of
the longest piece: as soon as all surviving paths go through one boundary, the ids up to it are committed. Where no piece crosses a space,
such a boundary is known before every space; the texts of a batch are cut there, and the distinct parts are run
side by side in numpy, each to its end, where all paths meet.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.llm.common import free_name, ship, whole

SPACE = "▁"
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Parts are run side by side in columns of these lengths; longer ones are read by the streaming form one by one.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 48)
#: Parts that are read side by side.
LANES = 32_768
UNKNOWN_PENALTY = 10.0


class Pieces:
    """The pieces of a model: plain data that is broadcast once (its size is that of the vocabulary)."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        """kinds: "normal", "byte" or "other" for each id."""
        self.pieces = pieces
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "byte"}
        self.byte_values = {i: b for b, i in self.bytes.items()}
        self.ids = {}
        self.score = np.array(scores, np.float64)
        for i, (p, k) in enumerate(zip(pieces, kinds)):
            if k == "normal" and p:
                self.ids[p] = i
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = (min((scores[i] for p, i in self.ids.items()), default=0.0)) - UNKNOWN_PENALTY
        #: No piece has a space behind another character, so every path has a boundary there.
        self.cuts_at_spaces = SPACE in self.ids and not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.text = [bytes([self.byte_values[i]]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "normal" else b"" for i, (p, k) in enumerate(zip(pieces, kinds))]
        self.ascii = np.array([self.bytes.get(b, 0) for b in range(128)] + [-1], np.int32)
        if not self.bytes:
            self.ascii[:] = -1
        self.tables = self._tables()

    def _tables(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Hash tables without collisions inside each: (shift, keys, ids)."""
        keys = np.array([hash_code(p) for p in self.ids], np.uint64)
        ids = np.fromiter(self.ids.values(), np.int32, len(self.ids))
        if len(set(keys.tolist())) != len(keys):
            raise ValueError("two pieces have the same hash")
        tables, bits = [], max(8, int(np.ceil(np.log2(len(keys) + 1))) + 3)
        while len(keys):
            slot = (spread(keys, len(tables)) >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            held, found = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            held[slot[first]], found[slot[first]] = keys[first], ids[first]
            tables.append((64 - bits, held, found))
            rest = np.setdiff1d(np.arange(len(keys)), first)
            keys, ids = keys[rest], ids[rest]
        return tables

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where hash codes are those of pieces, and the ids of these."""
        at, ids = [], []
        for k, (shift, held, found) in enumerate(self.tables):
            slot = (spread(keys, k) >> np.uint64(shift)).astype(np.int64)
            hit = np.flatnonzero(held[slot] == keys)
            at.append(hit)
            ids.append(found[slot[hit]])
        return np.concatenate(at), np.concatenate(ids)

    def unknown_ids(self, char: str) -> list[int]:
        """Byte pieces for a character, or id 0 if the model has none."""
        raw = char.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if all(b in self.bytes for b in raw) else [0]


def spread(keys: np.ndarray, turn: int) -> np.ndarray:
    return keys * np.uint64((2 * (0x51ED270B2F3A91C5 + 0x9E3779B97F4A7C1 * turn) + 1) % 2 ** 64)


def hash_code(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(FACTOR) + ord(c) + 1) % 2 ** 64
    return h


@lru_cache(maxsize=4)
def load(model_file: str) -> Pieces:
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = range(p.get_piece_size())
    kinds = ["byte" if p.is_byte(i) else "other" if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) else "normal" for i in n]
    return Pieces([p.id_to_piece(i) for i in n], [p.get_score(i) for i in n], kinds)


class StreamingViterbi:
    """Feed characters, get committed ids. It holds one column per character of the window and those not yet committed."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.text = ""  # from the last committed boundary on
        self.best = [0.0]
        self.back: list[tuple[int, int]] = [(0, -1)]  # length and id of the last piece of the best path to each boundary

    def feed(self, chars: str) -> list[int]:
        out: list[int] = []
        for c in chars:
            self.text += c
            end = len(self.text)
            top, back = -np.inf, (0, -1)
            for start in range(max(0, end - self.p.longest), end):
                i = self.p.ids.get(self.text[start:end], -1)
                gain = self.p.score[i] if i >= 0 else self.p.unknown if start == end - 1 else None
                if gain is not None and self.best[start] + gain > top:
                    top, back = self.best[start] + gain, (end - start, i)
            self.best.append(top)
            self.back.append(back)
            if end > self.p.longest:
                out += self._commit()
        return out

    def _commit(self) -> list[int]:
        """The ids up to the last boundary that lies on the path of every boundary at which a later piece can start."""
        at = set(range(len(self.text) - self.p.longest + 1, len(self.text) + 1))
        while len(at) > 1:
            last = max(at)
            at.remove(last)
            at.add(last - self.back[last][0])
        meet = at.pop()
        return self._take(meet) if meet else []

    def _take(self, end: int) -> list[int]:
        out, at = [], end
        while at:
            length, i = self.back[at]
            out.append([i] if i >= 0 else self.p.unknown_ids(self.text[at - 1]))
            at -= length
        base = self.best[end]
        self.text, self.best, self.back = self.text[end:], [b - base for b in self.best[end:]], self.back[end:]
        self.back[0] = (0, -1)
        return [i for ids in reversed(out) for i in ids]

    def finish(self) -> list[int]:
        return self._take(len(self.text))


def encode_stream(p: Pieces, text: str) -> list[int]:
    """Ids of one text."""
    reader = StreamingViterbi(p)
    return reader.feed(SPACE + text.replace(" ", SPACE)) + reader.finish() if text else []


def _lanes(lengths: np.ndarray):
    """Parts of about one length that are read side by side, ``LANES`` at most, and the longest they can be."""
    for low, n in zip((0, *WIDTHS), WIDTHS):
        rows = np.flatnonzero((lengths > low) & (lengths <= n))
        yield from ((rows[k:k + LANES], n) for k in range(0, len(rows), LANES))


def encode_parts(p: Pieces, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of parts that begin and end at certain boundaries, one after another, and the offset of each part's."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    counts, blocks = np.zeros(len(parts), np.int64), []
    for r in np.flatnonzero(lengths > WIDTHS[-1]):
        reader = StreamingViterbi(p)
        ids = np.array(reader.feed(parts[r]) + reader.finish(), np.int32)
        counts[r] = len(ids)
        blocks.append((np.array([r]), ids))
    for rows, n in _lanes(lengths):
        # one column per part, filled up with a character that no piece has
        joined = "".join([parts[r].ljust(n, "\0") for r in rows]).encode("utf-32-le", "surrogatepass")
        chars = np.ascontiguousarray(np.frombuffer(joined, np.uint32).reshape(len(rows), n).T).astype(np.uint64)
        best = np.full((n + 1, len(rows)), -np.inf)
        best[0] = 0
        back, ids = np.ones((n + 1, len(rows)), np.int8), np.full((n + 1, len(rows)), -1, np.int32)
        for s in range(n):
            key = np.zeros(len(rows), np.uint64)
            for w in range(1, min(p.longest, n - s) + 1):
                key = key * FACTOR + chars[s + w - 1] + np.uint64(1)
                hit, found = p.find(key)
                if w == 1:  # a lone character can always end here
                    total = np.full(len(rows), best[s] + p.unknown)
                    total[hit] = best[s][hit] + p.score[found]
                    better = total > best[s + 1]
                    best[s + 1][better], back[s + 1][better], ids[s + 1][better] = total[better], 1, -1
                    better = better[hit]
                else:
                    total = best[s][hit] + p.score[found]
                    better = total > best[s + w][hit]
                    best[s + w][hit[better]], back[s + w][hit[better]] = total[better], w
                ids[s + w][hit[better]] = found[better]
        lanes, at = np.arange(len(rows)), lengths[rows].copy()
        taken, valid = np.full((n, len(rows)), -2, np.int32), np.zeros((n, len(rows)), bool)
        odd = np.zeros(len(rows), bool)
        while len(lanes):
            i = ids[at, lanes]
            alone = i < 0  # a character that no piece has; one byte of ASCII has one id
            i[alone] = p.ascii[np.minimum(chars[at[alone] - 1, lanes[alone]], np.uint64(128))]
            taken[at - 1, lanes], valid[at - 1, lanes] = i, True
            odd[lanes[i < 0]] = True
            at = at - back[at, lanes]
            lanes, at = lanes[at > 0], at[at > 0]
        for lane in np.flatnonzero(odd):  # characters that no piece has: as many ids as bytes
            text = parts[rows[lane]]
            flat = [x for k in np.flatnonzero(valid[:, lane]) for x in ([int(taken[k, lane])] if taken[k, lane] >= 0 else p.unknown_ids(text[k]))]
            counts[rows[lane]] = len(flat)
            blocks.append((rows[lane:lane + 1], np.array(flat, np.int32)))
        plain = np.flatnonzero(~odd)
        counts[rows[plain]] = valid[:, plain].sum(0)
        blocks.append((rows[plain], taken[:, plain].T[valid[:, plain].T]))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(offsets[-1], np.int32)
    for rows, ids in blocks:
        out[spans(offsets[rows], counts[rows])] = ids
    return out, offsets


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and its count."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def encode_batch(p: Pieces, texts: pa.Array) -> pa.Array:
    """A list of ids for each text; a null text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not p.cuts_at_spaces:
        return pa.array([encode_stream(p, t) for t in texts.to_pylist()], pa.list_(pa.int32()))
    own = pc.match_substring(texts, SPACE)
    if pc.any(own).as_py():  # texts that hold the mark of a space themselves are read one by one
        rest = encode_batch(p, pc.if_else(own, "", texts)).to_pylist()
        return pa.array([encode_stream(p, t) if o else r for t, o, r in zip(texts.to_pylist(), own.to_pylist(), rest)], pa.list_(pa.int32()))
    if pc.any(pc.match_substring_regex(texts, "^ |  ")).as_py():  # a run of spaces belongs to the word after it
        mark = next(m for m in map(chr, range(0xE000, 0xF8FF)) if not pc.any(pc.match_substring(texts, m)).as_py())
        lists = pc.split_pattern(pc.replace_substring_regex(pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in (" ", texts, ""))), "([^ ]) ", rf"\1{mark} "), mark)
        parts = lists.flatten().dictionary_encode()
        distinct = [w.replace(" ", SPACE) for w in parts.dictionary.to_pylist()]
    else:
        lists = pc.split_pattern(texts, " ")
        parts = lists.flatten().dictionary_encode()
        distinct = [SPACE + w for w in parts.dictionary.to_pylist()]
    ids, offsets = encode_parts(p, distinct)
    codes = parts.indices.to_numpy()
    counts = np.diff(offsets)[codes] if len(codes) else np.zeros(0, np.int64)
    flat = ids[spans(offsets[:-1][codes], counts)] if len(codes) else np.zeros(0, np.int32)
    ends = np.concatenate([[0], np.cumsum(counts)])
    at = lists.offsets.to_numpy().astype(np.int64)
    starts = ends[at - at[0]]
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    if empty.any():
        sizes = np.diff(starts)
        flat = flat[np.repeat(~empty, sizes)]
        starts = np.concatenate([[0], np.cumsum(np.where(empty, 0, sizes))])
    return pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(flat))


@lru_cache(maxsize=2)
def _flat_texts(p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(b) for b in p.text])])
    return np.frombuffer(b"".join(p.text), np.uint8), ends


def decode_batch(p: Pieces, ids: pa.Array) -> pa.Array:
    """The texts of lists of ids, without the space that encoding puts in front. Bytes that aren't UTF-8 become U+FFFD."""
    raw, ends = _flat_texts(p)
    flat, at = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ids.offsets.to_numpy().astype(np.int64)
    sizes = (ends[1:] - ends[:-1])[flat] if len(flat) else np.zeros(0, np.int64)
    data = raw[spans(ends[:-1][flat], sizes)] if len(flat) else np.zeros(0, np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])[at - at[0]]
    whole_bytes = data.tobytes()
    texts = [whole_bytes[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(starts[:-1], starts[1:])]
    return pa.array(texts, pa.string())


def in_pieces(texts: pa.Array, size: int = 2_000_000):
    """Slices of about ``size`` bytes of text, so that a task's memory doesn't grow with its batch."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(total[1:] != total[:-1]) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def broadcast_pieces(spark: SparkSession, model_file: str) -> Broadcast:
    return spark.sparkContext.broadcast(load(model_file))


def encode(text: Column, pieces: Broadcast) -> Column:
    """array<int> of a text's ids; null and empty texts have none."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        parts = [encode_batch(pieces.value, t) for t in in_pieces(texts)]
        return pa.concat_arrays(parts) if len(parts) > 1 else parts[0]

    return ids.asNondeterministic()(text)


def decode(ids: Column, pieces: Broadcast) -> Column:
    """The text of an array of ids."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        return decode_batch(pieces.value, lists)

    return texts.asNondeterministic()(ids)


def encode_documents(docs: DataFrame, model_file: str) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): ids, and whether decoding them gives the text back, byte for byte.

    Null texts count as empty ones, which have no ids; repeated rows are encoded alike; other columns stay as they are."""
    ship(docs.sparkSession)
    pieces = broadcast_pieces(docs.sparkSession, model_file)
    name = free_name(docs, "pieces")

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def both(texts: pa.Array) -> pa.Array:
        parts, same = [], []
        for t in in_pieces(texts):
            parts.append(encode_batch(pieces.value, t))
            same.append(pc.equal(decode_batch(pieces.value, parts[-1]).cast(pa.large_string()), pc.fill_null(t.cast(pa.large_string()), "")))
            pa.default_memory_pool().release_unused()  # what earlier slices, and earlier stages of this worker, have left
        ids, same = (pa.concat_arrays(x) if len(x) > 1 else x[0] for x in (parts, same))
        return pa.StructArray.from_arrays([ids, same], ["ids", "round_trip"])

    return docs.withColumn(name, both.asNondeterministic()(whole(F.col("text")))), name
