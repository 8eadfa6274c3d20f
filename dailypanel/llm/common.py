"""Small helpers the text operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.session import ensure_checkpoint_dir

#: Words of a text: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "dailypanel_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="dailypanel-")) / "dailypanel_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context.dailypanel_shipped = True


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, so that several readers don't compute it again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_table(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder: readers of a few columns read only these."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer form of it that no column of ``df`` has (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def folded(docs: DataFrame, *more: str) -> DataFrame:
    """``row``, all columns but text as one struct, beside doc_id, text and ``more``: no name of an operator's own can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("row"), "doc_id", "text", *more)


def unfolded(df: DataFrame, docs: DataFrame, *more) -> DataFrame:
    """The columns of ``docs`` in their order, and ``more``."""
    return df.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns], *more)


def whole(text: Column) -> Column:
    """A null text is an empty one."""
    return F.coalesce(text, F.lit(""))


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces whose texts hold about ``size`` bytes at most, or one row: bounds a task's memory."""
    for batch in batches:
        if batch.num_rows:
            total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            part = total // size
            edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
            yield from (batch.slice(a, b - a) for a, b in zip(edges[:-1], edges[1:]))


def batch_of(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    """Arrays as a batch of exactly this schema, whatever types a small or empty slice has led to."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of a batch of texts as dictionary codes, and the offset of each text's first word (one more at the end)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, starts = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        kept = np.concatenate([[0], np.cumsum(full)])
        starts, flat = kept[starts], flat.filter(pa.array(full))
    return flat.dictionary_encode(), starts


def word_hashes(words: pa.DictionaryArray) -> np.ndarray:
    """64 bits per word, the same in every process."""
    import xxhash

    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in words.dictionary.cast(pa.large_binary())), np.uint64, len(words.dictionary))
    return distinct[words.indices.to_numpy()] if len(distinct) else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words and their offsets; a text of fewer words is one run, one without words has none."""
    lengths = np.diff(starts)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - n + 1, 1))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(offsets[-1]) + np.repeat(starts[:-1] - offsets[:-1], counts)
    room = np.repeat(starts[1:], counts)
    out = np.full(len(at), np.uint64(0x9E3779B97F4A7C15))
    for k in range(n):
        inside = at + k < room
        step = np.where(inside, words[np.minimum(at + k, len(words) - 1)] if len(words) else 0, np.uint64(0))
        out = out * np.uint64(0x100000001B3) + step
    return mix64(out), offsets
