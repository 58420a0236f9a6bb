"""Helpers of the text operators: bounded batches, hashed words, checkpoints."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Text bytes that one numpy step works on; a longer text is one step of its own.
STEP_BYTES = 1 << 20

_local_folder: str | None = None


def columns_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """Just the key and the text, so that no other column can clash with an operator's own."""
    return df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def in_fold(key: str, buckets: int, bucket: int) -> Column:
    """Whether crc32 of the key as text falls into one bucket; a null key is in none."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % buckets == bucket, F.lit(False))


def own_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a local master may leave it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="martkit-llm-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def cut(df: DataFrame) -> DataFrame:
    """Store a table in the shared folder and go on from there: the lineage ends, lost executors cost nothing."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and broadcasts of finished steps: its cleaner waits for the driver's garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# What a worker process keeps from task to task for the operator that ran last in it.
_kept: dict[object, object] = {}


def kept[T](key: object, make: Callable[[], T]) -> T:
    """One value per worker process, made on first use; that of another operator goes."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Free what operators before this one keep in the worker process: a worker is used again for other stages."""
    if _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """The table marked for broadcast if it has at most ``rows`` rows, which is counted; else as it is, to be shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def steps(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the next step."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, STEP_BYTES + (STEP_BYTES >> 3))
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            made.append(np.multiply.accumulate(a))
        _powers = (made[0], made[1])
    return _powers


class Words:
    """The words of several texts as arrays: start, end and hash of each, and the first word of each text.

    ``is_word`` says which bytes make up words (256 flags).  Texts are joined by line breaks, which must not be
    word bytes.  A hash depends on the word's bytes alone.
    """

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        self.data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        flags = np.zeros(len(raw) + 1, np.int8)
        flags[1:] = is_word[raw]
        turns = np.flatnonzero(np.diff(flags))
        self.start, self.end = turns[::2], turns[1::2]
        up, down = _base_powers(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[raw] * up[: len(raw)], out=sums[1:])
        self.hash = mixed((sums[self.end] - sums[self.start]) * down[self.start])
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths, out=bounds[1:])
        self.offset = bounds
        self.first = np.searchsorted(self.start, bounds)

    def windows(self, size: int) -> np.ndarray:
        """Hash of each run of ``size`` words; runs may span two texts."""
        n = max(0, len(self.hash) - size + 1)
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h *= np.uint64(0xD6E8FEB86659FD93)
            h += self.hash[k : k + n]
        return mixed(h)

    def word(self, i: int, j: int) -> tuple[bytes, ...]:
        """The words i to j (exclusive) themselves."""
        return tuple(self.data[self.start[k] : self.end[k]] for k in range(i, j))
