"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Text a task looks at together in numpy; arrays derived from it are up to a few dozen times larger.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, every other letter left alone."""
    return F.translate(col, UPPER, LOWER)


def crc_remainder(col: Column, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``."""
    return F.crc32(col.cast("string").cast("binary")) % modulus


def staged(df: DataFrame, name: str, compression: str = "none") -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor rereads the files, it never computes the
    steps before them again.  Hashes don't compress, and a codec's buffers outside
    the heap add up over many small tasks, so by default there is none.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a ``staged`` frame that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps that nothing refers to any more.

    Its cleaner follows the garbage collector, which a driver with little to do seldom runs.
    """
    gc.collect()  # drops the driver's handles of finished frames, then the JVM drops what they held
    for _ in range(2):
        spark.sparkContext._jvm.java.lang.System.gc()
        time.sleep(0.3)


def release_memory() -> None:
    """Give freed memory back to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


#: What modules keep in a worker from task to task, by module.
kept: dict[str, dict] = {}


def drop_kept(owner: str | None) -> None:
    """Empty what other modules than ``owner`` keep in this worker, which now does other work."""
    others = [cache for name, cache in kept.items() if name != owner and cache]
    for cache in others:
        cache.clear()
    if others:
        release_memory()


def tidy(run: Callable, owner: str | None = None) -> Callable:
    """A function of batches that gives its memory back at the end, but for what ``owner`` keeps."""

    def tidied(batches):
        drop_kept(owner)
        yield from run(batches)
        release_memory()

    return tidied


def tidy_group(function: Callable) -> Callable:
    """The same for a function of one group's table."""

    def tidied(table):
        drop_kept(None)
        made = function(table)
        release_memory()
        return made

    return tidied


def tidy_cogroup(function: Callable) -> Callable:
    """The same for a function of one group's two tables."""

    def tidied(table, other):
        drop_kept(None)
        made = function(table, other)
        release_memory()
        return made

    return tidied


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """UTF-8 bytes of consecutive rows, at most ``limit`` bytes unless one text is longer.

    Yields (first row, row after the last, bytes, offsets into them: rows + 1);
    a null is an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words_in(data: np.ndarray, solid: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text of each) of the runs of bytes where ``solid`` holds, in texts ``data[at[i]:at[i + 1]]``."""
    edge = at[:-1][at[:-1] < at[1:]]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    first[edge] = solid[edge]
    last[edge[1:] - 1] = solid[edge[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts[i]:ends[i]]``: one step for each place, over the words that long."""
    letters = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    hashes = np.zeros(len(starts), np.uint64)
    long = (ends - starts) > 64
    live = np.flatnonzero(~long)
    spot = starts[live].copy()
    while len(live):
        step = (hashes[live] ^ letters[data[spot]]) * np.uint64(0x9FB21C651E98DF25)
        hashes[live] = step ^ (step >> np.uint64(29))
        spot += 1
        more = spot < ends[live]
        live, spot = live[more], spot[more]
    for i in np.flatnonzero(long):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mix64(hashes ^ (ends - starts).astype(np.uint64))


def mapped(
    docs: DataFrame,
    added: str,
    function: Callable[[Iterator[pa.StructArray]], Iterator[tuple[pa.StructArray, list[pa.Array]]]],
    owner: str | None = None,
) -> DataFrame:
    """Rows of ``docs`` as struct column ``doc``, with the columns ``added`` (DDL) that ``function`` makes in Arrow batches.

    The input keeps its own column names inside ``doc``, so none can clash with an added one.
    """
    wrapped = docs.select(F.struct("*").alias("doc"))
    schema = T.StructType([T.StructField("doc", wrapped.schema["doc"].dataType, False), *T.StructType.fromDDL(added)])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, arrays in function(b.column(0) for b in batches):
            yield pa.RecordBatch.from_arrays([rows, *arrays], names)

    return wrapped.mapInArrow(tidy(run, owner), schema)
