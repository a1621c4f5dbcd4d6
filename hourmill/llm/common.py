"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one is set only where a local session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows from a table written in the shared folder: later steps neither repeat the work nor lose it."""
    return _written(df, new_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that serve one step only: they go as the block ends, so nothing returned from it may read them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, new_path(spark, "scratch")

    def __enter__(self) -> Scratch:
        return self

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        return _written(df, f"{self.path}/{name}-{uuid.uuid4().hex}")

    def __exit__(self, *_) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def packed(text: Column) -> Column:
    """The text compressed, for a shuffle of whole texts."""

    @F.arrow_udf("binary")
    def pack(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compress = zstandard.ZstdCompressor(3).compress
        for texts in parts:
            yield pa.array([None if t is None else compress(t) for t in utf8(texts)], pa.binary())

    return pack(text)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def identity(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """What tells rows apart: the document's number (null: below all) and a hash of number and text."""
    number = F.coalesce(quoted(doc_id).cast("long"), F.lit(-(1 << 63)).cast("long"))
    return number.alias("d"), F.xxhash64(quoted(doc_id).isNull(), F.coalesce(quoted(text), F.lit(""))).alias("h")


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    LIMIT = 1 << 19

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SLICE = 1 << 18
_LONG_WORD = 128
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9FB21C651E98DF25  # odd, so that it has an inverse
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse from 0 to ``n`` at least, wrapping at 64 bits."""
    size = max(2 * _SLICE, 1 << n.bit_length()) + 1
    if size not in _POWERS:
        both = np.array([_BASE, pow(_BASE, -1, 1 << 64)], np.uint64)
        steps = np.repeat(both[:, None], size, axis=1)
        steps[:, 0] = 1
        up, down = np.multiply.accumulate(steps, axis=1)
        if size > 2 * _SLICE + 1:  # only a word longer than a slice needs more: not kept
            return up, down
        _POWERS[size] = up, down
    return _POWERS[size]


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``_SLICE`` bytes, cut at white space only."""
    start = 0
    while len(text) - start > _SLICE:
        cut = next((i for i in range(start + _SLICE, len(text)) if _SPACE[text[i]]), len(text))
        yield text[start:cut]
        start = cut
    yield text[start:]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, white space being the bytes 0x20 and 0x09 to 0x0D.

    A word's hash is a polynomial over values of its bytes, taken from running sums
    of the whole text, so that no word becomes an object of its own. Long words, whose
    polynomials can be made to meet, are hashed by themselves.
    """
    found = []
    for part in _slices(text):
        raw = np.frombuffer(part, np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        np.logical_not(_SPACE[raw], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        up, down = _powers(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[raw] * up[: len(raw)], out=sums[1:])
        starts, ends = edges[::2], edges[1::2]
        hashes = mixed((sums[ends] - sums[starts]) * down[starts])
        for i in np.flatnonzero(ends - starts > _LONG_WORD):
            hashes[i] = xxhash.xxh3_64_intdigest(part[starts[i] : ends[i]])
        found.append(hashes)
    return found[0] if len(found) == 1 else np.concatenate(found)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` word hashes; none if there are fewer words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for i in range(1, n):
        total = mixed(total) + hashes[i : i + count]
    return mixed(total)


def give_back() -> None:
    """Free memory of this worker returns to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def let_go() -> None:
    """What tokenising tasks remember for each other goes, in a worker that turns to other work."""
    if vars(sys).pop("_llm_token_pieces", None):
        give_back()


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches, before which a reused worker lets go of tokens and after which it keeps no memory of its task."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        let_go()
        yield from run(batches)
        give_back()

    return whole


def chunks(texts: list, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``size`` characters together, so that word lists stay small."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text) if text else 0
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """Texts of a column as UTF-8, one after another, so that a batch is not held a second time."""
    for text in column:
        yield text.as_buffer().to_pybytes() if text.is_valid else None


def table_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    arrays = [batch.column(batch.schema.get_field_index(k)) for k in keep] + list(new.values())
    return pa.RecordBatch.from_arrays(arrays, names=[*keep, *new])
