"""Packing documents into sequences of a fixed number of tokens (best-two-fit).

Sequences are filled one after the other: greedily with the longest piece that
fits, then the smallest piece in it gives way to two unpacked ones that fill the
widened gap more tightly, as long as such a pair exists. All decisions depend on
lengths only, so the plan is made on the number of pieces of each length (at most
one entry per possible length) and equal fillings are repeated at once. Every piece
then finds its place by its rank among pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, table_of
from .tokens import TOKENIZER, Encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, turn long"
_PIECES_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("turn", pa.int64()),
    ]
)


def cut_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: full ones, and before them the rest."""
    return [n % size] * (n % size > 0) + [size] * (n // size)


class _Pool:
    """Number of unpacked pieces by length."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64)

    def largest(self, most: int, used: dict[int, int]) -> int:
        """The longest length up to ``most`` with a piece left beyond those used; 0 if none."""
        fits = np.flatnonzero(self.counts[: most + 1])
        for length in fits[::-1].tolist():
            if self.counts[length] > used.get(length, 0):
                return length
        return 0

    def pair(self, room: int, above: int, used: dict[int, int]) -> tuple[int, int] | None:
        """Two unpacked pieces whose lengths sum to at most ``room`` and more than ``above``, as much as can be."""
        left = self.counts.copy()
        for length, k in used.items():
            left[length] -= k
        lengths = np.flatnonzero(left[: room + 1])
        if not len(lengths):
            return None
        at = np.searchsorted(lengths, room - lengths, side="right") - 1
        ok = at >= 0
        partner = np.where(ok, lengths[np.maximum(at, 0)], 0)
        alone = ok & (partner == lengths) & (left[lengths] < 2)
        partner = np.where(alone, np.where(at > 0, lengths[np.maximum(at - 1, 0)], 0), partner)
        sums = np.where(partner > 0, lengths + partner, 0)
        best = int(sums.argmax())
        return (int(lengths[best]), int(partner[best])) if sums[best] > above else None


def plan(counts: np.ndarray, size: int) -> list[tuple[int, dict[int, int]]]:
    """Fillings as (how many sequences, pieces per length), for ``counts[length]`` pieces."""
    pool, fillings = _Pool(counts), []
    while pool.counts[1:].any():
        used: dict[int, int] = {}
        room = size
        while room and (length := pool.largest(room, used)):
            k = min(room // length, int(pool.counts[length]) - used.get(length, 0))
            used[length] = used.get(length, 0) + k
            room -= k * length
        while room:
            smallest = min(used)
            pair = pool.pair(room + smallest, smallest, used)
            if pair is None:
                break
            room += smallest - sum(pair)
            used[smallest] -= 1
            for length in pair:
                used[length] = used.get(length, 0) + 1
            used = {length: k for length, k in used.items() if k}
        times = min(int(pool.counts[length]) // k for length, k in used.items())
        for length, k in used.items():
            pool.counts[length] -= k * times
        fillings.append((times, used))
    return fillings


def _places(fillings: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, for each filling that holds it: rank of its first piece, pieces per sequence, first sequence, offset."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, used in fillings:
        offset = 0
        for length in sorted(used, reverse=True):
            found.setdefault(length, []).append((ranks.get(length, 0), used[length], sequence, offset))
            ranks[length] = ranks.get(length, 0) + used[length] * times
            offset += length * used[length]
        sequence += times
    return {length: tuple(np.array(column, np.int64) for column in zip(*rows)) for length, rows in found.items()}


def _cut(size: int, tokenizer: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, turns = Encoder(tokenizer), TaskContext.get().partitionId(), {}
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in _PIECES_ARROW}
            held = 0
            for doc_id, encoded in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                ids = encoder.with_end(encoded)
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids), size)):
                    body = ids[start : start + length].tobytes()
                    turn = turns[length] = turns.get(length, -1) + 1
                    row = (doc_id, piece, start, length, zlib.crc32(body), body if with_ids else None, part, turn)
                    for values, value in zip(out.values(), row):
                        values.append(value)
                    start += length
                held += len(ids) * with_ids
                if held > 1 << 20:
                    yield table_of(out, _PIECES_ARROW)
                    held, out = 0, {f.name: [] for f in _PIECES_ARROW}
            yield table_of(out, _PIECES_ARROW)

    return run


def _place(places: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            sequences, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                first, each, sequence, offset = places[length]
                at = np.searchsorted(first, ranks[mine], side="right") - 1
                nth = ranks[mine] - first[at]
                sequences[mine] = sequence[at] + nth // each[at]
                offsets[mine] = offset[at] + nth % each[at] * length
            kept = [batch.column(n) for n in batch.schema.names if n != "rank"]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequences), pa.array(offsets)], names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, size: int = 2048, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and their offset in it.

    A document is its text's ids and an end id; one longer than ``size`` is cut into
    pieces of ``size``, before them the shorter rest. Columns: ``doc_id``, ``piece``,
    ``start``, ``length``, ``ids_crc32``, with ``with_ids`` also ``ids`` (little-endian
    32-bit), ``sequence_id``, ``offset``. Sequences are gapless from offset 0.

    Null and empty texts are the end id alone. Null and repeated ``doc_id`` are
    allowed; each row is packed. Other columns are not carried. An empty table gives
    an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    pieces = saved(texts.mapInArrow(_cut(size, tokenizer, with_ids), _PIECES), "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = np.zeros(size + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        counts[r["length"]] = r["count"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = pieces.join(bases, ["length", "part"]).select(*columns, (F.col("base") + F.col("turn")).alias("rank"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(_place(_places(plan(counts, size))), f"{types}, sequence_id long, offset long")
