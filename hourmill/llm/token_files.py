"""Token ids in files: canonical length-limited Huffman codes in independent blocks.

A folder holds two Parquet tables. ``codes``: ``token``, ``bits`` - code lengths;
canonical codes follow from them, shorter first, then by token. ``blocks``: some
consecutive documents each, with ``doc_ids``, ``lengths`` (ids per document),
``start`` (ids of all documents before), ``payload`` (codes, most significant bit
first) and ``marks``, the bit offset of every ``STEP``-th id. A block is read
without any other, and its marks let a decoder follow many places at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identity, saved, table_of
from .tokens import END, TOKENIZER, Encoder

STEP = 64
BLOCK_IDS = 1 << 16
LONGEST_CODE = 16
#: Pieces of text a task remembers, and as many older ones: no other work shares its executor, so twice as many as elsewhere.
REMEMBERED = 500_000

_IDS = "kind int, doc_id long, part int, turn long, start long, n long, ids binary, token long"
_IDS_ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("doc_id", pa.int64()), ("part", pa.int32()), ("turn", pa.int64()),
        ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("token", pa.int64()),
    ]
)
_BLOCKS = "start long, doc_ids array<long>, lengths array<long>, payload binary, marks array<long>"
_BLOCKS_ARROW = pa.schema(
    [
        ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()), ("marks", pa.list_(pa.int64())),
    ]
)
_READ = "doc_id long, start long, n_tokens long, ids binary"
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``longest`` bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    longest = max(longest, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.empty(0, np.int64)
    for _ in range(longest):
        both = np.concatenate([leaves, packages])
        is_leaf = np.r_[np.ones(len(leaves), bool), np.zeros(len(packages), bool)]
        by = np.argsort(both, kind="stable")
        both = both[by]
        levels.append(is_leaf[by])
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(used) - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then token."""
    codes = np.zeros(len(lengths), np.uint64)
    code = previous = 0
    for token in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        bits = int(lengths[token])
        if bits:
            code <<= bits - previous
            codes[token] = code
            code, previous = code + 1, bits
    return codes


def write_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of some ids as bytes, and the bit offset of every ``STEP``-th."""
    bits = lengths[ids]
    ends = np.cumsum(bits)
    begins = ends - bits
    word, at = begins >> 6, begins & 63
    shift = 64 - at - bits
    values = codes[ids]
    high = np.where(shift >= 0, values << np.maximum(shift, 0).astype(np.uint64), values >> np.maximum(-shift, 0).astype(np.uint64))
    words = np.zeros(int(ends[-1] + 63) // 64 + 1, np.uint64)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    words[word[first]] = np.bitwise_or.reduceat(high, first)
    over = np.flatnonzero(shift < 0)
    words[word[over] + 1] |= values[over] << (64 + shift[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], begins[::STEP]


class Decoder:
    """Decoding by one table over all bit patterns of the longest code."""

    def __init__(self, lengths: np.ndarray):
        self.width = int(lengths.max()) if len(lengths) else 0
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = 1 << (self.width - lengths[order])
        self.tokens = np.repeat(order, spans).astype("<u4")
        self.bits = np.repeat(lengths[order], spans)
        missing = (1 << self.width) - len(self.tokens)
        if missing:  # one used token leaves half of the table open
            self.tokens, self.bits = np.pad(self.tokens, (0, missing)), np.pad(self.bits, (0, missing), constant_values=1)

    def read(self, payload: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint64)
        place = np.array(marks, np.int64)
        found = np.zeros((len(place), STEP), "<u4")
        mask = np.uint64((1 << self.width) - 1)
        last = len(raw) - 5
        for step in range(STEP):
            byte = np.minimum(place >> 3, last)
            window = (
                raw[byte] << np.uint64(32) | raw[byte + 1] << np.uint64(24) | raw[byte + 2] << np.uint64(16)
                | raw[byte + 3] << np.uint64(8) | raw[byte + 4]
            )
            index = (window >> (40 - self.width - (place & 7)).astype(np.uint64)) & mask
            found[:, step] = self.tokens[index]
            place = place + self.bits[index]
        return found.reshape(-1)[:n]


def _tokenise(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(tokenizer, REMEMBERED), TaskContext.get().partitionId()
        start = turn = 0
        counts = np.zeros(0, np.int64)

        def rows(doc_ids, turns, starts, sizes, bodies):
            n = len(doc_ids)
            fixed = {"kind": [0] * n, "part": [part] * n, "token": [None] * n}
            return table_of(fixed | {"doc_id": doc_ids, "turn": turns, "start": starts, "n": sizes, "ids": bodies}, _IDS_ARROW)

        end = np.array([END], encoder.dtype).tobytes()

        def count(bodies):
            nonlocal counts
            seen = np.bincount(np.frombuffer(b"".join(bodies), encoder.dtype))
            if len(seen) > len(counts):
                counts = np.pad(counts, (0, len(seen) - len(counts)))
            counts[: len(seen)] += seen

        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            held = 0
            for doc_id, encoded in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                body = encoded + end
                n = len(body) // encoder.dtype.itemsize
                for values, value in zip(out, (doc_id, turn, start, n, body)):
                    values.append(value)
                start, turn, held = start + n, turn + 1, held + n
                if held > 1 << 20:
                    count(out[-1])
                    yield rows(*out)
                    out, held = ([], [], [], [], []), 0
            count(out[-1])
            yield rows(*out)
        used = np.flatnonzero(counts)
        none = [None] * len(used)
        yield table_of(
            {"kind": [1] * len(used), "doc_id": none, "part": none, "turn": none, "start": none, "n": counts[used], "ids": none, "token": used},
            _IDS_ARROW,
        )

    return run


def _encode(lengths: np.ndarray, bases: dict[int, int], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        block: list[tuple] = []
        held = 0

        def closed():
            ids = np.frombuffer(b"".join(r[5] for r in block), f"<u{width}").astype(np.int64)
            payload, marks = write_bits(ids, lengths, codes)
            start = bases[block[0][1]] + block[0][3]
            return table_of(
                {"start": [start], "doc_ids": [[r[0] for r in block]], "lengths": [[r[4] for r in block]], "payload": [payload], "marks": [marks]},
                _BLOCKS_ARROW,
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                follows = block and (row[1], row[2]) == (block[-1][1], block[-1][2] + 1)
                if block and (not follows or held >= BLOCK_IDS):
                    yield closed()
                    block, held = [], 0
                block.append(row)
                held += row[4]
        if block:
            yield closed()

    return run


def _decode(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for batch in batches:
            for start, doc_ids, sizes, payload, marks in zip(*batch.columns):
                n = sizes.values.to_numpy()
                ids = decoder.read(payload.as_py(), marks.values.to_numpy(), int(n.sum()))
                ends = np.cumsum(n)
                bodies = [ids[e - k : e].tobytes() for e, k in zip(ends.tolist(), n.tolist())]
                yield table_of(
                    {"doc_id": doc_ids.values, "start": start.as_py() + ends - n, "n_tokens": n, "ids": bodies}, _READ_ARROW
                )

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> None:
    """Write the ids of all documents, each with an end id, in ascending order of ``doc_id``.

    Null and empty texts are the end id alone; a null ``doc_id`` comes first; rows
    with one ``doc_id`` come in the order of a hash of their text. Other columns are
    not written. An empty table writes empty tables.
    """
    spark = docs.sparkSession
    _, h = identity()
    rows = docs.select(F.col("doc_id").cast("long"), "text", h)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = rows.repartitionByRange(ranges, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    ids = saved(in_order.mapInArrow(_tokenise(tokenizer), _IDS), "ids")
    # One number per partition and one per token of the vocabulary come to the driver.
    totals = sorted((r["part"], r["n"]) for r in ids.where("kind = 0").groupBy("part").agg(F.sum("n").alias("n")).collect())
    bases, total = {}, 0
    for part, n in totals:
        bases[part], total = total, total + n
    seen = {r["token"]: r["n"] for r in ids.where("kind = 1").groupBy("token").agg(F.sum("n").alias("n")).collect()}
    counts = np.zeros(max(seen, default=0) + 1, np.int64)
    counts[list(seen)] = list(seen.values())
    lengths = code_lengths(counts)
    codes = [(int(t), int(lengths[t])) for t in np.flatnonzero(lengths)]
    spark.createDataFrame(codes, "token long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    width = Encoder(tokenizer).dtype.itemsize
    blocks = ids.where("kind = 0").select("doc_id", "part", "turn", "start", "n", "ids")
    blocks.mapInArrow(_encode(lengths, bases, width), _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a folder: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian 32-bit)."""
    found = spark.read.schema("token long, bits int").parquet(f"{path}/codes").collect()  # at most the vocabulary
    lengths = np.zeros(max((r["token"] for r in found), default=0) + 1, np.int64)
    for r in found:
        lengths[r["token"]] = r["bits"]
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    return blocks.mapInArrow(_decode(lengths), _READ)
