"""The trie of conversation prefixes: who shares which opening turns, and what sharing saves.

A prefix is known by a chain of SHA-256 values, turn after turn, cut to 16 bytes.
Equal conversations become one row; distinct ones are sorted by their chains over all
tasks, so the members of any prefix stand next to each other. Each task has a slice
of that order, the longest common prefix (LCP) of each neighbour pair, and a sparse
table of minima over them; every prefix searches its left and right extent there by
itself. What a prefix is asked for is a sum over its interval, so parts of intervals in
several slices add up. Only a slice's first and last conversation matter to its
neighbours: corrections along these two chains make the sums exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, saved

ID_BYTES = 16
FAMILY, OPENINGS = 20, 4
#: A prefix with more than this part of all prefixes as children is joined to them by broadcast: there can be no more than so many.
HOT_PARENTS = 1000
_ROOT = bytes(ID_BYTES)
_BLOB_CHARS = 1 << 16

_NODES = pa.schema(
    [
        ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("slice", pa.int32()), ("edge", pa.binary()),
    ]
)
_NODES_DDL = (
    "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, slice int, edge binary"
)
_TURNS = "array<struct<id:binary,words:long>>"


def _turn_rows(turns: DataFrame) -> DataFrame:
    """Turns with their SHA-256 and words; the length in front keeps role and text apart."""
    role = F.coalesce(quoted("role").cast("string"), F.lit(""))
    text = F.coalesce(quoted("text").cast("string"), F.lit(""))
    return turns.where(quoted("conv_id").isNotNull()).select(
        quoted("conv_id").cast("long").alias("conv_id"),
        quoted("turn").alias("turn"),
        role.alias("role"),
        F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text), 256).alias("id"),
        F.regexp_count(text, F.lit(r"[^ \t-\r]+")).cast("long").alias("words"),
        text.alias("text"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations as told in `prefix_trie`: ``conv_id`` and ``turns``, an array of turn digests with their words.

    A conversation's openings come from the first one of its family, so only the first
    few turns of those travel.
    """
    rows = _turn_rows(turns)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.select("conv_id", F.struct(F.row_number().over(order).alias("place"), F.unhex("id").alias("id"), "words").alias("one"))
    told = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("t"))
    own = told.select("conv_id", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("own"))
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("own", 1, OPENINGS - 1).alias("opening")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENINGS).cast("int")
    joined = own.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "family", "left").withColumn("h", h)
    opening = F.coalesce(F.slice("opening", F.lit(1), F.col("h")), F.lit(None).cast(_TURNS))
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    both = F.concat(F.coalesce(opening, F.array().cast(_TURNS)), rest)
    return joined.select("conv_id", both.alias("turns"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix identities of each conversation, one after another in one value, and words up to each turn."""
    for batch in batches:
        turns = batch.column("turns")
        flat, bounds = turns.flatten(), turns.offsets.to_numpy()
        ids, words = flat.field("id").to_pylist(), flat.field("words").to_numpy(zero_copy_only=False)
        chains, sums = [], []
        for lo, hi in zip(bounds - bounds[0], bounds[1:] - bounds[0]):
            now, path = _ROOT, []
            for i in range(lo, hi):
                now = hashlib.sha256(now + ids[i]).digest()[:ID_BYTES]
                path.append(now)
            chains.append(b"".join(path))
            sums.append(np.cumsum(words[lo:hi]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(chains, pa.binary()), pa.array(sums, pa.list_(pa.int64()))], names=["conv_id", "chain", "words"]
        )


class SparseTable:
    """Minima of any range by two look-ups."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (half := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def reach(self, start: np.ndarray, least: np.ndarray, step: int) -> np.ndarray:
        """How far from each start, in direction ``step``, all values stay at ``least`` or above: a binary search per start.

        The start's own value counts; the result is the first place that does not.
        """
        place = start.astype(np.int64).copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 1 << k
            left = place if step > 0 else place - width + 1
            inside = (left >= 0) & (left < len(level))
            far = inside.copy()
            far[inside] = level[left[inside]] >= least[inside]
            place = np.where(far, place + step * width, place)
        return place


def _slice_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of every prefix in a sorted slice, and one row that tells its first and last chain."""
    table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
    if table is None:
        return
    chains = table.column("chain").to_pylist()
    copies = table.column("copies").to_numpy()
    lowest = table.column("conv_id").to_numpy()
    words = np.concatenate([np.asarray(w, np.int64) for w in table.column("words").to_pylist()] or [np.empty(0, np.int64)])
    n = len(chains)
    depth = np.array([len(c) // ID_BYTES for c in chains], np.int64)
    begin = np.r_[0, np.cumsum(depth)]
    lcp = np.full(n, -1, np.int64)  # with the conversation before; none: -1
    for i in range(1, n):
        lcp[i] = _common(chains[i - 1], chains[i])
    # Every prefix of every conversation, the root first; it is kept where its interval begins.
    owner = np.repeat(np.arange(n), depth + 1)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(depth + 1) - depth - 1, depth + 1)
    minima = SparseTable(lcp)
    left = minima.reach(owner, at, -1)
    mine = left == owner
    owner, at = owner[mine], at[mine]
    right = minima.reach(owner + 1, at, 1)  # past the last member
    total = np.r_[0, np.cumsum(copies)]
    upto = np.r_[0, words]  # words up to turn d of conversation i: at begin[i] + d, 0 for d = 0
    def said(i, d):
        return np.where(d > 0, upto[begin[i] + np.maximum(d, 0)], 0)

    everyone = np.arange(n)
    full = said(everyone, depth)
    gross = np.r_[0, np.cumsum(copies * full)]
    fresh = np.r_[0, np.cumsum(full - said(everyone, lcp))]
    leaf = np.r_[0, np.cumsum(np.r_[lcp[1:], -1] < depth)]
    before = said(owner, at - 1)
    members = total[right] - total[owner]
    # Turns told by all members, less turns told once by each distinct prefix.
    shared = (gross[right] - gross[owner] - members * before) - (fresh[right] - fresh[owner + 1] + full[owner] - before)
    minimum = SparseTable(lowest)
    width = right - owner
    k = np.maximum(np.frexp(width.astype(float))[1] - 1, 0)
    smallest = np.empty(len(owner), np.int64)
    for level in np.unique(k):
        here = k == level
        values = minimum.levels[level]
        smallest[here] = np.minimum(values[owner[here]], values[right[here] - (1 << level)])
    ids = [chains[i][(d - 1) * ID_BYTES : d * ID_BYTES] if d else _ROOT for i, d in zip(owner, at)]
    parents = [chains[i][(d - 2) * ID_BYTES : (d - 1) * ID_BYTES] if d > 1 else (_ROOT if d else None) for i, d in zip(owner, at)]
    children = _children(ids, parents)
    part = TaskContext.get().partitionId()
    columns = [
        ids, parents, at, smallest, members, children, leaf[right] - leaf[owner], shared,
        np.full(len(ids), part, np.int32), [None] * len(ids),
    ]
    yield from pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODES)], schema=_NODES).to_batches(1 << 14)
    edges = [(chains[0], depth[0], words[begin[0] : begin[1]]), (chains[-1], depth[-1], words[begin[-2] : begin[-1]])]
    blob = b"".join(len(c).to_bytes(8, "big") + c + np.asarray(w, ">i8").tobytes() for c, _, w in edges)
    row = [[None], [None], [None], [None], [None], [None], [None], [None], [part], [blob]]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _NODES)], schema=_NODES)


def _common(a: bytes, b: bytes) -> int:
    """Turns that two chains share: as identities are of whole prefixes, a binary search finds the last equal one."""
    lo, hi = 0, min(len(a), len(b)) // ID_BYTES
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[(mid - 1) * ID_BYTES : mid * ID_BYTES] == b[(mid - 1) * ID_BYTES : mid * ID_BYTES]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _children(ids: list[bytes], parents: list[bytes | None]) -> np.ndarray:
    place = {x: i for i, x in enumerate(ids)}
    return np.bincount([place[p] for p in parents if p is not None], minlength=len(ids))


def _read_edge(blob: bytes) -> list[tuple[bytes, np.ndarray]]:
    found, place = [], 0
    for _ in range(2):
        size = int.from_bytes(blob[place : place + 8], "big")
        chain = blob[place + 8 : place + 8 + size]
        place += 8 + size
        words = np.frombuffer(blob, ">i8", size // ID_BYTES, place).astype(np.int64)
        place += 8 * (size // ID_BYTES)
        found.append((chain, words))
    return found


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two neighbouring slices both counted along the chains that meet there."""
    for batch in batches:
        rows: list[tuple] = []
        for before, after in zip(batch.column("before").to_pylist(), batch.column("edge").to_pylist()):
            if before is None:
                continue
            (chain, words), (last, _) = _read_edge(after)[0], _read_edge(before)[1]
            shared = _common(last, chain)
            upto = np.r_[0, words]
            ended = shared == len(last) // ID_BYTES  # the last one goes on in the first one: no leaf
            for d in range(shared + 1):
                node = chain[(d - 1) * ID_BYTES : d * ID_BYTES] if d else _ROOT
                # The first chain's turns d to `shared` were taken as new once more.
                again = int(upto[shared] - upto[max(d - 1, 0)])
                rows.append((node, None, None, None, 0, -1 if d < shared else 0, -1 if ended else 0, again))
        columns = list(zip(*rows)) or [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, list(_NODES)[:8])], schema=pa.schema(list(_NODES)[:8]))


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each prefix in a sorted slice as joined text, in pieces."""
    part, number, now, held, size, first = TaskContext.get().partitionId(), 0, None, [], 0, 0
    for batch in batches:
        done: list[tuple] = []
        for node, conv_id in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if held and (node != now or size > _BLOB_CHARS):
                done.append((now, part, number, ",".join(held)))
                number, held, size = number + 1, [], 0
            now = node
            held.append(str(conv_id))
            size += len(held[-1]) + 1
        yield _members(done)
    if held:
        yield _members([(now, part, number, ",".join(held))])


def _members(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("node", pa.binary()), ("part", pa.int32()), ("number", pa.int32()), ("said", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * 4, schema)], schema=schema)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each prefix's pieces, as they come in order."""
    now, state = None, None
    for batch in batches:
        done = []
        for node, said in zip(batch.column("node").to_pylist(), batch.column("said").to_pylist()):
            if node != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256(said.encode())
            else:
                state.update(b"," + said.encode())
        yield _digests(done)
    if state is not None:
        yield _digests([(now, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * 2, schema)], schema=schema)


def _ends(convs: DataFrame) -> DataFrame:
    """SHA-256 of the numbers of the conversations that end at each prefix.

    A frequent ending is spread over tasks by number; one task then hashes a few long
    pieces of it in order, since SHA-256 cannot be put together from parts.
    """
    ordered = convs.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ordered.select("node", "conv_id").mapInArrow(_blobs, "node binary, part int, number int, said string")
    gathered = pieces.repartition("node").sortWithinPartitions("node", "part", "number")
    return gathered.select("node", "said").mapInArrow(_hashes, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, from the root (depth 0) down.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. Conversation ``c`` is told anew: the first ``h`` turns
    of conversation ``c - c % 20`` (``h`` is the CRC-32 of ``c`` in decimals, modulo 4), then its own turns after its first
    ``h``. Columns: ``node`` (the prefix's identity), ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless prefixes below or at it), ``saved_tokens`` (over all
    prefixes below or at it, members but one times words of the last turn) and ``ends_sha256`` (of the numbers of the members that end
    there, ascending, with commas between).

    Turns go by ``turn`` (null first), then role and text; repeated rows are turns of their own; null roles and texts are
    empty; rows without a ``conv_id`` belong to no conversation and are left out; extra columns are not carried; without
    conversations there is no row. A conversation's digests, 24 bytes a turn, are held in one task.
    """
    chained = rebuilt(turns).mapInArrow(_chain, "conv_id long, chain binary, words array<long>")
    node = F.when(F.octet_length("chain") == 0, F.lit(_ROOT)).otherwise(F.substring("chain", -ID_BYTES, ID_BYTES))
    convs = saved(chained.withColumn("node", node), "conversations")
    # The last identity stands for the whole chain, so copies meet by it.
    distinct = convs.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("conv_id"), F.any_value("chain").alias("chain"), F.any_value("words").alias("words")
    )
    slices = distinct.repartitionByRange("chain").sortWithinPartitions("chain").select("chain", "words", "copies", "conv_id")
    parts = saved(slices.mapInArrow(_slice_nodes, _NODES_DDL), "slices")
    sums = ["node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    edges = parts.where("edge IS NOT NULL").select("slice", "edge")  # a row per slice
    neighbours = edges.withColumn("before", F.lag("edge").over(Window.orderBy("slice")))
    fixes = neighbours.select("before", "edge").mapInArrow(_corrections, ", ".join(_NODES_DDL.split(", ")[:8]))
    merged = parts.where("edge IS NULL").select(*sums).unionAll(fixes.select(*sums)).groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in sums[4:]],
    )
    nodes = saved(merged, "nodes")
    ends = nodes.join(_ends(convs), "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    told = _with_parents(ends, nodes)
    return told.select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def _with_parents(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each prefix's parent's smallest member; parents of very many are few, and broadcast."""
    many = max(nodes.count() // HOT_PARENTS, 1)
    names = [c for c in rows.columns if c != "parent"]
    is_hot = F.col("n_children") > many
    hot = nodes.where(is_hot).select(F.col("node").alias("parent"), F.col("conv_id").alias("hot_conv_id"))
    cold = nodes.where(~is_hot & (F.col("n_children") > 0)).select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    marked = rows.join(F.broadcast(hot), "parent", "left")
    near = marked.where(F.col("hot_conv_id").isNotNull() | F.col("parent").isNull()).select(*names, F.col("hot_conv_id").alias("parent_conv_id"))
    far = marked.where(F.col("hot_conv_id").isNull() & F.col("parent").isNotNull()).join(cold, "parent").select(*names, "parent_conv_id")
    return near.unionAll(far)
