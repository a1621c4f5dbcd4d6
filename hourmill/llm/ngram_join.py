"""Near duplicates by Jaccard similarity of word n-grams (size-aware heavy-light join).

A document is the set of its distinct shingles. Equal sets become one node first.
All sets order their shingles alike: rare ones first, those known to be frequent
last. Two similar sets then share their first common shingles within a prefix:

- *small* sets (both at most a boundary) are joined on fixed-size subsets: all pairs
  of shingles within the prefix that must hold two common ones;
- any pair with a *large* set is found by scanning inverted lists of single prefix
  shingles. The boundary is the size that makes both costs least on these tables.

Candidates are verified on the whole sets: all pairs where links are asked for. Where
only groups are, large groups of copies are spared their pairs: each node is first
checked against one other node, the one it shares most keys with. Keys that then still
hold nodes of different components deal these into a row by chance, in which neighbours
are checked: a number of pairs that grows with the rows, and that joins a group of near
copies which differ among each other. This is done again while many such pairs are similar;
only keys that still hold nodes of different components give all further pairs, of those nodes only.
Each node carries a bit per residue class of its shingles, set if their number is odd.
Two sets differ in at least as many shingles as these bits differ, so that most pairs that
share a key but little else are seen to be too different where they meet, without a text.
Links and components stay distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, distinct, gram_hashes, identity, mixed, packed, released, saved, table_of, utf8, word_hashes

Save = Callable[[DataFrame, str], DataFrame]
FREQUENT = 8
MAX_FREQUENT = 1 << 20
#: Bounds of a task's memory: shingles counted, shingles waiting to be counted, rows sent at once, shingles kept for verification.
MAX_COUNTED, FOLDED, SENT, KEPT = 1 << 20, 1 << 19, 1 << 16, 1 << 20
#: Sets that a task remembers, so as not to send equal ones again.
REMEMBERED = 1 << 17
#: Shingles of so many sets are known to be shared, so their rows need not meet.
HOT = 20_000
#: Sets of one key that a task pairs with each other; keys of more are dealt to several tasks.
PAIRED = 1_000
#: Times that neighbours are checked at most, and the share of similar ones among them from which it is done again.
TURNS, SIMILAR = 4, 0.1
LOWEST = -(1 << 63)
_PLACE_NAMES = {"d": "_llm_e", "h": "_llm_g", "n_shingles": "_llm_n", "component_id": "_llm_c", "leads": "_llm_l", "n_links": "_llm_k"}
LARGEST_SMALL = 64

#: Parities of the shingles' residue classes, 64 to a column.
_MARKS = [f"m{i}" for i in range(8)]
_NODES = "kind int, d long, h long, id binary, a long, n int, token long, df long, " + ", ".join(f"{m} long" for m in _MARKS)
_NODES_ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("d", pa.int64()), ("h", pa.int64()), ("id", pa.binary()), ("a", pa.int64()),
        ("n", pa.int32()), ("token", pa.int64()), ("df", pa.int64()), *((m, pa.int64()) for m in _MARKS),
    ]
)
_KEYS = "key long, a long, n int, pos int, hot boolean"
_KEYS_ARROW = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("hot", pa.bool_())])
_COST = "n int, subsets long, lists long"
_COST_ARROW = pa.schema([("n", pa.int32()), ("subsets", pa.int64()), ("lists", pa.int64())])


def shingle_set(text: str | bytes | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct ``n``-word shingles; of the whole sequence if it is shorter."""
    raw = text.encode() if isinstance(text, str) else text or b""
    words = word_hashes(raw.lower())
    if not len(words):
        return np.empty(0, np.uint64)
    return distinct(gram_hashes(words, min(n, len(words))))


def _id(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def _short(name: bytes | None) -> int | None:
    """Half of an id. Candidates go by it; should two sets share it, there are more candidates, not fewer."""
    return None if name is None else int.from_bytes(name[:8], "little", signed=True)


def _marks(shingles: np.ndarray) -> np.ndarray:
    """One bit per residue class of the shingles, set where their number is odd."""
    classes = 64 * len(_MARKS)
    odd = np.bincount((shingles % np.uint64(classes)).view(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _near(x: str, y: str, percent: int) -> Column:
    """Whether the marks of two sets of sizes ``n`` leave them a chance to be similar.

    Similar sets differ in at most ``(100 - percent) / (100 + percent)`` of both sizes together.
    """
    differ = sum(F.bit_count(F.col(f"{x}.{m}").bitwiseXOR(F.col(f"{y}.{m}"))) for m in _MARKS)
    return differ * (100 + percent) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - percent)


def _least(n: int, percent: int) -> int:
    """Common shingles that a set of ``n`` must have with any similar set."""
    return -(-n * percent // 100)


def _nodes(shingle: int):
    """Per document its set's id and size; per task how many sets hold a shingle (from two on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pending = set(), []
        tokens, counts, waiting = np.empty(0, np.uint64), np.empty(0, np.int64), 0

        def fold():
            nonlocal pending, tokens, counts, waiting
            new, pending, waiting = np.concatenate(pending), [], 0
            new.sort()
            firsts = np.flatnonzero(np.r_[True, new[1:] != new[:-1]])
            more = np.diff(np.r_[firsts, len(new)])
            new = new[firsts]
            at = np.searchsorted(tokens, new)
            old = np.flatnonzero(at < len(tokens))
            old = old[tokens[at[old]] == new[old]]
            counts[at[old]] += more[old]
            fresh = np.ones(len(new), bool)
            fresh[old] = False
            at = at[fresh]
            tokens, counts = np.insert(tokens, at, new[fresh]), np.insert(counts, at, more[fresh])
            if len(tokens) > MAX_COUNTED:  # counts serve the order of shingles only, where any order is right
                tokens, counts = tokens[counts > 1], counts[counts > 1]

        for batch in batches:
            d, h = (c.to_pylist() for c in batch.columns[:2])
            ids, sizes, marks = [], [], np.zeros((len(d), len(_MARKS)), np.int64)
            for text in utf8(batch.column(2)):
                found = shingle_set(text, shingle)
                marks[len(ids)] = _marks(found)
                ids.append(_id(found) if len(found) else None)
                sizes.append(len(found))
                if len(found) and ids[-1] not in known:
                    if len(known) < REMEMBERED:
                        known.add(ids[-1])
                    pending.append(found)
                    waiting += len(found)
                    if waiting >= FOLDED:
                        fold()
            none = [None] * len(d)
            rows = {"kind": [0] * len(d), "d": d, "h": h, "id": ids, "a": [_short(i) for i in ids], "n": sizes}
            yield table_of(rows | {"token": none, "df": none} | dict(zip(_MARKS, marks.T)), _NODES_ARROW)
        if pending:
            fold()
        tokens, counts = tokens[counts > 1].view(np.int64), counts[counts > 1]
        for lo in range(0, len(tokens), SENT):
            part = tokens[lo : lo + SENT]
            none = [None] * len(part)
            rows = {"kind": [1] * len(part)} | dict.fromkeys(["d", "h", "id", "a", "n", *_MARKS], none)
            yield table_of(rows | {"token": part, "df": counts[lo : lo + SENT]}, _NODES_ARROW)

    return run


class Order:
    """The common order of shingles: by known frequency, then by hash."""

    def __init__(self, tokens: np.ndarray, df: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.df = tokens[by], df[by]
        self.leading: np.ndarray | None = None  # leading 24 bits that some token has; made where it is used

    def frequency(self, shingles: np.ndarray) -> np.ndarray:
        found = np.zeros(len(shingles), np.int64)
        if not len(self.tokens):
            return found
        if self.leading is None:
            self.leading = np.zeros(1 << 24, bool)
            self.leading[self.tokens >> np.uint64(40)] = True
        maybe = np.flatnonzero(self.leading[shingles >> np.uint64(40)])
        at = np.searchsorted(self.tokens, shingles[maybe])
        at[at == len(self.tokens)] = 0
        found[maybe] = np.where(self.tokens[at] == shingles[maybe], self.df[at], 0)
        return found

    def prefix(self, shingles: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        df = self.frequency(shingles)
        by = np.lexsort((mixed(shingles), df))[:length]
        return shingles[by], df[by]


def _smallest_linked(percent: int) -> int:
    """Sets below this size are similar to equal sets only."""
    n = 1
    while n * 100 < percent * (n + 1):
        n += 1
    return n


def _costs(shingle: int, percent: int, order: Order):
    """Work per set size, as rows of subsets and as entries met in inverted lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = set(), {}
        for batch in batches:
            for text in utf8(batch.column(0)):
                found = shingle_set(text, shingle)
                n = len(found)
                if not 0 < n <= LARGEST_SMALL or _id(found) in known:
                    continue
                known.add(_id(found)) if len(known) < REMEMBERED else None
                prefix = n - _least(n, percent) + 2
                subsets, lists = total.get(n, (0, 0))
                lists += int(np.maximum(order.prefix(found, prefix - 1)[1], 1).sum())
                total[n] = (subsets + prefix * (prefix - 1) // 2, lists)
        yield table_of(
            {"n": list(total), "subsets": [v[0] for v in total.values()], "lists": [v[1] for v in total.values()]}, _COST_ARROW
        )

    return run


def boundary(costs: dict[int, tuple[int, int]], percent: int) -> int:
    """The largest size treated as small: where rows of subsets and entries of lists together are fewest."""

    def cost(b: int) -> int:
        from_lists = _least(b + 1, percent)
        return sum((s if n <= b else 0) + (e if n >= from_lists else 0) for n, (s, e) in costs.items())

    return min(range(LARGEST_SMALL + 1), key=lambda b: (cost(b), b))


def _keys(shingle: int, percent: int, order: Order, small: int):
    """Prefix subsets of small sets and prefix shingles of sets that may be similar to a large one."""
    least_linked = _smallest_linked(percent)
    from_lists = _least(small + 1, percent)
    # A set of so few shingles may have to share one only, so it and what is similar to it meet by lists.
    by_one = 100 // percent * 100 // percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set()
        keys, ids, sizes, places, hot = [], [], [], [], []

        def rows() -> pa.RecordBatch:
            nonlocal keys, ids, sizes, places, hot
            made = table_of({"key": keys, "a": ids, "n": sizes, "pos": places, "hot": hot}, _KEYS_ARROW)
            keys, ids, sizes, places, hot = [], [], [], [], []
            return made

        for batch in batches:
            for text in utf8(batch.column(0)):
                found = shingle_set(text, shingle)
                n = len(found)
                if n < least_linked or (name := _id(found)) in known:
                    continue
                if len(known) < REMEMBERED:
                    known.add(name)
                prefix, df = order.prefix(found, n - _least(n, percent) + 2)
                before = len(keys)
                if n <= small:
                    for i, j in combinations(range(len(prefix)), 2):
                        pair = gram_hashes(prefix[[i, j]], 2) + np.uint64(1)
                        keys.append(int(pair.view(np.int64)[0]))
                        places.append(j - 1)
                    hot += [False] * (len(keys) - before)
                if n >= from_lists or n <= by_one:
                    single = min(n - _least(n, percent) + 1, len(prefix))
                    keys += prefix[:single].view(np.int64).tolist()
                    places += range(single)
                    hot += (df[:single] >= HOT).tolist()
                ids += [_short(name)] * (len(keys) - before)
                sizes += [n] * (len(keys) - before)
                if len(keys) >= SENT:
                    yield rows()
        yield rows()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by key and set, of keys that several sets have."""
    last, told = None, True  # the last row, and whether it has gone out
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids, hot = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "a", "hot"))
        new_key = np.r_[last is None or last["key"][0].as_py() != keys[0], keys[1:] != keys[:-1]]
        new_set = new_key | np.r_[last is None or last["a"][0].as_py() != ids[0], ids[1:] != ids[:-1]]
        firsts = np.flatnonzero(new_key)
        group = np.cumsum(new_key)  # 0 continues the last batch's key
        carried = last is not None and not new_key[0]
        several = np.zeros(group[-1] + 1, bool)
        several[group[new_set & ~new_key]] = True
        if carried:
            several[0] |= told
            if several[0] and not told:
                yield last
        keep = several[group] | hot
        told = bool(keep[-1])
        if not told:  # equal sets of one key that stay open are one row
            start = firsts[-1] if len(firsts) else 0
            keep[start:] = False
        yield batch.filter(pa.array(keep))
        last = batch.slice(len(keys) - 1, 1)


class _Sets(dict):
    """Shingle sets by id, remembered up to a bound on their sizes together."""

    def __init__(self, shingle: int):
        self.shingle, self.held, self.unpack = shingle, 0, zstandard.ZstdDecompressor().decompress

    def of(self, name: bytes, text: pa.Scalar) -> np.ndarray:
        found = self.get(name)
        if found is None:
            found = shingle_set(self.unpack(text.as_py()), self.shingle)
            if self.held > KEPT:
                self.clear()
                self.held = 0
            self[name] = found
            self.held += len(found) + 64
        return found


def _verify(shingle: int, percent: int):
    """Similar ones among pairs that come in the order of their second members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(shingle)
        last: tuple[bytes | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            keep = []
            for i, (x, y, a, b) in enumerate(zip(*batch.columns)):
                if last[0] != y.as_py():
                    last = (y.as_py(), sets.of(y.as_py(), b))
                left, right = sets.of(x.as_py(), a), last[1]
                least, most = sorted((len(left), len(right)))
                if 100 * least < percent * most:
                    continue
                both = np.sort(np.concatenate([left, right]), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * common >= percent * (least + most - common):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return run


def components(links: DataFrame, saved: Save = saved) -> DataFrame:
    """``id`` and ``root`` (smallest id reachable) of all nodes of ``links`` (``x``, ``y``).

    Each round takes the smallest label among neighbours and then that node's own
    label, so paths shorten fast; labels are written to the shared folder each round.
    """
    both = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    both = saved(both.distinct(), "graph")
    labels = saved(
        both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("id"), F.least("x", "m").alias("root")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("y"), "root"), "y")
            .groupBy(F.col("x").alias("id"))
            .agg(F.min("root").alias("near"))
        )
        stepped = labels.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("new"))
        jump = labels.select(F.col("id").alias("new"), F.col("root").alias("top"))
        updated = saved(
            stepped.join(jump, "new", "left").select("id", "old", F.coalesce("top", "new").alias("root")), "labels"
        )
        labels = updated.select("id", "root")
        if updated.where("old != root").isEmpty():
            return labels


def _parted(placed: DataFrame, paired: int) -> DataFrame:
    """The rows with ``parts``, the number of parts that a key of many sets is split into."""
    sizes = placed.groupBy("key").agg(F.ceil(F.count("*") / paired).cast("int").alias("parts"))
    return placed.join(sizes.where("parts > 1"), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


def _may_be_similar(percent: int) -> Column:
    """Whether sets ``x`` and ``y`` of one key may be, by sizes, places in the key and marks."""
    need = (F.col("x.n") + F.col("y.n")) * percent
    room = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) * (100 + percent)
    return (
        (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
        & (room >= need)
        & _near("x", "y", percent)
    )


def _all_pairs(placed: DataFrame, percent: int, paired: int, apart: bool = False) -> DataFrame:
    """Distinct pairs ``x`` < ``y`` of sets that share a key of ``placed`` (``key``, ``id``, ``n``, ``pos``, marks) and may be similar.

    With ``apart`` only pairs whose ``root`` differs. A key of many sets is split: each set's row goes to one part as first member and to all parts as second.
    """
    placed = _parted(placed, paired)
    x = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).alias("x")
    y = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    wanted = F.col("x.root") != F.col("y.root") if apart else F.lit(True)
    met = x.join(
        y,
        wanted
        & (F.col("x.key") == F.col("y.key"))
        & (F.col("x.part") == F.col("y.part"))
        & (F.col("x.id") < F.col("y.id"))
        & _may_be_similar(percent),
    )
    return met.select(F.col("x.id").alias("x"), F.col("y.id").alias("y")).distinct()


def _neighbours(placed: DataFrame, percent: int, paired: int, turn: int) -> DataFrame:
    """Distinct pairs ``x`` < ``y`` of different ``root`` that may be similar and follow each other in a key.

    The sets of a key, or of a part of a long one, follow in an order dealt by chance, another one for each key and turn.
    """
    dealt = _parted(placed, paired).withColumn("place", F.xxhash64(F.lit(turn), "key", "id"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("place"), F.col("parts")))
    one = F.struct("id", "n", "pos", "root", *_MARKS)
    after = F.lead(one).over(Window.partitionBy("key", "part").orderBy("place", "id"))
    met = dealt.select(one.alias("x"), after.alias("y")).where((F.col("x.root") != F.col("y.root")) & _may_be_similar(percent))
    return met.select(F.least("x.id", "y.id").alias("x"), F.greatest("x.id", "y.id").alias("y")).distinct()


def _apart(placed: DataFrame, links: DataFrame, saved: Save) -> DataFrame:
    """Rows of keys that, given these links, still hold sets of several components, with the ``root`` of each set."""
    rooted = placed.drop("root").join(components(links, saved), "id", "left").withColumn("root", F.coalesce("root", "id"))
    r = F.xxhash64("root")
    several = rooted.groupBy("key").agg(F.min(r).alias("lo"), F.max(r).alias("hi")).where("lo != hi")
    return saved(rooted.join(several.select("key"), "key", "left_semi"), "ngram-rest")


def _merged_keys(placed: DataFrame) -> DataFrame:
    """Keys that hold sets of several components ``r``, each with one number for all keys of the same sets.

    The number comes from sums over hashes of the sets. Should different sets give one number, their keys
    become one, which adds candidates and loses none; a key whose sums leave 64 bits stays by itself.
    """
    sums = [
        F.try_sum(F.xxhash64(F.lit(seed), "id").bitwiseAND(F.lit((1 << 44) - 1))).alias(name)
        for seed, name in enumerate(["s", "t"])
    ]
    several = placed.groupBy("key").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count("*").alias("rows"), *sums)
    whole = F.col("s").isNotNull() & F.col("t").isNotNull()
    return several.where("lo != hi").select("key", F.when(whole, F.xxhash64("rows", "s", "t")).otherwise(F.col("key")).alias("merged"))


def similar_links(
    docs: DataFrame, nodes: DataFrame, shingle: int, percent: int, every: bool = True, paired: int = PAIRED, saved: Save = saved
) -> DataFrame:
    """Links ``x``, ``y`` between distinct sets: every one, or only such as yield the same components."""
    spark = docs.sparkSession
    frequent = (
        nodes.where("kind = 1").groupBy("token").agg(F.sum("df").alias("df")).where(F.col("df") >= FREQUENT)
        .orderBy(F.desc("df"), "token").limit(MAX_FREQUENT).collect()
    )  # MAX_FREQUENT pairs of numbers at most; a shingle that is not among them only takes its place by hash
    order = Order(
        np.array([r["token"] for r in frequent], np.int64).view(np.uint64), np.array([r["df"] for r in frequent], np.int64)
    )
    short = docs.where(F.length("text") <= 40 * LARGEST_SMALL).select("text")
    sizes = short.mapInArrow(released(_costs(shingle, percent, order)), _COST).groupBy("n").agg(
        F.sum("subsets").alias("subsets"), F.sum("lists").alias("lists")
    )
    small = boundary({r["n"]: (r["subsets"], r["lists"]) for r in sizes.collect()}, percent)

    keys = docs.select("text").mapInArrow(released(_keys(shingle, percent, order, small)), _KEYS)
    slot = F.when(F.col("hot"), F.xxhash64("key", "a")).otherwise(F.xxhash64("key"))
    met = keys.repartition(slot).sortWithinPartitions("key", "a").mapInArrow(released(_shared), _KEYS)
    shared = saved(met.drop("hot"), "ngram-keys")

    traits = [F.min(c).alias(c) for c in ["n", *_MARKS]]  # equal for all documents of a set
    reps = nodes.where("id is not null").groupBy("id", "a").agg(F.min(F.struct("d", "h")).alias("rep"), *traits)
    involved = shared.select("a").distinct()
    chosen = saved(reps.join(involved, "a", "left_semi").select("id", "a", "rep.d", "rep.h", "n", *_MARKS), "ngram-chosen")
    d, h = identity()
    texts = docs.select(d, h, packed(F.col("text")).alias("text")).join(chosen.select("id", "d", "h"), ["d", "h"]).dropDuplicates(["id"])
    texts = saved(texts.select("id", "text"), "ngram-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("id").alias("x"), F.col("text").alias("left"))
        right = texts.select(F.col("id").alias("y"), F.col("text").alias("right"))
        whole = pairs.join(left, "x").join(right, "y").select("x", "y", "left", "right")
        return whole.mapInArrow(released(_verify(shingle, percent)), "x binary, y binary")

    if every:
        placed = shared.drop("n").join(chosen.drop("d", "h"), "a")
        pairs = saved(_all_pairs(placed, percent, paired), "ngram-pairs")
        return verified(pairs)

    firsts = shared.groupBy("key").agg(F.min("a").alias("first"))
    votes = shared.join(firsts, "key").where("a != first").groupBy("a", "first").count()
    best = votes.groupBy("a").agg(F.max(F.struct("count", "first")).alias("best")).select("a", "best.first")
    x, y = chosen.alias("x"), chosen.alias("y")
    met = best.join(x, F.col("x.a") == best["a"]).join(y, F.col("y.a") == best["first"]).where(_near("x", "y", percent))
    one_each = met.select(F.col("x.id").alias("x"), F.col("y.id").alias("y"))
    pair = [F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")]
    one_each = one_each.groupBy(*pair).agg(F.min(F.struct("x", "y")).alias("pair"))  # the partner of many comes second
    one_each = saved(one_each.select("lo", "hi", "pair.*"), "ngram-pairs")
    first_links = saved(verified(one_each.select("x", "y")), "ngram-links")
    roots = components(first_links, saved)
    rooted = chosen.drop("d", "h").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = shared.drop("n").join(rooted, "a").select("key", "id", "n", "pos", "root", *_MARKS)
    mixed_keys = _merged_keys(placed.select("key", "id", F.xxhash64("root").alias("r")))
    # Sets that meet under many keys meet once; the first place of all is the loosest bound, so no pair is lost.
    traits = [F.col("merged").alias("key"), "id", "n", "root", *_MARKS]
    rest = saved(placed.join(mixed_keys, "key").groupBy(*traits).agg(F.min("pos").alias("pos")), "ngram-rest")
    links, checked = first_links, one_each.select(F.col("lo").alias("x"), F.col("hi").alias("y"))
    for turn in range(TURNS):
        beside = saved(_neighbours(rest, percent, paired, turn).join(checked, ["x", "y"], "left_anti"), "ngram-pairs")
        similar = saved(verified(beside), "ngram-links")
        n_beside, n_similar = beside.count(), similar.count()
        links, checked = links.unionByName(similar), checked.unionByName(beside)
        if n_similar:
            rest = _apart(rest, links, saved)
        if n_similar <= SIMILAR * n_beside:
            break
    further = _all_pairs(rest, percent, paired, apart=True)
    return links.unionByName(verified(further.join(checked, ["x", "y"], "left_anti")))


def _placed(docs: DataFrame, shingle: int, percent: int, every: bool, paired: int = PAIRED) -> DataFrame:
    """Per document (``d``, ``h``): set size, component, whether it is the first of its component and, given all links, their number."""
    with Scratch(docs.sparkSession) as scratch:
        return saved(_places(docs, shingle, percent, every, paired, scratch.saved), "ngram-places")


def _places(docs: DataFrame, shingle: int, percent: int, every: bool, paired: int, saved: Save) -> DataFrame:
    nodes = saved(docs.select(*identity(), "text").mapInArrow(released(_nodes(shingle)), _NODES), "ngram-nodes")
    per_doc = nodes.where("kind = 0").select("d", "h", "id", "n").distinct()
    with Scratch(docs.sparkSession) as scratch:
        links = saved(similar_links(docs, nodes, shingle, percent, every, paired, scratch.saved), "ngram-all-links")
    roots = components(links, saved)
    grouped = per_doc.where("id is not null").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    firsts = grouped.groupBy("root").agg(
        F.min(F.when(F.col("d") != F.lit(LOWEST).cast("long"), F.col("d"))).alias("component"), F.min(F.struct("d", "h")).alias("first")
    )
    if every:  # a node's documents link with each other and with those of its neighbours
        copies = nodes.where("kind = 0 and id is not null").groupBy("id").agg(F.count("*").alias("copies"))
        both = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        beside = both.join(copies.withColumnRenamed("id", "y"), "y").groupBy(F.col("x").alias("id")).agg(F.sum("copies").alias("beside"))
        linked = copies.join(beside, "id", "left").select("id", (F.col("copies") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"))
        grouped = grouped.join(linked, "id")
    else:
        grouped = grouped.withColumn("n_links", F.lit(None).cast("long"))
    placed = grouped.join(firsts, "root").select("d", "h", "component", "n_links", (F.struct("d", "h") == F.col("first")).alias("leads"))
    alone = F.col("id").isNull()
    return per_doc.join(placed, ["d", "h"], "left").select(
        "d",
        "h",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(alone & (F.col("d") != F.lit(LOWEST).cast("long")), F.col("d")).otherwise(F.col("component")).alias("component_id"),
        F.coalesce("leads", F.lit(True)).alias("leads"),
        F.when(alone, 0).otherwise(F.col("n_links")).alias("n_links"),
    )


def _with_places(docs: DataFrame, placed: DataFrame) -> DataFrame:
    d, h = identity()
    marked = docs.select("*", d.alias("_llm_d"), h.alias("_llm_h"))
    same = (F.col("_llm_d") == F.col("_llm_e")) & (F.col("_llm_h") == F.col("_llm_g"))
    return marked.join(placed.select(*[F.col(o).alias(n) for o, n in _PLACE_NAMES.items()]), same)


def ngram_components(
    docs: DataFrame, shingle: int = 4, percent: int = 85, paired: int = PAIRED, links: bool = True
) -> DataFrame:
    """Every document with its set size, its group of near duplicates and the number of its links.

    Two documents link when the Jaccard similarity of their sets of distinct
    ``shingle``-word shingles (A-Z lower-cased) is at least ``percent`` hundredths; a
    shorter text is one shingle. Added columns, which replace extra ones of these
    names: ``n_shingles``, ``component_id``, the smallest ``doc_id`` reachable by links, and
    ``n_links``, how many other documents (rows) it links with, equal ones among them. To count links
    every pair of similar texts is verified, whose number grows with the square of a group of near
    copies; with ``links=False`` there is no ``n_links``, and only pairs that may join two components are.

    Null, empty and blank texts have no shingles and link with nothing: their
    component is their own number. Rows with one ``doc_id`` are separate documents of
    that number. A null ``doc_id`` is never the smallest; a group of such rows alone
    has a null component. An empty table gives an empty result.
    """
    kept = docs.drop("n_shingles", "component_id", "n_links")
    return _with_places(kept, _placed(docs, shingle, percent, links, paired)).select(
        *[F.col(f"`{c}`") for c in kept.columns],
        F.col("_llm_n").alias("n_shingles"),
        F.col("_llm_c").alias("component_id"),
        *([F.col("_llm_k").alias("n_links")] if links else []),
    )


def without_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest ``doc_id``, in the columns of ``docs``.

    Cases are those of :func:`ngram_components`; documents without words all stay,
    but of wholly equal rows one does.
    """
    rows = _with_places(docs, _placed(docs, shingle, percent, False)).where("_llm_l")
    return rows.dropDuplicates(["_llm_d", "_llm_h"]).select(*[F.col(f"`{c}`") for c in docs.columns])
