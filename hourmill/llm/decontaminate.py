"""Benchmark passages in documents, within an edit budget (pigeonhole and Myers).

Texts are compared lower-cased, with every run of other characters than letters and
digits as one space. An item may differ in ``share`` of its characters; it is split
into one piece more than that, so one piece at least stands unchanged wherever it
occurs. Pieces are found by Aho-Corasick and each place is verified with Myers'
bit-parallel distance. Short items are found unchanged, between word boundaries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, identity, saved

SHARE = 0.08
SHORTEST = 32
LEAST_WORDS = 3
SLICE_BYTES = 4 << 20
_OTHER = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> Iterator[tuple[int, str]]:
    """``budget + 1`` parts of nearly equal length, with their places."""
    n = budget + 1
    for i in range(n):
        lo, hi = i * len(item) // n, (i + 1) * len(item) // n
        yield lo, item[lo:hi]


class Pattern:
    """Myers' bit vectors of one item."""

    def __init__(self, item: str):
        self.length, self.masks = len(item), {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """Least distance of the item to any part of the text, and where that part ends (first such end)."""
        full, top = (1 << self.length) - 1, 1 << (self.length - 1)
        plus, minus, distance = full, 0, self.length
        least, end = distance, 0
        for i, c in enumerate(text):
            equal = self.masks.get(c, 0)
            across = equal | minus
            down = (((equal & plus) + plus) ^ plus) | equal
            up, low = minus | ~(down | plus) & full, plus & down
            if up & top:
                distance += 1
            elif low & top:
                distance -= 1
            up, low = up << 1 & full, low << 1 & full
            plus, minus = low | ~(across | up) & full, up & across
            if distance < least:
                least, end = distance, i + 1
        return least, end


class Items:
    """An automaton over the pieces of some items, and over whole short ones between word boundaries."""

    def __init__(self, items: list[tuple[int, str]], share: float = SHARE, shortest: int = SHORTEST, least_words: int = LEAST_WORDS):
        import ahocorasick

        self.whole: dict[str, list[int]] = {}
        self.patterns: list[tuple[int, Pattern, int]] = []
        at: dict[str, tuple[list[tuple[int, int]], list[int]]] = {}
        for item_id, text in items:
            item = normalised(text)
            if len(item) >= shortest:
                budget = int(len(item) * share)
                for place, piece in pieces(item, budget):
                    at.setdefault(piece, ([], []))[0].append((len(self.patterns), place))
                self.patterns.append((item_id, Pattern(item), budget))
            elif item.count(" ") + 1 >= least_words:
                at.setdefault(f" {item} ", ([], []))[1].append(item_id)
            elif item:
                self.whole.setdefault(item, []).append(item_id)
        self.automaton = ahocorasick.Automaton() if at else None
        for piece, (places, short) in at.items():
            self.automaton.add_word(piece, (len(piece), places, short))
        if at:
            self.automaton.make_automaton()

    def found(self, text: str | None) -> list[tuple[int, int, int]]:
        """Items in a text as (item, distance, end in the normalised text), each at its best place."""
        said = normalised(text)
        best: dict[int, tuple[int, int]] = {i: (0, len(said)) for i in self.whole.get(said, ())}
        if self.automaton is None or not said:
            return [(i, *v) for i, v in best.items()]
        areas: dict[int, list[list[int]]] = {}
        for behind, (length, places, short) in self.automaton.iter(f" {said} "):
            end = behind - 1  # in the text without the space before it
            for item_id in short:
                best[item_id] = min(best.get(item_id, (0, end)), (0, end))
            for number, place in places:
                _, pattern, budget = self.patterns[number]
                lo = max(0, end + 1 - length - place - budget)
                hi = min(len(said), end + 1 - length - place + pattern.length + budget)
                areas.setdefault(number, []).append([lo, hi])
        for number, spans in areas.items():
            item_id, pattern, budget = self.patterns[number]
            spans.sort()
            joined = spans[:1]
            for lo, hi in spans[1:]:
                if lo <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], hi)
                else:
                    joined.append([lo, hi])
            for lo, hi in joined:
                distance, end = pattern.best(said[lo:hi])
                if distance <= budget:
                    best[item_id] = min(best.get(item_id, (distance, lo + end)), (distance, lo + end))
        return [(i, *v) for i, v in sorted(best.items())]


def _slices(benchmark: DataFrame, slice_bytes: int) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """The items in parts of bounded size, each small enough to travel with the tasks, and their number."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("n")).collect()[0]["n"]
    n = int(size // slice_bytes) + 1

    def part(k: int) -> list[tuple[int, str]]:
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        return [(r["item_id"], r["text"]) for r in rows]

    return n, map(part, range(n))


_KIND = "array<struct<item_id:long,distance:int,end:int>>"


def _finder(part: list[tuple[int, str]], options: dict):
    @F.pandas_udf(_KIND)
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(part, **options)
        for texts in parts:
            rows = [[{"item_id": i, "distance": d, "end": e} for i, d, e in items.found(t)] for t in texts]
            yield pd.Series(rows, dtype="object")
        del items
        give_back()

    return find.asNondeterministic()  # else the optimiser may run it once per use


def _marked(docs: DataFrame, benchmark: DataFrame, name: str, slice_bytes: int = SLICE_BYTES, **options) -> DataFrame:
    """Documents with the items found in them, as a column of that name.

    A benchmark of one slice goes with the tasks of one scan. Of several, only one is
    held at a time: each is searched in a job of its own whose matches are written
    before the next is read, and the matches of all are joined to the documents.
    """
    n, parts = _slices(benchmark, slice_bytes)
    if n == 1:
        return docs.select("*", _finder(next(parts), options)(F.col("text")).alias(name))
    d, h = identity()
    found = None
    for part in parts:
        hits = docs.select(d, h, _finder(part, options)(F.col("text")).alias("items")).where(F.size("items") > 0)
        hits = saved(hits, "benchmark-hits")
        found = hits if found is None else found.unionByName(hits)
    per_item = found.select("d", "h", F.explode("items").alias("item")).groupBy("d", "h", F.col("item.item_id").alias("item_id"))
    best = per_item.agg(F.min(F.struct("item.distance", "item.end")).alias("at"))
    listed = best.groupBy(F.col("d").alias("_llm_e"), F.col("h").alias("_llm_g")).agg(
        F.sort_array(F.collect_list(F.struct("item_id", "at.distance", "at.end"))).cast(_KIND).alias("_llm_items")
    )
    same = (F.col("_llm_d") == F.col("_llm_e")) & (F.col("_llm_h") == F.col("_llm_g"))
    joined = docs.select("*", d.alias("_llm_d"), h.alias("_llm_h")).join(listed, same, "left")
    items = F.coalesce("_llm_items", F.array().cast(_KIND)).alias(name)
    return joined.select(*[F.col(quoted) for quoted in (f"`{c}`" for c in docs.columns)], items)


def contaminations(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents with an added column ``items``: structs ``item_id``, ``distance``, ``end`` of benchmark items in them.

    An item counts if some part of the text is within ``share`` of its length in
    edits (both normalised). One shorter than ``shortest`` characters has no room for
    edits: it counts where it stands unchanged between word boundaries, and one of
    fewer than ``least_words`` words, which any text may hold, only if it is the whole
    text. ``end`` is where the part ends in the normalised text. The benchmark is
    held in slices of ``slice_bytes``, one at a time.

    Items without number or text match nothing, null and empty documents hold
    nothing; repeated rows are treated alike; an extra column ``items`` is replaced;
    empty tables on either side give no matches.
    """
    return _marked(docs.drop("items"), benchmark, "items", **options)


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that hold no benchmark item, in the columns they came with."""
    return _marked(docs, benchmark, "_llm_found", **options).where(F.size("_llm_found") == 0).drop("_llm_found")
