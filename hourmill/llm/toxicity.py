"""Toxicity by a weighted lexicon (Aho-Corasick over folded text).

Folding undoes homoglyphs and, inside words, digits and signs standing for letters.
Terms are beginnings of words; their weights are log-odds learned from labelled
documents. A match that lies in an exception phrase (given, or learned as a word
pair that only harmless documents have) does not count. The matched weight, in all
and relative to length, is turned into a probability by logistic calibration.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, give_back, let_go, released, table_of

MAX_LABELLED = 200_000
MAX_TERMS = 5_000
PREFIXES = (4, 5, 6, 7, 8)
LEAST_DOCS, LEAST_WEIGHT, LEAST_Z = 4, 1.5, 5.0

# Look-alike letters of other scripts, and what stands for letters inside words.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "к": "k",
    "м": "m", "т": "t", "н": "h", "в": "b", "ԁ": "d", "ԛ": "q", "ѡ": "w", "α": "a", "ε": "e", "ο": "o", "ρ": "p",
    "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ß": "ss", "ı": "i", "ɡ": "g", "ⅼ": "l", "ǀ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
_HOMOGLYPHS = str.maketrans({k: v for k, v in HOMOGLYPHS.items() if k != "ß"} | {chr(0xFF21 + i): chr(97 + i) for i in range(26)} | {chr(0xFF41 + i): chr(97 + i) for i in range(26)})
_SUBSTITUTES = str.maketrans(SUBSTITUTES)
_COUNTS_ARROW = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
_MARKED = re.compile(r"[^\W\d_][0134578@$!]|[0134578@$][^\W\d_]")
_DISGUISED = re.compile(r"[\w@$!]*[^\W\d_][\w@$!]*")
_WORD = re.compile(r"[^\W\d_]+")
_INNER = re.compile(r"[0134578@$]|!(?=\w)")


def fold(text: str | None) -> str:
    folded = (text or "").lower().translate(_HOMOGLYPHS)
    if _MARKED.search(folded):
        folded = _DISGUISED.sub(lambda m: _INNER.sub(lambda c: c[0].translate(_SUBSTITUTES), m[0]), folded)
    return folded


@dataclass
class Model:
    """Term weights, exception phrases and calibration (constant, matched weight, weight by length, distinct terms)."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    calibration: tuple[float, ...] = (-30.0, 0.0, 0.0, 0.0)


class Matcher:
    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.automaton = ahocorasick.Automaton()
        for term, weight in model.weights.items():
            self.automaton.add_word(term, (term, weight))
        if model.weights:
            self.automaton.make_automaton()

    def matches(self, folded: str) -> Iterator[tuple[str, float, str, str]]:
        """Per matched word the heaviest term, its weight, and the word with its neighbour before and after."""
        if not self.model.weights:
            return
        best: dict[int, tuple[float, str]] = {}
        for end, (term, weight) in self.automaton.iter(folded):
            start = end - len(term) + 1
            if start and folded[start - 1].isalpha():
                continue
            best[start] = max(best.get(start, (-math.inf, "")), (weight, term))
        for start, (weight, term) in best.items():
            word = _WORD.match(folded, start)[0]
            before = _WORD.findall(folded[max(0, start - 60) : start])[-1:] or [""]
            after = _WORD.search(folded, start + len(word), start + len(word) + 60)
            yield term, weight, f"{before[0]} {word}", f"{word} {after[0] if after else ''}"

    def features(self, folded: str) -> tuple[float, float, float]:
        total, terms = 0.0, set()
        for term, weight, before, after in self.matches(folded):
            if before not in self.model.exceptions and after not in self.model.exceptions:
                total += weight
                terms.add(term)
        words = folded.count(" ") + 1 if terms else 1
        return math.log1p(total), total / math.sqrt(words), float(len(terms))

    def score(self, text: str | None) -> float:
        constant, *slopes = self.model.calibration
        z = constant + sum(s * x for s, x in zip(slopes, self.features(fold(text))))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folded = pa.array([fold(t.as_py()) for t in batch.column("text")], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), folded], names=["toxic", "folded"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word beginning, by label."""
    counts = (Counter(), Counter())

    def rows():
        terms = list(counts[0].keys() | counts[1].keys())
        return table_of(
            {"term": terms, "toxic": [counts[1][t] for t in terms], "clean": [counts[0][t] for t in terms]}, _COUNTS_ARROW
        )

    for batch in batches:
        for toxic, folded in zip(batch.column("toxic").to_pylist(), batch.column("folded")):
            words = set(_WORD.findall(folded.as_py()))
            counts[toxic].update({w[:n] for w in words for n in PREFIXES if len(w) >= n})
            if len(counts[0]) + len(counts[1]) > 1_000_000:
                yield rows()
                counts = (Counter(), Counter())
    yield rows()


def _training(model: Model):
    """Features of labelled documents, and their word pairs with a match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            rows: dict[str, list] = {"pair": [], "toxic": [], "x": []}
            for y, text in zip(batch.column("toxic").to_pylist(), batch.column("folded")):
                folded = text.as_py()
                rows["pair"].append(None), rows["toxic"].append(y), rows["x"].append(matcher.features(folded))
                pairs = {p for _, _, *both in matcher.matches(folded) for p in both}
                for p in pairs:
                    rows["pair"].append(p), rows["toxic"].append(y), rows["x"].append(None)
            types = {"pair": pa.string(), "toxic": pa.int32(), "x": pa.list_(pa.float64())}
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in types.items()], names=list(types))

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _lexicon(rows: list, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Beginnings that toxic documents have far more often; one goes if a shorter one weighs as much."""
    share = n_toxic / max(1, n_toxic + n_clean)
    weights: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r["term"]), r["term"])):
        n1, n0 = r["toxic"], r["clean"]
        expected = (n1 + n0) * share
        z = (n1 - expected) / math.sqrt(max(expected * (1 - share), 1e-9))
        weight = math.log((n1 + 0.5) / (n_toxic + 1)) - math.log((n0 + 0.5) / (n_clean + 1))
        shorter = max((weights.get(r["term"][:k], -math.inf) for k in range(1, len(r["term"]))), default=-math.inf)
        if z >= LEAST_Z and weight >= LEAST_WEIGHT and shorter < weight - 0.7:
            weights[r["term"]] = weight
    heaviest = sorted(weights, key=lambda t: (-weights[t], t))[:MAX_TERMS]
    return {t: weights[t] for t in heaviest}


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    ridge = np.diag([1e-6, *[0.5] * x.shape[1]])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        gradient = design.T @ (y - p) - ridge @ beta
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def fit(
    docs: DataFrame, labels: DataFrame, exceptions: Sequence[str] = (), max_labelled: int = MAX_LABELLED
) -> Model:
    """Learn a model from labelled documents outside the held-out fold.

    At most ``max_labelled`` labelled rows, those of smallest hash, take part; rows
    without number or label do not, and one with several labels is toxic if any says
    so. Without both labels the model scores every document
    practically 0.
    """
    with Scratch(docs.sparkSession) as scratch:  # the model is held by the driver
        return _fit(docs, labels, exceptions, max_labelled, scratch.saved)


def _fit(
    docs: DataFrame, labels: DataFrame, exceptions: Sequence[str], max_labelled: int, saved: Callable[[DataFrame, str], DataFrame]
) -> Model:
    usable = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = saved(
        usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled),
        "labels",
    )
    n_toxic, n_clean = known.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not n_toxic or not n_clean:
        return Model(exceptions=frozenset(exceptions))
    # The labelled texts, folded, once; known has max_labelled pairs of numbers at most.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    labelled = saved(texts.select("toxic", "text").mapInArrow(released(_folded), "toxic int, folded string"), "labelled")
    counts = labelled.mapInArrow(released(_term_counts), "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    chosen = counts.where((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") * n_clean > F.col("clean") * n_toxic * 4))
    chosen = chosen.orderBy(F.desc(F.col("toxic") / (F.col("clean") + 1)), "term").limit(20 * MAX_TERMS)
    model = Model(_lexicon(chosen.collect(), n_toxic, n_clean), frozenset(exceptions))
    kind = "pair string, toxic int, x array<double>"

    def examples(m: Model):
        rows = saved(labelled.mapInArrow(released(_training(m)), kind), "examples")
        return rows.where("pair is null").select("toxic", "x").collect(), rows.where("pair is not null")

    found, pairs = examples(model)
    harmless = (
        pairs.groupBy("pair").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") >= 5) & (F.col("toxic") == 0)).orderBy(F.desc("n"), "pair").limit(MAX_TERMS).collect()
    )
    if harmless:
        model.exceptions |= {r["pair"] for r in harmless}
        found, _ = examples(model)
    found.sort(key=lambda r: (r["toxic"], r["x"]))
    x = np.array([r["x"] for r in found], float).reshape(len(found), 3)
    model.calibration = _calibrate(x, np.array([r["toxic"] for r in found], float))
    return model


def toxicity(text: Column, model: Model) -> Column:
    """Probability that the text is toxic; null and empty texts get that of a text without matches."""

    @F.arrow_udf("double")
    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        matcher = Matcher(model)
        for texts in parts:
            yield pa.array([matcher.score(t.as_py()) for t in texts], pa.float64())
        del matcher
        give_back()

    return scores.asNondeterministic()(text)  # else the optimiser may run it once per use


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """Documents with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    The added columns replace extra ones of these names. Null and empty texts are
    scored like texts without matches; a null ``doc_id`` is not held out; repeated
    rows get equal scores. An empty table gives an empty result.
    """
    model = fit(docs, labels, **options)
    score = toxicity(F.col("text"), model)
    kept = docs.drop("held_out", "score", "predicted")
    scored = kept.select("*", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
