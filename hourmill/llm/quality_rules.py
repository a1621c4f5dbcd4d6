"""Quality rules: fixed counts per document, and how far its characters and common words are from its language's.

The reference of a language is counted over all its documents: the median share of each
class of characters, which junk does not move, and how often each of its common words
occurs. A document's own two histograms are held against them by the Jensen-Shannon distance (0: equal, 1: nothing
in common). A small sample is always some way off, so the allowed distance grows as a text
gets shorter, and texts below a minimum length are not judged by that histogram at all.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import chunks, gram_hashes, mixed, quoted, saved, with_columns

UNKNOWN_LANGUAGE = "und"
WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30
SYMBOLS = b"#*$%&|<>"
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUED = bytes(range(0x80, 0xC0))

#: Names of the character classes, by the first byte of a character.
CLASSES = ["vowel", "consonant", "capital", "digit", "space", "line end", "full stop", "other sign", "symbol", "control", "accented", "wide"]


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other sign"), np.uint8)
    members = {
        "vowel": b"aeiou",
        "consonant": bytes(c for c in range(0x61, 0x7B) if c not in b"aeiou"),
        "capital": bytes(range(0x41, 0x5B)),
        "digit": bytes(range(0x30, 0x3A)),
        "space": b" \t",
        "line end": b"\n\r\x0b\x0c",
        "full stop": b".,;:?",
        "symbol": SYMBOLS,
        "control": bytes(c for c in range(0x20) if c not in b"\t\n\r\x0b\x0c") + b"\x7f",
        "accented": bytes(range(0xC0, 0xE0)),
        "wide": bytes(range(0xE0, 0x100)),
    }
    for name, values in members.items():
        table[list(values)] = CLASSES.index(name)
    table[0x80:0xC0] = len(CLASSES)  # not the start of a character
    return table


_CLASS = _class_table()
# Words of the histograms: small letters, without signs.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 32 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)

_COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("item", pa.string()), ("share", pa.int32()), ("n", pa.int64())])
#: Shares of a class are counted in steps of one in so many.
_STEPS = 1000
_RESULTS = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType())]
    + [T.StructField(name, T.DoubleType()) for name in ("char_distance", "word_distance")]
    + [T.StructField("kept", T.BooleanType())]
)


@dataclass(frozen=True)
class Limits:
    """When a document is too far off.

    ``chars`` and ``words`` are Jensen-Shannon distances that a long text may have, ``min_chars`` and ``min_words`` the
    lengths from which a histogram is judged. A word is common if it is ``common_share`` of its language's words, so
    there are at most ``1 / common_share``. A language is a reference with ``min_reference`` words and ``min_share``
    of all words, so there are at most ``1 / min_share``.
    """

    chars: float = 0.17
    words: float = 0.36
    min_chars: int = 200
    min_words: int = 50
    common_share: float = 0.005
    min_reference: int = 2_000
    min_share: float = 1e-4


def class_histogram(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def js_distance(a: np.ndarray, b: np.ndarray) -> float:
    """The Jensen-Shannon distance of two histograms (base 2); an empty one is at no distance."""
    if not a.sum() or not b.sum():
        return 0.0
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(parts.sum() / 2, 0.0)))


def allowance(bins: int, n: int) -> float:
    """About how far a sample of ``n`` from the reference itself would be."""
    return float(np.sqrt(max(bins - 1, 0) / (8 * np.log(2) * n)))


def _counter(min_chars: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents per share of a class, and words, of a task's texts, added up every now and then."""
        classes: dict[str, Counter] = defaultdict(Counter)
        words: dict[str, Counter] = defaultdict(Counter)

        def added_up() -> Iterator[pa.RecordBatch]:
            rows = [(lang, "class", CLASSES[c], share, n) for lang, counts in classes.items() for (c, share), n in counts.items()]
            rows += [(lang, "word", w.decode(errors="replace"), 0, n) for lang, counts in words.items() for w, n in counts.items()]
            classes.clear()
            words.clear()
            if rows:
                yield from pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _COUNTS)], schema=_COUNTS).to_batches(1 << 16)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                said = text.as_py()
                histogram = class_histogram(said)
                if (size := int(histogram.sum())) >= min_chars:
                    classes[lang].update(enumerate((histogram * _STEPS // size).tolist()))
                words[lang].update(folded_words(said))
                if sum(map(len, words.values())) > 1 << 18:
                    yield from added_up()
        yield from added_up()

    return count


def language_references(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Character classes and common words per language, counted over all documents.

    Columns ``lang``, ``kind`` (``class``, ``word``, or ``words`` for the number of all words), ``item`` and ``n``: the median
    share of a class, in thousandths of the documents' characters, or the number of words.
    """
    texts = docs.select(
        F.coalesce(quoted("lang").cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), quoted("text").cast("string").cast("binary").alias("text")
    ).where("octet_length(text) > 0")
    counted = texts.mapInArrow(_counter(limits.min_chars), "lang string, kind string, item string, share int, n long")
    counts = saved(counted.groupBy("lang", "kind", "item", "share").agg(F.sum("n").alias("n")), "histograms")
    sizes = counts.where("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("size"))
    every = sizes.agg(F.sum("size")).first()[0] or 0
    large = sizes.where(F.col("size") >= max(limits.min_reference, every * limits.min_share))
    known = counts.join(F.broadcast(large), "lang")
    common = known.where((F.col("kind") == "word") & (F.col("n") >= F.col("size") * limits.common_share)).drop("size", "share")
    median = F.expr("cast(percentile(share, 0.5, n) AS long) AS n")
    classes = known.where("kind = 'class'").groupBy("lang", "kind", "item").agg(median)
    return common.unionByName(classes).unionByName(large.select("lang", F.lit("words").alias("kind"), F.lit("").alias("item"), F.col("size").alias("n")))


def repeated_words(ids: np.ndarray, text_of: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text, its words in windows that it holds twice or more."""
    count = len(ids) - WINDOW + 1
    none = np.zeros(n_texts, np.int64)
    if count <= 0:
        return none
    inside = np.flatnonzero(text_of[:count] == text_of[WINDOW - 1 :])
    keys = gram_hashes(mixed(ids.astype(np.uint64) + np.uint64(1)), WINDOW)[inside] + mixed(text_of[inside].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = inside[order[np.r_[same, False] | np.r_[False, same]]]
    if not len(twice):
        return none
    # Equal hashes are looked at word by word: numbers of windows that are really equal, within one text.
    windows = np.stack([text_of[twice], *[ids[twice + i] for i in range(WINDOW)]], axis=1)
    adjacent = (windows[1:] == windows[:-1]).all(axis=1)
    hashed = keys[order][np.r_[same, False] | np.r_[False, same]]
    if (adjacent == (hashed[1:] == hashed[:-1])).all():
        real = twice
    else:
        _, group, size = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        real = twice[size[group.ravel()] > 1]
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, real, 1)
    np.add.at(change, real + WINDOW, -1)
    return np.bincount(text_of[np.cumsum(change[:-1]) > 0], minlength=n_texts)


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The fixed counts of some texts."""
    numbers: dict[bytes, int] = {}
    ids: list[int] = []
    out: dict[str, list[int]] = {"n_words": [], "word_chars": [], "n_symbols": [], "n_dup_lines": []}
    for text in texts:
        words = text.split()
        ids += [numbers.setdefault(w, len(numbers)) for w in words]
        lines = [line for line in text.split(b"\n") if line.strip()]
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text.translate(None, _SPACES + _CONTINUED)))
        out["n_symbols"].append(len(text) - len(text.translate(None, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    counts = {name: np.array(values, np.int64) for name, values in out.items()}
    text_of = np.repeat(np.arange(len(texts)), counts["n_words"])
    counts["n_repeat_words"] = repeated_words(np.array(ids, np.int64), text_of, len(texts))
    return counts


class Reference:
    """One language's histograms; the last bin of the words is all that are not common."""

    def __init__(self, rows: list[dict]):
        by = {(r["kind"], r["item"]): r["n"] for r in rows}
        self.classes = np.array([by.get(("class", name), 0) for name in CLASSES], float)
        self.place = {item.encode(): i for i, item in enumerate(sorted(item for kind, item in by if kind == "word"))}
        common = [by["word", item.decode()] for item in self.place]
        self.words = np.array([*common, by.get(("words", ""), 0) - sum(common)], float)

    def distances(self, text: bytes, limits: Limits) -> tuple[float | None, float | None, bool]:
        """The two distances, None where a text is too short for one, and whether both are allowed."""
        chars, words, fine = None, None, True
        classes = class_histogram(text)
        if classes.sum() >= limits.min_chars:
            chars = js_distance(classes, self.classes)
            fine = chars <= limits.chars + allowance(np.count_nonzero(self.classes), classes.sum())
        found = folded_words(text)
        if len(found) >= limits.min_words:
            other = len(self.words) - 1
            get = self.place.get
            histogram = np.bincount([get(w, other) for w in found], minlength=other + 1)
            words = js_distance(histogram, self.words)
            fine &= words <= limits.words + allowance(len(self.words), len(found))
        return chars, words, bool(fine)


def _judge(known, keep: list[str], schema: pa.Schema, limits: Limits):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, list[dict]] = defaultdict(list)
        for row in known.value:
            by_lang[row["lang"]].append(row)
        references = {name: Reference(rows) for name, rows in by_lang.items()}
        for whole in batches:
            said = whole.column("_text").to_pylist()
            for lo, hi in chunks(said):
                batch = whole.slice(lo, hi - lo)
                texts = [t or b"" for t in said[lo:hi]]
                found = base_counts(texts)
                failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEATED * found["n_words"])
                judged = [
                    references[name].distances(t, limits) if name in references else (None, None, True)
                    for name, t in zip(batch.column("_lang").to_pylist(), texts)
                ]
                chars, words, fine = zip(*judged)
                new = found | {
                    "base_failed": failed, "char_distance": chars, "word_distance": words, "kept": ~failed & np.array(fine, bool)
                }
                yield with_columns(batch, keep, {f.name: pa.array(new[f.name], f.type) for f in schema})

    return judge


def judge_quality(docs: DataFrame, references: DataFrame | None = None, limits: Limits = Limits()) -> DataFrame:
    """Documents with their counts, distances and verdict.

    Added columns: ``n_words`` (words between white space 0x20, 0x09-0x0D), ``word_chars`` (code points in them), ``n_symbols``
    (``#*$%&|<>``), ``n_dup_lines`` (lines with a word that equal an earlier one), ``n_repeat_words`` (words in runs of eight found
    twice or more), ``base_failed`` (under 20 words, or over 30 % of them repeated), ``char_distance`` and ``word_distance`` (null where
    the text is too short or its language no reference) and ``kept`` (not failed, and no distance beyond what `Limits` allow).
    ``references`` come from `language_references`, by default of these documents.

    A null text is empty, hence failed; a null language is ``und``; a null ``doc_id`` is a document as any other; repeated rows
    are judged each; columns named as an added one are replaced, others carried; without rows there is no result. A text is
    judged whole, in one task.
    """
    rows = (language_references(docs, limits) if references is None else references).toArrow().to_pylist()
    known = docs.sparkSession.sparkContext.broadcast(rows)  # at most 1 / min_share languages of 1 / common_share words
    keep = [c for c in docs.columns if c not in _RESULTS.names]
    lang = F.coalesce(quoted("lang").cast("string"), F.lit(UNKNOWN_LANGUAGE)) if "lang" in docs.columns else F.lit(UNKNOWN_LANGUAGE)
    prepared = docs.select(*[quoted(c) for c in keep], quoted("text").cast("string").cast("binary").alias("_text"), lang.alias("_lang"))
    schema = T.StructType([docs.schema[c] for c in keep] + _RESULTS.fields)
    return prepared.mapInArrow(_judge(known, keep, to_arrow_schema(_RESULTS), limits), schema)
