"""Exact removal of repeated word windows (super-k-mer partitioning).

Of every document's windows of ``window`` words, consecutive ones that share a
minimiser (the smallest hash among the window's three-word grams) travel together
as one packed string to the bucket of that gram. Equal windows have equal
minimisers, so they meet in one bucket, where rows come sorted by place and a
window seen before is a repeat. Comparison is of words, hashes only route.

Scale: a first pass counts grams per task and sums them; windows of grams above
``hot_rows`` travel one by one to buckets of their own, so that no passage, however
common, gathers its surroundings in one task. Copies of a packed string within a
task are settled before the shuffle. The same pass picks the commonest words of
each part for one- and two-byte codes (at most ``CODES``), which halves the strings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, chunks, gram_hashes, identity, packed, released, table_of, word_hashes

GRAM = 3
#: Words with one-, two- and three-byte codes.
BY_LENGTH = (128, 112 << 8, 4 << 16)
CODES, LONGEST_CODED = sum(BY_LENGTH), 40
MAX_HOT_KEYS = 1 << 20
ALONE = -(1 << 63)
SEEN_LIMIT = 50_000
#: Texts whose words a task holds at a time, in bytes; words it counts before it drops rare ones; rows it sends at once.
HELD_BYTES, MAX_WORDS, SENT = 1 << 19, CODES + CODES // 2, 1 << 14
#: Grams compare by their bits above these, which hold a place while the smallest is looked for.
PLACE_BITS = 20

_STATS = "kind int, key long, word binary, n long"
_SUPER = "key long, d long, h long, start int, n int, words binary"
_SPANS = "d long, h long, lo int, hi int"
_SUPER_ARROW = pa.schema(
    [("key", pa.int64()), ("d", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("words", pa.binary())]
)
_SPANS_ARROW = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
_STATS_ARROW = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])


class Codes(dict):
    """Self-delimiting codes of words, joined by spaces: one to three bytes, or the word between 0xFE and 0xFF."""

    def __init__(self, words: bytes):
        one, two, _ = BY_LENGTH
        for i, w in enumerate(words.split(b" ")[:CODES] if words else ()):
            if i < one:
                self[w] = bytes([i])
            elif i < one + two:
                self[w] = (0x8000 + i - one).to_bytes(2)
            else:
                self[w] = (0xF00000 + i - one - two).to_bytes(3)

    def __missing__(self, word: bytes) -> bytes:
        return b"\xfe" + word + b"\xff"


def _places(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest gram among every ``width`` consecutive ones."""
    found = np.empty(max(len(grams) - width + 1, 0), np.int64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    step = (1 << PLACE_BITS) - width + 1
    for lo in range(0, len(found), step):
        part = grams[lo : lo + step + width - 1]
        least = part & ~low | np.arange(len(part), dtype=np.uint64)
        size = 1
        while size < width:  # smallest of ``size`` ones, from two ranges that may overlap
            by = min(size, width - size)
            least = np.minimum(least[:-by], least[by:])
            size += by
        found[lo : lo + len(least)] = (least & low).astype(np.int64) + lo
    return found


def _runs(hashes: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers of documents of ``lengths`` words, hashed one after another: document, first window, number of windows, gram."""
    windows = np.maximum(lengths - window + 1, 0)
    before = np.cumsum(lengths) - lengths
    at = np.arange(windows.sum()) + np.repeat(before - (np.cumsum(windows) - windows), windows)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, none
    grams = gram_hashes(hashes, GRAM)
    place = _places(grams, window - GRAM + 1)[at]
    firsts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])  # documents share no places
    counts = np.diff(np.r_[firsts, len(at)])
    return np.repeat(np.arange(len(lengths)), windows)[firsts], at[firsts], counts, grams[place[firsts]].view(np.int64)


def _apart(starts: np.ndarray, counts: np.ndarray, keys: np.ndarray, hot: np.ndarray):
    """Super-k-mers with those of hot grams taken apart into single windows, whose bucket is still open, and where each was."""
    times = np.where(hot, counts, 1)
    which = np.repeat(np.arange(len(times)), times)
    begins = starts[which] + np.arange(len(which)) - (np.cumsum(times) - times)[which]
    return which, begins, np.where(hot, 1, counts)[which], np.where(hot, ALONE, keys)[which]


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether keys are among known ones, which are sorted."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return known[at] == keys


def _words(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of texts one after another, their hashes, and how many each text has."""
    words: list[bytes] = []
    raw = [(t or "").encode() for t in texts]
    lengths = np.zeros(len(raw), np.int64)
    for i, text in enumerate(raw):
        before = len(words)
        words += text.split()
        lengths[i] = len(words) - before
    return words, word_hashes(b" ".join(raw)), lengths


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``HELD_BYTES`` bytes together."""
    part = np.cumsum(sizes) // HELD_BYTES
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(edges, edges[1:]) if a < b)


def _sizes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _survey(window: int):
    """Per task: how often super-k-mers of a gram occur (from twice on), and its commonest words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, words = np.empty(0, np.int64), {}
        counts = np.empty(0, np.int64)
        pending: list[np.ndarray] = []
        size = 0

        def fold():
            nonlocal keys, counts, pending, size
            if pending:
                new, n = np.unique(np.concatenate(pending), return_counts=True)
                both, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                keys, counts = both, np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)
                pending, size = [], 0

        for batch in batches:
            texts = batch.column(0)
            for lo, hi in _groups(_sizes(texts)):
                parts, hashes, lengths = _words(texts.slice(lo, hi - lo).to_pylist())
                by = np.argsort(hashes)
                firsts = np.flatnonzero(np.r_[True, np.diff(hashes[by]) != 0])[: len(by)]
                times = np.diff(np.r_[firsts, len(by)])
                for i, n in zip(by[firsts].tolist(), times.tolist()):
                    words[parts[i]] = words.get(parts[i], 0) + n
                least = 1
                while len(words) > (CODES if least > 1 else MAX_WORDS):
                    words = {w: n for w, n in words.items() if n > least}
                    least += 1
                pending.append(_runs(hashes, lengths, window)[3])
                size += len(pending[-1])
                if size > 1 << 18:
                    fold()
        fold()
        often = counts > 1
        keys, counts = keys[often], counts[often]
        top = [(w, n) for w, n in words.items() if n > 2 and len(w) <= LONGEST_CODED]
        for lo in range(0, len(keys), SENT):
            part = keys[lo : lo + SENT]
            yield table_of({"kind": [0] * len(part), "key": part, "word": [None] * len(part), "n": counts[lo : lo + SENT]}, _STATS_ARROW)
        for lo in range(0, len(top), SENT):
            part = top[lo : lo + SENT]
            columns = {"kind": [1] * len(part), "key": [None] * len(part), "word": [w for w, _ in part], "n": [n for _, n in part]}
            yield table_of(columns, _STATS_ARROW)

    return run


class Seen:
    """Packed strings and the first place each had, remembered up to a bound; places are numbers of an array, not objects."""

    def __init__(self):
        self.at: dict[bytes, int] = {}
        self.places = np.empty((SEEN_LIMIT, 3), np.int64)

    def earlier(self, piece: bytes, place: tuple[int, int, int]) -> bool:
        """Whether the string was seen at an earlier place; if not, it is now seen at this one."""
        known = self.at.get(piece)
        if known is not None and tuple(self.places[known].tolist()) < place:
            return True
        if known is None:
            if len(self.at) >= SEEN_LIMIT:
                self.at.clear()
            known = self.at[piece] = len(self.at)
        self.places[known] = place
        return False


def _split(window: int, coded: bytes, hot: np.ndarray):
    """Super-k-mers of documents, less those an earlier equal one of the same task makes repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(coded)
        seen = Seen()
        for batch in batches:
            d_all, h_all = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            order = np.lexsort((h_all, d_all))
            texts = batch.column(2)
            for lo, hi in _groups(_sizes(texts)[order]):
                rows = order[lo:hi]
                words, hashes, lengths = _words(texts.take(pa.array(rows)).to_pylist())
                docs, starts, counts, keys = _runs(hashes, lengths, window)
                if not len(docs):
                    continue
                common = _among(keys, hot)
                if common.any():
                    which, starts, counts, keys = _apart(starts, counts, keys, common)
                    docs = docs[which]
                packed = list(map(codes.__getitem__, words))
                at = np.zeros(len(words) + 1, np.int64)
                np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)), out=at[1:])
                blob = b"".join(packed)
                d, h = d_all[rows][docs], h_all[rows][docs]
                begins = starts - (np.cumsum(lengths) - lengths)[docs]
                buckets = keys.tolist()
                pieces = [blob[a:b] for a, b in zip(at[starts].tolist(), at[starts + counts - 1 + window].tolist())]
                for k, place in enumerate(zip(d.tolist(), h.tolist(), begins.tolist())):
                    piece = pieces[k]
                    if seen.earlier(piece, place):
                        pieces[k] = None
                        buckets[k] ^= place[0]
                    elif buckets[k] == ALONE:
                        buckets[k] = xxhash.xxh3_64_intdigest(piece) - (1 << 63)
                columns = {"key": buckets, "d": d, "h": h, "start": begins, "n": counts, "words": pieces}
                for first in range(0, len(d), SENT):
                    yield table_of({name: c[first : first + SENT] for name, c in columns.items()}, _SUPER_ARROW)

    return run


def _merged(flags: list[int], start: int, window: int) -> Iterator[tuple[int, int]]:
    """Word ranges of repeated windows, given by their places in a string that begins at word ``start``."""
    lo = last = None
    for j in flags:
        if lo is None:
            lo = j
        elif j > last + window:
            yield start + lo, start + last + window
            lo = j
        last = j
    if lo is not None:
        yield start + lo, start + last + window


def _count(window: int):
    """Rows sorted by bucket and place: the word ranges of windows seen before in their bucket."""
    code = re.compile(rb"[\x00-\x7f]|[\x80-\xef].|[\xf0-\xf3]..|\xfe[^\xff]*\xff", re.DOTALL)

    def windows(words: bytes) -> list[bytes]:
        ends = [m.end() for m in code.finditer(words)]
        begins = [0, *ends[:-1]]
        return [words[begins[j] : ends[j + window - 1]] for j in range(len(ends) - window + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, only, seen, wholes = None, None, {}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            out: dict[str, list] = {f.name: [] for f in _SPANS_ARROW}

            def emit(d, h, spans):
                for lo, hi in spans:
                    out["d"].append(d), out["h"].append(h), out["lo"].append(lo), out["hi"].append(hi)

            keys = batch.column(0).to_numpy(zero_copy_only=False)
            changes = keys[1:] != keys[:-1]
            # The only string of a bucket repeats nothing; the first and the last row may go on in other batches.
            alone = np.r_[False, changes] & np.r_[changes, False] & batch.column(5).is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(~alone))
            for key, d, h, start, n, words in zip(*[c.to_pylist() for c in batch.columns]):
                if words is None:
                    emit(d, h, [(start, start + n - 1 + window)])
                    continue
                place = d, h, start
                if key != now:
                    now, only, seen, wholes = key, words, {}, {words: place}
                    continue
                if wholes.setdefault(words, place) < place:  # and so is each of its windows
                    emit(d, h, [(start, start + n - 1 + window)])
                    continue
                if only is not None:
                    first = wholes[only]
                    for j, w in enumerate(windows(only)):
                        seen.setdefault(w, (*first[:2], first[2] + j))
                    only = None
                flags = []
                for j, w in enumerate(windows(words)):
                    if seen.setdefault(w, (d, h, start + j)) < (d, h, start + j):
                        flags.append(j)
                emit(d, h, _merged(flags, start, window))
            if out["d"]:
                yield table_of(out, _SPANS_ARROW)

    return run


def repeated_spans(docs: DataFrame, window: int = 20, hot_rows: int = 20_000) -> DataFrame:
    """Word ranges ``[lo, hi)`` of documents (``d``, ``h``) covered by windows that also start earlier."""
    if window < GRAM:
        raise ValueError(f"a window has {GRAM} words at least")
    texts = docs.select("text")
    often = (
        texts.mapInArrow(released(_survey(window)), _STATS).groupBy("kind", "key", "word").agg(F.sum("n").alias("n"))
        .where((F.col("kind") == 1) | (F.col("n") > hot_rows))
    )

    def most(stats: DataFrame, kind: int, column: str, limit: int) -> list:
        """The most frequent ones: at most ``limit`` numbers, or words of LONGEST_CODED bytes."""
        top = stats.where(F.col("kind") == kind).orderBy(F.desc("n"), column).limit(limit)
        return [r[column] for r in top.select(column).collect()]

    with Scratch(docs.sparkSession) as scratch:
        stats = scratch.saved(often, "grams")
        hot, words = most(stats, 0, "key", MAX_HOT_KEYS), [bytes(w) for w in most(stats, 1, "word", CODES)]
    supers = docs.select(*identity(), "text").mapInArrow(released(_split(window, b" ".join(words), np.sort(np.array(hot, np.int64)))), _SUPER)
    sorted_rows = supers.repartition("key").sortWithinPartitions("key", "d", "h", "start")
    return sorted_rows.mapInArrow(released(_count(window)), _SPANS)


def substring_dedup(docs: DataFrame, window: int = 20, hot_rows: int = 20_000) -> DataFrame:
    """Documents less every word in a window of ``window`` words that also starts earlier.

    Earlier means in a smaller ``doc_id``, or in the same document before. Windows
    are judged on the input. Added columns, which replace any of these names:
    ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space).

    Null and empty texts have no words and keep an empty text; a null ``doc_id``
    is below all others. Rows with one ``doc_id`` and different texts are separate
    documents in a fixed order; wholly equal rows give equal results, none of them
    earlier than the other. An empty table gives an empty result.
    """
    added = {"n_words": "long", "n_removed": "long", "kept_text": "string"}
    kept_columns = [c for c in docs.columns if c not in added]
    spans = repeated_spans(docs, window, hot_rows).groupBy("d", "h").agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in kept_columns if c != "text"], packed(F.col("text")).alias("text")).alias("row")
    joined = docs.select(row, *identity()).join(spans, ["d", "h"], "left").select("row", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            rows = whole.column(0)
            held = rows.field("text").to_pylist()
            for a, b in chunks(held):
                batch = whole.slice(a, b - a)
                texts, lists = [None if t is None else unpack(t).decode() for t in held[a:b]], batch.column(1).to_pylist()
                n_words, n_removed, kept = [], [], []
                for text, found in zip(texts, lists):
                    words = (text or "").encode().split()
                    gone = 0
                    if found:
                        keep, at = [], 0
                        for lo, hi in sorted((s["lo"], s["hi"]) for s in found):
                            keep += words[at:lo]
                            at = max(at, hi)
                        keep += words[at:]
                        gone = len(words) - len(keep)
                        kept.append(b" ".join(keep).decode())
                    else:
                        kept.append(b" ".join(words).decode())
                    n_words.append(len(words))
                    n_removed.append(gone)
                fields = {f.name: rows.field(f.name).slice(a, b - a) for f in rows.type}
                fields["text"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.StructArray.from_arrays(list(fields.values()), names=list(fields)), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["row", *added],
                )

    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns if c != "text"], F.col("text")).alias("row"))
    types = [T.StructField("row", plain.schema["row"].dataType)]
    types += [T.StructField(n, T.LongType() if t == "long" else T.StringType()) for n, t in added.items()]
    return joined.mapInArrow(released(cut), T.StructType(types)).select(*[F.col(f"row.`{c}`") for c in kept_columns], *added)
