"""Phrases whose words stand together more often than their parts would suggest, per language.

Texts become numbered words; prefix polynomials over the words' values give the
fingerprint of any run of words by two look-ups (Rabin and Karp). Each task counts its
runs by fingerprint and sends one row for each, with a pointer to an occurrence and a
check value of its words; the shuffle adds them up. Short runs come first: a run can only
be frequent if the runs in it are, so a bit map of frequent fingerprints keeps most
longer runs out of the shuffle. The map has a fixed size and errs on the side of letting
runs through.

Only frequent fingerprints are spelled out, from the text their pointer leads to, where
fingerprint and check are computed once more. Where the checks of a fingerprint
differ, several phrases share it: such fingerprints are looked up in all texts again
and counted by their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mixed, quoted, released, saved

UNKNOWN_LANGUAGE = "und"
LONGEST = 4
FILTER_BITS = 27
#: Words that are counted together before they go to the shuffle; a task holds some 600 bytes for each.
CHUNK_WORDS = 1 << 18
_PART_BYTES = 4 << 20
#: Parts of a language that are ranked by themselves first, so that no task sorts a whole language.
_SPREAD = (1024, 32)

# Bytes that no UTF-8 text holds stand for the end of a piece and the end of a text.
_PIECE, _TEXT = b"\xff", b"\xfe"
_FOLD = bytearray(range(256))
_FOLD[0x41:0x5B] = range(0x61, 0x7B)
for _sign in b".,;:!?\x0a\x0b\x0c\x0d":
    _FOLD[_sign] = 0xFF
_FOLD[0x09] = 0x20
_FOLD = bytes(_FOLD)

_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1664525000)

_COUNTS = pa.schema([("key", pa.int64()), ("f", pa.int64()), ("check", pa.int32()), ("text_id", pa.int64()), ("place", pa.int64())])
_WORDS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
_PHRASES = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("n_parts", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
#: A place holds the words and ends of pieces before a run, and in these bits its length.
_LENGTH_BITS = 4


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class Numbers(dict):
    """Numbers of words by first appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Chunk:
    """Numbered words of some texts, one array for all; numbers 0 and 1 are the ends of pieces and texts."""

    def __init__(self) -> None:
        self.numbers = Numbers({_PIECE: 0, _TEXT: 1})
        self.arrays: list[np.ndarray] = []
        self.langs: list[str] = []
        self.size = 0

    def add(self, text: bytes, lang: str) -> None:
        folded = text.translate(_FOLD)
        start = 0
        while start < len(folded):  # long texts in parts, cut where a piece ends: no run crosses that
            cut = folded.find(_PIECE, start + _PART_BYTES) if len(folded) - start > _PART_BYTES else -1
            end = len(folded) if cut < 0 else cut + 1
            self._number(folded[start:end].replace(_PIECE, b" \xff ").split())
            start = end
        self._number([_TEXT])
        self.langs.append(lang)

    def _number(self, words: list[bytes]) -> None:
        self.arrays.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def closed(self) -> Closed:
        ids = np.concatenate(self.arrays) if self.arrays else np.empty(0, np.int32)
        return Closed(ids, list(self.numbers), self.langs)


class Closed:
    """A full chunk with its prefix polynomials."""

    def __init__(self, ids: np.ndarray, words: list[bytes], langs: list[str]):
        self.ids, self.words, self.langs = ids, words, langs
        self.text_of = np.zeros(len(ids), np.int32)
        np.cumsum(ids[:-1] == 1, out=self.text_of[1:])
        salts = {lang: xxhash.xxh3_64_intdigest(lang.encode()) for lang in set(langs)}
        self.salt_of_text = np.array([salts[lang] for lang in langs], np.uint64)
        values = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.sums = [self._prefix(values, k) for k in (0, 1)]
        self.first_of_text = np.r_[0, np.flatnonzero(ids == 1) + 1]
        self._checks: np.ndarray | None = None

    def _prefix(self, values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of value times power up to each word, and the inverse powers, modulo a prime."""
        prime = np.uint64(_PRIMES[k])
        up, down = _powers(len(self.ids), k)
        terms = (values >> np.uint64(32 * k)) % prime
        sums = np.zeros(len(self.ids) + 1, np.uint64)
        np.cumsum(terms[self.ids] * up[: len(self.ids)] % prime, out=sums[1:])
        return sums, down

    def runs(self, n: int) -> np.ndarray:
        """Starts of runs of ``n`` words within a piece."""
        count = len(self.ids) - n + 1
        if count <= 0:
            return np.empty(0, np.int64)
        word = self.ids > 1
        return np.flatnonzero(reduce(np.logical_and, [word[i : i + count] for i in range(n)]))

    def keys(self, starts: np.ndarray, n: int, bits: int) -> np.ndarray:
        """Fingerprints of runs, told apart by language and length."""
        halves = []
        for k, (sums, down) in enumerate(self.sums):
            prime = np.uint64(_PRIMES[k])
            halves.append((sums[starts + n] - sums[starts]) % prime * down[starts] % prime)
        key = mixed((halves[0] << np.uint64(31) | halves[1]) + self.salt_of_text[self.text_of[starts]] + np.uint64(n))
        return key >> np.uint64(64 - bits)

    def checks(self, starts: np.ndarray, n: int) -> np.ndarray:
        """32-bit values of the words of runs that owe nothing to the polynomials."""
        if self._checks is None:
            self._checks = np.fromiter((xxhash.xxh3_64_intdigest(w, 1) for w in self.words), np.uint64, len(self.words))
        total = self.salt_of_text[self.text_of[starts]]
        for i in range(n):
            total = mixed(total) + self._checks[self.ids[starts + i]]
        return (mixed(total) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def phrase(self, start: int, n: int) -> str:
        return b" ".join(self.words[i] for i in self.ids[start : start + n]).decode(errors="replace")


_KEPT_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo a prime, by doubling."""
    kept = _KEPT_POWERS.get(k)
    if kept is None or len(kept[0]) < n:
        prime = _PRIMES[k]
        both = []
        for base in (_BASES[k], pow(_BASES[k], -1, prime)):
            powers = np.ones(1, np.uint64)
            while len(powers) < max(n, CHUNK_WORDS):
                powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), prime)) % np.uint64(prime)])
            both.append(powers)
        kept = both[0], both[1]
        if n <= 2 * CHUNK_WORDS:  # a longer one is of a single very long text: not kept
            _KEPT_POWERS[k] = kept
    return kept


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Closed, list[tuple]]]:
    """Texts as chunks, with the other columns of their rows."""
    chunk, others = Chunk(), []
    for batch in batches:
        for text, lang, *other in zip(*[batch.column(name) for name in batch.schema.names]):
            chunk.add(text.as_py(), lang.as_py())
            others.append(other)
            if chunk.size >= size:
                yield chunk.closed(), others
                chunk, others = Chunk(), []
    if chunk.langs:
        yield chunk.closed(), others


def _frame(schema: pa.Schema, *columns: object) -> Iterator[pa.RecordBatch]:
    """Rows in batches that stay small for the reader."""
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    yield from table.to_batches(max_chunksize=1 << 16)


def _groups(differs: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where groups begin among ``n`` sorted rows, given where a row differs from the one before, and their sizes."""
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    firsts = np.flatnonzero(np.r_[True, reduce(np.logical_or, differs)])
    return firsts, np.diff(np.r_[firsts, n])


def _word_counter(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _ in _chunks(batches, size):
            names = list(dict.fromkeys(chunk.langs))
            place = {lang: i for i, lang in enumerate(names)}
            code = np.array([place[lang] for lang in chunk.langs], np.int64)
            at = chunk.runs(1)
            both = np.sort(code[chunk.text_of[at]] * len(chunk.words) + chunk.ids[at])
            firsts, counts = _groups([both[1:] != both[:-1]], len(both))
            lang, word = np.divmod(both[firsts], len(chunk.words))
            yield from _frame(_WORDS, [names[i] for i in lang], [chunk.words[i].decode(errors="replace") for i in word], counts)

    return count


def _word_keys(bits: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            numbers = Numbers({_PIECE: 0, _TEXT: 1})
            ids = [x for word in words for x in (numbers[word.encode()], 1)]  # each word a text of its own
            chunk = Closed(np.array(ids, np.int32), list(numbers), langs)
            yield pa.RecordBatch.from_arrays([pa.array(chunk.keys(chunk.runs(1), 1, bits).view(np.int64))], names=["key"])

    return keys


def _holds(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slots = keys & np.uint64(len(known) * 8 - 1)
    return (known[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _run_counter(known, lengths: list[int], size: int, bits: int):
    """Runs of some lengths whose own runs of the length before all pass the filter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(known.value, np.uint8)
        inner = lengths[0] - 1
        for chunk, others in _chunks(batches, size):
            passes = np.zeros(len(chunk.ids) + lengths[-1], bool)
            shorter = chunk.runs(inner)
            passes[shorter[_holds(bitmap, chunk.keys(shorter, inner, bits))]] = True
            text_ids = np.array([x.as_py() for x, in others], np.int64)
            for n in lengths:
                starts = chunk.runs(n)
                starts = starts[reduce(np.logical_and, [passes[starts + i] for i in range(n - inner + 1)])]
                keys, checks = chunk.keys(starts, n, bits), chunk.checks(starts, n)
                order = np.argsort(keys, kind="stable")
                keys, checks, starts = keys[order], checks[order], starts[order]
                firsts, counts = _groups([keys[1:] != keys[:-1], checks[1:] != checks[:-1]], len(keys))
                starts = starts[firsts]
                texts = chunk.text_of[starts]
                at = starts - chunk.first_of_text[texts]
                yield from _frame(
                    _COUNTS, keys[firsts].view(np.int64), counts, checks[firsts], text_ids[texts], at << _LENGTH_BITS | n
                )

    return count


def _reader(size: int, bits: int):
    """The words that pointers into texts lead to, where fingerprint and check agree."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, others in _chunks(batches, size):
            lists = [pointers.values for pointers, in others]
            sizes = [len(p) for p in lists]
            place, key, check, f = (np.concatenate([p.field(name).to_numpy() for p in lists]) for name in ("place", "key", "check", "f"))
            starts = np.repeat(chunk.first_of_text[: len(sizes)], sizes) + (place >> _LENGTH_BITS)
            lengths = place & (1 << _LENGTH_BITS) - 1
            starts = np.minimum(starts, len(chunk.ids) - 1)
            for n in np.unique(lengths):
                mine = np.flatnonzero((lengths == n) & (starts + n < len(chunk.ids)))
                same = (chunk.keys(starts[mine], n, bits).view(np.int64) == key[mine]) & (
                    chunk.checks(starts[mine], n) == check[mine]
                )
                mine = mine[same]
                langs = [chunk.langs[t] for t in chunk.text_of[starts[mine]]]
                phrases = [chunk.phrase(s, n) for s in starts[mine]]
                yield from _frame(_PHRASES, key[mine], langs, np.full(len(mine), n), phrases, f[mine])

    return read


def _speller(known, longest: int, size: int, bits: int):
    """All runs whose fingerprints pass the filter, counted by their words."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(known.value, np.uint8)
        for chunk, _ in _chunks(batches, size):
            for n in range(2, longest + 1):
                starts = chunk.runs(n)
                keys = chunk.keys(starts, n, bits)
                passing = _holds(bitmap, keys)
                keys, starts = keys[passing], starts[passing]
                order = np.argsort(keys, kind="stable")
                keys, starts = keys[order], starts[order]
                salts = chunk.salt_of_text[chunk.text_of[starts]]
                differs = [keys[1:] != keys[:-1], salts[1:] != salts[:-1]]
                differs += [(w := chunk.ids[starts + i])[1:] != w[:-1] for i in range(n)]
                firsts, counts = _groups(differs, len(keys))
                starts = starts[firsts]
                langs = [chunk.langs[t] for t in chunk.text_of[starts]]
                yield from _frame(
                    _PHRASES, keys[firsts].view(np.int64), langs, np.full(len(firsts), n), [chunk.phrase(s, n) for s in starts], counts
                )

    return spell


def _filter_of(keys: DataFrame, filter_bits: int):
    """A bit map of keys, put together by Spark and at most ``2 ** filter_bits`` bits long, sent to all executors."""
    slot = F.col("key").bitwiseAND(F.lit((1 << filter_bits) - 1))
    word, bit = F.shiftright(slot, 6).cast("int"), slot.bitwiseAND(F.lit(63)).cast("int")
    words = keys.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit)) AS bits"))
    rows = words.toArrow()
    bitmap = np.zeros(1 << (filter_bits - 6), np.int64)
    bitmap[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(bitmap.tobytes())


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def phrase_counts(
    docs: DataFrame,
    longest: int = LONGEST,
    min_count: int = 30,
    filter_bits: int = FILTER_BITS,
    fingerprint_bits: int = 64,
    chunk_words: int = CHUNK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with ``min_count`` occurrences at least, and the number of words per language.

    The first table has ``lang``, ``n_parts`` (words), ``phrase`` and ``f``. Fewer ``filter_bits`` or
    ``fingerprint_bits`` cost time, not results.
    """
    if not 2 <= longest < 1 << _LENGTH_BITS:
        raise ValueError(f"the longest phrase has 2 to {(1 << _LENGTH_BITS) - 1} words")
    lang = F.coalesce(quoted("lang").cast("string"), F.lit(UNKNOWN_LANGUAGE))
    text = quoted("text").cast("string")
    text_id = F.xxhash64(quoted("doc_id").cast("long"), lang, text)  # should two texts share one, both are read and one agrees
    marked = docs.where(F.octet_length(text) > 0).select(text.cast("binary").alias("text"), lang.alias("lang"), text_id.alias("text_id"))
    texts = marked.select("text", "lang")
    words = saved(texts.mapInArrow(released(_word_counter(chunk_words)), _ddl(_WORDS)).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= min_count)
    known = _filter_of(frequent.mapInArrow(released(_word_keys(fingerprint_bits)), "key long"), filter_bits)
    levels = []
    for lengths in [[2], *[list(range(n, min(n + 2, longest + 1))) for n in range(3, longest + 1, 2)]]:
        counted = marked.mapInArrow(released(_run_counter(known, lengths, chunk_words, fingerprint_bits)), _ddl(_COUNTS))
        level = counted.groupBy("key").agg(
            F.sum("f").alias("f"), F.min("check").alias("check"), F.max("check").alias("other"), F.first("text_id").alias("text_id"), F.first("place").alias("place")
        )  # the two firsts are of one row
        levels.append(saved(level.where(F.col("f") >= min_count), "runs"))
        known.unpersist()  # of the lengths before: not read again
        known = _filter_of(levels[-1].select("key"), filter_bits)
    runs = reduce(DataFrame.unionAll, levels)
    shared = runs.where("check <> other")
    pointers = F.collect_list(F.struct("place", "key", "check", "f")).alias("pointers")  # no more than a text has runs
    per_text = runs.where("check = other").groupBy("text_id").agg(pointers)
    found = marked.join(per_text, "text_id").select("text", "lang", "pointers")
    # A row that is there twice is read twice.
    phrases = found.mapInArrow(released(_reader(chunk_words, fingerprint_bits)), _ddl(_PHRASES)).dropDuplicates(["key"]).drop("key")
    if not shared.isEmpty():
        known = _filter_of(shared.select("key"), filter_bits)
        spelled = texts.mapInArrow(released(_speller(known, longest, chunk_words, fingerprint_bits)), _ddl(_PHRASES))
        own = spelled.join(shared.select("key"), "key", "left_semi").groupBy("lang", "n_parts", "phrase").agg(F.sum("f").alias("f"))
        phrases = phrases.unionAll(own.where(F.col("f") >= min_count))
    single = frequent.select("lang", F.lit(1).alias("n_parts"), "phrase", "f")
    return saved(phrases.unionAll(single), "phrases"), sizes


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    min_count: int = 30,
    covered_percent: int = 80,
    limit: int | None = 2000,
    filter_bits: int = FILTER_BITS,
    fingerprint_bits: int = 64,
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """Phrases of 2 to ``longest`` words per language, best first.

    Texts are lower-cased (A-Z), split at ``[.,;:!?]`` and line ends into pieces and
    those at spaces and tabs into words; phrases stay within a piece, overlaps count.
    A phrase of ``a >= min_count`` occurrences is cut after each of its words into parts
    of ``l`` and ``r`` occurrences; its score is ``floor(2000000 a / (l + r))`` of its
    lowest-scoring cut, the shortest first part among equals. A phrase goes when a
    longer one that holds its words has ``covered_percent`` of its occurrences. Each
    language's first ``limit`` (all, if None) by score and ``a`` descending, then phrase
    (UTF-8 bytes): ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` (words of the
    language) and ``score``.

    Null texts are empty, a null language is ``und``, a null ``doc_id`` counts as any other;
    repeated rows all count; extra columns are not carried; without rows there is no result.
    """
    every, sizes = phrase_counts(docs, longest, min_count, filter_bits, fingerprint_bits, chunk_words)
    candidates = every.where("n_parts > 1")
    inner = F.expr(
        "flatten(transform(sequence(2, n_parts - 1), m -> transform(sequence(1, n_parts - m + 1), i -> "
        "array_join(slice(split(phrase, ' '), i, m), ' '))))"
    )
    covered = (
        candidates.where("n_parts > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    settled = candidates.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("f")) * covered_percent)
    )
    cuts = settled.select("lang", "phrase", "f", F.explode(F.expr("sequence(1, n_parts - 1)")).alias("k"), F.split("phrase", " ").alias("w"))
    parts = cuts.select(
        "lang", "phrase", "f", "k",
        F.expr("array_join(slice(w, 1, k), ' ')").alias("left"), F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("right"),
    )
    for side, count in (("left", "l"), ("right", "r")):
        parts = parts.join(every.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    score = F.expr("cast(cast(f as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r) as long)")
    lowest = (
        parts.select("lang", "phrase", "f", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase").agg(F.min("cut").alias("cut"), F.first("f").alias("f"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = lowest.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    if limit is not None:
        spread = F.xxhash64("phrase")
        for parts in _SPREAD:  # a language's first ones are among the first ones of any part of it
            near = Window.partitionBy("lang", F.pmod(spread, F.lit(parts))).orderBy(*order)
            scored = scored.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= limit).drop("rank")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if limit is not None:
        ranked = ranked.where(F.col("rank") <= limit)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
