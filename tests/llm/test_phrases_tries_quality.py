"""Collocations, prefix trie and quality rules against plain Python on small tables."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from hourmill.llm import collocations, prefix_trie, quality_rules
from hourmill.llm.prefix_trie import SparseTable

# --- phrases ---------------------------------------------------------------------------


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_phrases(rows, longest=4, least=30, percent=80, limit=2000):
    """``rows`` of (text, lang)."""
    runs, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    runs[lang][tuple(words[i : i + n])] += 1
    result = []
    for lang, counts in runs.items():
        often = {p: f for p, f in counts.items() if f >= least}
        covered = Counter()
        for p, f in often.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    covered[p[i : i + n]] = max(covered[p[i : i + n]], f)
        found = []
        for p, a in often.items():
            if len(p) > 1 and not (covered[p] and 100 * covered[p] >= percent * a):
                cut = min((2000000 * a // (often[p[:k]] + often[p[k:]]), k) for k in range(1, len(p)))
                found.append((-cut[0], -a, " ".join(p).encode(), often[p[: cut[1]]], often[p[cut[1] :]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:limit], 1):
            result.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(result)


def phrase_rows():
    pick = random.Random(5)
    words = ["a", "b", "c", "New", "york", "é", "ÀB", "\x1fodd", "\xa0joined", "the"]
    rows = []
    for i in range(120):
        said = " ".join(pick.choices(words, [9, 5, 3, 1, 1, 2, 2, 1, 1, 6], k=pick.randint(0, 60)))
        said = said.replace(" b a", ", b\ta").replace("the c", "the. c")
        rows.append((pick.choice([None, i, i]), said, pick.choice(["en", "en", "de", None])))
    rows += [(500, "new york city hall, " * 40, "en"), (501, None, "en"), (502, "", None), (503, " ., \n", "fr"), (504, "one", "it")]
    rows += [(505, "the same row " * 20, "en")] * 3 + [(506, "long " * 5000 + "tail end", "de")]
    return [(d, t, lang, "x", 1) for d, t, lang in rows]


PHRASE_SCHEMA = "doc_id long, text string, lang string, phrase string, f int"


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"fingerprint_bits": 5, "chunk_words": 300},  # nearly all runs share a fingerprint with others
        {"fingerprint_bits": 9, "chunk_words": 2000},
        {"filter_bits": 6, "chunk_words": 1000},  # the filter lets everything through
        {"min_count": 2, "longest": 3},
        {"longest": 5, "limit": 7},
        {"longest": 2, "covered_percent": 10},
    ],
)
def test_collocations(spark, options):
    rows = phrase_rows()
    names = {"longest": "longest", "min_count": "least", "covered_percent": "percent", "limit": "limit"}
    want = brute_phrases([(t, lang) for _, t, lang, *_ in rows], **{names[k]: v for k, v in options.items() if k in names})
    got = collocations.collocations(spark.createDataFrame(rows, PHRASE_SCHEMA).repartition(4), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 5


def test_collocations_parts_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_PART_BYTES", 50)
    rows = phrase_rows()
    chunk = collocations.Chunk()
    for _, text, lang, *_ in rows:
        if text:
            chunk.add(text.encode(), lang or "und")
    monkeypatch.undo()
    whole = collocations.Chunk()
    for _, text, lang, *_ in rows:
        if text:
            whole.add(text.encode(), lang or "und")
    a, b = chunk.closed(), whole.closed()
    assert a.words == b.words and (a.ids == b.ids).all()


def test_run_counter_holds_a_bounded_number_of_words():
    class Known:
        value = b"\xff" * 64

    text = " ".join(f"w{i * i % 4999}" for i in range(3_000)).encode()
    names = ["text", "lang", "text_id"]
    batches = (pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["de"]), pa.array([i])], names=names) for i in range(400))
    count = collocations._run_counter(Known, [2], collocations.CHUNK_WORDS, 64)
    tracemalloc.start()
    try:
        rows = sum(sum(made.column("f").to_pylist()) for made in count(batches))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 400 * 2_999
    assert peak < 100 << 20


def test_collocations_without_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], PHRASE_SCHEMA)).collect() == []
    none = spark.createDataFrame([(1, None, "en", "x", 1), (2, "", None, "x", 1)], PHRASE_SCHEMA)
    assert collocations.collocations(none).collect() == []
    with pytest.raises(ValueError):
        collocations.collocations(none, longest=1)


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([(5 * 10**18, 10**18, 4 * 10**18)], "f long, l long, r long")
    score = counts.selectExpr("cast(cast(f as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r) as long) AS s").first().s
    assert score == 2000000


# --- prefix trie -------------------------------------------------------------------------


def brute_trie(rows):
    """``rows`` of (conv_id, turn, role, text)."""
    told = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            told[c].append(((turn is not None, turn or 0), role or "", text or ""))
    told = {c: [x[1:] for x in sorted(t)] for c, t in told.items()}
    convs = {}
    for c, t in told.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = tuple(told.get(c - int(np.fmod(c, 20)), [])[:h] + t[h:])
    members = defaultdict(list)
    for c, t in sorted(convs.items()):
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    result = {}
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(p))
        result[p] = (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p],
            sum(not children[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(result.values(), key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string, node string, depth string, words string"


def random_turns(seed, n):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(-30, 400), n):
        for turn in range(pick.choice([1, 1, 2, 3, 4, 6])):
            text = pick.choice(["hello there", "hello  there", "yes", "", None, "é ü\x0bx", "word " * 300 if turn == 2 else "no"])
            rows.append((c, pick.choice([turn, turn, None]), pick.choice(["user", "assistant", None]), text))
    rows += [(40, 0, "system", "one opening"), (41, 0, "system", "one opening")] * 2  # repeated rows
    rows += [(c, 0, "system", "one opening") for c in range(1000, 1040)]  # many equal conversations
    rows += [(None, 0, "user", "of nobody")]
    return rows


@pytest.mark.parametrize(("seed", "n", "parts"), [(1, 60, 8), (2, 60, 3), (3, 200, 8), (4, 5, 8)])
def test_prefix_trie(spark, seed, n, parts):
    rows = random_turns(seed, n)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many slices, so that intervals span them
        turns = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TURNS).repartition(5)
        got = sorted((tuple(r[c] for c in TRIE) for r in prefix_trie.prefix_trie(turns).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert got == brute_trie(rows)


def test_prefix_trie_edges(spark):
    def trie(rows):
        made = prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TURNS))
        return sorted((tuple(r[c] for c in TRIE) for r in made.collect()), key=repr)

    assert trie([]) == [] and trie([(None, 1, "user", "x")]) == []
    without_turns = next(c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    assert trie([(without_turns, 0, "user", "gone")]) == brute_trie([(without_turns, 0, "user", "gone")])
    # role and text are told apart
    rows = [(100 + i, 0, *x) for i, x in enumerate([("a", "b:c"), ("a:b", "c"), ("ab", "c"), ("a", "bc"), ("", "a:bc"), ("1:a", "bc")])]
    assert trie(rows) == brute_trie(rows)
    long = [(7, t, "user", f"turn {t}") for t in range(300)] + [(8, t, "user", f"turn {t}") for t in range(299)]
    assert trie(long) == brute_trie(long)


def test_sparse_table_reaches_like_a_scan():
    pick = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = pick.integers(-1, 5, n)
        table = SparseTable(values)
        start, least = pick.integers(0, n, 50), pick.integers(-1, 6, 50)
        for step in (1, -1):
            want = []
            for s, v in zip(start, least):
                while 0 <= s < n and values[s] >= v:
                    s += step
                want.append(s)
            assert table.reach(start, least, step).tolist() == want


# --- quality -----------------------------------------------------------------------------


def brute_base(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    lines = [line for line in text.split("\n") if re.sub("[ \t-\r]", "", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    inside = {p for i, w in enumerate(windows) if count[w] > 1 for p in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def prose(pick, n):
    words = ["the", "of", "and", "river", "stone", "walked", "slowly", "house", "green", "é"] + [f"w{chr(97 + i)}" for i in range(20)]
    weights = [8, 6, 5] + [2] * 7 + [1] * 20
    return " ".join(pick.choices(words, weights, k=n)).replace(" and ", ". And ").replace(" river ", ",\n river ")


def quality_rows():
    pick = random.Random(9)
    texts = [prose(pick, pick.randint(60, 300)) for _ in range(80)]
    texts += [None, "", " \n\t", "one", "x " * 19, "x " * 20, prose(pick, 19), "line one\nline one\n \n \nline two\nline one \n", "a b c d e f g h " * 3]
    texts += ["é\x00#ü |" * 50, "\x1c\x1f \x85 " * 30, prose(pick, 40_000)]
    half = prose(pick, 40)
    texts += [half + " " + half, half + "\n" + prose(pick, 200) + "\n" + half]
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[1]), (3, texts[1])]


def test_quality_base_counts(spark):
    rows = quality_rows()
    schema = "doc_id long, text string, lang string, kept string, n_words string, share int"
    docs = spark.createDataFrame([(d, t, "en", "x", "x", 7) for d, t in rows], schema).repartition(3)
    got = quality_rules.judge_quality(docs).collect()
    assert sorted((repr(r.text), *(r[c] for c in BASE)) for r in got) == sorted((repr(t), *brute_base(t)) for _, t in rows)
    assert all(r.share == 7 and not (r.base_failed and r.kept) for r in got)
    assert quality_rules.judge_quality(docs.limit(0)).collect() == []


def test_repeated_words_survives_equal_hashes(monkeypatch):
    monkeypatch.setattr(quality_rules, "gram_hashes", lambda hashes, n: np.zeros(max(len(hashes) - n + 1, 0), np.uint64))
    texts = [t or "" for _, t in quality_rows() if len(t or "") < 3000]
    got = quality_rules.base_counts([t.encode() for t in texts])["n_repeat_words"]
    assert got.tolist() == [brute_base(t)[4] for t in texts]


def test_quality_verdict(spark):
    pick = random.Random(4)
    good = [prose(pick, pick.randint(80, 400)) for _ in range(150)]
    shouted = [prose(pick, 200).upper().replace(" ", "!! ") for _ in range(5)]
    marked = [prose(pick, 200).replace(" ", "*** ") for _ in range(5)]
    table = [" | ".join(f"cell{i}" for i in range(k, k + 150)) for k in range(5)]
    short = ["#### " * 19 + "@@ @@ end of it now"]
    rows = [(i, t, lang) for lang in ("en", None) for i, t in enumerate(good + shouted + marked + table + short)]
    got = quality_rules.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    kept = {(r.doc_id, r.lang): r.kept for r in got}
    bad = range(len(good), len(good) + 15)
    for lang in ("en", None):
        assert all(kept[i, lang] for i in range(len(good))) and not any(kept[i, lang] for i in bad)
    lone = spark.createDataFrame([(1, shouted[0], "xx")], "doc_id long, text string, lang string")
    (only,) = quality_rules.judge_quality(lone).collect()
    assert only.kept and only.char_distance is None and only.word_distance is None  # too little to be a reference


def test_quality_with_given_references_and_without_lang(spark):
    pick = random.Random(6)
    known = spark.createDataFrame([(i, prose(pick, 300), "und") for i in range(40)], "doc_id long, text string, lang string")
    references = quality_rules.language_references(known)
    new = spark.createDataFrame([(1, prose(pick, 300)), (2, prose(pick, 300).upper())], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in quality_rules.judge_quality(new, references).collect()}
    assert got == {1: True, 2: False}


def test_js_distance():
    assert quality_rules.js_distance(np.array([1, 0]), np.array([0, 3])) == 1
    assert quality_rules.js_distance(np.array([1, 2, 0]), np.array([2, 4, 0])) == 0
    assert quality_rules.js_distance(np.array([0, 0]), np.array([1, 1])) == 0
    p, q = np.array([0.5, 0.5]), np.array([0.9, 0.1])
    m = (p + q) / 2
    want = np.sqrt((sum(p * np.log2(p / m)) + sum(q * np.log2(q / m))) / 2)
    assert abs(quality_rules.js_distance(p * 10, q * 7) - want) < 1e-12
