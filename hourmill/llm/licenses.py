"""License statements by a positional rare-token index, in DataFrame functions only.

Templates are short license texts. Their words with positions are the postings. For
each template, the words of highest inverse document frequency among those of its
words that the document holds are looked up; each occurrence votes for the places at
which the template would start there (its own position less the word's in the template).
At every start on which enough of a template's words agree, the template's mandatory
phrases are looked for in the words from there on; its label is given where they stand.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases with their labels, and short texts of public licenses.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template(
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2.0",
        "licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use", "following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        ("permission to use copy modify", "hereby granted"),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
)
RARE_WORDS = 8
AGREEING = 0.6
SLACK = 8
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text, in order."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, _SEPARATORS), lambda w: w != "")


def _positions(templates: tuple[Template, ...]) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        for place, word in enumerate(template.text.split()):
            found.setdefault(word, []).append((t, place))
    return found


def _starts(phrase: str) -> Column:
    """Places in ``hits`` (structs ``i``, ``w`` of vocabulary words) where the phrase begins, judged on ``words``."""
    first, *rest = phrase.split()

    def here(h: Column) -> Column:
        fits = h["w"] == first
        for k, word in enumerate(rest, 1):
            fits = fits & (F.get("words", h["i"] + k) == word)
        return F.coalesce(fits, F.lit(False))

    return F.transform(F.filter("hits", here), lambda h: h["i"])


def _stands(phrase: str, lo: Column, hi: Column) -> Column:
    """Whether the phrase stands within ``words[lo:hi]``."""
    begin = F.greatest(lo, F.lit(0))
    area = F.slice("words", begin + 1, F.greatest(hi - begin, F.lit(0)))
    return F.contains(F.concat(F.lit(" "), F.array_join(area, " "), F.lit(" ")), F.lit(f" {phrase} "))


def scan_licenses(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = BASE_PHRASES
) -> DataFrame:
    """Documents with the licenses they state.

    Added columns, which replace extra ones of these names: ``n_words``, ``n_base``
    (places of base phrases), ``first_word`` and ``last_word`` (smallest and largest
    of them, else null), ``base_labels``, ``labels`` (also those of templates; distinct,
    sorted, comma-joined) and ``score``: the largest share of a template's words that
    agree on its place, 1 with a base phrase, 0 without any license.

    Null, empty and word-less texts have no words and no labels; repeated rows are
    treated alike; other columns may be null or missing; an empty table gives an empty
    result. Inverse document frequencies are counted over all documents.
    """
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    postings = _positions(templates)
    vocabulary = sorted(set(postings) | {p.split()[0] for p, _ in phrases})
    split = docs.drop(*added).withColumn("words", words_of(F.col("text")))

    held = docs.select(F.array_intersect(words_of(F.col("text")), F.array(*[F.lit(w) for w in sorted(postings)])).alias("held"))
    counts = held.select(F.explode("held").alias("w")).groupBy("w").count().collect()  # a row per template word at most
    total = max([r["count"] for r in counts], default=1)
    idf = {w: 1.0 for w in postings} | {r["w"]: 1 + math.log(total / r["count"]) for r in counts}

    indexed = F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("i"), w.alias("w"))))
    located = split.withColumn("hits", F.filter(indexed, lambda h: h.isNotNull()))
    base = located.select("*", *[_starts(p).alias(f"base_{k}") for k, (p, _) in enumerate(phrases)])

    held_words = F.array_distinct(F.filter(F.transform("hits", lambda h: h["w"]), lambda w: w.isin(sorted(postings))))
    base = base.withColumn("held", held_words)

    def rare(template: Template) -> Column:
        """The rarest words of the template that the document holds."""
        own = sorted(set(template.text.split()), key=lambda w: (-idf[w], w))
        return F.slice(F.array_intersect(F.array(*[F.lit(w) for w in own]), "held"), 1, RARE_WORDS)

    base = base.select("*", *[rare(x).alias(f"rare_{t}") for t, x in enumerate(templates)])

    def starts(t: int, template: Template) -> Column:
        """A start of the template per vote, sorted."""
        places: dict[str, list[int]] = {}
        for word, found in postings.items():
            if own := [p for x, p in found if x == t]:
                places[word] = own
        at = F.create_map(*[x for w, p in sorted(places.items()) for x in (F.lit(w), F.array(*[F.lit(i) for i in p]))])
        mine = F.filter("hits", lambda h: F.array_contains(f"rare_{t}", h["w"]))
        return F.sort_array(F.flatten(F.transform(mine, lambda h: F.transform(at[h["w"]], lambda p: h["i"] - p))))

    def edges(t: int) -> Column:
        """Where runs of one start begin in the sorted starts."""
        new = F.transform(f"starts_{t}", lambda x, j: F.when((j == 0) | (F.get(f"starts_{t}", j - 1) != x), j))
        return F.filter(new, lambda j: j.isNotNull())

    def fitting(t: int, template: Template) -> Column:
        """The shares of the words that agree on a start, of all starts at which the template stands."""
        length = len(template.text.split())
        at, first = f"starts_{t}", f"edges_{t}"
        out_of = F.least(F.lit(length), F.greatest(F.size(f"rare_{t}"), F.lit(math.ceil(AGREEING * min(RARE_WORDS, length)))))

        def run(j: Column, r: Column) -> Column:
            n = F.coalesce(F.get(first, r + 1), F.size(at)) - j
            return F.struct(F.get(at, j).alias("start"), (n / out_of).alias("share"))

        def stands(s: Column) -> Column:
            return reduce(lambda a, b: a & b, [_stands(p, s["start"] - SLACK, s["start"] + length + SLACK) for p in template.phrases])

        enough = F.filter(F.transform(first, run), lambda s: s["share"] >= AGREEING)
        return F.transform(F.filter(enough, stands), lambda s: s["share"])

    voted = base.select("*", *[starts(t, x).alias(f"starts_{t}") for t, x in enumerate(templates)])
    voted = voted.select("*", *[edges(t).alias(f"edges_{t}") for t in range(len(templates))])
    voted = voted.select("*", *[fitting(t, x).alias(f"fits_{t}") for t, x in enumerate(templates)])
    found = [F.when(F.size(f"fits_{t}") > 0, F.lit(x.label)) for t, x in enumerate(templates)]
    shares = [F.least(F.coalesce(F.array_max(f"fits_{t}"), F.lit(0.0)), F.lit(1.0)) for t in range(len(templates))]
    bases = [F.col(f"base_{k}") for k in range(len(phrases))]
    places = F.concat(*bases)
    base_labels = F.array_compact(F.array(*[F.when(F.size(b) > 0, F.lit(label)) for b, (_, label) in zip(bases, phrases)]))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    n_base = F.size(places)
    return voted.select(
        *[F.col(f"`{c}`") for c in split.columns if c != "words"],
        F.size("words").cast("long").alias("n_words"),
        n_base.cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.array_compact(F.array(*found)))).alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.greatest(*shares)).alias("score"),
    )
