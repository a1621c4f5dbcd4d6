"""URL filter: rules first, then a ratio of character language models.

Two variable-order Markov models (a character after up to ``ORDER`` others, each order
backed by the next lower one with Witten-Bell weights) are counted over all distinct
URLs that a rule allows and all that a rule blocks. A URL without a rule is judged by
the difference of its log-likelihoods per character, against a threshold calibrated
on rule-judged URLs kept out of the counts.

The counts are a table: every run of characters of the URLs with its number in each
model. It grows with the URLs and never comes to the driver. Probabilities go up the
orders by one join each, where a row meets at most as many as there are characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released, saved, table_of

ORDER = 6
START, END = "\x02", "\x03"
#: A gram or URL of at least this part of all rows is looked up apart from the others: at most so many are.
SHARE = 4096
#: Log ratios are whole multiples of its reciprocal, so that sums do not move with the order of adding.
UNIT = 1_000_000
SENT = 1 << 16
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_GRAMS_ARROW = pa.schema([("id", pa.binary()), ("kind", pa.int32()), ("gram", pa.string())])


def grams(url: str) -> Iterator[str]:
    """Every character of a URL, and its end, with the ``ORDER`` before it."""
    padded = START * ORDER + url + END
    return (padded[i : i + ORDER + 1] for i in range(len(url) + 1))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, kinds, found = [], [], []
    for batch in batches:
        for name, kind, url in zip(*batch.columns):
            name, kind = name.as_py(), kind.as_py()
            for gram in grams(url.as_py()):
                ids.append(name)
                kinds.append(kind)
                found.append(gram)
                if len(found) == SENT:
                    yield table_of({"id": ids, "kind": kinds, "gram": found}, _GRAMS_ARROW)
                    ids, kinds, found = [], [], []
    yield table_of({"id": ids, "kind": kinds, "gram": found}, _GRAMS_ARROW)


def log_ratios(counts: DataFrame) -> DataFrame:
    """``gram`` and ``ratio``, the log of both models' probabilities of its last character, from ``counts`` (``gram``, ``a``, ``b``).

    ``a`` and ``b`` are its places in allowed and blocked URLs; grams of neither are scored too.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(ORDER)))
    ends = counts.select("a", "b", "gram", level.alias("k"))
    ends = ends.groupBy("k", F.expr("right(gram, k + 1)").alias("said")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # Rows of one context differ in their last character, so a context has at most as many rows as there are characters.
    ends = ends.withColumn("context", F.expr("left(said, k)"))
    contexts = ends.groupBy("k", "context").agg(
        F.sum("a").alias("all_a"), F.count_if(F.col("a") > 0).alias("kinds_a"),
        F.sum("b").alias("all_b"), F.count_if(F.col("b") > 0).alias("kinds_b"),
    )
    ends = saved(ends.join(contexts, ["k", "context"]).drop("context"), "url-grams")
    total = ends.where("k = 0").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total["a"] or not total["b"]:
        return counts.select("gram", F.lit(0).cast("long").alias("ratio"))

    def smoothed(model: str, below: Column) -> Column:
        own, seen, kinds = F.col(model), F.col(f"all_{model}"), F.col(f"kinds_{model}")
        return F.when(seen > 0, (own + kinds * below) / (seen + kinds)).otherwise(below).alias(f"p_{model}")

    alike = F.lit(1 / total["n"])
    lower = ends.where("k = 0").select("said", smoothed("a", alike), smoothed("b", alike))
    for k in range(1, ORDER + 1):
        below = lower.select(F.col("said").alias("rest"), F.col("p_a").alias("below_a"), F.col("p_b").alias("below_b"))
        own = ends.where(F.col("k") == k).withColumn("rest", F.expr(f"right(said, {k})"))
        lower = own.join(below, "rest").select("said", smoothed("a", F.col("below_a")), smoothed("b", F.col("below_b")))
    ratio = F.round((F.log("p_a") - F.log("p_b")) * UNIT).cast("long")
    return lower.select(F.col("said").alias("gram"), ratio.alias("ratio"))


def _looked_up(rows: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with the value of their key; ``values`` marks as ``hot`` keys of many rows, at most ``SHARE``, which need no shuffle."""
    hot = F.broadcast(values.where("hot").select(key, value))
    first = rows.join(hot, key, "left")
    rest = first.where(F.col(value).isNull()).drop(value).join(values.where(~F.col("hot")).select(key, value), key)
    return first.where(F.col(value).isNotNull()).unionByName(rest)


def margins(urls: DataFrame) -> DataFrame:
    """``id`` and ``margin``, the log-likelihood difference per character, of distinct ``urls`` (``id``, ``kind``, ``said``).

    The models learn from URLs of ``kind`` 0 (allowed) and 1 (blocked).
    """
    places = saved(urls.select("id", "kind", "said").mapInArrow(released(_grams), "id binary, kind int, gram string"), "url-places")
    counts = places.groupBy("gram").agg(
        F.count_if(F.col("kind") == 0).alias("a"), F.count_if(F.col("kind") == 1).alias("b"), F.count("*").alias("n")
    )
    counts = saved(counts, "url-counts")
    everywhere = counts.agg(F.sum("n")).first()[0] or 0
    ratios = log_ratios(counts).join(counts.select("gram", (F.col("n") * SHARE >= everywhere).alias("hot")), "gram")
    scored = _looked_up(places.select("id", "gram"), saved(ratios, "url-ratios"), "gram", "ratio")
    return scored.groupBy("id").agg((F.sum("ratio") / F.count("*") / UNIT).alias("margin"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = r"^(?s)(?:.*?)://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    known = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(known, pattern, 1), upper, lower), F.regexp_extract(known, pattern, 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name = verdict = None
    for kind, suffix, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        name = F.when(fits, suffix + prefix) if name is None else name.when(fits, suffix + prefix)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return name, verdict


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, calibration_share: int = 4) -> DataFrame:
    """Pages with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score``.

    ``score`` is the log-likelihood difference per character less the threshold, from
    0 on it allows. One in ``calibration_share`` rule-judged URLs, chosen by hash,
    sets the threshold, where both kinds are told apart best. Without allowed or
    blocked URLs the models say nothing and everything without a rule is allowed.

    The models count and score the whole url as it is, query and fragment too; a url of
    many rows counts once. A null url, or one without ``://``, has an empty host and
    path; null is scored as an empty string. The added columns replace extra ones of
    these names; repeated rows are judged alike; an empty table gives an empty result.
    """
    added = ("host", "path", "rule", "verdict", "score")
    host, path = host_and_path(F.col("url"))
    split = pages.drop(*added).select("*", host.alias("host"), path.alias("path"))
    name, kind = rule_of(F.col("host"), F.col("path"), rules)
    said = F.coalesce("url", F.lit(""))
    ruled = split.select("*", name.alias("rule"), kind.alias("_llm_kind"), F.unhex(F.md5(said)).alias("_llm_id"))

    distinct_urls = ruled.groupBy(F.col("_llm_id").alias("id")).agg(
        F.first(said).alias("said"), F.first(F.when(F.col("_llm_kind") == "block", 1).when(F.col("_llm_kind") == "allow", 0)).alias("kind"),
        F.count("*").alias("n"),
    )
    apart = F.pmod(F.xxhash64("said"), F.lit(calibration_share)) == 0
    urls = saved(distinct_urls.select("*", apart.alias("apart")), "urls")
    learned = urls.select("id", F.when(~F.col("apart"), F.col("kind")).alias("kind"), "said")
    rows = urls.agg(F.sum("n")).first()[0] or 0
    marked = urls.select("id", F.when(F.col("apart"), F.col("kind")).alias("kind"), (F.col("n") * SHARE >= rows).alias("hot"))
    known = saved(margins(learned).join(marked, "id"), "url-margins")

    bins = known.where("kind is not null").select("kind", F.floor(F.col("margin") * 100).alias("bin")).groupBy("bin").agg(
        F.count_if(F.col("kind") == 0).alias("allowed"), F.count_if(F.col("kind") == 1).alias("blocked")
    )  # a bin per hundredth between the least and the greatest log ratio of a character
    threshold = _threshold(sorted((r["bin"], r["allowed"], r["blocked"]) for r in bins.collect()))
    values = known.select(F.col("id").alias("_llm_id"), F.col("margin").alias("_llm_margin"), "hot")
    scored = _looked_up(ruled, values, "_llm_id", "_llm_margin").withColumn("score", F.col("_llm_margin") - threshold)
    own = F.when(F.col("score") >= 0, "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("_llm_kind", own)).select(*split.columns, "rule", "verdict", "score")


def _threshold(bins: list[tuple[int, int, int]]) -> float:
    """Bin edge with the best mean of both kinds' hit rates; among equals the one nearest 0."""
    allowed, blocked = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not allowed or not blocked:
        return 0.0
    best, below_allowed, below_blocked = [], 0, 0
    for edge, a, b in bins:
        best.append(((allowed - below_allowed) / allowed + below_blocked / blocked, -abs(edge), edge))
        below_allowed, below_blocked = below_allowed + a, below_blocked + b
    return max(best)[2] / 100
