"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, collocations, decontaminate, licenses, nearest, ngram_join, packing, prefix_trie, quality_rules, substring_dedup, token_files, toxicity, url_filter
from .common import new_path

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, d):
    kept = substring_dedup.substring_dedup(_table(spark, d, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_ngram_join(spark, d):
    docs = _table(spark, d, "documents")
    return ngram_join.ngram_components(docs, links=False).select("doc_id", "n_shingles", "component_id")


def op3_best_fit_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"))


def op4_url_filter(spark, d):
    return url_filter.judge_urls(_table(spark, d, "pages").select("page_id", "url")).drop("url")


def op5_license_scan(spark, d):
    return licenses.scan_licenses(_table(spark, d, "documents").select("doc_id", "text")).drop("text")


def op6_token_files(spark, d):
    path = new_path(spark, "tokens")
    token_files.write_tokens(_table(spark, d, "documents"), path)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_toxicity(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, _table(spark, d, "labels")).drop("text")


def op8_nearest(spark, d):
    vectors = _table(spark, d, "embeddings")
    return nearest.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op9_decontamination(spark, d):
    """A row per document and benchmark item in it."""
    docs = _table(spark, d, "documents").select("doc_id", "text")
    found = decontaminate.contaminations(docs, _table(spark, d, "benchmark"))
    return found.select("doc_id", F.explode("items").alias("item")).select("doc_id", "item.*")


def op10_chat_format(spark, d):
    turns = _table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    added = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    return chat_format.digests(chat_format.format_turns(turns.unionByName(spark.createDataFrame(added, turns.schema))))


def op11_collocations(spark, d):
    return collocations.collocations(_table(spark, d, "documents"))


def op12_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(_table(spark, d, "conversations")).drop("node")


def op13_quality_rules(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge_quality(docs).drop("text", "lang")


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_ngram_join,
        op3_best_fit_packing,
        op4_url_filter,
        op5_license_scan,
        op6_token_files,
        op7_toxicity,
        op8_nearest,
        op9_decontamination,
        op10_chat_format,
        op11_collocations,
        op12_prefix_trie,
        op13_quality_rules,
    )
}

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op1_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS said
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)
        ),
        repeats AS (
            SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, i) > 1
        ),
        gone AS (
            SELECT doc_id, list(DISTINCT p) AS places
            FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM repeats) GROUP BY doc_id
        ),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        covered AS (SELECT DISTINCT doc_id, unnest(places) AS p FROM gone),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS said, count(*) AS n
            FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(said, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op2_ngram_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
        places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s FROM places),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
            WHERE 100 * common >= 85 * (a.n + b.n - common)
        ),
        reach(x, y) AS (
            SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
        ),
        lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id
        FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.x = doc_id
    """,
    "op8_nearest": """
        WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        near AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM near QUALIFY rank <= 10
    """,
    "op10_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
                        + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars,
               CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
        FROM turns GROUP BY conv_id
    """,
    "op11_collocations": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ),
        p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
        runs AS (
            SELECT lang, m, w[i : i + m - 1] AS w
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p CROSS JOIN range(1, 5) AS s(m))
        ),
        every AS (
            SELECT lang, any_value(m) AS m, w, array_to_string(w, ' ') AS phrase, count(*) AS f FROM runs GROUP BY lang, w HAVING count(*) >= 30
        ),
        inner_runs AS (
            SELECT lang, w[i : i + k - 1] AS w, max(f) AS longer
            FROM (SELECT lang, w, f, k, unnest(range(1, m - k + 2)) AS i FROM every CROSS JOIN range(2, 4) AS s(k) WHERE k < m)
            GROUP BY ALL
        ),
        settled AS (
            SELECT e.* FROM every e LEFT JOIN inner_runs i ON i.lang = e.lang AND i.w = e.w
            WHERE e.m > 1 AND (longer IS NULL OR 100 * longer < 80 * e.f)
        ),
        cuts AS (
            SELECT s.lang, s.phrase, s.f AS a, k, x.f AS l, y.f AS r,
                   CAST((CAST(s.f AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score
            FROM settled s CROSS JOIN range(1, 4) AS c(k)
            JOIN every x ON x.lang = s.lang AND x.w = s.w[1 : k] JOIN every y ON y.lang = s.lang AND y.w = s.w[k + 1 :]
            WHERE k < s.m
        ),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
            FROM lowest
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
    """,
    "op12_prefix_trie": rf"""
        WITH told AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                                 ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        drawn AS (
            SELECT conv_id, t, conv_id - conv_id % 20 AS family,
                   xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                           lambda x: [CAST(ascii(x) AS BIGINT)] || list_transform(range(8), lambda i: CAST(-1 AS BIGINT))))),
                       lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 4 AS h
            FROM told
        ),
        rebuilt AS (
            SELECT a.conv_id, coalesce(b.t[1 : a.h], []) || a.t[a.h + 1 :] AS t
            FROM drawn a LEFT JOIN told b ON b.conv_id = a.family
        ),
        places AS (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt),
        nodes AS (
            SELECT t[1 : depth] AS p, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(t) = depth), '')) AS ends_sha256
            FROM places GROUP BY t[1 : depth]
        ),
        children AS (SELECT p[1 : depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        own AS (
            SELECT n.*, coalesce(c.n, 0) AS n_children,
                   CASE WHEN n.depth = 0 THEN 0
                        ELSE (n_convs - 1) * len({_WORDS.format("n.p[n.depth].text")}) END AS saved
            FROM nodes n LEFT JOIN children c ON c.p = n.p
        ),
        tops AS (SELECT p[1 : k] AS p, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM own)),
        below AS (SELECT p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM tops GROUP BY p)
        SELECT o.conv_id, o.depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, o.ends_sha256
        FROM own o JOIN below b ON b.p = o.p LEFT JOIN nodes u ON o.depth > 0 AND u.p = o.p[1 : o.depth - 1]
    """,
}
