"""The queries of this subpackage by name, and DuckDB SQL for those that SQL expresses on whole tables.

Beside the query of each operator there are some of the columns that fixed rules give, without what the operator's model
adds, so that SQL can check them.
"""

from __future__ import annotations

from moorage.llm.embedding_dedup import op5_embedding_dedup
from moorage.llm.language_id import op4_language_id
from moorage.llm.lm_scoring import op10_lm_scoring
from moorage.llm.mixing import op8_mix_sources
from moorage.llm.ngram_jaccard import op9_ngram_jaccard
from moorage.llm.pii import op6_pii
from moorage.llm.quality_classifier import op2_quality_classifier
from moorage.llm.quality_rules import op7_quality_rules
from moorage.llm.sentencepiece import op3_sentencepiece
from moorage.llm.url_filter import LOWER, PRODUCTION_RULES, UPPER, op1_url_filter

WORD = r"[^\x20\x09-\x0D]+"


def url_rules(spark, sf_dir):
    return op1_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule")


def pii_base(spark, sf_dir):
    return op6_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def quality_base(spark, sf_dir):
    return op7_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def mix_targets(spark, sf_dir):
    return op8_mix_sources(spark, sf_dir).selectExpr("doc_id", "size", "source_size", "round(target, 3) AS target")


def queries() -> dict:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_language_id": op4_language_id,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op6_pii": op6_pii,
        "op7_quality_rules": op7_quality_rules,
        "op8_mix_sources": op8_mix_sources,
        "op9_ngram_jaccard": op9_ngram_jaccard,
        "op10_lm_scoring": op10_lm_scoring,
        "url_rules": url_rules,
        "pii_base": pii_base,
        "quality_base": quality_base,
        "mix_targets": mix_targets,
    }


#: (a, b) of ``link``, both ways round, to (a, smallest node reachable).
REACH = """reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
    least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""


def oracle_sql() -> dict[str, str]:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    by_length = sorted(PRODUCTION_RULES, key=lambda r: (-len(r.text), r.text))
    base = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(v, '.'), lambda x: len(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0"),
        "card": (r"[0-9]([\x20-]?[0-9])+", "len(d) BETWEEN 16 AND 19 AND list_sum(list_transform(range(len(d)), lambda i: CASE WHEN i % 2 = 0 THEN d[len(d) - i]::INT WHEN d[len(d) - i]::INT > 4 THEN 2 * d[len(d) - i]::INT - 9 ELSE 2 * d[len(d) - i]::INT END)) % 10 = 0"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(d) BETWEEN 8 AND 15"),
    }
    # values and the gaps before them alternate, so a value starts after as much text as both have before it
    found = lambda k, i: f"""
    m{k} AS (SELECT doc_id, regexp_extract_all(text, '{base[k][0]}') AS vs, string_split_regex(text, '{base[k][0]}') AS gs FROM docs),
    s{k} AS (SELECT doc_id, {i} AS o, '{k}' AS kind, vs[j] AS v, regexp_replace(vs[j], '[^0-9]', '', 'g') AS d,
        coalesce(list_sum(list_transform(gs[1:j], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(vs[1:j - 1], lambda x: len(x))), 0) AS begin_
        FROM (SELECT doc_id, vs, gs, unnest(range(1, len(vs) + 1)) AS j FROM m{k})),
    f{k} AS (SELECT doc_id, o, kind, begin_, begin_ + len(v) AS fin FROM s{k} WHERE {base[k][1]})"""  # noqa: E731
    kinds = list(base)
    return {
        "op5_embedding_dedup": f"""WITH RECURSIVE
    v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    sound AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    link AS (SELECT p.vec_id AS a, q.vec_id AS b FROM sound p JOIN sound q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e) WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
    {REACH},
    n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(l.b, vec_id)) AS kept
    FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN least_ l ON l.a = vec_id""",
        "op9_ngram_jaccard": f"""WITH RECURSIVE
    w AS (SELECT doc_id, regexp_extract_all({lower}, '{WORD}') AS ws FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: hash(array_to_string(ws[i:i + 3], ' ')))) WHEN len(ws) > 0 THEN [hash(array_to_string(ws, ' '))] ELSE [] END AS sh FROM w),
    x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
    shared AS (SELECT p.doc_id AS a, q.doc_id AS b, p.n AS m, q.n AS n, count(*) AS c FROM x p JOIN x q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (m + n - c)),
    {REACH}
    SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(doc_id, coalesce(l.b, doc_id)) AS component_id FROM s LEFT JOIN least_ l ON l.a = doc_id""",
        "url_rules": f"""WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
    SELECT page_id, host, path, CASE {" ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in by_length)} END AS rule FROM p""",
        "pii_base": f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), {",".join(found(k, i) for i, k in enumerate(kinds))},
    a AS ({" UNION ALL ".join(f"SELECT * FROM f{k}" for k in kinds)}),
    g AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)}, string_agg(kind || ':' || begin_ || ':' || fin, ',' ORDER BY o, begin_) AS spans FROM a GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)}, sha256(coalesce(spans, '')) AS base_sha256 FROM docs LEFT JOIN g USING (doc_id)""",
        "quality_base": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
    five AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM d WHERE len(ws) >= 5),
    seen AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM five),
    repeats AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM seen WHERE times > 1) GROUP BY doc_id),
    lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
    c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0) AS BIGINT) AS word_chars,
        CAST(len(text) - len(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
        FROM d JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id))
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c""",
        "mix_targets": f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
    t AS (SELECT source, sum(size) AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
    w AS (SELECT *, CASE i % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight FROM t),
    -- with the k sources that fill up first at twice their size, the others have this level for each unit of weight
    r AS (SELECT 2 * total / weight AS full_at, total, weight FROM w),
    k AS (SELECT full_at, row_number() OVER (ORDER BY full_at, total, weight) AS pos, coalesce(sum(2 * total) OVER before, 0) AS used, (SELECT sum(weight) FROM r) - coalesce(sum(weight) OVER before, 0) AS open_ FROM r
        WINDOW before AS (ORDER BY full_at, total, weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    v AS (SELECT full_at, pos, (1.5::DOUBLE * (SELECT sum(size) FROM d) - used) / open_ AS level FROM k),
    lvl AS (SELECT arg_min(level, pos) FILTER (level <= full_at) AS l FROM v)
    SELECT doc_id, size, CAST(total AS BIGINT) AS source_size, round(least(2.0 * total, coalesce(l, 'infinity'::DOUBLE) * weight), 3) AS target FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source, lvl""",
    }
