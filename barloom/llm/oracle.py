"""DuckDB SQL for the queries that SQL can express.

The others rest on learned models, SimHash hashes, tokenizers or suffix automata; their tests
compare them with brute-force versions, exact round trips or held-out labels.
"""

from barloom.llm import decontaminate, secrets

ORACLE = {}

WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLE["op3_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
     b AS (SELECT item_id::VARCHAR AS item, {WORDS} AS w FROM benchmark),
     grams AS (
         SELECT DISTINCT item, least(10, len(w)) AS size, w[i:i + least(10, len(w)) - 1] AS gram
         FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(i) WHERE len(w) > 0),
     sizes AS (SELECT DISTINCT size FROM grams),
     spots AS (
         SELECT doc_id, size, i, w[i:i + size - 1] AS gram
         FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS r(i)),
     hit AS (SELECT doc_id, s.size, i, item FROM spots s JOIN grams g ON s.gram = g.gram),
     covered AS (
         SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + size)) AS r(p) GROUP BY doc_id),
     named AS (
         SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op4_cover_tree"] = """
WITH RECURSIVE v AS (
         SELECT vec_id, label, embedding::DOUBLE[] AS x,
                embedding IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
                AND len(list_filter(embedding, lambda e: e <> 0)) > 0 AND label IS NOT NULL AS fine
         FROM embeddings),
     near AS (
         SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
         ON a.label = b.label AND a.fine AND b.fine AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
     reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
     least_of AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
     counted AS (SELECT a AS vec_id, count(*) AS n_links FROM near GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least_of USING (vec_id) LEFT JOIN counted USING (vec_id)
"""


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    """Each rule over every text: where its matches stand between the pieces that they part."""
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = _quoted(rule.pattern)
        parts.append(f"""
         SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind,
                list_sum(list_transform(gaps[1:i], lambda x: len(x)))
                + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0) AS start, hits[i] AS hit
         FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS hits, regexp_extract_all(text, {pattern}, {rule.group}) AS own,
                      string_split_regex(text, {pattern}) AS gaps FROM d WHERE regexp_matches(text, {pattern})),
              unnest(range(1, len(hits) + 1)) AS r(i) WHERE len(own[i]) >= {rule.least}""")
    kinds = [r.kind for r in secrets.BASE_RULES]
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     spans AS ({' UNION ALL '.join(parts)}),
     put AS (SELECT *, concat_ws(':', kind, start::BIGINT, (start + len(hit))::BIGINT) AS span FROM spans),
     per_doc AS (
         SELECT doc_id, {counts},
                string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(kinds)}) AS base,
                string_agg(span, ',' ORDER BY start, rank) AS spans
         FROM put GROUP BY doc_id)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in kinds)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_doc USING (doc_id)
"""


ORACLE["op8_secrets"] = _secrets()

TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLE["op12_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {TERMS} AS w FROM documents),
     whole AS (SELECT count(*) FILTER (len(w) > 0) AS documents, sum(len(w))::BIGINT AS total FROM d),
     held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
     weighed AS (
         SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
         FROM held, whole GROUP BY term, documents),
     asked AS (
         SELECT DISTINCT item, item_id, term
         FROM (SELECT row_number() OVER () AS item, item_id, unnest({TERMS}) AS term FROM benchmark)),
     scored AS (
         SELECT item, item_id, row, doc_id,
                sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * documents) // total))))::BIGINT AS score
         FROM asked JOIN held USING (term) JOIN weighed USING (term) JOIN d USING (row), whole
         GROUP BY item, item_id, row, doc_id),
     ranked AS (
         SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 50
"""

ORACLE["op13_hard_negatives"] = """
WITH v AS (
         SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
         FROM embeddings
         WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
     scored AS (
         SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                list_inner_product(a.x, b.x)::BIGINT AS score
         FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
     positive AS (
         SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
         QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
     negative AS (
         SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS place
         FROM positive JOIN scored USING (anchor_id)
         WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negative WHERE place <= 10
"""
