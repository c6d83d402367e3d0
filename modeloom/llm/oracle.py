"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
WORDS = r"'[^\x20\x09-\x0D]+'"

# From links l(a, b): r(id, root), every node with the nodes of smaller id that reach it.
REACHED = """e AS (
    SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
    SELECT id, id AS root FROM nodes
    UNION
    SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b
)"""

EXACT_DEDUP = f"""
WITH d AS (
    SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents
), g AS (
    SELECT *, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size
    FROM d WINDOW w AS (PARTITION BY text_sha256)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, {WORDS}) AS w FROM documents
), s AS (
    SELECT doc_id, unnest(list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    END)) AS g FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)
), nodes AS (SELECT doc_id AS id FROM documents), {REACHED}
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.id = d.doc_id GROUP BY d.doc_id
"""

LATTICE_DEDUP = f"""
WITH RECURSIVE v AS (
    SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
    SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.label = y.label AND x.id < y.id
        AND len(x.e) = len(y.e)
    WHERE list_cosine_similarity(x.e, y.e) >= 0.93
), nodes AS (SELECT vec_id AS id FROM embeddings), {REACHED}, n AS (
    SELECT a AS id, count(*) AS n FROM e GROUP BY 1
)
SELECT r.id AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(root) AS component_id,
    r.id = min(root) AS kept
FROM r LEFT JOIN n USING (id) GROUP BY r.id
"""

PHRASE_DEDUP = f"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents
), t AS (
    SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM w
), g AS (
    SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w WHERE len(w) >= 13
), k AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM g
), f AS (
    SELECT g, min(doc_id) AS first FROM k GROUP BY 1
), gone AS (
    SELECT DISTINCT doc_id, i + j AS i
    FROM k JOIN f USING (g), (SELECT unnest(range(13)) AS j) WHERE first < doc_id
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY 1
)
SELECT w.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


# CRC-32 of a text of digits, from its definition: one table entry per byte value.
CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(
    range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))"""
CRC = """xor(4294967295, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"""

PREFIX_TRIE = f"""
WITH s AS (
    SELECT conv_id, turn, length(coalesce(text, '')) AS n,
        md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS x
    FROM conversations WHERE conv_id IS NOT NULL
), t AS (
    SELECT conv_id, n, x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS pos
    FROM s
), k AS (
    SELECT {CRC_TABLE} AS crc_of
), c AS (
    SELECT conv_id, conv_id - conv_id % 100 AS first, {CRC} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM t), k
), u AS (
    SELECT c.conv_id, 0 AS part, t.pos, t.x, t.n
    FROM c JOIN t ON t.conv_id = c.first AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.x, t.n FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), o AS (
    SELECT *, row_number() OVER w AS d, string_agg(x, '') OVER w AS key
    FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
), p AS (
    SELECT conv_id, d, key, left(key, length(key) - 32) AS above, n FROM o
    UNION ALL
    SELECT conv_id, 0, '', NULL, 0 FROM c
), m AS (
    SELECT conv_id, max(d) AS last FROM p GROUP BY 1
), g AS (
    SELECT p.d, p.key, any_value(p.above) AS above, any_value(p.n) AS n, count(*) AS n_convs,
        min(conv_id) AS owner,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
            FILTER (WHERE p.d = m.last), '')) AS ends_sha256
    FROM p JOIN m USING (conv_id) GROUP BY 1, 2
), h AS (
    SELECT above AS key, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1
), e AS (
    SELECT g.*, coalesce(h.n_children, 0) AS n_children, up.owner AS parent
    FROM g LEFT JOIN h USING (key) LEFT JOIN g up ON up.key = g.above
), z AS (
    SELECT p.key, sum((e.n_children = 0)::INT) AS n_leaves, sum((e.n_convs - 1) * e.n) AS saved
    FROM e JOIN p ON p.conv_id = e.owner AND p.d <= e.d GROUP BY 1
)
SELECT e.owner AS conv_id, e.d::BIGINT AS depth, e.parent AS parent_conv_id, e.n_convs,
    e.n_children, z.n_leaves::BIGINT AS n_leaves, z.saved::BIGINT AS saved_tokens, e.ends_sha256
FROM e JOIN z USING (key)
"""

TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

RANKED_SEARCH = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, {TERMS}) AS w
    FROM documents
), n AS (
    SELECT r, doc_id, len(w)::BIGINT AS n, w FROM d WHERE len(w) > 0
), s AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n
), q AS (
    SELECT item_id, term, count(*) AS c
    FROM (SELECT item_id, unnest(regexp_extract_all({LOWERED}, {TERMS})) AS term FROM benchmark)
    GROUP BY 1, 2
), t AS (
    SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM n)
    WHERE term IN (SELECT term FROM q) GROUP BY ALL
), f AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM t, s GROUP BY 1
), x AS (
    SELECT q.item_id, t.r, t.doc_id, sum(q.c * f.w
        * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM q JOIN f USING (term) JOIN t USING (term), s GROUP BY 1, 2, 3
), y AS (
    SELECT *, row_number() OVER (
        PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM x WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 10
"""

TOPK_SEARCH = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)::BIGINT) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), p AS (
    SELECT a.r AS q, a.vec_id AS query_id, b.vec_id, coalesce(list_sum(list_transform(
        list_zip(a.w, b.w, true), lambda x: x[1] * x[2])), 0)::BIGINT AS score
    FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 20 = 0
), y AS (
    SELECT *, row_number() OVER (
        PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM y WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_join": NGRAM_JOIN,
        "op3_exact_dedup": EXACT_DEDUP,
        "op6_lattice_dedup": LATTICE_DEDUP,
        "op9_phrase_dedup": PHRASE_DEDUP,
        "op11_prefix_trie": PREFIX_TRIE,
        "op12_ranked_search": RANKED_SEARCH,
        "op13_topk_search": TOPK_SEARCH,
    }
