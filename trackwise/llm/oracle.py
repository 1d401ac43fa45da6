"""DuckDB SQL of the corpus queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _shingles(name: str, table: str, key: str) -> str:
    """Relation of distinct (key, g): five-word shingles, or all words of a shorter text."""
    return f"""
{name}_w AS (SELECT {key}, {_WORDS.format(text=_LOWER)} AS w FROM {table}),
{name} AS (
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM {name}_w WHERE {key} IS NOT NULL)"""


_REACH = """
reach AS (
  SELECT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"""

NGRAM_JACCARD = f"""
WITH RECURSIVE {_shingles("s", "documents", "doc_id")},
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
{_REACH}
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(coalesce(component, d.doc_id) AS BIGINT) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.id = d.doc_id"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
          WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
{_REACH},
k AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, CAST(coalesce(component, vec_id) AS BIGINT) AS component_id,
       coalesce(vec_id = coalesce(component, vec_id), false) AS kept
FROM embeddings LEFT JOIN k ON k.a = vec_id LEFT JOIN comp ON comp.id = vec_id"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
first AS (SELECT h, min(doc_id) AS origin FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first USING (h) WHERE origin < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

DECONTAMINATION = f"""
WITH {_shingles("s", "documents", "doc_id")}, {_shingles("t", "benchmark", "item_id")},
q AS (SELECT item_id, count(*) AS n FROM t GROUP BY item_id),
common AS (SELECT doc_id, item_id, count(*) AS c FROM s JOIN t USING (g) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_item, CAST(c AS BIGINT) AS n_shared, round(CAST(c AS DOUBLE) / n, 4) AS containment
FROM common JOIN q USING (item_id) WHERE 100 * c >= 75 * n"""

ORACLE = {
    "op2_ngram_jaccard": NGRAM_JACCARD,
    "op4_embedding_dedup": EMBEDDING_DEDUP,
    "op8_substring_dedup": SUBSTRING_DEDUP,
    "op9_decontamination": DECONTAMINATION,
}
