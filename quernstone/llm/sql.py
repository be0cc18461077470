"""DuckDB SQL of the operators that have an SQL form."""

SUBSTRING = r"""WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM windows JOIN least USING (s) WHERE doc_id > first),
kept AS (SELECT w.doc_id, len(w.w) AS n_words, list_filter(w.w, lambda x, k: NOT list_contains(coalesce(g.ks, []), k)) AS left_, coalesce(len(g.ks), 0) AS n_removed FROM words w LEFT JOIN (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id) g USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(left_, ' ')) AS kept_sha256 FROM kept"""

SQL: dict[str, str] = {"op8_substring_dedup": SUBSTRING}
