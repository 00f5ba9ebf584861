"""Check SQL, for DuckDB, of the operators whose contract SQL can say in full."""

from __future__ import annotations

from tradeflow.llm.chat import BEGIN, CONTROL, END

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SUBSTRINGS = f"""
WITH texts AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(words[p:p + 19], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS p FROM texts)
), late AS (
  SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, p) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS k FROM late
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM texts
), cut AS (
  SELECT doc_id, count(g.k) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (g.k IS NULL) AS kept
  FROM words LEFT JOIN gone g USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION = f"""
WITH texts AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
items AS (SELECT item_id, {_TERMS} AS terms FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(10, len(terms)) AS n, array_to_string(terms[p:p + least(10, len(terms)) - 1], ' ') AS gram
  FROM (SELECT item_id, terms, unnest(range(1, len(terms) - least(10, len(terms)) + 2)) AS p FROM items WHERE len(terms) > 0)
), grams AS (
  SELECT doc_id, n, p, array_to_string(terms[p:p + n - 1], ' ') AS gram
  FROM (SELECT doc_id, terms, n, unnest(range(1, len(terms) - n + 2)) AS p FROM texts, (SELECT DISTINCT n FROM phrases))
), found AS (SELECT doc_id, item_id, n, p FROM grams JOIN phrases USING (n, gram)),
hits AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS k FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(terms) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _escaped(text: str) -> str:
    return rf"regexp_replace({text}, '([<\[])(\\*){CONTROL}', '\1\\\2\3', 'g')"


_ROLE = _escaped(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(BEGIN) + 1 + len(END)} + length({_ROLE}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
digests AS (
  SELECT page_id, strlen(html) AS bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS digest
  FROM payloads
)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM digests WINDOW same AS (PARTITION BY digest)
"""

EXACT_COPIES = f"""
WITH normal AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY text)
"""


def _vector_codes(rounds: int = 2) -> str:
    """Assign and move, written out once per round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""far{k} AS (
  SELECT p.row, p.part, b.entry, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS far
  FROM parts p JOIN book{k} b USING (part)
), near{k} AS (
  SELECT row, part, arg_min(entry, far * 64 + entry) AS entry, min(far) AS far FROM far{k} GROUP BY ALL
)""")
        if k < rounds:
            steps.append(f"""mean{k} AS (
  SELECT part, entry, list(m ORDER BY i) AS c FROM (
    SELECT part, entry, i, CAST(floor(sum(x[i]) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS m
    FROM near{k} JOIN parts USING (row, part), (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY ALL
  ) GROUP BY ALL
), book{k + 1} AS (
  SELECT part, entry, coalesce(n.c, o.c) AS c FROM book{k} o LEFT JOIN mean{k} n USING (part, entry)
)""")
    return f"""
WITH whole AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT row, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x FROM whole, (SELECT unnest(range(16)) AS part)
), book0 AS (SELECT part, row - 1 AS entry, x AS c FROM parts WHERE row <= 64),
{", ".join(steps)},
codes AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM near{rounds} GROUP BY row
), book AS (
  SELECT sha256(string_agg(m, ',' ORDER BY part, entry)) AS digest
  FROM (SELECT part, entry, array_to_string(c, ',') AS m FROM book{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM whole JOIN codes USING (row), book
"""


ORACLES = {
    "op12_vector_code_compression": _vector_codes(),
    "op13_exact_dedup": EXACT_COPIES,
    "op3_substring_dedup": SUBSTRINGS,
    "op5_benchmark_decontamination": DECONTAMINATION,
    "op6_chat_formatting": CHAT,
    "op10_warc": WARC,
}
