"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from sparkmart.llm.chat import INSTRUCT
from sparkmart.llm.quality import RULES, STOP_WORDS


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_escape(column: str) -> str:
    column = f"replace({column}, '\\', '\\\\')"
    for c in INSTRUCT.controls:
        column = f"replace({column}, {_text(c)}, {_text(c[0] + chr(92) + c[1:])})"
    return column


def chat() -> str:
    known = " ".join(f"WHEN role = {_text(r)} THEN {len(m.open) + len(m.close)}" for r, m in INSTRUCT.turns.items())
    other = len(INSTRUCT.other.open) + len(INSTRUCT.role_end) + len(INSTRUCT.other.close)
    moves = ", ".join(_text(f"{a}>{r}") for (a, r) in INSTRUCT.moves)
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), m AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 'start')
            || '>' || role IN ({moves}) AS fits,
    length({_sql_escape("text")}) + CASE {known} ELSE {other} + length({_sql_escape("role")}) END AS chars
  FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, bool_and(fits) AS valid
FROM m GROUP BY conv_id"""


def quality() -> str:
    stop = ", ".join(_text(w) for w in STOP_WORDS)
    tests = []
    for r in RULES:
        if r.low is not None:
            tests.append(f"{r.whole} * 100 >= {r.part} * {r.low}")
        if r.high is not None:
            tests.append(f"{r.whole} * 100 <= {r.part} * {r.high}")
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), w AS (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS i FROM d),
g AS (
  SELECT k, i, word, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY k ORDER BY i)
), r AS (
  SELECT k, i, c IS NOT NULL AND count(*) OVER (PARTITION BY k, word, b, c) > 1 AS twice FROM g
), n AS (
  SELECT k, count(*) FILTER (hit)::BIGINT AS n_repeat_words
  FROM (SELECT k, bool_or(twice) OVER (PARTITION BY k ORDER BY i ROWS 2 PRECEDING) AS hit FROM r) GROUP BY k
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(list_aggregate(words, 'string_agg', ''))::BIGINT AS wc,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(list_filter(words, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN n USING (k)
), f AS (
  SELECT doc_id, n_words, coalesce(wc, 0) AS word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND {" AND ".join(tests)} AS kept FROM f"""


def ngrams(n: int = 4, percent: int = 85) -> str:
    later = ", ".join(f"lead(word, {k}) OVER o AS w{k}" for k in range(1, n))
    joined = " || ' ' || ".join(["word"] + [f"w{k}" for k in range(1, n)])
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM d WHERE len(words) >= {n}),
g AS (SELECT doc_id, word, {later} FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (
  SELECT DISTINCT doc_id, {joined} AS gram FROM g WHERE w{n - 1} IS NOT NULL
  UNION ALL SELECT doc_id, list_aggregate(words, 'string_agg', ' ') FROM d WHERE len(words) BETWEEN 1 AND {n - 1}
), c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, min(r.b)::BIGINT AS component_id
FROM d LEFT JOIN c USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id, c.n"""


def topk(k: int = 20, every: int = 20, scale: int = 64) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}"""
