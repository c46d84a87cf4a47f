"""DuckDB SQL for the queries whose whole result SQL can state."""

from __future__ import annotations

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
WHERE r <= 10
"""


# white space as the operators see it
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"

OP2 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(COALESCE(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS i FROM documents),
placed AS (  -- a blank line belongs to the line before it
  SELECT *, regexp_matches(line, '{_WORD}') AS has,
         SUM(CAST(regexp_matches(line, '{_WORD}') AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM lines),
gone AS (  -- every line that equals one before it, in order of doc_id and place, whatever stands around it
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS copy FROM placed WHERE has)
  WHERE copy > 1)
SELECT p.doc_id, CAST(SUM(CAST(p.has AS INTEGER)) AS BIGINT) AS n_lines,
       CAST(SUM(CASE WHEN p.has AND g.pos IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
       sha256(COALESCE(string_agg(p.line, chr(10) ORDER BY p.i) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos
GROUP BY p.doc_id
"""

OP8 = rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(COALESCE(text, ''), '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS h FROM starts),
firsts AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM firsts WHERE doc_id > first),
split AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
kept AS (
  SELECT s.doc_id, CAST(COUNT(g.k) AS BIGINT) AS n_removed, string_agg(s.word, ' ' ORDER BY s.k) FILTER (WHERE g.k IS NULL) AS text
  FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.k = g.k GROUP BY s.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, COALESCE(k.n_removed, 0) AS n_removed, sha256(COALESCE(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def _quality_sql(rounds: int = 12, trust: float = 20.0) -> str:
    """Figures, votes and the rounds of expectation-maximisation, each one a row of parameters."""
    from roadpulse.llm.quality import LEAST, RULES, START

    votes = []
    for i, (_, above, below, low, at_low, high, at_high) in enumerate(RULES):
        share = f"(CAST({above} AS DOUBLE) / greatest({below}, 1))"
        votes.append(f"CASE WHEN {share} <= {low} THEN {at_low} WHEN {share} >= {high} THEN {at_high} ELSE 0 END AS v{i}")
    names = [f"v{i}" for i in range(len(RULES))]
    odds = " + ".join(["ln(good / (1 - good))"] + [
        f"CASE v{i} WHEN 1 THEN ln(g{i} / (1 - b{i})) WHEN -1 THEN ln((1 - g{i}) / b{i}) ELSE 0 END" for i in range(len(RULES))])
    post = f"1 / (1 + exp(-({odds})))"
    clip = lambda hits, of, start: f"least({1 - LEAST}, greatest({LEAST}, (COALESCE({hits}, 0) + {trust * start}) / (COALESCE({of}, 0) + {trust})))"
    text = f"""
WITH t AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
d AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM t),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS h FROM starts),
twice AS (SELECT doc_id, i FROM (SELECT *, COUNT(*) OVER (PARTITION BY doc_id, h) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, CAST(SUM(least(8, COALESCE(follows - i, 8))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS follows FROM twice) GROUP BY doc_id),
figures AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, COALESCE(c.n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '^[\\p{{L}}\\p{{M}}''’-]+[.,;:!?]?$'))) AS n_prose,
         length(regexp_replace(text, '\\P{{Lu}}+', '', 'g')) AS n_capitals,
         length(text) - length(regexp_replace(text, '!{{2,}}', '', 'g')) AS n_shouts, len(lines) AS n_lines,
         len(list_distinct(w)) AS n_distinct, len(list_filter(range(2, len(w) + 1), lambda j: w[j] = w[j - 1])) AS n_echoes
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id),
voted AS (SELECT *, {', '.join(votes)} FROM figures),
patterns AS MATERIALIZED (SELECT {', '.join(names)}, COUNT(*) AS n FROM voted GROUP BY ALL),
m0 AS (SELECT {START['good']} AS good, {', '.join(f"{START['right_good']} AS g{i}, {START['right_bad']} AS b{i}" for i in range(len(RULES)))})"""
    for k in range(1, rounds + 1):
        parts = [f"{clip('SUM(n * p)', 'SUM(n)', START['good'])} AS good"]
        for i in range(len(RULES)):
            parts.append(clip(f"SUM(CASE WHEN v{i} = 1 THEN n * p END)", f"SUM(CASE WHEN v{i} <> 0 THEN n * p END)", START["right_good"]) + f" AS g{i}")
            parts.append(clip(f"SUM(CASE WHEN v{i} = -1 THEN n * (1 - p) END)", f"SUM(CASE WHEN v{i} <> 0 THEN n * (1 - p) END)", START["right_bad"]) + f" AS b{i}")
        text += f""",
m{k} AS MATERIALIZED (SELECT {', '.join(parts)} FROM (SELECT *, {post} AS p FROM patterns CROSS JOIN m{k - 1}))"""
    return text + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {post} >= 0.5 AS kept
FROM voted CROSS JOIN m{rounds}
"""


# crc32 over the bytes of each distinct run of words, by its table of 256 remainders
OP13 = r"""
WITH remainders AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
split AS (
  SELECT side, r, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM split),
own AS (SELECT side, r, f, COUNT(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT f, list_transform(range(0, len(hex(encode(f))) // 2), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)) AS b
  FROM (SELECT DISTINCT f FROM own)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM bytes CROSS JOIN remainders),
placed AS (SELECT side, r, n, bucket FROM own JOIN hashed USING (f)),
sums AS (
  SELECT bucket, SUM(CASE WHEN side = 'd' THEN n ELSE 0 END) AS s, SUM(CASE WHEN side = 't' THEN n ELSE 0 END) AS t FROM placed GROUP BY bucket),
alls AS (SELECT COALESCE(SUM(s), 0) AS s, COALESCE(SUM(t), 0) AS t FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln(CAST(sums.t + 1 AS DOUBLE) * CAST(alls.s + 10000 AS DOUBLE) / (CAST(sums.s + 1 AS DOUBLE) * CAST(alls.t + 10000 AS DOUBLE)))) AS g
  FROM sums CROSS JOIN alls),
weights AS (SELECT r, CAST(floor(SUM(n * g) / SUM(n)) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scores AS (
  SELECT d.r, d.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(weight, 0) AS weight,
         COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                       / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM split d LEFT JOIN weights USING (r) WHERE side = 'd'),
places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, COUNT(*) OVER () AS n FROM scores WHERE n_words >= 20)
SELECT doc_id, n_words + greatest(n_words - 1, 0) AS n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (r)
"""


def _codes_sql(parts: int = 4, rounds: int = 4, entries: int = 256) -> str:
    """Plain Lloyd rounds: every piece against every entry, each round three steps."""
    text = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT r, vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS q FROM kept CROSS JOIN range({parts}) AS t(p)),
b0 AS MATERIALIZED (
  SELECT p, e, q FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, q) - 1 AS e, q FROM pieces) WHERE e < {entries})"""
    for k in range(rounds + 1):
        text += f""",
a{k} AS MATERIALIZED (
  SELECT r, p, q, n.e AS e, n.d AS d
  FROM (SELECT x.r, x.p, any_value(x.q) AS q, min({{'d': CAST(list_dot_product(CAST(x.q AS DOUBLE[]), CAST(x.q AS DOUBLE[]))
          - 2 * list_dot_product(CAST(x.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) + list_dot_product(CAST(b.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT),
          'e': b.e}}) AS n
        FROM pieces x JOIN b{k} b USING (p) GROUP BY x.r, x.p))"""
        if k < rounds:
            text += f""",
s{k} AS (SELECT p, e, i, CAST(floor(CAST(SUM(c) AS DOUBLE) / COUNT(*)) AS BIGINT) AS c
         FROM (SELECT p, e, unnest(q) AS c, generate_subscripts(q, 1) AS i FROM a{k}) GROUP BY p, e, i),
b{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, COALESCE(m.q, b.q) AS q FROM b{k} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS q FROM s{k} GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""
    return text + f""",
book AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY p, e)) AS h FROM b{rounds}),
codes AS (SELECT r, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(SUM(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN codes USING (r) CROSS JOIN book
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2, "op4_quality": _quality_sql(), "op8_substring": OP8, "op9_topk_search": OP9, "op11_vector_codes": _codes_sql(), "op13_resample": OP13}
