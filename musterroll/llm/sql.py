"""The queries' SQL over the given tables, where SQL can express them."""

from __future__ import annotations

from musterroll.llm.quality_rules import RULES, HostRules
from musterroll.llm.warc import ENTITY, NAMES, REPLACEMENT, STEPS

CRLF = "chr(13) || chr(10)"


def _urn(text: str) -> str:
    h = f"sha256({text})"
    return (
        f"'urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-8' || {h}[13:15] || '-a'"
        f" || {h}[16:18] || '-' || {h}[19:30]"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain_text(column: str) -> str:
    for pattern, into in STEPS:
        into = "chr(10)" if into == "\n" else _quoted(into)
        column = f"regexp_replace({column}, {_quoted(pattern)}, {into}, 'g')"
    names, characters = (", ".join(map(_quoted, x)) for x in zip(*NAMES.items()))
    number = """(CASE WHEN lower(e[:2]) = '#x' THEN try_cast('0x' || e[3:] AS BIGINT)
      ELSE try_cast(e[2:] AS BIGINT) END)"""
    character = f"""CASE WHEN e[1] <> '#' THEN MAP([{names}], [{characters}])[e]
      WHEN {number} = 160 THEN ' '
      WHEN {number} BETWEEN 1 AND 1114111 AND {number} NOT BETWEEN 55296 AND 57343
      THEN chr({number}::INT) ELSE {_quoted(REPLACEMENT)} END"""
    piece = f"""list_transform(string_split({column}, '&')[2:], lambda p:
      list_transform([regexp_extract(p, {_quoted(ENTITY)}, 1)], lambda e:
        CASE WHEN e = '' THEN '&' || p
        ELSE coalesce({character} || p[length(e) + 2:], '&' || p) END)[1])"""
    return f"string_split({column}, '&')[1] || array_to_string({piece}, '')"


WARC = f"""
WITH response AS (
  SELECT {_urn("'response ' || coalesce(page_id::varchar, '') || ' ' || coalesce(url, '')")} AS id,
    coalesce(url, '') AS uri, coalesce(html, '') AS body,
    'HTTP/1.1 200 OK' AS status,
    'Content-Type: text/html; charset=utf-8' AS field1,
    'Content-Length: ' || strlen(coalesce(html, '')) AS field2
  FROM pages
), made AS (
  SELECT 'metadata' AS warc_type, {_urn("'metadata ' || id")} AS record_id, id AS refers_to, uri,
    'application/warc-fields' AS content_type,
    'http-status: ' || status || {CRLF} || 'http-header: ' || field1 || {CRLF} || 'http-header: '
      || field2 || {CRLF} || 'source-block-digest: sha256:'
      || sha256(status || {CRLF} || field1 || {CRLF} || field2 || {CRLF} || {CRLF} || body)
      || {CRLF} || 'source-payload-digest: sha256:' || sha256(body) || {CRLF}
      || 'conversion: <' || {_urn("'conversion ' || id")} || '>' || {CRLF} AS block,
    body
  FROM response
  UNION ALL
  SELECT 'conversion', {_urn("'conversion ' || id")}, id, uri, 'text/plain; charset=utf-8',
    {_plain_text("body")}, body
  FROM response
)
SELECT warc_type, record_id, refers_to, uri AS target_uri, '2024-01-01T00:00:00Z' AS date,
  content_type, strlen(block)::bigint AS content_length,
  'sha256:' || sha256(block) AS block_digest, 'sha256:' || sha256(body) AS payload_digest, block
FROM made
"""

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SUBSTRINGS = f"""
WITH doc AS (SELECT doc_id, {WORDS} AS words FROM documents),
word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM doc
), wdw AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM doc)
), least_doc AS (SELECT k, min(doc_id) AS first_id FROM wdw GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i
  FROM wdw JOIN least_doc USING (k) WHERE first_id < doc_id
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(g.i) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL), '') AS left_over
  FROM word w LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0)::bigint AS n_words, coalesce(n_removed, 0)::bigint AS n_removed,
  sha256(coalesce(left_over, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


def _host_rules(rules: HostRules) -> str:
    counts = ", ".join(f"sum({r}::int) AS {r}" for r in RULES)
    means = ", ".join(f"sum({r}) / sum(n) AS mean_{r}" for r in RULES)
    spread = ", ".join(
        f"sum(n * power({r} / n - mean_{r}, 2)) / sum(n) AS var_{r}" for r in RULES
    )
    rates = ", ".join(
        f"""({r} + mean_{r} * s_{r}) / (n + s_{r})""" for r in RULES
    )
    strengths = ", ".join(
        f"""CASE WHEN var_{r} > 0 THEN least(greatest(mean_{r} * (1 - mean_{r}) / var_{r} - 1,
              {rules.least_strength}), {rules.most_strength}) ELSE {rules.most_strength} END AS s_{r}"""
        for r in RULES
    )
    return f"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, {WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), gram AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM doc)
), again AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM gram
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again WHERE times > 1) GROUP BY doc_id
), measured AS (
  SELECT doc_id, host, len(words)::bigint AS n_words,
    length(array_to_string(words, ''))::bigint AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols,
    len(lines)::bigint AS n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
    coalesce(n, 0)::bigint AS n_repeat_words
  FROM doc LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 AS failed_length, 100 * n_repeat_words > 20 * n_words AS failed_repeats,
    100 * n_symbols > {rules.symbols_per_100_words} * n_words AS failed_symbols,
    100 * n_dup_lines > {rules.dup_lines_percent} * n_lines AS failed_lines
  FROM measured
), host AS (SELECT host, count(*) AS n, {counts} FROM judged GROUP BY host),
mean AS (SELECT {means} FROM host),
spread AS (SELECT {spread} FROM host, mean),
strength AS (SELECT *, {strengths} FROM mean, spread),
bad AS (
  SELECT host FROM host, strength WHERE greatest({rates}) > {rules.host_rate}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed_length OR failed_repeats AS base_failed,
  NOT (failed_length OR failed_repeats OR failed_symbols OR failed_lines
    OR host IN (SELECT host FROM bad)) AS kept,
  host IN (SELECT host FROM bad) AS host_failed, failed_symbols, failed_lines
FROM judged
"""


SPELLING = r"""
WITH letters AS (
  SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM letters
), run AS MATERIALIZED (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS owned, run, count(*) AS n
  FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents
  )
  WHERE length(run) >= 7
  GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(strlen(owned)),
      lambda i: ('0x' || hex(encode(owned))[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM run, crc
), word AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (
    SELECT n, CASE WHEN h % 31 = 0
      THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word
    FROM hashed
  )
  WHERE length(word) >= 7
  GROUP BY word HAVING sum(n) >= 2
), variant AS MATERIALIZED (
  SELECT word, n, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n FROM variant a JOIN variant b USING (i, rest)
  WHERE a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM variant a JOIN word b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM variant a JOIN word b ON a.rest = b.word
), ranked AS (
  SELECT word, count(*) AS n_near,
    list(near ORDER BY n DESC, near)[1] AS best, max(n) AS best_n
  FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN best_n >= 10 * n THEN best END AS form,
    CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM word LEFT JOIN ranked USING (word)
), way AS (
  WITH RECURSIVE step AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL
    SELECT step.word, step.next, formed.form FROM step JOIN formed ON formed.word = step.next
  )
  SELECT word, root FROM step WHERE next IS NULL
)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM formed JOIN way USING (word)
"""


def _vector_codes(rounds: int) -> str:
    """Codebooks as a table (p, e, entry), one assignment and one update a round."""
    nearest = """
), near{k} AS MATERIALIZED (
  SELECT p, part, n, e, d
  FROM (
    SELECT p, part, n, e, d, row_number() OVER (PARTITION BY p, part ORDER BY d, e) AS place
    FROM (
      SELECT p, part, n, e, list_sum(list_transform(list_zip(part, entry),
        lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
      FROM distinct_part JOIN book{k} USING (p)
    )
  )
  WHERE place = 1"""
    moved = """
), total{k} AS (
  SELECT p, e, i, sum(part[i] * n)::HUGEINT AS total, sum(n)::HUGEINT AS n
  FROM near{j}, (SELECT unnest(range(1, w + 1)) AS i FROM width)
  GROUP BY p, e, i
), book{k} AS MATERIALIZED (
  SELECT p, e, coalesce(moved, entry) AS entry
  FROM book{j} LEFT JOIN (
    SELECT p, e, list(((total - (total % n + n) % n) // n)::BIGINT ORDER BY i) AS moved
    FROM total{k} GROUP BY p, e
  ) USING (p, e)"""
    steps = "".join(
        nearest.format(k=k) + moved.format(j=k, k=k + 1) for k in range(rounds)
    ) + nearest.format(k=rounds)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, label,
    list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), width AS (
  SELECT max(len(ints)) // 8 AS w FROM kept
), part AS MATERIALIZED (
  SELECT id, p, ints[p * w + 1:(p + 1) * w] AS part
  FROM kept, width, (SELECT unnest(range(8)) AS p)
), distinct_part AS MATERIALIZED (
  SELECT p, part, count(*) AS n FROM part GROUP BY p, part
), seed AS (
  SELECT id, row_number() OVER (ORDER BY vec_id NULLS LAST, ints) - 1 AS e FROM kept
), book0 AS MATERIALIZED (
  SELECT p, e, part AS entry FROM part JOIN seed USING (id) WHERE e < 16{steps}
), coded AS (
  SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM part JOIN near{rounds} USING (p, part) GROUP BY id
), digest AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(entry) AS x, generate_subscripts(entry, 1) AS i FROM book{rounds})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  codebooks_sha256
FROM kept JOIN coded USING (id), digest
"""


ORACLE_SQL: dict[str, str] = {
    "op1_warc_derivatives": WARC,
    "op3_substring_dedup": SUBSTRINGS,
    "op5_host_rules": _host_rules(HostRules()),
    "op12_vector_codes": _vector_codes(6),
    "op13_spelling": SPELLING,
}
