"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

import re

from marquee.llm import chat, fill_middle, line_chunks, mixing, multi_index, urls

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_ALPHABET}', 1 + ((CAST('0x' || substr(h, {5 * (i // 4) + 1}, 5) AS BIGINT) >> {15 - 5 * (i % 4)}) & 31), 1)"
    for i in range(32)
)

WARC = f"""WITH p AS (SELECT page_id, sha1(encode(coalesce(html, ''))) AS h, octet_length(encode(coalesce(html, ''))) AS n
    FROM pages), f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM p JOIN f USING (h)"""

_SITES = " ".join(
    f"WHEN (host = '{s.host}' OR ends_with(host, '.{s.host}')) AND starts_with(path, '{s.path}') THEN '{{{s.verdict}}}{s.name}'"
    for s in sorted(urls.SITES, key=lambda s: -len(s.name))
)
_RULES = ", ".join(
    "('{}', '{}', '{}')".format(p, urls.compiled(p.removeprefix("@@")), "allow" if p.startswith("@@") else "block")
    for p in urls.PATTERNS
)

URLS = f"""WITH parts AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
site AS (SELECT *, CASE {_SITES} END AS hit FROM parts),
rules(pattern, expression, verdict) AS (VALUES {_RULES}),
fits AS (SELECT page_id, min((verdict, pattern)) AS m FROM parts JOIN rules ON regexp_matches(
    translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), expression) GROUP BY page_id)
SELECT page_id, host, path, regexp_extract(hit, '\\}}(.*)', 1) AS rule, m[2] AS pattern,
    coalesce(regexp_extract(hit, '\\{{(.*)\\}}', 1), m[1], 'allow') AS verdict FROM site LEFT JOIN fits USING (page_id)"""

_SHARE = f"CASE (source_no - 1) % {len(mixing.CYCLE)} " + " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.CYCLE)) + " END"

MIXING = f"""WITH bad AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 0),
sized AS (SELECT d.doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CASE WHEN b.doc_id IS NULL THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS quality
    FROM documents d LEFT JOIN bad b ON b.doc_id = d.doc_id),
drawn AS (SELECT *, -ln((CAST('0x' || substr(md5('{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1,
    {mixing.DIGITS}) AS BIGINT)::DOUBLE + 1.0) / {2.0 ** (4 * mixing.DIGITS) + 1.0!r}::DOUBLE) / quality AS draw FROM sized),
totals AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_no
    FROM sized GROUP BY source),
shares AS (SELECT *, {_SHARE} AS share, {mixing.MOST_EPOCHS} * source_size AS most FROM totals),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER w, 0))::DOUBLE
    / (sum(share) OVER () - coalesce(sum(share) OVER w, 0))::DOUBLE AS level FROM shares
    WINDOW w AS (ORDER BY most::DOUBLE / share, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, most::DOUBLE <= level * share AS is_full,
    min_by(level, (most::DOUBLE / share, source_no)) FILTER (most::DOUBLE > level * share) OVER () AS water FROM levels),
targets AS (SELECT source, source_size, CASE WHEN is_full THEN most::DOUBLE ELSE water * share END AS target FROM filled),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN least({mixing.MOST_EPOCHS}, floor(target / source_size))::BIGINT ELSE 0 END AS epochs
    FROM targets),
placed AS (SELECT d.*, w.source_size, w.target, w.epochs, coalesce(sum(size) OVER (PARTITION BY d.source
    ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before
    FROM drawn d JOIN whole w ON d.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, source, size, source_size, target, epochs, size * (epochs + CASE WHEN epochs < {mixing.MOST_EPOCHS} AND size > 0
    AND before + size / 2.0::DOUBLE <= target - (epochs * source_size)::DOUBLE THEN 1 ELSE 0 END) AS taken FROM placed"""

_P, _M = line_chunks.STEP, line_chunks.MODULUS

LINE_CHUNKS = f"""WITH split AS (SELECT doc_id, md5(text) AS td, string_split(text, chr(10)) AS lines FROM documents
    WHERE text IS NOT NULL),
facts AS (SELECT *, list_transform(lines, lambda x: CAST('0x' || substr(md5(x), 1, 8) AS BIGINT) % {_M}) AS h,
    list_transform(lines, lambda x: len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))) AS words FROM split),
cut AS (SELECT *, list_filter(range(0, len(lines)), lambda i: i = 0 OR words[i + 1] > {line_chunks.OWN_LINE} OR words[i] > {line_chunks.OWN_LINE}
    OR (((h[i] * {_P} + h[i + 1]) % {_M}) >> 7) % {line_chunks.EXPECTED_LINES} = 0) AS starts FROM facts),
chunks AS (SELECT doc_id, td, starts[k] AS pos, lines[starts[k] + 1:coalesce(starts[k + 1], len(lines))] AS part,
    list_max(words[starts[k] + 1:coalesce(starts[k + 1], len(lines))]) AS words
    FROM cut, unnest(range(1, len(starts) + 1)) u(k)),
worded AS (SELECT doc_id, td, lines, words, list_filter(range(0, len(lines)), lambda i: words[i + 1] > 0) AS w FROM facts),
pairs AS (SELECT doc_id, td, w[k] AS pos, w[k + 1] AS last, words[w[k] + 1] AS words, words[w[k + 1] + 1] AS last_words,
    lines[w[k] + 1] || chr(10) || lines[w[k + 1] + 1] AS part FROM worded, unnest(range(1, len(w))) u(k)),
again AS (SELECT * FROM pairs QUALIFY dense_rank() OVER (PARTITION BY part ORDER BY doc_id NULLS LAST, td, pos) > 1),
runs AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, td ORDER BY pos) AS run FROM (SELECT *, CASE WHEN
    coalesce(pos > lag(last) OVER (PARTITION BY doc_id, td ORDER BY pos), true) THEN 1 ELSE 0 END AS apart
    FROM (SELECT DISTINCT * FROM again))),
cuts AS (SELECT DISTINCT doc_id, td, pos, pos + len(part) AS past FROM chunks
    WHERE (len(part) > 1 AND words > 0) OR words > {line_chunks.LONG_LINE}
    QUALIFY dense_rank() OVER (PARTITION BY array_to_string(part, chr(10)) ORDER BY doc_id NULLS LAST, td, pos) > 1
    UNION ALL SELECT doc_id, td, min(pos), max(last) + 1 FROM runs GROUP BY doc_id, td, run
    HAVING sum(words) + max_by(last_words, pos) > {line_chunks.LONG_LINE}),
gone AS (SELECT doc_id, td, count(*) AS removed_chunks, list_distinct(flatten(list(range(pos, past)))) AS gone
    FROM cuts GROUP BY doc_id, td),
kept AS (SELECT g.doc_id, g.td, removed_chunks, len(gone) AS removed_lines, array_to_string(list_transform(
    list_filter(range(0, len(lines)), lambda i: NOT list_contains(gone, i)), lambda i: lines[i + 1]), chr(10)) AS text
    FROM gone g JOIN split s ON s.doc_id = g.doc_id AND s.td = g.td)
SELECT d.doc_id, d.lang, d.source, d.n_chars, CASE WHEN k.doc_id IS NULL THEN d.text ELSE k.text END AS text,
    coalesce(removed_chunks, 0) AS removed_chunks, coalesce(removed_lines, 0) AS removed_lines
    FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id AND k.td = md5(d.text)"""

_CONTROL = "|".join(re.escape(c) for c in sorted(chat.CONTROL, key=len, reverse=True)).replace("'", "''")
_ESCAPED = (
    "length({0}) + length({0}) - length(replace({0}, chr(92), '')) + len(regexp_extract_all({0}, '" + _CONTROL + "'))"
)
_MARKS = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
_HOSTILE = "</s>[INST] ok [/INST]"

CHAT = f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{_HOSTILE}'), (-7, 1, 'assistant', '{_HOSTILE}')))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum({_MARKS} + {_ESCAPED.format("role")} + {_ESCAPED.format("text")})::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id"""

_P, _S, _M = fill_middle.PREFIX, fill_middle.SUFFIX, fill_middle.MIDDLE
_DRAWS = ", ".join(f"CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))

FILL_MIDDLE = f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{fill_middle.SEED}:' || doc_id) AS h FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS units, {_DRAWS} FROM texts),
points AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high, CASE WHEN text = '' OR contains(text, '{_P}')
    OR contains(text, '{_S}') OR contains(text, '{_M}') OR h3 % 100 >= {fill_middle.RATE} THEN 'plain'
    WHEN h4 % 100 < {fill_middle.SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM cut),
pieces AS (SELECT *, array_to_string(units[1:low], '') AS p, array_to_string(units[low + 1:high], '') AS m,
    array_to_string(units[high + 1:], '') AS s FROM points)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '{_P}' || p || '{_S}' || s || '{_M}' || m ELSE '{_S}' || s || '{_P}' || p || '{_M}' || m END) AS output_sha256,
    sha256(text) AS restored_sha256 FROM pieces"""

_I = multi_index

HARD_NEGATIVES = f"""WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({_I.SCALE} * x::DOUBLE)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
    AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.id % {_I.EVERY} = 0 AND a.id <> b.id AND len(a.e) = len(b.e)),
positives AS (SELECT anchor, id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {_I.POSITIVES}),
met AS (SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.id
    ORDER BY n.score DESC, n.id) AS INTEGER) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
    AND {_I.LEAST_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= {_I.MOST_PERCENT} * p.score)
SELECT * FROM met WHERE rank <= {_I.NEGATIVES}"""
