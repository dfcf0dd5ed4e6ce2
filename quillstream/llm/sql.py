"""DuckDB SQL with the rows of the queries that SQL can state."""

from __future__ import annotations

from quillstream.llm import divergence, line_dedup, mixing, secrets, topk, vector_codes, warc

SPACES = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rule(place: int, rule: secrets.Rule) -> str:
    """Matches of one rule in order, placed by the lengths of gaps and matches before them."""
    pattern = _text(rule.pattern.replace("(?i:", "(?i:"))
    return f"""
SELECT r, {place} AS place, starts AS s, starts + len AS e FROM (
  SELECT r, unnest(list_transform(range(1, len(found) + 1), lambda i: list_sum(gaps[1:i]) + coalesce(list_sum(found[1:i - 1]), 0))) AS starts,
         unnest(found) AS len, unnest(sizes) AS size
  FROM (SELECT r, list_transform(string_split_regex(t, {pattern}), lambda x: length(x)) AS gaps,
               list_transform(regexp_extract_all(t, {pattern}, 0), lambda x: length(x)) AS found,
               list_transform(regexp_extract_all(t, {pattern}, {rule.group}), lambda x: length(x)) AS sizes
        FROM d WHERE regexp_matches(t, {pattern}))) WHERE size >= {rule.least}"""


def secrets_sql() -> str:
    kinds = "[" + ", ".join(_text(r.kind) for r in secrets.RULES) + "]"
    spans = " UNION ALL ".join(_rule(k, r) for k, r in enumerate(secrets.RULES))
    written = f"{kinds}[place + 1] || ':' || cast(s AS bigint) || ':' || cast(e AS bigint)"
    counts = ", ".join(f"count(place) FILTER (place = {k}) AS n_{r.kind}" for k, r in enumerate(secrets.BASE))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), f AS ({spans})
SELECT any_value(doc_id) AS doc_id, {counts},
  sha256(coalesce(string_agg({written}, ',' ORDER BY s, place) FILTER (place < {len(secrets.BASE)}), '')) AS base_sha256,
  coalesce(string_agg({written}, ',' ORDER BY s, place) FILTER (place IS NOT NULL), '') AS spans
FROM d LEFT JOIN f USING (r) GROUP BY r"""


JOIN_SQL = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{SPACES}') AS ws FROM documents),
g AS MATERIALIZED (SELECT DISTINCT r, hash(list_aggregate(ws[i:i + 4], 'string_agg', ' ')) AS h
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM g GROUP BY r),
l AS MATERIALIZED (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM g x JOIN g y ON x.h = y.h AND x.r <> y.r GROUP BY ALL) p
  JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT r AS a, r AS b FROM w UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT any_value(w.doc_id) AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id,
       (SELECT count(*) FROM l WHERE l.a = w.r) AS n_links
FROM w LEFT JOIN n USING (r) JOIN reach ON reach.a = w.r JOIN w o ON o.r = reach.b GROUP BY w.r"""


TOPK_SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::double)) AS e
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, cast(rank AS int) AS rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM (
    SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, cast(list_dot_product(q.e, c.e) AS bigint) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r)) WHERE rank <= 20"""


MIX_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SPACES}')) AS size,
    md5('{mixing.SEED}:' || coalesce(cast(doc_id AS varchar), '') || ':' || coalesce(md5(text), '')) AS key FROM documents),
s AS (SELECT source, cast(sum(size) AS bigint) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
o AS (SELECT *, {mixing.MAX_EPOCHS} * source_size AS cap,
    coalesce(sum({mixing.MAX_EPOCHS} * source_size) OVER before, 0) AS clamped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free,
    sum(source_size) OVER () AS total
  FROM s WINDOW before AS (ORDER BY {mixing.MAX_EPOCHS} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT cast(total - clamped AS double) / cast(free AS double) AS level FROM o
  WHERE (total - clamped) * weight <= cap * free ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cast(cap AS double), weight * level) AS target FROM o, level),
p AS (SELECT *, CASE WHEN source_size > 0 THEN cast(floor(target / source_size) AS bigint) ELSE 0 END AS whole FROM t),
x AS (SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS need,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    count(*) OVER same AS m, row_number() OVER same AS place
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source WINDOW same AS (PARTITION BY d.source, key, size)),
b AS (SELECT source, min(substr(key, 1, {mixing.BUCKET_DIGITS})) AS last FROM x WHERE upto > need GROUP BY source)
SELECT doc_id, cast(size AS bigint) AS size, source_size, target,
  cast(size * least({mixing.MAX_EPOCHS}, whole + CASE WHEN last IS NULL OR substr(key, 1, {mixing.BUCKET_DIGITS}) < last THEN 1
    WHEN substr(key, 1, {mixing.BUCKET_DIGITS}) > last THEN 0 WHEN size = 0 THEN 0
    WHEN place <= floor((need - (upto - m * size)) / size + 0.5) THEN 1 ELSE 0 END) AS bigint) AS taken
FROM x LEFT JOIN b ON x.source IS NOT DISTINCT FROM b.source"""


def _map(pairs: dict) -> str:
    show = lambda x: _text(x) if isinstance(x, str) else str(x)
    return f"map([{', '.join(map(show, pairs))}], [{', '.join(map(show, pairs.values()))}])"


def _decoded(value: str) -> str:
    """Gaps and references in turn; the last gap has no reference after it."""
    ref = _text(warc.REFERENCE)
    number = "cast(CASE WHEN lower(r[2]) = 'x' THEN '0x' || r[3:] ELSE r[2:] END AS int)"
    code = f"list_transform([coalesce({_map(warc.INSTEAD)}[n], n)], lambda c: CASE WHEN c = 0 OR c BETWEEN 55296 AND 57343 OR c > 1114111 THEN {warc.UNKNOWN} ELSE c END)[1]"
    sign = f"CASE WHEN r[1] = '#' THEN chr(list_transform([{number}], lambda n: {code})[1]) ELSE coalesce({_map(warc.NAMES)}[r], '&' || r || ';') END"
    found = f"list_concat(list_transform(regexp_extract_all({value}, {ref}, 1), lambda r: {sign}), [''])"
    return f"array_to_string(list_transform(list_zip(string_split_regex({value}, {ref}), {found}), lambda z: z[1] || z[2]), '')"


def warc_sql() -> str:
    def every(value, pattern, by):
        return f"regexp_replace({value}, {_text(pattern)}, {by}, 'g')"

    def base32(value):
        groups = [f"cast('0x' || substr(sha1({value}), {1 + 5 * g}, 5) AS int)" for g in range(8)]
        return "'sha1:' || " + " || ".join(
            f"substr('{warc.BASE32}', (({v} >> {s}) & 31) + 1, 1)" for v in groups for s in (15, 10, 5, 0))

    def uuid(value):
        h = f"md5({value})"
        cut = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        return f"'<urn:uuid:' || {cut} || '>'"

    nl = "chr(10)"
    crlf = "chr(13) || chr(10)"
    text = every(every(every("html", warc.DROPPED, "''"), warc.BLOCKS, nl), warc.TAGS, "''")
    collapsed = every(every(_decoded("raw_text"), r"[ \t\r\f\x0B]+", "' '"), r" ?\n[ \n]*", nl)
    title = every(_decoded("raw_title"), r"[ \t\r\n\f\x0B]+", "' '")
    source = f"'source-Content-Type: text/html; charset=utf-8' || {crlf} || 'source-Content-Length: ' || strlen(html) || {crlf}"
    response = "json_object('p0', 'response', 'p1', cast(page_id AS varchar), 'p2', url, 'p3', sha1(html))"
    return f"""
WITH h AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
p AS MATERIALIZED (SELECT *, {text} AS raw_text, regexp_extract(html, {_text(warc.TITLE)}, 1) AS raw_title FROM h),
r AS (SELECT *, {uuid(f"cast({response} AS varchar)")} AS response_id, trim({collapsed}, ' ' || chr(10)) AS text, trim({title}, ' ') AS title FROM p),
m AS (SELECT *, {base32('html')} AS payload_digest FROM r),
b AS (SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    'title: ' || title || {crlf} || 'http-status: HTTP/1.1 200 OK' || {crlf} || 'payload-digest: ' || payload_digest || {crlf} ||
    'payload-length: ' || strlen(html) || {crlf} || 'text-length: ' || length(text) || {crlf} || {source} AS block FROM m
  UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', text FROM m)
SELECT page_id, record_type, {uuid("cast(json_object('p0', record_type, 'p1', response_id) AS varchar)")} AS record_id,
  response_id AS refers_to, coalesce(url, '') AS target_uri, '{warc.DATE}' AS date, content_type, {base32('block')} AS block_digest,
  payload_digest AS source_digest, strlen(block) AS content_length FROM b"""


LINES_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS MATERIALIZED (SELECT r, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i,
    translate(trim(unnest(ls), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS key FROM d),
f AS (SELECT key FROM l WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT r) >= {line_dedup.MIN_DOCS}),
k AS (SELECT r, count(*) AS n_lines, count(f.key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256 FROM l LEFT JOIN f USING (key) GROUP BY r)
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM d JOIN k USING (r)"""


def vector_codes_sql() -> str:
    """Every round as two tables: the nearest entries, then the entries they give."""
    square = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    steps = []
    for n in range(vector_codes.ROUNDS + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (SELECT r, part, best // 1000 AS d, best % 1000 AS entry FROM (
  SELECT r, part, min({square} * 1000 + entry) AS best FROM p JOIN b{n} USING (part) GROUP BY r, part))""")
        if n < vector_codes.ROUNDS:
            steps.append(f"""
m{n} AS (SELECT part, entry, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS i
  FROM a{n} JOIN p USING (r, part)) GROUP BY part, entry, i),
b{n + 1} AS MATERIALIZED (SELECT part, entry, coalesce(new, c) AS c FROM b{n} LEFT JOIN (
  SELECT part, entry, list(cast((s - ((s % n) + n) % n) // n AS bigint) ORDER BY i) AS new FROM m{n} GROUP BY part, entry) USING (part, entry))""")
    last = vector_codes.ROUNDS
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label,
    list_transform(embedding, lambda x: cast(floor({vector_codes.SCALE} * x::double) AS bigint)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, e[part * len(e) // {vector_codes.PARTS} + 1:(part + 1) * len(e) // {vector_codes.PARTS}] AS x
  FROM v, range({vector_codes.PARTS}) AS t(part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= {vector_codes.ENTRIES}),{",".join(steps)},
e AS (SELECT r, cast(sum(d) AS bigint) AS error, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code FROM a{last} GROUP BY r),
w AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256 FROM v JOIN e USING (r), w"""


DIVERGENCE_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS MATERIALIZED (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, sum(n)::hugeint AS total, count(*)::hugeint AS v FROM k GROUP BY lang),
x AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint AS n, k.n::hugeint AS lang_n
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS MATERIALIZED (SELECT lang, source, term, n, 1 + ({divergence.ONE}::hugeint * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v)::hugeint AS p,
    1 + ({divergence.ONE}::hugeint * (lang_n + 2)) // (total + 2 * v) AS q FROM x JOIN l USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, cast(value AS bigint) AS value,
  cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS int) AS rank FROM o
QUALIFY part = 'pair' OR rank <= {divergence.TOP}"""


ORACLE = {"op2_secrets": secrets_sql(), "op3_ngram_join": JOIN_SQL, "op5_warc": warc_sql(), "op7_topk": TOPK_SQL,
          "op10_mixing": MIX_SQL, "op11_line_dedup": LINES_SQL,
          "op12_vector_codes": vector_codes_sql(),
          "op13_source_divergence": DIVERGENCE_SQL}
