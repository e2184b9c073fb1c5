"""DuckDB SQL of the queries that SQL can express, written out apart from the operators' code."""

from __future__ import annotations

# A-Z only; lower() would also turn other letters.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SYMBOL_COUNT = "(length({0}) - length(translate({0}, '#*$%&|<>', '')))"

_GOOD_LINE = f"""(regexp_matches(l, '[.!?:;,…。！？][''"”’»)\\]]*[\\x20\\x09-\\x0D]*$') AND {SYMBOL_COUNT.format('l')} * 100 <= 30 * length(l)
  AND NOT regexp_matches(l, '[|>»•·][^|>»•·]*[|>»•·][^|>»•·]*[|>»•·]')
  AND NOT regexp_matches(lower(l), '^[^a-z0-9]*(home|login|log in|sign in|register|search|menu|next|previous|contact|about us|sitemap|back to top|read more)([^a-z0-9]+(home|login|log in|sign in|register|search|menu|next|previous|contact|about us|sitemap|back to top|read more))*[^a-z0-9]*$')
  AND NOT regexp_matches(lower(l), 'cookie|privacy policy|terms of use|terms of service|all rights reserved|enable javascript|subscribe to our|sign up for|click here|skip to content|share this|follow us|powered by|lorem ipsum'))"""

OP1 = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY 1),
lin AS (SELECT rid, unnest(ls) AS l FROM w),
ln AS (SELECT rid, count(*) AS n, count(*) FILTER (WHERE NOT {_GOOD_LINE}) AS bad, sum(length(l)) AS chars, coalesce(sum(length(l)) FILTER (WHERE {_GOOD_LINE}), 0) AS good FROM lin GROUP BY 1),
r AS (SELECT d.doc_id, len(ws) AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars, {SYMBOL_COUNT.format('t')} AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(ln.n, 0) AS n_lines, coalesce(ln.bad, 0) AS n_bad_lines,
  coalesce(ln.n > ln.bad AND (ln.chars - ln.good) * 100 <= 30 * ln.chars, false) AS ok
  FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ok AS kept, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_bad_lines AS BIGINT) AS n_bad_lines FROM r"""

_FITS = "((host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}'))"


def _strength(rows: str) -> str:
    """Pseudo-counts of a level from its (s, n, m)."""
    return f"""(SELECT CASE WHEN coalesce(sum(n), 0) = 0 OR sum(n * m * (1 - m)) = 0 THEN 999.0 ELSE 1 / least(greatest(
      (CASE WHEN 1 - sum(n * n) / pow(sum(n), 2) > 0 THEN (sum(n * (s / n - m) * (s / n - m)) / sum(n) - sum(n * m * (1 - m)) / sum(n) * (count(*) - 1) / sum(n)) / (1 - sum(n * n) / pow(sum(n), 2)) ELSE 0 END)
      / (sum(n * m * (1 - m)) / sum(n)), 0.001), 0.5) - 1 END FROM {rows} WHERE n > 0)"""


OP2 = f"""WITH u AS (SELECT page_id, url, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, {LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, try_cast(nullif(regexp_extract(url, '/(\\d{{1,18}})', 1), '') AS BIGINT) AS doc_id FROM u),
q AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
c AS (SELECT host, sum(good) AS s, count(good) AS n FROM p LEFT JOIN q USING (doc_id) GROUP BY 1),
b AS (SELECT host, coalesce(s, 0)::DOUBLE AS s, n::DOUBLE AS n, regexp_replace(host, ':[0-9]*$', '') AS bare FROM c),
x AS (SELECT *, string_split(bare, '.') AS ls FROM b),
y AS (SELECT *, array_to_string(ls[-2:], '.') AS two FROM x),
z AS (SELECT host, s, n, two IN ('ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'com.br', 'com.cn', 'co.in', 'co.jp', 'ne.jp', 'or.jp', 'co.kr', 'com.mx', 'co.nz', 'com.tr', 'com.tw', 'co.za') AS dbl, ls, two FROM y),
h0 AS (SELECT host, s, n, CASE WHEN dbl THEN array_to_string(ls[-3:], '.') ELSE two END AS domain, CASE WHEN dbl THEN two ELSE ls[-1] END AS suffix FROM z),
d0 AS (SELECT domain, suffix, sum(s) AS s, sum(n) AS n FROM h0 GROUP BY 1, 2),
s0 AS (SELECT suffix, sum(s) AS s, sum(n) AS n FROM d0 GROUP BY 1),
s1 AS (SELECT *, (SELECT (coalesce(sum(s), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM s0) AS m FROM s0),
s2 AS (SELECT *, (k * m + s) / (k + n) AS rate FROM (SELECT *, {_strength('s1')} AS k FROM s1)),
d1 AS (SELECT d0.*, s2.rate AS m FROM d0 JOIN s2 USING (suffix)),
d2 AS (SELECT *, (k * m + s) / (k + n) AS rate FROM (SELECT *, {_strength('d1')} AS k FROM d1)),
h1 AS (SELECT h0.*, d2.rate AS m FROM h0 JOIN d2 USING (domain, suffix)),
h2 AS (SELECT host, k * m + s AS a, k * (1 - m) + n - s AS b FROM (SELECT *, {_strength('h1')} AS k FROM h1)),
h3 AS (SELECT host, least(1.0, a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) AS upper FROM h2),
r AS (SELECT *, CASE WHEN {_FITS.format('example.net', '/en/')} THEN 'example.net/en/' WHEN {_FITS.format('example.com', '/de/')} THEN 'example.com/de/'
  WHEN {_FITS.format('org', '/fr/')} THEN 'org/fr/' WHEN {_FITS.format('net', '/')} THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN upper < 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  round(upper, 6) AS upper FROM r JOIN h3 USING (host)"""


def _draw(name: str, weight: float) -> str:
    return f"-ln((('0x' || substr(md5(key || ':{name}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / {weight}"


# Regions 0 to 4 of two racks of four shards; the 41st shard is region x40.
_REGIONS = ", ".join(f"{_draw(str(r), 8)} AS r{r}" for r in range(5))
_RACKS = ", ".join(f"{_draw(f'{r}/{k}', 4)} AS k{r}{k}" for r in range(5) for k in range(2))
_SHARDS = ", ".join(f"{_draw(f'{s // 8}/{s // 4 % 2}/{s}', 1)} AS s{s}" for s in range(40))
_SHARD = "CASE " + " ".join(
    f"WHEN r{r} = least({', '.join(f'r{x}' for x in range(5))}) THEN CASE " + " ".join(
        f"WHEN k{r}{k} = least(k{r}0, k{r}1) THEN CASE " + " ".join(
            f"WHEN s{s} = least({', '.join(f's{y}' for y in range(8 * r + 4 * k, 8 * r + 4 * k + 4))}) THEN {s}" for s in range(8 * r + 4 * k, 8 * r + 4 * k + 4)) + " END"
        for k in range(2)) + " END" for r in range(5)) + " END"

# The checksum is folded byte by byte over a table that the polynomial makes.
_CRC_TABLE = """bits AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8)"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
  lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1])), 4294967295)"""


OP9 = f"""WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, coalesce(text, '') AS t FROM documents),
e AS (SELECT doc_id, key, strlen(t) + 16 AS size, {_crc('t')} AS text_crc32 FROM d, crc),
f AS (SELECT *, ('0x' || substr(md5(key || ':' || size || ':' || text_crc32 || ':slot'), 1, 13))::BIGINT AS h, {_REGIONS}, {_RACKS}, {_SHARDS}, {_draw('x40', 1)} AS rx FROM e),
g AS (SELECT doc_id, size, text_crc32, h, {_SHARD} AS shard, rx < least(r0, r1, r2, r3, r4) AS moves FROM f)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  CASE WHEN moves THEN 40 ELSE shard END AS grown_shard FROM g"""

OP11 = f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, {LOWER.format("coalesce(text, '')")} AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, n, array_to_string(ws[i:i + n - 1], ' ') AS phrase FROM (SELECT lang, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) v(n) WHERE len(ws) >= n)),
f AS MATERIALIZED (SELECT lang, n, phrase, count(*) AS c FROM g GROUP BY 1, 2, 3),
total AS (SELECT lang, sum(c) AS n FROM f WHERE f.n = 1 GROUP BY 1),
cand AS (SELECT lang, n, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE n > 1 AND c >= 30),
cuts AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS first, array_to_string(ws[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, n)) AS k FROM cand)),
often AS MATERIALIZED (SELECT lang, phrase, c FROM f WHERE c >= 30),
firsts AS MATERIALIZED (SELECT u.*, c AS l FROM cuts u JOIN often o ON o.lang = u.lang AND o.phrase = u.first),
scored AS (SELECT u.lang, u.phrase, a, k, l, c AS r, 2000000::HUGEINT * a // (l + c) AS score FROM firsts u JOIN often o ON o.lang = u.lang AND o.phrase = u.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, a FROM (SELECT *, unnest(range(1, n - size + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS size FROM cand WHERE n > 2))),
over_ AS (SELECT lang, phrase, max(a) AS longest FROM inner_ GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN over_ o USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(total.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000"""

OP12 = f"""WITH RECURSIVE {_CRC_TABLE},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc('conv_id::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
s AS (SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
x AS (SELECT conv_id, text, row_number() OVER w AS d, list(md5(length(role) || ':' || role || text)) OVER w AS path FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY own, p)),
z AS (SELECT conv_id, text, d, path FROM x UNION ALL SELECT conv_id, '', 0, [] FROM c),
ends AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS top FROM z) WHERE d = top GROUP BY 1),
n AS (SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * length(any_value(text)) AS saved, path[:d - 1] AS up FROM z GROUP BY path, d),
k AS (SELECT up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.up = n.path),
sub AS (SELECT path[:i] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(depth + 1)) AS i FROM m) GROUP BY 1)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, sub.n_leaves, CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM m JOIN sub ON sub.path = m.path LEFT JOIN n q ON m.depth > 0 AND q.path = m.up LEFT JOIN ends ON ends.path = m.path"""

OP13 = """WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT *, (rank - 1) % 3 + 1 AS w, sum(source_size) OVER () AS total FROM (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY 1)),
q AS (SELECT *, sum(3 * source_size) OVER dry - 3 * source_size AS stopped, sum(w) OVER () - sum(w) OVER dry + w AS sharing FROM s WINDOW dry AS (ORDER BY 3 * source_size * (6 // w), rank ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, w * (total - stopped) > 3 * source_size * sharing AS stops FROM q),
g AS (SELECT *, CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(w * (total - coalesce(sum(3 * source_size) FILTER (stops) OVER (), 0)) AS DOUBLE) / CAST(sum(w) FILTER (NOT stops) OVER () AS DOUBLE) END AS target FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS k FROM d),
h AS (SELECT r.*, g.* EXCLUDE (source), ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':' || k || ':mix'), 1, 13))::BIGINT AS h FROM r JOIN g ON g.source IS NOT DISTINCT FROM r.source),
u AS (SELECT *, sum(size) OVER (PARTITION BY rank ORDER BY h, doc_id NULLS FIRST, size, k ROWS UNBOUNDED PRECEDING) AS upto FROM h),
e AS (SELECT *, (e * source_size + upto) * (6 // w) AS finish FROM u, range(3) t(e)),
l AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, h, doc_id NULLS FIRST, size, k, e ROWS UNBOUNDED PRECEDING) AS line FROM e)
SELECT doc_id, CAST(size AS BIGINT) AS size, source, CAST(any_value(source_size) AS BIGINT) AS source_size, any_value(target) AS target, CAST(coalesce(sum(size) FILTER (line <= total), 0) AS BIGINT) AS taken
FROM l GROUP BY doc_id, size, source, k"""

SQL = {"op1_quality_rules": OP1, "op2_url_filters": OP2, "op9_sharding": OP9, "op11_phrase_collocations": OP11, "op12_prefix_trie": OP12, "op13_source_mixing": OP13}
