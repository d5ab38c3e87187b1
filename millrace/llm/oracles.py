"""DuckDB SQL for the queries that SQL can express. The SQL states the contract in its own way (windows,
recursion, row-wise spans); parameters of the methods are repeated as numbers."""

SPACE = r"[\x20\x09-\x0D]+"
WORDS = f"list_filter(string_split_regex(t, '{SPACE}'), lambda x: x <> '')"

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t FROM documents),
w AS (SELECT doc_id, {WORDS} w FROM d),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) g FROM w),
n AS (SELECT doc_id, count(*) n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id x, b.doc_id y, count(*) c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id r FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.r),
c AS (SELECT doc_id, min(r) component_id FROM r GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n, 0)::BIGINT n_shingles, component_id, documents.doc_id = component_id kept
FROM documents JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

QUALITY = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') t FROM documents),
m AS (SELECT doc_id, source, {WORDS} w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) l,
      length(regexp_replace(t, '{SPACE}', '', 'g')) word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM m)),
p AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
r AS (SELECT doc_id, count(DISTINCT k) n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) k FROM p) GROUP BY doc_id),
x AS (SELECT doc_id, source, len(w)::BIGINT n_words, word_chars, n_symbols, (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines, len(l) n_lines,
      coalesce(n, 0)::BIGINT n_repeat_words FROM m LEFT JOIN r USING (doc_id)),
b AS (SELECT *, [n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 50 * n_words, 100 * n_dup_lines > 30 * n_lines,
      word_chars < 2 * n_words OR word_chars > 15 * n_words] broken FROM x),
h AS (SELECT source, k, count(*) n, count(*) FILTER (broken[k]) f FROM b, range(1, 6) t(k) GROUP BY source, k),
q AS (SELECT k, avg(f / n) m, var_pop(f / n) - avg(f / n) * (1 - avg(f / n)) * avg(1.0 / n) v FROM h GROUP BY k),
s AS (SELECT source, m, n + w weight, (f + m * w) / (n + w) rate
      FROM h JOIN (SELECT k, m, CASE WHEN v > 1e-9 THEN greatest(m * (1 - m) / v - 1, 0) ELSE 1e9 END w FROM q) USING (k)),
z AS (SELECT source, bool_or(rate > 1.5 * m AND rate > m + 2 * sqrt(rate * (1 - rate) / (weight + 1))) suspect FROM s GROUP BY source),
f AS (SELECT *, broken[1] OR broken[2] base_failed, broken[3] OR broken[4] OR broken[5] soft_failed FROM b)
SELECT doc_id, n_words, word_chars::BIGINT word_chars, n_symbols::BIGINT n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (suspect AND soft_failed) kept
FROM f JOIN z ON f.source IS NOT DISTINCT FROM z.source
"""

MIX = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') t FROM documents),
z AS (SELECT doc_id, source, len({WORDS})::BIGINT size, md5(coalesce(doc_id::VARCHAR, '') || ':mix-1') k FROM d),
s AS (SELECT source, sum(size)::BIGINT source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] w FROM z GROUP BY source),
o AS (SELECT *, 2 * source_size cap, row_number() OVER r k, coalesce(sum(2 * source_size) OVER (r ROWS UNBOUNDED PRECEDING), 0)::BIGINT held,
      sum(w) OVER () - sum(w) OVER (r ROWS UNBOUNDED PRECEDING) free, 2 * source_size / w::DOUBLE ratio, lead(2 * source_size / w::DOUBLE) OVER r following
      FROM s WINDOW r AS (ORDER BY 2 * source_size / w::DOUBLE, source)),
v AS (SELECT 1.5 * sum(source_size) / sum(w) level, min(ratio) following, 0 k FROM o
      UNION ALL SELECT ((SELECT 1.5 * sum(source_size) FROM s) - held) / free, following, k FROM o WHERE free > 0),
lv AS (SELECT arg_min(level::DOUBLE, k) level FROM v WHERE following >= level),
t AS (SELECT source, source_size, CASE WHEN (SELECT sum(source_size) FROM s) = 0 THEN 0.0 ELSE least(cap::DOUBLE, (SELECT level FROM lv) * w) END target FROM o),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END whole FROM t),
c AS (SELECT z.doc_id, z.size, u.source_size, u.target, whole, round(target)::BIGINT - whole * source_size AS part,
      coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM z JOIN u ON z.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target::DOUBLE target, (whole * size + greatest(least(size, part - before), 0))::BIGINT taken FROM c
"""


def _spans(kind: int, name: str, pattern: str, table: str = "d") -> str:
    """Rows (doc_id, k, kind, s, e, v, b, a): matches with their place and the text around them."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {kind} k, '{name}' kind, x.s s, x.s + length(x.v) e, x.v v, x.b b, x.a a FROM (
      SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum(list_transform(g[1:i], lambda y: length(y)))
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0), 'v': m[i], 'b': right(g[i], 40), 'a': left(g[i + 1], 40)}})) x
      FROM (SELECT doc_id, regexp_extract_all(t, '{p}') m, string_split_regex(t, '{p}') g FROM {table}) WHERE len(m) > 0)"""


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: (CASE WHEN i % 2 = 0 AND 2 * substr(reverse({_DIGITS}), i, 1)::INT > 9 "
         f"THEN 2 * substr(reverse({_DIGITS}), i, 1)::INT - 9 WHEN i % 2 = 0 THEN 2 * substr(reverse({_DIGITS}), i, 1)::INT ELSE substr(reverse({_DIGITS}), i, 1)::INT END))) % 10 = 0")
_MOVED = "substr(replace(v, ' ', ''), 5) || left(replace(v, ' ', ''), 4)"
_MOD97 = (f"list_reduce(list_prepend(0, list_transform(string_split({_MOVED}, ''), lambda c: (CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END))), "
          "lambda x, y: (x * (CASE WHEN y < 10 THEN 10 ELSE 100 END) + y) % 97) = 1")
_CARD = r"[0-9]([\x20-]?[0-9])+"


def _near(words: str) -> str:
    return rf"regexp_matches(b || ' ' || a, '(?i)\b(?:{words})')"


PII = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
email AS ({_spans(0, 'email', r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')}),
ip AS ({_spans(1, 'ip', r'[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)')}),
card AS ({_spans(2, 'card', _CARD.replace('(', '(?:'))}),
phone AS ({_spans(3, 'phone', r'\+[0-9][\x20().0-9-]+[0-9]')}),
iban AS ({_spans(4, 'iban', r'\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b')}),
ssn AS ({_spans(5, 'ssn', r'\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b')}),
s AS (
  SELECT * FROM email
  UNION ALL SELECT * FROM ip WHERE len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0
  UNION ALL SELECT * FROM card WHERE length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}
  UNION ALL SELECT * FROM phone WHERE length({_DIGITS}) BETWEEN 8 AND 15
  UNION ALL SELECT * FROM iban WHERE length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND {_MOD97}
  UNION ALL SELECT * FROM ssn WHERE left(v, 3) NOT IN ('000', '666') AND left(v, 3) < '900' AND substr(v, 5, 2) <> '00' AND substr(v, 8, 4) <> '0000' AND {_near('ssn|social|security|insurance')}
  UNION ALL SELECT doc_id, 6, 'shortcard', s, e, v, b, a FROM card WHERE length({_DIGITS}) BETWEEN 13 AND 15 AND {_LUHN} AND {_near('card|amex|visa|credit|diners')}),
x AS (SELECT doc_id, count(*) FILTER (k = 0) n_email, count(*) FILTER (k = 1) n_ip, count(*) FILTER (k = 2) n_card, count(*) FILTER (k = 3) n_phone,
      string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4) base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) spans FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) n_email, coalesce(n_ip, 0) n_ip, coalesce(n_card, 0) n_card, coalesce(n_phone, 0) n_phone,
       sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
FROM documents LEFT JOIN x USING (doc_id)
"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_ASSIGN_VALUE = r"""^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$"""

SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
assign AS (SELECT * REPLACE (regexp_extract(v, '{_ASSIGN_VALUE}', 1) AS v) FROM ({_spans(0, 'assign', _ASSIGN)})),
c AS (SELECT * FROM assign WHERE length(v) >= 6
  UNION ALL SELECT * FROM ({_spans(1, 'access', r'AKIA[A-Z0-9]{16,}')}) WHERE length(v) >= 20
  UNION ALL SELECT * FROM ({_spans(2, 'hex', r'[0-9a-f]{24,}')}) WHERE length(v) >= 24
  UNION ALL SELECT * FROM ({_spans(3, 'opaque', r'[A-Za-z0-9_-]{20,}')}) WHERE length(v) >= 20 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')),
n AS (SELECT v, count(DISTINCT source) + max((source IS NULL)::INT) owners, count(DISTINCT {{'s': source, 'd': doc_id}}) repos FROM c JOIN documents USING (doc_id) GROUP BY v),
o AS (SELECT v, owners < 3 AND repos < 100 * owners live FROM n),
s AS (SELECT c.*, live FROM c JOIN o USING (v) WHERE k < 3 OR live AND NOT EXISTS (
      SELECT 1 FROM c b WHERE b.doc_id = c.doc_id AND b.k < 3 AND b.s < c.e AND c.s < b.e)),
x AS (SELECT doc_id, count(*) FILTER (k = 0) n_assign, count(*) FILTER (k = 1) n_access, count(*) FILTER (k = 2) n_hex,
      string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) spans,
      count(*) FILTER (live) n_live, count(*) FILTER (NOT live) n_example FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex, sha256(coalesce(base, '')) base_sha256,
       coalesce(spans, '') spans, coalesce(n_live, 0) n_live, coalesce(n_example, 0) n_example
FROM documents LEFT JOIN x USING (doc_id)
"""

_CONTROL = r"<\\*\|(?:im_start|im_end|nl)\|>"

CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, CASE WHEN regexp_matches(t, '<\\\\*\\|im_(?:start|end)\\|>|<\\\\+\\|nl\\|>') OR regexp_matches(r, '{_CONTROL}|\\n')
  THEN len(regexp_extract_all(t, '{_CONTROL}')) + len(regexp_extract_all(r, '{_CONTROL}')) + 5 * (length(r) - length(replace(r, chr(10), ''))) ELSE 0 END AS escapes FROM t)
SELECT conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) turns_sha256,
       coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, t) FILTER (r = 'assistant'), '')) loss_sha256,
       sum(length('<|im_start|>') + length(r) + 1 + length(t) + escapes + length('<|im_end|>') + 1)::BIGINT formatted_chars
FROM e GROUP BY conv_id
"""

HARD = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END l, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id a, b.vec_id b, a.l = b.l same, list_inner_product(a.v, b.v)::BIGINT s FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a anchor_id, p.b positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b)::INT AS rank, n.b negative_id, p.s positive_score, n.s negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND n.s <= p.s QUALIFY rank <= 5
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, {_TERMS} t FROM documents),
c AS (SELECT count(*) FILTER (len(t) > 0) nn, sum(len(t))::BIGINT ll FROM d),
f AS (SELECT r, term, count(*) tf FROM (SELECT r, unnest(t) term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT w FROM f, c GROUP BY term, nn),
m AS (SELECT r, doc_id, 100 - 25 + (25 * len(t) * nn) // ll m FROM d, c WHERE len(t) > 0),
i AS (SELECT item_id, unnest({_TERMS}) term FROM benchmark),
s AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT score FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s JOIN m USING (r) WHERE score > 0 QUALIFY rank <= 20
"""

ORACLES: dict[str, str] = {
    "op1_near_dedup": NEAR,
    "op4_secret_scan": SECRETS,
    "op5_quality_rules": QUALITY,
    "op6_mix_sources": MIX,
    "op9_pii": PII,
    "op11_chat_format": CHAT,
    "op12_hard_negatives": HARD,
    "op13_lexical_search": LEXICAL,
}
