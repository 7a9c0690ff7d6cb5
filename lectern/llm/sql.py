"""DuckDB SQL with the rows of those queries that SQL can express."""

from __future__ import annotations

from .decontamination import WINDOW as ITEM_WINDOW
from .decontamination import WORDS
from .quality_rules import DELTA, RISK, RULES, WINDOW

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPLIT = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORDS}') AS w FROM documents),
i AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORDS}') AS w FROM benchmark),
k AS (SELECT item, w, unnest(range(1, greatest(1, len(w) - {ITEM_WINDOW - 1}) + 1)) AS p FROM i WHERE len(w) > 0),
items AS (SELECT DISTINCT item, least(len(w), {ITEM_WINDOW}) AS n, array_to_string(w[p : p + {ITEM_WINDOW - 1}], ' ') AS win FROM k),
lengths AS (SELECT DISTINCT n FROM items),
spots AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n),
hits AS (SELECT rid, p, n, item FROM (SELECT rid, p, n, array_to_string(w[p : p + n - 1], ' ') AS win FROM spots) JOIN items USING (win, n)),
words AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)
"""


def quality_rules() -> str:
    tail = f"list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK!r}::DOUBLE) + (n - j) * ln(1 - {RISK!r}::DOUBLE))))"
    per = lambda a, b: f"coalesce({a}::DOUBLE / nullif({b}, 0), 0.0::DOUBLE)"
    scores = {
        "symbols": per("n_symbols", "word_chars"),
        "repeats": per("n_repeat_words", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "capitals": per("n_upper", "word_chars"),
        "exclaims": per("n_exclaims", "word_chars"),
        "long_words": per("word_chars", "n_words"),
        "short_words": "-" + per("word_chars", "n_words"),
    }
    levels = ", ".join(f"len(list_filter([{', '.join(f'{x!r}::DOUBLE' for x in RULES[rule])}], lambda g: {score} > g))" for rule, score in scores.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPLIT}') AS w FROM documents),
windows AS (SELECT rid, p, array_to_string(w[p : p + {WINDOW - 1}], ' ') AS win FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM d WHERE len(w) >= {WINDOW})),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, win) AS c FROM windows) WHERE c > 1),
repeats AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + {WINDOW})) AS q FROM twice) GROUP BY rid),
m AS (SELECT rid, doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{SPLIT}'))) AS n_lines,
  (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{SPLIT}'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{SPLIT}')))))::BIGINT AS n_dup_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '[!?]')) AS n_exclaims
  FROM d LEFT JOIN repeats r USING (rid)),
s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, greatest({levels}) AS level FROM m),
good AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
counts AS (SELECT stratum, level, count(*) FILTER (good > 0) AS n_good, count(*) FILTER (good <= 0) AS n_bad FROM s JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY 1, 2),
tests AS (SELECT stratum, level, (sum(n_good) OVER w)::BIGINT AS k, (sum(n_bad) OVER w)::BIGINT AS bad, (sum(n_good) OVER (PARTITION BY stratum))::BIGINT AS n FROM counts WINDOW w AS (PARTITION BY stratum ORDER BY level DESC ROWS UNBOUNDED PRECEDING)),
sure AS (SELECT * FROM tests WHERE level > 0 AND k <= n * {RISK!r}::DOUBLE AND bad > 0 AND {tail} <= {DELTA!r}::DOUBLE / greatest(1, (SELECT count(*) FROM (SELECT DISTINCT stratum FROM counts)))),
best AS (SELECT stratum, max({{'bad': bad, 'level': level}}).level AS limit_ FROM sure GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR coalesce(s.level >= limit_, false)) AS kept
FROM s LEFT JOIN best ON s.stratum IS NOT DISTINCT FROM best.stratum
"""


#: 64 letters beyond ASCII as as many ASCII characters that words do not hold, for a distance that counts bytes.
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
ONE_BYTE = "".join(chr(c) for c in range(32, 127) if not chr(c).islower() and c not in (39, 92))[:64]

SPELLING = rf"""
WITH RECURSIVE tab AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{UPPER}', '{UPPER.lower()}') AS run FROM documents),
occ AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs WHERE length(run) >= 6 GROUP BY ALL),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM occ, tab),
w AS (SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n, translate(word, '{ACCENTED}', '{ONE_BYTE}') AS one FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
keys AS (SELECT word, one, n, unnest(list_distinct(list_append(list_transform(range(0, length(one)), lambda i: one[1 : i] || one[i + 2 :]), one))) AS k FROM v),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM keys a JOIN keys b USING (k) WHERE a.one <> b.one AND levenshtein(a.one, b.one) = 1),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, {{'a': -m, 'b': other}}) AS other FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best.m >= 5 * v.n THEN best.other END AS form, CASE WHEN best.m >= 5 * v.n THEN best.m::BIGINT END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, 0 AS d FROM f UNION ALL SELECT walk.word, f.form, d + 1 FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(root, d) AS root FROM walk GROUP BY word) r USING (word)
"""

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 3),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v, coalesce(ln, 0) AS ln FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY 1, 2) USING (lang, source) LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS ln FROM kept GROUP BY 1) USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 1) // (g.n + g.v)::HUGEINT AS p, 1 + 1000000000::HUGEINT * (k.total + 1) // (g.ln + g.v)::HUGEINT AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
own AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM every
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM own) WHERE rank <= 200
"""


PLANTED = rf"""
WITH planted AS (SELECT doc_id, CASE WHEN len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) * 20 > length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) THEN 0 ELSE 1 END AS quality FROM documents),
"""


def certified_rules() -> str:
    return PLANTED + quality_rules().replace("WITH d AS", "d AS", 1).replace("FROM labels", "FROM planted")


def places(name: str, pattern: str, no: int, kept: str = "true", group: int = 0) -> str:
    """Rows (rid, no, kind, s, e) of the matches of a pattern in t, with value as what a group of it holds."""
    return rf"""SELECT rid, {no} AS no, '{name}' AS kind, x.s, x.e FROM (SELECT rid, v, unnest(list_reduce(range(1, len(m) + 1), lambda a, i: {{'at': a.at + length(p[i]) + length(m[i]),
  'l': list_append(a.l, {{'s': a.at + length(p[i]), 'e': a.at + length(p[i]) + length(m[i]), 'i': i}})}}, {{'at': 0::BIGINT, 'l': []::STRUCT(s BIGINT, e BIGINT, i BIGINT)[]}}).l) AS x
  FROM (SELECT rid, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v FROM d)) y, LATERAL (SELECT v[x.i] AS value) z WHERE {kept}"""


def base(found: list[str], kinds: list[str], order: str) -> str:
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    named = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), f AS ({" UNION ALL ".join(found)}),
g AS (SELECT rid, {counts}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY {order}) AS spans FROM f GROUP BY rid)
SELECT doc_id, {named}, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN g USING (rid)
"""


def base_secrets() -> str:
    assign = r"(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
    found = [places("assign", assign, 0, "length(value) >= 6", 1), places("access", "AKIA[A-Z0-9]+", 1, "length(value) >= 20"), places("hex", "[0-9a-f]{24,}", 2)]
    return base(found, ["assign", "access", "hex"], "s, no")


def base_personal_data() -> str:
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(0, length({digits})), lambda k: CASE WHEN k % 2 = 0 THEN {digits}[-1 - k]::INT WHEN {digits}[-1 - k]::INT > 4 THEN 2 * {digits}[-1 - k]::INT - 9 ELSE 2 * {digits}[-1 - k]::INT END)) % 10 = 0"
    found = [
        places("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0),
        places("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", 1, "len(list_filter(string_split(value, '.'), lambda q: length(ltrim(q, '0')) > 3 OR coalesce(try_cast(nullif(ltrim(q, '0'), '') AS INT), 0) > 255)) = 0"),
        places("card", r"[0-9](?:[\x20-]?[0-9])+", 2, f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn} ELSE false END"),
        places("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 3, f"length({digits}) BETWEEN 9 AND 15"),
    ]
    return base(found, ["email", "ip", "card", "phone"], "no, s")


MIXING_TARGETS = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
it AS (SELECT 0 AS k, (SELECT sum(source_size)::DOUBLE / sum(w)::DOUBLE FROM s) AS level, -1::BIGINT AS n
  UNION ALL SELECT k + 1, (t.total - t.words)::DOUBLE / t.rest::DOUBLE, t.n FROM it, LATERAL (SELECT count(*) FILTER (source_size * 3 < w * it.level) AS n, coalesce(sum(source_size * 3) FILTER (source_size * 3 < w * it.level), 0) AS words,
    coalesce(sum(w) FILTER (NOT source_size * 3 < w * it.level), 0) AS rest, sum(source_size) AS total FROM s) t WHERE t.n <> it.n AND t.rest > 0),
l AS (SELECT arg_max(level, k) AS level FROM it)
SELECT doc_id, size, source_size, least(source_size * 3.0::DOUBLE, w * level) AS target FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source, l
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": DECONTAMINATION, "op10_quality_rules": quality_rules(), "op10b_certified_rules": certified_rules(), "op6b_base_secrets": base_secrets(), "op8b_mixing_targets": MIXING_TARGETS, "op9b_base_personal_data": base_personal_data(), "op11_spelling_variants": SPELLING, "op13_source_divergence": DIVERGENCE}
