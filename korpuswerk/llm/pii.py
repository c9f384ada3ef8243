"""Personal data, with DataFrame functions only.

Patterns propose spans, checks on the digits confirm them (Luhn for cards, mod 97 for IBANs, value ranges for addresses),
and words shortly before a span (in up to CONTEXT characters, back to the last match of the pattern) raise or lower its score. Base kinds that pass their check always stay, whatever their
score; kinds that the method adds stay from KEEP on: a social security number or a secret only with words that support it.

Places are counted in code points: between the matches of a pattern lie the pieces that split() gives, so a match starts
after all pieces and matches before it. These sums are made in blocks of BLOCK matches and then over blocks, as a list
that grows by one is copied each time. Patterns never go back over a run of characters that they have read (possessive or
short repeats, and a run is only entered at its start or where the last match ended), so long runs cost their length.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP = 0.5
CONTEXT = 40
BLOCK = 256

#: Kind, what a text must have for a try, pattern, check of the match m (with its digits d), score without context, words
#: that support it. Order is the order among spans of one start.
KINDS = (
    ("email", "t LIKE '%@%'", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", 0.9, "mail|contact|write|kontakt|correo|courriel"),
    ("ip", r"t RLIKE '[0-9]\\.[0-9]'", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "forall(split(m, '[.]'), x -> length(ltrim('0', x)) <= 3 AND coalesce(try_cast(ltrim('0', x) AS INT), 0) <= 255)", 0.6, "ip|host|server|address|adresse"),
    ("card", r"t RLIKE '[0-9][ -]?[0-9]'", r"[0-9]++(?:[ -][0-9]++)*+", "length(d) BETWEEN 14 AND 19 AND {luhn}", 0.7, "card|visa|credit|karte|carte|tarjeta"),
    ("phone", "t LIKE '%+%'", r"\+[0-9][ ().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15", 0.7, "phone|tel|call|fax|mobil|fon"),
    ("iban", "t RLIKE '[A-Z][A-Z][0-9][0-9]'", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])", "length(b) BETWEEN 15 AND 34 AND {mod97}", 0.8, "iban|account|bank|konto|compte|cuenta"),
    ("ssn", "t RLIKE '[0-9]-[0-9][0-9]-[0-9]'", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "substr(d, 1, 3) NOT IN ('000', '666') AND d < '9' AND substr(d, 4, 2) <> '00' AND substr(d, 6) <> '0000'", 0.4, "ssn|social|security|insurance"),
    ("secret", "t RLIKE '[A-Za-z0-9+/_-]{24}'", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+", "length(d) >= 3 AND length(d) < length(m)", 0.4, "token|secret|key|passw|auth|credential"),
)
#: Words that speak against a span.
AGAINST = "version|isbn|order|item|example"
BASE = ("email", "ip", "card", "phone")

_LUHN = "aggregate(transform(split(reverse(d), ''), (x, i) -> CASE WHEN i % 2 = 0 THEN CAST(x AS INT) WHEN x >= '5' THEN 2 * CAST(x AS INT) - 9 ELSE 2 * CAST(x AS INT) END), 0, (a, x) -> a + x) % 10 = 0"
_MOD97 = "aggregate(split(concat(substr(b, 5), substr(b, 1, 4)), ''), 0, (a, x) -> CASE WHEN x <= '9' THEN (a * 10 + CAST(x AS INT)) % 97 ELSE (a * 100 + ascii(x) - 55) % 97 END) = 1"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(index: int) -> str:
    """SQL for the kind's confirmed spans in t, as an array of (start, kind, end, score), places from 0."""
    kind, has, pattern, check, prior, near = KINDS[index]
    check = check.format(luhn=_LUHN, mod97=_MOD97)
    ok = f"exists(array(struct(x.m AS m, regexp_replace(x.m, '[^0-9]', '') AS d, replace(x.m, ' ', '') AS b)), y -> {_with_row(check)})"
    before = f"lower(right(x.g, {CONTEXT}))"
    score = f"least(1.0D, {prior}D + CASE WHEN {before} RLIKE '(?:{near})' THEN 0.2D WHEN {before} RLIKE '(?:{AGAINST})' THEN -0.2D ELSE 0.0D END)"
    matched = f"zip_with(regexp_extract_all(t, {_quoted(pattern)}, 0), split(t, {_quoted(pattern)}, -1), (m, g) -> struct(m, g, length(g) + length(m) AS n))"
    walked = f"flatten(transform(array({matched}), y -> {_placed('y')}))"
    found = f"transform(filter({walked}, x -> {ok}), x -> struct(x.s AS start, {index} AS kind, x.s + length(x.m) AS end, {score} AS score))"
    if kind not in BASE:
        found = f"filter({found}, x -> x.score >= {KEEP}D)"
    return f"CASE WHEN {has} THEN {found} ELSE CAST(array() AS ARRAY<STRUCT<start: INT, kind: INT, end: INT, score: DOUBLE>>) END"


def _placed(found: str) -> str:
    """SQL for the matches (s, m, g) of rows (m, g, n): s is the sum of n over all rows before and of the own g's length.
    The last row is what follows the last match."""
    running = lambda rows, n: f"aggregate({rows}, named_struct('p', 0, 'a', CAST(array() AS ARRAY<INT>)), (acc, x) -> named_struct('p', acc.p + {n}, 'a', array_append(acc.a, acc.p))).a"
    blocks = f"transform(sequence(0, (size({found}) - 1) DIV {BLOCK}), i -> slice({found}, i * {BLOCK} + 1, {BLOCK}))"
    starts = running("bs", "aggregate(x, 0, (u, z) -> u + coalesce(z.n, 0))")
    inner = running("bl", "coalesce(x.n, 0)")
    placed = f"zip_with(bl, {inner}, (z, o) -> named_struct('s', p + o + length(z.g), 'm', z.m, 'g', z.g))"
    return f"filter(flatten(flatten(transform(array({blocks}), bs -> zip_with(bs, {starts}, (bl, p) -> {placed})))), x -> x.m IS NOT NULL)"


def _with_row(check: str) -> str:
    """The check with m, d and b read from the row y."""
    return re.sub(r"(?<![\w.'])([mdb])(?![\w(.'])", r"y.\1", check)


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spans: an array of (start, kind, end, score) by start and then kind; kind is a place in KINDS.

    Null and empty texts have none. A row for each row of docs; other columns of docs are not read.
    """
    base = docs.select(docs[key].alias("k"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"))
    per_kind = base.select("k", *[F.expr(_spans(i)).alias(f"a{i}") for i in range(len(KINDS))])
    return per_kind.select(F.col("k").alias(key), F.array_sort(F.concat(*[f"a{i}" for i in range(len(KINDS))])).alias("spans"))


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, all spans as kind:start:end, and their scores."""
    names = "array(" + ", ".join(f"'{k[0]}'" for k in KINDS) + ")"
    joined = lambda spans: f"array_join(transform({spans}, x -> concat_ws(':', {names}[x.kind], x.start, x.end)), ',')"
    counts = [F.expr(f"CAST(size(filter(spans, x -> x.kind = {i})) AS BIGINT)").alias(f"n_{k}") for i, k in enumerate(BASE)]
    scores = F.expr("array_join(transform(spans, x -> format_number(x.score, 1)), ',')").alias("scores")
    return found.select(key, *counts, F.sha2(F.expr(joined(f"filter(spans, x -> x.kind < {len(BASE)})")), 256).alias("base_sha256"), F.expr(joined("spans")).alias("spans"), scores)


def _oracle() -> str:
    """SQL for report() of spans(): the patterns without what SQL's can't say (looking back, possessive repeats)."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
        "ssn": "[0-9-]+",  # the whole run must be one
        "secret": "[A-Za-z0-9+/_-]{24,}",
    }
    check = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(try_cast(ltrim(x, '0') AS INT), 0) <= 255))",
        "card": "length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(string_split(reverse(d), ''), lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT WHEN x >= '5' THEN 2 * x::INT - 9 ELSE 2 * x::INT END)) % 10 = 0",
        "phone": "length(d) BETWEEN 10 AND 15",
        "iban": "length(b) BETWEEN 15 AND 34 AND list_reduce(string_split(b[5:] || b[:4], ''), lambda a, x: CASE WHEN x <= '9' THEN (a * 10 + x::INT) % 97 ELSE (a * 100 + ascii(x) - 55) % 97 END, 0) = 1",
        "ssn": "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND d[:3] NOT IN ('000', '666') AND d < '9' AND d[4:5] <> '00' AND d[6:] <> '0000'",
        "secret": "length(d) >= 3 AND length(d) < length(m)",
    }
    parts = []
    for i, (kind, _, _, _, prior, near) in enumerate(KINDS):
        keep = "true" if kind in BASE else f"score >= {KEEP}"
        parts.append(f"""SELECT r, {i} AS k, '{kind}' AS kind, s, e, score FROM (
  SELECT *, least(1.0, {prior} + CASE WHEN regexp_matches(ctx, '{near}') THEN 0.2 WHEN regexp_matches(ctx, '{AGAINST}') THEN -0.2 ELSE 0.0 END)::DOUBLE AS score FROM (
    SELECT r, s, s + length(m) AS e, m, regexp_replace(m, '[^0-9]', '', 'g') AS d, replace(m, ' ', '') AS b, lower(right(g, {CONTEXT})) AS ctx FROM (
      SELECT r, ms[i] AS m, gs[i] AS g, (list_sum(list_transform(gs[:i], lambda z: length(z))) + coalesce(list_sum(list_transform(ms[:i - 1], lambda z: length(z))), 0))::BIGINT AS s FROM (
        SELECT r, t, ms, gs, unnest(generate_series(1, len(ms))) AS i FROM (SELECT r, t, regexp_extract_all(t, '{plain[kind]}') AS ms, string_split_regex(t, '{plain[kind]}') AS gs FROM d))))
  WHERE {check[kind]}) WHERE {keep}""")
    counts = ", ".join(f"(count(*) FILTER (WHERE kind = '{k}'))::BIGINT AS n_{k}" for k in BASE)
    span = "kind || ':' || s || ':' || e"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
x AS ({" UNION ALL ".join(parts)}),
g AS (SELECT r, {counts}, string_agg({span}, ',' ORDER BY s, k) FILTER (WHERE k < {len(BASE)}) AS base, string_agg({span}, ',' ORDER BY s, k) AS spans, string_agg(format('{{:.1f}}', score), ',' ORDER BY s, k) AS scores FROM x GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM d LEFT JOIN g USING (r)"""


ORACLE = _oracle()
