"""Registered queries: the library's operators over the driver's tables. Arrays are given as joined strings."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from korpuswerk.functions import alignment as A
from korpuswerk.functions import text as X
from korpuswerk.operators import checks, lexicon, metadata, models, modifiers, split
from korpuswerk.plans import corpus as C
from korpuswerk.sources import mappings, readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def joined(tok: Column, sep: str = "|") -> Column:
    return F.array_join(tok, sep)


def flat_pairs(pairs: Column) -> Column:
    """[[0,1],[2,null]] as 0-1,2-_."""
    part = lambda x: F.coalesce(x.cast("string"), F.lit("_"))
    return F.array_join(F.transform(pairs, lambda p: F.concat(part(p[0]), F.lit("-"), part(p[1]))), ",")


def _flags(ws: Column) -> Column:
    return F.array_join(F.transform(ws, lambda w: w.cast("int").cast("string")), "")


# ---- lexicons ----

_COUNTED = "SELECT orig, norm, count(*)::BIGINT AS freq, count(DISTINCT basename)::BIGINT AS docs FROM p {where} GROUP BY orig, norm"


@query(f"WITH {C.RECORDS.format(sep='▁')} {_COUNTED.format(where='WHERE length(orig) > 0 AND length(norm) > 0')}")
def lexicon_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.build(C.records(spark, sf_dir))


@query(f"WITH {C.RECORDS.format(sep='_')} {_COUNTED.format(where='')}")
def lexicon_keep_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.build(C.records(spark, sf_dir), keep_none=True, sep="_")


@query(f"WITH {C.RECORDS.format(sep='▁')} SELECT orig, norm, freq FROM ({_COUNTED.format(where='WHERE length(orig) > 0 AND length(norm) > 0')}) ORDER BY orig, norm LIMIT 100")
def lexicon_sorted_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.build(C.records(spark, sf_dir)).orderBy("orig", "norm").limit(100).select("orig", "norm", "freq")


@query(f"WITH {C.SENTENCES}, t AS (SELECT basename, unnest(tok) AS w FROM s) SELECT CASE WHEN w = 'the' THEN 'sä' ELSE w END AS orig, w AS norm, count(*)::BIGINT AS freq, count(DISTINCT basename)::BIGINT AS docs FROM t WHERE w <> '' GROUP BY ALL")
def lexicon_translit(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.expr("transform(orig_tok, t -> if(t = 'the', 'ſaͤ', t))")
    df = C.sentences(spark, sf_dir).withColumns({"norm_tok": F.col("orig_tok"), "alignment": F.expr("transform(orig_tok, (t, i) -> array(i, i))"), "orig_tok": old})
    return lexicon.build(df, transliterate=True)


# ---- texts, tokens, spans ----


@query(f"WITH {C.SENTENCES} SELECT basename, par_idx, orig AS raw, len(tok)::BIGINT AS n_tok FROM s")
def tok2raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.sentences(spark, sf_dir)
    ws = F.transform("orig_tok", lambda t, i: i > 0)
    return df.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), X.tok2raw(F.col("orig_tok"), ws).alias("raw"), F.size("orig_tok").cast("bigint").alias("n_tok"))


_SPANS = f"""WITH {C.SENTENCES}, t AS (SELECT basename, par_idx, unnest(tok) AS w, generate_subscripts(tok, 1) AS i FROM s),
e AS (SELECT *, sum(length(w) + CASE WHEN i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY basename, par_idx ORDER BY i) AS b FROM t)
SELECT basename, par_idx, string_agg((b - length(w))::BIGINT || '-' || b::BIGINT, ',' ORDER BY i) AS spans FROM e GROUP BY basename, par_idx"""


@query(_SPANS)
def spans_from_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.sentences(spark, sf_dir)
    ws = F.transform("orig_tok", lambda t, i: i > 0)
    return df.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), flat_pairs(X.spans_from_ws(F.col("orig_tok"), ws)).alias("spans"))


@query(_SPANS.replace("AS spans FROM", "AS spans, string_agg(CASE WHEN i > 1 THEN '1' ELSE '0' END, '' ORDER BY i) AS ws FROM"))
def spans_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.sentences(spark, sf_dir).withColumn("x", X.spans_ws_from_raw(F.col("orig_tok"), F.col("orig")))
    return df.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), flat_pairs(F.col("x.spans")).alias("spans"), _flags(F.col("x.ws")).alias("ws"))


def _detokenized(expr: str) -> str:
    for pattern, new in X.DETOKENIZE:
        old, to = pattern.replace("'", "''"), new.replace("$", "\\").replace("'", "''")
        expr = f"regexp_replace({expr}, '{old}', '{to}', 'g')"
    return expr


_PADDED = "regexp_replace(orig, '([.,;:!?()])', ' \\1 ', 'g')"


@query(f"WITH {C.SENTENCES} SELECT basename, par_idx, {_detokenized(f"' ' || {_PADDED} || ' '")} AS raw FROM s")
def detokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.regexp_replace("orig", r"([.,;:!?()])", " $1 ")
    return C.sentences(spark, sf_dir).select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), X.detokenize(F.split(padded, " ")).alias("raw"))


_ROOM = "\\t-\\r\\x{85}\\p{Z}"
_WORD_SQL = "[\\p{L}\\p{M}\\p{N}]"
#: The tokens of column x with the white space before each. SQL's patterns can't look ahead: an abbreviation before a letter
#: is broken up by a control character, which is taken out again.
_CUT = (
    f"list_filter(regexp_extract_all(regexp_replace({{x}}, '({'|'.join(a[:-1].replace('.', chr(92) + '.') for a in X.ABBREVIATIONS)})[.](\\p{{{{L}}}})', '\\1\x01.\\2', 'g'), '[{_ROOM}]*(?:".replace("{85}", "{{85}}").replace("{Z}", "{{Z}}")
    + "|".join([*(a.replace(".", "\\.") for a in X.ABBREVIATIONS), "\\p{{N}}+(?:[.,:/]\\p{{N}}+)+", f"{_WORD_SQL}+(?:[-''’]{_WORD_SQL}+)*-?".replace("{", "{{").replace("}", "}}"), "\\.{{2,}}", "…", "-{{2,}}", f"[^{_ROOM}]".replace("{85}", "{{85}}").replace("{Z}", "{{Z}}")])
    + ")'), lambda z: z <> '\x01')"
)
_TRIM = f"regexp_replace({{x}}, '^[{_ROOM}]+', '')".replace("{85}", "{{85}}").replace("{Z}", "{{Z}}")
#: Spans and flags of the tokens `tok` in the text `raw`, read from left to right.
_READ = """list_reduce(tok, lambda a, t: CASE WHEN a.at >= length(raw) THEN a ELSE struct_pack(
    at := a.at + (substring(raw, a.at + 1, 1) = ' ')::BIGINT + length(t),
    spans := list_append(a.spans, (a.at + (substring(raw, a.at + 1, 1) = ' ')::BIGINT) || '-' || (a.at + (substring(raw, a.at + 1, 1) = ' ')::BIGINT + length(t))),
    ws := a.ws || (substring(raw, a.at + 1, 1) = ' ')::INT::VARCHAR) END, struct_pack(at := 0::BIGINT, spans := []::VARCHAR[], ws := ''))"""


@query(
    f"""WITH {C.SENTENCES}, c AS (SELECT basename, par_idx, {_CUT.format(x="orig")} AS p FROM s)
SELECT basename, par_idx, array_to_string(list_transform(p, lambda z: {_TRIM.format(x="z")}), '|') AS tok,
  array_to_string(list_transform(p, lambda z, i: CASE WHEN i > 1 AND z <> {_TRIM.format(x="z")} THEN '1' ELSE '0' END), '') AS ws FROM c"""
)
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.sentences(spark, sf_dir).withColumn("x", X.raw2tok(F.col("orig")))
    return df.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), joined(F.col("x.tok")).alias("tok"), _flags(F.col("x.ws")).alias("ws"))


@query(f"WITH {C.SENTENCES} SELECT count(*)::BIGINT AS n, 0::BIGINT AS broken FROM s")
def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose tokens, flags and spans, by the tokeniser, don't fit their text: none."""
    df = C.sentences(spark, sf_dir).withColumn("t", X.raw2tok(F.col("orig"))).withColumn("orig_tok", F.col("t.tok"))
    df = df.withColumn("x", X.spans_ws_from_raw(F.col("orig_tok"), F.col("orig"))).withColumns({"orig_ws": F.col("x.ws"), "orig_spans": F.col("x.spans")})
    return df.agg(F.count("*").alias("n"), F.count(F.when(F.size(checks.faults("orig")) > 0, 1)).alias("broken"))


# ---- modifiers ----


def _edited(df: DataFrame) -> DataFrame:
    return df.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), F.col("norm"), joined(F.col("norm_tok")).alias("tok"), _flags(F.col("norm_ws")).alias("ws"), flat_pairs(F.col("norm_spans")).alias("spans"))


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = F.expr("transform(orig_tok, (t, i) -> i > 0)")
    df = C.sentences(spark, sf_dir).withColumns({"norm": F.col("orig"), "norm_tok": F.col("orig_tok"), "norm_ws": ws})
    return df.withColumn("norm_spans", X.spans_from_ws(F.col("norm_tok"), F.col("norm_ws")))


def _edited_sql(cases: str) -> str:
    return f"""WITH {C.SENTENCES}, t AS (SELECT basename, par_idx, unnest(tok) AS w, generate_subscripts(tok, 1) AS i FROM s),
u AS (SELECT basename, par_idx, i, unnest({cases}) AS w, generate_subscripts({cases}, 1) AS k FROM t),
e AS (SELECT *, CASE WHEN i > 1 OR k > 1 THEN 1 ELSE 0 END AS ws FROM u),
f AS (SELECT *, sum(length(w) + ws) OVER (PARTITION BY basename, par_idx ORDER BY i, k) AS b FROM e)
SELECT basename, par_idx, string_agg(CASE WHEN ws = 1 THEN ' ' ELSE '' END || w, '' ORDER BY i, k) AS norm, string_agg(w, '|' ORDER BY i, k) AS tok,
  string_agg(ws::VARCHAR, '' ORDER BY i, k) AS ws, string_agg((b - length(w))::BIGINT || '-' || b::BIGINT, ',' ORDER BY i, k) AS spans FROM f GROUP BY basename, par_idx"""


@query(_edited_sql("[CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.ONE_TO_ONE.items()) + " ELSE w END]"))
def replace_1to1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edited(modifiers.replace_1to1(C.ONE_TO_ONE)(_plain(spark, sf_dir)))


_MANY = "CASE w " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.ONE_TO_MANY.items()) + " ELSE [w] END"


@query(_edited_sql(_MANY))
def replace_1ton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edited(modifiers.replace_1ton(C.ONE_TO_MANY)(_plain(spark, sf_dir)))


@query(
    f"""WITH {C.SENTENCES}, t AS (SELECT basename, par_idx, i, len({_MANY}) AS n FROM (SELECT basename, par_idx, unnest(tok) AS w, generate_subscripts(tok, 1) AS i FROM s)),
e AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY basename, par_idx ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM t)
SELECT basename, par_idx, string_agg(array_to_string(list_transform(generate_series(0, n - 1), lambda k: (i - 1) || '-' || (b + k)), ','), ',' ORDER BY i) AS alignment FROM e GROUP BY basename, par_idx"""
)
def replace_1ton_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _plain(spark, sf_dir).withColumn("alignment", F.expr("transform(orig_tok, (t, i) -> array(i, i))"))
    return modifiers.replace_1ton(C.ONE_TO_MANY)(df).select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), flat_pairs(F.col("alignment")).alias("alignment"))


_SIZES = sorted({len(k) for k in C.MANY_TO_MANY})


@query(
    f"""WITH {C.SENTENCES}, t AS (SELECT basename, par_idx, unnest(tok) AS w, generate_subscripts(tok, 1) - 1 AS i FROM s),
n AS ({" UNION ALL ".join(f"SELECT basename, par_idx, i, {n}::BIGINT AS n, " + " || ' ' || ".join(["w", *[f"lead(w, {k}) OVER (PARTITION BY basename, par_idx ORDER BY i)" for k in range(1, n)]]) + " AS gram FROM t" for n in _SIZES)})
SELECT basename, par_idx, i::BIGINT AS at, n, gram FROM n WHERE gram IN ({", ".join("'" + " ".join(k) + "'" for k in C.MANY_TO_MANY)})"""
)
def ntom_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every n-gram of the mapping."""
    found = F.explode(modifiers.ngram_hits(C.MANY_TO_MANY)("orig_tok")).alias("x")
    df = C.sentences(spark, sf_dir).select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), found)
    return df.select("basename", "par_idx", F.col("x.places")[0].cast("bigint").alias("at"), F.size("x.places").cast("bigint").alias("n"), F.array_join("x.gram", " ").alias("gram"))


def _spliced() -> str:
    """The tokens around and in the n-grams of the mapping, where none is mapped by two: in place of one that begins at a
    token come its m-gram's. Of two that begin at a token the shorter counts, and one that begins within another doesn't."""
    gram = lambda k: " AND ".join(f"{'w' if not j else f'lead(w, {j}) OVER o'} = '{x}'" for j, x in enumerate(k))
    keys = sorted(C.MANY_TO_MANY, key=len)
    return f"""m AS (SELECT *, CASE {" ".join(f"WHEN {gram(k)} THEN {len(k)}" for k in keys)} END AS n, CASE {" ".join(f"WHEN {gram(k)} THEN {list(C.MANY_TO_MANY[k])}" for k in keys)} END AS new FROM t WINDOW o AS (PARTITION BY basename, par_idx ORDER BY i)),
hit AS (SELECT basename, par_idx, list_reduce(list({{'i': i, 'n': n}} ORDER BY i), lambda a, x: CASE WHEN x.i > a.last THEN struct_pack(last := x.i + x.n - 1, kept := list_append(a.kept, x.i)) ELSE a END, struct_pack(last := -1::BIGINT, kept := []::BIGINT[])).kept AS kept FROM m WHERE n IS NOT NULL GROUP BY basename, par_idx),
k AS (SELECT m.*, hit.kept IS NOT NULL AS changed, coalesce(list_contains(hit.kept, i), false) AS starts FROM m LEFT JOIN hit USING (basename, par_idx)),
c AS (SELECT *, max(CASE WHEN starts THEN i + n - 1 END) OVER (PARTITION BY basename, par_idx ORDER BY i) AS until FROM k),
u AS (SELECT basename, par_idx, changed, flatten(list(CASE WHEN starts THEN new WHEN until >= i THEN []::VARCHAR[] ELSE [w] END ORDER BY i)) AS tok FROM c GROUP BY basename, par_idx, changed)"""


@query(
    f"""WITH {C.SENTENCES}, t AS (SELECT basename, par_idx, unnest(tok) AS w, generate_subscripts(tok, 1) - 1 AS i FROM s), {_spliced()},
r AS (SELECT u.basename, u.par_idx, u.tok, CASE WHEN changed THEN {_detokenized("' ' || array_to_string(u.tok, ' ') || ' '")} ELSE orig END AS raw FROM u JOIN s USING (basename, par_idx)),
x AS (SELECT *, {_READ} AS x FROM r)
SELECT basename, par_idx, raw AS norm, array_to_string(tok, '|') AS tok, x.ws AS ws, array_to_string(x.spans, ',') AS spans FROM x"""
)
def ntom_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _plain(spark, sf_dir).withColumn("alignment", F.expr("transform(orig_tok, (t, i) -> array(i, i))"))
    return _edited(modifiers.replace_ntom(C.MANY_TO_MANY)(df))


@query(f"WITH {C.SENTENCES} SELECT basename, par_idx, CASE WHEN par_idx = 1 AND lang = 'de' THEN 'Neu: ' || upper(lang) || '.' ELSE orig END AS norm, par_idx = 1 AND lang = 'de' AS corrected FROM s")
def raw_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = C.sentences(spark, sf_dir).where("par_idx = 1 AND lang = 'de'")
    fixed = fixed.select("basename", "par_idx", F.explode(F.array(F.struct(F.lit(0).alias("n"), F.lit("old").alias("raw")), F.struct(F.lit(1).alias("n"), F.lit("Neu: DE.").alias("raw")))).alias("x")).select("basename", "par_idx", "x.*")
    done = modifiers.replace_raw(fixed)(_plain(spark, sf_dir))
    return done.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), "norm", ((F.col("par_idx") == 1) & (F.col("lang") == "de") & (joined(F.col("norm_tok")) == "Neu|:|DE|.")).alias("corrected"))


@query(
    f"""WITH {C.SENTENCES}, t AS (SELECT basename, par_idx, unnest(tok) AS w, generate_subscripts(tok, 1) - 1 AS i, len(tok) AS n FROM s),
g AS (SELECT *, i - (i % 7 = 4)::INT AS e FROM t), f AS (SELECT *, (bool_or(w <> '') OVER (PARTITION BY basename, par_idx, e)) AND i = e AS filled FROM g),
k AS (SELECT *, sum(filled::INT) OVER (PARTITION BY basename, par_idx ORDER BY i) - 1 AS j FROM f)
SELECT basename, par_idx, string_agg(i || '-' || CASE WHEN w = '' THEN '_' ELSE j::BIGINT::VARCHAR END, ',' ORDER BY i) AS alignment FROM k GROUP BY basename, par_idx"""
)
def align(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = F.expr("filter(transform(orig_tok, (t, i) -> if(i + 1 < size(orig_tok) AND i % 7 = 3, concat(t, orig_tok[i + 1]), if(i % 7 = 4 AND i > 0, '', t))), t -> t != '')")
    return C.sentences(spark, sf_dir).select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), flat_pairs(A.align(F.col("orig_tok"), merged)).alias("alignment"))


@query(
    f"""WITH {C.SENTENCES}, r AS (SELECT basename, par_idx, {_detokenized("' ' || orig || ' '")} AS raw FROM s),
c AS (SELECT *, list_transform({_CUT.format(x=_TRIM.format(x="raw"))}, lambda z: {_TRIM.format(x="z")}) AS tok FROM r),
x AS (SELECT *, {_READ} AS x FROM c)
SELECT basename, par_idx, raw AS norm, array_to_string(tok, '|') AS tok, x.ws AS ws, array_to_string(x.spans, ',') AS spans FROM x"""
)
def vanilla(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.sentences(spark, sf_dir).select("basename", "par_idx", "orig_tok", F.col("orig_tok").alias("norm_tok"))
    return _edited(modifiers.vanilla(df))


# ---- models ----


def _votes_sql(words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(regexp_split_to_array(lower(orig), '[^\\p{{L}}]+'), lambda t: t IN ({listed})))"


_BEST = "CASE " + " ".join(f"WHEN {k} > 0 AND {k} = greatest({', '.join(models.COMMON_WORDS)}) THEN '{k}'" for k in models.COMMON_WORDS) + " END"


@query(f"WITH {C.SENTENCES}, v AS (SELECT basename, par_idx, {', '.join(f'{_votes_sql(w)} AS {k}' for k, w in models.COMMON_WORDS.items())} FROM s) SELECT basename, par_idx, {_BEST} AS label, ({_BEST}) IS NOT DISTINCT FROM 'de' AS german FROM v")
def lang_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.sentences(spark, sf_dir).withColumn("label", models.by_words(F.col("orig")))
    return df.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), "label", F.coalesce(F.col("label") == "de", F.lit(False)).alias("german"))


#: Signs of words' beginnings and ends are put into the text, as SQL's word boundaries know ASCII only.
_MARKED = "regexp_replace(lower(orig), '([\\p{L}\\p{M}\\p{Nd}\\p{Pc}]+)', '\x02\\1\x03', 'g')"


def _lettered(pattern: str) -> str:
    """A pattern's word boundaries as the signs: before a letter the beginning's, else the end's."""
    return re.sub(r"\\b(\w)?", lambda m: f"\x02{m[1]}" if m[1] else "\x03", pattern)


def _label(votes: str) -> str:
    """The language with most votes of the list of columns, the first of equal ones."""
    names = [f"{votes}_{k}" for k in models.COMMON_WORDS]
    return "CASE " + " ".join(f"WHEN {n} > 0 AND {n} = greatest({', '.join(names)}) THEN '{k}'" for n, k in zip(names, models.COMMON_WORDS, strict=True)) + " END"


_COLUMNS = ", ".join([*(f"{_votes_sql(w)} AS w_{k}" for k, w in models.COMMON_WORDS.items()), *(f"len(regexp_extract_all({_MARKED}, '{_lettered(p)}')) AS l_{k}" for k, p in models.LETTER_SIGNS.items())])
_SHARES = ", ".join(f"CASE WHEN w_{k} * 10 >= n THEN w_{k} ELSE 0 END AS s_{k}" for k in models.COMMON_WORDS)


@query(
    f"""WITH {C.SENTENCES}, v AS (SELECT basename, par_idx, len(regexp_split_to_array(lower(orig), '[^\\p{{L}}]+')) AS n, {_COLUMNS} FROM s),
x AS (SELECT *, {_SHARES} FROM v), y AS (SELECT basename, par_idx, {_label("w")} AS a, {_label("l")} AS b, {_label("s")} AS c FROM x)
SELECT basename, par_idx, a AS "lang_fastText", b AS lang_py3langid, c AS lang_cld3, round((coalesce(a = 'de', false)::INT + coalesce(b = 'de', false)::INT + coalesce(c = 'de', false)::INT) / 3.0::DOUBLE, 3) AS lang_de FROM y"""
)
def lang_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.detect_language()(C.sentences(spark, sf_dir)).select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), *models.DETECTORS, "lang_de")


_PLAIN = "' ' || regexp_replace(lower(orig), '[\\x00-@\\[-`{-\\x{bf}]+', ' ', 'g') || ' '"


@query(
    f"""WITH {C.SENTENCES}, z AS (SELECT row_number() OVER () AS id, basename, par_idx, lang, {_PLAIN} AS z FROM s),
p AS (SELECT id, lang, substring(z, i, 3) AS gram FROM (SELECT *, unnest(generate_series(1, length(z) - 2)) AS i FROM z)),
v AS (SELECT count(DISTINCT gram) AS v FROM p), t AS (SELECT lang, count(*) + v + 1 AS total FROM p, v GROUP BY lang, v),
g AS (SELECT lang, gram, count(*) AS n FROM p GROUP BY lang, gram),
l AS (SELECT t.lang, q.gram, ln((coalesce(n, 0) + 1) / total) AS x FROM t CROSS JOIN (SELECT DISTINCT gram FROM p) q LEFT JOIN g ON g.lang = t.lang AND g.gram = q.gram),
b AS (SELECT id, lang, sum(x) AS x FROM (SELECT id, p.gram, l.lang, x FROM p JOIN l USING (gram)) GROUP BY id, lang),
m AS (SELECT id, arg_max(lang, x) AS label FROM b GROUP BY id)
SELECT basename, par_idx, CASE WHEN trim(z) <> '' THEN label END AS label FROM z LEFT JOIN m USING (id)"""
)
def lang_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences' languages by profiles of the documents' labelled languages."""
    df = C.sentences(spark, sf_dir)
    detect = models.LanguageProfiles.gathered(models.LanguageProfiles.count(df, "orig", "lang")).detector(spark)
    return df.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), detect("orig").alias("label"))


_ORDER = 4
_GRAMS = ", ".join(f"coalesce(g{n}.c, 0) AS c{n}, coalesce(x{n}.c, 0) AS d{n}" for n in range(1, _ORDER + 1))
_JOINS = " ".join(f"LEFT JOIN g g{n} ON g{n}.gram = right(q.gram, {n}) LEFT JOIN x x{n} ON x{n}.gram = left(right(q.gram, {n}), {n - 1}) AND x{n}.n = {n}" for n in range(1, _ORDER + 1))


def _likelihood(n: int = _ORDER) -> str:
    return f"(c{n} + 2 * {_likelihood(n - 1)}) / (d{n} + 2)" if n else "(1 / (SELECT count(*) + 1 FROM g WHERE length(gram) = 1))"


@query(
    f"""WITH {C.SENTENCES}, z AS (SELECT basename, par_idx, lang, repeat(chr(2), {_ORDER - 1}) || orig || chr(3) AS z FROM s),
p AS (SELECT basename, par_idx, lang, substring(z, i, {_ORDER}) AS gram FROM (SELECT *, unnest(generate_series(1, length(z) - {_ORDER - 1})) AS i FROM z)),
g AS (SELECT right(gram, n) AS gram, count(*) AS c FROM p, (SELECT unnest(generate_series(1, {_ORDER})) AS n) WHERE lang = 'de' GROUP BY 1),
x AS (SELECT left(gram, length(gram) - 1) AS gram, length(gram) AS n, sum(c) AS c FROM g GROUP BY 1, 2),
c AS (SELECT q.gram, {_GRAMS} FROM (SELECT DISTINCT gram FROM p) q {_JOINS}),
l AS (SELECT gram, -ln({_likelihood()}) AS nll FROM c)
SELECT basename, par_idx, round(avg(nll), 6) AS nll FROM p JOIN l USING (gram) GROUP BY basename, par_idx"""
)
def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts by a character model of all German sentences. Its distinct n-grams of up to 4 are gathered, up to a bound."""
    df = C.sentences(spark, sf_dir)
    seen = df.where("lang = 'de'")
    sent = spark.sparkContext.broadcast(models.CharacterModel.gathered(models.CharacterModel.count(seen, "orig")))
    return models.lm_score(lambda: models.CharacterModel(sent.value), "char4", "orig")(df).select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), F.round("orig_char4", 6).alias("nll"))


@query(f"WITH {C.SENTENCES}, z AS (SELECT basename, par_idx, 'Das ist zuviel , ' || orig AS x FROM s) SELECT basename, par_idx, regexp_replace(regexp_replace(x, '\\bzuviel\\b', 'zu viel', 'g'), ' +,', ',', 'g') AS norm FROM z")
def grammar_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.sentences(spark, sf_dir).withColumn("norm", F.concat(F.lit("Das ist zuviel , "), F.col("orig")))
    done = models.correct_by_rules({"ZUVIEL", "SPACE_BEFORE_COMMA", "NO_SUCH_RULE"})(df.drop("orig_tok"))
    return done.select("basename", F.col("par_idx").cast("bigint").alias("par_idx"), "norm")


# ---- metadata and splits ----


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def metadata_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = C.table(spark, sf_dir, "nation"), C.table(spark, sf_dir, "region")
    meta = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(F.col("n_nationkey").cast("string").alias("basename"), F.col("n_name").alias("title"), F.col("r_name").alias("genre"))
    rows = C.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("basename"))
    return metadata.join(rows, meta).select("c_custkey", F.col("title").alias("n_name"), F.col("genre").alias("r_name"))


@query("SELECT 'doc' || doc_id AS basename FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def metadata_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("doc"), "doc_id").alias("basename")
    return metadata.missing(C.table(spark, sf_dir, "documents").select(name), C.table(spark, sf_dir, "labels").select(name))


@query("SELECT basename, min_by(v, n) AS author, 1700::INTEGER AS date FROM (SELECT (o_orderkey % 97)::VARCHAR AS basename, o_orderkey AS n, o_orderpriority AS v FROM orders) GROUP BY basename")
def metadata_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = C.table(spark, sf_dir, "orders")
    line = F.to_json(F.struct(F.lit("1700").alias("date_"), F.lit("1700").alias("firstDate"), (F.col("o_orderkey") % 97).cast("string").alias("basename"), F.col("o_orderpriority").alias("author")))
    return readers.metadata_from_lines(o.select(F.col("o_orderkey").alias("n"), line.alias("value"))).select("basename", "author", "date")


def _orders_as_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: their year, priority and customer as date, genre and author."""
    return C.table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("basename"), F.lit(0).alias("par_idx"), F.year("o_orderdate").alias("date"), F.concat("o_orderpriority", F.lit("::x")).alias("genre"), F.concat(F.lit("c"), "o_custkey").alias("author"))


_DOCS = "d AS (SELECT 'o' || o_orderkey AS basename, year(o_orderdate) AS date, o_orderpriority AS genre, 'c' || o_custkey AS author FROM orders)"


@query(f"WITH {_DOCS} SELECT (date // 10 * 10)::INTEGER AS decade, genre, count(*)::BIGINT AS n_docs FROM d GROUP BY 1, 2")
def genre_decade_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.groups(split.documents(_orders_as_documents(spark, sf_dir)))


@query(f"WITH {_DOCS} SELECT author, count(DISTINCT (date // 10 * 10, genre))::BIGINT AS works FROM d GROUP BY author")
def author_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.author_counts(split.documents(_orders_as_documents(spark, sf_dir))).select("author", "works")


@query(f"WITH {_DOCS} SELECT basename, date::INTEGER AS date, genre FROM d WHERE date BETWEEN 1993 AND 1995")
def year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.documents(_orders_as_documents(spark, sf_dir), 1993, 1995).select("basename", "date", "genre")


@query(f"WITH {_DOCS} SELECT count(*)::BIGINT AS docs, count(DISTINCT author)::BIGINT AS authors, 0::BIGINT AS in_several, ceil(0.2 * count(DISTINCT author))::BIGINT AS held_out FROM d")
def author_split_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split.split(split.documents(_orders_as_documents(spark, sf_dir)))
    by = parts.groupBy("author").agg(F.count("*").alias("n"), F.count_distinct("split").alias("k"), F.min("split").alias("s"))
    return by.agg(F.sum("n").alias("docs"), F.count("*").alias("authors"), F.count(F.when(F.col("k") > 1, 1)).alias("in_several"), F.count(F.when(F.col("s") != "train", 1)).alias("held_out"))


def _permuted(name: str, of: str) -> str:
    """SQL queries up to `name`, which gives p: the seeded permutation of the numbers below n of the one-row query `of`.

    It is the Mersenne twister's, seeded with 42: blocks of 624 numbers, tempered, masked to the size of what is left and
    passed over where they are too great, as numpy's RandomState does it.
    """
    # fixed values: the generator's constants
    def twisted(a: str, b: str, c: str) -> str:
        return f"xor(xor({c}, (({a} & 2147483648) | ({b} & 2147483647)) >> 1), CASE WHEN {b} & 1 = 1 THEN 2567483615::UBIGINT ELSE 0::UBIGINT END)"

    return f"""{name}_m AS (
  SELECT 0 AS k, list_reduce(generate_series(1, 623), lambda a, i: list_append(a, (1812433253::UBIGINT * xor(a[i], a[i] >> 30) + i::UBIGINT) & 4294967295), [42::UBIGINT]) AS mt
  UNION ALL SELECT k + 1, list_concat(list_concat(p1, p2), p3) FROM (
    SELECT *, list_transform(generate_series(455, 624), lambda i: {twisted("mt[i]", "CASE WHEN i < 624 THEN mt[i + 1] ELSE p1[1] END", "p2[i - 454]")}) AS p3 FROM (
      SELECT *, list_transform(generate_series(228, 454), lambda i: {twisted("mt[i]", "mt[i + 1]", "p1[i - 227]")}) AS p2 FROM (
        SELECT k, mt, list_transform(generate_series(1, 227), lambda i: {twisted("mt[i]", "mt[i + 1]", "mt[i + 397]")}) AS p1 FROM {name}_m WHERE k < 3 + (SELECT n FROM {of}) // 300)))),
{name}_a AS (SELECT k, i, mt[i] AS a FROM {name}_m, (SELECT unnest(generate_series(1, 624)) AS i) WHERE k > 0),
{name}_b AS (SELECT k, i, xor(a, a >> 11) AS b FROM {name}_a),
{name}_c AS (SELECT k, i, xor(b, (b << 7) & 2636928640) AS c FROM {name}_b),
{name}_d AS (SELECT k, i, xor(c, (c << 15) & 4022730752) AS d FROM {name}_c),
{name}_w AS (SELECT list(xor(d, d >> 18) ORDER BY k, i) AS w FROM {name}_d),
{name} AS (
  SELECT list_reduce(w, lambda s, v: CASE WHEN s.i < 1 OR (v & s.mask) > s.i THEN s ELSE struct_pack(
      i := s.i - 1, mask := CASE WHEN s.i - 1 <= s.mask >> 1 THEN s.mask >> 1 ELSE s.mask END,
      p := list_transform(s.p, lambda x, j: CASE WHEN j = s.i + 1 THEN s.p[(v & s.mask)::BIGINT + 1] WHEN j = (v & s.mask) + 1 THEN s.p[s.i::BIGINT + 1] ELSE x END)) END,
    struct_pack(i := n::UBIGINT - 1, mask := (1::UBIGINT << length(bin(n - 1))) - 1, p := generate_series(0, n - 1))).p AS p FROM {name}_w, {of})"""


@query(
    f"""WITH RECURSIVE {_DOCS}, o AS (SELECT basename, date // 10 * 10 AS decade, genre, author FROM d),
g AS (SELECT decade, genre, min(basename) AS first FROM o GROUP BY decade, genre),
u AS (SELECT author, count(*) AS works, min((first, author)) AS first FROM (SELECT DISTINCT decade, genre, author FROM o) JOIN g USING (decade, genre) GROUP BY author),
a AS (SELECT author, row_number() OVER (ORDER BY works, first) - 1 AS r FROM u),
n1 AS (SELECT count(*) AS n, ceil(0.2::DOUBLE * count(*))::BIGINT AS held FROM a), n2 AS (SELECT held AS n, ceil(0.5::DOUBLE * held)::BIGINT AS test FROM n1),
{_permuted("p1", "n1")},
{_permuted("p2", "n2")},
x AS (SELECT unnest(p) AS r, generate_subscripts(p, 1) - 1 AS place FROM p1), y AS (SELECT unnest(p) AS place, generate_subscripts(p, 1) - 1 AS place2 FROM p2),
z AS (SELECT r, CASE WHEN place2 IS NULL THEN 'train' WHEN place2 < test THEN 'test' ELSE 'validation' END AS split FROM n2, x LEFT JOIN y USING (place))
SELECT basename, split FROM d JOIN a USING (author) JOIN z USING (r)"""
)
def author_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split(split.documents(_orders_as_documents(spark, sf_dir))).select("basename", "split")


# ---- sources ----


def _tab_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token tables: a line a sentence; every document's last sentence lacks its blank line."""
    head = "".join(f"%%$DDC:index[{i}]={long} {short}\n" for i, (long, short) in enumerate([("Token", "w"), ("Utf8", "u"), ("CanonicalToken", "v"), ("Pos", "p"), ("Lemma", "l"), ("WordSep", "ws")]))
    row = "concat_ws('\\t', lower(t), t, concat(t, '_x'), if(t RLIKE '[.,]', '$.', 'N'), 'l', '1')"
    body = f"array_join(transform(split(text, '\\n'), s -> array_join(transform(split(s, ' '), t -> {row}), '\\n')), '\\n\\n')"
    return C.spread(C.table(spark, sf_dir, "documents")).select(F.concat(F.lit("/data/doc"), "doc_id", F.lit(".TEI.tabs")).alias("path"), F.concat(F.lit(head), F.expr(body), F.lit("\n")).alias("value"))


_XML_WORDS = r"[\p{L}-]+"


def _xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as evaluation XML: every line a sentence, every other one marked bad; words of over three letters have a
    normal form of two."""
    word = "concat('<w old=\"', w, '\" new=\"', w, if(length(w) > 3, '_x', ''), '\" class=\"LEX\"/>')"
    line = f"concat('<s', if(i % 2 = 1, ' sbad=\"1\"', ''), '>', array_join(transform(regexp_extract_all(l, '{_XML_WORDS.replace(chr(92), chr(92) * 2)}', 0), w -> {word}), ''), '</s>')"
    body = f"concat('<doc><body>', array_join(transform(split(text, '\\n'), (l, i) -> {line}), ''), '</body></doc>')"
    return C.spread(C.table(spark, sf_dir, "documents")).select(F.concat(F.lit("/x/doc"), "doc_id", F.lit(".xml")).alias("path"), F.expr(body).alias("value"))


@query(
    f"""WITH s AS (SELECT 'doc' || doc_id AS basename, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS par_idx FROM documents),
t AS (SELECT basename, par_idx, regexp_extract_all(l, '{_XML_WORDS}') AS w FROM s)
SELECT basename, par_idx::BIGINT AS par_idx, par_idx % 2 = 1 AS is_bad, array_to_string(w, '|') AS orig,
  array_to_string(list_transform(w, lambda x: CASE WHEN length(x) <= 3 THEN x WHEN x LIKE '%-' THEN x || '|x-' ELSE x || '|x' END), '|') AS norm,
  array_to_string(list_transform(w, lambda x: 'LEX'), '|') AS classes FROM t"""
)
def xml_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.xml_records(_xml_files(spark, sf_dir))
    return df.select("basename", "par_idx", "is_bad", joined(F.col("orig_tok")).alias("orig"), joined(F.col("norm_tok")).alias("norm"), joined(F.col("orig_class")).alias("classes"))


_TABBED = "s AS (SELECT 'doc' || doc_id AS basename, text, unnest(string_split(text, chr(10))[:-2]) AS x, generate_subscripts(string_split(text, chr(10))[:-2], 1) - 1 AS par_idx FROM documents), t AS (SELECT basename, par_idx, unnest(string_split(x, ' ')) AS w, generate_subscripts(string_split(x, ' '), 1) AS i FROM s)"


@query(f"WITH {_TABBED} SELECT basename, par_idx::BIGINT AS par_idx, count(*)::BIGINT AS n_orig, string_agg(w, '|' ORDER BY i) AS orig, string_agg(lower(w), '|' ORDER BY i) AS xlit, string_agg(CASE WHEN regexp_matches(w, '[.,]') THEN w ELSE w || '|x' END, '|' ORDER BY i) AS norm, string_agg(CASE WHEN i > 1 THEN '1' ELSE '0' END, '' ORDER BY i) AS ws FROM t GROUP BY 1, 2")
def tabs_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.tab_records(_tab_files(spark, sf_dir))
    return df.select("basename", "par_idx", F.size("orig_tok").cast("bigint").alias("n_orig"), joined(F.col("orig_tok")).alias("orig"), joined(F.col("orig_xlit")).alias("xlit"), joined(F.col("norm_tok")).alias("norm"), _flags(F.col("orig_ws")).alias("ws"))


@query("SELECT doc_id, regexp_extract('/a/b/doc' || doc_id || '.x.y', '([^/.]*)[.][^/]*$', 1) AS basename, (n_chars // 10 * 10)::INTEGER AS decade, source AS genre, right('__label__' || lang, 2) AS label FROM documents")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.table(spark, sf_dir, "documents")
    return d.select("doc_id", X.basename(F.concat(F.lit("/a/b/doc"), "doc_id", F.lit(".x.y"))).alias("basename"), X.decade(F.col("n_chars")).alias("decade"), X.coarse_genre(F.concat("source", F.lit(":sub::x"))).alias("genre"), X.language_label(F.concat(F.lit("__label__"), "lang")).alias("label"))


@query("SELECT l_partkey % 50 AS key, max_by(l_suppkey, l_orderkey * 10 + l_linenumber) AS value FROM lineitem GROUP BY 1")
def mapping_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 50).alias("key"), F.col("l_suppkey").alias("value"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n"))
    return mappings.keyed(rows)
