"""Line dedup across all documents, with DataFrame functions only: a deletion-neighbourhood join over words.

A line of MIN_WORDS words or more is dropped if an earlier line (by document key, then place) is within one word edit of it:
equal but for white space, or with one word inserted, deleted or exchanged. With five words and more, one edit leaves a
similarity of at least 0.8. Shorter lines are never touched.

1. Equal lines are found by 128-bit hashes, aggregated on the map side.
2. Lines within one edit agree on all words before or all words after the middle of the longer one. Only lines that share
   such a half with a different line go on; the filter loses none.
3. Each of these emits a hashed key for every variant with one word deleted. Equal keys of lines of one length and place
   are exchanges; a whole line equal to a longer line's variant is a deletion. A key's lines only meet as a minimum, their
   earliest, never as pairs.
4. The edit distance to that earliest line is verified on the words.

A variant's hash is the exclusive or of its words' hashes with their places in it, so that all of a line's variants follow
from one running sum: a line of n words costs a few times n. Variants are made only where a line shares a half. Tables that meet all lines are
broadcast up to SMALL rows, counted beforehand, and shuffled beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import discard, materialize

MIN_WORDS = 5
#: Rows up to which a counted table is broadcast: at most some 20 MB.
SMALL = 400_000
#: Words of a line up to which a running sum is made in one go.
BLOCK = 256


def _sized(table: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has at most SMALL rows."""
    return F.broadcast(table) if table.count() <= SMALL else table


def _plain(line: Column) -> Column:
    """The line's words with one space between them."""
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r") | line.contains("\x0b") | line.contains("\f")
    return F.trim(F.when(odd, F.regexp_replace(line, "[ \\t\\x0B\\f\\r]+", " ")).otherwise(line))


def _spaces(text: str) -> Column:
    """How many spaces there are; a space is one byte."""
    return F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit(" "), F.lit("")))


def lines(docs: DataFrame, key: str, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(k, th, ln, w, n, h1, h2): the long enough lines of docs; k and th (a hash of the text) name the document."""
    split = docs.select(docs[key].alias("k"), F.xxhash64(docs[text]).alias("th"), F.posexplode(F.split(docs[text], "\n")).alias("ln", "line"))
    # the generator of one row keeps the condition above what it reads: pushed down, it would make words and count once more
    plain = split.select("k", "th", "ln", _plain(F.col("line")).alias("w")).select("k", "th", "ln", F.inline(F.array(F.struct("w", _spaces("w").alias("spaces")))))
    counted = plain.select("k", "th", "ln", "w", (F.col("spaces") + 1).alias("n")).where(F.col("spaces") >= min_words - 1)
    return counted.withColumn("h1", F.xxhash64("w")).withColumn("h2", F.xxhash64(F.lit(1), "w"))


def _order() -> Column:
    """By which the earliest is found: null keys come last."""
    return F.struct(F.col("k").isNull().alias("z"), "k", "th", "ln")


def _halved(every: DataFrame) -> DataFrame:
    """every with halves: keys of the words before and after the middle, as the longer and as the shorter line of a pair.

    The middle is sought once, as the halves of n words and of n + 1 differ in one word at most: with n even the latter half
    begins one word earlier, with n odd the first half ends one word later. Rests are cut as bytes.
    """
    cut = every.withColumn("a", F.expr("substring_index(w, ' ', n DIV 2)"))
    cut = cut.withColumn("b", F.expr("substring(CAST(w AS BINARY), if(n = 1, 1, octet_length(a) + 2))")).withColumn("even", F.expr("n % 2 = 0"))
    one = "if(even, octet_length(substring_index(a, ' ', -1)), octet_length(substring_index(CAST(b AS STRING), ' ', 1)))"
    cut = cut.withColumn("one", F.expr(one)).withColumn("ha", F.expr("xxhash64('before', a)")).withColumn("hb", F.expr("xxhash64('after', b)"))
    cut = cut.withColumn("hc", F.expr("if(even, xxhash64('after', substring(CAST(w AS BINARY), octet_length(a) - one + 1)), xxhash64('before', substring(CAST(w AS BINARY), 1, octet_length(a) + 1 + one)))"))
    made = "array(xxhash64(n, ha), xxhash64(n, hb), xxhash64(n + 1, if(even, ha, hc)), xxhash64(n + 1, if(even, hc, hb)))"
    return cut.select(*every.columns, F.expr(made).alias("halves"))


_XOR = "(u, x) -> u ^ x"


def _running(numbers: str) -> str:
    """SQL for the exclusive or of all numbers before each one, in blocks and then over blocks, as a list that grows by one
    is copied each time."""
    before = lambda rows, x: f"aggregate({rows}, named_struct('u', 0L, 'a', CAST(array() AS ARRAY<BIGINT>)), (acc, x) -> named_struct('u', acc.u ^ {x}, 'a', array_append(acc.a, acc.u))).a"
    blocks = f"transform(sequence(0, (size(ns) - 1) DIV {BLOCK}), i -> slice(ns, i * {BLOCK} + 1, {BLOCK}))"
    made = f"flatten(flatten(transform(array({blocks}), bs -> zip_with(bs, {before('bs', f'aggregate(x, 0L, {_XOR})')}, (b, o) -> transform({before('b', 'x')}, y -> y ^ o)))))"
    return f"flatten(transform(array({numbers}), ns -> if(size(ns) <= {BLOCK}, {before('ns', 'x')}, {made})))"


def _near(found: DataFrame) -> DataFrame:
    """Of distinct lines (first, n, w): pairs (a, b) of a line's first place and an earlier one's within an edit."""
    # here: each word with its place; left: with its place one further left, as behind a deleted word
    hashed = found.select("first", "n", F.split("w", " ").alias("ws")).select("first", "n", F.expr("transform(ws, (x, i) -> xxhash64(x, i))").alias("here"), F.expr("transform(ws, (x, i) -> xxhash64(x, i - 1))").alias("left"))
    hashed = hashed.select("first", "n", F.expr(f"aggregate(here, 0L, {_XOR})").alias("whole"), "left", F.expr(f"aggregate(left, 0L, {_XOR})").alias("all"), F.expr(_running("zip_with(here, left, (x, y) -> x ^ y)")).alias("before"))
    variants = hashed.select("first", "n", F.explode(F.expr("zip_with(sequence(0, n - 1), zip_with(left, before, (x, y) -> all ^ x ^ y), (p, r) -> struct(p, r))")).alias("v")).select("first", "n", "v.p", "v.r")
    variants = materialize(variants, "variants")
    wholes = hashed.select(F.col("first").alias("s"), (F.col("n") + 1).alias("n"), F.col("whole").alias("r"))
    exchanged = variants.groupBy("r", "n", "p").agg(F.min("first").alias("m"), F.max("first").alias("last")).where("m < last").drop("last")
    pairs = variants.join(exchanged, ["r", "n", "p"]).where("m < first").select(F.col("first").alias("a"), F.col("m").alias("b"))
    longest = variants.groupBy("r", "n").agg(F.min("first").alias("m"))
    pairs = pairs.union(wholes.join(longest, ["r", "n"]).where("m < s").select("s", "m"))
    least = wholes.groupBy("r", "n").agg(F.min("s").alias("s"))
    pairs = pairs.union(variants.join(least, ["r", "n"]).where("s < first").select("first", "s")).distinct()
    mine, theirs = found.select(F.col("first").alias("a"), F.split("w", " ").alias("wa")), found.select(F.col("first").alias("b"), F.split("w", " ").alias("wb"))
    both = pairs.join(mine, "a").join(theirs, "b").select("a", "b", F.expr("if(size(wa) >= size(wb), wa, wb)").alias("l"), F.expr("if(size(wa) >= size(wb), wb, wa)").alias("s"))
    at = both.withColumn("i", F.expr("array_position(zip_with(slice(l, 1, size(s)), s, (x, y) -> x <> y), true)"))
    same_tail = "slice(l, CAST(i AS INT) + 1, size(l)) = slice(s, CAST(i AS INT) + if(size(l) = size(s), 1, 0), size(l))"
    return at.where(F.expr(f"size(l) - size(s) <= 1 AND if(i = 0, true, {same_tail})")).select("a", "b")


def dropped(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(k, th, drop): of each document that loses lines, their places from 0, unordered.

    Null and empty texts have no lines. Rows that repeat both key and text are one document, and lose the same lines.
    """
    every = lines(docs, key, text, min_words)
    slim = materialize(_halved(every).select("k", "th", "ln", "n", "h1", "h2", "halves"), "lines")
    shared = slim.select("h1", F.explode("halves").alias("half")).groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo != hi").select("half")
    shared = materialize(shared, "halves")
    ids = materialize(slim.select("h1", F.explode("halves").alias("half")).join(_sized(shared), "half", "left_semi").select("h1").distinct(), "sharing")
    found = every.join(_sized(ids), "h1", "left_semi").groupBy("h1", "h2", "n").agg(F.min(_order()).alias("first"), F.min("w").alias("w"))
    found = materialize(found, "candidates")
    near = _near(found.select("first", "n", "w")).select(F.col("a").alias("first")).distinct()
    near = found.select("h1", "h2", "first").join(near, "first", "left_semi").select("h1", "h2", "first", F.lit(True).alias("near"))
    # a plain count finds the few lines that repeat; only for these is the earliest place worked out
    repeated = materialize(slim.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2"), "repeated")
    firsts = slim.join(_sized(repeated), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min(_order()).alias("first"))
    classes = firsts.select("h1", "h2", "first", F.lit(False).alias("near")).union(near).groupBy("h1", "h2").agg(F.min("first").alias("first"), F.max("near").alias("near"))
    classes = materialize(classes, "classes")
    places = slim.select("h1", "h2", "k", "th", "ln").join(_sized(classes), ["h1", "h2"]).where(F.col("near") | (_order() != F.col("first")))
    out = materialize(places.groupBy("k", "th").agg(F.collect_set("ln").alias("drop")), "drops")
    for t in (slim, shared, ids, found, repeated, classes):
        discard(t)
    return out


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, mark: str | None = None) -> DataFrame:
    """docs with duplicate lines taken out of text; all rows and columns stay. n_chars, if there is one, follows the text.

    mark names a column to add with the places of dropped lines, in order (null if none). A null text stays null; a text
    all of whose lines are dropped becomes empty.
    """
    drops = dropped(docs, key, text, min_words)
    # a row goes along as one column, so that no name of docs can clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("d"), docs[key].alias("mine"), docs[text].alias("t"), F.xxhash64(docs[text]).alias("hash"))
    joined = rows.join(drops, rows["mine"].eqNullSafe(drops["k"]) & (rows["hash"] == drops["th"]), "left")
    kept = F.expr("array_join(filter(split(t, '\\n'), (x, i) -> NOT array_contains(drop, i)), '\\n')")
    out = joined.select("d", F.array_sort("drop").alias("places"), F.when(F.col("drop").isNull(), F.col("t")).otherwise(kept).alias("t"))
    new = {text: F.col("t")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("places").isNull(), F.col("d")["n_chars"]).otherwise(F.length("t").cast(docs.schema["n_chars"].dataType))
    return out.select(*[new.get(c, F.col("d")[c]).alias(c) for c in docs.columns], *([F.col("places").alias(mark)] if mark else []))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_dropped, dropped (places, comma-joined) and text_sha256 of what stays, for each row of docs."""
    done = dedup(docs.select(key, text), key, text, mark="_places")
    places = F.coalesce("_places", F.array().cast("array<int>"))
    return done.select(key, F.size(places).cast("bigint").alias("n_dropped"), F.array_join(F.transform(places, lambda x: x.cast("string")), ",").alias("dropped"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("text_sha256"))


ORACLE = """
WITH l AS (
  SELECT doc_id, ln - 1 AS ln, line, string_split(trim(regexp_replace(line, '[ \\t\\x0B\\f\\r]+', ' ', 'g'), ' '), ' ') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents)),
c AS (SELECT w, len(w) AS n, min((doc_id, ln)) AS first FROM l WHERE len(w) >= 5 GROUP BY w),
v AS (SELECT first, n, p, list_concat(w[:p], w[p + 2:]) AS r FROM (SELECT *, unnest(generate_series(0, n - 1)) AS p FROM c)),
near AS (
  SELECT first FROM v JOIN (SELECT n, p, r, min(first) AS m FROM v GROUP BY n, p, r) USING (n, p, r) WHERE m < first
  UNION SELECT c.first FROM c JOIN (SELECT r, min(first) AS m FROM v GROUP BY r) ON r = w WHERE m < c.first
  UNION SELECT v.first FROM v JOIN c ON r = w WHERE c.first < v.first),
drops AS (SELECT doc_id, l.ln FROM l JOIN c USING (w) WHERE (doc_id, l.ln) <> first OR first IN (SELECT first FROM near)),
d AS (SELECT doc_id, count(*) AS n, string_agg(ln, ',' ORDER BY ln) AS dropped FROM drops GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY ln) AS text FROM l ANTI JOIN drops USING (doc_id, ln) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_dropped, coalesce(dropped, '') AS dropped, sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents LEFT JOIN d USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
