"""Column functions that keep raw text, tokens, white-space flags and spans of a layer consistent."""

from __future__ import annotations

import unicodedata
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values ----
#: Quotation marks that open or close in German print; the typewriter quote does both.
QUOTES_END = "«‘“‹‛‟\""
QUOTES_START = "»”›„‚⹂\""
#: Applied after compatibility composition: long s, vowels with a small e above, r rotunda.
LETTERS = {"ſ": "s", "aͤ": "ä", "oͤ": "ö", "uͤ": "ü", "ꝛ": "r"}
#: Abbreviations that keep their full stop.
ABBREVIATIONS = ("z.B.", "d.h.", "u.s.w.", "u.a.", "usw.", "etc.", "bzw.", "Dr.", "Prof.", "Hr.", "Hrn.", "Fr.", "St.", "Nr.", "Bd.", "Kap.")
#: What separates n-grams' tokens in a lexicon.
SEPARATOR = "▁"
# ---- end of fixed values ----

_ENDS, _STARTS = f"[{QUOTES_END}]", f"[{QUOTES_START}]"
#: Spacing of joined tokens, in this order: pattern and replacement.
DETOKENIZE = (
    (rf"(\S)\s({_ENDS})", "$1$2"),
    (rf"({_ENDS})\s([.,:)\]>}};%])", "$1$2"),
    (r"^\s+|\s+$", ""),
    (r" -- ", "--"),
    (r"([\[({<])\s", "$1"),
    (r"\s([\])}>])", "$1"),
    (r"([\])}>])\s([:;,.])", "$1$2"),
    (r"([^'])\s'\s", "$1' "),
    (r"\s([?!])", "$1"),
    (r"([^.])\s(\.)([\])}>\"']*)\s*$", "$1$2$3"),
    (r"([#$])\s", "$1"),
    (r"\s([;%])", "$1"),
    (r"\s\.\.\.\s", "..."),
    (r"\s([:,])", "$1"),
    (rf"([ (\[{{<])\s({_STARTS})", "$1$2"),
    (rf"({_STARTS})\s", "$1"),
    (r"^\s+|\s+$", ""),
)

_WORD = r"[\p{L}\p{M}\p{N}]"
#: A token: an abbreviation, a number, a word with inner hyphens or apostrophes and a trailing hyphen, dots, dashes, or
#: any one character that isn't white space.
TOKEN = "(?:" + "|".join([*(a.replace(".", r"\.") + r"(?!\p{L})" for a in ABBREVIATIONS), r"\p{N}+(?:[.,:/]\p{N}+)+", rf"{_WORD}+(?:[-'’]{_WORD}+)*-?", r"\.{2,}|…", "-{2,}", r"\S"]) + ")"


def tok2raw(tok: Column, ws: Column) -> Column:
    """Text of tokens: by their white-space flags, or guessed where there are none. Null without tokens."""
    joined = F.array_join(F.zip_with(ws, tok, lambda w, t: F.concat(F.when(w, F.lit(" ")).otherwise(F.lit("")), t)), "")
    return F.when(ws.isNull(), detokenize(tok)).otherwise(joined)


def detokenize(tok: Column) -> Column:
    """Text of tokens with the spacing that print has around punctuation and quotes."""
    out = F.concat(F.lit(" "), F.array_join(tok, " "), F.lit(" "))
    for pattern, new in DETOKENIZE:
        out = F.regexp_replace(out, pattern, new)
    return out


def raw2tok(raw: Column) -> Column:
    """struct(tok, ws) of a text: its tokens, and whether white space stands before each (not before the first)."""
    pieces = F.regexp_extract_all(raw, F.lit(rf"(?U)\s*{TOKEN}"), F.lit(0))
    tok = F.transform(pieces, lambda p: F.regexp_replace(p, r"(?U)^\s+", ""))
    ws = F.transform(pieces, lambda p, i: (i > 0) & p.rlike(r"(?U)^\s"))
    return F.struct(tok.alias("tok"), ws.alias("ws"))


def _lists(inner: pa.Array, sizes: list[int | None]) -> pa.Array:
    """A list for each size, of so many of the inner values; null for none."""
    ends = list(accumulate((n or 0 for n in sizes), initial=0))
    return pa.ListArray.from_arrays(pa.array([None if n is None else e for n, e in zip(sizes, ends, strict=False)] + [ends[-1]], pa.int32()), inner)


def _pairs(begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Lists of two numbers."""
    flat = np.stack([begin, end], 1).astype(np.int32).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 2, dtype=np.int32)), pa.array(flat))


_SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))


@F.arrow_udf(_SPANS)
def _summed(tok: pa.Array, ws: pa.Array) -> pa.Array:
    """Spans by prefix sums over a whole batch."""
    sizes = [None if x is None or y is None else x for x, y in zip(pc.list_value_length(tok).to_pylist(), pc.list_value_length(ws).to_pylist(), strict=True)]
    known = pa.array([n is not None for n in sizes])
    tok, ws = tok.filter(known), ws.filter(known)
    length = np.asarray(pc.fill_null(pc.utf8_length(tok.flatten()), 0), np.int64)
    space = np.asarray(pc.fill_null(ws.flatten(), False), bool)
    n = np.array([x for x in sizes if x is not None], np.int64)
    end = np.cumsum(length + space)
    before = np.concatenate([[0], end])[np.repeat(np.cumsum(n) - n, n)]
    return _lists(_pairs(end - length - before, end - before), sizes)


def spans_from_ws(tok: Column, ws: Column) -> Column:
    """[start, end) of each token in code points, from the flags, of which there is one a token. Null if either is."""
    return _summed(tok, ws)


@F.arrow_udf(T.StructType([T.StructField("spans", _SPANS), T.StructField("ws", T.ArrayType(T.BooleanType()))]))
def _read(tok: pa.Array, raw: pa.Array) -> pa.Array:
    begin, end, flags, sizes = [], [], [], []
    for ts, text in zip(tok.to_pylist(), raw.to_pylist(), strict=True):
        if ts is None or text is None:
            sizes.append(None)
            continue
        at, n, first = 0, len(text), len(begin)
        for t in ts:
            if at >= n:
                break
            space = text[at] == " "
            start = at + space
            at = start + len(t or "")
            begin.append(start)
            end.append(at)
            flags.append(space)
        sizes.append(len(begin) - first)
    spans = _pairs(np.array(begin, np.int64), np.array(end, np.int64))
    return pa.StructArray.from_arrays([_lists(spans, sizes), _lists(pa.array(flags, pa.bool_()), sizes)], ["spans", "ws"])


def spans_ws_from_raw(tok: Column, raw: Column) -> Column:
    """struct(spans, ws) of tokens in a text, reading it from left to right: only U+0020 counts as white space. Tokens that
    begin beyond the text's end get nothing. Both are null if either column is. Time is linear in the text."""
    return _read.asNondeterministic()(tok, raw)  # see the note on modifiers


def consistent(raw: Column, tok: Column, ws: Column) -> Column:
    """Whether flags and tokens give the text back."""
    return F.coalesce((F.size(tok) == F.size(ws)) & (raw == tok2raw(tok, ws)), F.lit(False))


def strip(s: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


@F.arrow_udf(T.StringType())
def _nfkc(s: pa.Array) -> pa.Array:
    return pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in s.to_pylist()], pa.string())


def transliterate(s: Column) -> Column:
    """Compatibility composition (NFKC, which Spark has no function for), then today's letters."""
    return _letters(_nfkc(s))


def transliterate_all(tok: Column) -> Column:
    """The same for every token of an array."""
    return F.transform(_nfkc_all(tok), _letters)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfkc_all(s: pa.Array) -> pa.Array:
    return pa.array([None if x is None else [None if t is None else unicodedata.normalize("NFKC", t) for t in x] for x in s.to_pylist()], pa.list_(pa.string()))


def _letters(s: Column) -> Column:
    for old, new in LETTERS.items():
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def basename(path: Column) -> Column:
    """The file's name up to its first full stop."""
    return F.split_part(F.element_at(F.split(path, "/"), -1), F.lit("."), F.lit(1))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def coarse_genre(genre: Column) -> Column:
    """Of Class::Subclass or Class:Subclass the class."""
    return F.regexp_replace(F.split(genre, "::")[0], ":.+$", "")


def language_label(label: Column) -> Column:
    """The code at the end of a label such as __label__de: its last two characters."""
    return F.right(label, F.lit(2))


def split_underscores(s: Column) -> Column:
    """At every underscore; pieces may be empty."""
    return F.split(s, "_")


def split_spaces_underscores(s: Column) -> Column:
    """At runs of underscores and white space."""
    return F.split(s, r"(?U)[_\s]+")


def vote_share(labels: list[Column], language: str = "de") -> Column:
    """The share of labels that name the language, to three places."""
    return F.round(sum((F.coalesce(x == language, F.lit(False)).cast("int") for x in labels), F.lit(0)) / float(len(labels)), 3)


def join_wrongly_split(tokens: list[str]) -> list[str]:
    """Put words together that a line break split: a capitalised token ending in a hyphen and a capitalised next one. The
    negation sign at a token's end is a hyphen; in what is put behind it stays as it is."""
    out: list[str] = []
    open_ = False
    for t in tokens:
        if open_ and t[:1].isupper():
            out[-1] += t
        else:
            out.append(t.replace("¬", "-"))
        open_ = out[-1].endswith("-") and out[-1][:1].isupper()
    return out
