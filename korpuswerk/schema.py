"""The sentence record: its columns and how they belong to the two layers, orig and norm."""

from __future__ import annotations

from pyspark.sql import types as T

LAYERS = ("orig", "norm")
_TEXT, _TOKENS, _FLAGS, _PAIRS = T.StringType(), T.ArrayType(T.StringType()), T.ArrayType(T.BooleanType()), T.ArrayType(T.ArrayType(T.IntegerType()))

#: A record without the optional columns. (basename, par_idx) is its key.
RECORD = T.StructType(
    [T.StructField("basename", _TEXT), T.StructField("par_idx", T.LongType()), T.StructField("date", T.IntegerType())]
    + [T.StructField(c, _TEXT) for c in ("genre", "author", "title")]
    + [T.StructField(f"{layer}{part}", kind) for layer in LAYERS for part, kind in (("", _TEXT), ("_tok", _TOKENS), ("_ws", _FLAGS), ("_spans", _PAIRS))]
    + [T.StructField("alignment", _PAIRS)]
)
#: Columns that only some makers or modifiers add.
OPTIONAL = T.StructType(
    [T.StructField(c, _TOKENS) for c in ("orig_xlit", "orig_lemma", "orig_pos", "norm_lemma", "norm_pos", "orig_class")]
    + [T.StructField("is_bad", T.BooleanType())]
    + [T.StructField(c, _TEXT) for c in ("lang_fastText", "lang_py3langid", "lang_cld3")]
    + [T.StructField("lang_de", T.DoubleType())]
)


def other(layer: str) -> str:
    """The layer that is aligned with this one; ValueError if there is no such layer."""
    if layer not in LAYERS:
        raise ValueError(f"a layer is one of {LAYERS}, not {layer!r}")
    return "orig" if layer == "norm" else "norm"


def require(columns: list[str], *names: str) -> None:
    """ValueError naming the columns that are missing."""
    if missing := [n for n in names if n not in columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
