"""Record modifiers: each takes a DataFrame of records and gives one back, with text, tokens, flags, spans and alignment
consistent again. Pairs of the alignment are always (orig, norm), whichever layer a modifier edits.

Python functions that give what later steps read are marked as not deterministic, so that the optimizer keeps their calls in
steps of their own. Merged with the steps after them it left some calls where they can't run.

Work that needs Python (aligning) is done for changed rows only: rows that stay are given empty lists to align, as Spark runs
a Python function on every row whatever a condition around it says.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpuswerk.functions import alignment as A
from korpuswerk.functions import text as X
from korpuswerk.schema import other, require

Modifier = Callable[[DataFrame], DataFrame]
#: From a text to struct(tok, ws): its tokens, and whether white space stands before each.
Tokenizer = Callable[[Column], Column]
#: Entries up to which a mapping becomes part of the expression: Spark looks a map's keys up one by one, Python by hash.
INLINE = 32


def _hits(tok: Column, mapping: dict[str, list[str]]) -> Column:
    """For each token what it is mapped to, or null."""
    if len(mapping) <= INLINE:
        m = F.create_map(*chain.from_iterable((F.lit(k), F.array(*map(F.lit, v))) for k, v in mapping.items()))
        return F.transform(tok, lambda t: m[t])

    @F.arrow_udf("array<array<string>>")
    def look(s: pa.Array) -> pa.Array:
        return pa.array([None if x is None else [mapping.get(t) for t in x] for x in s.to_pylist()], pa.list_(pa.list_(pa.string())))

    return look.asNondeterministic()(tok)


def _aligned(changed: Column, orig_tok: Column, norm_tok: Column, old: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(changed, A.align(F.when(changed, orig_tok).otherwise(none), F.when(changed, norm_tok).otherwise(none))).otherwise(old)


def _rebuilt(df: DataFrame, layer: str, raw: Column, tok: Column, realign: bool) -> DataFrame:
    """Put a layer's new text and tokens into the rows that _changed marks; flags and spans follow from them."""
    df = df.withColumns({"_raw": F.when(F.col("_changed"), raw), "_tok": F.when(F.col("_changed"), tok)})
    df = df.withColumn("_sw", X.spans_ws_from_raw(F.col("_tok"), F.col("_raw")))
    new = {layer: F.col("_raw"), f"{layer}_tok": F.col("_tok"), f"{layer}_ws": F.col("_sw.ws"), f"{layer}_spans": F.col("_sw.spans")}
    df = df.withColumns({c: F.when(F.col("_changed"), v).otherwise(F.col(c)) if c in df.columns else v for c, v in new.items()})
    if realign and "alignment" in df.columns:
        df = df.withColumn("alignment", _aligned(F.col("_changed"), F.col("orig_tok"), F.col("norm_tok"), F.col("alignment")))
    return df.drop("_raw", "_tok", "_sw", "_changed")


def vanilla(df: DataFrame, tokenizer: Tokenizer = X.raw2tok) -> DataFrame:
    """Fill in what makers leave out: both texts from their tokens, norm tokenised anew, the alignment, flags, spans."""
    require(df.columns, "orig_tok", "norm_tok")
    ws = lambda layer: F.col(f"{layer}_ws") if f"{layer}_ws" in df.columns else F.lit(None).cast("array<boolean>")
    df = df.withColumns({f"{x}": X.tok2raw(F.col(f"{x}_tok"), ws(x)) for x in ("orig", "norm")})
    df = df.withColumn("norm_tok", tokenizer(X.strip(F.col("norm")))["tok"])
    df = df.withColumn("alignment", A.align("orig_tok", "norm_tok"))
    for layer in ("orig", "norm"):
        df = df.withColumn("_sw", X.spans_ws_from_raw(F.col(f"{layer}_tok"), F.col(layer)))
        df = df.withColumns({f"{layer}_ws": F.col("_sw.ws"), f"{layer}_spans": F.col("_sw.spans")}).drop("_sw")
    return df


def replace_1to1(mapping: dict[str, str], layer: str = "norm") -> Modifier:
    """Exchange tokens; the text follows by the flags there are, the alignment stays. A row with any mapped token counts as
    changed, even by an entry that maps a token to itself."""
    other(layer)

    def apply(df: DataFrame) -> DataFrame:
        require(df.columns, f"{layer}_tok")
        if not mapping:
            return df
        ws = F.col(f"{layer}_ws") if f"{layer}_ws" in df.columns else F.lit(None).cast("array<boolean>")
        df = df.withColumn("_hits", _hits(F.col(f"{layer}_tok"), {k: [v] for k, v in mapping.items()}))
        df = df.withColumn("_changed", F.coalesce(F.exists("_hits", lambda h: h.isNotNull()), F.lit(False)))
        df = df.withColumn("_new", F.zip_with(f"{layer}_tok", "_hits", lambda t, h: F.coalesce(h[0], t))).drop("_hits")
        return _rebuilt(df, layer, X.tok2raw(F.col("_new"), ws), F.col("_new"), False).drop("_new")

    return apply


def replace_1ton(mapping: dict[str, list[str]], layer: str = "norm") -> Modifier:
    """Exchange a token for several; the first keeps the flag, the others follow white space. Changed rows are aligned."""
    other(layer)

    def apply(df: DataFrame) -> DataFrame:
        require(df.columns, f"{layer}_tok", f"{layer}_ws")
        if not mapping:
            return df
        ws = F.col(f"{layer}_ws")
        df = df.withColumn("_hits", _hits(F.col(f"{layer}_tok"), mapping))
        df = df.withColumn("_changed", F.coalesce(F.exists("_hits", lambda h: h.isNotNull()), F.lit(False)))
        df = df.withColumn("_pieces", F.zip_with(f"{layer}_tok", "_hits", lambda t, h: F.coalesce(h, F.array(t)))).drop("_hits")
        df = df.withColumns({"_new": F.flatten("_pieces"), "_nws": F.flatten(F.zip_with(ws, "_pieces", lambda w, p: F.transform(p, lambda t, i: F.when(i == 0, w).otherwise(F.lit(True)))))})
        return _rebuilt(df, layer, X.tok2raw(F.col("_new"), F.col("_nws")), F.col("_new"), True).drop("_new", "_nws", "_pieces")

    return apply


class NgramReplacer:
    """n-grams of source tokens that stand for m-grams of target tokens."""

    def __init__(self, mapping: dict[tuple[str, ...], tuple[str, ...]]):
        self.mapping, self.sizes = mapping, sorted({len(k) for k in mapping})

    def hits(self, tokens: list[str]) -> list[tuple[tuple[str, ...], tuple[int, ...]]]:
        """Every place of every mapped n-gram: by length, then first place of the n-gram, then place."""
        out = []
        for n in self.sizes:
            at: dict[tuple[str, ...], list[tuple[int, ...]]] = {}
            for i in range(len(tokens) - n + 1):
                if (g := tuple(tokens[i : i + n])) in self.mapping:
                    at.setdefault(g, []).append(tuple(range(i, i + n)))
            out += [(g, places) for g, found in at.items() for places in found]
        return out

    @staticmethod
    def across(places: tuple[int, ...], alignment: list) -> tuple[int, ...]:
        """The target indices of source places, sorted, without nulls."""
        return tuple(sorted({t for s, t in alignment if t is not None and s in places}))

    def replacements(self, tokens: list[str], alignment: list) -> tuple[dict[tuple[int, ...], tuple[str, ...]], bool]:
        """Target indices and what comes in their place; later ones win. And whether any n-gram was found at all."""
        hits = self.hits(tokens)
        found = {t: self.mapping[g] for g, places in hits if (t := self.across(places, alignment))}
        return found, bool(hits)

    @staticmethod
    def without_overlaps(found: dict[tuple[int, ...], tuple[str, ...]]) -> list[tuple[int, int, tuple[str, ...]]]:
        """(start, end, m-gram) from left to right; what begins within the last one kept is dropped."""
        out: list[tuple[int, int, tuple[str, ...]]] = []
        for t in sorted(found):
            if not out or t[0] > out[-1][1]:
                out.append((t[0], t[-1], found[t]))
        return out

    def apply(self, source: list[str], target: list[str], alignment: list) -> tuple[list[str], bool]:
        """The target tokens with m-grams put in, and whether any n-gram was found."""
        found, hit = self.replacements(source, alignment)
        out, at = [], 0
        for start, end, gram in self.without_overlaps(found):
            out += [*target[at:start], *gram]
            at = end + 1
        return out + target[at:], hit


def ngram_hits(mapping: dict[tuple[str, ...], tuple[str, ...]]) -> Callable[[Column | str], Column]:
    """A column function: for each list of tokens every place of every mapped n-gram, as structs of gram and places."""
    replacer = NgramReplacer(mapping)

    @F.arrow_udf("array<struct<gram: array<string>, places: array<int>>>")
    def find(tok: pa.Array) -> pa.Array:
        made = [None if t is None else [{"gram": g, "places": places} for g, places in replacer.hits(t)] for t in tok.to_pylist()]
        return pa.array(made, pa.list_(pa.struct([("gram", pa.list_(pa.string())), ("places", pa.list_(pa.int32()))])))

    return find


def replace_ntom(mapping: dict[tuple[str, ...], tuple[str, ...]], source_layer: str = "orig", target_layer: str = "norm", transliterate_source: bool = False) -> Modifier:
    """Find n-grams in one layer and put m-grams into the other, through the alignment. A row in which any n-gram is found
    is respaced by the detokeniser and aligned. Rows with lang_de = 0, if there is such a column, stay as they are."""
    if other(source_layer) != target_layer:
        raise ValueError("source and target are the two layers")
    replacer = NgramReplacer(mapping)

    @F.arrow_udf("struct<tok: array<string>, hit: boolean>")
    def edit(src: pa.Array, trg: pa.Array, alignment: pa.Array) -> pa.Array:
        rows = [(None, False) if s is None or t is None or a is None else replacer.apply(s, t, a) for s, t, a in zip(src.to_pylist(), trg.to_pylist(), alignment.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array([tok for tok, _ in rows], pa.list_(pa.string())), pa.array([hit for _, hit in rows], pa.bool_())], ["tok", "hit"])

    def apply(df: DataFrame) -> DataFrame:
        require(df.columns, f"{source_layer}_tok", f"{target_layer}_tok", "alignment")
        pairs = F.col("alignment") if source_layer == "orig" else A.swapped(F.col("alignment"))
        tok = F.col(f"{source_layer}_tok")
        df = df.withColumn("_e", edit.asNondeterministic()(X.transliterate_all(tok) if transliterate_source else tok, F.col(f"{target_layer}_tok"), pairs))
        german = F.coalesce(F.col("lang_de") != 0, F.lit(True)) if "lang_de" in df.columns else F.lit(True)
        df = df.withColumn("_changed", F.coalesce(F.col("_e.hit"), F.lit(False)) & german)
        return _rebuilt(df, target_layer, X.detokenize(F.col("_e.tok")), F.col("_e.tok"), True).drop("_e")

    return apply


def replace_raw(corrections: DataFrame, layer: str = "norm", uid: tuple[str, ...] = ("basename", "par_idx"), tokenizer: Tokenizer = X.raw2tok) -> Modifier:
    """Put corrected texts in the place of those with the same uid. corrections: uid columns, raw, and n, by which the last
    of several wins. Corrected rows are tokenised and aligned; Spark broadcasts the corrections if they are small."""
    other(layer)

    def apply(df: DataFrame) -> DataFrame:
        require(df.columns, layer, *uid)
        last = corrections.groupBy(*[F.col(c).alias(f"_{c}") for c in uid]).agg(F.max_by("raw", "n").alias("_c"))
        on = [df[c] == F.col(f"_{c}").cast(df.schema[c].dataType) for c in uid]
        df = df.join(last, on, "left").drop(*[f"_{c}" for c in uid]).withColumn("_changed", F.col("_c").isNotNull())
        return _rebuilt(df, layer, F.col("_c"), tokenizer(X.strip(F.col("_c")))["tok"], True).drop("_c")

    return apply


def retextualise(new_raw: Column, layer: str = "norm", tokenizer: Tokenizer = X.raw2tok) -> Modifier:
    """Put what a column expression gives in the place of the text, where it differs; tokenise and align those rows."""

    def apply(df: DataFrame) -> DataFrame:
        df = df.withColumn("_n", new_raw).withColumn("_changed", F.coalesce(F.col("_n") != F.col(layer), F.lit(False)))
        return _rebuilt(df, layer, F.col("_n"), tokenizer(X.strip(F.col("_n")))["tok"], True).drop("_n")

    return apply
