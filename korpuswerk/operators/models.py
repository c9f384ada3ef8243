"""Modifiers that rest on models: rule-based correction, language detection, language-model scores. Each takes its model as
a parameter; the defaults work offline. They keep the columns' contract, not the numbers of any other model."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from korpuswerk.functions import text as X
from korpuswerk.operators.modifiers import Modifier, Tokenizer, retextualise
from korpuswerk.schema import other, require

# ---- fixed values ----
#: Rules by id: pattern and replacement.
RULES = {
    "ZUVIEL": (r"\b([Zz])uviel\b", "$1u viel"),
    "ZUWENIG": (r"\b([Zz])uwenig\b", "$1u wenig"),
    "OLD_SPELLING": (r"\b([Dd]a|[Mm]u|[Ww]u|[Kk]ü|[Nn]u)ß(te|ten|test)?\b", "$1ss$2"),
    "BESSERN_VS_BESSEREN": (r"\b([Bb])essern (?=\p{Lu})", "$1esseren "),
    "DOUBLE_SPACE": (r"(?<=\S)  +(?=\S)", " "),
    "SPACE_BEFORE_COMMA": (r" +,", ","),
    "SPACE_AFTER_COMMA": (r",(?=\p{L})", ", "),
    "DOUBLE_COMMA": (r",(?:\s*,)+", ","),
    "GARNICHT": (r"\b([Gg])arnicht(s?)\b", "$1ar nicht$2"),
    "GARKEIN": (r"\b([Gg])arkein(e[mnrs]?)?\b", "$1ar kein$2"),
    "VORALLEM": (r"\b([Vv])orallem\b", "$1or allem"),
    "AUFEINMAL": (r"\b([Aa])ufeinmal\b", "$1uf einmal"),
    "WIEVIEL": (r"\b([Ww])ieviel(e[nr]?)?\b", "$1ie viel$2"),
    "DESWEITEREN": (r"\b([Dd])esweiteren\b", "$1es Weiteren"),
    "STANDART": (r"\bStandart(?=s?\b|isier)", "Standard"),
    "WIEDERSPIEGELN": (r"\b([Ww])iederspieg(?=el|l)", "$1iderspieg"),
    "REPEATED_ARTICLE": (r"\b(der|die|das|dem|den|des|ein|eine) \1\b", "$1"),
}
#: Function words by language.
COMMON_WORDS = {
    "de": "der die das und ist nicht ein eine ich er sie es mit von zu auf den dem des im in war wie auch als sich so".split(),
    "en": "the of and to in is that was for it with as on his at by be this from".split(),
    "fr": "le la les de des et en un une est que dans qui pas pour sur au".split(),
    "es": "el la los las de y en un una es que por con no se para del".split(),
}
#: Letters and endings that speak for a language.
LETTER_SIGNS = {"de": "[äöüß]|sch|cht\\b|ung\\b|keit\\b", "en": "th|wh|ing\\b|tion\\b|\\bth", "fr": "[çèêàû]|eux\\b|oi|que\\b", "es": "[ñáíóú¿¡]|ción\\b|mente\\b|os\\b"}
# ---- end of fixed values ----
#: What profiles see as one blank.
NO_LETTERS = r"[\x00-@\[-`{-\xbf]+"


def correct_by_rules(rules: set[str], layer: str = "norm", tokenizer: Tokenizer = X.raw2tok) -> Modifier:
    """Apply the enabled rules of RULES in their order; unknown ids are ignored, as a checker without them would. Changed
    texts are tokenised and aligned."""

    def apply(df: DataFrame) -> DataFrame:
        require(df.columns, layer)
        out = F.col(layer)
        for name, (pattern, new) in RULES.items():
            if name in rules:
                out = F.regexp_replace(out, f"(?U){pattern}", new)
        return retextualise(out, layer, tokenizer)(df)

    return apply


def correct(corrector: Callable[[], Callable[[str], str]], layer: str = "norm", tokenizer: Tokenizer = X.raw2tok) -> Modifier:
    """The same with any corrector: a function without arguments makes it, once in each Python worker."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fix = corrector()
        for s in batches:
            yield s.map(lambda x: None if x is None else fix(x))

    return lambda df: retextualise(run(layer), layer, tokenizer)(df)


def _most(votes: dict[str, Column]) -> Column:
    """The language with most votes, the first of equal ones; null without a vote."""
    best = F.greatest(*votes.values())
    return F.when(best > 0, F.coalesce(*[F.when(v == best, F.lit(k)) for k, v in votes.items()]))


def _common(tok: Column, language: str) -> Column:
    """How many of the tokens are function words of the language."""
    return F.size(F.filter(tok, lambda t: t.isin(COMMON_WORDS[language])))


def by_words(text: Column) -> Column:
    """By how many function words of each language there are."""
    tok = F.split(F.lower(text), r"(?U)[^\p{L}]+")
    return _most({k: _common(tok, k) for k in COMMON_WORDS})


def by_letters(text: Column) -> Column:
    """By letters and endings."""
    return _most({k: F.regexp_count(F.lower(text), F.lit(f"(?U){p}")) for k, p in LETTER_SIGNS.items()})


def by_share(text: Column) -> Column:
    """By the share of function words, counted only from a tenth on."""
    tok = F.split(F.lower(text), r"(?U)[^\p{L}]+")
    return _most({k: F.when(_common(tok, k) * 10 >= F.size(tok), _common(tok, k)).otherwise(0) for k in COMMON_WORDS})


#: Column and detector: a function of the text that gives a label.
DETECTORS = {"lang_fastText": by_words, "lang_py3langid": by_letters, "lang_cld3": by_share}


def detect_language(layer: str = "orig", detectors: dict[str, Callable[[Column], Column]] | None = None) -> Modifier:
    """A column of labels for each of three detectors, and lang_de: the share of them that say German."""
    if layer not in ("orig", "norm"):
        raise NotImplementedError(f"no language detection for {layer!r}")
    chosen = detectors or DETECTORS

    def apply(df: DataFrame) -> DataFrame:
        require(df.columns, layer)
        df = df.withColumns({c: d(F.col(layer)) for c, d in chosen.items()})
        return df.withColumn("lang_de", X.vote_share([F.col(c) for c in chosen]))

    return apply


class LanguageProfiles:
    """Character trigrams of languages, learned from labelled texts: a text is of the language that makes it likeliest, the
    first by name of equally likely ones; texts without letters have none."""

    #: Trigrams that the driver gathers at most.
    MOST = 5_000_000

    def __init__(self, counts: dict[tuple[str, str], int]):
        self.languages = sorted({lang for lang, _ in counts})
        grams = {g for _, g in counts}
        totals = {lang: sum(n for (k, _), n in counts.items() if k == lang) + len(grams) + 1 for lang in self.languages}
        self.unknown = [-math.log(totals[lang]) for lang in self.languages]
        self.logs = {g: [math.log((counts.get((lang, g), 0) + 1) / totals[lang]) for lang in self.languages] for g in grams}

    @staticmethod
    def count(texts: DataFrame, text: str, lang: str) -> DataFrame:
        """(lang, gram, n) of labelled texts, counted with map-side sums."""
        plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), NO_LETTERS, " "), F.lit(" "))
        # a column of single characters first, as a lambda works its text out anew for each place
        chars = texts.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.split(plain, "").alias("c")).where(F.size("c") > 2)
        grams = F.transform(F.sequence(F.lit(1), F.size("c") - 2), lambda i: F.concat(F.get("c", i - 1), F.get("c", i), F.get("c", i + 1)))
        return chars.select("lang", F.explode(grams).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))

    @classmethod
    def gathered(cls, counted: DataFrame) -> LanguageProfiles:
        """From count()'s rows; ValueError over MOST."""
        rows = counted.limit(cls.MOST + 1).collect()
        if len(rows) > cls.MOST:
            raise ValueError(f"over {cls.MOST} trigrams")
        return cls({(r.lang, r.gram): r.n for r in rows})

    def __call__(self, text: str | None) -> str | None:
        plain = " " + re.sub(NO_LETTERS, " ", text.lower()) + " " if text else ""
        if not plain.strip() or not self.languages:
            return None
        sums = [sum(x) for x in zip(*(self.logs.get(plain[i : i + 3], self.unknown) for i in range(len(plain) - 2)), strict=True)]
        return self.languages[max(range(len(sums)), key=lambda k: (sums[k], -k))]

    def detector(self, spark: SparkSession) -> Callable[[Column], Column]:
        """A detector for detect_language()."""
        sent = spark.sparkContext.broadcast(self)

        @F.pandas_udf("string")
        def detect(s: pd.Series) -> pd.Series:
            return s.map(sent.value)

        return detect


class _Costs(dict):
    """What the last character of an n-gram costs, worked out once for each n-gram."""

    def __init__(self, cost: Callable[[str], float], most: int):
        super().__init__()
        self.cost, self.most = cost, most

    def __missing__(self, gram: str) -> float:
        if len(self) >= self.most:
            self.clear()
        out = self[gram] = self.cost(gram)
        return out


class CharacterModel:
    """An interpolated character n-gram model: mean negative log-likelihood of all of a text's characters."""

    #: n-grams that the driver gathers and a worker remembers at most.
    MOST = 5_000_000

    def __init__(self, counts: dict[str, int], order: int = 4):
        self.order = order
        self.counts, self.contexts = counts, {}
        for gram, n in counts.items():
            self.contexts[gram[:-1]] = self.contexts.get(gram[:-1], 0) + n
        self.alphabet = len({g for g in counts if len(g) == 1}) + 1
        self.costs = _Costs(self._cost, self.MOST)

    @staticmethod
    def count(texts: DataFrame, column: str, order: int = 4) -> DataFrame:
        """(gram, n): n-grams of all lengths up to order, counted with map-side sums."""
        padded = F.concat(F.lit("\u0002" * (order - 1)), F.col(column), F.lit("\u0003"))
        grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(order)), lambda n: F.transform(F.sequence(F.lit(order), F.length(padded)), lambda e: F.substring(padded, (e - n + 1).cast("int"), n.cast("int")))))
        return texts.where(F.col(column).isNotNull()).select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))

    @classmethod
    def gathered(cls, counted: DataFrame) -> dict[str, int]:
        """count()'s rows as a dictionary for a broadcast. A script's letters make some 100,000 n-grams; ValueError over MOST."""
        rows = counted.limit(cls.MOST + 1).collect()
        if len(rows) > cls.MOST:
            raise ValueError(f"over {cls.MOST} n-grams")
        return {r.gram: r.n for r in rows}

    def _cost(self, gram: str) -> float:
        p = 1 / self.alphabet
        for n in range(1, self.order + 1):
            part = gram[self.order - n :]
            p = (self.counts.get(part, 0) + 2 * p) / (self.contexts.get(part[:-1], 0) + 2)
        return -math.log(p)

    def __call__(self, text: str) -> float:
        s, o, costs = "\u0002" * (self.order - 1) + text + "\u0003", self.order, self.costs
        return sum(costs[s[i : i + o]] for i in range(len(s) - o + 1)) / max(1, len(s) - o + 1)


def lm_score(model: Callable[[], Callable[[str], float]], name: str, layer: str = "norm") -> Modifier:
    """A column {layer}_{name} with what the model gives a text: lower is likelier. A function without arguments makes the
    model, once in each Python worker."""
    other(layer)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model()
        for s in batches:
            yield s.map(lambda x: None if x is None else float(score(x)))

    return lambda df: df.withColumn(f"{layer}_{name}", run(layer))
