"""Makers and modifiers by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from korpuswerk.functions import text as X
from korpuswerk.operators import metadata, models, modifiers
from korpuswerk.operators.modifiers import Modifier, Tokenizer
from korpuswerk.sources import mappings, readers


def _made(read: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str, str], DataFrame]:
    """Raw corpus and metadata to records; norm is tokenised by the tokenizer."""

    def make(spark: SparkSession, data: str, meta: str, tokenizer: Tokenizer = X.raw2tok) -> DataFrame:
        return modifiers.vanilla(metadata.join(read(spark, data), readers.read_metadata(spark, meta)), tokenizer)

    return make


MAKERS = {"dtaevalmaker": _made(readers.read_xml), "dtakmaker": _made(readers.read_tabs)}


def _lm(spark: SparkSession, layer: str = "norm", model: str = "char4", counts: DataFrame | None = None) -> Modifier:
    """Scores by a character model of the records themselves; their counts are gathered, up to a bound."""

    def apply(df: DataFrame) -> DataFrame:
        table = models.CharacterModel.count((counts if counts is not None else df), layer)
        sent = spark.sparkContext.broadcast(models.CharacterModel.gathered(table))
        return models.lm_score(lambda: models.CharacterModel(sent.value), model, layer)(df)

    return apply


MODIFIERS: dict[str, Callable[..., Modifier]] = {
    "replacetoken1to1modifier": lambda spark, mapping_files, layer="norm": modifiers.replace_1to1(mappings.token_to_token(mapping_files), layer),
    "replacetoken1tonmodifier": lambda spark, mapping_files, layer="norm": modifiers.replace_1ton(mappings.token_to_tokens(mapping_files), layer),
    "replacentomcrosslayermodifier": lambda spark, mapping_files, delimiter=None, source_layer="orig", target_layer="norm", transliterate_source=False: modifiers.replace_ntom(mappings.ngram_to_ngram(mapping_files, delimiter), source_layer, target_layer, transliterate_source),
    "replacerawmodifier": lambda spark, mapping_files, layer="norm", raw_label="norm": modifiers.replace_raw(mappings.corrections(spark, mapping_files, raw_label), layer),
    "languagetoolmodifier": lambda spark, rule_file: models.correct_by_rules(mappings.rules(rule_file)),
    "languagedetectionmodifier": lambda spark, layer="orig": models.detect_language(layer),
    "lmscoremodifier": _lm,
}


def maker(name: str) -> Callable[[SparkSession, str, str], DataFrame]:
    """ValueError for an unknown name."""
    if (found := MAKERS.get(name.lower())) is None:
        raise ValueError(f"no maker {name!r}; there are {', '.join(MAKERS)}")
    return found


def modifier(spark: SparkSession, name: str, **options: object) -> Modifier:
    """ValueError for an unknown name."""
    if (found := MODIFIERS.get(name.lower().replace("_", ""))) is None:
        raise ValueError(f"no modifier {name!r}; there are {', '.join(MODIFIERS)}")
    return found(spark, **options)
