import time

import pytest
from pyspark.sql import functions as F

from korpuswerk.functions import text as X
from korpuswerk.operators import checks, models, modifiers, split
from korpuswerk.operators.modifiers import NgramReplacer
from korpuswerk.schema import RECORD

KINDS = "basename string, par_idx bigint, orig string, orig_tok array<string>, norm string, norm_tok array<string>, norm_ws array<boolean>, norm_spans array<array<int>>, alignment array<array<int>>"


def record(spark, orig_tok, norm, norm_tok, ws, spans, alignment=None, **more):
    alignment = alignment or [[i, i] for i in range(len(norm_tok))]
    df = spark.createDataFrame([("a", 0, " ".join(orig_tok), orig_tok, norm, norm_tok, ws, spans, alignment)], KINDS)
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


@pytest.fixture(scope="module")
def wir(spark):
    tok = ["Wir", "hofften", "aufeinmal", "alles", "zusammenzubringen", "."]
    orig = ["Wir", "hofften", "auffeinmal", "alles", "zuſammenzubringen", "."]
    spans = [[0, 3], [4, 11], [12, 21], [22, 27], [28, 45], [45, 46]]
    return record(spark, orig, "Wir hofften aufeinmal alles zusammenzubringen.", tok, [False] + [True] * 4 + [False], spans)


def test_one_to_many(wir):
    m = {"aufeinmal": ["auf", "einmal"], "zusammenzubringen": ["zusammen", "zu", "bringen"]}
    big = m | {f"x{i}": ["y"] for i in range(100)}
    for mapping in (m, big):
        r = modifiers.replace_1ton(mapping)(wir).first()
        assert r.norm == "Wir hofften auf einmal alles zusammen zu bringen."
        assert r.norm_ws == [False] + [True] * 7 + [False]
        assert r.norm_spans[2:] == [[12, 15], [16, 22], [23, 28], [29, 37], [38, 40], [41, 48], [48, 49]]
        assert r.alignment == [[0, 0], [1, 1], [2, 2], [2, 3], [3, 4], [4, 5], [4, 6], [4, 7], [5, 8]]
    same = modifiers.replace_1ton({"fehlt": ["a", "b"]})(wir)
    assert same.columns == wir.columns and same.first() == wir.first()


def test_one_to_one_keeps_alignment_and_flags(wir):
    r = modifiers.replace_1to1({"aufeinmal": "jäh"} | {f"x{i}": "y" for i in range(40)})(wir).first()
    assert r.norm == "Wir hofften jäh alles zusammenzubringen." and r.norm_spans[2] == [12, 15] and r.alignment == [[i, i] for i in range(6)]
    with pytest.raises(ValueError, match="layer"):
        modifiers.replace_1to1({"a": "b"}, "other")


def test_long_records_take_time_in_proportion(spark):
    tok = [f"w{i % 977}" for i in range(100_000)]
    df = record(spark, tok, " ".join(tok), tok, [i > 0 for i in range(len(tok))], None)
    began = time.time()
    r = modifiers.replace_1to1({"w5": "word"})(df).select("norm_spans", "norm_ws", "norm").first()
    assert len(r.norm_spans) == len(r.norm_ws) == 100_000 and r.norm_spans[-1][1] == len(r.norm) and time.time() - began < 60


def test_a_tokenizer_can_be_given(spark, wir):
    def letters(raw):
        tok = F.regexp_extract_all(raw, F.lit(r"\S"), F.lit(0))
        return F.struct(tok.alias("tok"), F.transform(tok, lambda t: F.lit(False)).alias("ws"))

    fixed = spark.createDataFrame([("a", "0", "ab c", 0)], "basename string, par_idx string, raw string, n bigint")
    assert modifiers.replace_raw(fixed, tokenizer=letters)(wir).first().norm_tok == ["a", "b", "c"]
    assert modifiers.retextualise(F.lit("xy"), tokenizer=letters)(wir).first().norm_tok == ["x", "y"]
    assert modifiers.vanilla(wir.select("basename", "par_idx", "orig_tok", "norm_tok"), letters).first().norm_tok[:4] == ["W", "i", "r", "h"]


NTOM = {("Aug", "'"): ("Auge",), ("Lieb", "'"): ("Liebe",), ("Herzen",): ("Herzen", "'"), ("lassig",): ("lässig",)}


def test_many_to_many(spark):
    m = {k: v for k, v in NTOM.items() if k != ("Herzen",)}
    spans = [[0, 3], [3, 4], [5, 11], [11, 12], [13, 17], [17, 18]]
    df = record(spark, ["Aug", "'", "Herzen", "'", "Lieb", "'"], "Aug' Herzen' Lieb'", ["Aug", "'", "Herzen", "'", "Lieb", "'"], [False, False, True, False, True, False], spans)
    r = modifiers.replace_ntom(m)(df).first()
    assert r.norm_tok == ["Auge", "Herzen", "'", "Liebe"] and r.norm == "Auge Herzen' Liebe"
    assert r.norm_spans == [[0, 4], [5, 11], [11, 12], [13, 18]] and r.norm_ws == [False, True, False, True]
    assert r.alignment == [[0, 0], [1, None], [2, 1], [3, 2], [4, 3], [5, None]]
    kept = modifiers.replace_ntom(m)(df.withColumn("lang_de", F.lit(0.0))).first()
    assert kept.norm == "Aug' Herzen' Lieb'"
    df = record(spark, ["laſſig"], "lassig", ["lassig"], [False], [[0, 6]])
    assert modifiers.replace_ntom(NTOM)(df).first().norm == "lassig"
    assert modifiers.replace_ntom(NTOM, transliterate_source=True)(df).first().norm == "lässig"
    with pytest.raises(ValueError, match="two layers"):
        modifiers.replace_ntom(NTOM, "norm", "norm")


def test_ngram_replacer_parts():
    r = NgramReplacer({("a",): ("x",), ("a", "b"): ("y",), ("c", "d"): ("z",)})
    assert r.hits(["a", "b", "a"]) == [(("a",), (0,)), (("a",), (2,)), (("a", "b"), (0, 1))]
    assert r.across((0, 1), [(0, 2), (1, None), (1, 0), (None, 1)]) == (0, 2) and r.across((5,), []) == ()
    assert r.without_overlaps({(0, 1): ("p",), (1, 2): ("q",), (2,): ("r",), (0,): ("s",)}) == [(0, 0, ("s",)), (1, 2, ("q",))]
    assert r.apply(["a", "b"], ["a", "b"], [(0, 0), (1, 1)]) == (["x", "b"], True)
    assert r.apply(["a"], ["a"], []) == (["a"], True) and r.apply(["q"], ["q"], [(0, 0)]) == (["q"], False)
    assert NgramReplacer({("c", "d"): ("z",)}).apply(["c", "d"], ["1", "2", "3"], [(0, 0), (1, 2)]) == (["z"], True)


def test_raw_replace(spark, wir):
    fixed = spark.createDataFrame([("a", "0", "alt", 0), ("a", "0", "Neu, neu.", 1), ("b", "0", "x", 2)], "basename string, par_idx string, raw string, n bigint")
    r = modifiers.replace_raw(fixed)(wir).first()
    assert r.norm == "Neu, neu." and r.norm_tok == ["Neu", ",", "neu", "."] and r.norm_spans == [[0, 3], [3, 4], [5, 8], [8, 9]]
    assert len({p[0] for p in r.alignment} - {None}) == 6
    assert modifiers.replace_raw(fixed.where("basename = 'b'"))(wir).first() == wir.first()


def test_rules(wir):
    df = wir.withColumn("norm", F.lit("Das war mir zuviel."))
    r = models.correct_by_rules({"ZUVIEL", "nope"})(df).first()
    assert r.norm == "Das war mir zu viel." and r.norm_tok == ["Das", "war", "mir", "zu", "viel", "."]
    r = models.correct(lambda: lambda s: s.replace("zuviel", "viel"))(df).first()
    assert r.norm == "Das war mir viel."


def test_language_and_scores(spark):
    df = spark.createDataFrame([("Das ist nicht die Art, wie ich es mit dem Haus und der Zeitung sage.",), ("the house of the king and this is not it with that",), (None,), ("",)], "orig string")
    rows = models.detect_language()(df).collect()
    assert [r.lang_de for r in rows] == [1.0, 0.0, 0.0, 0.0] and rows[1].lang_py3langid == "en" and rows[3].lang_fastText is None
    with pytest.raises(NotImplementedError):
        models.detect_language("title")
    counts = {r.gram: r.n for r in models.CharacterModel.count(df, "orig").collect()}
    m = models.CharacterModel(counts)
    assert m("the house of the king") < m("eht esuoh fo gnik eht") and m("") > 0
    scored = models.lm_score(lambda: m, "a/b", "norm")(df.withColumn("norm", F.col("orig")))
    assert scored.columns[-1] == "norm_a/b" and scored.where("orig IS NULL").first()["norm_a/b"] is None


def test_scores_see_the_end_of_long_texts(spark):
    m = models.CharacterModel({r.gram: r.n for r in models.CharacterModel.count(spark.createDataFrame([("abab" * 20,)], "orig string"), "orig").collect()})
    assert m("ab" * 1000 + "qx" * 50) > m("ab" * 1050)


def test_scores_learn_from_all_german_sentences(spark):
    from korpuswerk.plans import corpus, queries

    sf = "/root/testdata/sf0.001"
    df = corpus.sentences(spark, sf)
    m = models.CharacterModel({r.gram: r.n for r in models.CharacterModel.count(df.where("lang = 'de'"), "orig").collect()})
    texts = {(r.basename, r.par_idx): r.orig for r in df.limit(40).collect()}
    got = {(r.basename, r.par_idx): r.nll for r in queries.lm_score(spark, sf).collect()}
    assert all(abs(got[k] - m(t)) < 1e-5 for k, t in texts.items())


def test_vanilla_and_checks(spark):
    df = spark.createDataFrame([("a", 0, ["Sie", "ſagte", ":", "„", "Ja", "“", "."], None, ["Sie", "sagte", ":", "„", "Ja", "“", "."]), ("a", 1, [], [], [])], "basename string, par_idx int, orig_tok array<string>, orig_ws array<boolean>, norm_tok array<string>")
    done = modifiers.vanilla(df)
    r = done.first()
    assert r.norm == "Sie sagte: „Ja“." and r.orig == "Sie ſagte: „Ja“." and r.alignment == [[i, i] for i in range(7)]
    assert [len(x.faults) for x in checks.quarantine(done).collect()] == [0, 0]
    broken = done.withColumn("norm", F.concat("norm", F.lit("x")))
    assert checks.quarantine(broken).first().faults == ["norm: text"]
    with pytest.raises(Exception, match="record breaks"):
        checks.strict(broken).collect()
    assert checks.strict(done).count() == 2


def test_split(spark):
    docs = spark.createDataFrame([(f"t{i}", 0, 1700 + i, "Fiction::Historical", f"Author_{i}") for i in range(10)], "basename string, par_idx int, date int, genre string, author string")
    parts = split.split(split.documents(docs))
    assert {r.split: r["count"] for r in parts.groupBy("split").count().collect()} == {"train": 8, "validation": 1, "test": 1}
    assert split.documents(docs, 1703, 1705).count() == 3
    assert [(r.decade, r.genre, r.n_docs) for r in split.groups(split.documents(docs)).collect()] == [(1700, "Fiction", 10)]
    assert split.split(split.documents(docs).limit(0)).count() == 0
    assert split.split(split.documents(docs.withColumn("author", F.lit(None).cast("string")))).where("split = 'test'").count() == 10
    many = split.split_authors([str(i) for i in range(100)])
    assert sorted(many.values()).count("train") == 80 and len(many) == 100


def test_a_record_schema_names_both_layers():
    assert {"orig_tok", "norm_spans", "alignment"} <= set(RECORD.names)


def test_language_profiles(spark):
    rows = [("der kleine hund schläft nicht", "de"), ("die große stadt und ihr fluss", "de"), ("the little dog does not sleep", "en"), ("the big town with its river", "en"), (None, "en"), ("x", None)]
    counted = models.LanguageProfiles.count(spark.createDataFrame(rows, "t string, lang string"), "t", "lang")
    profiles = models.LanguageProfiles.gathered(counted)
    assert profiles.languages == ["de", "en"] and profiles("Die kleine Stadt") == "de" and profiles("the town!") == "en"
    assert profiles(None) is None and profiles("") is None and profiles("12 34") is None
    assert models.LanguageProfiles({})("der") is None
    df = spark.createDataFrame([("the river",), (None,)], "orig string")
    got = models.detect_language(detectors={"a": profiles.detector(spark), "b": models.by_words})(df).collect()
    assert [r.a for r in got] == ["en", None] and got[0].lang_de == 0.0


def test_every_rule_on_its_own(spark):
    pairs = {
        "ZUVIEL": ("Zuviel Wind", "Zu viel Wind"), "ZUWENIG": ("zuwenig", "zu wenig"), "OLD_SPELLING": ("daß er mußte", "dass er musste"), "BESSERN_VS_BESSEREN": ("bessern Zeiten", "besseren Zeiten"),
        "DOUBLE_SPACE": ("a  b", "a b"), "SPACE_BEFORE_COMMA": ("a , b", "a, b"), "SPACE_AFTER_COMMA": ("a,b 1,5", "a, b 1,5"), "DOUBLE_COMMA": ("a, , b", "a, b"), "GARNICHT": ("Garnichts", "Gar nichts"), "GARKEIN": ("garkeinen", "gar keinen"),
        "VORALLEM": ("vorallem", "vor allem"), "AUFEINMAL": ("aufeinmal", "auf einmal"), "WIEVIEL": ("Wieviele", "Wie viele"), "DESWEITEREN": ("Desweiteren", "Des Weiteren"), "STANDART": ("Standarte und Standarts", "Standarte und Standards"),
        "WIEDERSPIEGELN": ("wiederspiegelt", "widerspiegelt"), "REPEATED_ARTICLE": ("in der der Stadt", "in der Stadt"),
    }
    assert pairs.keys() == models.RULES.keys()
    for rule, (old, new) in pairs.items():
        df = spark.createDataFrame([(old,), (new,)], "norm string")
        assert [r.norm for r in models.correct_by_rules({rule})(df).select("norm").collect()] == [new, new], rule


def test_modifiers_in_a_row(spark, wir):
    many = {f"x{i}": "y" for i in range(40)}
    df = wir.transform(modifiers.replace_1to1({"alles": "viel"} | many)).transform(modifiers.replace_1ton({"aufeinmal": ["auf", "einmal"]} | {k: ["y"] for k in many}))
    df = df.transform(modifiers.replace_ntom({("hofften",): ("hofften", "sehr")}, transliterate_source=True)).transform(models.correct(lambda: lambda x: x.replace("sehr", "so sehr"))).transform(modifiers.replace_1to1({"viel": "manches"} | many))
    r = checks.strict(df.withColumns({"orig_ws": F.expr("transform(orig_tok, (t, i) -> i > 0)"), "orig_spans": X.spans_from_ws(F.col("orig_tok"), F.expr("transform(orig_tok, (t, i) -> i > 0)"))})).first()
    assert r.norm == "Wir hofften so sehr auf einmal manches zusammenzubringen." and [r.norm[a:b] for a, b in r.norm_spans] == r.norm_tok
    assert len({p[0] for p in r.alignment} - {None}) == 6
