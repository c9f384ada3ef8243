import random

from pyspark.sql import functions as F

from korpuswerk.functions import text as X

#: A sentence with its tokens, flags and spans (fixed values).
RAW = "Irgend eyn ſchoenes Haus zuviel."
TOK = ["Irgend", "eyn", "ſchoenes", "Haus", "zuviel", "."]
WS = [False, True, True, True, True, False]
SPANS = [[0, 6], [7, 10], [11, 19], [20, 24], [25, 31], [31, 32]]


def one(spark, column, **values):
    kinds = {"raw": "string", "tok": "array<string>", "ws": "array<boolean>"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[k]}" for k in values))
    return df.select(column.alias("x")).first().x


def test_tokens_and_text_follow_from_each_other(spark):
    got = one(spark, X.raw2tok(F.col("raw")), raw=RAW)
    assert (got.tok, got.ws) == (TOK, WS)
    assert one(spark, X.tok2raw(F.col("tok"), F.col("ws")), tok=TOK, ws=WS) == RAW
    assert one(spark, X.spans_from_ws(F.col("tok"), F.col("ws")), tok=TOK, ws=WS) == SPANS
    got = one(spark, X.spans_ws_from_raw(F.col("tok"), F.col("raw")), tok=TOK, raw=RAW)
    assert (got.spans, got.ws) == (SPANS, WS)


def test_text_without_flags_is_detokenised(spark):
    tok = "„ Irgend ' was ; es iſt ganz gleich , es muß nur einen Reim auf ‚ u ‘ haben ; ‚ u ‘ iſt immer Trauervokal .".split(" ")
    want = "„Irgend' was; es iſt ganz gleich, es muß nur einen Reim auf ‚u‘ haben; ‚u‘ iſt immer Trauervokal."
    assert one(spark, X.tok2raw(F.col("tok"), F.col("ws")), tok=tok, ws=None) == want
    assert one(spark, X.detokenize(F.col("tok")), tok=["Ich", "bin", "ein", "Mensch", "."]) == "Ich bin ein Mensch."


def test_white_space_is_only_u0020_and_a_misfit_is_seen(spark):
    got = one(spark, X.spans_ws_from_raw(F.col("tok"), F.col("raw")), tok=["a", "b"], raw="a b")
    assert got.ws == [False, False]
    df = spark.createDataFrame([("a b", ["a", "b"], [False, True]), ("a  b", ["a", "b"], [False, True]), (None, ["a"], [False])], "raw string, tok array<string>, ws array<boolean>")
    assert [r.x for r in df.select(X.consistent(F.col("raw"), F.col("tok"), F.col("ws")).alias("x")).collect()] == [True, False, False]


def test_random_tokens_come_back(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        tok = ["".join(rng.choice("aäſ😀.-,") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 9))]
        rows.append((tok, [False, *[rng.random() < 0.6 for _ in tok[1:]]]))
    df = spark.createDataFrame(rows, "tok array<string>, ws array<boolean>").withColumn("raw", X.tok2raw(F.col("tok"), F.col("ws")))
    df = df.withColumn("x", X.spans_ws_from_raw(F.col("tok"), F.col("raw"))).withColumn("s", X.spans_from_ws(F.col("tok"), F.col("ws")))
    for r in df.collect():
        assert r.x.ws == r.ws and r.x.spans == r.s and [r.raw[a:b] for a, b in r.s] == r.tok


def test_transliteration(spark):
    df = spark.createDataFrame([("ſchoͤn uͤber aͤ ꝛ ﬁ",), (None,), ("",)], "s string")
    assert [r.x for r in df.select(X.transliterate(F.col("s")).alias("x")).collect()] == ["schön über ä r fi", None, ""]


def test_names_years_genres_labels(spark):
    df = spark.createDataFrame([("file:/x/a.TEI-P5.tabs", 1834, "Fiction:Novel::x", "__label__de", ["de", "de", None])], "p string, y int, g string, l string, v array<string>")
    r = df.select(X.basename(F.col("p")).alias("b"), X.decade(F.col("y")).alias("d"), X.coarse_genre(F.col("g")).alias("g"), X.language_label(F.col("l")).alias("l"), X.vote_share([F.col("v")[i] for i in range(3)]).alias("v"), X.split_underscores(F.lit("a__b")).alias("u"), X.split_spaces_underscores(F.lit("a_ b")).alias("s")).first()
    assert tuple(r) == ("a", 1830, "Fiction", "de", 0.667, ["a", "", "b"], ["a", "b"])


def test_wrongly_split_words():
    assert X.join_wrongly_split(["Versammlungs-", "Freiheits-", "Gesetz"]) == ["Versammlungs-Freiheits-Gesetz"]
    assert X.join_wrongly_split(["Stände¬", "Verſammlungen", "auf-", "Bau", "A-", "b"]) == ["Stände-Verſammlungen", "auf-", "Bau", "A-", "b"]
    assert X.join_wrongly_split(["A-", "B¬", "C"]) == ["A-B¬", "C"] and X.join_wrongly_split([]) == []
