import csv
import json
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from korpuswerk import registry
from korpuswerk.cli import dataset2lexicon, make_dataset, modify_dataset, split_dataset
from korpuswerk.sources import mappings, readers, writers
from korpuswerk.streaming import modify

HEAD = "%%$DDC:meta.basename=other\n%%$DDC:index[0]=Token w\n%%$DDC:index[1]=Utf8 u\n%%$DDC:index[2]=CanonicalToken v\n%%$DDC:index[3]=Pos p\n%%$DDC:index[4]=Lemma l\n%%$DDC:index[5]=WordSep ws\n"
TABS = HEAD + "Ein\tEin\tEin\tART\teine\t1\nkoennen\tkönnē\tkann_es\tV\tkönnen\t1\n--\t—\t--\t$(\t--\t1\n.\t.\t.\t$.\t.\t0\n\n\nso\tſo\tso\tADV\tso\t1\n%%$DDC:PAGE=1\nja\tja\tja\tADV\tja\t1\n\nlost\tlost\tlost\tX\tlost\t0\n"
META = [{"basename": "a", "date_": "1700", "firstDate": "1700", "author": "A", "textClass": "Fiction::Novel", "title": "T"}, {"basename": "a", "date_": "1800", "firstDate": "1800", "author": "B", "textClass": "x", "title": "U"}, {"basename": "b", "date_": "1750", "firstDate": "1750", "author": "C", "textClass": "x", "title": "V", "bibl": "?"}]
XML = """<doc base="x"><body><s><w class="LEX" new="In" old="In"/><w class="JOIN" new="Ständeversammlungen" old="Stände- Verſammlungen"><w class="JOIN" new="Stände" old="Stände-"/><w class="JOIN" new="V" old="Verſammlungen"/></w><w class="LEX" new="zwei Wörter" old="zwei_wörter"/><w class="BUG" new="x"/><w class="LEX" old="auf¬"/><w class="LEX" new="Haus" old="Haus¬"/></s><s sbad="1"/></body></doc>"""


@pytest.fixture
def corpus(tmp_path):
    (tmp_path / "tabs").mkdir()
    (tmp_path / "tabs/a.TEI-P5.tabs").write_text(TABS)
    (tmp_path / "xml").mkdir()
    (tmp_path / "xml/b.orig.xml").write_text(XML)
    (tmp_path / "meta.jsonl").write_text("".join(json.dumps(m) + "\n" for m in META))
    return tmp_path


def test_token_tables(spark, corpus):
    rows = readers.read_tabs(spark, str(corpus / "tabs")).orderBy("par_idx").collect()
    assert [r.par_idx for r in rows] == [0, 1, 2] and rows[0].basename == "a" and rows[1].orig_tok == []
    r = rows[0]
    assert r.orig_tok == ["Ein", "könnē", "—", "."] and r.orig_xlit[1] == "koennen" and r.orig_ws == [False, True, True, False]
    assert r.norm_tok == ["Ein", "kann", "es", "—", "."] and r.orig_pos == ["ART", "V", "$(", "$."] and r.norm_ws is None
    assert rows[2].orig_tok == ["ſo", "ja"]
    bad = spark.createDataFrame([("x/y.tabs", "a\tb\n\n")], "path string, value string")
    with pytest.raises(Exception, match="no column"):
        readers.tab_records(bad).collect()


def test_xml(spark, corpus):
    rows = readers.read_xml(spark, str(corpus / "xml")).orderBy("par_idx").collect()
    assert rows[0].orig_tok == ["In", "Stände-Verſammlungen", "zwei", "wörter", "auf-", "Haus-"]
    assert rows[0].norm_tok == ["In", "Ständeversammlungen", "zwei", "Wörter", "auf-", "Haus-"]
    assert rows[0].orig_class == ["LEX"] * 6 and not rows[0].is_bad and rows[1].is_bad and rows[1].orig_tok == []
    join = ET.fromstring('<s><w class="JOIN" new="achtundachtzig" old="x"><w class="JOIN" old="acht"/><w class="JOIN" old="und"/></w></s>')
    assert readers.xml_sentence(join) == (["acht", "und"], ["achtundachtzig"], ["JOIN", "JOIN"])


def test_metadata(spark, corpus):
    got = {r.basename: (r.date, r.author, r.genre, r.title) for r in readers.read_metadata(spark, str(corpus / "meta.jsonl")).collect()}
    assert got == {"a": (1700, "A", "Fiction::Novel", "T"), "b": (1750, "C", "x", "V")}
    bad = spark.createDataFrame([(0, '{"basename": "a", "date_": "1", "firstDate": "2"}')], "n int, value string")
    with pytest.raises(Exception, match="two dates"):
        readers.metadata_from_lines(bad).collect()


def test_makers_and_programs(spark, corpus, capsys):
    made = registry.maker("DtakMaker")(spark, str(corpus / "tabs"), str(corpus / "meta.jsonl"))
    assert len(made.columns) == 18 and made.count() == 3
    assert len(registry.maker("dtaevalmaker")(spark, str(corpus / "xml"), str(corpus / "meta.jsonl")).columns) == 17
    with pytest.raises(ValueError, match="no maker"):
        registry.maker("x")
    with pytest.raises(ValueError, match="no modifier"):
        registry.modifier(spark, "x")
    (corpus / "meta2.jsonl").write_text(json.dumps(META[2]))
    with pytest.raises(Exception, match="no metadata for a"):
        registry.maker("dtakmaker")(spark, str(corpus / "tabs"), str(corpus / "meta2.jsonl")).collect()

    out = corpus / "out"
    make_dataset.main(["-m", "dtakmaker", "--data", str(corpus / "tabs"), "--metadata", str(corpus / "meta.jsonl"), "-o", str(out)])
    lines = [json.loads(x) for x in (out / "a.jsonl").read_text().splitlines()]
    assert [x["par_idx"] for x in lines] == [0, 1, 2] and lines[2]["norm"] == "so ja" and "ſo" in (out / "a.jsonl").read_text()

    (corpus / "map.tsv").write_text("so\tsehr so\nja\tja doch\n")
    modify_dataset.main(["-m", "replacetoken1tonmodifier", "--modifier-kwargs", f"mapping_files={corpus}/map.tsv layer=norm", "--data", str(out), "-o", str(corpus / "mod")])
    line = json.loads((corpus / "mod/a.jsonl").read_text().splitlines()[2])
    assert line["norm"] == "sehr so ja doch" and sorted(t for _, t in line["alignment"] if t is not None) == [0, 1, 2, 3] and line["orig_xlit"] == ["so", "ja"]
    modify_dataset.main(["-m", "languagedetectionmodifier", "--data", str(out), "-o", str(corpus / "one.jsonl"), "--output-single-file"])
    assert "lang_de" in json.loads((corpus / "one.jsonl").read_text().splitlines()[0])

    dataset2lexicon.main(["--data", str(corpus / "mod"), "-o", str(corpus / "lex.jsonl"), "-s", "_"])
    lex = [json.loads(x) for x in (corpus / "lex.jsonl").read_text().splitlines()]
    assert {"orig": "Ein", "norm": "Ein", "freq": 1, "docs": 1} in lex and [(x["orig"], x["norm"]) for x in lex] == sorted((x["orig"], x["norm"]) for x in lex)

    capsys.readouterr()
    split_dataset.main(["--input-dir", str(out), "--dry-run"])
    split, name, decade, *_ = capsys.readouterr().out.split()
    assert (split in ("train", "validation", "test"), name) == (True, "a") and int(decade) % 10 == 0
    with pytest.raises(SystemExit):
        split_dataset.main(["--input-dir", str(out)])
    split_dataset.main(["--input-dir", str(out), "--year-start", "1600", "--year-end", "1900", *[x for n in ("train", "validation", "test") for x in (f"--output-dir-{n}", str(corpus / n))]])
    assert sum((corpus / n / "a.jsonl").exists() for n in ("train", "validation", "test")) == 1 and (out / "a.jsonl").exists()


def test_empty_lexicon_is_an_empty_file(spark, tmp_path):
    writers.write_lexicon(spark.createDataFrame([], "orig string, norm string, freq bigint, docs bigint"), str(tmp_path / "l.jsonl"))
    assert (tmp_path / "l.jsonl").read_text() == ""


def test_dataset_keeps_nulls(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"basename": "x", "par_idx": 0, "alignment": [[0, null], [null, 1]], "norm_tok": ["a"]}\n')
    df = readers.drop_absent(readers.read_dataset(spark, str(tmp_path)))
    assert df.first().alignment == [[0, None], [None, 1]] and "orig_xlit" not in df.columns
    writers.write_grouped(df, str(tmp_path / "o"))
    assert json.loads((tmp_path / "o/x.jsonl").read_text())["alignment"] == [[0, None], [None, 1]]


def test_mapping_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("daß\tdass\nmuß\tmuss\n")
    (tmp_path / "b.tsv").write_text("daß\tdas\nAll '\tAlle\n")
    both = [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")]
    assert mappings.token_to_token(both)["daß"] == "das" == mappings.token_to_token([str(tmp_path / "[ab].tsv")])["daß"]
    with pytest.raises(FileNotFoundError):
        mappings.token_to_token([str(tmp_path / "none.tsv")])
    assert mappings.ngram_to_ngram([both[1]], "\t")[("All", "'")] == ("Alle",)
    (tmp_path / "bad.tsv").write_text("a\tb\nc\td\te\nf\n")
    with pytest.raises((csv.Error, AssertionError)):
        mappings.token_to_token([str(tmp_path / "bad.tsv")])
    (tmp_path / "c.csv").write_text("basename\tpar_idx\tfixed\nx\t1\tA b.\nx\t1\tC d.\n")
    rows = mappings.corrections(spark, [str(tmp_path / "c.csv"), "other.txt"], "fixed").orderBy("n").collect()
    assert [r.raw for r in rows] == ["A b.", "C d."]
    with pytest.raises(ValueError, match="missing"):
        mappings.corrections(spark, [str(tmp_path / "c.csv")], "none")
    (tmp_path / "r.txt").write_text(" ZUVIEL \n\nOLD_SPELLING\n")
    assert mappings.rules(str(tmp_path / "r.txt")) == {"ZUVIEL", "OLD_SPELLING"}
    assert mappings.options(["mapping_files=a,b delimiter={TAB}", "transliterate_source=True"]) == {"mapping_files": ["a", "b"], "delimiter": "\t", "transliterate_source": True}
    assert mappings.dataset_files(str(tmp_path)) == [] and len(mappings.resolve(str(tmp_path))) == 5
    with pytest.raises(ValueError):
        mappings.dataset_files(str(tmp_path / "none"))


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.jsonl").write_text('{"basename": "x", "par_idx": 0, "norm": "so", "norm_tok": ["so"], "norm_ws": [false], "orig_tok": ["ſo"], "alignment": [[0, 0]]}\n')
    records = modify.read(spark, str(tmp_path / "in"))
    step = registry.modifiers.replace_1to1({"so": "sehr"})
    modify.modify(records, [step], str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first().norm == "sehr"
    modify.frequencies(records, "freqs").awaitTermination()
    assert spark.table("freqs").where(F.col("orig") == "ſo").first().freq == 1
