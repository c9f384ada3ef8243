"""Very long texts, large groups, and the parts that other operators rest on."""

import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from korpuswerk.llm import ann, ctw, decontaminate, fitting, linededup, neardup, pii, runtime, simhash, toxicity, urls


def test_words_and_hashes_are_the_same_in_slices(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab  \n") for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", "x" * 100, " " * 50]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    whole = runtime.hashed_words(data, offs, runtime.NOT_SPACE)
    for size in (1, 7, 64):
        monkeypatch.setattr(runtime, "PASS_BYTES", size)
        for a, b in zip(whole, runtime.hashed_words(data, offs, runtime.NOT_SPACE), strict=True):
            assert (a == b).all()
    s, e, h, wb = whole
    found = [[data[x:y].tobytes() for x, y in zip(s[i:j], e[i:j], strict=True)] for i, j in zip(wb[:-1], wb[1:], strict=True)]
    assert found == [re.findall(rb"[^ \n]+", r) for r in raw]
    names = {}
    for w, x in zip([w for f in found for w in f], h.tolist(), strict=True):
        assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)


def test_pii_of_a_long_text(spark):
    text = "12 x " * 30_000 + "4111111111111111"
    began = time.time()
    r = pii.report(pii.spans(spark.createDataFrame([(1, text)], "doc_id int, text string"))).first()
    assert r.n_card == 1 and r.spans == f"card:150000:{150000 + 16}" and time.time() - began < 60


def test_context_decides_on_secrets(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [f'token = "{key}"', f"the value {key}", f"item token {key}", f"order {key}", "token " + "Wort" * 10, f"{key} token"]
    rows = pii.report(pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))).orderBy("doc_id").collect()
    assert [r.spans for r in rows] == ["secret:9:49", "", "secret:11:51", "", "", ""] and rows[0].scores == "0.6"


def test_line_dedup_of_long_lines(spark):
    w = [f"w{i}" for i in range(30_000)]
    changed, shorter = list(w), list(w)
    changed[11_111], shorter[20_000:20_001] = "new", []
    two = list(changed)
    two[5] = "second"
    rows = [(1, " ".join(w)), (2, " ".join(changed)), (3, " ".join(shorter)), (4, " ".join(reversed(w))), (5, " ".join(["more", *two]))]
    began = time.time()
    got = {r.doc_id: r.text for r in linededup.dedup(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [bool(got[k]) for k in range(1, 6)] == [True, False, False, True, True] and time.time() - began < 90


def test_line_dedup_with_any_column_names(spark):
    df = spark.createDataFrame([(1, "a b c d e", 5, 1, "m"), (2, "a b c d e\nf", 6, 2, "n")], "doc_id int, text string, k int, hash int, mine string").withColumns({"d": F.lit(1), "t": F.lit("t"), "drop": F.lit(2), "th": F.lit(3), "places": F.lit(4), "_mine": F.lit(5)})
    got = linededup.dedup(df)
    assert got.columns == df.columns and [r.text for r in got.orderBy("doc_id").collect()] == ["a b c d e", "f"]
    assert got.drop("text").orderBy("doc_id").collect() == df.drop("text").orderBy("doc_id").collect()


def shingles(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.mark.parametrize("chunk", [4, 512])
def test_near_dedup_of_hot_groups(spark, chunk):
    """A group of near copies and one of texts with a long passage in common; shards are dealt in several levels."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, passage, rows = [word() for _ in range(80)], [word() for _ in range(60)], []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(80)] = word()
        rows.append((rng.randrange(10**6), " ".join(w)))
    for i in range(60):
        rows.append((rng.randrange(10**6), " ".join([*passage, *[word() for _ in range(rng.randint(20, 40))]])))
    rows.append((None, rows[0][1]))
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id int, text string, s int, keys int")
    got = neardup.first_of_each(df, chunk=chunk)
    assert got.columns == df.columns
    kept = {r.doc_id: shingles(r.text) for r in got.collect()}
    similar = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    assert None not in kept and all(not similar(kept[a], kept[b]) for a in kept for b in kept if a < b)
    gone = [(k, shingles(t)) for k, t in rows if k is not None and k not in kept]
    assert len(gone) > 15 and all(any(a < k and similar(kept[a], s) for a in kept) for k, s in gone)
    assert sum(bool(set(passage) <= {w for s in v for w in s}) for v in kept.values()) == 60


def test_training_samples(spark):
    docs = spark.createDataFrame([(1, "one", 3), (2, "two", 3), (2, "again", 5), (3, None, 0), (4, "x" * 50, 50), (5, "five", 4), (6, "six", 3), (None, "none", 4), (7, "held", 4), (8, "plain", 5)], "doc_id int, text string, n_chars int")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (4, 1), (5, None), (6, 1), (None, 1), (7, 1), (9, 0)], "doc_id int, toxic int")
    got = fitting.sample(docs, labels, "toxic", F.col("doc_id") != 7, 10, 20, more=("n_chars",))
    # of several labels the highest, of several texts the first; nothing held out, unlabelled, null or too long
    assert got[["k", "text", "n_chars", "y"]].values.tolist() == [[1, "one", 3, 1], [2, "again", 5, 0], [6, "six", 3, 1]]
    assert abs(got.attrs["share"] - 4 / 6) < 1e-9
    few = fitting.sample(docs, labels, "toxic", F.lit(True), 1, 20)
    assert len(few) <= 2 and len(fitting.sample(docs, labels.limit(0), "toxic", F.lit(True), 5, 20)) == 0
    assert fitting.shift(few, np.array([1.0])) == 0.0
    half = pd.DataFrame({"y": [0, 1]})
    half.attrs["share"] = 0.9
    assert abs(fitting.shift(half, np.array([0.0, 1.0])) - np.log(9)) < 1e-9


def test_network_word_by_word():
    """The score of a text by loops over its windows, words and n-grams."""
    net = toxicity.Network(4)
    p = {k: v.astype(float) for k, v in net.p.items()}
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(n)) for n in (0, 1, 5, 33, 70)]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    H = toxicity.HIDDEN

    def place(x, kind=0):
        x = np.frombuffer(x, np.uint8)
        return runtime.mix(runtime.Hasher(x)(np.array([0]), np.array([len(x)])) + np.uint64(kind))

    def vector(w):
        name = runtime.Hasher(np.frombuffer(w, np.uint8))(np.array([0]), np.array([len(w)]))
        out, found = p["word"][int(name[0]) & (toxicity.WORDS - 1)].copy(), []
        for n in toxicity.SIZES:
            if len(w) >= n:
                found += [place(w[i : i + n]) for i in range(len(w) - n + 1)] + [place(w[:n], 1), place(w[-n:], 2)]
        return out + sum(p["gram"][int(x[0]) & (toxicity.GRAMS - 1)] for x in found) / max(1, len(found))

    def window(ws):
        states = np.zeros((2, len(ws), H))
        for d in (0, 1):
            h = np.zeros(H)
            for i in range(len(ws)) if d == 0 else range(len(ws) - 1, -1, -1):
                g, q = vector(ws[i]) @ p["into"][d] + p["bias"][d, 0], h @ p["turn"][d]
                z, r = sigmoid(g[:H] + q[:H]), sigmoid(g[H : 2 * H] + q[H : 2 * H])
                c = np.tanh(g[2 * H :] + r * q[2 * H :])
                h = z * h + (1 - z) * c
                states[d, i] = h
        s = np.concatenate(states, 1)
        if not len(s):
            return p["off"][0]
        e = np.exp(np.tanh(s @ p["look"]) @ p["seek"])
        return (e / e.sum()) @ s @ p["out"] + p["off"][0]

    raw = [t.encode() for t in texts]
    got = net.score(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    for r, score in zip(raw, got, strict=True):
        ws = r.split()
        starts = range(0, max(1, len(ws) - toxicity.WIDTH + toxicity.STEP), toxicity.STEP)
        assert abs(score - sigmoid(max(window(ws[i : i + toxicity.WIDTH]) for i in starts))) < 1e-4


def test_registered_domains_and_suffixes(spark):
    want = {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "www.x.co.uk:80": ("x.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.com": ("x.com", "com"), "co.example": ("co.example", "example"), "10.20.30.40:8080": ("10.20.30.40",) * 2, "u@10.20.30.40": ("10.20.30.40",) * 2, "[::1]:80": ("[::1]",) * 2, "localhost": ("localhost",) * 2, "": ("", "")}
    domain, suffix = urls.names(F.col("h"))
    rows = spark.createDataFrame([(h,) for h in want], "h string").select("h", domain.alias("d"), suffix.alias("s")).collect()
    assert {r.h: (r.d, r.s) for r in rows} == want


@pytest.mark.parametrize(("n", "every"), [(1000, 20), (6000, 60), (18_000, 360)])
def test_recall_at_sizes_up_to_more_than_1024_lists(spark, n, every):
    """Vectors without clusters, the hardest case, in lists of 16: 63, 375 and 1125 lists."""
    x = np.random.default_rng(6).normal(size=(n, 24))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    found = {}
    for r in ann.search(df, every=every, list_size=16).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in range(0, n, every):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hit / (20 * len(found)) >= 0.9 and len(found) == len(range(0, n, every))


def test_lengths_of_vectors_are_searched_apart(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(40)] + [(100 + i, [1.0, float(i), 2.0]) for i in range(0, 41)]
    got = ann.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r.query_id for r in got} == {0, 20, 100, 120, 140} and all((r.query_id < 100) == (r.vec_id < 100) for r in got)


def test_decontamination_with_a_common_shingle(spark):
    """Items whose shingles are everywhere, several blocks, and documents of one word repeated."""
    items = [(i, "the of and " * 3 + f"w{i} " * (i % 4) + "the of and") for i in range(60)] + [(99, "the the the"), (98, "zz")]
    docs = [(i, "x " * (i % 5) + items[i % 62][1] + " y") for i in range(80)] + [(200, "the " * 500), (201, None)]
    df, bench = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    windows = {}
    for k, t in items:
        for w in decontaminate.windows_of(decontaminate.words_of(t)):
            windows.setdefault(w, set()).add(k)
    for block in (1 << 20, 300):
        for r in decontaminate.overlaps(df, bench, block_bytes=block).collect():
            words, hit, own = decontaminate.words_of(dict(docs)[r.doc_id]), set(), set()
            for w, ids in windows.items():
                for i in range(len(words) - len(w) + 1):
                    if tuple(words[i : i + len(w)]) == w:
                        hit |= set(range(i, i + len(w)))
                        own |= ids
            assert {i for i, x in enumerate(r.hit or b"") if x} == hit and set(r["items"] or ()) == own and r.n_words == len(words)


def test_scores_of_texts_in_slices(spark, monkeypatch):
    """A text longer than a pass has the grams it has in one."""
    data = np.frombuffer(("the an ä" * 40).encode(), np.uint8)
    offs = np.array([0, len(data)])
    whole = ctw.grams(data, offs)
    for size in (1, 7, 50):
        monkeypatch.setattr(ctw, "PASS_BYTES", size)
        assert (np.concatenate([g for _, g in ctw.gram_runs(data, offs)]) == whole).all()


def test_simhash_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b c d", 7, "r", 2.0), (2, "a b c d", 8, None, 3.0)], "doc_id int, text string, fp int, root string, own double")
    rows = simhash.near_duplicates(df, keep=("fp", "root", "own")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.component_id, r.fp, r.root, r.own) for r in rows] == [(1, 1, 7, "r", 2.0), (2, 1, 8, None, 3.0)]
