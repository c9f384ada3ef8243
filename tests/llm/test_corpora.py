"""Operators on whole tables: links, windows, neighbours, hosts, the pipeline."""

import hashlib
import random

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from korpuswerk.llm import ann, decontaminate, linededup, neardup, simhash, urls

DOCS = "doc_id bigint, text string"


def some_words(rng, n):
    return ["".join(rng.choice(["an", "th", "er", "on", "ing", "ou", "le", "ä"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        w = some_words(rng, rng.randint(3, 80))
        rows.append((i, " ".join(w)))
        if i % 5 == 0:
            w[rng.randrange(len(w))] = "changed"
            rows.append((1000 + i, " ".join(w)))
        if i % 7 == 0:
            rows.append((2000 + i, " ".join(w).upper()))
    return rows + [(None, "x y z"), (5000, ""), (5001, None), (5002, "  \n"), (5003, "one"), (5004, "One"), (5003, "one"), (6000, rows[0][1]), (None, rows[0][1])]


def test_simhash_against_all_pairs(spark, docs):
    df = spark.createDataFrame([(k, t, 1, "f") for k, t in docs], "doc_id bigint, text string, component_id int, fp string").repartition(3)
    got = sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted(brute.simhash_rows(docs), key=str)
    kept = simhash.first_of_each(df)
    rows = kept.collect()
    assert kept.columns == df.columns and {r.doc_id for r in rows} == {c for _, _, c in got}
    # one document a component; a row that is there twice stays twice
    assert len({(r.doc_id, r.text) for r in rows}) == len({c for _, _, c in got})
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_near_dedup_stage_against_all_pairs(spark, docs):
    """Copies with a few words changed go, chains of them too, but none that is under 0.8 to each one kept."""
    rng = random.Random(9)
    rows = [r for r in docs]
    for i in range(30):
        w = some_words(rng, rng.randint(40, 90))
        for j in range(5):
            w = list(w)
            w[rng.randrange(len(w))] = f"new{j}"
            rows.append((8000 + 10 * i + j, " ".join(w)))
    df = spark.createDataFrame([(k, t, "s") for k, t in rows], "doc_id bigint, text string, s string").repartition(3)

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    kept = []
    for k, t in sorted((r for r in set(rows) if r[0] is not None), key=lambda r: r[0]):
        s = shingles(t)
        if not any(5 * len(s & o) >= 4 * len(s | o) for _, o in kept):
            kept.append((k, s))
    got = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert {r.doc_id for r in got.where("doc_id IS NOT NULL").collect()} == {k for k, _ in kept}
    assert {r.text for r in got.where("doc_id IS NULL").collect()} == {"x y z"}
    assert neardup.first_of_each(df.limit(0)).count() == 0


def test_bk_tree_links_a_dense_ball(spark):
    rng = random.Random(4)
    vals = [0, *[1 << i for i in range(20)], *[(1 << i) | (1 << j) for i in range(12) for j in range(i)], *[rng.getrandbits(64) for _ in range(200)], (1 << 64) - 1]
    rng.shuffle(vals)
    tree = simhash.BkTree()
    for v in vals:
        tree.add(v)
    for q in vals[:40]:
        assert sorted(tree.values[i] for i in tree.near(q)) == sorted(v for v in vals if (v ^ q).bit_count() <= 3)
    parent = {v: v for v in vals}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in vals:
        for b in vals:
            if a < b and (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    for i, a in enumerate(vals):
        for j in range(i):
            assert (tree.root(i) == tree.root(j)) == (root(a) == root(vals[j]))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    found = {r.node: r.root for r in simhash.components(simhash.links(spark.createDataFrame([(signed(v),) for v in vals], "fp bigint"))).collect()}
    name = lambda v: found.get(signed(v), signed(v))
    assert all((name(a) == name(vals[0])) == (root(a) == root(vals[0])) for a in vals)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 200: 100}


def plain_overlaps(docs, items):
    out = []
    windows = {}
    for k, t in items:
        for w in decontaminate.windows_of(decontaminate.words_of(t)):
            windows.setdefault(w, set()).add(k)
    for k, t in docs:
        words = decontaminate.words_of(t)
        hit, own = set(), set()
        for w, ids in windows.items():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    own |= ids - {None}
        out.append((k, len(words), len(hit), len(own), hashlib.sha256(",".join(sorted(map(str, own))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_decontamination_against_all_windows(spark, docs, block):
    rng = random.Random(2)
    items = [(i, " ".join(docs[i * 3][1].split()[: rng.randint(1, 30)])) for i in range(25)] + [(50, "One"), (51, None), (52, "..."), (53, "an an an an an an an an an an an an"), (2, docs[6][1]), (None, docs[9][1])]
    more = [*docs, (7000, "an " * 40), (7001, "x an an an an an an an an an an y")]
    df = spark.createDataFrame([(k, t, "h") for k, t in more], "doc_id bigint, text string, hit string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.overlaps(df, bench, block_bytes=block)
    assert sorted((tuple(r) for r in decontaminate.report(found).collect()), key=str) == plain_overlaps(more, items)


def test_decontamination_of_nothing(spark, docs):
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], "item_id bigint, text string")
    rows = decontaminate.report(decontaminate.overlaps(df, bench)).collect()
    assert len(rows) == len(docs) and not any(r.contaminated for r in rows) and {r.n_words for r in rows} > {0, 1}
    assert decontaminate.report(decontaminate.overlaps(df.limit(0), bench)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_line_dedup(rows):
    """(key, text) to kept text, by comparing each line with all earlier ones."""
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    earlier, out = [], {}
    for k, t in order:
        kept = []
        for line in t.split("\n"):
            w = line.split()
            if len(w) < 5 or not any(abs(len(w) - len(e)) < 2 and edits(w, e) <= 1 for e in earlier):
                kept.append(line)
            if len(w) >= 5:
                earlier.append(w)
        out[k, t] = "\n".join(kept)
    return out


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(6)
    pool = [some_words(rng, rng.choice([1, 4, 5, 6, 7, 12, 13])) for _ in range(30)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            w = list(rng.choice(pool))
            kind = rng.random()
            if kind < 0.25:
                w[rng.randrange(len(w))] = "new" + str(rng.randint(0, 3))
            elif kind < 0.4:
                w.insert(rng.randint(0, len(w)), "more")
            elif kind < 0.55:
                del w[rng.randrange(len(w))]
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((i, "\n".join(lines)))
    rows += [(70, None), (71, ""), (3, rows[3][1]), (None, rows[5][1] + "\nalpha beta gamma delta epsilon"), (72, "a a a a a\na a a a a a\nb a a a a")]
    df = spark.createDataFrame([(k, t, len(t or ""), "d") for k, t in rows], "doc_id bigint, text string, n_chars bigint, drop string")
    got = linededup.dedup(df)
    assert got.columns == df.columns and got.count() == len(rows)
    want = plain_line_dedup(rows)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(((k, want.get((k, t))) for k, t in rows), key=str)
    assert all(r.n_chars == len(r.text or "") for r in got.collect())
    assert linededup.report(df.limit(0)).count() == 0 and linededup.report(df).count() == len(rows)


def test_lines_are_made_once_and_halved_right(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "bé", "日本", "x" * 9]) for _ in range(rng.randint(1, 8))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    every = linededup.lines(df, "doc_id", "text", 1)
    # a condition pushed below the words would have them made once more for each time that it reads them
    assert every._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    named = {}
    for r in linededup._halved(every).collect():
        w = r.w.split(" ")
        want = [(size, side, *part) for size in (len(w), len(w) + 1) for side, part in (("before", w[: size // 2]), ("after", w[len(w) - (size - size // 2) :]))]
        for h, x in zip(r.halves, want, strict=True):
            assert named.setdefault(x, h) == h
    assert len(named) == len(set(named.values())) and sorted(r.w for r in every.collect()) == sorted(texts)


def test_neighbours_reach_the_true_ones(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    x = centre[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    x[500:1500] = x[500]  # a third are one vector
    rows = [(i, v.tolist(), "s") for i, v in enumerate(x)]
    rows += [(9000, None, "s"), (9020, [0.0] * 16, "s"), (9040, [float("nan")] * 16, "s"), (9060, [1.0] * 3, "s"), (None, [1.0] * 16, "s"), (9080, [None] * 16, "s"), (0, x[0].tolist(), "s")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    got = ann.search(df, list_size=64).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(by) == set(range(0, 3000, 20)) and all(sorted(v) == list(range(1, 21)) for v in by.values())
    hit = 0
    for q, found in by.items():
        s = x @ x[q]
        order = sorted((i for i in range(3000) if i != q), key=lambda i: (-s[i], i))[:20]
        hit += len({f[0] for f in found.values()} & set(order))
        assert all(abs(s[v] - score) < 1e-9 for v, score in found.values()) and q not in {f[0] for f in found.values()}
        scores = [found[k] for k in range(1, 21)]
        assert all(a[1] > b[1] or a[1] == b[1] and a[0] < b[0] for a, b in zip(scores, scores[1:], strict=False))
    assert hit / (20 * len(by)) >= 0.9
    few = ann.search(df.where("vec_id < 5")).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(0, k) for k in range(1, 5)]
    assert ann.search(df.limit(0)).count() == 0


def test_ratio_follows_the_table(spark):
    """Vectors without clusters in many small lists, where a ratio of 1.13 reads too few of them."""
    x = np.random.default_rng(5).normal(size=(12000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {}
    for r in ann.search(df, every=60, list_size=16).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in range(0, 12000, 60):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hit / (20 * 200) > 0.92


def test_lists_are_balanced():
    x = np.random.default_rng(0).normal(size=(2000, 8))
    c = ann.fit(x, 20)
    size = np.bincount(ann._distances(x, c).argmin(1), minlength=20)
    assert size.max() < 4 * 100
    g = ann.Graph(c)
    ids, dist = g.search(x[:50], 3)
    assert (ids[:, 0] == ann._distances(x[:50], c).argmin(1)).mean() > 0.95 and (np.diff(dist, axis=1) >= 0).all()


def test_hosts_paths_and_rules(spark):
    from korpuswerk.llm.queries import URL_RULES

    given = ["HTTP://WWW.Example.com/en/x?q#f", "http://a.b.example.com/en/", "x://net/es/1", "http://n.net/fr", "http://notnet/es/", "nothing", None, "http://h.org", "a://b://c/d", "http://example.com/EN/"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(given)] + [(None, given[0], "x"), (0, given[0], "x")], "page_id bigint, url string, host string")
    none = spark.createDataFrame([], "page_id bigint, bad int")
    rows = urls.judge(df, none, URL_RULES).collect()
    assert len(rows) == 12
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow") and got[1] == ("a.b.example.com", "/en/", "example.com/en/", "block")
    assert got[2] == ("net", "/es/1", "net/es/", "block") and got[3][2] is None and got[4][2] is None and got[5][:3] == ("", "", None) == got[6][:3]
    assert got[8][:2] == ("b:", "//c/d") and got[9][2] == "com/"
    assert urls.judge(df.limit(0), none, URL_RULES).count() == 0


def test_reputations_shrink(spark):
    rows = [("bad.x.org", 1)] * 60 + [("good.x.org", 0)] * 60 + [("one.y.com", 1)] + [("none.x.org", None), ("far.z.com", None)] + [(f"h{i}.y.com", 0) for i in range(40)]
    reps = {r.host: r for r in urls.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert reps["bad.x.org"].bound > 0.5 > reps["good.x.org"].mean and reps["one.y.com"].bound < 0.5
    assert reps["good.x.org"].mean < reps["none.x.org"].mean < reps["bad.x.org"].mean and reps["far.z.com"].mean < reps["none.x.org"].mean and reps["none.x.org"].n == 0


def test_pipeline_stages_agree_with_their_parts(spark, tmp_path):
    """Each stage on the smallest tables, against the plain versions where there are any."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs
    assert len(corpus_pipeline.STAGES) == 5
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, sf)
        after.write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        rows = [(r.doc_id, r.text) for r in before.collect()]
        if i < 4:
            assert after.columns == columns, name
        if i == 1:
            want = plain_line_dedup(rows)
            assert {(r.doc_id, r.text) for r in after.collect()} == {(k, want[k, t]) for k, t in rows}
        elif i == 2:
            assert {r.doc_id for r in after.collect()} == {c for _, _, c in brute.simhash_rows(rows)}
        elif i == 3:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert {r.doc_id for r in after.collect()} == {x[0] for x in plain_overlaps(rows, items) if not x[-1]}
        elif i == 4:
            assert {(r.doc_id, r.decoded_sha256) for r in after.collect()} == {(k, hashlib.sha256(t.encode()).hexdigest()) for k, t in rows}
        before = after
    assert 0 < before.count() < docs.count()
    assert before.where(F.col("n_tokens") > 0).count() > 0
