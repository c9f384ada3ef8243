"""Operators on single texts: encoding, personal data, scores."""

import base64
import hashlib
import random
import tracemalloc
import zlib

import brute
import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken


from korpuswerk.llm import bpe, ctw, pii, quality, toxicity
from korpuswerk.llm.runtime import NOT_SPACE, Hasher, HashTable, passes, words

DOCS = "doc_id bigint, text string"
ODD = ["", None, " ", "a" * 3000, "  \n\n x  ", "é😀 a@b.co", "e" * 257, "one", "One", "\u00a0x", "日本語 テキスト"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "c", 1) for i, t in enumerate(ODD)] + [(None, "no key", "c", 1), (3, "a" * 3000, "c", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, token_ids string, score int")


def test_bpe_as_the_library(spark, odd):
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n'1.é") for _ in range(rng.randint(0, 40))) for _ in range(500)] + ["".join(rng.choice("abcdefgh") for _ in range(3000))]
    own = bpe.Bpe(path, P.PATTERN)
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(t) and own.decode(ids).decode() == t
    plain = bpe.Bpe(path, P.PATTERN + "|x")  # a pattern that isn't cut at spaces
    assert plain.encode(texts[:50]) == own.encode(texts[:50])
    rows = bpe.decode(bpe.encode(odd, path, P.PATTERN), path, P.PATTERN).collect()
    assert len(rows) == len(ODD) + 2
    assert sorted(map(str, bpe.encode(odd, path, P.PATTERN, decoded=True).collect())) == sorted(map(str, rows))
    for r in rows:
        if r.doc_id is not None:
            assert bytes(r.decoded).decode() == (ODD[r.doc_id] or "") and r.n_tokens == len(want.encode_ordinary(ODD[r.doc_id] or ""))
    assert bpe.encode(odd.limit(0), path, P.PATTERN).count() == 0


def test_pii_against_plain_python(spark, odd):
    rng = random.Random(4)
    texts = ["a@b.c_d@e.f x", "1.2.3.4.5", "1.2.3.400 256.1.1.1.1", "1" * 5000, "x" * 5000, "4111 1111 1111 1111 and 4111-1111-1111-1111-", "+1 (017) 555-7713) +12", "é😀 a@b.co 1.2.3.4\n\n+49 30 1234 5678", "", None, "a@b.c@d.e", "--a@b-.c-- ..@x.y", "1.2.3.4a@b.c"]
    texts += ["".join(rng.choice("ab1205 .-+@()") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    for r in pii.report(pii.spans(df)).collect():
        assert tuple(r)[1:6] == brute.pii_row(texts[r.doc_id]), texts[r.doc_id]
    assert pii.spans(odd).count() == odd.count() and pii.report(pii.spans(odd.limit(0))).count() == 0


def test_pii_of_the_method(spark):
    df = spark.createDataFrame([(0, "IBAN DE89 3704 0044 0532 0130 00 x"), (1, "DE88 3704 0044 0532 0130 00"), (2, "ssn 078-05-1120"), (3, "item 078-05-1120"), (4, "078-05-1120")], DOCS)
    got = {r.doc_id: r.spans for r in pii.report(pii.spans(df)).collect()}
    assert got == {0: "iban:5:32", 1: "", 2: "ssn:4:15", 3: "", 4: ""}


def test_words_and_hashes():
    raw = ["Ab c", "", "é  x\n", " ", "Ab"]
    data = np.frombuffer("".join(raw).encode(), np.uint8)
    offs = np.cumsum([0, *[len(t.encode()) for t in raw]])
    s, e, b = words(data, offs, NOT_SPACE)
    assert [data[x:y].tobytes().decode() for x, y in zip(s, e, strict=True)] == ["Ab", "c", "é", "x", "Ab"] and b.tolist() == [0, 2, 2, 4, 4, 5]
    h = Hasher(data)(s, e)
    assert h[0] == h[4] and len(set(h.tolist())) == 4
    assert [x[:2] for x in passes(data, offs, 5)] == [(0, 2), (2, 3), (3, 5)]
    keys = np.random.default_rng(0).integers(-(2**62), 2**62, 5000)
    t = HashTable(keys)
    assert (keys[t.find(keys)] == keys).all() and (t.find(keys + 1) == -1).all() and (HashTable(keys[:0]).find(keys) == -1).all()


def plain_ctw(train, texts, depth):
    """Code lengths by the definition: dictionaries of nodes, block probabilities from the leaves up."""
    from collections import defaultdict
    from math import exp, lgamma, log, pi

    counts = defaultdict(lambda: [0, 0])
    steps = lambda t: [(tuple(([ctw.PAD] * depth + list(t.encode()) + [ctw.END])[i : i + depth]), c) for i, c in enumerate([*t.encode(), ctw.END])]
    for t in train:
        for ctx, c in steps(t):
            for i in range(8):
                for d in range(depth + 1):
                    counts[ctx[depth - d :], i, c >> (8 - i)][c >> (7 - i) & 1] += 1
    logs = {}

    def kt(n):
        return lgamma(n[0] + 0.5) + lgamma(n[1] + 0.5) - lgamma(sum(n) + 1) - log(pi)

    below = defaultdict(float)
    for (ctx, i, pre), n in sorted(counts.items(), key=lambda x: -len(x[0][0])):
        k = kt(n)
        w = k if len(ctx) == depth else log(0.5) + max(k, below[ctx, i, pre]) + log(1 + exp(-abs(k - below[ctx, i, pre])))
        logs[ctx, i, pre] = w
        if ctx:
            below[ctx[1:], i, pre] += w
    out = []
    for t in texts:
        total = 0.0
        for ctx, c in steps(t):
            for i in range(8):
                bit, p = c >> (7 - i) & 1, None
                for d in range(depth, -1, -1):
                    node = (ctx[depth - d :], i, c >> (8 - i))
                    n = counts.get(node, [0, 0])
                    est = (n[bit] + 0.5) / (sum(n) + 1)
                    share = exp(log(0.5) + kt(n) - logs[node]) if node in logs else 0.5
                    p = est if p is None else share * est + (1 - share) * p
                total += log(p) / log(10)
        out.append(total)
    return out


@pytest.mark.parametrize("heads", [(1 << 20, 1 << 20), (5, 40), (0, 0)])
def test_context_tree_weighting_by_the_definition(spark, heads):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["an ", "the ", "ä", "b", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(30)] + ["", None, "zz zz zz"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "the an")]
    held = [k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows]
    train = [t or "" for (_, t), h in zip(rows, held, strict=True) if not h]
    want = plain_ctw(train, [t or "" for _, t in rows], 3)
    tokens = [w for t in train for w in [*[x for x in "".join(c.lower() if c < "\x80" else c for c in t).split()], None]]
    seen = {w: tokens.count(w) for w in set(tokens)}
    base = lambda t: [np.log10((seen.get(w, 0) + 1) / (len(tokens) + len(seen) + 1)) for w in [*t.lower().split(), None]]
    df = spark.createDataFrame(rows, DOCS).coalesce(2)
    got = ctw.score(df, depth=3, head_words=heads[0], head_grams=heads[1]).collect()
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), r[1])
    expected = sorted(((k, h, len((t or "").split()) + 1, sum(w in seen for w in [*(t or "").lower().split(), None]), len(tokens), sum(base(t or "")), s) for (k, t), h, s in zip(rows, held, want, strict=True)), key=key)
    for r, w in zip(sorted(got, key=key), expected, strict=True):
        assert tuple(r)[:5] == w[:5] and np.allclose(r[5:7], w[5:7], atol=1e-8), (r, w)


def test_scores_without_any_rows(spark):
    df = spark.createDataFrame([(1, "a")], DOCS)
    assert ctw.score(df.limit(0)).count() == 0


def labelled(n=400):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "th", "er", "on", "ing", "ou"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(5, 90))]
        y = i % 4 == 0
        if y:
            w[rng.randrange(len(w))] = rng.choice(["idiot", "scum"]) + rng.choice(["", "s"])
        rows.append((i, " ".join(w), int(y)))
    return pd.DataFrame(rows, columns=["k", "text", "y"])


def test_toxicity_learns_and_is_whole(spark, odd):
    seen = labelled()
    net = toxicity.train(seen.head(300), rounds=8)
    rest = seen.tail(100)
    data, offs = toxicity._join(list(rest.text))
    s = net.score(data, offs)
    assert ((s >= 0.3) == (rest.y == 1)).mean() >= 0.85
    far = "anth eron " * 3000 + "idiot " + "anth eron " * 3000
    assert net.score(*toxicity._join([far]))[0] > 0.3
    rows = toxicity.score(odd, net, keep=("token_ids",)).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({round(r.score, 6) for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert toxicity.score(odd.limit(0), net).count() == 0
    assert toxicity.train(seen.head(0)).score(data, offs)[0] == pytest.approx(0.5)


def test_toxicity_gradients():
    seen = labelled(12)
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    t = toxicity.Text(*toxicity._join(list(seen.text)))
    idx, y = t.windows(np.arange(8)), np.array([1, 0, 0, 1, 0, 1, 1, 0.0])
    loss = lambda: -np.log(np.where(y == 1, q := 1 / (1 + np.exp(-net.run(net.gates(net.inputs(t)), idx))), 1 - q)).mean()  # noqa: E731, F821
    grad = net.gradients(t, idx, y, np.ones(8))
    for name in net.p:
        flat, g = net.p[name].reshape(-1), np.asarray(grad[name]).reshape(-1)
        at = int(np.abs(g).argmax())
        old = flat[at]
        flat[at] = old + 1e-3
        up = loss()
        flat[at] = old - 1e-3
        down = loss()
        flat[at] = old
        assert g[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=1e-4), name


def test_factorisation_machine(spark, odd):
    rng = random.Random(1)
    rows = [(" ".join(rng.choice(["an", "the", "of", "then"]) + ("%%%" if y and rng.random() < 0.7 else "") for _ in range(40)), 200.0, int(not y)) for y in (i % 3 == 0 for i in range(300))]
    seen = pd.DataFrame(rows, columns=["text", "n_chars", "y"])
    m = quality.train(seen.head(200))
    data, offs = toxicity._join(list(seen.text))
    found = quality.features(data, offs, seen.n_chars.to_numpy())
    s = m.score(*found)
    assert ((s >= 0.3) == (seen.y == 1))[200:].mean() > 0.97
    row, bucket, value, dense = (x for x in found)
    x = m.scaled(dense)[0]
    mine = row == 0
    w, v = np.concatenate([m.w[bucket[mine]], m.w[quality.BUCKETS :]]), np.concatenate([m.v[bucket[mine]], m.v[quality.BUCKETS :]])
    f = np.concatenate([value[mine], x])
    pairs = sum(f[i] * f[j] * (v[i] @ v[j]) for i in range(len(f)) for j in range(i))
    assert m.raw(*found)[0] == pytest.approx(m.bias + f @ w + pairs)
    rows = quality.score(odd, m, n_chars=None).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows) and quality.score(odd.limit(0), m).count() == 0
    assert quality.train(seen.head(0)).score(*found)[0] == pytest.approx(0.5)


def test_digests_of_nothing():
    assert brute.pii_row(None)[-1] == hashlib.sha256(b"").hexdigest()


def test_bpe_in_little_memory(spark, odd):
    path, rng = P.path("byte_bpe_50k.tiktoken"), random.Random(2)
    own, wide = bpe.Bpe(path, P.PATTERN, 10), bpe.Bpe(path, P.PATTERN)
    few = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(1000)]
    texts = [" ".join(rng.choices(few, k=300)) for _ in range(1000)]
    assert [i for t in texts[:20] for i in own.encode([t, " \n".join(few[:5])])] == [i for t in texts[:20] for i in wide.encode([t, " \n".join(few[:5])])]
    tracemalloc.start()
    own.encode(texts)  # 2 MB; with the words of all texts at once it took 25 MB
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 15e6
    lean = bpe.encode(odd, path, P.PATTERN, decoded=True, at_once=100, remembered=2)
    assert sorted(map(str, lean.collect())) == sorted(map(str, bpe.encode(odd, path, P.PATTERN, decoded=True).collect()))
