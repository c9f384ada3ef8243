"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A word's input is the sum of a vector for the whole word and the mean of vectors for its byte n-grams (inner, first and
last ones), all by hash. Windows of WIDTH words, STEP apart and so overlapping, cover the whole text; each is read in both
directions and pooled by attention. A text's score is that of its worst window. Training sees, for each text of a bounded
sample of labelled ones, its worst window by the network so far and a few others.

What a word adds to the gates does not depend on its place, so it is worked out once for each distinct word of a pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .fitting import shift
from .runtime import LOWER, WORDLIKE, Hasher, hashed_words, lean, mix, passes, utf8

WIDTH, STEP = 32, 24
WORDS, GRAMS, DIM, HIDDEN, ATTEND = 1 << 13, 1 << 14, 16, 10, 8
SIZES = (3, 5)
#: At most so many texts of each class are trained on, none longer than this many characters.
MOST, LONGEST = 1500, 20_000
BLOCK = 2048
#: Steps of training, about, that even a few texts get.
LEAST_STEPS = 240


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 / (1 + np.exp(-2 * x)) - 1


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its end, one range behind the other."""
    n = ends - starts
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Text:
    """Rows of text as windows over their distinct words."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        parts = [self._part(part, o) for _, _, part, o in passes(data, offs)]
        parts = parts or [self._part(data, offs)]
        names = np.concatenate([p[0] for p in parts])
        # each word's n-grams are those from the pass that has it first
        self.names, first, inv = np.unique(names, return_index=True, return_inverse=True)
        begin = np.cumsum([0, *[len(p[0]) for p in parts]])
        self.word = np.append(np.concatenate([inv[b + p[1]] for b, p in zip(begin, parts, strict=False)]), -1).astype(np.int32)
        sizes, grams = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
        ends = np.cumsum(sizes)
        n = sizes[first]
        self.gram_bounds = np.concatenate([[0], np.cumsum(n)])
        self.gram = grams[np.repeat((ends - sizes)[first] - self.gram_bounds[:-1], n) + np.arange(n.sum())]
        self.whole = (self.names & np.uint64(WORDS - 1)).astype(np.int64)
        n = np.concatenate([p[2] for p in parts])
        wb = np.concatenate([[0], np.cumsum(n)])
        per = 1 + np.maximum(0, -(-(n - WIDTH) // STEP))  # at least one window, the empty one
        self.row = np.repeat(np.arange(len(n)), per)
        self.bounds = np.concatenate([[0], np.cumsum(per)])
        self.start = wb[:-1][self.row] + (np.arange(len(self.row)) - self.bounds[:-1][self.row]) * STEP
        self.size = np.minimum(WIDTH, wb[1:][self.row] - self.start)

    @staticmethod
    def _part(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of a pass: distinct words, each word's place among them, words of each row, n-grams of each distinct word, and
        these n-grams' places among the vectors."""
        lower = LOWER[data]
        s, e, h, wb = hashed_words(lower, offs, WORDLIKE)
        names, first, inv = np.unique(h, return_index=True, return_inverse=True)
        # from here on only the distinct words, put one behind the other
        lower, e = lower[_ranges(s[first], e[first])], np.cumsum(e[first] - s[first])
        s = np.concatenate([[0], e[:-1]])
        hasher = Hasher(lower)
        of, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in SIZES:
            w = np.flatnonzero(e - s >= n)
            count = (e - s)[w] - n + 1
            rep = np.repeat(w, count)
            begin = s[rep] + np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count)
            for kind, (x, b) in enumerate(((rep, begin), (w, s[w]), (w, e[w] - n))):  # any, the first, the last
                of.append(x)
                at.append((mix(hasher(b, b + n) + np.uint64(kind)) & np.uint64(GRAMS - 1)).astype(np.int64))
        of, at = np.concatenate(of), np.concatenate(at)
        return names, inv, np.diff(wb), np.bincount(of, minlength=len(names)), at[np.argsort(of, kind="stable")]

    def windows(self, pick: np.ndarray) -> np.ndarray:
        """The chosen windows' words, -1 beyond a window's end."""
        cols = np.arange(WIDTH)
        at = np.where(cols < self.size[pick][:, None], self.start[pick][:, None] + cols, len(self.word) - 1)
        return self.word[at]


class Network:
    """The weights. Directions are stacked: forwards, backwards."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        normal = lambda scale, *shape: r.normal(0, scale, shape).astype(np.float32)
        self.p = {
            "word": normal(0.1, WORDS, DIM), "gram": normal(0.1, GRAMS, DIM),
            "into": normal(DIM**-0.5, 2, DIM, 3 * HIDDEN), "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32), "turn": normal(HIDDEN**-0.5, 2, HIDDEN, 3 * HIDDEN),
            "look": normal((2 * HIDDEN) ** -0.5, 2 * HIDDEN, ATTEND), "seek": normal(ATTEND**-0.5, ATTEND), "out": normal((2 * HIDDEN) ** -0.5, 2 * HIDDEN), "off": np.zeros(1, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, t: Text, pick: np.ndarray | None = None) -> np.ndarray:
        """Input vectors of the distinct words, of those in pick alone if given."""
        a, b = t.gram_bounds[:-1], t.gram_bounds[1:]
        if pick is not None:
            a, b = a[pick], b[pick]
        n = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else a, n) + np.arange(n.sum())
        sums = np.zeros((len(n), DIM), np.float32)
        some = np.flatnonzero(n)
        if len(some):
            sums[some] = np.add.reduceat(self.p["gram"][t.gram[at]], (np.cumsum(n) - n)[some], axis=0)
        return self.p["word"][t.whole if pick is None else t.whole[pick]] + sums / np.maximum(n, 1)[:, None].astype(np.float32)

    def run(self, gates: np.ndarray, idx: np.ndarray, keep: bool = False):
        """Log odds of windows. gates: what each distinct word adds, a last row of zeros for -1; by direction."""
        n, p = len(idx), self.p
        mask = (idx >= 0).astype(np.float32)
        h = np.zeros((2, n, HIDDEN), np.float32)
        states, kept = np.empty((WIDTH, n, 2 * HIDDEN), np.float32), []
        for t in range(WIDTH):
            u = WIDTH - 1 - t
            g = np.stack([gates[0][idx[:, t]], gates[1][idx[:, u]]])
            q = h @ p["turn"]
            zr = _sigmoid(g[..., : 2 * HIDDEN] + q[..., : 2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            c = _tanh(g[..., 2 * HIDDEN :] + r * q[..., 2 * HIDDEN :])
            m = np.stack([mask[:, t], mask[:, u]])[..., None]
            new = (c + z * (h - c)) * m
            if keep:
                kept.append((h, z, r, c, q[..., 2 * HIDDEN :], m))
            h = new
            states[t, :, :HIDDEN], states[u, :, HIDDEN:] = h[0], h[1]
        a = _tanh(states @ p["look"])
        e = a @ p["seek"] - 1e4 * (1 - mask.T)
        e = np.exp(e - e.max(0))
        alpha = e / e.sum(0)
        pooled = (alpha[..., None] * states).sum(0)
        logit = pooled @ p["out"] + p["off"][0]
        return (logit, (states, a, alpha, pooled, kept)) if keep else logit

    def gates(self, x: np.ndarray) -> np.ndarray:
        g = x @ self.p["into"] + self.p["bias"]
        return np.concatenate([g, np.zeros((2, 1, 3 * HIDDEN), np.float32)], 1)

    def logits(self, t: Text) -> np.ndarray:
        """Log odds of all windows."""
        gates = self.gates(self.inputs(t))
        return np.concatenate([self.run(gates, t.windows(np.arange(i, min(i + BLOCK, len(t.row))))) for i in range(0, len(t.row), BLOCK)])

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Scores of rows of text: of each, its worst window's."""
        t = Text(data, offs)
        worst = np.maximum.reduceat(self.logits(t), t.bounds[:-1]) if len(offs) > 1 else np.zeros(0)
        return _sigmoid(np.clip(worst.astype(float) * self.scale + self.shift, -30, 30))

    def gradients(self, t: Text, idx: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss of windows."""
        p, n = self.p, len(idx)
        pick, inv = np.unique(idx, return_inverse=True)
        inv = inv.reshape(idx.shape)
        if pick[0] < 0:  # padding becomes the last row
            pick, inv = pick[1:], inv - 1
        x = self.inputs(t, pick)
        gates = self.gates(x)
        logit, (states, a, alpha, pooled, kept) = self.run(gates, inv, True)
        d = ((_sigmoid(logit) - y) * weight / n).astype(np.float32)
        g = {"out": pooled.T @ d, "off": d.sum(keepdims=True)}
        dp = d[:, None] * p["out"]
        dalpha = (states * dp).sum(2)
        de = alpha * (dalpha - (alpha * dalpha).sum(0))
        g["seek"] = np.einsum("tn,tna->a", de, a)
        da = de[..., None] * p["seek"] * (1 - a * a)
        g["look"] = states.reshape(-1, 2 * HIDDEN).T @ da.reshape(-1, ATTEND)
        ds = alpha[..., None] * dp + da @ p["look"].T
        g["turn"], dg = np.zeros_like(p["turn"]), np.zeros_like(gates)
        dh = np.zeros((2, n, HIDDEN), np.float32)
        for s in range(WIDTH - 1, -1, -1):
            u = WIDTH - 1 - s
            h, z, r, c, qn, m = kept[s]
            dh = (dh + np.stack([ds[s, :, :HIDDEN], ds[u, :, HIDDEN:]])) * m
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * qn * r * (1 - r)
            into = np.concatenate([dz, dr, dc], 2)
            back = np.concatenate([dz, dr, dc * r], 2)
            g["turn"] += h.transpose(0, 2, 1) @ back
            np.add.at(dg[0], inv[:, s], into[0])
            np.add.at(dg[1], inv[:, u], into[1])
            dh = dh * z + back @ p["turn"].transpose(0, 2, 1)
        dg = dg[:, :-1]
        g["bias"] = dg.sum(1, keepdims=True)
        g["into"] = x.T @ dg
        dx = (dg @ p["into"].transpose(0, 2, 1)).sum(0)
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], t.whole[pick], dx)
        lo, size = t.gram_bounds[pick], t.gram_bounds[pick + 1] - t.gram_bounds[pick]
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        np.add.at(g["gram"], t.gram[at], np.repeat(dx / np.maximum(size, 1)[:, None], size, 0))
        return g


def _join(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)


def train(texts: pd.DataFrame, rounds: int = 10, rate: float = 0.01, batch: int = 256, seed: int = 5) -> Network:
    """Fit a network to a frame of text and y. With one class only (or no text) all scores are that class's share."""
    y = texts["y"].to_numpy(float)
    net, rng = Network(seed), np.random.default_rng(seed)
    if not len(y) or y.min() == y.max():
        net.scale, net.shift = 0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return net
    t = Text(*_join(list(texts["text"])))
    m1, m2, step = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    logits = rng.normal(size=len(t.row))
    # few texts are seen in smaller batches and more rounds
    batch = int(np.clip(len(y) // 8, 32, batch))
    rounds = max(rounds, -(-LEAST_STEPS * batch // (2 * len(y))))
    for k in range(rounds):
        order = np.lexsort((-logits, t.row))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - t.bounds[:-1][t.row[order]]
        label = y[t.row]
        # of toxic texts at first several windows, then the worst one; of others also some by chance
        chosen = np.flatnonzero(np.where(label == 1, rank < (4 if k < rounds * 0.2 else 2 if k < rounds * 0.5 else 1), (rank < 2) | (rng.random(len(rank)) < 0.02)))
        share = label[chosen].mean()
        weight = np.where(label[chosen] == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.7
        mixed = rng.permutation(len(chosen))
        for i in range(0, len(mixed), batch):
            at = mixed[i : i + batch]
            step += 1
            pace = rate * min(1.0, 1.5 * (1 - (k + i / len(mixed)) / rounds) + 0.05)
            for name, d in net.gradients(t, t.windows(chosen[at]), label[chosen[at]], weight[at]).items():
                m1[name] += 0.1 * (d - m1[name])
                m2[name] += 0.002 * (d * d - m2[name])
                net.p[name] -= (pace * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.998**step)) + 1e-7)).astype(np.float32)
                if name in ("word", "gram"):
                    net.p[name] *= np.float32(1 - 0.02 * pace)
        logits = net.logits(t)
    worst = np.maximum.reduceat(logits, t.bounds[:-1]).astype(float)
    for _ in range(200):  # scores are fitted to whole texts by scale and shift
        q = _sigmoid(np.clip(worst * net.scale + net.shift, -30, 30)) - y
        net.shift -= 0.5 * q.mean()
        net.scale = max(0.1, net.scale - 0.05 * float((q * worst).mean()))
    net.shift += shift(texts, y)
    return net


def score(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, score (0 to 1) and the columns in keep for each row of docs. Null texts are scored as empty: one window without
    words."""
    sent = docs.sparkSession.sparkContext.broadcast(net)  # some MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column(0))
            out = [sent.value.score(part, o) for _, _, part, o in passes(data, offs)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else np.zeros(0))], [*batch.schema.names, "score"])

    cols = [docs[text].cast("string").alias("t"), docs[key].alias("k"), *[docs[c].alias(f"x{i}") for i, c in enumerate(keep)]]
    picked = docs.select(*cols)
    made = picked.mapInArrow(lean(run), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.schema) + ", score double")
    return made.select(made["k"].alias(key), "score", *[made[f"x{i}"].alias(c) for i, c in enumerate(keep)])
