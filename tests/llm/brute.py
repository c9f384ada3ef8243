"""Plain Python versions of the operators, for comparison on small tables."""

import hashlib
import re

import xxhash

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(x) if i % 2 == 0 else (int(x) * 2 - 9 if x >= "5" else int(x) * 2) for i, x in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def pii_row(text):
    spans = base_spans(text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (*[sum(s[0] == k for s in spans) for k in BASE], hashlib.sha256(joined.encode()).hexdigest())


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_rows(docs):
    """docs: (key, text) pairs; sorted (key, fingerprint, component) rows."""
    fp = [fingerprint(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return [(k, f"{fp[i]:016x}", least.get(root(i))) for i, (k, _) in enumerate(docs)]
