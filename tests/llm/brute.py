"""Plain Python versions of the operators, quadratic where that is simplest."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def key(i):
    return (i is None, i or 0)


def contamination(docs, items, window=13):
    held = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            held[tuple(w[k : k + n])].add(None if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, ids = ALNUM.findall(lower(t)), set(), set()
        for n in {len(k) for k in held}:
            for k in range(len(w) - n + 1):
                if (own := held.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    ids |= own - {None}
        out.append((d, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def substrings(docs, window):
    first = {}
    split = [(d, SPACE.findall(t or "")) for d, t in docs]
    for d, w in split:
        for k in range(len(w) - window + 1):
            s = tuple(w[k : k + window])
            first[s] = min(first.get(s, key(d)), key(d))
    out = []
    for d, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < key(d):
                gone |= set(range(k, k + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def suffixes(docs, length):
    raw = [(d, (t or "").encode()) for d, t in docs]
    n = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if n[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def fingerprint(t, shingle):
    w = SPACE.findall(lower(t))
    if not w:
        return 0
    parts = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))]
    n = Counter(b for p in parts for h in [xxhash.xxh64_intdigest(p.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * n[b] > len(parts))


def simhash(docs, shingle=4, radius=4):
    prints = [fingerprint(t, shingle) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(docs)], [find(i) for i in range(len(docs))]


def base_statistics(t):
    t = t or ""
    w = SPACE.findall(t)
    n = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    again = {i for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for i in (k, k + 1, k + 2)}
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))


def outliers(rows, floor, grid=32, distance_grid=16, h=0.75, own=50.0, chi2_median=3.3567):
    """rows: (lang, source, vector). The squared distance of each, by plain NumPy over boxes of equal vectors."""
    names = [((a, b), (a,), ()) for a, b, _ in rows]
    groups = defaultdict(list)
    for k, g in enumerate(names):
        for x in g:
            groups[x].append(k)

    def quantile(bins, n, q):
        order = np.argsort(bins, kind="stable")
        upto = np.cumsum(n[order])
        return bins[order][np.flatnonzero(upto >= upto[-1] * q)[0]]

    def distances(x, m, v):
        return np.maximum(((x - m) @ np.linalg.inv(v) * (x - m)).sum(axis=1), 1e-6)

    def least(own_rows):
        x = np.array([rows[k][2] for k in own_rows])
        box, back = np.unique(np.floor(x * grid), axis=0, return_inverse=True)
        back = back.ravel()
        n = np.bincount(back)
        mean = np.array([x[back == b].mean(axis=0) for b in range(len(box))])

        def estimate(some):
            part = x[some[back]]
            return part.mean(axis=0), np.cov(part.T, bias=True) + np.diag(np.square(floor))

        m = np.array([(quantile(box[:, k], n, 0.5) + 0.5) / grid for k in range(x.shape[1])])
        s = np.array([(quantile(np.floor(np.abs(mean[:, k] - m[k]) * grid), n, 0.5) + 0.5) / grid for k in range(x.shape[1])])
        starts = [(m, np.diag(np.maximum(1.4826 * s, floor) ** 2)), estimate(np.ones(len(box), bool))]
        starts += [estimate(some) for r in (0, 1) if (some := box.sum(axis=1) % 2 == r).any()]
        found = []
        for k, (m, v) in enumerate(starts):
            def step(m, v):
                at = np.floor(np.log(distances(mean, m, v)) * distance_grid)
                return estimate(at <= quantile(at, n, h))

            m, v = step(m, v)
            while np.linalg.slogdet((after := step(m, v))[1])[1] < np.linalg.slogdet(v)[1] - 1e-9:
                m, v = after
            found.append((round(np.linalg.slogdet(v)[1], 9), k, m, v))
        _, _, m, v = min(found, key=lambda f: f[:2])
        half = quantile(np.floor(np.log(distances(mean, m, v)) * distance_grid), n, 0.5)
        return len(x), m, v * max(1.0, np.exp((half + 0.5) / distance_grid) / chi2_median)

    levels = {g: least(own_rows) for g, own_rows in groups.items()}

    def shrunk(g):
        n, m, v = levels[g]
        _, m2, v2 = levels[()] if len(g) < 2 else shrunk(g[:1])
        share = own / (n + own)
        return n, m + share * (m2 - m), v + share * (v2 - v)

    return [distances(np.array([x]), *shrunk((a, b))[1:])[0] for a, b, x in rows]


def mixing(docs, weights=(1, 2, 3), epochs=3):
    """docs: (doc_id, text, source). (target by source, {(doc_id, size): taken}) by refilling until no source is above its stop."""
    size = Counter()
    for _, t, s in docs:
        size[s] += len(SPACE.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        rest = sum(w[s] for s in order if s not in full)
        left = total - sum(epochs * size[s] for s in full)
        target = {s: epochs * size[s] if s in full else left * w[s] / rest for s in order}
        over = {s for s in order if s not in full and target[s] > epochs * size[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for s in order:
        need = min(round(target[s]), epochs * size[s])
        own = sorted(((hashlib.md5(("null" + (t or "") if d is None else str(d)).encode()).hexdigest(), d, len(SPACE.findall(t or ""))) for d, t, x in docs if x == s), key=lambda r: (r[0], r[2]))
        rounds, rest = divmod(need, size[s]) if size[s] else (0, 0)
        at = 0
        for _, d, n in own:
            taken[d] += rounds * n + max(0, min(at + n, rest) - at)
            at += n
    return target, taken


def lines_of(t):
    return [tuple(w) for x in (t or "").split("\n") if (w := SPACE.findall(x))]


def patience(a, b, lo=0, hi=None, lo2=0, hi2=None):
    """Places of a that patience diff aligns with b, by recursion."""
    hi, hi2 = len(a) if hi is None else hi, len(b) if hi2 is None else hi2
    if lo >= hi or lo2 >= hi2:
        return set()
    if a[lo] == b[lo2]:
        return {lo} | patience(a, b, lo + 1, hi, lo2 + 1, hi2)
    if a[hi - 1] == b[hi2 - 1]:
        return {hi - 1} | patience(a, b, lo, hi - 1, lo2, hi2 - 1)
    own, other = a[lo:hi], b[lo2:hi2]
    pairs = [(lo + i, lo2 + other.index(x)) for i, x in enumerate(own) if own.count(x) == 1 and other.count(x) == 1]
    size, back = [], []
    for k, (_, j) in enumerate(pairs):
        size.append(1 + max((size[x] for x in range(k) if pairs[x][1] < j), default=0))
        back.append(max((x for x in range(k) if size[x] == size[k] - 1 and pairs[x][1] < j), default=-1))
    chain, k = [], max((k for k in range(len(pairs)) if size[k] == max(size)), default=-1)
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    if not pairs:
        chain = [(lo + i, lo2 + other.index(x)) for i, x in enumerate(own) if x in other][:1]
    if not chain:
        return set()
    edges = [(lo - 1, lo2 - 1), *reversed(chain), (hi, hi2)]
    return {i for i, _ in chain}.union(*(patience(a, b, i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(edges, edges[1:])))


def around(own):
    """Neighbouring lines, ends included, then each line with the number of its occurrence."""
    ends = ["start", *own, "end"]
    return [*zip(ends, ends[1:]), *((x, own[:p].count(x)) for p, x in enumerate(own))]


def line_dedup(docs, every_pair=False):
    """docs: (doc_id, text). Kept text, lines and deleted lines of each, by the operator's definition; or aligned with every earlier document.

    The two differ where a line is covered by an alignment of the definition only, or by one with a document that it does not try:
    it tries every holder of a line that stays uncovered, so both delete the same lines.
    """
    rows = {(key(d), t or ""): lines_of(t) for d, t in docs}
    known, pairs = {}, {}
    order = sorted(rows, key=lambda r: (r[0], xx(r[1])))
    for r in order:
        for x in set(rows[r]):
            known.setdefault(x, []).append(r)
        for x in set(around(rows[r])):
            pairs.setdefault(x, r)
    place = {r: k for k, r in enumerate(order)}
    gone = {r: set() for r in rows}
    for r in order:
        own = rows[r]
        shared = [(p, known[x]) for p, x in enumerate(own) if known[x][0] != r]

        def align(partners):
            for b in partners:
                gone[r].update(patience(own, rows[b]))

        if every_pair:
            align({b for _, held in shared for b in held if place[b] < place[r]})
            continue
        partners, run = set(), []
        for p, held in [*shared, (1 << 60, None)]:
            if run and p != run[-1][0] + 1:
                partners.add(min(run, key=lambda x: (len(x[1]), x[0]))[1][0])
                run = []
            run.append((p, held))
        align(partners)
        align({held[0] for p, held in shared if p not in gone[r]})
        left = [p for p, _ in shared if p not in gone[r]]
        keys = around(own)
        align({b for p in left for x in (keys[p], keys[p + 1], keys[len(own) + 1 + p]) if place[b := pairs[x]] < place[r]})
        align({b for p in left if p not in gone[r] for b in known[own[p]] if place[b] < place[r]})
    out = []
    for d, t in docs:
        cut, k, kept = gone[key(d), t or ""], -1, []
        for x in (t or "").split("\n"):
            k += bool(SPACE.search(x))
            if not (SPACE.search(x) and k in cut):
                kept.append(x)
        out.append((d, None if t is None else "\n".join(kept), len(lines_of(t)), len(cut)))
    return out


def xx(t):
    h = xxhash.xxh64_intdigest(t.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def quality_features(t):
    """The sixteen statistics, one plain count after another."""
    b = (t or "").encode()
    w = [x.encode() for x in SPACE.findall(t or "")]
    lines = [x for x in b.split(b"\n") if x]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    count = lambda own: sum(b.count(bytes([c])) for c in own)
    part = lambda x, of, scale: math.log1p(scale * x / max(of, 1))
    upper, ink = count(range(65, 91)), max(len(b) - count(b" \t\n\x0b\f\r"), 1)
    sizes = [len(x) for x in w]
    mean = sum(sizes) / max(len(w), 1)
    entropy = -sum(n / len(b) * math.log(n / len(b)) for n in Counter(b).values()) if b else 0.0
    return [
        math.log1p(len(w)), math.log1p(mean), math.log1p(math.sqrt(max(sum(x * x for x in sizes) / max(len(w), 1) - mean**2, 0))),
        part(upper, upper + count(range(97, 123)) + count(range(192, 256)), 20), part(count(b"#*$%&<>@~^=+_\\/"), ink, 50), part(count(b"!"), ink, 50),
        part(count(b"0123456789"), ink, 50), part(count(b".,;:?'\"()-"), ink, 20), part(count(b"\n"), max(len(w), 1), 50), part(count(range(128, 192)), ink, 10), entropy,
        math.log1p(len(set(w))) / math.log1p(max(len(w), 1)), part(len(grams) - len(set(grams)), len(grams), 20), part(len(lines) - len(set(lines)), len(lines), 20),
        part(count(b"|"), ink, 50), part(sum(x <= 2 for x in sizes), max(len(w), 1), 5),
    ]


def discriminant(rows, shrink=0.5, diagonal=0.02, ridge=1e-3, temperature=2.0):
    """rows: (features, label or None). The score of each from the labelled ones, by densities with inverse matrices."""
    x = np.array([r[0] for r in rows])
    own = {k: x[[r[1] == k for r in rows]] for k in (0, 1)}
    total = sum(map(len, own.values()))
    cov = {k: np.cov(v.T, bias=True) for k, v in own.items()}
    pooled = sum(len(own[k]) * cov[k] for k in own) / total
    logs = []
    for k, v in own.items():
        a = shrink + (1 - shrink) / (1 + len(v) / x.shape[1])
        s = (1 - a) * cov[k] + a * pooled
        s = (1 - diagonal) * s + np.diag(diagonal * np.diag(s) + ridge)
        off = x - v.mean(axis=0)
        logs.append(math.log(len(v) / total) - 0.5 * ((off @ np.linalg.inv(s) * off).sum(axis=1) + np.linalg.slogdet(s)[1]))
    return 1 / (1 + np.exp((logs[0] - logs[1]) / temperature))


class KneserNey:
    """An interpolated model of one language in dictionaries; characters are padded at the start by None."""

    def __init__(self, texts, order, size):
        self.order, self.size = order, size
        grams = Counter()
        for t in texts:
            c = [None] * (order - 1) + list(lower(t))
            grams.update(tuple(c[k : k + order]) for k in range(len(t)))
        self.counts = {order: grams}
        for o in range(order - 1, 0, -1):
            self.counts[o] = Counter(g[1:] for g in self.counts[o + 1])
        self.totals, self.kinds, self.discount = {}, {}, {}
        for o, own in self.counts.items():
            n = Counter(own.values())
            self.discount[o] = min(max(n[1] / max(n[1] + 2 * n[2], 1), 0.1), 0.95)
            self.totals[o], self.kinds[o] = Counter(), Counter()
            for g, k in own.items():
                self.totals[o][g[:-1]] += k
                self.kinds[o][g[:-1]] += 1

    def prob(self, gram):
        o = len(gram)
        if o == 0:
            return 1 / self.size
        below, d, total = self.prob(gram[1:]), self.discount[o], self.totals[o][gram[:-1]]
        if not total:
            return below
        return max(self.counts[o][gram] - d, 0) / total + d * self.kinds[o][gram[:-1]] / total * below

    def loss(self, t):
        c = [None] * (self.order - 1) + list(lower(t))
        return -sum(math.log(self.prob(tuple(c[k : k + self.order]))) for k in range(len(t)))


def similar(texts, shingle=5):
    """The component of each text, by Jaccard similarity of 0.8 or more of its sets of shingles."""
    own = [{tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if (w := SPACE.findall(lower(t))) else set() for t in texts]
    up = list(range(len(own)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(own):
        for j, b in enumerate(own[:i]):
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                up[find(i)] = find(j)
    return [find(i) for i in range(len(own))]
