"""Plain versions of the contracts, for small inputs."""

import hashlib
import math
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def decontamination(docs, items, width=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOW))
        for j in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[j : j + width])].add(i)
    out = []
    for d, t in docs:
        w = word.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for x, own in windows.items():
            for j in range(len(w) - len(x) + 1):
                if tuple(w[j : j + len(x)]) == x:
                    hit.update(range(j, j + len(x)))
                    found |= own - {None}
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def line_dedup(docs, copies=3, least=20):
    def key(line):
        return line.strip(" \t\n\r\x0b\x0c").translate(LOW)

    where = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                where[key(line)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where[key(x)]) < copies or max(where[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def substrings(docs, width):
    where = defaultdict(int)
    texts = [(t or "").encode() for _, t in docs]
    for b in texts:
        for i in range(len(b) - width + 1):
            where[b[i : i + width]] += 1
    out = []
    for (d, _), b in zip(docs, texts, strict=True):
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if where[b[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def passages(docs, width):
    least = {}
    split = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - width + 1):
            x = tuple(w[i : i + width])
            least[x] = min(least.get(x, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        out.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def top_k(vectors, k, scale=64.0):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in good:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def similar(docs, width=5, num=80, den=100):
    sets = {}
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(d, len(sets[d]), find(d)) for d in sets]


def lexicon(rows, labels, toxicity):
    """{term: weight} that toxicity.learn() must find, one text, class and term after another. Folding and minima are the operator's."""
    own = defaultdict(set)
    for i, label in labels:
        if i is not None and label is not None:
            own[i].add(label)
    label = {i: min(x) for i, x in own.items() if len(x) == 1}
    sample = [(t, label[i]) for i, t in rows if t and i in label]
    texts = sorted({t for t, x in sample if x == 1})
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if any(a == b for a, b in zip(toxicity.minima(toxicity.fold(texts[i])), toxicity.minima(toxicity.fold(texts[j])), strict=True)):
                group = [group[j] if g == group[i] else g for g in group]
    where = defaultdict(set)
    for t, g in zip(texts, group, strict=True):
        for w in toxicity.fold(t).split():
            if len(w) >= 3:
                for term in [f" {w} ", *(f" {w[:n]}" for n in range(4, 8) if len(w) > n)]:
                    where[term].add(g)
    n_pos, negatives, n = sum(x for _, x in sample), [toxicity.fold(t) for t, x in sample if x == 0], len(set(group))
    tested = sum(len(x) >= 3 for x in where.values())
    least = max(3, math.log(100 * max(1, tested)) / math.log((n + len(negatives) + 1) / (n + 0.5)))
    support = {t: len(x) for t, x in where.items() if len(x) >= least}
    out = {}
    for t in sorted(support, key=lambda t: (len(t.rstrip(" ")), t)):
        against = sum(t in x for x in negatives)
        weight = math.log((support[t] + 0.5) / (n_pos + 1)) - math.log((against + 0.5) / (len(negatives) + 1))
        if weight >= math.log(30) and against <= 0.02 * support[t] and not any(t.startswith(x) for x in out if len(x) >= 5):
            more = True
            while more:
                more = [x for x in support if len(x) == len(t) + 1 and x.startswith(t) and support[x] == support[t]]
                if more:
                    t = min(more)
            out[t] = min(8.0, weight)
    base = {f" {t} ": w for t, w in toxicity.TERMS.items()}
    return out | {t: max(w, out.get(t, 0)) for t, w in base.items()}
