"""Plain single-process versions of the operators' contracts, for small fixtures."""

import hashlib
import itertools
import math
import re
import statistics
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def substring_dedup(docs, length=400):
    seen = defaultdict(int)
    raw = [(i, (t or "").encode()) for i, t in docs]
    for _, b in raw:
        for s in range(len(b) - length + 1):
            seen[b[s:s + length]] += 1
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def shingle_set(text, k=5):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def near_dup(docs, similar=85):
    """(id, set size, component) by comparing all pairs that share a shingle."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(k)
    pairs = Counter((a, b) for ks in by.values() for n, a in enumerate(ks) for b in ks[n + 1:])
    for (a, b), inter in pairs.items():
        if 100 * inter >= similar * (len(sets[a][1]) + len(sets[b][1]) - inter):
            x, y = sorted((root(sets[a][0]), root(sets[b][0])))
            parent[y] = x
    return sorted((i, len(s), root(i)) for i, s in sets)


def secrets(text):
    text = text or ""
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def random_spans(texts):
    """The ``random`` spans of all texts: every run is tested by itself, then the probabilities of
    a length class are sorted and the usual false-discovery rule names the last one accepted."""
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = [num + low[:6], num + up[:6], up + "234567", low, up, num + low, num + up, num + up + low,
                 up + low + num + "+/", up + low + num + "-_", up + low + num + "+/-_"]
    normal = statistics.NormalDist()

    def chance(run):
        which, letters = next((i, a) for i, a in enumerate(alphabets) if not set(run) - set(a))
        n, k = len(run), len(letters)
        x = [letters.index(c) for c in run]
        counts = [x.count(v) for v in range(k)]
        chi = sum((c - n / k) ** 2 / (n / k) for c in counts)
        p1 = 1 - normal.cdf(((chi / (k - 1)) ** (1 / 3) - 1 + 2 / 9 / (k - 1)) / (2 / 9 / (k - 1)) ** 0.5)
        high = "".join("+" if 2 * v >= k else "-" for v in x)
        a, b = high.count("+"), high.count("-")
        if a and b:
            mean = 1 + 2 * a * b / n
            var = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
            runs = len(list(itertools.groupby(high)))
            p2 = 2 * normal.cdf(-abs(runs - mean) / var ** 0.5) if var > 0 else 1
        else:
            p2 = 2 * 0.5 ** n
        mid = sum(x) / n
        power = sum((v - mid) ** 2 for v in x)
        p3 = 2 * normal.cdf(-abs(sum((u - mid) * (v - mid) for u, v in zip(x, x[1:])) / power + 1 / n) * n ** 0.5) if power else 0
        if 3 * min(p1, p2, p3) < 0.001:
            return None
        if which < 2:
            return 0.3 ** n
        seen = sum(c * (c - 1) for c in counts) / (n * (n - 1))
        var = (2 * 0.065 * 0.935 + 4 * (n - 2) * (0.0056 - 0.065 ** 2)) / (n * (n - 1))
        p = normal.cdf((seen - 0.065) / var ** 0.5)
        if which in (3, 4):
            return p
        kinds = "".join("a" if c in low else "A" if c in up else "0" if c in num else "-" for c in run)
        turned = sum(len(set(pair)) == 2 and pair != "Aa" for pair in map("".join, zip(kinds, kinds[1:])))
        p *= sum(math.comb(n - 1, i) * 0.2 ** i * 0.8 ** (n - 1 - i) for i in range(turned, n))
        return p * (1 - math.log(p))

    seen = []
    for i, text in enumerate(texts):
        base = secrets(text)
        for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text or ""):
            if all(e <= m.start() or m.end() <= s for s, _, e in base):
                p = chance(m[0])
                if p is not None:
                    step = 320 if p <= 1e-16 else int(-math.log10(p) * 20)
                    seen.append((sum(len(m[0]) >= x for x in (20, 28, 40, 64, 128)), 10 ** (-step / 20), i, m.start(), m.end()))
    out = set()
    for c in {x[0] for x in seen}:
        own = sorted(x[1:] for x in seen if x[0] == c)
        good = [p for rank, (p, *_) in enumerate(own, 1) if p <= 0.01 * rank / len(own)]
        out |= {(i, s, e) for p, i, s, e in own if good and p <= good[-1]}
    return out


def ranked_search(docs, items, k=50):
    """(item, rank, doc, score) by scoring every document for every item."""
    low = lambda t: TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    rows = [(i, Counter(w), len(w)) for i, w in ((i, low(t)) for i, t in docs) if w]
    n, words = len(rows), sum(r[2] for r in rows)
    df = Counter(t for _, tf, _ in rows for t in tf)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(low(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, tf, size in rows:
            m = 50 + (50 * size * n) // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in terms if t in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def merkle(rows, tampered, change):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of ``doc_id, source, lang, n_chars, text`` rows."""
    def h(*x):
        return hashlib.sha256("".join(x).encode()).hexdigest()

    def leaf(*values):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def climb(level):
        """Root and, per leaf, the (left, right) siblings of each level."""
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for k, path in enumerate(paths):
                run = at[k] // 3 * 3
                path.append((level[run:at[k]], level[at[k] + 1:run + 3]))
                at[k] //= 3
            level = [h(*level[i:i + 3]) for i in range(0, len(level), 3)]
        return level[0], paths

    groups = defaultdict(list)
    for r in rows:
        seen = leaf(*r[:4], change(r[4])) if tampered(r[0]) else leaf(*r)
        groups[(r[1] is not None, (r[1] or "").encode())].append((r[0] is not None, r[0] or 0, leaf(*r), r[0], seen))
    names = sorted(groups)
    done = [climb([x[2] for x in sorted(groups[g])]) for g in names]
    if not names:
        return []
    root, above = climb([d[0] for d in done])
    out = []
    for g, (sub, paths), up in zip(names, done, above):
        for x, path in zip(sorted(groups[g]), paths):
            fold, proof = x[4], ""
            for left, right in path + up:
                proof += "".join(left + right)
                fold = h(*left, fold, *right)
            out.append((x[3], x[2], sub, root, h(proof), fold, fold == root))
    return sorted(out, key=str)
