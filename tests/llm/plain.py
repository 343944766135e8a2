"""What the operators compute, in plain Python, by the shortest way."""

import hashlib
import re
from collections import Counter, defaultdict

WS = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate(LOW))
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def components(docs):
    sets = [(i, frozenset(shingles(t))) for i, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 80 * len(sets[a][1] | sets[b][1]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)] if s else i) for k, (i, s) in enumerate(sets))


def exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups["".join(c for c in t or "" if c not in WS)].append((-len(t or ""), i))
    return sorted((i, min(g)[1], len(g), i == min(g)[1], hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, i in g)


def line_dedup(docs, least=3):
    held = defaultdict(list)
    key = lambda x: x.strip(WS).translate(LOW)
    for i, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20 and i not in held[k]:
                held[k].append(i)
    gone = lambda i, x: len(h := held.get(key(x), ())) >= least and i < max(h)
    return [(i, "\n".join(kept), len(lines), len(lines) - len(kept)) for i, t in docs for lines in [(t or "").split("\n")] for kept in [[x for x in lines if not gone(i, x)]]]


def phrase_dedup(docs, n=13):
    first = {}
    for i, t in docs:
        w = words(t)
        for s in range(len(w) - n + 1):
            p = tuple(w[s : s + n])
            first[p] = min(i, first.get(p, i))
    out = []
    for i, t in docs:
        w = words(t)
        gone = {s + k for s in range(len(w) - n + 1) if first[tuple(w[s : s + n])] < i for k in range(n)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def byte_dedup(docs, n):
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[s : s + n] for _, b in data for s in range(len(b) - n + 1))
    out = []
    for i, b in data:
        gone = sorted({s + k for s in range(len(b) - n + 1) if seen[b[s : s + n]] > 1 for k in range(n)})
        spans = sum(k == 0 or gone[k] != gone[k - 1] + 1 for k in range(len(gone)))
        drop = set(gone)
        out.append((i, len(b), len(gone), spans, bytes(x for k, x in enumerate(b) if k not in drop)))
    return sorted(out)


def contaminated(docs, items):
    out = set()
    for i, t in docs:
        own, size = shingles(t), len(words(t))
        for item, u in items:
            theirs, n = Counter(shingles(u)), len(words(u))
            m = sum(theirs.values())
            for s in range(max(1, size - n + 1)):  # every window, aligned or not
                mine = Counter(own[s : s + m])
                both = sum((mine & theirs).values())
                if both and both >= 0.8 * sum((mine | theirs).values()):
                    out.add((i, item))
                    break
    return sorted(out)
