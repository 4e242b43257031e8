"""Plain versions of the operators, for small inputs."""

import hashlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NO_ID = 2**63 - 1


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def ordered(rows):
    return sorted(tuple(NO_ID if v is None and i == 0 else v for i, v in enumerate(r)) for r in map(tuple, rows))


def words(text):
    return (text or "").encode().split()


def passages(rows, size=35):
    places = defaultdict(list)
    for r, (_, text) in enumerate(rows):
        w = words(text)
        for i in range(len(w) - size + 1):
            places[b" ".join(w[i : i + size])].append((r, i))
    gone = defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            for r, i in found:
                gone[r].update(range(i, i + size))
    out = []
    for r, (doc_id, text) in enumerate(rows):
        w = words(text)
        kept = [x for i, x in enumerate(w) if i not in gone[r]]
        out.append((doc_id, len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return ordered(out)


def byte_repeats(rows, size=100):
    """For rows of different ids."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: NO_ID if r[0] is None else r[0]):
        data = (text or "").encode()
        marks = [0] * (len(data) + 1)
        for i in range(len(data) - size + 1):
            if data[i : i + size] in seen:
                marks[i] += 1
                marks[i + size] -= 1
            seen.add(data[i : i + size])
        kept, depth, spans, inside = bytearray(), 0, 0, False
        for i, byte in enumerate(data):
            depth += marks[i]
            if depth == 0:
                kept.append(byte)
            spans += depth > 0 and not inside
            inside = depth > 0
        out.append((doc_id, len(data), len(data) - len(kept), spans, sha(bytes(kept))))
    return ordered(out)


def shingles(text, size=5):
    w = [x.decode() for x in words((text or "").translate(LOWER))]
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near(rows):
    """For rows of any ids; all pairs that share a shingle. Rows are linked, ids name components."""
    sets = [(NO_ID if d is None else d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    shared = Counter()
    for found in holders.values():
        for i, a in enumerate(found):
            for b in found[:i]:
                shared[b, a] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    least = {}
    for k, (d, _) in enumerate(sets):
        least[root(k)] = min(d, least.get(root(k), NO_ID))
    return sorted((d, len(s), least[root(k)], least[root(k)] == d) for k, (d, s) in enumerate(sets))


def best_score(text: bytes, scores: dict[bytes, float]) -> float:
    """The largest sum of piece scores over all segmentations."""
    best = [0.0] + [float("-inf")] * len(text)
    longest = max(map(len, scores))
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - longest), end):
            score = scores.get(text[begin:end])
            if score is not None:
                best[end] = max(best[end], best[begin] + score)
    return best[-1]


def tiles(item, text, least):
    """Greedy string tiling over all pairs of places: longest first, then first in the item, then first in the text."""
    item_free, text_free, found = [True] * len(item), [True] * len(text), []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(text)):
                n = 0
                while a + n < len(item) and b + n < len(text) and item_free[a + n] and text_free[b + n] and item[a + n] == text[b + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return found
        found.append(best)
        a, b, n = best
        for k in range(n):
            item_free[a + k] = text_free[b + k] = False
