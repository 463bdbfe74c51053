"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re

#: Null, empty, blank, ties, repeated rows, a null id, and one very long text.
ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one two three four", "b"), (4, "one two three four", "b"),
       (None, "one two three four", "b"), (5, "word " * 30_000, None), (6, "one two three five", "")]

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(n, linked):
    """For each of n things the smallest one reached through links."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(text, shingle=3, seed=42):
    import xxhash
    words = WORD.findall(lower_ascii(text))
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def base_quality(text):
    text = text or ""
    words = WORD.findall(text)
    starts = {}
    for i in range(len(words) - 7):
        starts.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for s in starts.values() if len(s) > 1 for i in s for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def phrases(text, table):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))
    starts, labels = [], set()
    for phrase, label in table.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def targets(sizes, weights=(5, 2, 1), budget=1.5, most=2):
    """Shares by weight; what passes a cap is shared anew among the others until none is above."""
    names = sorted((s for s in sizes if s is not None), key=str) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        left = budget * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return share | {s: float(most * sizes[s]) for s in capped}
        capped |= above


def class_fill(docs, target, blocks=1024, seed=7, parts=(1, 4, 16, 64)):
    """How often each document ``(doc_id, size)`` of one source is taken: whole times, then classes by length."""
    import hashlib
    from itertools import groupby
    total = sum(n for _, n in docs)
    whole = int(target // total) if total else 0
    rest = target - whole * total
    rows = []
    for at, (i, n) in enumerate(docs):
        digest = hashlib.md5(f"{seed}-{i}".encode()).hexdigest()
        rows.append((sum(n * p <= rest for p in parts), int(digest[:8], 16) % blocks, digest[8:32], n, at))
    taken, left = [whole] * len(docs), rest
    for k in range(len(parts) + 1 if rest > 0 else 0):
        own = sorted(r for r in rows if r[0] == k)
        words, below = sum(r[3] for r in own), sum(r[3] for r in rows if r[0] > k)
        goal = max(left, 0.0) * words / (words + below) if words else 0.0
        ends, upto = [(0, 0)], 0                                # words and documents up to each hash
        for _, same in groupby(own, key=lambda r: r[1:3]):
            same = list(same)
            upto += sum(r[3] for r in same)
            ends.append((upto, ends[-1][1] + len(same)))
        def cost(e, left=left, below=below, goal=goal):
            return max(e[0] - left, left - below - e[0], 0.0), abs(e[0] - goal)
        under = max((e for e in ends if e[0] <= goal), key=lambda e: e)
        over = min((e for e in ends if e[0] > goal), default=None)
        pick = (words, len(own)) if over is None else over if cost(over) < cost(under) else under
        left -= pick[0]
        for r in own[:pick[1]]:
            taken[r[4]] += 1
    return taken


def marginals(potential, move):
    """State 1's marginals of one chain by going through all state sequences."""
    import itertools
    import math
    total, one = 0.0, [0.0] * len(potential)
    for states in itertools.product((0, 1), repeat=len(potential)):
        w = math.exp(sum(p * s for p, s in zip(potential, states, strict=True))
                     + sum(move[a][b] for a, b in zip(states, states[1:], strict=False)))
        total += w
        for i, s in enumerate(states):
            one[i] += w * s
    return [x / total for x in one]


def backoff(docs, order=3, alpha=0.4):
    """Sum of log scores of each text by all other texts."""
    import math
    from collections import Counter
    words = [WORD.findall(lower_ascii(t)) for t in docs]

    def grams(w):
        return Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))

    own = [grams(w) for w in words]
    total = sum(own, Counter())
    out = []
    for w, mine in zip(words, own, strict=True):
        others = sum(map(len, words)) - len(w)
        score = 0.0
        for i in range(len(w)):
            most = min(order, i + 1)
            for n in range(most, 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                if total[g] > mine[g]:
                    below = others if n == 1 else total[g[:-1]] - mine[g[:-1]]
                    score += math.log((total[g] - mine[g]) / below) + (most - n) * math.log(alpha)
                    break
            else:
                score += math.log(1 / (others + 1)) + most * math.log(alpha)
        out.append(score)
    return out
