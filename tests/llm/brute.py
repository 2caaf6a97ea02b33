"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter


def find_components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= 5:
        return {tuple(words[k: k + 5]) for k in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def jaccard_report(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = find_components(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}


def cut_repeats(docs, window=400):
    """doc → (n_bytes, n_removed, n_spans, sha256, kept bytes)."""
    raw = {i: (t or "").encode() for i, t in docs.items()}
    seen = Counter(x[k: k + window] for x in raw.values() for k in range(len(x) - window + 1))
    out = {}
    for i, x in raw.items():
        gone = bytearray(len(x))
        for k in range(len(x) - window + 1):
            if seen[x[k: k + window]] > 1:
                gone[k: k + window] = b"\1" * window
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def least_edits(pattern, text):
    """Edits between the pattern and the best part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def best_segmentation(text, pieces, unknown):
    """Greatest sum of scores over all segmentations of a short text."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            p = text[start:end]
            score = pieces.get(p, unknown if end - start == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def class_evidence(docs, order, shared_order):
    """Gram → log P_toxic - log P_ordinary of its last letter, and context → the same of a letter
    unseen after it, from ``docs`` of (lower-case text, label 1, 0 or None): Kneser-Ney with class
    counts on top and continuation counts of all documents below. ``^`` begins and ``$`` ends words."""
    def spelled(text, n):
        for word in re.findall("[a-z]+", text):
            x = "^" * (n - 1) + word + "$"
            yield from (x[k: k + n] for k in range(len(word) + 1))

    top = {c: Counter(g for text, label in docs if label == c for g in spelled(text, order)) for c in (0, 1)}
    seen = set(top[0]) | set(top[1])

    def discount(counts):
        one, two = (sum(c == n for c in counts.values()) for n in (1, 2))
        return min(max(one / (one + 2 * two), 0.1), 0.95) if one else 0.5

    below = {}                                    # length → suffix: symbols that stand before it
    longer = {g for text, _ in docs for g in spelled(text, shared_order)}
    for n in range(shared_order - 1, 0, -1):
        below[n] = Counter(g[1:] for g in longer)
        longer = set(below[n])
    cuts = {n: discount(c) for n, c in below.items()}

    def shared(g):
        counts, d = below[len(g)], cuts[len(g)]
        like = {x: c for x, c in counts.items() if x[:-1] == g[:-1]}
        rest = shared(g[1:]) if len(g) > 1 else 1 / 64
        return (max(counts[g] - d, 0) + d * len(like) * rest) / sum(like.values())

    def parts(label, h):
        after = [c for g, c in top[label].items() if g[:-1] == h]
        d = discount(top[label])
        return sum(after), d, d * len(after) / sum(after) if after else 1.0

    contexts = {h: math.log(parts(1, h)[2]) - math.log(parts(0, h)[2]) for h in {g[:-1] for g in seen}}
    grams = {}
    for g in seen:
        p = []
        for label in (1, 0):
            n, d, rest = parts(label, g[:-1])
            p.append((max(top[label][g] - d, 0) / n if n else 0.0) + rest * shared(g[1 - shared_order:]))
        grams[g] = math.log(p[0]) - math.log(p[1])
    return grams, contexts
