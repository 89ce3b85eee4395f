"""What the operators must give, the plain way."""

import hashlib
import re
from collections import defaultdict

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def components(texts):
    """(component number, set size) of each text."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [(root(i), len(s)) for i, s in enumerate(sets)]


def exact(rows):
    """For (doc_id, text) rows: digest, index of the row that stays, group size."""
    groups = defaultdict(list)
    for i, (_, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append(i)
    out = [None] * len(rows)
    for plain, members in groups.items():
        keep = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0], i))
        for i in members:
            out[i] = (hashlib.sha256(plain.encode()).hexdigest(), keep, len(members))
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(text, items):
    """Words, hit words and item ids of one text; items are (id, text)."""
    found = WORD.findall((text or "").translate(FOLD))
    hit, named = set(), set()
    for item, said in items:
        wanted = WORD.findall((said or "").translate(FOLD))
        for k in range(max(1, len(wanted) - 9) if wanted else 0):
            window = wanted[k : k + 10]
            for i in range(len(found) - len(window) + 1):
                if found[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    named.add("" if item is None else str(item))
    return len(found), len(hit), named
