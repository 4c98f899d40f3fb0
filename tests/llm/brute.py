"""Plain versions of the operators, for a few small rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_duplicates(docs, width, percent):
    """{doc_id: (n_shingles, component_id)} for (doc_id, text) with distinct ids."""
    sets = {i: shingles(t, width) for i, t in docs}
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                part[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def repeats(docs, length):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256, rest)}."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = [True] * length
            seen.add(raw[p : p + length])
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest)
    return out


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return counts, len(words) < 50 or 100 * len(covered) > 50 * len(words)


def words_of(text):
    return Counter(x for x in WORD.findall(text))


def jaccard(a, b):
    a, b = words_of(a), words_of(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0
