"""Brute-force versions that the operators are held against."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOC)


def repeats(texts, window):
    """Per text: number of words, words removed, kept words."""
    lists = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), " ".join(kept)))
    return out


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = words(lowered)
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, distance):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(prints)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(prints))]


def contained(texts, items, size=5, share=0.8):
    def grams(t):
        w = words((t or "").lower())
        return {" ".join(w[i:i + size]) for i in range(len(w) - size + 1)}

    sets = [grams(t) for t in items]
    return [[j for j, s in enumerate(sets) if s and len(s & g) >= len(s) * share - 1e-9]
            for g in map(grams, texts)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
