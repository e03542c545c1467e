"""Brute-force versions to hold the operators against."""

import collections
import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text):
    return WORD.findall((text or "").encode())


def shingle_set(text, width=5):
    w = [x.translate(LOWER) for x in words(text)]
    if len(w) >= width:
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def similar(rows, percent=80):
    """Per row: (set size, smallest id of its component, links)."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = collections.Counter()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows)]


def without_repeats(rows, length=50):
    """Per row: (id, bytes, removed bytes, runs, hash of the rest)."""
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s not in first or order(d) < order(first[s]):
                first[s] = d
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if order(first[b[p : p + length]]) < order(d):
                gone[p : p + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


#: Texts that operators must bear: null, empty, blank, one word, ties, repeats, other scripts, long ones without a space.
ODD = [
    (1, "a b c d e f g h i j k l"),
    (2, "A b c d e f g h i j k l"),
    (3, "a b c d e f g h i j k l m"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one"),
    (8, "one"),
    (9, "ONE two"),
    (10, "x" * 30_000),
    (11, "x" * 30_001),
    (12, "ñandú 日本語 \U0001f600 été " * 40),
    (13, "ñandú 日本語 \U0001f600 été " * 41),
    (14, " ".join(f"w{i}" for i in range(20_000))),
    (15, " ".join(f"w{i}" for i in range(20_000)) + " end"),
    (None, "a b c d e f g h i j k l"),
    (None, None),
    (1, "a b c d e f g h i j k l"),
    (1, "something else entirely stands in this row of one id"),
]
SCHEMA = "doc_id long, text string"


def odd_docs(spark):
    """The odd texts with further columns whose names could clash."""
    rows = [(d, t, "en", "s", None, 5, "q") for d, t in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", lang string, source string, n_chars long, size long, shard string")


def no_docs(spark):
    return odd_docs(spark).where("false")
