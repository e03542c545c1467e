"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from loadkit.llm import queries, runs
from tests.conftest import SMALL
from tests.llm.helpers import no_docs, odd_docs, words


def runs_by_hand(w, least=12):
    """(start, length, period) of each run, by start and period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed_by_hand(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def test_many_words():
    rng = random.Random(3)
    for _ in range(300):
        many = rng.randint(0, 60)
        w = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(many)]
        if rng.random() < 0.6 and many:
            p = rng.randint(1, many)
            w = (w[:p] * 60)[:many]
            w[rng.randrange(many)] = rng.randrange(2)
        start, end, period = runs.runs_of(np.array([*w, -1], np.int64), 2)
        got = list(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True))
        assert got == runs_by_hand(w, 2), w


@pytest.mark.parametrize("lookups", [7, 1 << 20])
def test_texts_in_one_slice(monkeypatch, lookups):
    monkeypatch.setattr(runs, "LOOKUPS", lookups)
    rng = random.Random(4)
    texts = ["", "a", "a b " * 9, " a\tb\n" * 6 + "b", "é x" * 20]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 50))) for _ in range(60)]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    n, found, left = runs._collapsed(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]), 12)
    for t, many, own, rest in zip(texts, n.to_pylist(), found.to_pylist(), left.to_pylist(), strict=True):
        want = runs_by_hand(words(t))
        assert many == len(words(t)) and [tuple(r.values()) for r in own] == want
        assert rest.encode() == collapsed_by_hand(words(t), want)


def digest(d, t):
    w = words(t)
    h = zlib.crc32(str(d).encode())
    g, n = h // 10, len(w)
    if d is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = runs_by_hand(w)
    s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (
        d,
        len(found),
        s,
        length,
        q,
        1000 * length // q if q else None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
        hashlib.sha256(collapsed_by_hand(w, found)).hexdigest(),
    )


def test_given_table(spark):
    """All texts but the longest, which the plain version takes too long for."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(words(r.text)) < 3000]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    assert len(got) == docs.count()
    assert sum(v[1] for v in got.values()) > 10
    for d, t in rows:
        assert got[d] == digest(d, t)


def test_odd_rows(spark, tmp_path):
    docs = odd_docs(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(words(r.text)) < 3000]
    got = [repr(tuple(r)) for r in queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert len(got) == docs.count()
    for d, t in rows:
        assert repr(digest(d, t)) in got
    assert runs.collapse_runs(no_docs(spark)).collect() == []


def test_a_very_long_text(spark):
    text = "a b c " * 200_000 + "d " + "e " * 300_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (got,) = runs.collapse_runs(docs).collect()
    assert [tuple(r) for r in got.runs] == [(0, 600_000, 3), (600_001, 300_000, 1)] and got.collapsed == "a b c d e"
