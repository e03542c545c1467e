"""Phrase collocations against brute force and SQL."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest

from loadkit.llm import collocations, queries
from tests.conftest import DATA
from tests.llm.helpers import LOWER, no_docs, odd_docs


def by_hand(rows, least=10, percent=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from rows of (lang, text)."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(LOWER)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, *w[i : i + k]] += 1
    out = collections.defaultdict(list)
    for key, a in f.items():
        lang, *w = key
        if len(w) < 2 or a < least:
            continue
        longer = [b for k, b in f.items() if b >= least and k[0] == lang and len(k) == 4 and len(w) == 2 and (k[1:3] == key[1:] or k[2:] == key[1:])]
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        out[lang].append((-score, -a, b" ".join(w), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


@pytest.mark.parametrize("bits", [1, 7, 20, 21, 22, 32])
def test_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    high = rng.integers(0, 1 << bits, 500, np.uint64)
    low = rng.integers(0, 1 << 2 * bits, 500, np.uint64, endpoint=False) if bits < 32 else rng.integers(0, 1 << 64, 500, np.uint64)
    high[::3], low[::3] = high[0], low[0]
    counts = rng.choice([1, 2, 254, 255, 256, 1 << 40], 500)
    there, again = collocations.permuted(*collocations.permuted(high, low, bits), bits, back=True)
    assert (there == high).all() and (again == low).all()
    x, y = collocations.permuted(high, low, bits)
    want = collections.Counter()
    for h, v, c in zip(x.tolist(), y.tolist(), counts.tolist(), strict=True):
        want[h, v] += c
    x, y, counts = collocations.summed(x, y, counts, bits)
    for block_bits in {0, min(3, bits), bits}:
        got = {}
        for block in np.unique(x >> np.uint64(bits - block_bits)).tolist():
            own = x >> np.uint64(bits - block_bits) == block
            packed = collocations.filter_of(x[own], y[own], counts[own], bits, block_bits)
            got |= {(h, v): c for h, v, c in zip(*(p.tolist() for p in collocations.entries_of(packed, block, bits, block_bits)), strict=True)}
        assert got == dict(want)


def test_numbers_pack():
    for many in ([], [0], list(range(70_000)), [2**32 - 1, 0, 5]):
        assert collocations._unpacked_numbers(collocations._packed_numbers(np.array(many, np.int64))).tolist() == many


def random_rows(many):
    rng = random.Random(5)
    parts = ["a", "B", "b", "c", "new", "York", "york", "city", "ñ", ",", "x.y", "!", "\n", "\t", "日本", "d:e"]
    return [(rng.choice(["en", "de", "und", None]), " ".join(rng.choices(parts, k=rng.randint(0, 40)))) for _ in range(many)]


@pytest.mark.parametrize("flush", [3, 1 << 20])
def test_against_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 400)
    monkeypatch.setattr(collocations, "BLOCK_ROWS", 64)
    monkeypatch.setattr(collocations, "FLUSH", flush)
    rows = [*random_rows(150), ("en", "new york city " * 12), ("fr", None), ("fr", "")]
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    for least, percent, top in ((10, 50, 2000), (1, 80, 30)):
        got = collocations.collocations(docs, least=least, percent=percent, top=top)
        assert sorted(map(tuple, got.collect())) == by_hand(rows, least, percent, top)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert sorted(map(tuple, collocations.collocations(docs, least=3).collect())) == by_hand([(r.lang, r.text) for r in docs.collect()], 3)
    assert collocations.collocations(no_docs(spark)).collect() == []
    assert collocations.collocations(docs.where("text is null")).collect() == []


def test_counts_past_64_bits(spark):
    frame = spark.createDataFrame([(30_000_000_000_000, 40_000_000_000_000, 50_000_000_000_000)], "a long, l long, r long")
    (got,) = frame.select(collocations._score(frame.a, frame.l, frame.r)).first()
    assert got == 1_000_000 * 9 // 20


def test_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = connection.execute(queries.ORACLES["op11_phrase_collocations"]).fetchall()
    got = queries.QUERIES["op11_phrase_collocations"](spark, DATA).collect()
    assert len(got) > 1000 and sorted(map(tuple, got)) == sorted(want)
