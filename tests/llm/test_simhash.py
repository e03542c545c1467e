"""SimHash near-duplicates against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from loadkit.llm import queries, simhash
from tests.conftest import SMALL
from tests.llm.helpers import LOWER, no_docs, odd_docs, words


def print_of(text):
    w = [x.translate(LOWER) for x in words(text)]
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def groups(prints, ids, bits=4):
    """The smallest id reachable of each row."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= bits:
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def check(df, rows):
    prints = [print_of(t) for _, t in rows]
    want = zip([d for d, _ in rows], [f"{p:016x}" for p in prints], groups(prints, [d for d, _ in rows]), strict=True)
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.fingerprint, r.component_id)) for r in df.collect())


def test_golay_code():
    rest, offsets, there = simhash.golay()
    code = np.arange(4096) << 11 | rest
    weights = np.bincount(np.bitwise_count(code))
    assert weights[7] == 253 and weights[8] == 506 and weights[1:7].sum() == 0
    word = np.random.default_rng(1).integers(0, 1 << 23, 300)
    number, have = simhash.codewords(word)
    for w, n, h in zip(word, number, have, strict=True):
        assert set(n[h]) == set(np.flatnonzero(np.bitwise_count(code ^ w) <= 4)) or np.bitwise_count(code ^ w).min() < 3
        assert set(n[h]) <= set(np.flatnonzero(np.bitwise_count(code ^ w) <= 4))


def test_every_link_has_a_common_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 64, 1_000, np.uint64)
    flips = np.zeros(len(a), np.uint64)
    for i, n in enumerate(rng.integers(0, 5, len(a))):
        for bit in rng.choice(64, n, replace=False):
            flips[i] |= np.uint64(1) << np.uint64(bit)
    row, key = simhash.keys_of(a)
    other, same = simhash.keys_of(a ^ flips)
    keys = [{} for _ in range(2)]
    for have, pairs in zip(keys, ((row, key), (other, same)), strict=True):
        for r, k in zip(*pairs, strict=True):
            have.setdefault(r, set()).add(k)
    assert all(keys[0][i] & keys[1][i] for i in range(len(a)))


@pytest.mark.parametrize("tile", [2, 2048])
def test_links_against_brute_force(spark, tile):
    """Dense clusters of different fingerprints, also with keys cut into tiles."""
    rng = random.Random(tile)
    prints = [0, 1, (1 << 64) - 1]
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 4, 25])):
            prints.append(centre ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 4))))
    rows = list(enumerate(np.array(prints, np.uint64).view(np.int64).tolist())) + [(None, 0), (0, 0)]
    got = simhash.linked(spark.createDataFrame(rows, "id long, print long"), tile=tile).collect()
    want = groups([p & (1 << 64) - 1 for _, p in rows], [i for i, _ in rows])
    assert sorted(map(repr, got)) == sorted(f"Row(print={p}, id={i}, group={g})" for (i, p), g in zip(rows, want, strict=True))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    check(simhash.near_duplicates(docs), [(r.doc_id, r.text) for r in docs.collect()])
    assert simhash.near_duplicates(no_docs(spark)).collect() == []


def test_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(queries.QUERIES["op13_simhash_near_dedup"](spark, SMALL), rows)


def test_too_many_bits(spark):
    with pytest.raises(ValueError):
        simhash.near_duplicates(no_docs(spark), bits=5)
