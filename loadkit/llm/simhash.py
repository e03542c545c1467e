"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has 64 bits: two segments of 23 and one of 18, filled up with
zeros. The binary Golay code is perfect: each 23-bit word is within three bits
of one codeword. Words with three errors have five more codewords at four bits.
A segment's keys are the numbers of all codewords within four bits, six at
most, and any two segments that differ in two bits or fewer have one in common.

Fingerprints that differ in four bits or fewer meet under one of these keys:

- A segment has no error: then one of the others has two at most. The key is
  the first one's bits with a codeword of the second (six ordered pairs).
- Every segment has an error: then each has two at most. The key is a codeword
  of each.

Keys are sorted by range in Spark and streamed, so a key that very many
different fingerprints have is cut into tiles, which meet in pairs; nothing
holds a whole key. Links are verified on the bits, and each run passes on a
spanning forest of its links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loadkit.llm.common import components, stored
from loadkit.llm.textbytes import LOWER, slices, word_spans
from loadkit.operators.keyed import join_per_key

GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
BITS = 4
TILE = 2048
ROWS = 2048
MOST_EDGES = 1 << 20


@cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainder of each message, offsets to the codewords near a word by its syndrome, which of them there are)."""
    rest = np.arange(4096) << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    words = np.arange(4096) << 11 | rest
    blocks = words[np.bitwise_count(words) == 7]
    errors = [0]
    for _ in range(3):
        errors = sorted({e ^ 1 << i for e in errors for i in range(23)} | set(errors))
    offsets, there = np.zeros((2048, 6), np.int64), np.zeros((2048, 6), bool)
    for e in errors:
        near = [e]
        if e.bit_count() == 3:
            near += [e ^ b for b in blocks[blocks & e == e].tolist()]
        syndrome = int(rest[e >> 11]) ^ e & 2047
        offsets[syndrome, : len(near)] = near
        there[syndrome, : len(near)] = True
    return rest, offsets, there


def codewords(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the codewords within four bits of each 23-bit word, in six columns, and which of them there are."""
    rest, offsets, there = golay()
    syndrome = rest[segment >> 11] ^ segment & 2047
    return (segment[:, None] ^ offsets[syndrome]) >> 11, there[syndrome]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of the fingerprints."""
    bits = prints.view(np.uint64)
    parts = [(bits >> np.uint64(s) & np.uint64(m)).astype(np.int64) for s, m in ((41, 0x7FFFFF), (18, 0x7FFFFF), (0, 0x3FFFF))]
    near = [codewords(p) for p in parts]
    row = np.arange(len(prints))
    rows, keys = [], []
    for i in range(3):
        for j in range(3):
            if i != j:
                number, there = near[j]
                keys.append((3 * i + j << 56 | parts[i][:, None] << 12 | number)[there])
                rows.append(np.broadcast_to(row[:, None], there.shape)[there])
    (a, in_a), (b, in_b), (c, in_c) = near
    there = in_a[:, :, None, None] & in_b[:, None, :, None] & in_c[:, None, None, :]
    keys.append((9 << 56 | a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :])[there])
    rows.append(np.broadcast_to(row[:, None, None, None], there.shape)[there])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprints(texts: pa.Array, width: int = 4, seed: int = 42) -> np.ndarray:
    """The fingerprint of each text, as signed 64-bit numbers."""
    out = np.zeros(len(texts), np.uint64)
    for first, end, data, offsets in slices(texts):
        starts, ends, words = word_spans(data, offsets)
        long = ends - starts
        place = np.cumsum(long + 1) - long - 1  # where each word stands if single spaces part them
        plain = np.full(int(long.sum()) + len(long), 0x20, np.uint8)
        byte = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
        plain[np.repeat(place, long) + byte] = LOWER[data[np.repeat(starts, long) + byte]]
        counts = np.diff(words)
        many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        have = np.flatnonzero(many)
        if not len(have):
            continue
        bounds = np.cumsum(many) - many
        at = np.arange(int(many.sum())) - np.repeat(bounds - words[:-1], many)
        last = at + np.repeat(np.minimum(counts, width), many) - 1
        raw, digest = plain.tobytes(), xxhash.xxh64_digest
        hashes = b"".join([digest(raw[s:e], seed) for s, e in zip(place[at].tolist(), (place[last] + long[last]).tolist(), strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, bounds[have], axis=0, dtype=np.int64)
        packed = np.packbits(2 * ones > many[have][:, None], axis=1)
        out[first + have] = np.frombuffer(packed.tobytes(), ">u8")
    return out.view(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges between the same nodes with the same components, fewer than there are nodes."""
    nodes, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = back[: len(a)], back[len(a) :]
    root = np.arange(len(nodes))
    while True:
        old = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == old).all():
            break
    up = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[up], nodes[root[up]]


def _linked(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The forest of edges that come piece by piece, of which only a bounded number is held beside it."""
    a, b, held = [], [], 0
    for x, y in found:
        a.append(x)
        b.append(y)
        held += len(x)
        if held > MOST_EDGES:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], 0
    return forest(np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _in_runs(key: np.ndarray, prints: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal keys."""
    at, step, value = np.flatnonzero(key[1:] == key[:-1]), 1, prints.view(np.uint64)
    while len(at):
        near = at[np.bitwise_count(value[at] ^ value[at + step]) <= bits]
        yield prints[near], prints[near + step]
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]


def _between(a: np.ndarray, b: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two tiles."""
    for i in range(0, len(a), 256):
        part = a[i : i + 256]
        x, y = np.nonzero(np.bitwise_count((part[:, None] ^ b[None, :]).view(np.uint64)) <= bits)
        yield part[x], b[y]


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=["a", "b", "key", "tile"]
    )


def _tile(key: int, prints: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([prints[0]]), pa.nulls(1, pa.int64()), pa.array([key]), pa.array([prints.tobytes()], pa.binary())], names=["a", "b", "key", "tile"]
    )


def _met(keyed: DataFrame, bits: int, most: int) -> DataFrame:
    """From rows sorted by (key, print): links (a, b) of keys that one task has seen whole, and tiles of the others.

    A task's first and last key may go on in its neighbours', and a long key
    may be anywhere: their fingerprints are passed on in tiles (a: the first).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = cut = None  # the task's first key; a key of which tiles have gone out
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, batch.column("key").to_numpy()])
            prints = np.concatenate([prints, batch.column("print").to_numpy()])
            first = key[0] if first is None else first
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            many = np.diff(np.concatenate([begin, [len(key)]]))
            whole = (key[begin] != first) & (many <= most)
            whole &= key[begin] != cut if cut is not None else True
            whole[-1] = False
            inside = np.repeat(whole, many)
            yield _edges(*_linked(_in_runs(key[inside], prints[inside], bits)))
            for i in np.flatnonzero(~whole[:-1]).tolist():
                for at in range(begin[i], begin[i] + many[i], most):
                    yield _tile(key[begin[i]], prints[at : min(at + most, begin[i] + many[i])])
            key, prints = key[begin[-1] :], prints[begin[-1] :]
            while len(key) > most:
                cut = key[0]
                yield _tile(cut, prints[:most])
                key, prints = key[most:], prints[most:]
        if len(key):
            yield _tile(key[0], prints)

    return keyed.mapInArrow(run, "a long, b long, key long, tile binary")


def linked(rows: DataFrame, bits: int = BITS, tile: int = TILE) -> DataFrame:
    """Adds ``group`` to rows (id, print): the smallest id reachable by prints that differ in ``bits`` bits or fewer.

    Up to ``tile`` different prints of one key are compared at once.
    """
    if not 0 <= bits <= BITS:
        raise ValueError(f"the keys find at most {BITS} differing bits")
    classes = stored(rows.groupBy("print").agg(F.min("id").alias("least")), "simhash_classes")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = batch.column("print").to_numpy()
            for at in range(0, len(value), ROWS):
                part = value[at : at + ROWS]
                row, key = keys_of(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "print"])

    dealt = classes.select("print").mapInArrow(keys, "key long, print long")
    met = stored(_met(dealt.repartitionByRange("key", "print").sortWithinPartitions("key", "print"), bits, tile), "simhash_met")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("tile"), batch.column("other"), strict=True):
                a, b = _linked(_between(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), bits))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    tiles = met.where("tile is not null")
    others = tiles.select("key", F.col("a").alias("from"), F.col("tile").alias("other"))
    pairs = tiles.join(others, "key").where("a <= from").select("tile", "other")
    edges = met.where("b is not null").select("a", "b").unionByName(pairs.mapInArrow(across, "a long, b long"))

    roots = components(edges, "simhash_components")
    least = roots.join(classes, F.col("node") == F.col("print")).groupBy("root").agg(F.min("least").alias("group"))
    grouped = join_per_key(roots, least, ["root"], "inner").select(F.col("node").alias("print"), "group")
    known = stored(classes.join(grouped, "print", "left").select("print", F.coalesce("group", "least").alias("group")), "simhash_groups")
    return join_per_key(rows, known, ["print"], "inner")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, bits: int = BITS
) -> DataFrame:
    """Groups of rows whose fingerprints differ in ``bits`` bits or fewer (four at most), directly or through others.

    Words are what stands between ASCII white space, lower-cased (A-Z). A
    fingerprint's bit is 1 where it is in over half of the XXH64 hashes (seed
    42) of the ``width``-word shingles, repeats included; with fewer words the
    whole sequence is one shingle. Null texts and those without words have
    fingerprint zero, which links like any other.

    Returns one row per input row: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``: the smallest id that can be reached by links. Null ids
    count only if no member has another. Repeated rows are rows of their own,
    of one fingerprint. An empty table gives no rows. Other columns are not
    read. A worker holds some hundred bytes for each word of its longest text.
    """
    kind = docs.schema[id_col].dataType

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(to_arrow_type(kind)), pa.array(fingerprints(batch.column("text"), width))], names=["id", "print"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(rows.mapInArrow(prints, f"id {kind.simpleString()}, print long"), "simhash_rows")
    return linked(rows, bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("group").alias("component_id")
    )
