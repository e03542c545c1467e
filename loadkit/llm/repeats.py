"""Removal of repeated passages by longest-previous-factor arrays, keeping the first occurrence.

A suffix array over a whole corpus doesn't fit into a task, so suffixes are
brought together by content first, without loss:

- Of the ``K``-byte strings in every window of ``length`` bytes the one with
  the smallest hash is the window's anchor. Equal windows have equal anchors,
  so windows that match in different documents meet where anchors are dealt
  by their hash. The windows of one anchor are consecutive; the bytes they
  cover are a block, some twenty bytes longer than a window.
- Blocks that are equal need no bytes to be judged: all their windows match.
  A task takes its texts by pieces and settles the copies within each; for
  each block, one entry per piece is dealt out.
- Blocks that differ but have an anchor in common may still share some
  windows. Only their bytes are dealt out, and there the suffix array decides:
  the suffixes at all windows are put in order, to the depth of a window. In a
  run of suffixes that agree that far, the previous or the next smaller
  document in suffix order gives the earlier match; there is one unless the
  suffix's own document is the smallest of its run.

What is dealt out comes back in order, so a worker holds a piece of it at a
time, however much of it its task has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import in_small_batches, stored
from loadkit.llm.textbytes import PIECE_BYTES, hash_spans, mix, powers, prefix_hashes, slices

K = 24
HOT_BLOCKS = 10_000  # of some 27 windows at most
PIECE_BLOCKS = 1 << 18  # blocks that a worker settles at once: some 4 MB of text
PIECE_WINDOWS = 1 << 17  # suffixes from which on a worker puts them in order; a batch may add twice as many
LAST = 2**63 - 1  # null ids come after all others


def blocks_of(data: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash, block hash) of each block of a slice."""
    windows = len(data) - length + 1
    if windows <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums = prefix_hashes(data)
    grams = len(data) - k + 1
    low = mix((sums[k:] - sums[:-k]) * powers(len(sums))[1][:grams])
    low &= ~np.uint64(63)
    # tells the anchors of neighbouring windows apart, in the same way wherever the text lies in a slice
    low |= (np.arange(grams) - np.repeat(offsets[:-1], np.diff(offsets))[:grams]).astype(np.uint64) & np.uint64(63)
    width, span = length - k + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: windows], low[width - span :][:windows])
    owner_end = np.repeat(offsets[1:], np.diff(offsets))[:windows]
    valid = np.arange(windows) + length <= owner_end
    begin = valid.copy()
    begin[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
    starts = offsets[:-1][np.diff(offsets) >= length]
    begin[starts] = True
    first = np.flatnonzero(begin)
    number = np.cumsum(begin)
    last = np.zeros(len(first), np.int64)
    at = np.flatnonzero(valid)
    last[number[at] - 1] = at  # the last write stays: positions rise
    text = np.searchsorted(offsets, first, "right") - 1
    return text, first, last, low[first] >> np.uint64(6), hash_spans(sums, first, last + length)


def _key(text: np.ndarray, block: np.ndarray) -> np.ndarray:
    """One number for a block of a text of the slice."""
    return mix(block + (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _packed_by(owner: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """The owners, each once, and for each column the bytes of its values per owner."""
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    ends = [*begin[1:].tolist(), len(owner)]
    packed = [[c[a:b].tobytes() for a, b in zip(begin.tolist(), ends, strict=False)] for c in (x[order] for x in columns)]
    return owner[begin], packed


def _least(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, document), where a key begins in it, and for each place whether a smaller document has the key."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    begin = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    first = doc[np.flatnonzero(begin)][np.cumsum(begin) - 1] if len(key) else doc
    return order, begin, doc > first


ENTRIES = "bucket int, id long, hashes binary, blocks binary, docs binary"


def _entries(docs: DataFrame, length: int, k: int, buckets: int) -> DataFrame:
    """Blocks dealt by their anchors, one entry per block and piece of a task; copies within the piece as matched, by document."""

    def settled(found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, anchor, block = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        order, begin, matched = _least(block, doc)
        owner, (packed,) = _packed_by(doc[order[matched]], block[order[matched]])
        none = pa.nulls(len(owner), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array((owner % buckets).astype(np.int32)), pa.array(owner), none, pa.array(packed, pa.binary()), none], names=["bucket", "id", "hashes", "blocks", "docs"]
        )
        order = np.sort(order[begin])  # documents stay together, which packs well
        doc, anchor, block = doc[order], anchor[order], block[order]
        bucket, packed = _packed_by((anchor % np.uint64(buckets)).astype(np.int32), (anchor // np.uint64(buckets)).astype(np.uint32), block, doc)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.nulls(len(bucket), pa.int64()), *(pa.array(x, pa.binary()) for x in packed)],
            names=["bucket", "id", "hashes", "blocks", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, many = [], 0
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for start, _, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                text, _, _, anchor, block = blocks_of(data, offsets, length, k)
                found.append((ids[start + text], anchor, block))
                many += len(block)
                if many >= PIECE_BLOCKS:
                    yield from settled(found)
                    many = 0
        if found:
            yield from settled(found)

    return docs.mapInArrow(run, ENTRIES)


def _judged(entries: DataFrame) -> DataFrame:
    """(id, kind, blocks): blocks of a document that an earlier one has whole (0), or that must be compared (1, 2 if very many must).

    The entries lie by bucket, and one bucket is held at a time.
    """

    def judged(packed: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
        whole = [np.concatenate([np.frombuffer(x[i], kind) for x in packed]) for i, kind in enumerate((np.uint32, np.uint64, np.int64))]
        packed.clear()
        parts = np.uint32(1 + len(whole[0]) // PIECE_BLOCKS)
        part = whole[0] % parts
        for i in range(parts):
            anchor, block, doc = (x[part == i] for x in whole)
            order, begin, matched = _least(block, doc)
            kinds = [(doc[order[matched]], block[order[matched]], 0)]
            # the first document of each block speaks for it where blocks that differ have one anchor
            one = order[begin]
            anchor, block, doc = anchor[one], block[one], doc[one]
            order = np.argsort(anchor, kind="stable")
            anchor, block, doc = anchor[order], block[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
            many = np.diff(np.concatenate([first, [len(anchor)]]))
            if len(first):
                several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
                for kind, which in ((1, several & (many <= HOT_BLOCKS)), (2, several & (many > HOT_BLOCKS))):
                    take = np.repeat(which, many)
                    kinds.append((doc[take], block[take], kind))
            for owners, blocks, kind in kinds:
                owner, (bytes_of,) = _packed_by(owners, blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner, pa.int64()), pa.array(np.full(len(owner), kind, np.int32)), pa.array(bytes_of, pa.binary())], names=["id", "kind", "blocks"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, now = [], None
        for batch in batches:
            whole = batch.filter(batch.column("id").is_valid())
            if whole.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [whole.column("id"), pa.array(np.zeros(whole.num_rows, np.int32)), whole.column("blocks")], names=["id", "kind", "blocks"]
                )
            rest = batch.filter(batch.column("id").is_null())
            for bucket, *row in zip(*(rest.column(c).to_pylist() for c in ("bucket", "hashes", "blocks", "docs")), strict=True):
                if packed and bucket != now:
                    yield from judged(packed)
                packed.append(row)
                now = bucket
        if packed:
            yield from judged(packed)

    return entries.mapInArrow(run, "id long, kind int, blocks binary")


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all 64-bit values in a column of lists of bytes."""
    rows, values = [], []
    for i, parts in enumerate(column.to_pylist()):
        for part in parts or ():
            got = np.frombuffer(part, np.uint64)
            values.append(got)
            rows.append(np.full(len(got), i))
    return (np.concatenate(rows), np.concatenate(values)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _contexts(asked: DataFrame, length: int, k: int) -> DataFrame:
    """The bytes of blocks to compare, keyed by anchor; of very many with one anchor, each window by its own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            wanted = {}
            for kind in ("blocks", "hot_blocks"):
                row, value = _lists(batch.column(kind))
                wanted[kind] = row, value
            for start, end, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                text, first, last, anchor, block = blocks_of(data, offsets, length, k)
                out = []
                for kind in ("blocks", "hot_blocks"):
                    row, value = wanted[kind]
                    here = (row >= start) & (row < end)
                    if not here.any():
                        continue
                    # once, however often the text has the block: what is found holds for all its places
                    key, one = np.unique(_key(text, block), return_index=True)
                    hit = one[np.isin(key, _key(row[here] - start, value[here]))]
                    if kind == "blocks":
                        out.append((text[hit], anchor[hit], block[hit], np.zeros(len(hit), np.int64), first[hit], last[hit] + length))
                    else:
                        size = last[hit] - first[hit] + 1
                        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                        at = np.repeat(first[hit], size) + step
                        own = hash_spans(prefix_hashes(data), at, at + length)
                        out.append((np.repeat(text[hit], size), own, np.repeat(block[hit], size), step, at, at + length))
                if not out:
                    continue
                text, anchor, block, step, a, b = (np.concatenate(x) for x in zip(*out, strict=True))
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(ids[start + text]),
                        pa.array(block.view(np.int64)),
                        pa.array(step.astype(np.int32)),
                        pa.array([raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["key", "id", "block", "step", "bytes"],
                )

    return asked.select("id", "text", "blocks", "hot_blocks").mapInArrow(run, "key long, id long, block long, step int, bytes binary")


def earlier_windows(data: np.ndarray, starts: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For suffixes at ``starts``: whether one that agrees for ``length`` bytes is in a smaller document.

    The suffix order is made to that depth, eight bytes at a time. In it, equal
    suffixes are a run, and are put by document: then no next smaller document
    is left in a run, and the previous one shows at once.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data) + 1, np.uint64)
    for i in range(8):
        words = words << np.uint64(8) | padded[i : i + len(words)]
    keys = [words[starts + i] for i in range(0, length - 7, 8)]
    if length % 8:
        keys.append(words[starts + length - length % 8] >> np.uint64(8 * (8 - length % 8)))
    order = np.lexsort((doc, *keys[::-1]))
    agree = np.ones(len(order), bool)
    for key in keys:
        agree[1:] &= key[order][1:] == key[order][:-1]
    agree[:1] = False
    run = np.cumsum(~agree) - 1
    smallest = doc[order][~agree]  # the first of its run
    out = np.zeros(len(starts), bool)
    out[order] = doc[order] > smallest[run]
    return out


def _bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column's values, one behind the other, and their bounds."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    bounds = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return np.frombuffer(array.buffers()[2], np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _by_key(batches: Iterator[pa.RecordBatch], length: int, most: int) -> Iterator[tuple[pa.Table, bool]]:
    """Pieces of rows in order of keys, of some ``most`` windows, and whether the key goes on: only where a piece has no other."""
    held, windows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        windows += len(_bytes_of(pa.chunked_array([batch.column("bytes")]))[0]) - batch.num_rows * (length - 1)
        if windows < most:
            continue
        table = pa.Table.from_batches(held)
        key = table["key"].to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        yield (table.slice(0, cut), False) if cut else (table, True)
        held = table.slice(cut).combine_chunks().to_batches() if cut else []
        windows = sum(len(_bytes_of(pa.chunked_array([b.column("bytes")]))[0]) - b.num_rows * (length - 1) for b in held)
    if held:
        yield pa.Table.from_batches(held), False


def _compared(contexts: DataFrame, length: int) -> DataFrame:
    """(id, spans): packed triples (block, first window, last window) that an earlier document has, for differing blocks.

    The rows lie by key, then by document. A key of more rows than a piece
    holds hands its different windows on, each with its smallest document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, seen, seen_doc = None, np.zeros((0, length), np.uint8), np.zeros(0, np.int64)
        for table, goes_on in _by_key(batches, length, PIECE_WINDOWS):
            key, ids, block, step = (table[c].to_numpy() for c in ("key", "id", "block", "step"))
            if before != key[0]:
                seen, seen_doc = seen[:0], seen_doc[:0]
            data, bounds = _bytes_of(table["bytes"])
            many = np.diff(bounds) - length + 1
            owner = np.repeat(np.arange(len(many)), many)
            place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            starts = np.concatenate([bounds[:-1][owner] + place, len(data) + length * np.arange(len(seen))])
            data, doc = np.concatenate([data, seen.ravel()]), np.concatenate([ids[owner], seen_doc])
            hit = earlier_windows(data, starts, doc, length)
            before = None
            if goes_on:
                least = np.flatnonzero(~hit)
                windows = np.lib.stride_tricks.sliding_window_view(data, length)[starts[least]]
                seen, one = np.unique(windows, axis=0, return_index=True)
                before, seen_doc = key[0], doc[least[one]]
            hit = hit[: len(owner)]
            begin = hit.copy()
            begin[1:] &= ~hit[:-1] | (owner[1:] != owner[:-1])
            end = hit.copy()
            end[:-1] &= ~hit[1:] | (owner[1:] != owner[:-1])
            a, b = np.flatnonzero(begin), np.flatnonzero(end)
            triples = np.stack([block[owner[a]], place[a] + step[owner[a]], place[b] + step[owner[a]]], 1)
            who, (packed,) = _packed_by(ids[owner[a]], triples)
            yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(packed, pa.binary())], names=["id", "spans"])

    return contexts.mapInArrow(run, "id long, spans binary")


RESULT = "id long, row struct<id:{0}>, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary, kept_sha256 string"


def _cut(docs: DataFrame, kind: str, length: int, k: int, with_bytes: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, partly = _lists(batch.column("blocks")), _lists(batch.column("spans"))
            triples = partly[1].view(np.int64).reshape(-1, 3)
            partly_row = partly[0][::3]
            for start, end, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                text, first, last, _, block = blocks_of(data, offsets, length, k)
                key = _key(text, block)
                here = (whole[0] >= start) & (whole[0] < end)
                hit = np.isin(key, _key(whole[0][here] - start, whole[1][here]))
                begins, ends = [first[hit]], [last[hit]]
                here = (partly_row >= start) & (partly_row < end)
                if here.any():
                    asked = _key(partly_row[here] - start, triples[here, 0].view(np.uint64))
                    order = np.argsort(asked, kind="stable")
                    low = np.searchsorted(asked[order], key, "left")
                    size = np.searchsorted(asked[order], key, "right") - low
                    at = np.repeat(low, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                    base = np.repeat(first, size)
                    begins.append(base + triples[here][order][at, 1])
                    ends.append(base + triples[here][order][at, 2])
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, np.concatenate(begins), 1)
                np.add.at(change, np.concatenate(ends) + length, -1)
                removed = np.cumsum(change[:-1]) > 0
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                opens = removed & (np.concatenate([[True], ~removed[:-1]]) | edge[:-1]) if len(data) else removed
                closes = removed & (np.concatenate([~removed[1:], [True]]) | edge[1:]) if len(data) else removed
                a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
                spans_at = np.searchsorted(a, offsets)
                owner = np.repeat(offsets[:-1], np.diff(spans_at))
                kept = data[~removed].tobytes()
                kept_at = np.concatenate([[0], np.cumsum(~removed)])[offsets].tolist()
                texts = [kept[i:j] for i, j in zip(kept_at[:-1], kept_at[1:], strict=True)]
                span = pa.StructArray.from_arrays([pa.array(a - owner), pa.array(b - owner)], ["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(start, end - start),
                        batch.column("row").slice(start, end - start),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(spans_at.astype(np.int32)), span),
                        pa.array(texts if with_bytes else [None] * len(texts), pa.binary()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    ],
                    names=["id", "row", "n_bytes", "spans", "kept", "kept_sha256"],
                )

    return docs.mapInArrow(run, RESULT.format(kind))


@in_small_batches
def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, k: int = K, with_bytes: bool = False
) -> DataFrame:
    """Each document without the bytes that a string of ``length`` bytes covers which also begins in a smaller document.

    Texts are UTF-8 bytes, null is empty; matches never cross documents;
    overlaps count; strings are judged on the input. Returns a row per input
    row: id, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs as
    start and end), ``kept`` (the bytes left, null unless ``with_bytes``; a cut
    may fall inside a character) and ``kept_sha256``.

    Ids are integers. Null ids come after all others and are not smaller than
    each other; rows with one id are not smaller than each other either, and
    share their fate block by block. An empty table gives no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key: Column = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    rows = docs.select(key.alias("id"), F.struct(F.col(id_col).alias("id")).alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    entries = _entries(rows.select("id", "text"), length, k, buckets)
    judged = stored(_judged(entries.repartition("bucket").sortWithinPartitions("bucket")), "repeat_blocks")
    asked = judged.where("kind > 0").groupBy("id").agg(
        F.collect_list(F.when(F.col("kind") == 1, F.col("blocks"))).alias("blocks"),
        F.collect_list(F.when(F.col("kind") == 2, F.col("blocks"))).alias("hot_blocks"),
    )
    contexts = _contexts(rows.select("id", "text").join(asked, "id"), length, k)
    compared = stored(_compared(contexts.repartition("key").sortWithinPartitions("key", "id"), length), "repeat_spans")

    whole = judged.where("kind = 0").groupBy("id").agg(F.collect_list("blocks").alias("blocks"))
    partly = compared.groupBy("id").agg(F.collect_list("spans").alias("spans"))
    known = whole.join(partly, "id", "full_outer")
    cut = _cut(rows.join(known, "id", "left").select("id", "row", "text", "blocks", "spans"), kind, length, k, with_bytes)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(F.col("row.id").alias(id_col), "n_bytes", removed.alias("n_removed"), "spans", "kept", "kept_sha256")
