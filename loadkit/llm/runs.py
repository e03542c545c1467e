"""Periodic runs of words in texts, by the branching-tandem test on an enhanced suffix array.

The words of many texts lie in one array; a word is told apart by text, so
suffixes agree only within a text. The suffix array comes from prefix doubling,
whose ranks of 2, 4, 8, ... words also tell how far two places agree to the right
or to the left.

An LCP interval of depth d is split at its smallest values into two sides. For
each suffix i on the smaller side it is looked up in the inverse suffix array
whether i + d or i - d is on the other side. If so, d words stand there twice in
a row, and the word behind differs from the one d before it: a square that
cannot be rotated to the right. Rotated to the left as far as it goes, it has
covered its run; squares of one run that repeat a shorter period are merged
into it. Sides are ranges of the arrays; there are no tree nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loadkit.llm.textbytes import slices, word_spans

LOOKUPS = 1 << 20


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 1, 2, 4, ... symbols) of symbols whose last one is like no other.

    Only suffixes that agree with others so far are sorted again.
    """
    order = np.argsort(symbols, kind="stable")
    new = np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]])
    rank = np.empty(len(symbols), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(symbols)), 0))
    ranks, reach = [rank], 1
    open_ = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    while len(open_):
        place = order[open_]
        key = rank[place] * len(symbols) + rank[place + reach]
        by = np.argsort(key, kind="stable")
        place, key = place[by], key[by]
        order[open_] = place
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[place] = np.maximum.accumulate(np.where(new, open_, 0))
        ranks.append(rank)
        reach *= 2
        open_ = open_[~(new & np.concatenate([new[1:], [True]]))]
    return order, ranks


def common(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """How many symbols agree from i and j on, or before them."""
    far = np.zeros(len(i), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        if back:
            a, b = i - far - step, j - far - step
            same = (a >= 0) & (ranks[level][np.maximum(a, 0)] == ranks[level][np.maximum(b, 0)])
        else:
            same = ranks[level][i + far] == ranks[level][j + far]
        far += same * step
    return far


def sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in the LCP array the last smaller one before it, and the first not larger one behind it."""
    left, right = [0] * len(lcp), [len(lcp)] * len(lcp)
    stack = [0]
    values = lcp.tolist()
    for k in range(1, len(values)):
        v = values[k]
        while values[stack[-1]] >= v and len(stack) > 1:
            right[stack.pop()] = k
        if v:
            left[k] = stack[-1]
            stack.append(k)
        else:
            stack[0] = k
    return np.array(left, np.int64), np.array(right, np.int64)


def squares(order: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all squares that cannot be rotated to the right."""
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.arange(len(order))
    left, right = sides(lcp)
    node = np.flatnonzero(lcp)
    low, high, depth = left[node], right[node], lcp[node]
    smaller_left = node - low <= high - node
    first = np.where(smaller_left, low, node)  # the smaller side, and the other one
    many = np.where(smaller_left, node - low, high - node)
    from_, to = np.where(smaller_left, node, low), np.where(smaller_left, high, node)
    cuts = np.searchsorted(np.cumsum(many), np.arange(0, max(1, int(many.sum())), LOOKUPS), "right")
    for a, b in zip(cuts, [*cuts[1:], len(node)], strict=True):
        part = np.repeat(np.arange(a, b), many[a:b])
        within = np.arange(len(part)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
        place, d = order[first[part] + within], depth[part]
        for at, other in ((place, place + d), (place - d, place - d)):
            there = inverse[np.maximum(other, 0)]
            hit = (other >= 0) & (there >= from_[part]) & (there < to[part])
            yield at[hit], d[hit]


def runs_of(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs of at least ``least`` symbols, by start and period; see ``suffix_ranks``."""
    order, ranks = suffix_ranks(symbols)
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = common(ranks, order[:-1], order[1:])
    found = []
    for place, period in squares(order, lcp):
        start = place - common(ranks, place, place + period, back=True)
        end = place + 2 * period
        long = end - start >= least
        found.append(np.stack([start, end, period])[:, long])
    start, end, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    keep = np.ones(len(by), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[keep], end[keep], period[keep]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _collapsed(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(words, runs, what is left) of each text of a slice."""
    starts, ends, bounds = word_spans(data, offsets)
    long, n = ends - starts, len(starts)
    at = np.concatenate([[0], np.cumsum(long)])
    byte = np.repeat(starts - at[:-1], long) + np.arange(at[-1])
    names = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at), pa.py_buffer(data[byte])]).dictionary_encode()
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    word = text * (len(names.dictionary) + 1) + names.indices.to_numpy()
    start, end, period = runs_of(np.concatenate([word, [-1]]), least)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, end, -1)
    kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0)

    # the words that stay, with a space behind each, then without a text's last one
    rest = long[kept] + 1
    place = np.concatenate([[0], np.cumsum(rest)])
    plain = np.full(place[-1], 0x20, np.uint8)
    byte = np.arange(place[-1]) - np.repeat(place[:-1], rest)
    inside = byte < np.repeat(rest - 1, rest)
    plain[inside] = data[(np.repeat(starts[kept], rest) + byte)[inside]]
    first = place[np.searchsorted(kept, bounds)]
    last = first[1:][first[1:] > first[:-1]] - 1
    plain = np.delete(plain, last)
    begins = np.concatenate([[0], np.cumsum(np.diff(first) - (np.diff(first) > 0))])
    left = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(begins), pa.py_buffer(plain)])

    own = np.searchsorted(bounds, start, "right") - 1
    fields = [pa.array(x) for x in (start - bounds[own], end - start, period)]
    rows = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(len(bounds))), pa.int32()), rows)
    return pa.array(np.diff(bounds)), runs, left


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """Finds where texts repeat themselves word by word, and keeps one period of each such run.

    Words are what stands between ASCII white space, compared byte by byte. A
    run is a stretch of at least ``least`` words, and at least twice its smallest
    period, that neither neighbour extends. Runs may overlap; a word goes if it
    is in any run behind that run's first period.

    Returns one row per input row: the id, ``n_words``, ``runs`` (start word
    from 0, length and period in words, by start and period) and ``collapsed``
    (the words that stay, joined by single spaces). A null text counts as
    empty: no words, no runs. Null ids are allowed, and repeated rows are rows
    of their own. An empty table gives no rows. Other columns are not read.
    Texts are taken whole: a worker holds some four hundred bytes for each word
    of its longest text.
    """
    kind = docs.schema[id_col].dataType
    names = ["id", "n_words", "runs", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").cast(to_arrow_type(kind))
            for first, end, data, offsets in slices(batch.column("text")):
                n, runs, left = _collapsed(data, offsets, least)
                yield pa.RecordBatch.from_arrays([ids[first:end], n, runs, left.cast(pa.string())], names=names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = f"id {kind.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(run, found).withColumnRenamed("id", id_col)
