"""Phrase collocations, counted in mergeable quotient filters.

- Texts become numbers: a chunk of some megabytes numbers its own words, the
  words of all chunks are added up, and those frequent enough get corpus-wide
  numbers of ``bits`` bits. A rarer word cannot be part of a frequent phrase.
- Phrases of two and three words are packed into 3 * ``bits`` bits and permuted
  by a Feistel network, which can be inverted. The first bits of the permuted
  phrase are its block, the next ones its quotient, all others its remainder. A
  filter of a block keeps, for each quotient, how many phrases there are, then
  their whole remainders and counts. So it is much smaller than the phrases,
  but counts without error.
- Each task counts into sorted filters; those of a block are merged over all
  tasks, and the frequent phrases are read back by inverting the permutation.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import bucket_of, numbered, stored
from loadkit.llm.textbytes import LOWER, mix, slices, word_spans
from loadkit.operators.keyed import join_per_key

CHUNK_BYTES = 1 << 22
BLOCK_ROWS = 1 << 18
FLUSH = 1 << 20
MOST_BITS = 32
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAPS = BREAKS.copy()
GAPS[[0x20, 0x09]] = True
KEYS = mix(np.arange(11, 15, dtype=np.uint64))


# 1: texts as numbers


def _packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers from 0 as four planes of bytes, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked_numbers(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = pa.decompress(packed[8:], decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, tokens, words, langs, counts): texts as numbers of the chunk's words from 1, 0 between pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for first, end, data, offsets in slices(batch.column("text"), CHUNK_BYTES):
                data = LOWER[data]
                starts, ends, bounds = word_spans(data, offsets, GAPS)
                if not len(starts):
                    continue
                text = np.repeat(np.arange(end - first), np.diff(bounds))
                piece = np.cumsum(BREAKS[data])[starts] + text
                long = ends - starts
                at = np.concatenate([[0], np.cumsum(long)])
                byte = np.repeat(starts - at[:-1], long) + np.arange(at[-1])
                names = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[byte])]).dictionary_encode()
                many = len(names.dictionary)
                word = langs.indices[first:end].to_numpy()[text].astype(np.int64) * many + names.indices.to_numpy()
                own, number, counts = np.unique(word, return_inverse=True, return_counts=True)
                common = np.argsort(-counts, kind="stable")  # frequent words have small numbers, which pack better
                small = np.empty(len(own), np.int64)
                small[common] = np.arange(1, len(own) + 1)
                own, counts = own[common], counts[common]
                gap = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
                tokens = np.zeros(len(starts) + int(gap[-1]), np.int64)
                tokens[np.arange(len(starts)) + gap] = small[number]
                ends_of = pa.array([0, len(own)], pa.int32())
                columns = [
                    pa.array([uuid.uuid4().hex]),
                    pa.array([_packed_numbers(tokens)], pa.binary()),
                    pa.ListArray.from_arrays(ends_of, names.dictionary.take(pa.array(own % many)).cast(pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(ends_of, langs.dictionary.take(pa.array(own // many))),
                    pa.ListArray.from_arrays(ends_of, pa.array(counts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "tokens", "words", "langs", "counts"])

    return docs.mapInArrow(run, "chunk string, tokens binary, words array<string>, langs array<string>, counts array<long>")


# 2: filters


def permuted(high: np.ndarray, low: np.ndarray, bits: int, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """An invertible permutation of pairs of ``bits`` and 2 * ``bits`` bits, and its inverse."""
    masks = np.uint64((1 << bits) - 1), np.uint64((1 << 2 * bits) - 1)
    for i in reversed(range(4)) if back else range(4):
        if i % 2:
            low = low ^ mix(high ^ KEYS[i]) & masks[1]
        else:
            high = high ^ mix(low ^ KEYS[i]) & masks[0]
    return high, low


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in order, each once with the sum of its counts."""
    if not len(high):
        return high, low, counts
    by = np.argsort(high << np.uint64(2 * bits) | low, kind="stable") if 3 * bits <= 64 else np.lexsort((low, high))
    high, low, counts = high[by], low[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    return high[first], low[first], np.add.reduceat(counts, first)


def _short(values: np.ndarray) -> tuple[bytes, bytes]:
    """A byte for each number; 255 stands for one that follows in the second part."""
    return np.minimum(values, 255).astype(np.uint8).tobytes(), values[values >= 255].astype("<i8").tobytes()


def _long(short: np.ndarray, rest: np.ndarray) -> np.ndarray:
    values = short.astype(np.int64)
    values[short == 255] = rest
    return values


def _cut(values: np.ndarray, width: int) -> bytes:
    """The last ``width`` bytes of each number."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _whole(data: bytes, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.view("<u8").ravel()


def filter_of(high: np.ndarray, low: np.ndarray, counts: np.ndarray, bits: int, block_bits: int) -> bytes:
    """A filter of one block's permuted phrases, which come in order."""
    free = bits - block_bits
    q = min(free, max(0, len(high) - 1).bit_length())
    inner = high & np.uint64((1 << free) - 1)
    runs = np.bincount((inner >> np.uint64(free - q)).astype(np.int64), minlength=1 << q)
    parts = [*_short(runs), *_short(counts), _cut(inner & np.uint64((1 << (free - q)) - 1), (free - q + 7) // 8), _cut(low, (2 * bits + 7) // 8)]
    return np.array([len(high), q, *map(len, parts)], "<i8").tobytes() + b"".join(parts)


def entries_of(packed: bytes, block: int, bits: int, block_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The permuted phrases and counts of a block's filter, in order."""
    n, q, *sizes = np.frombuffer(packed, "<i8", 8).tolist()
    cuts = np.cumsum([64, *sizes]).tolist()
    runs, more_runs, counts, more_counts, inner, low = (packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
    free = bits - block_bits
    quotient = np.repeat(np.arange(1 << q, dtype=np.uint64), _long(np.frombuffer(runs, np.uint8), np.frombuffer(more_runs, "<i8")))
    high = np.uint64(block) << np.uint64(free) | quotient << np.uint64(free - q) | _whole(inner, (free - q + 7) // 8, n)
    return high, _whole(low, (2 * bits + 7) // 8, n), _long(np.frombuffer(counts, np.uint8), np.frombuffer(more_counts, "<i8"))


def phrases(tokens: np.ndarray, bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Two and three words in a row that are not 0 and begin before ``most``: the first word, and the other two (0: no third)."""
    word = tokens.astype(np.uint64)
    two = np.flatnonzero((word[:-1] > 0) & (word[1:] > 0))
    three = two[:-1][np.diff(two) == 1]
    two, three = two[two < most], three[three < most]
    width = np.uint64(bits)
    return np.concatenate([word[two], word[three]]), np.concatenate([word[two + 1] << width, word[three + 1] << width | word[three + 2]])


def _filters(chunks: DataFrame, bits: int, block_bits: int) -> DataFrame:
    """(block, filter): the phrases of a task's chunks, counted together until they are many."""
    shift = np.uint64(bits - block_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))

        def flushed() -> Iterator[pa.RecordBatch]:
            high, low, counts = have
            block = high >> shift
            cuts = [*np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])).tolist(), len(high)]
            for i in range(0, len(cuts) - 1, 256):
                spans = list(zip(cuts[i : i + 256], cuts[i + 1 : i + 257], strict=False))
                packed = [filter_of(high[a:b], low[a:b], counts[a:b], bits, block_bits) for a, b in spans]
                names = pa.array(block[[a for a, _ in spans]].astype(np.int64))
                yield pa.RecordBatch.from_arrays([names, pa.array(packed, pa.binary())], names=["block", "filter"])

        for batch in batches:
            for tokens, local, number in zip(*(batch.column(c) for c in ("tokens", "local", "number")), strict=True):
                known = _unpacked_numbers(tokens.as_py())
                ids = np.zeros(int(known.max(initial=0)) + 1, np.int64)
                ids[local.values.to_numpy()] = number.values.to_numpy()
                ids = ids[known]
                for at in range(0, len(ids), FLUSH):
                    x, y = phrases(ids[at : at + FLUSH + 2], bits, FLUSH)
                    x, y = permuted(x, y, bits)
                    have = summed(*(np.concatenate(p) for p in zip(have, (x, y, np.ones(len(x), np.int64)), strict=True)), bits)
                    if len(have[0]) >= FLUSH:
                        yield from flushed()
                        have = tuple(h[:0] for h in have)
        if len(have[0]):
            yield from flushed()

    return chunks.mapInArrow(run, "block long, filter binary")


def _merged(filters: DataFrame, bits: int, block_bits: int, least: int) -> DataFrame:
    """(x, y, z, a): the phrases that occur often enough, z 0 for two words."""

    def run(key: tuple, batch: pa.Table) -> pa.Table:
        (block,) = (k.as_py() for k in key)
        found = [entries_of(f.as_py(), block, bits, block_bits) for f in batch["filter"]]
        high, low, counts = summed(*(np.concatenate(p) for p in zip(*found, strict=True)), bits)
        often = counts >= least
        x, rest = permuted(high[often], low[often], bits, back=True)
        words = (x, rest >> np.uint64(bits), rest & np.uint64((1 << bits) - 1))
        return pa.table([*(pa.array(w.astype(np.int64)) for w in words), pa.array(counts[often])], names=["x", "y", "z", "a"])

    return filters.groupBy("block").applyInArrow(run, "x long, y long, z long, a long")


# 3: scores


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), in whole numbers of up to 38 digits."""
    whole = lambda c: c.cast("decimal(16,0)")
    product = (whole(a) * whole(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", product, whole(left) * whole(right))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, percent: int = 50, top: int = 2000
) -> DataFrame:
    """The ``top`` phrases of two or three words in each language, by how much oftener they occur than their parts.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line
    ends, and these into words at spaces and tabs. A phrase that occurs ``least``
    times or more is a candidate. At each place where it can be cut, its score
    is floor(1000000 * a * a / (l * r)) from the occurrences of the phrase and of
    both parts; the lowest score counts, of equal ones the first. Candidates
    of two words go if a candidate of three that holds them occurs at least
    ``percent`` per cent as often.

    Returns (lang, rank, phrase, a, l, r, n, score); n is the number of all
    words of the language. Equal scores are ranked by a, then by the phrase's
    bytes. A null text counts as empty, a null language as ``und``. Repeated
    rows count each. An empty table gives no rows. Other columns are not read.
    A worker holds about a hundred times the bytes of its largest chunk or text.
    More than 2 to the 32 frequent words are refused.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    chunks = stored(_chunks(rows), "phrase_chunks")
    entry = F.posexplode(F.arrays_zip("langs", "words", "counts"))
    told = chunks.select("chunk", entry.alias("local", "w")).select(
        "chunk", (F.col("local") + 1).alias("local"), F.col("w.langs").alias("lang"), F.col("w.words").alias("word"), F.col("w.counts").alias("count")
    )
    counted = stored(told.groupBy("lang", "word").agg(F.sum("count").alias("f")), "phrase_words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    often = counted.where(F.col("f") >= least).withColumns({"_all": F.lit(0), "_b": bucket_of(F.col("lang"), F.col("word"), buckets=1024)})
    words = stored(numbered(often, ["_all"], "_b", ["lang", "word"], "id").select("lang", "word", "f", (F.col("id") + 1).alias("id")), "phrase_ids")
    last, n = words.agg(F.max("id")).first()[0] or 1, totals.agg(F.sum("n")).first()[0] or 1
    bits = last.bit_length()
    if bits > MOST_BITS:
        raise ValueError(f"{last} frequent words do not fit into {MOST_BITS} bits")
    block_bits = min(bits, max(0, (2 * n // BLOCK_ROWS).bit_length()))

    # a chunk's own words are bounded by its size, so this row is too
    ids = join_per_key(told.select("chunk", "local", "lang", "word"), words.select("lang", "word", "id"), ["lang", "word"], "inner")
    ids = ids.groupBy("chunk").agg(F.collect_list(F.struct("local", "id")).alias("w"))
    numbers = ids.select("chunk", F.col("w.local").alias("local"), F.col("w.id").alias("number"))
    filters = _filters(chunks.select("chunk", "tokens").join(numbers, "chunk").select("tokens", "local", "number"), bits, block_bits)
    grams = stored(_merged(filters, bits, block_bits, least), "phrase_grams")

    two, three = grams.where("z = 0"), grams.where("z > 0")
    word = {i: words.select(F.col("id").alias(i), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}")) for i in "xyz"}
    lang = words.select(F.col("id").alias("x"), "lang", F.col("word").alias("wx"), F.col("f").alias("fx"))
    covered = three.select("x", "y", "a").unionByName(three.select(F.col("y").alias("x"), F.col("z").alias("y"), "a")).groupBy("x", "y").agg(F.max("a").alias("longer"))
    two = join_per_key(two, covered, ["x", "y"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    two = join_per_key(join_per_key(two.select("x", "y", "a"), lang, ["x"], "inner"), word["y"], ["y"], "inner")
    two = two.select("lang", F.concat_ws(" ", "wx", "wy").alias("phrase"), "a", F.col("fx").alias("l"), F.col("fy").alias("r")).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))

    pair = grams.where("z = 0").select("x", "y", F.col("a").alias("fxy"))
    tail = grams.where("z = 0").select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("fyz"))
    three = join_per_key(join_per_key(three, pair, ["x", "y"], "inner"), tail, ["y", "z"], "inner")
    for side, key in ((lang, "x"), (word["y"], "y"), (word["z"], "z")):
        three = join_per_key(three, side, [key], "inner")
    cut = lambda left, right: F.struct(_score(F.col("a"), F.col(left), F.col(right)).alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))
    three = three.withColumn("one", cut("fx", "fyz")).withColumn("two", cut("fxy", "fz"))
    lowest = F.when(F.col("one.score") <= F.col("two.score"), F.col("one")).otherwise(F.col("two"))
    three = three.select("lang", F.concat_ws(" ", "wx", "wy", "wz").alias("phrase"), "a", lowest.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
