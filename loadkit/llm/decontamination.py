"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; what is left of a question
is its template. Windows of template words are joined by hash between
documents and benchmark items. Windows that follow one another in both are a
run, and in a run the values that fill the placeholders must be consistent: a
value of the item always stands against the same value of the document, and
the other way round. So a question with other numbers and names is found, and
a text that only has the same shape is not.

Windows are also hashed with names as words, and with all values, both
lower-cased. What the writing or the words around it make of a placeholder
cannot hide a copy then, and windows that are placeholders for the most part
match if their values are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import hash_bits, in_bits, in_small_batches, stored
from loadkit.llm.textbytes import LOWER, PIECE_BYTES, hash_spans, mix, prefix_hashes, slices, word_spans

WINDOW = 8
LEAST_ORDINARY = 4
LEAST_RUN = 13
LEAST_WORDS = 3
FILTER_BITS = 1 << 24

# fixed values: units and their plurals
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes pound pounds lb lbs "
    "ounce ounces oz ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks month months "
    "year years meter meters metre metres dollar dollars cent cents euro euros percent degree degrees"
).split()
_UNIT_HASHES = np.sort(
    np.concatenate([hash_spans(prefix_hashes(b), np.array([0]), np.array([len(b)])) for b in (np.frombuffer(u.encode(), np.uint8) for u in UNITS)])
)
NUMBER, NAME, UNIT = (np.uint64(mix(np.array([k], np.uint64))[0]) for k in (101, 102, 103))
_PLACEHOLDERS = np.array([0, NUMBER, UNIT, NAME], np.uint64)

_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_PART = _DIGIT.copy()  # what a number may hold besides digits
_PART[[ord(c) for c in ".,+-/%$:"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = _LETTER[0x80:] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;|"]] = True


def templates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each word of a slice: value hash, placeholder (0 for none), whether it is capitalised; and where each text's words begin.

    Signs around a word are left off; words that are nothing else are left out.
    A number has a digit and no letters. A unit is one of ``UNITS`` right after
    a number. A name is capitalised (one capital, then a small letter) and
    neither begins a sentence nor a text. Other words stand for themselves,
    lower-cased (A-Z).
    """
    starts, ends, _ = word_spans(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, np.zeros(0, np.int8), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    solid = _LETTER[data] | _DIGIT[data]
    at = np.flatnonzero(solid)
    low, high = np.searchsorted(at, starts), np.searchsorted(at, ends)
    real = high > low
    stop_before = np.concatenate([[True], _STOP[data[ends[:-1] - 1]]])
    stop_before |= np.isin(starts, offsets[:-1])
    break_at = np.concatenate([[0], np.cumsum(data == 0x0A)])
    stop_before[1:] |= break_at[starts[1:]] > break_at[ends[:-1] - 1]
    # a stop carries over words that are left out
    carried = np.cumsum(stop_before)[real]
    starts, ends = at[low[real]], at[high[real] - 1] + 1
    stops = np.ones(len(starts), bool)
    stops[1:] = carried[1:] > carried[:-1]
    words = np.searchsorted(starts, offsets)
    stops[words[:-1][words[:-1] < len(starts)]] = True
    lowered = prefix_hashes(LOWER[data])
    value = hash_spans(lowered, starts, ends)
    digits, letters = (np.concatenate([[0], np.cumsum(x[data])]) for x in (_DIGIT, _LETTER))
    number = (digits[ends] > digits[starts]) & (letters[ends] == letters[starts])
    second = data[np.minimum(starts + 1, len(data) - 1)]
    capital = _UPPER[data[starts]] & (ends - starts > 1) & _LETTER[second] & ~_UPPER[second]
    unit = np.zeros(len(starts), bool)
    unit[1:] = number[:-1] & ~stops[1:]
    unit &= np.isin(value, _UNIT_HASHES)
    kind = np.select([number, unit, capital & ~stops], [1, 2, 3], 0).astype(np.int8)
    return value, kind, capital, words


def windows(data: np.ndarray, offsets: np.ndarray, width: int, short: Iterable[int] = ()) -> tuple[np.ndarray, ...]:
    """(text, first word, words, form, hash) of the windows in their forms, and what ``templates`` gives.

    Form 0 has all placeholders; 1 takes the first word, if capitalised, the
    other way, as a name or as a word; 2 has names as words; 3 has no
    placeholders. The first three need enough ordinary words; none is there
    twice. Hashes of different forms are equal where what they hold is equal.
    Windows of the ``short`` widths are in the last form only.
    """
    value, kind, capital, words = templates(data, offsets)
    plain = np.where(kind == 3, value, _PLACEHOLDERS[kind]) if len(kind) else value
    plain = np.where(kind == 0, value, plain)
    template = np.where(kind == 3, NAME, plain)
    before = lambda x: np.concatenate([[0], np.cumsum(x)])
    names, slots = before(kind == 3), before(kind > 0)
    base = np.uint64(0x9E3779B97F4A7C15)

    def placed(size: int) -> tuple[np.ndarray, ...]:
        many = np.maximum(np.diff(words) - size + 1, 0)
        text = np.repeat(np.arange(len(many)), many)
        first = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return text, first, first + words[:-1][text]

    def summed(of: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        total = np.zeros(len(place), np.uint64)
        for i in range(size):
            total = total * base + of[place + i] if len(place) else total
        return total

    out = []
    for size in sorted({n for n in short if n < width}):
        text, first, place = placed(size)
        out.append((text, first, np.full(len(text), size), np.full(len(text), 3), summed(value, place, size)))
    text, first, place = placed(width)
    least = min(width, LEAST_ORDINARY)
    n_names, n_slots = names[place + width] - names[place], slots[place + width] - slots[place]
    rich = width - n_slots >= least
    total = summed(template, place, width)
    lead = kind[place] if len(place) else np.zeros(0, np.int8)
    turned = np.where(lead == 3, n_slots - 1, n_slots + 1)
    turn = ((lead == 3) | (lead == 0)) & (capital[place] if len(place) else False) & (turned > 0) & (width - turned >= least)
    power = np.uint64(pow(int(base), width - 1, 1 << 64))
    at = place[turn]
    turned_hash = total[turn] + (np.where(kind[at] == 3, value[at], NAME) - template[at]) * power
    some = (n_names > 0) & (n_slots > n_names) & (width - n_slots + n_names >= least)
    for form, keep, sums in ((0, rich, total[rich]), (1, turn, turned_hash), (2, some, summed(plain, place[some], width)), (3, n_slots > 0, summed(value, place[n_slots > 0], width))):
        out.append((text[keep], first[keep], np.full(len(sums), width), np.full(len(sums), form), sums))
    text, first, size, form, total = map(np.concatenate, zip(*out, strict=True))
    return text, first, size, form, mix(total), value, kind, words


WINDOWS = "key {0}, words int, at int, form int, hash long, slots array<struct<value:bigint,free:boolean>>"


def _windows(texts: DataFrame, width: int, bits=None, short: Iterable[int] = ()) -> DataFrame:
    """A row for each form of each window of (key, text); with ``bits``, only for those whose hash may be among the benchmark's.

    Without, texts shorter than a window are one window of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, _, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                text, first, size, form, hashes, value, kind, words = windows(data, offsets, width, short if bits is not None else range(LEAST_WORDS, width))
                count = np.diff(words)
                keep = in_bits(hashes, bits.value) if bits is not None else (size == width) | (size == count[text])
                text, first, size, form, hashes = (x[keep] for x in (text, first, size, form, hashes))
                place = words[:-1][text] + first
                each = np.repeat(np.arange(len(place)), size)
                inner = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
                word = place[each] + inner
                turned = (form[each] == 1) & (inner == 0)
                slot = (kind[word] > 0) | turned
                each, word, turned = each[slot], word[slot], turned[slot]
                filler = kind[word]
                free = np.where(turned, filler == 0, (form[each] < 2) | ((form[each] == 2) & (filler != 3)))
                slots = pa.StructArray.from_arrays([pa.array(value[word].view(np.int64)), pa.array(free)], ["value", "free"])
                bounds = np.searchsorted(each, np.arange(len(place) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(start + text)),
                        pa.array(count[text].astype(np.int32)),
                        pa.array(first.astype(np.int32)),
                        pa.array(form.astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(bounds), slots),
                    ],
                    names=["key", "words", "at", "form", "hash", "slots"],
                )

    return texts.select("key", "text").mapInArrow(run, WINDOWS.format(texts.schema["key"].dataType.simpleString()))


@in_small_batches
def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    width: int = WINDOW, least_run: int = LEAST_RUN,
) -> DataFrame:
    """(id, text_key, item, run_words, share, verbatim): documents that hold a benchmark item, one row for each such pair.

    A document holds an item if one of its runs has ``least_run`` words of the
    item's template, or all of an item with fewer, with consistent values.
    ``share`` is the part of the item's words in the longest such run;
    ``verbatim`` says that no value differs in it. Windows with fewer than four
    ordinary words, and items shorter than a window, are found by the same
    values only, in whatever case (A-Z); items of one or two words cannot be
    told from chance and are not looked for. Values need to be consistent in
    one of: the whole run, its windows of templates, its windows of equal values.

    ``text_key`` is a hash of the document's text, so that rows with one id can
    be told apart. Null or empty texts hold nothing; null ids, repeated rows
    (one result each) and empty tables are allowed. Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    items = benchmark.select(F.struct(F.col(item_col).alias("item")).alias("key"), F.col(item_text_col).cast("string").alias("text"))
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("t")).alias("key"), text.alias("text"))
    asked = stored(_windows(items, width), "items")
    bits = spark.sparkContext.broadcast(hash_bits(asked.select("hash"), FILTER_BITS))  # of fixed size
    short = [r[0] for r in asked.where(F.col("words") < width).select("words").distinct().collect()]  # fewer than ``width`` numbers
    found = stored(_windows(rows, width, bits, short), "windows")
    wanted = asked.select(
        "hash", F.col("key.item").alias("item"), F.col("words").alias("item_words"), F.col("at").alias("item_at"), F.col("form").alias("item_form"),
        F.filter("slots", lambda x: x["free"]).alias("item_free"), F.filter("slots", lambda x: ~x["free"]).alias("item_bound"),
    )
    pair = lambda a, b: F.struct(a.alias("of_item"), b.alias("of_doc"))
    pairs = (
        found.withColumn("doc_free", F.filter("slots", lambda x: x["free"]))
        .join(wanted, "hash")
        .withColumn("shift", F.col("at") - F.col("item_at"))
        .withColumn(
            "values",
            F.concat(
                F.transform(F.arrays_zip("doc_free", "item_free"), lambda z: pair(z["item_free"]["value"], z["doc_free"]["value"])),
                F.transform("item_bound", lambda x: pair(x["value"], x["value"])),
            ),
        )
        # runs of all windows, of those that are templates, and of those with equal values
        .withColumn("kinds", F.array_compact(F.array(F.lit(0), F.when((F.col("form") == 0) & (F.col("item_form") == 0), 1), F.when(F.size("item_free") == 0, 2))))
        .select("key", "item", "item_words", "shift", F.explode("kinds").alias("kind"), "item_at", "values")
        .groupBy("key", "item", "item_words", "shift", "kind", "item_at")
        .agg(F.min(F.struct(F.size("values").alias("n"), "values"))["values"].alias("values"))
    )
    line = ["key", "item", "item_words", "shift", "kind"]
    island = pairs.withColumn("island", F.col("item_at") - F.row_number().over(Window.partitionBy(*line).orderBy("item_at")))
    runs = island.groupBy(*line, "island").agg(
        (F.max("item_at") - F.min("item_at") + F.least(F.lit(width), F.max("item_words"))).alias("run_words"),
        F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"),
    )
    one_way = F.size(F.array_distinct(F.transform("values", lambda v: v["of_item"])))
    other_way = F.size(F.array_distinct(F.transform("values", lambda v: v["of_doc"])))
    good = runs.where((F.size("values") == one_way) & (F.size("values") == other_way) & (F.col("run_words") >= F.least(F.lit(least_run), F.col("item_words"))))
    best = good.groupBy("key", "item").agg(
        F.max(F.struct("run_words", F.forall("values", lambda v: v["of_item"] == v["of_doc"]).alias("verbatim"), "item_words")).alias("best")
    )
    return best.select(
        F.col("key.id").alias(id_col),
        F.col("key.t").alias("text_key"),
        F.col("item").alias(item_col),
        "best.run_words",
        (F.col("best.run_words") / F.col("best.item_words")).alias("share"),
        "best.verbatim",
    )
