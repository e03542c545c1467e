"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding undoes disguises: compatibility forms, look-alike letters of other
scripts, digits and signs for letters, zero-width characters and combining
marks; what is not a letter becomes a space. Lexicon and text are folded alike.
An entry is a whole word or the beginning of one; it matches at a word's
beginning. Words of exception phrases don't count. What the matches weigh is
set against the length of the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import stored

MOST_LABELLED = 20_000
LEAST_TEXTS = 3
CHANCE = 1e-4
PREFIXES = (4, 5, 6)

# look-alikes of Latin letters, by what they look like
_ALIKE = {
    "a": "аαɑ", "b": "вьβ", "c": "сϲ", "d": "ԁ", "e": "еεє", "h": "һн", "i": "іιı", "j": "ј", "k": "кκ", "l": "ӏ",
    "m": "м", "n": "ո", "o": "оοσ", "p": "рρ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "νѵ", "w": "ԝω", "x": "хχ", "y": "уγ",
}
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "€": "e"}
_NOTHING = "\u200b\u200c\u200d\u2060\ufeff\u00ad"


class _Fold(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c).lower()
        if len(plain) == 1 and ord(plain) in self:
            out = self[ord(plain)]
        elif unicodedata.combining(c):
            out = ""
        else:
            out = "".join(x if x.isalpha() else " " for x in plain)
        self[code] = out
        return out


_FOLD = _Fold({ord(x): k for k, v in _ALIKE.items() for x in v} | {ord(k): v for k, v in _SIGNS.items()} | dict.fromkeys(map(ord, _NOTHING), ""))


def fold(text: str) -> str:
    """The text with disguises undone, words apart by single places that are not letters; ``l`` and ``i`` are one letter."""
    return text.translate(_FOLD).replace("l", "i")


class Lexicon:
    """Entries with weights; `` word`` matches a word that begins so, `` word `` the whole word."""

    def __init__(self, weights: dict[str, float], exceptions: Iterable[str] = (), scale: tuple[float, float, float] = (-4.0, 2.0, 0.0)):
        self.weights, self.exceptions, self.scale = dict(weights), sorted({f" {fold(e).strip()} " for e in exceptions}), scale

    def machine(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight, False))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), 0.0, True))
        found.make_automaton()
        return found


def weigh(machine: ahocorasick.Automaton, text: str) -> tuple[float, int]:
    """(weight of the matches, words): a word counts with its heaviest entry, once; not inside an exception phrase."""
    split = fold(text).split()
    folded = " " + " ".join(split) + " "
    if not len(machine):
        return 0.0, len(split)
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, weight, spare) in machine.iter(folded):
        start = end - size + 1
        if spare:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if not spared:
        return sum(best.values()), len(split)
    spared.sort()
    weight, reach, i = 0.0, -1, 0  # reach: how far the phrases that begin up to here go
    for start in sorted(best):
        while i < len(spared) and spared[i][0] <= start:
            reach = max(reach, spared[i][1])
            i += 1
        if start >= reach:
            weight += best[start]
    return weight, len(split)


def _scores(weight: np.ndarray, words: np.ndarray, scale: tuple[float, float, float]) -> np.ndarray:
    """Between 0 and 1, from the weight of the matches and its share of the words."""
    z = scale[0] + scale[1] * np.log1p(weight) + scale[2] * np.log1p(100 * weight / np.maximum(words, 1))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(id_column: Column) -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    exceptions: Iterable[str] = (), most_labelled: int = MOST_LABELLED, least_texts: int = LEAST_TEXTS, chance: float = CHANCE,
) -> Lexicon:
    """A lexicon from at most ``most_labelled`` labelled rows that are not held out, those whose ids hash lowest.

    Entries are words and beginnings of words that stand in ``least_texts``
    marked texts, are at least twenty times likelier there than in unmarked ones, and
    would be found so often in marked texts by chance with a probability of
    ``chance`` at most (Chernoff's bound). So what an entry has to reach doesn't
    rise with the sample, and their number isn't limited. A beginning stands for
    the words it begins. Words under an entry that are themselves found in
    unmarked texts rather than marked ones become exceptions. Null ids and
    labels are left out; an id with several rows has all their texts. Without
    marked and unmarked rows the lexicon is empty and scores are low.
    """
    marks = labels.select(F.col(id_col).alias("_i"), F.col(label_col).cast("int").alias("_y"))
    marks = marks.where(F.col("_i").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_i")))
    sample = stored(marks.withColumn("_o", F.xxhash64("_i")).orderBy("_o", "_i", "_y").limit(most_labelled).drop("_o"), "toxic_sample")
    joined = docs.select(F.col(id_col).alias("_i"), F.col(text_col).cast("string").alias("_t")).join(F.broadcast(sample), "_i")
    texts = stored(joined.select("_y", F.coalesce("_t", F.lit("")).alias("_t")), "toxic_texts")
    size = {r[0]: r[1] for r in texts.groupBy("_y").count().collect()}
    if not (size.get(0) and size.get(1)):
        return Lexicon({}, exceptions)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for y, t in zip(batch.column("_y").to_pylist(), batch.column("_t"), strict=True):
                words = set(fold(t.as_py()).split())
                for e in {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n}:
                    counts.setdefault(e, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *(pa.array([c[y] for c in counts.values()], pa.int64()) for y in (0, 1))], names=["entry", "no", "yes"]
        )

    counted = texts.mapInArrow(entries, "entry string, no long, yes long").groupBy("entry").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    weight = F.log((F.col("yes") + 0.5) / (size[1] + 1)) - F.log((F.col("no") + 0.5) / (size[0] + 1))
    share = size[1] / (size[0] + size[1])
    own = F.col("yes") / (F.col("yes") + F.col("no"))
    surprise = F.col("yes") * F.log(own / share) + F.col("no") * F.log(F.greatest((1 - own) / (1 - share), F.lit(1e-300)))
    often = (F.col("yes") >= least_texts) & (F.col("w") >= float(np.log(20))) & (surprise >= -float(np.log(chance)))
    rows = counted.withColumn("w", weight).where(often).collect()  # bounded by the sample's words
    weights: dict[str, float] = {}
    for r in sorted(rows, key=lambda r: (len(r["entry"].strip()), r["entry"])):
        entry = r["entry"]
        if not any(entry.startswith(e) for e in (entry[: n + 1] for n in PREFIXES) if e != entry and e in weights):
            weights[entry] = r["w"]
    stems = [e for e in weights if not e.endswith(" ")]
    spared = []
    if stems:
        under = F.lit(False)
        for n in PREFIXES:
            under = under | F.substring("entry", 1, n + 1).isin([e for e in stems if len(e) == n + 1])
        clean = counted.where(under & F.col("entry").endswith(" ") & (F.col("no") >= LEAST_TEXTS) & (F.col("no") / size[0] > F.col("yes") / size[1]))
        spared = [r["entry"].strip() for r in clean.collect()]
    lexicon = Lexicon(weights, [*exceptions, *spared])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.machine()
        for batch in batches:
            got = [weigh(machine, t.as_py()) for t in batch.column("_t")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_y"), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64())], names=["y", "weight", "words"]
            )

    # three numbers, and how many texts of the sample have them
    seen = texts.mapInArrow(weighed, "y int, weight double, words long").groupBy("y", "weight", "words").count().orderBy("y", "weight", "words").collect()
    y, w, n, many = (np.array([r[c] for r in seen], float) for c in ("y", "weight", "words", "count"))
    x = np.stack([np.ones(len(y)), np.log1p(w), np.log1p(100 * w / np.maximum(n, 1))], 1)
    beta = np.array([-2.0, 0.5, 0.5])
    for _ in range(30):  # Newton steps of a ridge logistic regression on three numbers
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (many * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
        beta = beta + np.linalg.solve(hessian, x.T @ (many * (y - p)) - 0.5 * beta)
    return Lexicon(weights, [*exceptions, *spared], tuple(map(float, beta)))


def scored(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; null texts count as empty, and empty ones have the score of no match.

    Works on rows where they are. Null ids and repeated rows are kept. Other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.machine()
        for batch in batches:
            got = [weigh(machine, t.as_py() or "") for t in batch.column("_t")]
            weight, words = np.array([g[0] for g in got], float), np.array([g[1] for g in got], float)
            yield pa.RecordBatch.from_arrays([batch.column("_i"), pa.array(_scores(weight, words, lexicon.scale))], names=["_i", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.struct(F.col(id_col).alias("i")).alias("_i"), F.col(text_col).cast("string").alias("_t"))
    return slim.mapInArrow(run, f"_i struct<i:{kind}>, score double").select(F.col("_i.i").alias(id_col), "score")
