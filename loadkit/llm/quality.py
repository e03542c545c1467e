"""Quality by ordinal cumulative-link regression on hashed text.

For graded ratings g with grades in order, P(grade > k | text) is
sigmoid(f(text) - t_k): one weight per hash bucket, shared by all grades, and
thresholds t_0 < t_1 < ... that are kept in order by construction. The model
gives an expected grade, and the tail probability of a grade or better.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import in_small_batches, stored
from loadkit.llm.textbytes import LOWER, PIECE_BYTES, hash_spans, mix, prefix_hashes, slices, word_spans

DIMS = 1 << 16
MOST_LABELLED = 20_000
SHARDS = 8
ROUNDS = 3

# kinds of bytes in a word's shape; other bytes stand for themselves
_KIND = np.arange(256, dtype=np.uint8)
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("a") : ord("z") + 1] = ord("a")
_KIND[0x80:] = ord("a")
_KIND[ord("0") : ord("9") + 1] = ord("0")


def features(data: np.ndarray, offsets: np.ndarray, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value): words, word shapes with runs of a kind as one, and binned measures of the whole text.

    Words and shapes count with their share of the text's words. A text
    without words has its measures alone.
    """
    starts, ends, words = word_spans(data, offsets)
    n = np.diff(words)
    owner = np.repeat(np.arange(len(n)), n)
    share = 1.0 / np.sqrt(np.maximum(n, 1))[owner] / np.sqrt(np.maximum(n, 1))[owner]
    hashes = hash_spans(prefix_hashes(LOWER[data]), starts, ends)
    kind = _KIND[data]
    turn = np.ones(len(kind), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[starts] = True
    place = np.concatenate([[0], np.cumsum(turn)])
    shapes = hash_spans(prefix_hashes(kind[turn]), place[starts], place[ends])

    def per_text(flag: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flag, len(n)) / np.maximum(n, 1)

    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    seen = np.zeros(len(hashes), bool)
    seen[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    size = ends - starts
    upper = np.concatenate([[0], np.cumsum(kind == ord("A"))])
    plain = np.concatenate([[0], np.cumsum((kind == ord("A")) | (kind == ord("a")))])
    measures = [
        np.minimum(np.log2(n + 1), 15),
        per_text(again) * 15,
        per_text(seen) * 15,
        per_text((upper[ends] - upper[starts]) == size) * 15,
        per_text((plain[ends] - plain[starts]) == 0) * 15,
        per_text((plain[ends] - plain[starts]) < size) * 15,
        np.minimum(per_text(size), 30) / 2,
    ]
    texts, buckets, values = [owner, owner], [hashes, shapes + np.uint64(1)], [share, share]
    for i, measure in enumerate(measures):
        texts.append(np.arange(len(n)))
        buckets.append(mix(np.ceil(measure).astype(np.uint64) + np.uint64(1000 * (i + 1))))
        values.append(np.full(len(n), 0.3))
    bucket = np.concatenate(buckets) % np.uint64(dims)
    return np.concatenate(texts), bucket.astype(np.int64), np.concatenate(values)


@dataclass
class Model:
    grades: list[float]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score and each grade but the last."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -30, 30)))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, bucket, value = features(data, offsets, len(self.weights))
        return np.bincount(text, self.weights[bucket] * value, len(offsets) - 1)


def _gaps(thresholds: np.ndarray) -> np.ndarray:
    """The first threshold and the logs of the gaps: any values of these give ordered thresholds."""
    return np.concatenate([thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-6))])


def _ordered(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))


def descend(grade, text, bucket, value, weights, thresholds, epochs: int = 6, batch: int = 128, rate: float = 0.3, l2: float = 1e-6, seed: int = 0):
    """Minibatch gradient descent with a rate per weight; returns new weights and thresholds."""
    weights, gaps = weights.copy(), _gaps(thresholds)
    order = np.argsort(text, kind="stable")
    text, bucket, value = text[order], bucket[order], value[order]
    begin = np.searchsorted(text, np.arange(len(grade) + 1))
    sums, sums_gaps = np.full(len(weights), 1e-6), np.full(len(gaps), 1e-6)
    dice = np.random.default_rng(seed)
    steps = np.arange(len(gaps))
    for _ in range(epochs):
        deal = dice.permutation(len(grade))
        for at in range(0, len(deal), batch):
            rows = deal[at : at + batch]
            size = begin[rows + 1] - begin[rows]
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[rows], size)
            who = np.repeat(np.arange(len(rows)), size)
            f = np.bincount(who, weights[bucket[place]] * value[place], len(rows))
            thresholds = _ordered(gaps)
            above = 1 / (1 + np.exp(-np.clip(f[:, None] - thresholds, -30, 30)))
            edge = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], 1)
            g = grade[rows]
            line = np.arange(len(rows))
            chance = np.maximum(edge[line, g] - edge[line, g + 1], 1e-9)
            slope = edge * (1 - edge)  # derivative of each bound with respect to f
            down = -(slope[line, g] - slope[line, g + 1]) / chance
            touched = bucket[place]
            gradient = np.bincount(touched, value[place] * down[who], len(weights)) / len(rows)
            gradient += l2 * weights
            by_threshold = np.zeros((len(rows), len(thresholds) + 2))
            np.add.at(by_threshold, (line, g), slope[line, g] / chance)
            np.add.at(by_threshold, (line, g + 1), -slope[line, g + 1] / chance)
            by_threshold = by_threshold[:, 1:-1].mean(0)
            inner = np.array([by_threshold[s:].sum() * (1.0 if s == 0 else np.exp(gaps[s])) for s in steps])
            sums += gradient * gradient
            sums_gaps += inner * inner
            weights -= rate * gradient / np.sqrt(sums)
            gaps -= rate * inner / np.sqrt(sums_gaps)
    return weights, _ordered(gaps)


@in_small_batches
def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "quality", dims: int = DIMS, most_labelled: int = MOST_LABELLED) -> Model | None:
    """A model from at most ``most_labelled`` labelled rows, those whose ids hash lowest.

    The sample is dealt to ``SHARDS`` tasks; each descends from the mean of the
    last round's models, and the means are taken ``ROUNDS`` times. Rows with a
    null id or grade are left out, as are labels without a document; a label
    that is there twice counts twice. Without two grades there is no model: None.
    """
    spark = docs.sparkSession
    marks = labels.select(F.col(id_col).alias("_i"), F.col(grade_col).cast("double").alias("_g")).where("_i is not null and _g is not null")
    sample = marks.withColumn("_o", F.xxhash64("_i")).orderBy("_o", "_i", "_g").limit(most_labelled)
    sample = stored(sample, "quality_sample")
    grades = [r[0] for r in sample.select("_g").distinct().orderBy("_g").collect()]  # at most the sample's
    if len(grades) < 2:
        return None
    rows = docs.select(F.col(id_col).alias("_i"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "_i")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                text, bucket, value = features(data, offsets, dims)
                key = text * dims + bucket
                kept, back = np.unique(key, return_inverse=True)
                total = np.bincount(back, value).astype(np.float32)
                bounds = np.searchsorted(kept, np.arange(end - start + 1) * dims).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_o").slice(start, end - start),
                        batch.column("_g").slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array((kept % dims).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(total)),
                    ],
                    names=["o", "g", "buckets", "values"],
                )

    examples = stored(rows.select("_o", "_g", "text").mapInArrow(featured, "o long, g double, buckets array<int>, values array<float>"), "quality_examples")
    counts = {r[0]: r[1] for r in examples.groupBy("g").count().collect()}
    grades = sorted(counts)
    if len(grades) < 2:
        return None
    total = sum(counts.values())
    tail = np.array([sum(counts[g] for g in grades[k + 1 :]) / total for k in range(len(grades) - 1)])
    model = Model(grades, np.zeros(dims), -np.log(tail / (1 - tail)))
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((model.weights, model.thresholds))  # of fixed size

        def learn(key: tuple, group: pa.Table) -> pa.Table:
            group = group.combine_chunks().sort_by([("o", "ascending")])
            weights, thresholds = shared.value
            grade = np.searchsorted(np.array(grades), group["g"].to_numpy())
            lists = group["buckets"].combine_chunks()
            text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            values = group["values"].combine_chunks().flatten().to_numpy().astype(np.float64)
            found = descend(grade, text, lists.flatten().to_numpy().astype(np.int64), values, weights, thresholds, seed=turn)
            return pa.table({"weights": [found[0].tobytes()], "thresholds": [found[1].tolist()], "n": [group.num_rows]})

        shards = examples.withColumn("shard", F.pmod(F.col("o"), F.lit(SHARDS)))
        learnt = shards.groupBy("shard").applyInArrow(learn, "weights binary, thresholds array<double>, n long").collect()  # SHARDS rows
        part = np.array([r["n"] for r in learnt], float) / sum(r["n"] for r in learnt)
        model.weights = sum(p * np.frombuffer(r["weights"]) for p, r in zip(part, learnt, strict=True))
        model.thresholds = sum(p * np.array(r["thresholds"]) for p, r in zip(part, learnt, strict=True))
    return model


def graded(docs: DataFrame, model: Model | None, text_col: str = "text", at_least: float | None = None, select: float = 0.5) -> DataFrame:
    """(row, expected_grade, tail, selected) for every row, ``row`` being the whole input row.

    ``tail`` is the probability of the grade ``at_least`` or better (by default
    the second lowest); rows with a tail of ``select`` or more are selected.
    Works on rows where they are: no shuffle. Null texts count as empty ones.
    Without a model grades are null and every row is selected.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return whole.select("row", F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail"), F.lit(True).alias("selected"))
    level = 0 if at_least is None else max(0, int(np.searchsorted(model.grades, at_least)) - 1)
    steps = np.diff(model.grades)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                above = shared.value.above(shared.value.scores(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, end - start), pa.array(model_low + above @ steps), pa.array(above[:, level])],
                    names=["row", "expected_grade", "tail"],
                )

    model_low = model.grades[0]
    scored = whole.mapInArrow(run, f"row {whole.schema['row'].dataType.simpleString()}, expected_grade double, tail double")
    return scored.withColumn("selected", F.col("tail") >= select)
