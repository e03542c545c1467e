"""What a worker of the repeats operator holds does not grow with its task, and pieces lose no match."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from loadkit.llm import repeats
from loadkit.llm.common import BATCH_BYTES
from tests.llm.helpers import SCHEMA, without_repeats
from tests.llm.test_repeats import passages, result


class Frame:
    """Gives the function that a worker would run."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def batch(**columns):
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def texts(n, seed=1):
    """Batches of 1 MB, in texts of 2 KB."""
    dice = np.random.default_rng(seed)
    for i in range(n):
        made = dice.integers(97, 123, (500, 2048), np.uint8)
        yield batch(id=pa.array(np.arange(500) + 500 * i), text=pa.array([t.tobytes().decode() for t in made]))


def entries(n, seed=2):
    """Batches in order of buckets, each with 200,000 blocks."""
    dice = np.random.default_rng(seed)
    for i in range(n):
        packed = [dice.integers(0, 2**31, 10_000).astype(kind).tobytes() for kind in (np.uint32, np.uint64, np.int64) for _ in range(20)]
        yield batch(
            bucket=pa.array(np.full(20, i, np.int32)), id=pa.nulls(20, pa.int64()), hashes=pa.array(packed[:20]), blocks=pa.array(packed[20:40]), docs=pa.array(packed[40:])
        )


def contexts(n, seed=3, same=False):
    """Batches in order of keys, or all of one key, each of 5,000 blocks of 76 bytes, or of one."""
    dice = np.random.default_rng(seed)
    one = dice.integers(97, 123, 76, np.uint8).tobytes()
    for i in range(n):
        at = np.arange(5000) + 5000 * i
        made = [one] * 5000 if same else [t.tobytes() for t in dice.integers(97, 123, (5000, 76), np.uint8)]
        yield batch(key=pa.array(at * 0 if same else at // 10), id=pa.array(at), block=pa.array(at), step=pa.array((at * 0).astype(np.int32)), bytes=pa.array(made))


def peak(run, batches):
    tracemalloc.start()
    try:
        for _ in run(batches):
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize(
    "run, made, few, many",
    [
        (lambda: repeats._entries(Frame(), 50, 24, 64), texts, 5, 20),
        (lambda: repeats._judged(Frame()), entries, 3, 12),
        (lambda: repeats._compared(Frame(), 50), contexts, 3, 12),
        (lambda: repeats._compared(Frame(), 50), lambda n: contexts(n, same=True), 3, 12),
    ],
    ids=["entries", "judged", "compared", "one key"],
)
def test_a_longer_task_holds_no_more(run, made, few, many):
    run = run()
    peak(run, made(1))
    assert peak(run, made(many)) < 1.4 * peak(run, made(few))


def test_a_block_that_a_text_repeats_goes_out_once():
    line = "one and the same line is in this text again and again, over and over\n"
    _, _, _, _, block = repeats.blocks_of(np.frombuffer(line.encode() * 300, np.uint8), np.array([0, 300 * len(line)]), 50, 24)
    assert len(block) > 4 * len(np.unique(block))
    asked = batch(id=pa.array([7]), text=pa.array([line * 300]), blocks=pa.array([[block.tobytes()]]), hot_blocks=pa.array([None], pa.list_(pa.binary())))
    assert sum(b.num_rows for b in repeats._contexts(Frame(), 50, 24)([asked])) == len(np.unique(block))


@pytest.mark.parametrize("hot", [1, 50_000])
def test_small_pieces_lose_no_match(spark, monkeypatch, conf, hot):
    monkeypatch.setattr(repeats, "HOT_BLOCKS", hot)
    monkeypatch.setattr(repeats, "PIECE_BLOCKS", 5)
    monkeypatch.setattr(repeats, "PIECE_WINDOWS", 7)
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="3")
    rows = passages(50, 7)
    rows += [(None, rows[3][1]), (None, rows[4][1] * 2), (None, rows[4][1] + "tail " * 20), (90, "tail " * 30), (91, None)]
    assert result(repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3))) == sorted(without_repeats(rows), key=repr)


def test_texts_go_to_python_in_small_batches(spark):
    seen = []

    class Docs:
        sparkSession = spark
        schema = spark.createDataFrame([], SCHEMA).schema

        def select(self, *_):
            seen.append(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
            raise InterruptedError

    with pytest.raises(InterruptedError):
        repeats.remove_repeats(Docs())
    assert seen == [str(BATCH_BYTES)]
