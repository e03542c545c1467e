"""Quality, toxicity, decontamination and neighbours."""

import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadkit.llm import decontamination, neighbours, quality, toxicity
from loadkit.llm.common import components
from loadkit.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import SCHEMA, no_docs, odd_docs

LARGER = "/root/testdata/sf0.1"


def test_quality_on_rows_it_did_not_learn_from(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    rest = F.xxhash64("doc_id") % 4 == 0
    model = quality.fit(docs, labels.where(~rest))
    got = quality.graded(docs, model).select("row.doc_id", "selected", "tail").join(labels.where(rest), "doc_id").collect()
    assert np.mean([r.selected == (r.quality == 1) for r in got]) > 0.97
    assert all(0 <= r.tail <= 1 for r in got)


def test_quality_with_several_grades(spark):
    """Grades that go up with the share of one kind of word: thresholds stay in order and the expected grade follows."""
    dice = np.random.default_rng(1)
    rows = []
    for i in range(1500):
        g = i % 4
        rows.append((i, " ".join("good" if dice.random() < 0.1 + 0.27 * g else "BAD!!" for _ in range(60)), float(g)))
    docs = spark.createDataFrame(rows, SCHEMA + ", quality double")
    model = quality.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    got = quality.graded(docs, model, at_least=2).select("row.quality", "expected_grade", "selected").collect()
    assert np.corrcoef([r.quality for r in got], [r.expected_grade for r in got])[0, 1] > 0.9
    assert np.mean([r.selected == (r.quality >= 2) for r in got]) > 0.9


def test_quality_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, None), (None, 1), (99, 0), (7, 1)], "doc_id long, quality int")
    got = quality.graded(docs, quality.fit(docs, labels)).collect()
    assert len(got) == docs.count() and got[0].row.asDict().keys() == set(docs.columns)
    assert all(0 <= r.tail <= 1 for r in got)
    assert quality.fit(docs, labels.where("false")) is None
    assert all(r.selected for r in quality.graded(docs, None).collect())
    assert quality.graded(no_docs(spark), quality.fit(docs, labels)).collect() == []


def test_toxicity_on_held_out_rows(spark):
    got = QUERIES["op9_toxicity"](spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_folds_disguises_and_spares_phrases():
    lexicon = toxicity.Lexicon({" idiot".replace("l", "i"): 5.0, toxicity.fold(" scum "): 4.0}, ["idiot savant"])
    machine = lexicon.machine()
    weight = lambda t: toxicity.weigh(machine, t)[0]
    for text in ("idiot", "IDIOTS!", "1d10t", "idіоt", "i​diot", "ｉｄｉｏｔ", "id́iot"):
        assert weight(text) == 5.0, text
    assert weight("scum of") == 4.0 and weight("scummy") == 0 and weight("an anidiot") == 0
    assert weight("an idiot savant") == 0 and weight("an idiot, idiot savant") == 5.0
    assert toxicity.weigh(machine, "") == (0.0, 0) and toxicity.weigh(toxicity.Lexicon({}).machine(), "a b") == (0.0, 2)


def test_toxicity_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.scored(docs, toxicity.learn(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = toxicity.learn(docs, labels.where("false"))
    assert empty.weights == {} and all(r.score < 0.5 for r in toxicity.scored(docs, empty).collect())
    assert toxicity.scored(no_docs(spark), empty).collect() == []


ITEM = "Yesterday Anna said that Anna had 17 apples and then gave 5 apples to Bert before 17 kg of flour arrived here."


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (ITEM, (22, True)),
        ("Before it. " + ITEM + " And after.", (22, True)),
        ("So yesterday Carl said that Carl had 21 apples and then gave 8 apples to Dora before 21 pounds of flour arrived here", (22, False)),
        ("Yesterday Carl said that Eva had 21 apples and then gave 8 apples to Dora before 29 pounds of flour arrived here.", None),
        ("Anna had 17 apples and then gave 5 apples", None),
        ("", None),
        (None, None),
    ],
)
def test_templates(spark, text, found):
    items = spark.createDataFrame([(3, ITEM), (4, None), (5, "short one")], "item_id long, text string")
    docs = spark.createDataFrame([(7, text, "x")], SCHEMA + ", item_id string")
    got = [(r.run_words, r.verbatim) for r in decontamination.contaminated(docs, items).collect()]
    assert got == ([found] if found else [])


RICE = "In 2019 Alice Smith paid 30 dollars to Bob Jones for 12 kg of rice"


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (RICE, (15, True)),
        ("We saw it. " + RICE + ". It was so.", (15, True)),
        (RICE.replace("30", "45"), (15, False)),
        ("In 2021 Carl Brown paid 45 euros to Eva Green for 7 pounds of rice", None),
    ],
)
def test_items_of_numbers_and_names(spark, text, found):
    """Windows with few ordinary words are found by their values, and lie in one run with the others."""
    items = spark.createDataFrame([(3, RICE), (4, "Solve 3 + 4 * 5 - 6 / 7 = 8 now")], "item_id long, text string")
    docs = spark.createDataFrame([(7, text)], SCHEMA)
    got = [(r.run_words, r.verbatim) for r in decontamination.contaminated(docs, items).collect()]
    assert got == ([found] if found else [])


def test_poor_windows_do_not_break_runs_of_templates(spark):
    """A line of names amid a question whose numbers differ before and after it."""
    item = "they bought 17 red apples there and went on to Anna Bert Carl Dora Emil who gave 5 green pears to them all"
    items = spark.createDataFrame([(3, item)], "item_id long, text string")
    docs = spark.createDataFrame([(7, item.replace("17", "29").replace("5", "8")), (8, item.lower())], SCHEMA)
    got = {r.doc_id: (r.run_words, r.verbatim) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {7: (23, False), 8: (23, True)}


SHORT = ["Paris is older than Rome", "Anna gave the red book to her old friend", "Who wrote Hamlet"]


@pytest.mark.parametrize("form", ["{}", "so then {} and on", "They said. {}! And on", "lower {}"])
def test_short_items_in_any_context_and_case(spark, form):
    items = spark.createDataFrame(list(enumerate(SHORT)), "item_id long, text string")
    texts = [form.format(t if "lower" not in form else t.lower()) for t in SHORT]
    docs = spark.createDataFrame([(10 + i, t) for i, t in enumerate(texts)] + [(20, "Paris is older and older than Rome"), (21, "who wrote")], SCHEMA)
    got = {(r.doc_id, r.item_id, r.run_words, r.share, r.verbatim) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(10, 0, 5, 1.0, True), (11, 1, 9, 1.0, True), (12, 2, 3, 1.0, True)}


def test_other_numbers_and_names_in_another_context(spark):
    items = spark.createDataFrame([(1, "Anna gave 5 red books to her friend Bert yesterday")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "and so anna gave 7 red books to her friend bert yesterday"), (2, "and so Carl gave 7 red books to her friend Dora yesterday")], SCHEMA)
    got = {(r.doc_id, r.run_words, r.verbatim) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(1, 10, False), (2, 10, False)}


def test_decontamination_query(spark):
    """Every item whose words stand in a document, one after the other, is found, and nothing else."""
    import re

    split = lambda t: re.findall(r"\w+", t.lower())
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    joined = {d.doc_id: " " + " ".join(split(d.text)) + " " for d in docs}
    want = {(d, i.item_id) for i in items for d, t in joined.items() if " " + " ".join(split(i.text)) + " " in t}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_benchmark_decontamination"](spark, DATA).collect()}
    assert got == want and want


def test_decontamination_odd_rows(spark):
    docs = odd_docs(spark)
    items = docs.select(F.col("doc_id").alias("item_id"), "text", F.lit(1).alias("doc_id"))
    got = decontamination.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(14, 14), (15, 14), (14, 15), (15, 15), (12, 13), (13, 13)}
    assert not any(r.doc_id in (4, 5, 6, 7, 8, 9, 10, 11) for r in got)
    assert decontamination.contaminated(no_docs(spark), items).collect() == []
    assert decontamination.contaminated(docs, items.where("false")).collect() == []


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i) for i, w in rows if i != q)
        out[q] = [(i, d) for d, i in near[:k]]
    return out


def test_neighbours_query(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{LARGER}/embeddings.parquet").collect()]
    want = exact(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = {}
    for r in sorted(QUERIES["op10_nearest_neighbours"](spark, LARGER).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    vectors = {i: np.array(v) for i, v in rows}
    assert all(abs(np.sqrt(((vectors[q] - vectors[i]) ** 2).sum()) - d) < 1e-12 for q, found in got.items() for i, d in found)


def test_rare_and_long_toxic_words(spark):
    """A word in two of a thousand marked texts, and one of 45 letters, are learnt; a word as rare in all texts is not."""
    long = "gr" + "u" * 41 + "mf"
    docs, labels, clean, marked = [], [], 0, 0
    for i in range(20_000):
        bad = i % 4 == 0
        if zlib.crc32(str(i).encode()) % 5:
            marked, clean = marked + bad, clean + (not bad)
        at = marked if bad else clean
        word = "zarkword" if bad and at % 400 == 7 else long if bad and at % 400 == 9 else "neutral" if at % 400 == 11 else ""
        docs.append((i, f"some plain text {i % 7} of {i % 11} words {word}"))
        labels.append((i, int(bad)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    lexicon = toxicity.learn(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    machine = lexicon.machine()
    assert 5 <= marked // 400 <= marked * 3 / 1000
    assert toxicity.weigh(machine, "a zarkword")[0] > 0 and toxicity.weigh(machine, f"a {long}")[0] > 0
    assert toxicity.weigh(machine, "a neutral plain text")[0] == 0


def test_many_exceptions_take_time_in_proportion():
    machine = toxicity.Lexicon({" idio": 5.0}, ["idiot savant"]).machine()
    took = []
    for n in (20_000, 80_000):
        began = time.perf_counter()
        assert toxicity.weigh(machine, "idiot savant idiot " * n)[0] == 5.0 * n
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0]


def test_neighbours_with_copies_and_odd_vectors(spark):
    dice = np.random.default_rng(2)
    rows = [(i, [float(x) for x in dice.normal(size=4)]) for i in range(30)]
    rows += [(i, [1.0, 0.0, 0.0, 2.0]) for i in range(100, 160)] + [(200, [1.0, 0.0, 0.0, 2.5])]
    odd = [(300, None), (301, [0.0] * 4), (302, [1.0, None, 0.0, 0.0]), (303, [1.0, float("nan"), 0.0, 0.0]), (304, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (305, [1.0]), (306, [])]
    table = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>")
    queries = [r for r in rows if r[0] in (0, 7, 100, 130, 200)]
    got = {}
    asked = spark.createDataFrame(queries + odd, "vec_id long, embedding array<float>")
    for r in sorted(neighbours.search_table(table, asked, k=10).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, pytest.approx(r.score)))
    small = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == {q: v for q, v in exact(small, [(q, [float(np.float32(x)) for x in v]) for q, v in queries], 10).items()}
    assert neighbours.search_table(table.where("false"), asked).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40) if i % 10 != 9] + [(100, 50), (50, 75), (75, 100), (7, 7), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: i // 10 * 10 for i in range(41)} | {50: 50, 75: 50, 100: 50}
    del want[40]
    assert got == want
