"""Sharding, mixing and chat formatting."""

import collections
import hashlib
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadkit.llm import chat, mixing, queries, sharding
from loadkit.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA, SMALL, plan
from tests.llm.helpers import SCHEMA, no_docs, odd_docs, words

# sharding


def check_shards(docs, got, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs if d is not None
    )
    assert len(got) == len(docs) and all(r.law == "rows" and r.grown_shard is None for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(docs)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_sharding"](spark, DATA).collect()
    check_shards(docs, got, 40)
    places = collections.defaultdict(set)
    for r in got:
        places[r.text_crc32, r.size].add(r.shard)
    assert all(len(v) == 1 for v in places.values())  # no group of these is as large as a shard


def test_sharding_odd_rows(spark):
    docs = odd_docs(spark)
    check_shards([(r.doc_id, r.text) for r in docs.collect()], sharding.assign_shards(docs, 4).collect(), 4)
    assert sharding.assign_shards(no_docs(spark), 4).collect() == []


def test_sharding_splits_a_hot_group_over_few_shards(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i}" if i % 3 == 1 else f"pair {i // 6}") for i in range(600)]
    got = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 10).collect()
    check_shards(rows, got, 10)
    texts, shards = dict(rows), collections.defaultdict(collections.Counter)
    for r in got:
        shards[texts[r.doc_id]][r.shard] += 1
    assert len(shards["same"]) <= 6  # 200 rows, 60 to a shard
    cut = sum(len(v) > 1 for k, v in shards.items() if k.startswith("pair"))
    assert cut <= len(shards) / 20
    again = sharding.assign_shards(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), 10).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


@pytest.mark.parametrize("alone", [0, 8])
def test_sharding_exchanges_members_of_full_shards(spark, alone):
    """Hardly any room: at the end no two groups could still gain by an exchange."""
    rows = [(i, f"pair {i % 200}") for i in range(400)] + [(1000 + i, f"alone {i}") for i in range(alone)]
    got = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 4).collect()
    check_shards(rows, got, 4)
    texts, shards = dict(rows), collections.defaultdict(collections.Counter)
    for r in got:
        shards[texts[r.doc_id]][r.shard] += 1
    cut = collections.Counter(tuple(sorted(v)) for v in shards.values() if len(v) > 1)
    assert all(n == 1 for n in cut.values()) and sum(cut.values()) <= 6


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sharding_leaves_no_move(spark, seed):
    """A group lies in several shards only if no shard had room for it, and over as few as the rooms allow."""
    rng = random.Random(seed)
    rows, shards = [], 6
    for g in range(40):
        rows += [(0, f"group {g}")] * rng.choice([1, 1, 2, 3, 10, 25])
    rows += [(0, "large")] * rng.choice([0, 90, 300])
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), shards, seed=seed).collect()
    check_shards(rows, got, shards)
    texts, members = dict(rows), collections.defaultdict(collections.Counter)
    for r in got:
        members[texts[r.doc_id]][r.shard] += 1
    alone = collections.Counter()
    for counts in members.values():
        if sum(counts.values()) == 1:
            alone += counts
    quota = len(rows) // shards
    for counts in members.values():
        size = sum(counts.values())
        if len(counts) > 1 and size <= quota:
            assert all(alone[s] + counts[s] < size for s in range(shards))
    assert sum(len(c) - 1 for c in members.values()) <= sum(sum(c.values()) // quota for c in members.values()) + shards


# mixing


def test_targets_are_met_and_no_document_is_taken_too_often(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = QUERIES["op7_mixing"](spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        source = docs[r.doc_id].source
        assert r.size == len(words(docs[r.doc_id].text)) and r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
    total = sum(sizes.values())
    for i, s in enumerate(sorted(sizes)):
        assert target[s] == pytest.approx(mixing.targets(sizes, {x: 1 + k % 3 for k, x in enumerate(sorted(sizes))})[s])
        assert abs(taken[s] - target[s]) <= 0.01 * target[s], (i, s)
    assert sum(target.values()) == pytest.approx(total)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op7_mixing"](spark, DATA).collect()))


def test_targets_stop_at_three_times_the_size():
    got = mixing.targets({"a": 10, "b": 1000, "c": 5, None: 0}, {"a": 1, "b": 1, "c": 5, None: 2})
    assert got == pytest.approx({"a": 30, "b": 970, "c": 15, None: 0})
    assert mixing.targets({"a": 0}, {"a": 1}) == {"a": 0.0}
    assert mixing.targets({}, {}) == {}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from([("a",), ("b",), ("c",), ("a", "b"), ("b", "c"), ("a", "b", "c")]), st.integers(0, 50), min_size=1), st.tuples(*[st.integers(0, 80)] * 3))
def test_flow_is_largest_and_cheapest(patterns, wanted):
    goal = {s: w for s, w in zip("abc", wanted, strict=True) if any(s in p for p in patterns)}
    got = mixing.flow(patterns, goal, 3)
    for s, w in goal.items():
        assert sum(n for (p, x), n in got.items() if x == s) <= w + 1e-6
    used = {p: sum(n for (q, _), n in got.items() if q == p) for p in patterns}
    assert all(n <= 3 * patterns[p] + 1e-6 for p, n in used.items())
    # the largest flow is the smallest cut over sets of sources
    sources = list(goal)
    cuts = []
    for bits in range(1 << len(sources)):
        inside = {s for i, s in enumerate(sources) if bits >> i & 1}
        cuts.append(sum(goal[s] for s in sources if s not in inside) + sum(3 * n for p, n in patterns.items() if inside & set(p)))
    assert sum(got.values()) == pytest.approx(min(cuts), abs=1e-6)
    # cheapest: no pattern is a whole epoch ahead of another that could give its words instead
    for (p, s), n in got.items():
        for q in patterns:
            if n > 1e-6 and s in q and patterns[p] and patterns[q]:
                assert -(-used[p] // patterns[p]) - 1 <= used[q] / patterns[q] + 1e-6


def test_mixing_overlapping_sources_and_odd_rows(spark):
    docs = odd_docs(spark)
    many = docs.withColumn("in", F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("x"), F.lit("y"))).when(F.col("doc_id") == 9, F.array().cast("array<string>")).otherwise(F.array(F.lit("x"), F.lit(None).cast("string"))))
    got = mixing.mix(many, F.col("in")).collect()
    assert len(got) == docs.count() and all(0 <= r._copies <= 3 for r in got)
    assert all(r._copies == 0 for r in got if r.doc_id == 9)
    assert mixing.mix(no_docs(spark)).collect() == []
    nulls = spark.createDataFrame([(1, "a b", None), (2, "c d", None), (3, "e f", "s")], "doc_id long, text string, source string")
    assert {r.doc_id: r._target for r in mixing.mix(nulls).collect()} == pytest.approx({1: 4.0, 2: 4.0, 3: 2.0})


def test_mixing_null_memberships_and_clashing_names(spark):
    docs = odd_docs(spark)
    for name in ("_pattern", "_size", "_copies", "_target", "_source_size", "_full", "_left", "_runs", "_b", "_place", "_n", "row", "Row"):
        docs = docs.withColumn(name, F.lit(name)) if name != "Row" else docs
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r.row == "row" and r._full == "_full" and 0 <= r._copies <= 3 for r in got)
    whole = mixing.mixed_rows(docs).select("row.*")
    assert whole.columns == docs.columns and sorted(map(repr, whole.collect())) == sorted(map(repr, docs.collect()))
    some = F.when(F.col("doc_id") > 8, F.array(F.lit("x")))
    assert all(r._copies == 0 and r._pattern == [] for r in mixing.mix(docs, some).collect() if r.doc_id is None or r.doc_id <= 8)


def test_mixing_fills_what_a_long_document_leaves(spark):
    """Small documents make up for a long one that does not fit, and the result is that of one pass in order."""
    rows = [(i, "w " * 60, "a") for i in range(1000)] + [(5000, "w " * 130_000, "a"), (6000, "w " * 190_000, "b")]
    rows += [(7000 + i, "w " * (i % 700 + 1), "c") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total = sum(len(t) // 2 for _, t, _ in rows)
    for missing in (60_000, 100_020):
        weights = {"a": missing, "b": (total - missing) * 0.9, "c": (total - missing) * 0.1}
        got = mixing.mix(docs, weights=weights).collect()
        taken, target, least = collections.Counter(), {}, {}
        for r in got:
            taken[r.source] += r._size * r._copies
            target[r.source] = r._target
        assert len(got) == len(rows)
        for r in got:
            if r._copies < 3:
                least[r.source] = min(least.get(r.source, 1 << 60), r._size)
        assert abs(taken["c"] - target["c"]) <= least["c"], (taken, target)
        assert abs(taken["a"] - target["a"]) <= (0.5 if missing == 60_000 else 40_021), (taken, target)


def test_mixing_takes_repeated_rows_together(spark):
    rows = [(1, "w " * 7, "a")] * 30 + [(i, "w " * (i % 5 + 1), "a") for i in range(10, 60)] + [(None, "w " * 9, "a")] * 20 + [(99, "w " * 400, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for wanted in (40, 100, 205, 333):
        got = mixing.mix(docs, weights={"a": wanted, "b": 940 - wanted}).where("source = 'a'").collect()
        copies = collections.defaultdict(set)
        for r in got:
            copies[r.doc_id].add(r._copies)
        assert len(got) == 100 and all(len(v) == 1 for v in copies.values())
        left = collections.Counter()
        for r in got:
            left[r.doc_id] += r._size * (1 - r._copies)
        off = abs(sum(r._size * r._copies for r in got) - got[0]._target)
        assert off <= 0.5 * min(n for n in left.values() if n), wanted  # what is left is too large


# chat


def test_chat_query(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    df = QUERIES["op8_chat_formatting"](spark, SMALL)
    cursor = duck.execute(ORACLES["op8_chat_formatting"])
    columns = [d[0] for d in cursor.description]
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(cursor.fetchall())
    assert "Python" not in plan(df) and "Arrow" not in plan(df)
    control = "</s>[INST] ok [/INST]"
    (row,) = df.where("conv_id = -1").collect()
    assert row.loss_chars == len(control) and row.loss_sha256 == hashlib.sha256(control.encode()).hexdigest()


def test_chat_query_on_odd_rows(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, 2, "user", ""), (2, 5, "tool", "</s>"), (2, None, "user", "x"), (3, 0, "assistant", "<|end|>")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    df = QUERIES["op8_chat_formatting"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = duck.execute(ORACLES["op8_chat_formatting"].replace("ORDER BY turn,", "ORDER BY turn NULLS FIRST,"))
    columns = [d[0] for d in cursor.description]
    got = sorted(map(tuple, df.select(*columns).collect()))
    assert got == sorted(cursor.fetchall()) and [r[1] for r in got] == [2, 5, 2, 1]


HARD = ["", "<|end|>\n", "<|user|>\nhi", "\\l\\p\\b", "a|b<c\\d", "\\", "<", "é日\U0001f600", "\\\\l", "|>\n", "\n", "x" * 10_000]


def test_round_trip_of_control_strings(spark):
    rows = [(c, i, role, text) for c in range(3) for i, text in enumerate(HARD) for role in [["user", "assistant", "sys|>\n<tem\\"][(i + c) % 3]]]
    rows += [(9, 0, None, None), (9, 1, "assistant", None), (None, 0, "assistant", "no conversation")]
    messages = spark.createDataFrame(rows, "conv long, message long, role string, text string")
    made = chat.render(messages)
    got = made.select("conv", chat.read_back(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted", "loss_spans").collect()
    for r in got:
        own = [(role or "", text or "") for c, _, role, text in rows if c == r.conv]
        assert [(x.role, x.text) for x in r.t] == own
        assert r.l == "".join(t for role, t in own if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in own)
    assert len(got) == 5
    assert chat.render(messages.where("false")).collect() == []


def test_events_fold_to_final_messages(spark):
    log = [
        (1, 0, 0, "set", "user", "q"), (1, 1, 1, "delta", "assistant", "he"), (1, 1, 2, "delta", None, "llo"),
        (1, 2, 3, "set", "user", "more"), (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "new"),
        (1, 3, 6, "set", "user", "after"), (1, 0, 7, "edit", None, "Q"), (1, 4, 8, "set", "user", "gone"), (1, 4, 9, "delete", None, None),
        (2, 0, 0, None, None, None), (None, 0, 0, "delta", "user", "x"), (None, 0, 0, "delta", "user", "x"), (2, 1, None, "odd", "user", "y"),
    ]
    events = spark.createDataFrame(log, "c long, m long, s long, k string, r string, t string").repartition(5)
    got = chat.reconstruct(events, "c", "m", "s", "k", "r", "t").collect()
    assert sorted(((x.conv, x.message, x.role, x.text) for x in got), key=repr) == sorted(
        [(1, 0, "user", "Q"), (1, 1, "assistant", "new"), (1, 3, "user", "after"), (2, 0, "", ""), (None, 0, "user", "xx"), (2, 1, "user", "y")], key=repr
    )


def _folded(log):
    """A conversation after another, its events in sequence."""
    key = lambda e: tuple((x is not None, x) for x in (e[2], e[3], e[4], e[5]))
    state, first, again = {}, {}, []
    for c, m, s, kind, role, text in sorted(log, key=key):
        kind = kind or "set"
        before, parts, _ = state.get((c, m), ("", "", True))
        parts = {"delta": parts + (text or ""), "regenerate": "", "delete": ""}.get(kind, text or "")
        state[c, m] = (role or before, parts, kind != "delete")
        if s is not None:
            first.setdefault((c, m), s)
            again += [(c, m, s)] if kind == "regenerate" else []
    gone = lambda c, m: any(c == d and n < m and first.get((c, m), s) < s for d, n, s in again)
    return sorted((c, m, role, text) for (c, m), (role, text, here) in state.items() if here and not gone(c, m))


def test_random_logs_fold_in_sequence(spark):
    draw = random.Random(5)
    kinds = ["set", "delta", "delta", "edit", "regenerate", "delete", "odd"]
    log = [(draw.randrange(12), draw.randrange(6), draw.randrange(40), draw.choice(kinds), draw.choice(["user", "assistant"]), draw.choice(["a", "bc", "", "<"])) for _ in range(600)]
    events = spark.createDataFrame(log, "c long, m long, s long, k string, r string, t string").repartition(4)
    got = chat.reconstruct(events.withColumn("conv", F.lit(0)).withColumn("_m", F.lit(0)), "c", "m", "s", "k", "r", "t")
    assert sorted(map(tuple, got.collect())) == _folded(log)
    assert chat.reconstruct(events.where("false"), "c", "m", "s", "k", "r", "t").collect() == []


def test_the_query_folds_every_kind_of_event(spark):
    rows = spark.createDataFrame([(1, 0, 1, "user", "hello"), (1, 1, 1, "assistant", "good day"), (1, 2, 1, "user", None)], "conv_id long, turn long, again int, role string, text string")
    log = queries._chat_log(rows)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"set", "delta", "edit", "regenerate"}
    assert log.select("message").distinct().count() == 4  # one of them is begun for nothing
    left = chat.reconstruct(log, "conv_id", "message", "seq", "kind", "role", "text").orderBy("message").collect()
    assert [(r.message.turn, r.role, r.text) for r in left] == [(0, "user", "hello"), (1, "assistant", "good day"), (2, "user", "")]
