"""Mixing sources to target weights: min-cost flow over membership patterns, then seeded documents.

A document may belong to several sources. Documents with the same set of
sources (a pattern) are interchangeable, so Spark reduces them to one row per
pattern with its words; the flow from patterns to sources is solved on those
rows, and Spark selects documents for each pattern.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import bucket_of, local_frame, stored

BUCKETS = 4096
FEW_PATTERNS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, max_repeat: float = 3.0) -> dict:
    """Words each source should give: the total shared by weight, at most ``max_repeat`` times a source's size.

    What a source cannot give is shared again among the others by weight,
    until none is above its limit. If all are at their limit the rest lapses.
    """
    limit = {s: max_repeat * n for s, n in sizes.items()}
    result: dict = {}
    left, free = float(sum(sizes.values())), set(sizes)
    while free:
        weight = sum(weights[s] for s in free)
        share = {s: left * weights[s] / weight for s in free}
        above = {s for s in free if share[s] > limit[s]}
        if not above:
            return result | share
        for s in above:
            result[s] = float(limit[s])
            left -= limit[s]
        free -= above
    return result


def flow(patterns: dict[tuple, int], wanted: dict, epochs: int = 3) -> dict[tuple, float]:
    """Words to take from every (pattern, source): a min-cost flow.

    A pattern's words cost 0 when first taken, 1 the second time, 3 the third,
    6 the fourth (convex, so the cheapest flow spreads repetition evenly). The
    flow meets as much of ``wanted`` as the patterns allow, at least cost. Solved
    by successive shortest paths; its size is that of the pattern table, not of
    the corpus.
    """
    graph: dict = {}

    def arc(u, v, room, cost):
        a, b = [v, float(room), cost, None], [u, 0.0, -cost, None]
        a[3], b[3] = b, a
        graph.setdefault(u, []).append(a)
        graph.setdefault(v, []).append(b)
        return a

    routes = {}
    for p in sorted(patterns, key=repr):
        for e in range(epochs):
            arc("start", ("p", p), patterns[p], e * (e + 1) // 2)
        for s in p:
            routes[p, s] = arc(("p", p), ("s", s), epochs * patterns[p], 0)
    for s in sorted(wanted, key=repr):
        arc(("s", s), "end", wanted[s], 0)
    total = sum(patterns.values())
    least = 1e-9 * max(1.0, total)
    height = dict.fromkeys(graph, 0.0)
    while True:
        far, back, queue, tick = {"start": 0.0}, {}, [(0.0, 0, "start")], 0
        while queue:
            d, _, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for a in graph.get(u, []):
                if a[1] > least:
                    new = d + a[2] + height[u] - height[a[0]]
                    if new < far.get(a[0], float("inf")) - 1e-12:
                        tick += 1
                        far[a[0]], back[a[0]] = new, a
                        heapq.heappush(queue, (new, tick, a[0]))
        if "end" not in far:
            return {k: a[3][1] for k, a in routes.items()}
        most = max(far.values())
        for u in height:
            height[u] += far.get(u, most)
        path, u = [], "end"
        while u != "start":
            path.append(back[u])
            u = back[u][3][0]
        room = min(a[1] for a in path)
        for a in path:
            a[1] -= room
            a[3][1] += room


def mixed_rows(
    docs: DataFrame,
    sources: Column | None = None,
    weights: dict | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_repeat: int = 3,
    seed: int = 11,
) -> DataFrame:
    """How often the mix takes every document.

    ``sources`` is an array column, the sources a row belongs to (by default
    the column ``source`` alone); ``weights`` gives a weight per source, by
    default 1, 2, 3, repeating, over the sources by code point, null last.
    Targets share all words by weight (``targets``) with a source's size being
    the words of every row in it.

    Returns ``row`` (a struct of the input's columns, whatever their names),
    ``_pattern`` (the row's sources, sorted), ``_size`` (words), ``_copies`` (0
    to ``max_repeat``), and ``_source_size`` and ``_target`` of its first
    source. What is taken depends on the seed, the id and the size alone: the
    rows of a pattern are in a seeded order, and get one copy more, one after
    the other, if they fit what is still missing; at the end one that is larger
    does if that brings the words nearer.

    A null source is a source of its own; a row without any source, or with a
    null array, is never taken. Null or empty texts have size 0; long ones are
    only counted. Repeated rows count each, and share their place in the order:
    all get the copy or none. Null ids are allowed. An empty table gives no
    rows. The driver holds a row per pattern: sources that overlap in very many
    ways are more than it can solve.
    """
    sources = F.array(F.col("source").cast("string")) if sources is None else sources
    # null sorts after every text, as the last key
    pattern = F.coalesce(F.array_sort(F.array_distinct(sources)), F.array().cast("array<string>"))
    size = words_of(F.col(text_col))
    frame = docs.select(
        F.struct("*").alias("row"),
        pattern.alias("_pattern"),
        size.alias("_size"),
        bucket_of(F.col(id_col), size, F.lit(seed), buckets=BUCKETS).alias("_b"),
        F.xxhash64(F.col(id_col), size, F.lit(seed + 1)).alias("_place"),
    )

    units = stored(frame.groupBy("_pattern", "_b", "_place", "_size").agg(F.sum("_size").alias("_all")), "mix_rows")
    parts = units.groupBy("_pattern").agg(F.sum("_all").alias("_words"))
    # one row per pattern: the only thing that the driver sees
    patterns = {tuple(r["_pattern"]): r["_words"] for r in parts.collect()}
    sizes: dict = {}
    for p, n in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = weights or {s: 1 + i % 3 for i, s in enumerate(order)}
    total = sum(patterns.values())
    goal = targets(sizes, weights, max_repeat)
    if sum(sizes.values()) > total:  # overlapping sources: all words are shared, not all memberships
        goal = {s: t * total / sum(sizes.values()) for s, t in goal.items()}
    given: dict = {}
    for (p, _), n in flow(patterns, goal, max_repeat).items():
        given[p] = given.get(p, 0.0) + n

    session = frame.sparkSession

    def of_patterns(rows: list, schema: str) -> DataFrame:
        """A frame of a row per pattern at most; sent to every task only if they are few."""
        made = local_frame(session, rows, schema)
        return F.broadcast(made) if len(rows) <= FEW_PATTERNS else made

    plan = {
        p: (*whole(given.get(p, 0.0), n, max_repeat), int(sizes[p[0]]) if p else 0, float(goal[p[0]]) if p else 0.0)
        for p, n in patterns.items()
    }
    # Cuts: a pattern's order is taken as far as it fits, without what is larger than the gap. The first that no longer fits
    # is left out, as it is larger than the gap from there on, and the order goes on behind it. So the runs between cuts,
    # each with the gap at its beginning, tell what is taken.
    gap = {p: int(x[1] + 1e-6) for p, x in plan.items()}
    left = {p: x[1] for p, x in plan.items()}
    begin = {p: (-1, -(2**63)) for p in patterns}
    runs: dict = {p: [] for p in patterns}
    open_now = {p for p in patterns if gap[p]}
    while open_now:
        gaps = of_patterns([(list(p), *begin[p], gap[p]) for p in open_now], "_pattern array<string>, _from_b int, _from long, _gap long")
        found = {tuple(r["_pattern"]): r for r in _cut(units.join(gaps, "_pattern")).collect()}
        for p in open_now:
            end = found[p]["_mark"] if p in found else None
            words = (found[p]["_words"] if end is None else end["_at"]) if p in found else 0
            end = (BUCKETS, -(2**63)) if end is None else (end["_b"], end["_place"])
            runs[p].append((*begin[p], *end, gap[p]))
            gap[p] -= words
            left[p] -= words
            begin[p] = end
        open_now = {p for p in open_now if gap[p] and begin[p][0] < BUCKETS}
    final = of_patterns(
        [(list(p), full, size, goal_of, left[p], runs[p]) for p, (full, _, size, goal_of) in plan.items()],
        f"_pattern array<string>, _full int, _source_size long, _target double, _left double, _runs array<{RUN}>",
    )
    inside = F.exists("_runs", lambda r: _inside(r) & (F.col("_size") <= r["gap"]))
    fits = F.exists("_runs", lambda r: _inside(r) & (F.col("_all") <= r["gap"]))
    ended = units.join(final, "_pattern")
    # of what is left, the smallest, if the words are nearer with it than without
    nearest = ended.where(~fits & (F.col("_all") > 0) & (F.col("_all") < 2 * F.col("_left"))).groupBy("_pattern").agg(F.min(F.struct("_all", "_b", "_place")).alias("_best"))
    best = {tuple(r["_pattern"]): (r["_best"]["_b"], r["_best"]["_place"]) for r in nearest.collect()}
    extra = of_patterns([(list(p), *best.get(p, (None, None))) for p in patterns], "_pattern array<string>, _extra_b int, _extra long")
    is_extra = F.coalesce((F.col("_b") == F.col("_extra_b")) & (F.col("_place") == F.col("_extra")), F.lit(False))
    more = inside | is_extra
    rows = frame.join(final, "_pattern").join(extra, "_pattern")
    # rows that fit one by one, but not all that share the place
    none = stored(ended.where(inside & ~fits).select("_b", "_place", "_pattern", F.lit(True).alias("_none")), "mix_none")
    if not none.isEmpty():
        rows = rows.join(none, ["_pattern", "_b", "_place"], "left")
        more = (inside & F.col("_none").isNull()) | is_extra
    return rows.withColumn("_copies", F.least(F.col("_full") + more.cast("int"), F.lit(max_repeat))).select(
        "row", "_pattern", "_size", "_copies", "_source_size", "_target"
    )


def mix(docs: DataFrame, *args, **more) -> DataFrame:
    """``mixed_rows`` with the input's columns side by side; those named like an added one give way."""
    mixed = mixed_rows(docs, *args, **more)
    added = mixed.columns[1:]
    names = [c for c in docs.columns if c.lower() not in added]
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in names], *added)


RUN = "struct<from_b:int,from:bigint,to_b:int,to:bigint,gap:bigint>"


def _inside(run: Column) -> Column:
    """Whether a place lies between two cuts."""
    b, place = F.col("_b"), F.col("_place")
    return ((b > run["from_b"]) | ((b == run["from_b"]) & (place > run["from"]))) & (
        (b < run["to_b"]) | ((b == run["to_b"]) & (place < run["to"]))
    )


def _cut(units: DataFrame) -> DataFrame:
    """(pattern, words, mark): what fits ``_gap`` behind (``_from_b``, ``_from``) has how many words, and where the first one no longer fits."""
    behind = (F.col("_b") > F.col("_from_b")) | ((F.col("_b") == F.col("_from_b")) & (F.col("_place") > F.col("_from")))
    rest = units.where(behind & (F.col("_all") <= F.col("_gap")))
    parts = rest.groupBy("_pattern", "_b").agg(F.sum("_all").alias("_words"))
    # the mark of a pattern falls into one bucket; only there do rows have to be put in order
    earlier = Window.partitionBy("_pattern").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    at = parts.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    run = Window.partitionBy("_pattern", "_b").orderBy("_place", "_size").rowsBetween(Window.unboundedPreceding, -1)
    marks = (
        rest.join(at.select("_pattern", "_b", "_before", "_words"), ["_pattern", "_b"])
        .where("_before <= _gap and _gap < _before + _words")
        .withColumn("_at", F.col("_before") + F.coalesce(F.sum("_all").over(run), F.lit(0)))
        .where(F.col("_at") + F.col("_all") > F.col("_gap"))
        .groupBy("_pattern")
        .agg(F.min(F.struct("_b", "_place", "_at")).alias("_mark"))
    )
    return parts.groupBy("_pattern").agg(F.sum("_words").alias("_words")).join(marks, "_pattern", "left")


def whole(words: float, size: int, max_repeat: int) -> tuple[int, float]:
    """Whole copies of a pattern, and the words beyond them."""
    if not size:
        return 0, 0.0
    full = min(max_repeat, int(words / size + 1e-9))
    return full, max(0.0, words - full * size)
