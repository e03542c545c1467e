"""N-gram Jaccard join by count vectors in R-trees.

A text's set is that of its word shingles. The join goes from coarse to exact:

1. Texts with equal sets are one class.
2. Classes that share enough of their rarest shingles with others whose sizes
   allow it may be similar. This is lossless: of the first shingles of two
   similar sets, in any order that all texts use, a known number is shared
   (``prefix_of``); here the order is by frequency, so common passages come
   last. The classes of a shingle are not written as pairs, but as runs of
   sizes. Connected runs give clusters.
3. In a cluster, shingles are hashed into groups, and the counts per group are
   a point. R-trees over the points are joined: boxes whose summed coordinate
   minima are too small an overlap are not opened. Pairs of points that pass
   are verified on the sets themselves.

Large clusters are cut into tiles that are joined pair by pair. A task gives,
for each class, its number of links and one edge, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import components, drop_stored, hash_bits, in_bits, in_small_batches, stored
from loadkit.llm.textbytes import PIECE_BYTES, mix, shingles, slices

SKETCH = 1 << 20
SKETCH_PARTS = 16
TILE_SHINGLES = 3 << 19
TILE_CLASSES = 1024
FANOUT = 8
LONG_RUN = 256
FILTER_BITS = 1 << 24
ROWS = 1 << 16
ENTRIES = 1 << 18  # that a worker holds at once, besides those of one key or text
BIT_WORDS = 1 << 22


def sets_of(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, and their bounds."""
    hashes, bounds = shingles(data, offsets, width)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        hashes[a:b].sort()
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[keep], minlength=len(bounds) - 1)
    return hashes[keep], np.concatenate([[0], np.cumsum(sizes)])


def class_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, from two sums over its members."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(k)))]) for k in (1, 2)]
    a, b = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
    return mix(a ^ mix(b + np.diff(bounds).astype(np.uint64))).view(np.int64)


def shared_at_least(size, percent: int):
    """Shingles of its prefix that a set must share with any set as similar as asked (see ``prefix_of``)."""
    return np.maximum(1, (size * percent + 99) // 100 // 10)


def prefix_of(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's first shingles are dealt out.

    Let o be the least overlap that similarity asks of a set of n. In any
    order, the first n - o + m of two similar sets share m shingles. Here m is
    a tenth of the size; as the smaller of the two sets has its own, smaller m,
    what may be counted on is ``shared_at_least``.
    """
    return np.where(size > 0, size - (size * percent + 99) // 100 + np.maximum(1, size // 10), 0)


# 1: sets, classes, and how often shingles occur


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """Per row: its set's size and class. Per task: parts of the frequency sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            sizes, names = [], []
            for _, _, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                hashes, bounds = sets_of(data, offsets, width)
                np.add.at(sketch, (hashes % np.uint64(SKETCH)).astype(np.int64), np.uint32(1))
                sizes.append(np.diff(bounds))
                names.append(class_of(hashes, bounds))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.concatenate(sizes) if n else [], pa.int64()),
                    pa.array(np.concatenate(names) if n else [], pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names=["row", "n", "c", "part", "counts"],
            )
        parts = sketch.reshape(SKETCH_PARTS, -1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(SKETCH_PARTS, kind),
                pa.nulls(SKETCH_PARTS, pa.int64()),
                pa.nulls(SKETCH_PARTS, pa.int64()),
                pa.array(range(SKETCH_PARTS), pa.int32()),
                pa.array([x.tobytes() for x in parts], pa.binary()),
            ],
            names=["row", "n", "c", "part", "counts"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema["row"].dataType)
    row = docs.schema["row"].dataType.simpleString()
    return docs.select("row", "text").mapInArrow(run, f"row {row}, n long, c long, part int, counts binary")


def _summed(parts: DataFrame) -> np.ndarray:
    """The sketch of all rows: a fixed number of counts, quantised by ratio."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                have = total.setdefault(part, np.zeros(SKETCH // SKETCH_PARTS, np.uint64))
                have += np.frombuffer(counts.as_buffer(), np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "counts"]
        )

    sketch = np.zeros((SKETCH_PARTS, SKETCH // SKETCH_PARTS), np.uint64)
    for part, counts in parts.repartition(SKETCH_PARTS, "part").mapInArrow(run, "part int, counts binary").collect():
        sketch[part] += np.frombuffer(counts, np.uint64)  # SKETCH_PARTS rows of fixed size, or a few more
    return np.minimum(64 * np.log2(1.0 + sketch.ravel()), 4095).astype(np.uint16)


# 2: clusters


def _runs(key: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> np.ndarray:
    """For rows sorted by (key, low): where a run of sizes begins that no set before, with this key, can be similar to."""
    begin = np.ones(len(key), bool)
    if len(key) > 1:
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        group = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(key)]])))
        lift = group * (int(high.max()) + 1)  # so that the running maximum starts anew with each key
        reach = np.maximum.accumulate(high + lift) - lift
        begin[1:] = (group[1:] != group[:-1]) | (low[1:] * percent > reach[:-1] * 100)
    return begin


def _entries(docs: DataFrame, width: int, percent: int, sketch) -> DataFrame:
    """(key, c, low, high, head): the classes that begin with a shingle.

    Where a task has very many classes of one shingle, a run of their sizes
    stands for them: its first class with the run's bounds, the others with
    that class as ``head`` and without a key.
    """

    def packed(key: np.ndarray, name: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((size, key))
        key, name, size = key[order], name[order], size[order]
        begin = np.flatnonzero(_runs(key, size, size, percent))
        many = np.diff(np.concatenate([begin, [len(key)]]))
        long = many > LONG_RUN
        single = np.repeat(~long, many)
        high = np.maximum.reduceat(size, begin) if len(begin) else size
        inner = ~single
        inner[begin] = False
        head = np.repeat(name[begin], many)[inner]
        for k, c, low, top, first in (
            (key[single], name[single], size[single], size[single], None),
            (key[begin[long]], name[begin[long]], size[begin[long]], high[long], name[begin[long]]),
            (None, name[inner], size[inner], size[inner], head),
        ):
            whole = pa.RecordBatch.from_arrays(
                [pa.nulls(len(c), pa.int64()) if k is None else pa.array(k), pa.array(c), pa.array(low), pa.array(top), pa.nulls(len(c), pa.int64()) if first is None else pa.array(first)],
                names=["key", "c", "low", "high", "head"],
            )
            for at in range(0, len(c), ROWS):
                yield whole.slice(at, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = sketch.value.astype(np.uint64)
        have: list[tuple[np.ndarray, ...]] = []
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                hashes, bounds = sets_of(data, offsets, width)
                name, size = class_of(hashes, bounds), np.diff(bounds)
                order = rank[(hashes % np.uint64(SKETCH)).astype(np.int64)] << np.uint64(52) | hashes >> np.uint64(12)
                take = prefix_of(size, percent)
                for i, c in enumerate(name.tolist()):
                    if c in seen:
                        take[i] = 0
                    else:
                        seen.add(c)
                        order[bounds[i] : bounds[i + 1]].sort()
                place = np.arange(int(take.sum())) - np.repeat(np.cumsum(take) - take, take) + np.repeat(bounds[:-1], take)
                have.append((order[place].view(np.int64), np.repeat(name, take), np.repeat(size, take)))
                if sum(len(h[0]) for h in have) >= ENTRIES:
                    yield from packed(*map(np.concatenate, zip(*have, strict=True)))
                    have = []
        if have:
            yield from packed(*map(np.concatenate, zip(*have, strict=True)))

    return docs.select("text").mapInArrow(run, "key long, c long, low long, high long, head long")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows that come sorted by key, some whole keys at a time, by (key, low), each class of a key once; heads as they are, 0 for none."""
    parts: list[pa.RecordBatch] = []

    def columns(rows: list[pa.RecordBatch]) -> list[np.ndarray]:
        got = [np.concatenate([b.column(c).fill_null(0).to_numpy() for b in rows]) for c in ("key", "c", "low", "high", "head")]
        order = np.lexsort((-got[3], got[1], got[0]))
        got = [x[order] for x in got]
        keep = np.ones(len(order), bool)
        keep[1:] = (got[0][1:] != got[0][:-1]) | (got[1][1:] != got[1][:-1])
        got = [x[keep] for x in got]
        order = np.lexsort((got[2], got[0]))
        return [x[order] for x in got]

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if parts and (cut or key[0] != parts[-1].column("key")[-1].as_py()) and sum(b.num_rows for b in parts) + cut >= ROWS:
            yield columns([*parts, batch.slice(0, cut)])
            parts = [batch.slice(cut)]
        else:
            parts.append(batch)
    if parts:
        yield columns(parts)


def _met(entries: DataFrame, percent: int) -> DataFrame:
    """The entries that share a run of sizes with another class, and the members of long runs, from rows sorted by key."""

    def met(got: list[np.ndarray]) -> pa.RecordBatch:
        begin = np.flatnonzero(_runs(got[0], got[2], got[3], percent))
        many = np.diff(np.concatenate([begin, [len(got[0])]]))
        keep = np.repeat(many > 1, many) | (got[4] != 0)
        key, c, low, high, head = (x[keep] for x in got)
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(c), pa.array(low), pa.array(high), pa.array(head, mask=head == 0)], names=["key", "c", "low", "high", "head"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyless: list[pa.RecordBatch] = []

        def keyed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                none = batch.column("key").null_count  # they come first
                keyless.append(batch.slice(0, none))
                yield batch.slice(none)

        for got in _by_key(keyed()):
            yield met(got)
            yield from keyless
            keyless.clear()
        yield from keyless

    return entries.mapInArrow(run, "key long, c long, low long, high long, head long")


def _edges(met: DataFrame, percent: int) -> DataFrame:
    """(a, b): the first class of a run of sizes with each of the others, from rows sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, name, low, high, _ in _by_key(batches):
            begin = np.flatnonzero(_runs(key, low, high, percent))
            head = np.repeat(name[begin], np.diff(np.concatenate([begin, [len(key)]])))
            edge = np.unique(np.stack([head, name], 1)[head != name], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(edge[:, 0]), pa.array(edge[:, 1])], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


# 3: R-trees


class Tree:
    """An R-tree over count vectors, packed by sorting: boxes are kept by their upper corners and smallest sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        spread = np.argsort(points.var(0))[::-1][:2]
        self.order = np.lexsort((*(points[:, s] for s in spread), sizes))
        tops, lows = points[self.order], sizes[self.order]
        self.levels = [(tops, lows)]
        while len(tops) > FANOUT:
            cut = np.arange(0, len(tops), FANOUT)
            tops, lows = np.maximum.reduceat(tops, cut, axis=0), np.minimum.reduceat(lows, cut)
            self.levels.append((tops, lows))


def tree_join(a: Tree, b: Tree, percent: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points whose summed coordinate minima allow the overlap asked for; in one tree each pair once."""
    level = min(len(a.levels), len(b.levels)) - 1
    x, y = (v.ravel() for v in np.indices((len(a.levels[level][0]), len(b.levels[level][0]))))
    while True:
        if same:
            x, y = x[x <= y] if level else x[x < y], y[x <= y] if level else y[x < y]
        (top_a, low_a), (top_b, low_b) = a.levels[level], b.levels[level]
        keep = np.zeros(len(x), bool)
        for at in range(0, len(x), 1 << 16):
            part = slice(at, at + (1 << 16))
            shared = np.minimum(top_a[x[part]], top_b[y[part]]).sum(1, dtype=np.int64)
            keep[part] = shared * (100 + percent) >= percent * (low_a[x[part]] + low_b[y[part]])
        x, y = x[keep], y[keep]
        if not level:
            return a.order[x], b.order[y]
        level -= 1
        many_a, many_b = len(a.levels[level][0]), len(b.levels[level][0])
        i, j = (v.ravel() for v in np.indices((FANOUT, FANOUT)))
        x, y = (x[:, None] * FANOUT + i).ravel(), (y[:, None] * FANOUT + j).ravel()
        inside = (x < many_a) & (y < many_b)
        x, y = x[inside], y[inside]


def points_of(hashes: np.ndarray, bounds: np.ndarray, groups: int) -> np.ndarray:
    """How many of each set's shingles fall into each group."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    group = (mix(hashes) % np.uint64(groups)).astype(np.int64)
    return np.bincount(owner * groups + group, minlength=(len(bounds) - 1) * groups).reshape(-1, groups).astype(np.int32)


def verified(hashes: np.ndarray, bounds: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets are as similar as asked: their exact intersections, on bits of the shingles that several sets have."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    shared = count[back] > 1
    at, owner = place[back[shared]], owner[shared]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    width = (int((count > 1).sum()) + 63) // 64
    both = np.zeros(len(x), np.int64)
    most = max(1, BIT_WORDS // max(1, len(sizes)))  # words of bits at a time
    for first in range(0, width, most):
        a, b = np.searchsorted(at, (first << 6, (first + most) << 6))
        bits = np.zeros((len(sizes), min(most, width - first)), np.uint64)
        np.bitwise_or.at(bits, (owner[a:b], (at[a:b] >> 6) - first), np.uint64(1) << (at[a:b] & 63).astype(np.uint64))
        step = max(1, (1 << 20) // bits.shape[1])
        for i in range(0, len(x), step):
            part = slice(i, i + step)
            both[part] += np.bitwise_count(bits[x[part]] & bits[y[part]]).sum(1, dtype=np.int64)
    return both * (100 + percent) >= percent * (sizes[x] + sizes[y])


def _join_tiles(name, weight, tile, hashes, bounds, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of one pair of tiles (``tile`` is 0 or 1 per class): (classes, links, an equal or smaller linked class)."""
    sizes = np.diff(bounds)
    groups = 1 << int(np.clip(np.ceil(np.log2(max(1, sizes.max()) / 8)), 4, 8))
    points = points_of(hashes, bounds, groups)
    rows = [np.flatnonzero(tile == t) for t in (0, 1)]
    left = Tree(points[rows[0]], sizes[rows[0]])
    if len(rows[1]):
        x, y = tree_join(left, Tree(points[rows[1]], sizes[rows[1]]), percent, False)
        x, y = rows[0][x], rows[1][y]
    else:
        x, y = tree_join(left, left, percent, True)
        x, y = rows[0][x], rows[0][y]
    good = verified(hashes, bounds, x, y, percent)
    x, y = x[good], y[good]
    links = np.bincount(x, weight[y], len(name)) + np.bincount(y, weight[x], len(name))
    root = np.arange(len(name))
    while len(x):
        old = root.copy()
        np.minimum.at(root, x, root[y])
        np.minimum.at(root, y, root[x])
        root = root[root]
        if (root == old).all():
            break
    met = np.flatnonzero(links)
    return name[met], links[met].astype(np.int64), name[root[met]]


def _links(members: DataFrame, percent: int) -> DataFrame:
    """(c, links, other): from the rows of each pair of tiles."""

    def run(key: tuple, batch: pa.Table) -> pa.Table:
        batch = batch.combine_chunks()
        name, first = np.unique(batch["c"].to_numpy(), return_index=True)  # repeated rows of a class count once
        sets = [np.frombuffer(batch["set"][i].as_buffer(), np.uint64) for i in first.tolist()]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        found = _join_tiles(
            name,
            batch["w"].to_numpy()[first],
            (batch["tile"].to_numpy() != key[1].as_py())[first].astype(np.int64),
            np.concatenate(sets),
            bounds,
            percent,
        )
        return pa.table(dict(zip(("c", "links", "other"), map(pa.array, found), strict=True)))

    return members.groupBy("root", "ta", "tb").applyInArrow(run, "c long, links long, other long")


@in_small_batches
def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Classes of texts that are similar, directly or through others.

    Words are what stands between ASCII white space, lower-cased (A-Z). Two
    texts link when the intersection of their sets of ``width``-word shingles
    is at least ``percent`` per cent of the union. A text with fewer words has
    one shingle, its whole sequence; one without words (or null) has none and
    links with nothing, not even its like.

    Returns a row per input row: id, ``n_shingles``, ``component_id`` (the
    smallest id reachable by links, its own included), ``n_links`` (rows that
    it links with directly, other copies of its text included), ``is_first``
    (it has that smallest id) and ``text_key`` (a hash of the text, to tell
    rows with one id apart).
    Null ids are allowed; they are no component's smallest id unless no
    member has another. Repeated rows are rows of their own. An empty table gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("t")).alias("row"), text.alias("text"))
    scanned = stored(_scan(rows, width), "jaccard_scan")
    sketch = spark.sparkContext.broadcast(_summed(scanned.where("part is not null").select("part", "counts")))  # of fixed size
    known = scanned.where("part is null").select("row.id", "row.t", "n", "c")

    # classes that meet others often enough, and what they meet there
    dealt = _entries(rows, width, percent, sketch).repartition("key", F.when(F.col("key").isNull(), F.col("c"))).sortWithinPartitions("key")
    met = stored(_met(dealt, percent), "jaccard_met")
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("low") * percent / 100) / 10))
    enough = met.groupBy("c").agg(F.count(F.lit(1)).alias("k"), F.min("low").alias("low")).where(F.col("k") >= need)
    others = met.where("head is null or head != c").join(enough.select("c"), "c", "left_semi")
    good = stored(others.unionByName(met.where("head = c")), "jaccard_good")
    drop_stored(met)
    across = _edges(good.where("key is not null").repartition("key").sortWithinPartitions("key"), percent)
    within = good.where("key is null").select(F.col("head").alias("a"), F.col("c").alias("b"))
    clusters = stored(components(across.unionByName(within), "jaccard_clusters"), "jaccard_roots")
    drop_stored(good)

    # a row to take the set from, for every class that is in a cluster
    classes = known.where("n > 0").groupBy("c").agg(
        F.max("n").alias("n"),
        F.count(F.lit(1)).alias("w"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("first"),
    )
    member = clusters.join(classes, F.col("node") == F.col("c")).select("c", "root", "n", "w", "first.t")
    member = stored(member, "jaccard_members")
    bucket = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int")
    total = member.groupBy("root").agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("all_c"))
    large = (F.col("all_n") > TILE_SHINGLES) | (F.col("all_c") > TILE_CLASSES)
    big = total.where(large).select("root", F.lit(True).alias("big"))
    shelves = (
        member.join(big, "root")
        .groupBy("root", bucket.alias("shelf"))
        .agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("k"))
        .withColumn("cuts", F.ceil(F.greatest(F.col("s") / TILE_SHINGLES, F.col("k") / TILE_CLASSES)).cast("int"))
    )
    # tiles of a cluster: one, or for each shelf of sizes as many as it takes; only tiles of one or neighbouring shelves meet
    tiles = shelves.select("root", "shelf", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    named = tiles.select("root", "shelf", (F.col("shelf") * 1_000_000 + F.col("cut")).alias("tile"))
    other = named.select(F.col("root").alias("r"), F.col("shelf").alias("s"), F.col("tile").alias("tb"))
    meet = named.join(other, (F.col("root") == F.col("r")) & (F.col("s") - F.col("shelf")).between(0, 1) & (F.col("tile") <= F.col("tb")))
    meet = meet.select("root", F.col("tile").alias("ta"), "tb")
    sides = meet.select("root", F.col("ta").alias("tile"), "ta", "tb").unionByName(
        meet.where("ta != tb").select("root", F.col("tb").alias("tile"), "ta", "tb")
    )
    dealt = (
        member.withColumn("shelf", bucket)
        .join(shelves.select("root", "shelf", "cuts"), ["root", "shelf"], "left")
        .withColumn("tile", F.coalesce(F.col("shelf") * 1_000_000 + F.pmod(F.xxhash64("c"), F.col("cuts")), F.lit(0)).cast("int"))
        .join(sides, ["root", "tile"], "left")
        .select("c", "root", "w", "tile", F.coalesce("ta", F.lit(0)).alias("ta"), F.coalesce("tb", F.lit(0)).alias("tb"))
    )
    # sent to every task: of fixed size; it only spares the shuffle sets that nothing asks for
    bits = spark.sparkContext.broadcast(hash_bits(member.select("t"), FILTER_BITS))
    sets = _sets(rows.select("row.t", "text"), width, bits)
    links = stored(_links(dealt.join(sets, "c"), percent), "jaccard_links")

    roots = components(links.select(F.col("c").alias("a"), F.col("other").alias("b")), "jaccard_components")
    counted = links.groupBy("c").agg(F.sum("links").alias("links"))
    firsts = classes.select("c", "w", "first")
    smallest = roots.join(firsts, F.col("node") == F.col("c")).groupBy("root").agg(F.min("first").alias("group"))
    linked = roots.join(smallest, "root").select(F.col("node").alias("c"), "group")
    result = stored(
        firsts.join(linked, "c", "left").join(counted, "c", "left").select(
            "c", F.coalesce("group", "first").alias("group"), (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("links")
        ),
        "jaccard_classes",
    )
    any_words = F.col("n") > 0
    return known.join(result, "c", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(any_words, F.col("group.id")).otherwise(F.col("id")).alias("component_id"),
        F.when(any_words, F.col("links")).otherwise(F.lit(0)).alias("n_links"),
        F.when(any_words, F.col("id").eqNullSafe(F.col("group.id")) & (F.col("t") == F.col("group.t"))).otherwise(F.lit(True)).alias("is_first"),
        F.col("t").alias("text_key"),
    )


def _sets(texts: DataFrame, width: int, bits) -> DataFrame:
    """(c, set): the sets of the texts whose hashes may be asked for, each class once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(in_bits(batch.column("t").to_numpy(), bits.value)))
            for _, _, data, offsets in slices(batch.column("text"), PIECE_BYTES):
                hashes, bounds = sets_of(data, offsets, width)
                name = class_of(hashes, bounds).tolist()
                new = [i for i, c in enumerate(name) if bounds[i + 1] > bounds[i] and not (c in seen or seen.add(c))]
                packed = [hashes[bounds[i] : bounds[i + 1]].tobytes() for i in new]
                yield pa.RecordBatch.from_arrays([pa.array([name[i] for i in new], pa.int64()), pa.array(packed, pa.binary())], names=["c", "set"])

    return texts.mapInArrow(run, "c long, set binary")
