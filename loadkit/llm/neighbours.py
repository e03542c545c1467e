"""Nearest neighbours by a hierarchical navigable small-world graph per shard.

Equal vectors are one node. Nodes are dealt to shards of bounded size by a
hash; a task builds the graph of one shard and stores it as flat arrays. Every
query is searched in every shard, and the shards' answers are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import stored

SHARD_ROWS = 6000
M = 16
EF_BUILD = 64
EF_SEARCH = 160
SEEDS = 192
BATCH = 384


def _distances(vectors: np.ndarray, ids: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances from each point to its own row of nodes; infinite for id -1."""
    gap = vectors[ids] - points[:, None, :]
    return np.where(ids < 0, np.inf, np.einsum("qkd,qkd->qk", gap, gap))


def _spread(vectors: np.ndarray, ids: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's nodes, near ones first, preferring those nearer to the point than to one chosen before."""
    order = np.argsort(far, axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    rows, width = ids.shape
    points = vectors[ids]
    chosen = np.zeros((rows, width), bool)
    closest = np.full((rows, width), np.inf, np.float32)  # to any chosen node
    number = np.zeros(rows, np.int64)
    for c in range(width):
        take = (far[:, c] < closest[:, c]) & (number < most) & np.isfinite(far[:, c])
        chosen[:, c] = take
        number += take
        if take.any():
            gap = points[take] - points[take, c][:, None, :]
            closest[take] = np.minimum(closest[take], np.einsum("rkd,rkd->rk", gap, gap))
    # places left go to the nearest of the others
    rank = np.where(chosen, 0, np.where(np.isfinite(far), 1, 2)) * width + np.arange(width)
    pick = np.argsort(rank, axis=1)[:, :most]
    out = np.take_along_axis(ids, pick, 1)
    out = np.where(np.isfinite(np.take_along_axis(far, pick, 1)), out, -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1).astype(np.int32)


def _search(vectors, links, points, entry, ef, at_once=4):
    """The ``ef`` nearest nodes found from the entry nodes, for all points together: (ids, squared distances), near first."""
    rows = len(points)
    seen = np.zeros((rows, len(links) + 1), bool)  # the last column is for id -1
    seen[:, -1] = True
    line = np.arange(rows)[:, None]
    seen[line, entry] = True
    ids = np.full((rows, ef), -1, np.int32)
    far = np.full((rows, ef), np.inf, np.float32)
    width = min(ef, entry.shape[1])
    ids[:, :width], far[:, :width] = entry[:, :width], _distances(vectors, entry[:, :width], points)
    todo = ids >= 0
    live = np.arange(rows)
    while len(live):
        wait = np.where(todo[live], far[live], np.inf)
        pick = np.argpartition(wait, min(at_once, ef - 1), axis=1)[:, :at_once]
        good = np.isfinite(np.take_along_axis(wait, pick, 1))
        live, pick, good = live[good.any(1)], pick[good.any(1)], good[good.any(1)]
        if not len(live):
            break
        here = live[:, None]
        nodes = np.where(good, ids[here, pick], -1)
        todo[here, pick] = False
        near = np.where(nodes[:, :, None] < 0, -1, links[nodes])
        for j in range(near.shape[1]):
            column = near[:, j]
            column[seen[here, column]] = -1
            seen[here, column] = True
        near = near.reshape(len(live), -1)
        dist = _distances(vectors, near, points[live])
        all_ids = np.concatenate([ids[live], near], 1)
        all_far = np.concatenate([far[live], dist], 1)
        all_todo = np.concatenate([todo[live], near >= 0], 1)
        best = np.argpartition(all_far, ef - 1, axis=1)[:, :ef]
        ids[live], far[live], todo[live] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_far, all_todo))
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)


def build(vectors: np.ndarray, m: int = M, ef: int = EF_BUILD) -> list[np.ndarray]:
    """The layers of the graph, lowest first: the neighbours of nodes 0 to n as rows of a flat array, padded with -1.

    Layer sizes fall by the factor ``m``, and a layer holds the first nodes of
    the one below. Nodes are put in by batches: each is linked to nodes found
    by searching the graph so far and to its own batch.
    """
    n = len(vectors)
    sizes = [n]
    while sizes[-1] > SEEDS:
        sizes.append(sizes[-1] // m)
    layers: list[np.ndarray] = []  # highest first while building
    for level in range(len(sizes) - 1, -1, -1):
        size, most = sizes[level], 2 * m if level == 0 else m
        links = np.full((size, most), -1, np.int32)
        done = min(size, max(SEEDS, sizes[level + 1] if level + 1 < len(sizes) else 0))  # the layer above is all in
        if done > 1:
            all_ids = np.broadcast_to(np.arange(done), (done, done))
            far = _distances(vectors, all_ids, vectors[:done])
            np.fill_diagonal(far, np.inf)
            links[:done] = _spread(vectors, all_ids, far, most)
        while done < size:
            end = min(size, done + min(BATCH, done))
            new = np.arange(done, end)
            points = vectors[new]
            entry = descend(vectors, layers, points)
            ids, far = _search(vectors, links[:done], points, entry, ef)
            mates = np.broadcast_to(new, (len(new), len(new)))
            gap = _distances(vectors, mates, points)
            np.fill_diagonal(gap, np.inf)
            few = min(len(new), 2 * m)
            best = np.argpartition(gap, few - 1, axis=1)[:, :few]
            ids = np.concatenate([ids, np.take_along_axis(mates, best, 1)], 1)
            far = np.concatenate([far, np.take_along_axis(gap, best, 1)], 1)
            links[new, :m] = _spread(vectors, ids, far, m)
            _link_back(vectors, links, new, most)
            done = end
        layers.append(links)
    return layers[::-1]


def _link_back(vectors: np.ndarray, links: np.ndarray, new: np.ndarray, most: int) -> None:
    """Lets the neighbours of new nodes know them, within the room of their rows."""
    to = links[new].ravel()
    source = np.repeat(new, links.shape[1])[to >= 0]  # row by row
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    nodes, first, count = np.unique(to, return_index=True, return_counts=True)
    place = np.arange(len(to)) - np.repeat(first, count)
    wide = np.full((len(nodes), int(count.max(initial=0))), -1, np.int64)
    wide[np.repeat(np.arange(len(nodes)), count), place] = source
    if wide.shape[1] > 64:  # only the nearest of very many
        far = _distances(vectors, wide, vectors[nodes])
        wide = np.take_along_axis(wide, np.argpartition(far, 63, axis=1)[:, :64], 1)
    have = links[nodes]
    wide = np.where((wide[:, :, None] == have[:, None, :]).any(2), -1, wide)
    ids = np.concatenate([have, wide], 1)
    links[nodes] = _spread(vectors, ids, _distances(vectors, ids, vectors[nodes]), most)


def descend(vectors: np.ndarray, layers: list[np.ndarray], points: np.ndarray) -> np.ndarray:
    """Entry nodes for the layer below ``layers`` (highest first)."""
    entry = np.zeros((len(points), 1), np.int32)
    for links in layers:
        ids, _ = _search(vectors, links, points, entry, 8, 1)
        entry = np.where(ids < 0, ids[:, :1], ids)[:, : min(4, len(links))]
        first = entry[:, :1]
        entry = np.concatenate([first, np.where(entry[:, 1:] == first, -1, entry[:, 1:])], 1)
    return entry


def search(vectors: np.ndarray, layers: list[np.ndarray], points: np.ndarray, ef: int = EF_SEARCH) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` nearest nodes found for each point: (ids, squared distances), near first."""
    return _search(vectors, layers[0], points, descend(vectors, layers[:0:-1], points), max(1, min(ef, len(vectors))))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 1))


INDEX = "shard int, dim int, n int, vectors binary, ids array<array<bigint>>, sizes array<int>, links binary"


def index(rows: DataFrame, id_col: str, vector_col: str, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard and dimension: vectors, the smallest ``k`` + 1 ids of each, layer sizes and neighbour arrays."""
    vectors = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & usable(F.col("v"))
    )
    # a search never needs more ids of equal vectors than these
    kept = vectors.distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    classes = stored(
        kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("v")), "vectors"
    )
    shards = max(1, math.ceil(classes.count() / shard_rows))

    def make(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending")])
        exact = _matrix(group["v"])
        layers = build(exact.astype(np.float32))
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int32()),
                "dim": pa.array([key[1].as_py()], pa.int32()),
                "n": pa.array([len(exact)], pa.int32()),
                "vectors": pa.array([exact.tobytes()], pa.binary()),
                "ids": pa.array([group["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
                "sizes": pa.array([[x.shape[0] for x in layers]], pa.list_(pa.int32())),
                "links": pa.array([b"".join(x.tobytes() for x in layers)], pa.binary()),
            }
        )

    dealt = classes.withColumn("place", F.xxhash64("v")).withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("shard", "dim").applyInArrow(make, INDEX), "graphs")


def layers_of(sizes: list[int], links: bytes, m: int = M) -> list[np.ndarray]:
    flat, at, out = np.frombuffer(links, np.int32), 0, []
    for level, size in enumerate(sizes):
        width = 2 * m if level == 0 else m
        out.append(flat[at : at + size * width].reshape(size, width))
        at += size * width
    return out


def nearest(graphs: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 10, ef: int = EF_SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query, not counting the query's own id.

    ``score`` is the Euclidean distance of the original vectors in double
    precision; ties go to the smaller id. Null and unusable queries are left
    out; a repeated query is answered once. Only vectors of the query's length
    are candidates.
    """
    wanted = (
        queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("q"))
        .where(F.col("query_id").isNotNull() & usable(F.col("q")))
        .dropDuplicates(["query_id"])
        .withColumn("dim", F.size("q"))
    )
    places = graphs.select(F.col("shard").alias("at_shard"), F.col("dim").alias("at_dim"))
    dealt = wanted.join(places, F.col("dim") == F.col("at_dim")).drop("dim")

    def answer(key: tuple, graph: pa.Table, asked: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if graph.num_rows and asked.num_rows:
            row = graph.slice(0, 1).to_pylist()[0]
            exact = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dim"])
            small, layers = exact.astype(np.float32), layers_of(row["sizes"], row["links"])
            points, names = _matrix(asked["q"]), asked["query_id"].to_pylist()
            for at in range(0, len(points), BATCH):
                part = points[at : at + BATCH]
                ids, _ = search(small, layers, part.astype(np.float32), ef)
                gap = exact[ids] - part[:, None, :]
                score = np.where(ids < 0, np.inf, np.sqrt((gap * gap).sum(2)))
                order = np.argsort(score, axis=1, kind="stable")[:, : k + 1]
                for name, nodes, far in zip(names[at : at + BATCH], np.take_along_axis(ids, order, 1).tolist(), np.take_along_axis(score, order, 1).tolist(), strict=True):
                    for node, d in zip(nodes, far, strict=True):
                        if node >= 0:
                            for i in row["ids"][node]:
                                found["query_id"].append(name)
                                found["vec_id"].append(i)
                                found["score"].append(d)
        return pa.table(
            {"query_id": pa.array(found["query_id"], pa.int64()), "vec_id": pa.array(found["vec_id"], pa.int64()), "score": pa.array(found["score"], pa.float64())}
        )

    pairs = graphs.groupBy("shard", "dim").cogroup(dealt.groupBy("at_shard", "at_dim")).applyInArrow(answer, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.where("vec_id != query_id").withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_table(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10) -> DataFrame:
    """The ``k`` nearest rows of each query (see ``nearest``).

    Rows take part if their id is set and their vector is not null, not zero
    and without null or non-finite components. Repeated rows with one id and
    vector count once; one id with several vectors counts with each, the
    nearest first. Other columns are not read.
    """
    return nearest(index(rows, id_col, vector_col, k), queries, id_col, vector_col, k)

