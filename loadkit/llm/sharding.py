"""Balanced label propagation: linked documents share a shard as far as exact quotas allow.

Documents are linked when their texts are equal. The neighbours of a document
are the other members of its group, so what a document has to know of them is
how many have each shard as their label. Propagation therefore runs on one row
per group, with at most ``n_shards`` counts whatever the group's size, and
never on pairs.

Every document begins with a random label. In each round the members of a group
move to the label that most of them have, among the shards with room for all of
them; a shard takes groups while its quota lasts, those with most neighbours
there first, and the others look again. Who has not been taken holds no place,
so full shards cannot block each other, and documents without neighbours fill up
at the end. Every shard that is asked takes a group at least: rounds go on until
each group is taken or larger than any room that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.llm.common import bucket_of, local_frame, numbered, stored
from loadkit.operators.keyed import join_per_key

BUCKETS = 1024
SALTS = 64
KEY = ["_h", "_crc", "_size"]


def _queued(wish: DataFrame, within: list[str], name: str) -> DataFrame:
    """Adds the rows of the groups that go before a group, within ``within``: by rising ``_level``, then by salt, then falling ``_gain``.

    Groups are added up inside (level, salt) and shifted by the sums of the pieces before, a few thousand per value at most.
    """
    piece = [*within, "_level", "_salt"]
    earlier = Window.partitionBy(*within).orderBy("_level", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    pieces = wish.groupBy(*piece).agg(F.sum("_need").alias("_rows"))
    queue = pieces.select(*piece, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_ahead"))
    order = Window.partitionBy(*piece).orderBy(F.desc("_gain"), *KEY).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_ahead") + F.coalesce(F.sum("_need").over(order), F.lit(0))
    return wish.join(queue, piece).withColumn(name, before).drop("_ahead")


def _rooms(free: list[int]) -> Column:
    return F.array(*[F.struct(F.lit(s).alias("s"), F.lit(n).cast("long").alias("n")) for s, n in enumerate(free)])


def _round(units: DataFrame, free: list[int], seed: int) -> DataFrame:
    """Adds the shard that takes each group, or null: every group fits into one room at least."""
    have = lambda s: F.coalesce(F.col("_near")[s], F.lit(0))
    fit = F.filter(_rooms(free), lambda r: r["n"] >= F.col("_need"))
    best = F.array_max(F.transform(fit, lambda r: F.struct(have(r["s"]).alias("n"), F.xxhash64(*KEY, r["s"], F.lit(seed)).alias("h"), r["s"].alias("s"))))
    wish = (
        units.withColumn("_best", best)
        .select(*units.columns, F.col("_best.s").alias("_to"), F.col("_best.n").alias("_gain"))
        .withColumn("_level", -F.floor(F.log2(F.col("_gain") + 1)))
        .withColumn("_salt", bucket_of(*map(F.col, KEY), F.lit(seed), buckets=SALTS))
    )
    room = F.element_at(_rooms(free), F.col("_to") + 1)["n"]
    taken = F.when(F.col("_before") + F.col("_need") <= room, F.col("_to"))
    return _queued(wish, ["_to"], "_before").select(*units.columns, taken.alias("_shard"))


def _laid(units: DataFrame, free: list[int]) -> DataFrame:
    """(group, shard, rows) of groups that fit nowhere whole: laid out one behind the other over what is left."""
    line = units.withColumns({"_level": -F.floor(F.log2("_need")), "_salt": bucket_of(*map(F.col, KEY), buckets=SALTS), "_gain": F.col("_need"), "_all": F.lit(0)})
    line = _queued(line, ["_all"], "_before")
    spans, at = [], 0
    for n, s in sorted(((n, s) for s, n in enumerate(free)), reverse=True):
        spans.append(F.struct(F.lit(s).alias("s"), F.lit(at).cast("long").alias("from"), F.lit(at + n).cast("long").alias("to")))
        at += n
    part = lambda r: F.least(r["to"], F.col("_before") + F.col("_need")) - F.greatest(r["from"], F.col("_before"))
    pieces = F.transform(F.array(*spans), lambda r: F.struct(r["s"].alias("_shard"), part(r).alias("_n")))
    return line.select(*KEY, F.explode(pieces).alias("p")).select(*KEY, "p._shard", "p._n").where("_n > 0")


def assign_shards(
    docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", seed: int = 17
) -> DataFrame:
    """A shard and a place in it for every row, under the law ``rows``.

    Returns one row per input row: the id, ``size`` (UTF-8 bytes plus 16),
    ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (null under
    this law). Shard counts differ by one at most. A group of equal texts is in
    one shard if, when its turn came, any had room for all of it. A group larger
    than a shard fills whole shards first; groups that fit nowhere whole lie one
    behind the other over the rooms that are left, largest first.

    A null text counts as empty. Null ids are allowed. Repeated rows are
    documents of their own in the same group. An empty table gives no rows.
    Texts are only hashed, whatever their length. Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = stored(
        docs.select(
            F.col(id_col).alias("_id"),
            (F.octet_length(text) + 16).cast("long").alias("_size"),
            F.crc32(text.cast("binary")).cast("long").alias("_crc"),
            F.xxhash64(text).alias("_h"),
        ).withColumn("_bucket", bucket_of(F.col("_id"), F.col("_h"), F.lit(seed), buckets=BUCKETS)),
        "shard_rows",
    )
    total = base.count()
    free = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]

    # labels by group: the members, and how many of them have each label
    labels = base.groupBy(*KEY, bucket_of(F.col("_id"), F.col("_h"), F.lit(~seed), buckets=n_shards).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    near = F.map_from_entries(F.collect_list(F.struct("s", "n")))  # n_shards entries at most
    groups = labels.groupBy(*KEY).agg(F.sum("n").alias("_need"), near.alias("_near")).where("_need > 1")
    units = stored(groups, "shard_groups")

    # groups larger than a quota: there are fewer of them than shards
    whole = []
    for group in units.where(F.col("_need") > max(free)).select(*KEY, "_need").orderBy(F.desc("_need"), *KEY).collect():
        left = group["_need"]
        for s in range(n_shards):
            if 0 < free[s] <= left:
                whole.append((*(group[k] for k in KEY), s, free[s]))
                left, free[s] = left - free[s], 0
    kinds = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in units.select(*KEY).schema)}, _shard int, _n long"
    placed = local_frame(spark, whole, kinds)
    if whole:
        used = placed.groupBy(*KEY).agg(F.sum("_n").alias("_used"))
        rest = units.join(F.broadcast(used), KEY, "left").withColumn("_need", F.col("_need") - F.coalesce("_used", F.lit(0)))
        units = rest.where("_need > 0").drop("_used")

    aside = []
    for turn in range(total + 1):
        most = max(free)
        asked = stored(_round(units.where(F.col("_need") <= most), free, seed + turn), "shard_round")
        taken = {r["_shard"]: r["n"] for r in asked.groupBy("_shard").agg(F.sum("_need").alias("n")).collect()}
        aside.append(units.where(F.col("_need") > most))  # rooms only get smaller
        placed = placed.unionByName(asked.where("_shard is not null").select(*KEY, "_shard", F.col("_need").alias("_n")))
        for s, n in taken.items():
            if s is not None:
                free[s] -= n
        units = asked.where("_shard is null").drop("_shard")
        if None not in taken:
            break
    late = aside[0]
    for more in aside[1:]:
        late = late.unionByName(more)
    late = stored(late, "shard_late")
    placed = placed.unionByName(_laid(late, free))
    over = late.agg(F.sum("_need")).first()[0] or 0
    for _, s in sorted(((n, s) for s, n in enumerate(free)), reverse=True):
        used = min(over, free[s])
        free[s], over = free[s] - used, over - used

    # a group's members by number: the first _n of its first shard, and so on
    plan = placed.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct(F.col("_shard").alias("s"), F.col("_n").alias("n")))).alias("_plan"))
    plan = stored(plan, "shard_plan")
    members = numbered(join_per_key(base, plan.select(*KEY), KEY, "left_semi"), KEY, "_bucket", ["_id"], "_pos")
    members = join_per_key(members, plan, KEY, "inner")
    of_group = F.aggregate(
        "_plan",
        F.struct(F.col("_pos").alias("left"), F.lit(-1).alias("shard")),
        lambda acc, x: F.when(
            (acc["shard"] < 0) & (acc["left"] < x["n"]), F.struct(acc["left"].alias("left"), x["s"].alias("shard"))
        ).otherwise(F.struct((acc["left"] - x["n"]).alias("left"), acc["shard"].alias("shard"))),
    )["shard"]
    in_group = members.select("_id", *KEY, "_bucket", of_group.alias("_shard"))

    # documents without neighbours fill the rest
    alone = numbered(join_per_key(base, plan.select(*KEY), KEY, "left_anti").withColumn("_all", F.lit(0)), ["_all"], "_bucket", ["_id", *KEY], "_pos")
    filled = alone.withColumn("_plan", _rooms(free)).select("_id", *KEY, "_bucket", of_group.alias("_shard"))

    result = numbered(stored(in_group.unionByName(filled), "shard_placed"), ["_shard"], "_bucket", ["_id", *KEY], "_slot")
    return result.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
