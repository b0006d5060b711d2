"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions alone.

Each source is cut into blocks of ``block`` documents and has an integer share p of a frame of Q = sum of the shares slots. Its k-th block
(from 0) is released at floor(k Q / p) and due at ceil((k + 1) Q / p). In every slot, earliest deadline first picks among the released
blocks; by then every source has had floor or ceil of its due share, a deviation of less than one block. The schedule repeats after Q
slots, so one frame is worked out from the shares alone (a fold over Q slots) and every block finds its slot by arithmetic:
Q x (k div p) + offset[source, k mod p]. A source that ends early leaves its slots empty; the others keep their windows.

Every row is kept. Documents are numbered inside their source by MD5 of the key: 4096 hash cells per source are counted first and the
numbers of a cell start at the running count, so the largest source is spread over the cluster and no text is moved for it.
Null sources form a source of their own; repeated rows (same key and source) are numbered one after the other; a source with no share
gets the smallest share, 1; an empty table gives an empty result; other columns pass through untouched.

Bounds: sources are mixture components, up to some thousands; the frame has ``frame`` + one slot per source at most. The table of one
frame is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.llm.common import let

BLOCK = 16
FRAME = 1000
CELL = 3  # hex digits


def root_shares(df: DataFrame, source: str = "source", frame: int = FRAME) -> DataFrame:
    """source, share: target weights in proportion to the square root of each source's documents, in whole slots of a frame."""
    counts = df.groupBy(F.col(f"`{source}`").cast("string").alias("source")).agg(F.count("*").alias("n"))
    roots = counts.select("source", F.floor(F.sqrt("n")).alias("root"))
    total = roots.agg(F.sum("root")).scalar()
    return roots.select("source", F.greatest(F.lit(1).cast("long"), F.floor(F.lit(frame) * F.col("root") / total)).alias("share"))


def edf_frame(shares: DataFrame) -> DataFrame:
    """source, turn, share, frame, offset: the slot of each source's turn-th block in one frame."""
    listed = shares.agg(F.array_sort(F.collect_list(F.struct("source", "share"))).alias("all"))
    listed = listed.select("all", F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["share"]).alias("frame")).where("frame > 0")
    start = F.struct(F.transform("all", lambda x: F.lit(0).cast("long")).alias("done"), F.expr("cast(array() as array<int>)").alias("order"))

    def pick(done: Column, t: Column) -> Column:
        def window(x: Column, i: Column) -> Column:
            k, frame = F.get(done, i), F.col("frame")
            released, due = F.floor(k * frame / x["share"]), F.ceil((k + 1) * frame / x["share"])
            return F.when(released <= t, F.struct(due.alias("due"), i.alias("i")))

        return F.array_min(F.transform("all", window))["i"]

    def step(a: Column, t: Column) -> Column:
        return let(pick(a["done"], t), lambda p: F.struct(
            F.transform(a["done"], lambda d, i: F.when(i == p, d + 1).otherwise(d)).alias("done"), F.concat(a["order"], F.array(p)).alias("order"),
        ))

    order = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("frame") - 1), start, step, lambda a: a["order"])
    slots = listed.select("all", "frame", F.posexplode(order).alias("offset", "i"))
    turn = F.row_number().over(W.partitionBy("i").orderBy("offset")) - 1  # one frame only
    of = F.get("all", F.col("i"))
    return slots.select(of["source"].alias("source"), turn.cast("long").alias("turn"), of["share"].alias("share"), F.col("frame").alias("frame"), F.col("offset").cast("long").alias("offset"))


def placed(rows: DataFrame, shares: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` (doc_id, source, ...) with block, release, deadline, slot and place: (slot, place) is the mixed order."""
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    named = F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit("")))
    rows = rows.withColumns({"__mark": mark, "__source": named, "__cell": F.substring(mark, 1, CELL)})
    cells = rows.groupBy("__source", "__cell").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("__source").orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = cells.select("__source", "__cell", before.alias("__start"))
    inside = F.row_number().over(W.partitionBy("__source", "__cell").orderBy("__mark", "doc_id")) - 1
    numbered = rows.join(starts, ["__source", "__cell"]).withColumn("__number", F.col("__start") + inside).withColumn("block", F.floor(F.col("__number") / block))
    frame = edf_frame(shares)
    frame = frame.select(F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit(""))).alias("__source"), "turn", "share", "frame", "offset")
    most = shares.select(F.col("source").alias("__s"), F.col("share").alias("__share"))
    most = most.select(F.concat(F.when(F.col("__s").isNull(), "-").otherwise("+"), F.coalesce("__s", F.lit(""))).alias("__source"), "__share")
    turned = numbered.join(F.broadcast(most), "__source").withColumn("turn", F.col("block") % F.col("__share"))
    slot = F.floor(F.col("block") / F.col("share")) * F.col("frame") + F.col("offset")
    return turned.join(F.broadcast(frame), ["__source", "turn"]).withColumns({
        "release": F.floor(F.col("block") * F.col("frame") / F.col("share")), "deadline": F.ceil((F.col("block") + 1) * F.col("frame") / F.col("share")),
        "slot": slot, "place": F.col("__number") % block,
    })


def with_all_sources(shares: DataFrame, rows: DataFrame) -> DataFrame:
    """The given shares of the sources that ``rows`` has; a source without one gets 1."""
    present = rows.select("source").distinct()
    given = shares.select(F.col("source").alias("__s"), "share")
    return present.join(given, F.col("source").eqNullSafe(F.col("__s")), "left").select("source", F.greatest(F.coalesce("share", F.lit(1)).cast("long"), F.lit(1).cast("long")).alias("share"))


def mix_schedule(df: DataFrame, shares: DataFrame | None = None, source: str = "source", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: doc_id, source, block, release, deadline, slot, place."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"))
    shares = root_shares(rows) if shares is None else with_all_sources(shares, rows)
    return placed(rows, shares, block).select("doc_id", "source", "block", "release", "deadline", "slot", "place")


def mix(df: DataFrame, shares: DataFrame | None = None, source: str = "source", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """The rows of ``df`` in mixed order: ranges of slots, sorted inside; written out, the files follow the schedule."""
    own = df.columns
    at = {c: f"c{k}" for k, c in enumerate(own)}
    renamed = df.toDF(*at.values())
    rows = renamed.select(F.col(at[key]).cast("long").alias("doc_id"), F.col(at[source]).cast("string").alias("source"), F.struct(*at.values()).alias("doc"))
    narrow = rows.select("source")
    shares = root_shares(narrow) if shares is None else with_all_sources(shares, narrow)
    order = placed(rows, shares, block).select("slot", "place", "doc")
    return order.repartitionByRange("slot").sortWithinPartitions("slot", "place").select("doc.*").toDF(*own)
