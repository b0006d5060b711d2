"""Resharding by minimum-cost flow: from old shard sizes and new capacities to moved blocks and rewritten files.

Old shards supply their bytes, new ones take up to their capacity; keeping bytes in the shard of the same number costs nothing, moving them costs
1 a byte or what the caller's table says. ``min_cost_flow`` saturates what may stay and then augments along cheapest paths; its network has one node
per shard, so it is solved on the driver at any number of rows. The flow out of an old shard is cut into blocks: its documents, in the order of their
``place`` (text that sorts), fill the outgoing edges one after the other, lowest new shard first, and the rest stays. Where a block ends is found by
radix selection: bytes are summed per two-digit prefix of ``place``, the prefix in which a cut falls is opened, and so on until few rows are left to
fetch. No shard is sorted or gathered, and the documents themselves are dealt by comparing ``place`` with at most (old + new) cuts.
A document goes where its last byte lies, so every cut may miss by less than one document. A second, much smaller flow from the sizes then reached
moves the smallest documents first and leaves the shards apart by less than the next one of these.

``reshard_files`` does the same for a layout of files: its place is the file and the row in it, so blocks are runs of whole files but for one file at
each cut, only files that lose rows are written anew and the rest is carried over by name in the manifest.

A null text has size 1 (no bytes, plus 1), a null old shard counts as shard 0. Repeated rows are told apart by the row number of the staged table and dealt
one by one. An empty table gives no rows and no moves. Other columns aren't read (files keep theirs).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dockflow.llm.common import staged

DIGITS = 2
#: Rows of an opened prefix that are fetched instead of being summed again.
FEW = 1000
#: Leading hexadecimal digits of a place that share a numbering window.
SLOT_DIGITS = 3


def min_cost_flow(supply: list[int], capacity: list[int], cost: np.ndarray | None = None) -> np.ndarray:
    """Bytes from every old to every new shard at least cost; ``capacity`` must hold all of ``supply``.

    Successive cheapest paths with potentials, after the free edges are filled; ties take the lowest new shard.
    """
    m, n = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards can't hold all bytes")
    if cost is None:
        cost = 1 - np.eye(m, n, dtype=np.int64)
    cost = np.asarray(cost, float)
    if cost.min(initial=0) < 0:
        raise ValueError("costs below zero")
    flow = [[0] * n for _ in range(m)]
    left, room = list(supply), list(capacity)
    for i in range(min(m, n)):
        if cost[i, i] == 0:
            flow[i][i] = min(left[i], room[i])
            left[i] -= flow[i][i]
            room[i] -= flow[i][i]
    rows, columns = np.zeros(m), np.zeros(n)  # potentials
    for i in range(m):
        while left[i]:
            far_rows, far_columns = np.full(m, np.inf), np.full(n, np.inf)
            via_row, via_column = np.full(m, -1), np.full(n, -1)
            open_rows, open_columns = np.ones(m, bool), np.ones(n, bool)
            far_rows[i] = 0
            while True:
                r = int(np.argmin(np.where(open_rows, far_rows, np.inf)))
                c = int(np.argmin(np.where(open_columns, far_columns, np.inf)))
                near_row = far_rows[r] if open_rows[r] else np.inf
                near_column = far_columns[c] if open_columns[c] else np.inf
                if min(near_row, near_column) == np.inf:
                    break
                if near_row <= near_column:
                    open_rows[r] = False
                    through = near_row + cost[r] + rows[r] - columns
                    better = open_columns & (through < far_columns)
                    far_columns[better], via_column[better] = through[better], r
                else:
                    open_columns[c] = False
                    for k in range(m):
                        back = near_column + columns[c] - rows[k] - cost[k, c]
                        if open_rows[k] and flow[k][c] and back < far_rows[k]:
                            far_rows[k], via_row[k] = back, c
            costs = np.where(np.array([x > 0 for x in room]), far_columns + columns, np.inf)
            end = int(np.argmin(costs))
            reached = far_columns[end]
            rows += np.minimum(far_rows, reached)
            columns += np.minimum(far_columns, reached)
            path, c = [], end
            while True:
                r = int(via_column[c])
                path.append((r, c, 1))
                if r == i:
                    break
                c = int(via_row[r])
                path.append((r, c, -1))
            step = min(left[i], room[end], *[flow[r][c] for r, c, sign in path if sign < 0])
            for r, c, sign in path:
                flow[r][c] += sign * step
            left[i] -= step
            room[end] -= step
    return np.array(flow, dtype=object).reshape(m, n)


@dataclass
class Cut:
    """End of a block: documents of ``old`` up to ``place`` that no earlier cut took go to ``new``."""
    old: int
    new: int
    at: int
    place: str = ""


def shard_sizes(rows: DataFrame, shard: str, count: int = 0) -> tuple[list[int], int]:
    """Bytes of every shard, and the largest size of a row."""
    found = {r[shard]: r for r in rows.groupBy(shard).agg(F.sum("size").alias("size"), F.max("size").alias("most")).collect()}
    count = max(count, max(found, default=-1) + 1)
    return [int(found[k]["size"]) if k in found else 0 for k in range(count)], max((r["most"] for r in found.values()), default=1)


def _within(rows: DataFrame, shard: str, place: str, depth: int, prefixes: set[tuple[int, str]]) -> DataFrame:
    """Rows of the given shards and prefixes, one per cut at most."""
    named = F.concat_ws(":", F.col(shard).cast("string"), F.substring(place, 1, depth))
    return rows.where(named.isin([f"{old}:{p}" for old, p in sorted(prefixes)]))


def find_cuts(rows: DataFrame, flow: np.ndarray, shard: str = "old_shard", place: str = "place") -> list[Cut]:
    """Last place of every block of the flow, by radix selection over sums per prefix."""
    cuts = []
    for i in range(len(flow)):
        total = 0
        for j in range(flow.shape[1]):
            if i != j and flow[i, j]:
                total += int(flow[i, j])
                cuts.append(Cut(i, j, total))
    open_ = [(cut, "", 0) for cut in cuts]  # cut, prefix it lies in, bytes before that prefix
    depth = DIGITS
    while open_:
        inside = _within(rows, shard, place, depth - DIGITS, {(cut.old, prefix) for cut, prefix, _ in open_})
        sums: dict[tuple[int, str], list] = {}
        for r in inside.groupBy(shard, F.substring(place, 1, depth).alias("p")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
            sums.setdefault((r[shard], r["p"][:depth - DIGITS]), []).append((r["p"], int(r["size"]), r["n"]))
        opened, small = [], []
        for cut, prefix, before in open_:
            for p, size, n in sorted(sums.get((cut.old, prefix), [])):
                if before + size > cut.at:
                    (small if n <= FEW else opened).append((cut, p, before))
                    break
                before += size
                cut.place = p + "~"  # sorts after every place with that prefix
        if small:
            few = _within(rows, shard, place, depth, {(cut.old, p) for cut, p, _ in small})
            held: dict[tuple[int, str], list] = {}
            for r in few.select(shard, place, "size").collect():  # FEW rows a cut at most
                held.setdefault((r[shard], r[place][:depth]), []).append((r[place], int(r["size"])))
            for cut, p, before in small:
                for at, size in sorted(held[(cut.old, p)]):
                    before += size
                    if before > cut.at:
                        break
                    cut.place = at
        open_, depth = opened, depth + DIGITS
    return cuts


def dealt(rows: DataFrame, cuts: list[Cut], shard: str, place: str, target: str) -> DataFrame:
    """``target``: the shard each row goes to. The cuts, one per edge of the flow, travel as one small array per old shard."""
    by_old: dict[int, list] = {}
    for cut in cuts:
        by_old.setdefault(cut.old, []).append((cut.at, cut.place, cut.new))
    lists = [(old, [(p, new) for _, p, new in sorted(edges)]) for old, edges in by_old.items()]
    ends = rows.sparkSession.createDataFrame(lists, "o int, ends array<struct<p:string,new:int>>")
    taken = F.filter("ends", lambda e: F.col(place) <= e["p"])
    moved = F.when(F.size(taken) > 0, F.get(taken, F.lit(0))["new"])
    joined = rows.join(F.broadcast(ends), F.col(shard) == F.col("o"), "left")
    return joined.withColumn(target, F.coalesce(moved, F.col(shard))).drop("o", "ends")


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def reshard(rows: DataFrame, capacity: list[int] | None, shards: int, cost: np.ndarray | None = None) -> DataFrame:
    """Rows (old_shard, place, size, ...) with ``shard``: the flow from the old sizes, then the small one that evens out the cuts.

    Without ``capacity`` the shards get equal shares. A shard beyond the new ones takes no second flow.
    """
    sizes, most = shard_sizes(rows, "old_shard")
    capacity = capacity or even(sum(sizes), shards)
    first = dealt(rows, find_cuts(rows, min_cost_flow(sizes, capacity, cost)), "old_shard", "place", "reached")
    if sum(capacity) != sum(sizes):
        return first.withColumnRenamed("reached", "shard")
    first = first.withColumn("by_size", F.concat(F.lpad(F.lower(F.hex("size")), len(f"{most:x}"), "0"), F.col("place")))
    flow = min_cost_flow(shard_sizes(first, "reached", shards)[0], capacity, None if cost is None else cost[:shards])
    return dealt(first, find_cuts(first, flow, "reached", "by_size"), "reached", "by_size", "shard").drop("reached", "by_size")


def placed(df: DataFrame, old_shard: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, old_shard and place (hash of the key, then row number) of every row, staged."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    number = F.col(f"`{key}`").cast("long")
    place = F.concat(F.md5(F.coalesce(number.cast("string"), F.lit("")).cast("binary")), F.lpad(F.lower(F.hex(F.monotonically_increasing_id())), 16, "0"))
    return staged(df.select(
        number.alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old_shard"), place.alias("place"),
    ), "resharding")


def numbered(rows: DataFrame) -> DataFrame:
    """``slot``: gapless numbers per shard in the order of ``place``.

    A window holds the rows of one shard whose place starts with the same ``SLOT_DIGITS`` digits; what comes before it is a running count over
    the few thousand windows of the shard.
    """
    bins = rows.withColumn("bin", F.substring("place", 1, SLOT_DIGITS))
    counts = bins.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("shard", "bin").orderBy("place"))
    return bins.withColumn("own", own).join(counts, ["shard", "bin"]).withColumn("slot", F.col("before") + F.col("own") - 1).drop("bin", "own", "before")


def source_shards(shards: int, source: str = "source") -> Column:
    """Old layout of whole sources: every source lies in one shard, so a hot one makes it much larger than the others."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).cast("binary")), F.lit(shards))


def reshard_documents(df: DataFrame, old_shards: int = 6, shards: int = 8) -> DataFrame:
    """Documents from ``old_shards`` shards of whole sources into ``shards`` of equal bytes."""
    rows = numbered(reshard(placed(df, source_shards(old_shards)), None, shards))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def write_layout(df: DataFrame, root: str, shard: Column) -> None:
    """Files ``root/files/first/shard=N/*`` and the manifest (file, shard) ``root/manifests/0`` that names the live ones."""
    spark = df.sparkSession
    df.withColumn("shard", shard.cast("int")).write.partitionBy("shard").parquet(f"{root}/files/first")
    _listed(spark, f"{root}/files/first").write.parquet(f"{root}/manifests/0")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("shard").cast("int").alias("shard")).distinct()


def read_layout(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Live rows with their ``shard``, ``file`` and ``row`` in it."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/files")
    rows = rows.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    return rows.join(spark.read.parquet(f"{root}/manifests/{version}"), "file")


def reshard_files(spark: SparkSession, root: str, version: int, shards: int, text: str = "text", capacity: list[int] | None = None) -> int:
    """Move blocks of the layout's version into ``shards`` shards, write only files that lose rows anew, return the new version.

    A job that dies before the manifest is written leaves the old version as it was; run again, it writes under a new name.
    """
    live = read_layout(spark, root, version)
    size = (F.octet_length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))) + 1).cast("long")
    place = F.concat(F.md5(F.col("file").cast("binary")), F.lpad(F.lower(F.hex("row")), 16, "0"))
    rows = staged(live.select("file", "row", size.alias("size"), F.col("shard").alias("old_shard"), place.alias("place")), "layout")
    sizes, _ = shard_sizes(rows, "old_shard")
    flow = min_cost_flow(sizes, capacity or even(sum(sizes), shards))
    moves = staged(dealt(rows, find_cuts(rows, flow), "old_shard", "place", "new_shard"), "moves")
    affected = moves.where("new_shard <> old_shard").select("file").distinct()
    fresh = live.join(affected, "file", "left_semi").join(moves.select("file", "row", "new_shard"), ["file", "row"])
    name = staged(affected, "affected").sparkSession.range(1).select(F.expr("uuid()")).first()[0]
    target = f"{root}/files/{name}"
    fresh.withColumn("shard", F.col("new_shard")).drop("file", "row", "new_shard").write.partitionBy("shard").parquet(target)
    kept = spark.read.parquet(f"{root}/manifests/{version}").join(affected, "file", "left_anti")
    changed = moves.where("new_shard <> old_shard").limit(1).count()
    manifest = kept.unionByName(_listed(spark, target)) if changed else kept
    manifest.write.parquet(f"{root}/manifests/{version + 1}")
    return version + 1
