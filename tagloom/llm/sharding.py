"""Minimum-cost-flow resharding.

Rows lie in old shards and are to lie in new ones whose row counts are at most
one apart. An old shard numbered below the new number of shards goes on as the
new shard of that number. The rows of each old shard fall into blocks by size
class, cut also at the row that stays only if its shard keeps one row more than
the others. A flow of all rows from the blocks to the new shards, staying free,
moving at a row's bytes through a hub, gives how many rows each old shard gives
up, the smallest first, how many each new shard takes, and which new shards hold
one row more; its paths through the hub are the transfers. Of more than CLASSES
shards of a kind, shards alike share their blocks; shards that share a block
which the flow splits are cut finer and the flow is solved again, so the network
stays small for any number of shards and the result is the least by rows. The
driver works on a histogram, its rows bounded by old shards times size classes;
all work on rows is DataFrame code.
"""

from __future__ import annotations

import heapq
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.store import fresh, partitions, removed, stored

OLD_SHARDS, NEW_SHARDS = 20, 24
#: Shards of a kind that a network tells apart, two at least.
CLASSES = 64


def min_cost_flow(n_nodes: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost) of a maximum flow of least
    cost, by successive shortest paths with potentials. Costs are >= 0."""
    to, cap, cost, out = [], [], [], [[] for _ in range(n_nodes)]
    for u, v, c, w in arcs:
        out[u].append(len(to))
        out[v].append(len(to) + 1)
        to += [v, u]
        cap += [c, 0]
        cost += [w, -w]
    height = [0] * n_nodes
    while True:
        best, via = {source: 0}, {}
        heap = [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > best[u]:
                continue
            if u == sink:
                break
            for e in out[u]:
                if cap[e] and (reach := d + cost[e] + height[u] - height[to[e]]) < best.get(to[e], 1 << 200):
                    best[to[e]], via[to[e]] = reach, e
                    heapq.heappush(heap, (reach, to[e]))
        if sink not in best:
            return cap[1::2]
        far = best[sink]
        height = [h + min(best.get(u, far), far) for u, h in enumerate(height)]
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = to[via[v] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push


#: Of a shard with more rows than the common count: the rows that leave in any
#: case, the one in question, those that stay; rows of other shards are BASE.
FORCED, ASKED, BASE = 0, 1, 2


def _parts(shards: list[int]) -> list[list[int]]:
    """CLASSES parts of equal length at most, in order."""
    step = max(1, -(-len(shards) // CLASSES))
    return [shards[i : i + step] for i in range(0, len(shards), step)]


def _solved(groups: list[tuple[list[int], dict]], n_new: int, each: int, spare: int) -> list[tuple[int, int, int]]:
    """For each group (shards, blocks) the rows that leave it, those that come and
    how many of its shards hold one row more. The first ``n_new`` groups go on as
    new shards, the others end. ``blocks``: (rows, bytes of a row) by zone and class."""
    blocks = [(g, rows, cost) for g, (_, own) in enumerate(groups) for _, (rows, cost) in sorted(own.items())]
    into = range(len(blocks), len(blocks) + n_new)
    source, hub, extra, sink = range(len(blocks) + n_new, len(blocks) + n_new + 4)
    arcs, leave, come, more = [(extra, sink, spare, 0)], [], [], []
    for i, (g, rows, cost) in enumerate(blocks):
        arcs.append((source, i, rows, 0))
        if g < n_new:
            arcs.append((i, into[g], rows, 0))
        leave.append(len(arcs))
        arcs.append((i, hub, rows, cost))
    for g in range(n_new):
        size = len(groups[g][0])
        arcs.append((into[g], sink, each * size, 0))
        come.append(len(arcs))
        arcs.append((hub, into[g], (each + 1) * size, 0))
        more.append(len(arcs))
        arcs.append((into[g], extra, size, 0))
    flow = min_cost_flow(sink + 1, arcs, source, sink)
    gone = [0] * len(groups)
    for (g, *_), at in zip(blocks, leave, strict=True):
        gone[g] += flow[at]
    return [(gone[g], *((flow[come[g]], flow[more[g]]) if g < n_new else (0, 0))) for g in range(len(groups))]


def _shared(shards: list[int], blocks: dict[int, dict]) -> tuple[list[int], dict]:
    """A group of shards with its blocks. Several shards share one block a zone, at
    its least cost: no flow of least cost takes a part of a zone from such a group
    but of the rows in question, and then the group is cut finer."""
    if len(shards) == 1:
        return shards, blocks[shards[0]]
    out: dict = {}
    for s in shards:
        for (zone, _), (rows, cost) in blocks[s].items():
            have = out.get((zone, 0), (0, cost))
            out[zone, 0] = (have[0] + rows, min(have[1], cost))
    if (FORCED, 0) in out:  # they leave before any row in question of the group does
        rows, cost = out[FORCED, 0]
        out[FORCED, 0] = (rows, min(cost, out[ASKED, 0][1]))
    return shards, out


def solve_flow(
    blocks: dict[int, dict], over: list[int], under: list[int], ends: list[int], each: int, spare: int
) -> tuple[dict[int, int], dict[int, int]]:
    """Of the flow that moves the fewest bytes: the rows of each old shard that stay,
    and the rows of each new shard in the end.

    ``over``, ``under``: old shards that go on, with more rows than ``each`` and
    with others; ``ends``: old shards that end. Shards that share blocks of which
    the flow takes some are cut finer, until it treats all of a group alike."""
    asked = {s: min(c for (zone, _), (_, c) in blocks[s].items() if zone == ASKED) for s in over}
    order = sorted(over, key=lambda s: (asked[s], s))
    # Costs with the place in that order behind the bytes: no two rows in question tie.
    scale = len(order) + 1
    costs = {s: {k: (rows, cost * scale) for k, (rows, cost) in own.items()} for s, own in blocks.items()}
    for place, s in enumerate(order):
        costs[s] |= {k: (rows, cost + place) for k, (rows, cost) in costs[s].items() if k[0] != FORCED}
    lo, hi = 0, len(order)
    while True:
        tried = [p for p in (order[:lo], *_parts(order[lo:hi]), order[hi:]) if p]
        groups = [_shared(p, costs) for p in (*tried, *_parts(under), *_parts(ends))]
        n_new = len(groups) - len(_parts(ends))
        told = _solved(groups, n_new, each, spare)
        split = [p for p, (_, _, more) in zip(tried, told, strict=False) if 0 < more < len(p)]
        if not split:
            break
        lo, hi = order.index(split[0][0]), order.index(split[0][-1]) + 1
    stay, room = {}, {}
    for g, ((p, _), (gone, _, more)) in enumerate(zip(groups, told, strict=True)):
        for i, s in enumerate(p):
            rows = sum(n for n, _ in blocks[s].values())
            if g < n_new:
                room[s] = each + (i < more)
            stay[s] = rows - gone if len(p) == 1 else min(rows, room.get(s, 0))
    return stay, room


def plan_moves(
    counts: dict[int, int], question: dict[int, int], new_shards: int, blocks: dict[int, dict] | None = None
) -> dict[int, tuple[int, list]]:
    """For each old shard how many rows stay, and runs (lo, hi, shard, base): the
    leaving rows numbered ``lo`` to ``hi`` - 1 go to ``shard`` from slot ``base`` on.

    ``counts``: rows of each old shard; ``question``: for each one with more rows
    than the common count, and a number below ``new_shards``, the bytes of the
    last row that leaves if it keeps no more than that count; ``blocks``: for each
    old shard its histogram, (rows, bytes of the smallest) by (zone, size class),
    by default one class a zone."""
    each, spare = divmod(sum(counts.values()), new_shards)
    n = [counts.get(s, 0) for s in range(new_shards)]
    over = [s for s in range(new_shards) if n[s] > each]
    under = [s for s in range(new_shards) if n[s] <= each]
    ends = [s for s in counts if s >= new_shards]
    if blocks is None:
        blocks = {s: {(BASE, 0): (c, 1)} for s, c in counts.items()}
        for s in over:
            q = question[s]
            blocks[s] = {(FORCED, 0): (n[s] - each - 1, q), (ASKED, 0): (1, q), (BASE, 0): (each, q)}
    stay, room = solve_flow({s: blocks.get(s, {}) for s in (*over, *under, *ends)}, over, under, ends, each, spare)
    # The flow's paths through the hub: what leaves the old shards meets what the new ones take, in order.
    wanted = [(s, room[s] - stay[s]) for s in range(new_shards) if room[s] > stay[s]]
    out, at, used = {}, 0, 0
    for old in sorted(counts):
        left = counts[old] - stay[old]
        runs, lo = [], 0
        while lo < left:
            shard, size = wanted[at]
            take = min(left - lo, size - used)
            runs.append((lo, lo + take, shard, stay[shard] + used))
            lo, used = lo + take, used + take
            if used == size:
                at, used = at + 1, 0
        out[old] = (counts[old] - left, runs)
    return out


def reshard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    old_shard=None,
    old_shards: int = OLD_SHARDS,
    new_shards: int = NEW_SHARDS,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``size`` (UTF-8 bytes of the text, null
    none, plus 8), ``text_crc32``, ``law`` ('rows'), ``shard``, ``slot`` (gapless
    from 0 in each shard), ``grown_shard`` (null), ``old_shard``, ``moved``.

    ``old_shard`` is the column with each row's present shard, from 0 to
    ``old_shards`` - 1; by default crc32 of the id modulo ``old_shards``. Rows
    repeated, and ties of any kind, are rows of their own. A null id counts as
    the empty string. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    if old_shard is None:
        old_shard = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % old_shards
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(data).cast("long") + 8).alias("size"),
            F.crc32(data).alias("crc"),
            old_shard.cast("int").alias("old"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "rows",
    )
    # Ranks by size inside a shard: rows are dealt to ranges of (shard, size), each
    # counted by itself and carried on by what lies before it. The ranges are stored
    # before they are read twice, as their ends come from a sample.
    ranged = rows.repartitionByRange(partitions(rows), "old", "size", "rid").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranged")
    removed(rows)
    sums = stored(ranged.groupBy("old", "part").agg(F.count(F.lit(1)).alias("n")), "sums")
    counts = {r.old: r.n for r in sums.groupBy("old").agg(F.sum("n").alias("n")).collect()}  # one row a shard
    before = Window.partitionBy("old").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("old", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("old", "part").orderBy("size", "rid")
    ranked = ranged.withColumn("in_part", F.row_number().over(inside) - 1).join(offsets, ["old", "part"])
    ranked = ranked.withColumn("rank", F.col("in_part") + F.col("offset"))
    each = sum(counts.values()) // new_shards
    # The histogram of the flow: rows and least size by old shard, zone and size class.
    zones = spark.createDataFrame([(s, n - each - 1 if s < new_shards and n > each else -1) for s, n in counts.items()], "old int, asked long")
    rank, asked = F.col("rank"), F.col("asked")
    zone = F.when(rank < asked, FORCED).when(rank == asked, ASKED).otherwise(BASE)
    size_class = F.length(F.bin("size"))
    blocks: dict[int, dict] = {}
    told = ranked.join(F.broadcast(zones), "old").groupBy("old", zone.alias("zone"), size_class.alias("class"))
    for r in told.agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least")).collect():
        blocks.setdefault(r["old"], {})[r["zone"], r["class"]] = (r["n"], r["least"])
    question = {s: least for s, own in blocks.items() for (z, _), (_, least) in own.items() if z == ASKED}
    moves = plan_moves(counts, question, new_shards, blocks)
    schema = "old int, leave long, runs array<struct<lo:long,hi:long,shard:int,base:long>>"
    plan = spark.createDataFrame([(s, counts[s] - stay, runs) for s, (stay, runs) in moves.items()], schema)  # one row a shard
    placed = ranked.join(F.broadcast(plan), "old")
    leaves = F.col("rank") < F.col("leave")
    run = F.filter("runs", lambda r: (r["lo"] <= F.col("rank")) & (F.col("rank") < r["hi"]))
    placed = placed.withColumn("run", F.get(run, F.lit(0)))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.when(leaves, F.col("run.shard")).otherwise(F.col("old")).alias("shard"),
        F.when(leaves, F.col("run.base") + F.col("rank") - F.col("run.lo")).otherwise(F.col("rank") - F.col("leave")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("old").alias("old_shard"),
        leaves.alias("moved"),
    )


def rewrite_affected(docs: DataFrame, plan: DataFrame, path: str, id_col: str = "doc_id") -> list[int]:
    """Write the shards that gain or lose rows under ``plan`` (from ``reshard``) as
    ``path/shard=N`` and return their numbers. Shards that the plan leaves alone
    are not rewritten; a shard that ends is deleted. ``path`` may be where ``docs``
    is read from: the new shards are complete beside it before the first old one
    goes, and a note of what is to be put in place lets ``finish_rewrite`` go on
    after a crash. Ids must be unique and not null; columns of ``docs`` named
    shard or slot are replaced."""
    spark = docs.sparkSession
    finish_rewrite(spark, path)
    touched = plan.filter("moved").select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    numbers = sorted(r.s for r in touched.collect())  # at most old + new shard numbers
    own = fresh(docs, "_id")
    inside = plan.filter(F.col("shard").isin(numbers)).select(F.col("doc_id").alias(own), "shard", "slot")
    rows = docs.drop("shard", "slot").join(inside, F.col(id_col) == F.col(own)).drop(own)
    ready = f"{path.rstrip('/')}/_new-{uuid.uuid4().hex}"
    ranged = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(ready)
    made = {s.getPath().getName() for s in _fs(spark, ready)[0].listStatus(_fs(spark, ready)[1])}
    ends = [s for s in numbers if f"shard={s}" not in made]
    fs, at = _fs(spark, f"{path}/_rewrite.tmp")
    stream = fs.create(at, True)
    stream.write(bytearray(json.dumps({"new": ready, "shards": numbers, "ends": ends}).encode()))
    stream.close()
    if not fs.rename(at, _fs(spark, f"{path}/_rewrite.json")[1]):
        raise RuntimeError(f"another rewrite of {path} is under way")
    finish_rewrite(spark, path)
    return numbers


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def finish_rewrite(spark: SparkSession, path: str) -> None:
    """Put the shards of a rewrite in place that is noted at ``path``. May be begun
    again at any point: a shard whose new folder is gone has its new rows already."""
    fs, note = _fs(spark, f"{path.rstrip('/')}/_rewrite.json")
    if not fs.exists(note):
        return
    stream = fs.open(note)
    told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    for shard in told["shards"]:
        old, new = (_fs(spark, f"{x.rstrip('/')}/shard={shard}")[1] for x in (path, told["new"]))
        if shard in told["ends"]:
            fs.delete(old, True)
        elif fs.exists(new):
            fs.delete(old, True)
            if not fs.rename(new, old):
                raise RuntimeError(f"shard {shard} of {path} could not be put in place")
    fs.delete(_fs(spark, told["new"])[1], True)
    fs.delete(note, False)
