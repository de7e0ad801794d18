import random
import time
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tagloom.llm import sharding


def test_flow_is_least_cost():
    # Two ways of unit cost 1 and 3; three units must go.
    arcs = [(0, 1, 2, 1), (0, 2, 2, 3), (1, 3, 2, 0), (2, 3, 2, 0)]
    assert sharding.min_cost_flow(4, arcs, 0, 3) == [2, 2, 2, 2]
    arcs = [(0, 1, 3, 0), (1, 2, 2, 1), (1, 2, 2, 3)]
    assert sharding.min_cost_flow(3, arcs, 0, 2) == [3, 2, 1]


def told(layout, new):
    """Counts, and the size in question of each over-full shard, of {shard: row sizes}."""
    counts = {s: len(x) for s, x in layout.items() if x}
    each = sum(counts.values()) // new
    return counts, {s: sorted(x)[len(x) - each - 1] for s, x in layout.items() if s < new and len(x) > each}


def least(layout, new):
    """The fewest bytes by trying all ways to choose the shards that hold one row more."""
    each, spare = divmod(sum(map(len, layout.values())), new)
    best = None
    for more in combinations(range(new), spare):
        cost = 0
        for s, rows in layout.items():
            stay = min(len(rows), each + (s in more)) if s < new else 0
            cost += sum(sorted(rows)[: len(rows) - stay])
        best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("classes", [2, 3, 64])
def test_the_fewest_bytes_move(monkeypatch, classes):
    """Rows of different sizes, ties among them, more and fewer shards than before."""
    monkeypatch.setattr(sharding, "CLASSES", classes)
    random.seed(5)
    for _ in range(150):
        old, new = random.randint(1, 7), random.randint(1, 7)
        sizes = random.choice([[64, 127], [64, 65, 90, 127], range(8, 5000)])
        layout = {s: [random.choice(sizes) for _ in range(random.randint(0, 9))] for s in range(old)}
        moves = sharding.plan_moves(*told(layout, new), new)
        held, moved = Counter(), 0
        for s, (stay, runs) in moves.items():
            assert stay == 0 or s < new
            rows = sorted(layout[s])
            moved += sum(rows[: len(rows) - stay])
            held[s] += stay
            assert sum(hi - lo for lo, hi, *_ in runs) == len(rows) - stay
            for lo, hi, shard, _ in runs:
                held[shard] += hi - lo
        counts = [held[s] for s in range(new)]
        assert sum(held.values()) == sum(counts) == sum(map(len, layout.values()))
        assert max(counts) - min(counts) <= 1
        assert moved == least(layout, new)


def test_ten_thousand_shards_in_seconds():
    random.seed(6)
    counts = {s: random.randint(9_000, 11_000) for s in range(10_000)}
    each = sum(counts.values()) // 9_500
    question = {s: random.randint(8, 100_000) for s, n in counts.items() if s < 9_500 and n > each}
    started = time.time()
    moves = sharding.plan_moves(counts, question, 9_500)
    assert time.time() - started < 10
    assert sum(len(runs) for _, runs in moves.values()) < 2 * 10_000


def check(got, rows, new=sharding.NEW_SHARDS):
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < new and r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(new)]
    assert max(counts) - min(counts) <= 1


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(sharding.reshard(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd, empty):
    check(sharding.reshard(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert sharding.reshard(empty).count() == 0


def test_bytes_of_rows(spark):
    """The case of two sizes in one class: the small ones leave."""
    rows = [(i, "x" * (n - 8), i // 4) for i, n in enumerate([64, 64, 127, 127, 64, 64, 127, 127])]
    rows = [(i, t, 0) for i, t, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, at int")
    got = sharding.reshard(df, old_shard=F.col("at"), old_shards=1, new_shards=2).collect()
    assert sum(r.size for r in got if r.moved) == 4 * 64 and sum(r.moved for r in got) == 4


def layout_of(spark, path):
    return sorted((r.shard, r.slot, r.doc_id, r.text) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("old, new", [(3, 4), (4, 2), (5, 5), (2, 7)])
def test_rewrite_in_place(spark, sf, tmp_path, old, new):
    """Shards grow and shrink in the folder that is read; every row is there once."""
    path = str(tmp_path / "shards")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    first = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(old)).cast("int")).withColumn("slot", F.lit(0))
    first.write.partitionBy("shard").parquet(path)
    now = spark.read.parquet(path)
    plan = sharding.reshard(now, old_shard=F.col("shard"), old_shards=old, new_shards=new).cache()
    want = {r.doc_id: (r.shard, r.slot) for r in plan.collect()}
    numbers = sharding.rewrite_affected(now, plan, path)
    spark.catalog.refreshByPath(path)
    back = layout_of(spark, path)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r[2] for r in back) == sorted(texts) and all(texts[r[2]] == r[3] for r in back)
    assert {r[0] for r in back} == set(range(new))
    for shard, slot, doc, _ in back:
        assert want[doc][0] == shard and (shard not in numbers or want[doc][1] == slot)


def test_a_rewrite_goes_on_after_a_crash(spark, sf, tmp_path, monkeypatch):
    """Stopped while shards are put in place, and called again."""
    path = str(tmp_path / "shards")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs.withColumn("shard", F.pmod("doc_id", F.lit(4)).cast("int")).withColumn("slot", F.lit(0)).write.partitionBy("shard").parquet(path)
    now = spark.read.parquet(path)
    plan = sharding.reshard(now, old_shard=F.col("shard"), old_shards=4, new_shards=2).cache()
    finish, calls = sharding.finish_rewrite, []

    def stops(spark, at):
        calls.append(at)
        if len(calls) == 2:  # the note is written, some shards are put in place
            import json
            from pathlib import Path

            note = json.loads((Path(path) / "_rewrite.json").read_text())
            done = sharding._fs(spark, f"{path}/shard=0")[1]
            fs, new = sharding._fs(spark, f"{note['new']}/shard=0")
            fs.delete(done, True)
            fs.rename(new, done)
            raise RuntimeError("lost")
        return finish(spark, at)

    monkeypatch.setattr(sharding, "finish_rewrite", stops)
    with pytest.raises(RuntimeError, match="lost"):
        sharding.rewrite_affected(now, plan, path)
    finish(spark, path)
    spark.catalog.refreshByPath(path)
    back = layout_of(spark, path)
    assert sorted(r[2] for r in back) == sorted(r.doc_id for r in docs.collect()) and {r[0] for r in back} == {0, 1}
    finish(spark, path)  # nothing is left to do


def test_rewrite(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    # Three old shards of equal size and one empty one: only some rows move.
    old = F.pmod("doc_id", F.lit(3))
    plan = sharding.reshard(docs, old_shard=old, old_shards=3, new_shards=4).cache()
    numbers = sharding.rewrite_affected(docs, plan, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in plan.collect() if r.shard in numbers)
    assert plan.filter("moved").count() == docs.count() // 4


def test_the_flow_takes_all_rows_by_size_class(spark, sf, monkeypatch):
    """Every row flows from its block (old shard and size class) to a new shard, and
    the rows that leave are those that the flow sends through the hub."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    flow_of, nets = sharding.min_cost_flow, []

    def seen(n_nodes, arcs, source, sink):
        nets.append((arcs, source, sink, flow_of(n_nodes, arcs, source, sink)))
        return nets[-1][3]

    monkeypatch.setattr(sharding, "min_cost_flow", seen)
    got = sharding.reshard(docs, old_shard=F.pmod("doc_id", F.lit(5)), old_shards=5, new_shards=7).collect()
    arcs, source, sink, flow = nets[-1]
    blocks = [a for a in arcs if a[0] == source]
    assert sum(a[2] for a in blocks) == len(got) == sum(f for a, f in zip(arcs, flow) if a[0] == source)
    assert len(blocks) >= len({(r.old_shard, r.size.bit_length()) for r in got})
    hub = source + 1
    assert sum(f for a, f in zip(arcs, flow) if a[1] == hub) == sum(r.moved for r in got)
    into = Counter(r.shard for r in got if r.moved)
    assert sorted(f for a, f in zip(arcs, flow) if a[0] == hub and f) == sorted(into.values())


def test_more_shards_than_one_network_tells_apart():
    """More shards than one network tells apart, all rows in question of one size."""
    layout = {s: [64] * 12 for s in range(300)}
    counts, question = told(layout, 310)
    moves = sharding.plan_moves(counts, question, 310)
    each, spare = divmod(300 * 12, 310)
    held = Counter({s: stay for s, (stay, _) in moves.items()})
    for _, runs in moves.values():
        for lo, hi, shard, _ in runs:
            held[shard] += hi - lo
    assert Counter(held.values()) == {each + 1: spare, each: 310 - spare}
    assert sum(12 - stay for stay, _ in moves.values()) == 300 * (12 - each) - spare
