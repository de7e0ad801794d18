"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Measured (each forced to completion with a no-op write, after a warm-up):
  tag_counts             (a) tag histogram over all tracks
  label_substring        positive (tag, track) pairs, substring labels
  examples               rebalanced + split examples for every popular tag
  train_batch_all        batched SGD (100 iterations) for every popular tag
  train_batch_k          the same for k tags in one batch          (b)
  score_all              (c) every track against every tag, ranked
  auc_by_tag_margin      hold-out AUROC/AUPRC of every tag
  model_summary          summary table joined to tag counts

Reported apart under "comparison" (not in the total): train_single_k, the same
k tags trained one run after another -- the per-tag loop of the original jobs,
run on this engine as the other side of comparison (b).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "4"))
K_TAGS = int(os.environ.get("BENCH_K_TAGS", "3"))
ITERATIONS = int(os.environ.get("BENCH_ITERATIONS", "100"))


def _sf_label(path: str) -> str:
    name = Path(path.rstrip("/")).name
    return name[2:] if name.startswith("sf") else name


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tagloom-bench")
        .config("spark.sql.shuffle.partitions", str(max(2 * CPUS, 4)))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "6g"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from tagloom.config import clear_scratch
    from tagloom.operators import metrics as M
    from tagloom.operators import score as SC
    from tagloom.operators import train as TR
    from tagloom.plans import catalog as C
    from tagloom.plans import stages as G

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    # warm-up on the smallest data (JVM, codegen, Python workers)
    run(C.QUERIES["tag_counts"](spark, "/root/testdata/sf0.001"))

    timed("tag_counts", lambda: run(C.QUERIES["tag_counts"](spark, SF_DIR)))
    timed("label_substring", lambda: run(C.QUERIES["label_substring"](spark, SF_DIR)))

    # examples once, stored in the shared folder and reused by the queries below
    t0 = time.time()
    examples = G.examples(spark, SF_DIR)
    times["examples"] = round(time.time() - t0, 3)

    def train_all():
        TR.train_linear_all_tags(examples, G.FEATS, iterations=ITERATIONS).collect()

    timed("train_batch_all", train_all)

    popular = [r["tag"] for r in G.popular(spark, SF_DIR).orderBy(F.desc("n"), "tag").collect()]
    k_tags = popular[:K_TAGS]

    def train_batch_k():
        TR.train_linear_all_tags(examples.filter(F.col("tag").isin(k_tags)), G.FEATS, iterations=ITERATIONS).collect()

    def train_single_k():
        for t in k_tags:
            TR.train_linear_all_tags(examples.filter(F.col("tag") == t), G.FEATS, iterations=ITERATIONS).collect()

    timed("train_batch_k", train_batch_k)
    t0 = time.time()
    train_single_k()
    single_k = round(time.time() - t0, 3)

    weights = SC.class_mean_weights(examples.filter(F.col("split") == "train"), G.FEATS)
    timed("score_all", lambda: run(SC.score_all_tags(G.scaled(spark, SF_DIR), weights, G.FEATS)))

    def auc_margin():
        test = examples.filter(F.col("split") == "test")
        pred = SC.with_margin(test, weights, G.FEATS).withColumn("score", F.col("margin"))
        run(M.curve_areas(pred))

    timed("auc_by_tag_margin", auc_margin)
    timed("model_summary", lambda: run(C.QUERIES["model_summary"](spark, SF_DIR)))
    timed("class_balance", lambda: run(C.QUERIES["class_balance"](spark, SF_DIR)))
    timed("rank_tags_per_track", lambda: run(C.QUERIES["rank_tags_per_track"](spark, SF_DIR)))

    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf_label(SF_DIR),
        "cpus": CPUS,
        "k_tags": len(k_tags),
        "n_popular_tags": len(popular),
        "iterations": ITERATIONS,
        "comparison": {
            "train_single_k": single_k,
            "batch_vs_single_k": round(single_k / max(times["train_batch_k"], 1e-9), 2),
        },
    }
    print(json.dumps(out))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
