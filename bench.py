"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from wattgrade.operators import models
from wattgrade.operators.sampling import hashed_split
from wattgrade.plans.catalog import QUERIES
from wattgrade.plans.mapping import ROLES
from wattgrade.plans.model_queries import NUMERICS, TARGET, prepared_rows
from wattgrade.session import build_session, staged

HEADLINE = (
    "class_stats",
    "clean_v1",
    "clean_v2",
    "clean_report",
    "dedupe_key",
    "distinct_rows",
    "commune_left_join",
    "top10_communes",
    "gain_matrix",
    "gain_ladder",
    "profile_all",
    "corr_matrix",
    "kde_by_grade",
    "scenario_savings_v1",
    "scenario_summary",
    "model_metrics",
    "hash_split",
    "sample_800",
    "roundtrip_partitioned",
    "roundtrip_ndjson",
    "stream_silver",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="run-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    def train_small() -> float:
        """Both models at ten trees of depth five, fitted, scored and measured."""
        started = time.perf_counter()
        train, test = hashed_split(staged(prepared_rows(spark, sf_dir), "bench-rows"), ROLES.key)
        fitted = models.train(train, TARGET, ROLES.categoricals, NUMERICS, size=models.TreeSize(trees=10, depth=5))
        for kind in (models.FOREST, models.BOOSTED):
            scored = models.score(fitted.whole(kind), test)
            models.metrics_by_model(scored, TARGET, {kind: "prediction"}).collect()
        return time.perf_counter() - started

    run("class_stats")  # class loading and code generation, not part of any figure
    times = {name: round(run(name), 3) for name in HEADLINE}
    times["train_10x5"] = round(train_small(), 3)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
