"""Benchmark of the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints
one JSON line: ``{"metric", "value", "unit", "queries": {name: sec}, "sf", ...}``. Every timed
query is written in full to the ``noop`` sink. The tables are first laid out in as many files
as there are cores, as a data set of many files would be, since one Parquet row group is read
by one task. The word model is trained once, by ``train_words``, whose time is the training;
the encode, decode and report queries then time the operator and not the training again.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from subword_spark.operators.metrics import throughput  # noqa: E402
from subword_spark.operators.train import train  # noqa: E402
from subword_spark.plans import catalog as C  # noqa: E402
from subword_spark.session import local_session, remove_path, scratch_path  # noqa: E402

HEADLINE = [
    "train_words",
    "train_lines",
    "train_bytes",
    "train_target_size",
    "pair_counts_chars",
    "pair_counts_bytes",
    "encode_docs",
    "encode_rank",
    "decode_docs",
    "roundtrip_words",
    "stats_report",
    "token_id_lookup",
    "vocab_coverage",
]
TABLES = ("documents", "conversations", "benchmark")


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def train_once() -> None:
    """Let the catalog's queries share one model per set of options."""
    models, fresh = {}, C.word_model

    def model(spark, sf, opts=C.WORD):
        if opts not in models:
            models[opts] = fresh(spark, sf, opts)
        return models[opts]

    C.word_model = model


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="subword-bench")
    laid_out = scratch_path(spark, "bench-tables")
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(int(cpus) if cpus.isdigit() else 8).write.parquet(f"{laid_out}/{t}.parquet")
    # Warm-up (not timed): start the Python workers and warm the JVM once.
    run_noop(C.QUERIES["char_symbols"](spark, laid_out))
    train_once()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run_noop(C.QUERIES[name](spark, laid_out))
        times[name] = round(time.perf_counter() - t0, 3)

    # Throughput of encode and decode alone: one warm-up, then three trials, each a full job.
    docs, lines = C.documents(spark, laid_out), C.conv_lines(spark, laid_out).withColumnRenamed("line", "text")
    models = {"word": (docs, C.word_model(spark, laid_out)), "line": (lines, train(lines, "text", C.LINE)), "byte": (lines, train(lines, "text", C.BYTE))}
    speeds: dict[str, float] = {}
    for unit, (df, model) in models.items():
        rows = throughput(df, "text", model, trials=3, warmup=1).collect()
        for kind in ("encode", "decode"):
            mine = [r for r in rows if r.kind == kind]
            speeds[f"{kind}_{unit}_tokens_per_sec"] = round(sum(r.n_tokens for r in mine) / sum(r.seconds for r in mine), 1)
    remove_path(spark, laid_out)

    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        **speeds,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
