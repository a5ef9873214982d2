"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Sizes follow the published baseline where it names one: the exact join on 1,884
and 4,711 documents, the sweep on 2,000 documents with its truth computed
beforehand, the estimator on 5,000 documents and 10,000 pairs. The banding
queries take the whole corpus. Every query first runs on 200 documents, so that
the timed run finds compiled code and running Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession

from nearfold.operators import (
    exact_pairs,
    lsh_candidates,
    minhash_signatures,
    sample_pairs,
    shingle_sets,
)
from nearfold.params import Params
from nearfold.plans import (
    NearDuplicates,
    clean,
    corpus_audit,
    estimator_error,
    near_duplicates,
    param_sweep,
)
from nearfold.sources import corpus_prefix, load_corpus, spread, stage


def materialise(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def run_all(docs: DataFrame, params: Params) -> dict[str, float]:
    """Seconds per query. Set-up shared by the signature queries is not timed."""

    def prefix(n: int) -> DataFrame:
        return clean(corpus_prefix(docs, n))

    def exact(n: int) -> DataFrame:
        return exact_pairs(shingle_sets(prefix(n), params.k), params.threshold)

    def estimator() -> DataFrame:
        some = prefix(5000)
        return estimator_error(some, sample_pairs(some, 10_000, params.seed), k=params.k)

    packed = stage(shingle_sets(prefix(2000), params.k), "bench-sets")
    signatures = stage(minhash_signatures(packed, params.num_hashes, params.seed), "bench-sigs")
    truth = stage(exact_pairs(packed, params.threshold), "bench-truth")

    work: dict[str, Callable[[], object]] = {
        "lsh_candidate_count": lambda: NearDuplicates(docs, params).num_candidates(),
        "near_duplicates": lambda: materialise(near_duplicates(docs, params)),
        "corpus_audit": lambda: [materialise(df) for df in corpus_audit(docs, params)[:2]],
        "lsh_from_signatures_2000": lambda: materialise(
            lsh_candidates(signatures, params.bands, params.rows)
        ),
        "param_sweep_2000": lambda: materialise(param_sweep(signatures, truth)),
        "estimator_error_5000": lambda: materialise(estimator()),
        "exact_pairs_1884": lambda: materialise(exact(1884)),
        "exact_pairs_4711": lambda: materialise(exact(4711)),
        "exact_pairs_all": lambda: materialise(exact_pairs(shingle_sets(clean(docs), params.k), 0.8)),
    }
    seconds = {}
    for name, run in work.items():
        begun = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - begun, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("nearfold-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    params = Params()
    corpus = spread(load_corpus(spark, f"{sf_dir}/documents.parquet"))
    total = corpus.count()
    run_all(corpus_prefix(corpus, 200), params)
    seconds = run_all(corpus, params)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
                "docs": total,
                "lsh_docs_per_sec": round(total / seconds["lsh_candidate_count"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
