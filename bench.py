"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the warm runs of
which the median counts. Results are written to Spark's ``noop`` sink, so all rows are
computed and none is kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from citemill.plans.queries import QUERIES  # noqa: E402
from citemill.session import get_spark  # noqa: E402
from citemill.sources import tables  # noqa: E402

HEADLINE = [
    "chunk_fixed",
    "chunk_sentences",
    "sentence_split",
    "hash_embedding",
    "strip_markup",
    "quality_checks",
    "chunks_per_document",
    "upsert_latest",
    "chunk_lineage",
    "reingest_stats",
    "topk_cosine",
    "search_chunks",
    "rag_prompt",
    "query_metrics",
    "stream_query_metrics_daily",
]


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        **{tables.SCAN_PARTITIONS.replace(".", "__"): cpus},
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(runs)), 3)

    def rows(table: str) -> int:
        return spark.read.parquet(f"{folder}/{table}.parquet").count()

    rates = {}
    if "chunk_fixed" in seconds:
        rates["documents_per_sec_chunk_fixed"] = rows("documents") / seconds["chunk_fixed"]
    if "chunk_sentences" in seconds:
        rates["documents_per_sec_chunk_sentences"] = rows("documents") / seconds["chunk_sentences"]
    if "search_chunks" in seconds:
        chunks = QUERIES["chunk_fixed"](spark, folder).count()
        pairs = rows("benchmark") * chunks
        rates["chunks_per_sec_embedded_and_searched"] = chunks / seconds["search_chunks"]
        rates["pairs_per_sec_exact_search"] = pairs / seconds["search_chunks"]
        rates["ms_per_question"] = 1000 * seconds["search_chunks"] / rows("benchmark")
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "rates": {name: round(rate, 1) for name, rate in rates.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
