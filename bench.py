"""Time the headline queries on one machine and print one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pagequill as pq  # noqa: E402
from checks import queries as q  # noqa: E402
from pagequill.operators import words as wd  # noqa: E402
from pagequill.sources.scratch import scratch_path  # noqa: E402


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pagequill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    docs = q.documents(spark, sf)
    path = scratch_path(spark, "bench-index")
    dump = q.written_dump(q.dump_rows(spark, sf), "bench-dump")

    pages_path = scratch_path(spark, "bench-dump-index")
    texts = docs.where("content IS NOT NULL").limit(1000)
    words = F.concat_ws(" ", F.lit("10"), F.slice(F.split("content", " "), 5, 4))
    requests = texts.select(F.col("id").alias("request_id"), words.alias("msg"))

    def indexed() -> pq.Index:
        return pq.load_index(spark, path)

    def dump_results() -> DataFrame:
        found = pq.search_batch(q.requests(spark, sf), pq.load_index(spark, pages_path))
        return pq.result_list(found, pq.load_pages(spark, pages_path))

    steps = {
        "warm_up": lambda: run(pq.word_count(docs)),
        "word_count": lambda: run(pq.word_count(docs)),
        "page_word_count": lambda: run(pq.page_word_count(docs)),
        "page_max_word_count": lambda: run(pq.page_max_word_count(docs)),
        "inverted_index": lambda: run(pq.inverted_index(docs)),
        "load_dump": lambda: run(pq.page_fields(pq.load_dump(spark, dump))),
        "load_dump_offsets": lambda: run(pq.page_fields(pq.load_dump_offsets(spark, dump))),
        "visible_lines": lambda: run(pq.visible_lines(q.markup_pages(spark, sf))),
        "clean_text": lambda: run(q.indexed(spark, sf)),
        "build_index": lambda: pq.write_index(docs, path),
        "posting_lists": lambda: run(wd.posting_lines(pq.posting_lists(indexed().postings))),
        "search": lambda: pq.search("10 the heat tion", indexed()).collect(),
        "search_again": lambda: pq.search("-10 of and the ing", indexed()).collect(),
        "search_batch": lambda: run(pq.search_batch(q.text_requests(spark, sf), indexed())),
        "search_batch_1000": lambda: run(pq.search_batch(requests, indexed())),
        "index_dump": lambda: pq.index_dump(spark, dump, pages_path),
        "result_list": lambda: run(dump_results()),
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    seconds.pop("warm_up")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
