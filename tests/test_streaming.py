import os

from pyspark.sql import functions as F

import pagequill as pq
from pagequill import sizing
from pagequill.plans import prune

from .conftest import rows
from .test_search import MESSAGES, PAGE_SCHEMA, REQUEST_SCHEMA, Plain, corpus


def test_stream_answers_each_request_once(spark, tmp_path):
    pages = corpus(3)
    plain = Plain(pages)
    index = pq.write_index(spark.createDataFrame(pages, PAGE_SCHEMA), str(tmp_path / "index"))
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = pq.search_stream(
            pq.read_requests(spark, inbox, 1), index, out, state, available_now=True
        )
        stream.awaitTermination()

    def expected(ids):
        return sorted((i, n + 1, p) for i in ids for n, p in enumerate(plain.search(MESSAGES[i])))

    requests = spark.createDataFrame(list(enumerate(MESSAGES)), REQUEST_SCHEMA)
    requests.where("request_id < 3").coalesce(1).write.mode("append").parquet(inbox)
    run()
    columns = ("request_id", "rank", "id")
    assert rows(spark.read.parquet(out), *columns) == expected(range(3))
    requests.where("request_id between 3 and 7").coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert rows(spark.read.parquet(out), *columns) == expected(range(8))


def test_scratch_and_bad_requests(spark, tmp_path, monkeypatch):
    """After ten batches nothing is left in the scratch folder, and each bad request has an error."""
    pages = corpus(3)
    plain = Plain(pages)
    index = pq.write_index(spark.createDataFrame(pages, PAGE_SCHEMA), str(tmp_path / "index"))
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    monkeypatch.setattr(sizing.held, "__defaults__", (2,))
    monkeypatch.setattr(prune, "LOCAL_ROWS", 2)
    bad = [(None, "5 the"), (100, None), (101, "the heat"), (102, "5"), (103, "5 " + "x" * 10_000), (0, "~ no limit")]
    requests = spark.createDataFrame([*enumerate(MESSAGES[:10]), *bad], REQUEST_SCHEMA)
    for n in range(10):
        own = F.coalesce(F.col("request_id") == n, F.lit(False))
        rest = ~F.coalesce(F.col("request_id") < 10, F.lit(False)) if n == 3 else F.lit(False)
        requests.where(own | rest).where("msg IS NULL OR msg <> '~ no limit' OR request_id <> 0").unionByName(
            requests.where(F.lit(n == 5) & (F.col("msg") == "~ no limit"))
        ).coalesce(1).write.mode("append").parquet(inbox)
    stream = pq.search_stream(pq.read_requests(spark, inbox, 1), index, out, state, available_now=True)
    stream.awaitTermination()
    assert len([n for n in os.listdir(out) if n.startswith("batch_id=")]) == 10
    assert set(os.listdir(shared)) == before
    got = rows(spark.read.parquet(out), "request_id", "rank", "id")
    assert got == sorted((i, n + 1, p) for i in range(10) for n, p in enumerate(plain.search(MESSAGES[i])))
    errors = {(r["request_id"], r["error"]) for r in spark.read.parquet(f"{out}_errors").collect()}
    assert errors == {
        (None, "no request_id"), (100, "no message"), (101, "no limit"), (102, "no words"),
        (103, "message too long"), (0, "no limit"),
    }
