"""The stages of the pipeline, each against a plain version on what its predecessor kept."""

import re

import corpus_pipeline as cp
from pagequill.llm import sentencepiece, simhash, toxicity
from pagequill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    kept = {}
    for name, stage in cp.STAGES:
        docs = cp.saved(stage(spark, docs, SF), name.replace(" ", "-"))
        kept[name] = docs.collect()
        assert name == "sentencepiece" or docs.columns == columns
    ids = lambda rows: {r["doc_id"] for r in rows}

    # The model of the stage is that of op4; it rejects from a score of its own on.
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    own = spark.read.parquet(f"{SF}/documents.parquet")
    least = toxicity.fit(own.where(~toxicity.held_out()), labels.where(~toxicity.held_out())).threshold()
    scores = {r["doc_id"]: r["score"] for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    assert ids(kept["toxicity"]) == {i for i, p in scores.items() if p < least}

    groups = {}
    for r in kept["toxicity"]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"]), []).append((-len(r["text"]), r["doc_id"]))
    assert ids(kept["exact dedup"]) == {min(g)[1] for g in groups.values()}

    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in kept["exact dedup"]}
    group = {i: i for i in prints}
    for a in sorted(prints):
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert ids(kept["near dedup"]) == set(group.values())

    # The mix keeps every document and repeats some.
    assert ids(kept["mixing"]) == ids(kept["near dedup"])
    assert {tuple(r) for r in kept["mixing"]} == {tuple(r) for r in kept["near dedup"]}

    own = sentencepiece.model(cp.public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in before}
    assert len(kept["sentencepiece"]) == len(kept["mixing"])
    assert all(own.decode(r["ids"]) == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in kept["sentencepiece"])


def test_run_on_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900, "", "en", None, 0), (901, "x", None, "s", None)], docs.schema)
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    rows = cp.run(spark, str(tmp_path)).collect()
    assert {901} <= {r["doc_id"] for r in rows} and rows[0]["n_tokens"] == len(rows[0]["ids"])
    assert toxicity.THRESHOLD == 0.3
