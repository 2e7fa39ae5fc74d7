"""Operators that return their input's columns, with columns named as those they use themselves."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pagequill.llm import exact_dedup, line_dedup, mixing, periodic, sentencepiece, simhash, toxicity

NAMES = (
    "row", "number", "key", "id", "hash", "begins", "ends", "_doc_id", "_version", "_hash", "_lines", "_kept", "_n", "_p", "_buckets",
    "_rate", "_words", "_z", "_e", "_t", "_s1", "copy", "_copy", "__row", "__gone", "__kept", "__toxicity", "toxicity", "_text", "_ids", "own",
    "placed", "_own", "_placed", "component_id", "fp", "recipe", "a.b",
)
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LABELS = [(i, i % 2, i % 3) for i in range(40)]


def _labels(docs):
    return docs.sparkSession.createDataFrame(LABELS, "doc_id long, toxic int, quality int")


def _mixed(docs):
    domains = mixing.domains_of(_labels(docs))
    return mixing.mixed(docs, domains, {"toxic": 0.5, "good": 0.2, "poor": 0.3}, floor=1.0, budget=None)


def _decoded(docs):
    return sentencepiece.decoded(sentencepiece.encoded(docs, PIECES, out="ids of text"), PIECES, ids_col="ids of text").drop("ids of text")


OPERATORS = {
    "line_dedup": lambda d: line_dedup.deduplicated(d).drop("n_lines", "n_removed"),
    "mixing": _mixed,
    "sentencepiece": _decoded,
    "exact_dedup": exact_dedup.drop_copies,
    "simhash": simhash.drop_near_copies,
    "toxicity": lambda d: toxicity.drop_toxic(d, _labels(d), threshold=2.0),
    "periodic": periodic.with_planted_period,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_other_columns_stay(spark, name):
    texts = [f"word{i} some {i * i} text\nline {i}\nlast {i % 7}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.select("*", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in NAMES])
    got = OPERATORS[name](docs)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = got.collect()
    ids = {r["doc_id"] for r in rows}
    assert ids == set(range(40)) if name != "simhash" else len(ids) > 20
    for r in rows:
        assert all(r[n] == f"{n}:{r['doc_id']}" for n in NAMES)
        assert name == "periodic" or r["text"] == texts[r["doc_id"]]
