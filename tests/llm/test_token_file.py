"""Token files: ids, order and selective reads."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagequill.llm import token_file
from pagequill.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
HARD = [
    "it's  two   spaces\n\n b", "\t\ttabs \t x", "end  ", "  ", "", "a\x1c\x1d b", "<|endoftext|> <|endoftext|>x",
    "é ß 　x", "x" * 500 + " y", "1,234.5 \U0001f600\U0001f600", "don't 'll\n'll", " lead\n", "\n \n x",
]


def expected(rows):
    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_encoder_equals_the_library_on_hard_texts(monkeypatch):
    encoder, tokenizer = token_file.Encoder(PATH), Tokenizer.from_file(PATH)
    monkeypatch.setattr(token_file, "CACHE_BYTES", 1500)
    for texts in (HARD, HARD[::-1], ["".join(HARD)]):
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder(texts)] == want


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, QUERIES["op3_token_file"](spark, SF).collect()))
    assert got == expected(docs)


def test_nulls_repeats_and_empty_table(spark, tmp_path):
    rows = [(3, None), (1, "b b"), (1, "a"), (None, "null id"), (2, "")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, ids string")
    got = token_file.token_table(df, PATH).orderBy("start").collect()
    order = [(None, "null id"), (1, "a"), (1, "b b"), (2, ""), (3, None)]
    assert [tuple(r) for r in got] == expected(order)
    assert token_file.token_table(df.limit(0), PATH).count() == 0


def test_layout_and_selective_reads(spark, tmp_path):
    import pyarrow.parquet as pq

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = str(tmp_path / "tokens")
    token_file.write_tokens(docs, path, PATH)
    file = pq.ParquetFile(next((tmp_path / "tokens").glob("*.parquet")))
    group = file.metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert columns["ids.list.element"].has_column_index and columns["doc_id"].has_offset_index
    read = token_file.read_tokens(spark, path)
    plan = read.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "ids:" not in plan.split("ReadSchema")[1]
    plan = read.where("doc_id = 7").select("ids")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan
    total = read.agg({"n_tokens": "sum"}).first()[0]
    last = read.orderBy("start", ascending=False).first()
    assert last["start"] + last["n_tokens"] == total


@pytest.mark.parametrize("text", [None, ""])
def test_empty_text_has_only_the_end(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(r) for r in token_file.token_table(df, PATH).collect()] == expected([(1, text)])


class Counted(dict):
    """A dict that counts how often it is asked."""

    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_a_repeated_piece_is_looked_up_once_for_all_texts():
    encoder, texts = token_file.Encoder(PATH), ["a cat, a dog and a cat-like dog, it's so."] * 500
    encoder.known = Counted(encoder.known)
    want = Tokenizer.from_file(PATH).encode(texts[0], add_special_tokens=False).ids
    for _ in range(2):
        assert {tuple(np.frombuffer(b, "<u4")) for b in encoder(texts)} == {tuple(want)}
    assert encoder.known.asked < 100


def test_pieces_in_use_outlast_those_seen_once(monkeypatch):
    encoder = token_file.Encoder(PATH)
    encoder([" often"])
    monkeypatch.setattr(token_file, "CACHE_BYTES", 40_000)
    asked, plain = [], encoder._plain
    monkeypatch.setattr(encoder, "_plain", lambda texts: asked.extend(texts) or plain(texts))
    for i in range(100):
        encoder([" often" + "".join(f" w{i}x{j}" for j in range(20))])
    assert len(encoder.known) < 1000
    assert not any("often" in text for text in asked)


def test_encoder_equals_the_library_on_random_signs(monkeypatch):
    monkeypatch.setattr(token_file, "CACHE_BYTES", 60_000)
    monkeypatch.setattr(token_file, "NEW_BYTES", 300)
    white = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x202F, 0x205F, 0x3000)]
    signs = ["'s", "'ll", "'", "<|endoftext|>", "<|", "endoftext", *"éàïßΩ×日語…’”٣½𝒳ab1,.-_()", "the", "\0", "\x7f", "́", "\U0001f600"]
    random, encoder, tokenizer = np.random.default_rng(3), token_file.Encoder(PATH), Tokenizer.from_file(PATH)
    for _ in range(60):
        texts = ["".join(random.choice([*white, *[" "] * 20, *signs, *signs], n)) for n in random.integers(0, 40, 50)]
        texts.append("".join(texts))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder(texts)] == want


def test_other_string_types_and_nulls_among_texts(spark):
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        rows = [(1, "a b"), (2, None), (3, ""), (4, "c　  d")]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = token_file.token_table(df, PATH).orderBy("doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
    assert [tuple(r) for r in got] == expected(rows)
