import bz2
import gzip
import os

import pytest

import pagequill as pq
from pagequill.sources import dump

from .conftest import rows


def write(path, text):
    with open(path, "wb") as f:
        f.write(text.encode())
    return str(path)


def scan(data: bytes, start=b"<page>", end=b"</page>"):
    """Offsets and records, by walking over the bytes."""
    out, at = [], 0
    while True:
        a = data.find(start, at)
        b = data.find(end, a) if a >= 0 else -1
        if b < 0:
            return out
        at = b + len(end)
        out.append((a, data[a:at].decode()))


def test_dump_round_trip_with_many_splits(spark, tmp_path):
    pages = [f"<page><id>{i}</id><text>é{'x' * (i % 300)}\nz</text></page>" for i in range(3000)]
    path = write(tmp_path / "d.xml", "<mediawiki>\n <info>ü</info>\n" + "\n  ".join(pages) + "\n</mediawiki>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        loaded = pq.load_dump(spark, path)
        assert loaded.rdd.getNumPartitions() > 5
        assert sorted(r["raw"] for r in loaded.collect()) == sorted(pages)
        with open(path, "rb") as f:
            data = f.read()
        assert rows(pq.load_dump_offsets(spark, path), "offset", "raw") == sorted(scan(data))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_unterminated_last_record_is_dropped(spark, tmp_path):
    whole = write(tmp_path / "a.xml", "<page>1</page><page>2</page>")
    cut = write(tmp_path / "b.xml", "<page>3</page>\n<page>4")
    for load in (pq.load_dump, pq.load_dump_offsets):
        assert rows(load(spark, [whole, cut]), "raw") == [
            ("<page>1</page>",), ("<page>2</page>",), ("<page>3</page>",)
        ]
    assert pq.load_dump(spark, [whole, cut], complete=True).count() == 4


def test_record_starts_at_its_first_start_tag(spark, tmp_path):
    path = write(tmp_path / "c.xml", "rest</page> <<page>a<page>b</page> tail")
    assert rows(pq.load_dump(spark, path)) == [("<page>a<page>b</page>",)]
    found = rows(pq.load_dump_offsets(spark, path), "offset", "raw")
    assert found == [(13, "<page>a<page>b</page>")]


def test_tag_records_and_several_paths(spark, tmp_path):
    a = write(tmp_path / "a.xml", "<page><title>A</title></page>")
    b = write(tmp_path / "b.xml", "<page><title>B</title></page><page><title>C</title></page>")
    titles = pq.load_tag_records(spark, [a, b], "<title>", "</title>")
    assert rows(titles) == [("<title>A</title>",), ("<title>B</title>",), ("<title>C</title>",)]
    assert pq.multi_path_scan(spark, [a, b]).count() == 3


@pytest.mark.parametrize("ending", ["\n", "", "\n</mediawiki>\n", "<page>open", "\n<page><page>open"])
@pytest.mark.parametrize("pack", ["bz2", "gz", None])
@pytest.mark.parametrize("bom", [b"", b"\xef\xbb\xbf"])
def test_compressed_and_plain_dumps_agree(spark, tmp_path, ending, pack, bom):
    pages = [f"<page><id>{i}</id>é{'x' * (i % 50)}</page>" for i in range(400)]
    text = ("\n ".join(pages) + ending).encode()
    path = str(tmp_path / "d.xml") + (f".{pack}" if pack else "")
    half = len(text) // 2
    squeeze = {"bz2": bz2.compress, "gz": gzip.compress, None: bytes}[pack]
    with open(path, "wb") as f:
        f.write(squeeze(bom + text[:half]) + squeeze(text[half:]))
    assert sorted(r["raw"] for r in pq.load_dump(spark, path).collect()) == sorted(pages)
    shift = 0 if pack else len(bom)
    want = sorted((a + shift, raw) for a, raw in scan(text))
    assert rows(pq.load_dump_offsets(spark, path), "offset", "raw") == want


@pytest.mark.parametrize("name", ["a b.xml.bz2", "u.XML.BZ2", "a b.xml", "x%20y.xml.gz", "é+&.xml.bz2"])
def test_names_of_files(spark, tmp_path, name):
    """Blanks, other letters and upper-case endings; the cut-off last record is dropped from each."""
    pages = [f"<page><id>{i}</id>{'x' * (i % 50)}</page>" for i in range(50)]
    text = ("\n".join(pages) + "\n<page><id>50</id>").encode()
    squeeze = {"bz2": bz2.compress, "gz": gzip.compress}.get(name.lower().rsplit(".", 1)[-1], bytes)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / name).write_bytes(squeeze(text))
    for path in (str(tmp_path / "in"), str(tmp_path / "in" / name)):
        assert sorted(r["raw"] for r in pq.load_dump(spark, path).collect()) == sorted(pages)
    assert rows(pq.load_dump_offsets(spark, str(tmp_path / "in")), "offset", "raw") == sorted(scan(text))


def test_a_dump_is_read_once(spark, tmp_path, monkeypatch):
    """Records come from what one pass over the dump has written, whatever is asked of them."""
    path = write(tmp_path / "d.xml", "<mediawiki>" + "".join(f"<page>{i}</page>\n" for i in range(99)))
    scans, pieces = [], dump._pieces
    monkeypatch.setattr(dump, "_pieces", lambda *a: scans.append(a) or pieces(*a))
    found = pq.load_dump_offsets(spark, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and found.count() == 99 and len(scans) == 1


def test_records_are_not_shuffled(spark, tmp_path):
    """Places of splits go to the records, not the records to them."""
    paths = [write(tmp_path / f"{i}.xml", "<page>é</page> <page>b</page>") for i in range(3)]
    loaded = pq.load_dump_offsets(spark, paths)
    assert rows(loaded, "offset", "raw") == [(0, "<page>é</page>")] * 3 + [(16, "<page>b</page>")] * 3
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_export_is_ordered_over_all_files(spark, tmp_path):
    df = spark.createDataFrame([(f"w{i % 50}", i, i * 2) for i in range(500)], "word string, id long, tf long")
    out = str(tmp_path / "tsv")
    pq.export_tsv(df.repartition(4), out, ["word", "id"], ["tf"])
    lines = []
    for name in sorted(n for n in os.listdir(out) if n.startswith("part-")):
        with open(os.path.join(out, name)) as f:
            lines += f.read().splitlines()
    keys = [line.split("\t")[0] for line in lines]
    assert keys == sorted(keys) and len(keys) == 500
    assert "w7 7\t14" in lines
