"""Repeated passages of lines against a plain walk over all documents."""

from pagequill.llm import line_dedup

PASSAGE = "first line\nsecond line\nthird line\nfourth line"
ROWS = [
    (1, f"a\n{PASSAGE}\nb"), (2, f"{PASSAGE}\nown end"), (3, "own start\n" + PASSAGE), (4, None), (5, ""),
    (6, "x\nx\nx\nx\nx\ny"), (7, "only\ntwo"), (8, "only\ntwo"), (9, "\n\n\n\n"), (10, "\n \n\t\n\nq"),
    (None, PASSAGE), (11, PASSAGE), (11, PASSAGE), (12, "first line\nsecond line\nanother"), (13, "\n".join(map(str, range(900)))),
    (14, "\n".join(map(str, range(300, 700))) + "\nend"),
]


def expected(rows):
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    lines = [(t or "").split("\n") for _, t in rows]
    seen, covered = set(), [set() for _ in rows]
    for d, own in enumerate(lines):
        for p in range(len(own) - 2):
            window = tuple(own[p : p + 3])
            if all(not x.strip(" ") for x in window):
                continue
            if window in seen:
                covered[d] |= {p, p + 1, p + 2}
            seen.add(window)
    out = {}
    for (i, t), own, gone in zip(rows, lines, covered):
        kept = "\n".join(x for p, x in enumerate(own) if p not in gone)
        out[i, t] = (i, kept if gone else t, "e", len(own), len(gone))
    return out


def test_against_a_plain_walk(spark):
    df = spark.createDataFrame([(i, t, "e", 0) for i, t in ROWS], "doc_id long, text string, pos string, n_lines int")
    got = line_dedup.deduplicated(df)
    assert got.columns == ["doc_id", "text", "pos", "n_lines", "n_removed"]
    want = expected(ROWS)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((want[r] for r in ROWS), key=repr)
    assert "Python" not in got._jdf.queryExecution().toString()


def test_no_line_is_lost(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = line_dedup.deduplicated(df).collect()
    before = {x for r in df.collect() for x in r["text"].split("\n")}
    assert {x for r in got for x in r["text"].split("\n")} | {""} == before | {""}
    assert sum(r["n_removed"] for r in got) > 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.deduplicated(df).count() == 0
