import pagequill as pq

from .conftest import rows
from .test_search import Plain, corpus

BLOCKED = "t5mm8lyj25cvxe8i4i9pgokb6krbzj9"


def test_dump_to_search(spark, tmp_path):
    pages = corpus(4)
    records = [
        f"<page><title>{t}</title><id>{i}</id>"
        + (f'<redirect title="{r}" />' if r else "")
        + f"<revision><id>{i + 1000}</id><text xml:space=\"preserve\">{c} &amp;lt;</text>"
        + f"<sha1>s{i}</sha1></revision></page>"
        for i, t, r, c, _ in pages
    ]
    extra = [
        "<page><title>Page none</title><id>900</id><text /></page>",
        f"<page><title>Page bad</title><id>901</id><text>the the</text><sha1>{BLOCKED}</sha1></page>",
        "<page><title>Page no id</title><text>the the</text></page>",
    ]
    dump = tmp_path / "dump.xml"
    dump.write_text("<mediawiki>\n" + "\n".join(records + extra) + "\n</mediawiki>\n")
    out = str(tmp_path / "out")
    index = pq.index_dump(spark, str(dump), out)
    # Titles are part of what is indexed.
    plain = Plain([(i, t, r, c, f"{t} {c}") for i, t, r, c, _ in pages])
    for msg in ("10 the heat", "30 page a", "8 list b1 of"):
        assert [r["id"] for r in pq.search(msg, index).collect()] == plain.search(msg)
    data = dump.read_bytes()
    for page, offset, title in rows(index.directory, "id", "offset", "title"):
        assert data[offset:].decode().startswith(f"<page><title>{title}</title><id>{page}</id>")
    assert index.directory.count() == len(pages)
    assert rows(pq.load_pages(spark, out), "id") == sorted((p[0],) for p in pages)
