from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import pagediff, warc

ROWS = [(1, "http://a.example/x\r\n", "<p>one</p>"), (2, None, None), (3, "http://a.example/y", ""), (4, "u", "<p>one</p>"), (4, "u", "<p>one</p>"),
        (None, "n", "<p>one</p>"), (5, "v", "line\r\n\r\nWARC/1.1\r\n\r\nline é 😀"), (6, "w", "long " * 50_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, payload string, record_type int").repartition(2)


def digest(body):
    return base64.b32encode(hashlib.sha1((body or "").encode()).digest()).decode()


def test_archives_round_trip_and_revisits(spark, pages, tmp_path):
    raw, slim = str(tmp_path / "raw"), str(tmp_path / "slim")
    warc.write_archives(warc.page_records(pages), raw, mean_bytes=100, archive_bytes=1500)
    back = sorted(((r.page_id, r.url, r.payload, r.record_type) for r in warc.read_archives(spark, raw).collect()), key=str)
    clean = lambda u: u and u.replace("\r", "%0D").replace("\n", "%0A")
    assert back == sorted(((i, clean(u), h or "", "response") for i, u, h in ROWS), key=str)
    warc.dedup_archives(spark, raw, slim)
    rows = warc.read_archives(spark, slim).collect()
    by_type = {k: [r for r in rows if r.record_type == k] for k in ("response", "revisit")}
    assert sorted(((r.page_id, r.payload_digest, r.payload_bytes, r.refers_to) for r in by_type["revisit"]), key=str) == sorted(
        [(i, digest("<p>one</p>"), 10, 1) for i in (4, 4, None)] + [(3, digest(""), 0, 2)], key=str)
    assert len(by_type["response"]) == 4 and all(r.payload is None for r in by_type["revisit"])
    ids = {r.record_id: r.page_id for r in by_type["response"]}
    assert all(ids[r.refers_to_record] == r.refers_to for r in by_type["revisit"])
    # archives that hold revisits already resolve to the same records
    again = str(tmp_path / "again")
    warc.dedup_archives(spark, slim, again)
    key = lambda r: str((r.page_id, r.record_id, r.record_type, r.payload_digest, r.payload_bytes, r.refers_to, r.payload))
    assert sorted(map(key, warc.read_archives(spark, again).collect())) == sorted(map(key, rows))
    big = str(tmp_path / "big")
    warc.dedup_archives(spark, raw, big, min_bytes=11)
    assert warc.read_archives(spark, big).where("record_type = 'revisit'").count() == 0
    none = str(tmp_path / "none")
    warc.write_archives(warc.page_records(pages.limit(0)), none)
    assert warc.read_archives(spark, none).count() == 0


def test_headers_are_unpacked_once(spark, pages, tmp_path, monkeypatch):
    raw, seen, resolve = str(tmp_path / "raw"), [], warc.resolve_revisits
    warc.write_archives(warc.page_records(pages), raw)
    monkeypatch.setattr(warc, "resolve_revisits", lambda records, *more: seen.append(records) or resolve(records, *more))
    warc.dedup_archives(spark, raw, str(tmp_path / "slim"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "FileScan parquet" in plan


def test_orphan_revisit_stays(spark):
    row = (9, "u", "rec-1", "revisit", "ABC", 5, 3, "rec-0", None)
    out = warc.resolve_revisits(spark.createDataFrame([row], warc.RECORD)).first()
    assert (out.record_type, out.refers_to, out.refers_to_record, out.payload_bytes) == ("revisit", 3, "rec-0", 5)


def test_page_lines_zones():
    html = ("<html><head><title>t</title><style>p{}</style></head><body><header>Top</header><nav><ul><li>a<li>b</ul></nav><div class='main-menu'>m<div>n</div></div>"
            "<article><header><h1>Head&amp;line</h1></header><p><b>One<br>two\n  three<p>a &lt; b&nbsp;c<script>var x='</p>';</script></p><aside>side</aside>"
            "<div id=comments><p>nice</p></div><form><p>mail</p></form><p hidden>h</p>tail</article><!-- <p>no</p> --><footer>&copy; x")
    lines = pagediff.page_lines(html)
    assert [t for t, z in lines if z == pagediff.MAIN] == ["Head&line", "One two three", "a < b c", "tail"]
    assert {"Top", "a", "b", "m", "n", "side", "nice", "mail", "h", "© x"} == {t for t, z in lines if z == pagediff.NOISE}
    assert pagediff.page_lines(None) == [] and pagediff.page_lines("<nav>x<article>y") == [("x", "noise"), ("y", "main")]
    assert pagediff.page_lines("a <b>c</b>d < e") == [("a cd < e", "open")]


def test_bare_angle_brackets_and_cut_off_tags():
    def texts(html):
        return [t for t, z in pagediff.page_lines(html) if z == pagediff.MAIN]

    assert texts("<article><p>Prices fell as 1 < 2 and everything after") == ["Prices fell as 1 < 2 and everything after"]
    assert texts("<article><p>1 < 2 <p>3 <4 and 5<6<") == ["1 < 2", "3 <4 and 5<6<"]
    assert texts("<article><p>kept text <a href='cut") == ["kept text"] and texts("<article>x</article") == ["x"]
    assert texts("<article><p>x < y</p> tail <3 <!-- cut") == ["x < y", "tail <3"]


def test_class_words_inside_an_article():
    def texts(inner):
        return [t for t, z in pagediff.page_lines(f"<article><p>first</p>{inner}<p>last</p></article>") if z == pagediff.MAIN]

    for kept in ('<p class="share-price">Shares rose</p>', '<div id="related-work">Shares rose</div>', '<p class="lead promo_code">Shares rose</p>'):
        assert texts(kept) == ["first", "Shares rose", "last"]
    for gone in ('<div id="comments">x</div>', '<div class="box comment-list">x</div>', '<p class="social-share">x</p>', '<div class="ad-slot">x</div>'):
        assert texts(gone) == ["first", "last"]


def test_common_lines_is_longest():
    import itertools
    import random

    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 7))] for _ in range(2))
        got = pagediff.common_lines(a, b)
        best = max((k for k in range(len(a) + 1) for c in itertools.combinations(range(len(a)), k)
                    if (it := iter(b)) is not None and all(any(x == a[i] for x in it) for i in c)), default=0)
        assert len(got) == best and got == sorted(set(got))
        it = iter(b)
        assert all(any(x == a[i] for x in it) for i in got)


def test_extract_pairs_nearest_pages(spark):
    page = lambda body: f"<div>Site menu</div><div>Log in</div>{body}<div>All rights reserved</div>"
    rows = [(1, "http://h.example/news/a1", page("<p>First story text here</p><p>More of it</p>")),
            (2, "http://h.example/news/a2", page("<p>Second story, quite another one</p>")),
            (3, "http://h.example/zoo", "<p>Alone</p>"), (4, "http://other.example/news/a3", page("<p>Elsewhere</p>")),
            (5, None, "<p>x</p>"), (6, "http://h.example/news/a1", None), (7, "http://k.example/c1", "<p>copy of a long text</p><p>b</p>"),
            (8, "http://k.example/c2", "<p>copy of a long text</p><p>b</p>"),
            (9, "http://m.example/1", "<div>Menu</div><article><p>same</p></article>"), (10, "http://m.example/2", "<div>Menu</div><article><p>same</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).repartition(3)
    for part_bytes in (8 << 20, 100):
        got = {r.page_id: r for r in pagediff.extract(pages, part_bytes=part_bytes).collect()}
        assert len(got) == len(rows)
        assert got[2].text == "Second story, quite another one" and got[2].n_shared == 3
        assert got[3].text == "Alone" and got[5].text == "x" and got[6].text == ""
        assert got[4].text == "Site menu\n\nLog in\n\nElsewhere\n\nAll rights reserved"
        assert got[7].text == got[8].text == "copy of a long text\n\nb"
        assert got[9].text == "same" and got[9].n_shared == 1
        assert all(r.n_chars == len(r.text) for r in got.values())
    assert pagediff.extract(pages.limit(0)).count() == 0


def test_differencing_decides_lines_outside_the_article(spark):
    page = lambda n: f"<div>Site menu</div><nav>nav {n}</nav><div>Lead text of {n}</div><article><p>Story {n}</p></article><div>Legal</div>"
    pages = spark.createDataFrame([(i, f"http://h.example/a{i}", page(i)) for i in range(3)], "page_id long, url string, html string")
    got = {r.page_id: r for r in pagediff.extract(pages).collect()}
    assert all(got[i].text == f"Lead text of {i}\n\nStory {i}" and (got[i].n_shared, got[i].n_markup) == (2, 1) for i in range(3))


def test_lines_go_by_the_pages_that_hold_them(spark):
    menu = "".join(f"<div>Menu entry number {i} with a long label</div>" for i in range(20))
    rows = [(i, f"http://short.example/p{i}", f"{menu}<p>Tiny {i}</p>{menu}") for i in range(4)]
    paras = [f"<p>Paragraph {i} of an article printed twice</p>" for i in range(6)]
    rows += [(10, "http://near.example/a/x1", "<div>Top</div>" + "".join(paras) + "<p>own end</p><p>more</p><p>of it</p><p>here</p>"),
             (11, "http://near.example/a/x2", "<div>Top</div>" + "".join(paras) + "<p>other end</p><p>quite</p><p>another</p><p>one</p>"),
             (12, "http://near.example/a/x2", "<div>Top</div>" + "".join(paras) + "<p>other end</p><p>quite</p><p>another</p><p>one</p>")]
    rows += [(20 + i, f"http://near.example/b/{i}", f"<div>Top</div><p>Story {i}</p>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in pagediff.extract(pages).collect()}
    assert len(got) == len(rows)
    assert all(got[i].text == f"Tiny {i}" and got[i].n_shared == 40 for i in range(4))
    article = [f"Paragraph {i} of an article printed twice" for i in range(6)]
    assert got[10].text.split("\n\n") == [*article, "own end", "more", "of it", "here"]
    assert got[11].text == got[12].text == "\n\n".join([*article, "other end", "quite", "another", "one"])
    assert all(got[20 + i].text == f"Story {i}" and got[20 + i].n_shared == 1 for i in range(8))
