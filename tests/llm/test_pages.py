"""Main text and archives."""

import gzip
import hashlib

import numpy as np
from conftest import prose

from stationlake.llm import html_text, warc


def page(title, body, share="<div class='tool'><p>Get our app today</p></div>"):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>var t='</p>';</script></head><body><nav><ul><li>Home</ul></nav>"
            f"{share}<div class=ad>Buy</div><h1>{title}</h1>{body}<form>Name <input></form><footer>&copy; us</footer></body></html>")


def test_template_and_named_parts_go(spark):
    rows = [(i, f"http://Host.example/{i}", page(f"T{i}", f"<p>{prose(i, 9)}</p><section id=comments>nice</section>")) for i in range(14)]
    rows += [(100, "http://small.example/", page("S", "<p>a&amp;b &lt;c&gt;\n x&nbsp;y<br>z<p>second <b>bold</b>")), (101, None, None), (102, "nourl", ""),
             (103, "http://small.example/2", "<article><header><h1>Head</h1></header>t<p>u</p><div class='comments'>no</div></article><p>outside</p>"),
             (104, "http://small.example/3", "<div>" * 3000 + "deep"), (105, "x", "plain & text <!-- gone --> more <unclosed"), (100, "http://small.example/", "<p>again</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.digest(pages).collect())
    texts = {i: t for i, t, _ in got}
    assert all(texts[i] == f"T{i}\n{prose(i, 9)}" for i in range(14))
    assert [t for i, t, _ in got if i == 100] == ["Get our app today\nS\na&b <c> x y z\nsecond bold", "again"]
    assert (texts[101], texts[102], texts[103], texts[104]) == ("", "", "Head\nt\nu", "deep")
    assert texts[105].startswith("plain & text more")
    assert all(n == len(t) for _, t, n in got)


def text_of(page):
    return html_text.main_text(html_text.parse(page), frozenset())


def test_names_do_not_drop_the_page_or_text():
    for names in ("class='single no-sidebar'", "class='has-sidebar search-results'", "class='widget'", "id=search", "role=dialog class='ad social'"):
        assert text_of(f"<html {names}><body {names}><div {names}><main {names}><p>a</p></main></div><p>b</p></body></html>") == "a"
        assert text_of(f"<body {names}><div {names}><article {names}><h1>t</h1>a</article></div></body>") == "t\na"
        assert text_of(f"<body {names}><h1>t</h1><p>a</p></body>") == "t\na"
    assert text_of("<article class='share-enabled'><p>a</p></article><p>b</p>") == "a"
    assert text_of("<article><section id='related-work'><h2 id='how-to-search'>h</h2><p class=alert>p</p></section><section id=related>"
                   "<h2 id=search>i</h2><p id=menu>q <span class=notice>r</span></p></section><div class='alert notice'>s</div></article>") == "h\np\ni\nq r\ns"
    assert text_of("<article><p>a</p><div class='x comments'>c</div><p class=ad>d</p><ul role=menu><li>m</ul><div id=share>s</div><aside>x</aside><p>b</p></article>") == "a\nb"
    assert text_of("<body><div class=ad-free>a</div><div class=ad>b</div><h2 id=search>c</h2><section id=comments>d</section></body>") == "a\nc"


def test_copies_and_repeated_parts_of_articles_stay(spark):
    side = "<div class='tool'><p>Get our app today</p></div>"
    copy = "<h1>Copy</h1><p>The same page many times</p>"
    rows = [(i, f"http://copies.example/?v={i}", page("Copy", f"<p>The same page many times</p><div class=ad>{i}</div>")) for i in range(20)]
    rows += [(100 + i, None, f"{side}<article>{copy}</article><footer>{i}</footer>") for i in range(12)]
    rows += [(200 + i, f"http://parts.example/{i}", f"{side}<article><h2>Summary</h2><p><b>Note:</b> {prose(i, 5)}<table><tr><td>0<td>{i}</table></article>") for i in range(12)]
    rows += [(300 + i, f"http://plain.example/{i}", f"<body>{side}<p><b>Note:</b> {prose(i, 5)}</p><table><tr><td>0<td>{i}</table></body>") for i in range(12)]
    rows += [(400 + i, "http://plain.example/0", f"<body>{side}<p><b>Note:</b> {prose(0, 5)}</p><table><tr><td>0<td>0</table></body>") for i in range(30)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert {got[i] for i in range(20)} == {"Get our app today\nCopy\nThe same page many times"}
    assert {got[100 + i] for i in range(12)} == {"Copy\nThe same page many times"}
    assert all(got[200 + i] == f"Summary\nNote: {prose(i, 5)}\n0\n{i}" for i in range(12))
    assert all(got[300 + i] == f"Note: {prose(i, 5)}\n0\n{i}" for i in range(12))
    assert {got[400 + i] for i in range(30)} == {f"Note: {prose(0, 5)}\n0\n0"}


def test_empty_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, type string")
    assert html_text.extract(none).count() == 0
    assert warc.round_trip(none).count() == 0


def test_archive_round_trip(spark, tmp_path):
    long = "é\r\n\r\nWARC/1.1\r\n" * 30_000
    copy = prose(1, 40)
    rows = [(1, "u", long), (2, None, copy), (3, "v\r\nX: y", copy), (4, "w", "short"), (5, "w", "short"), (6, "w", None), (7, "w", ""), (8, "x", long + "!"),
            (None, "n", copy), (9, "y", copy), (3, "v", copy), (2, "again", copy)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    warc.write_warc(pages, str(tmp_path / "w"))
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    responses = [(r.page, bytes(r.payload)) for r in got if r.type == "response"]
    assert sorted(responses) == sorted((str(i), (h or "").encode()) for i, _, h in rows if i in (1, 2, 4, 5, 6, 7, 8))
    assert sorted(str(r.page) for r in got if r.type == "revisit") == ["3", "3", "9", "None"]
    assert {r.refers for r in got if r.type == "revisit"} == {"2"}
    want = {i: hashlib.sha256((h or "").encode()).hexdigest() for i, _, h in rows}
    assert all(r.digest == want[int(r.page) if r.page else None] for r in got)
    assert {r.page: r.bytes for r in got if r.page}["1"] == len(long.encode())
    some = gzip.decompress(next((tmp_path / "w").glob("part-*")).read_bytes())
    assert some.startswith(b"WARC/1.1\r\n")


def archive(spark, tmp_path, name, records):
    (tmp_path / name).mkdir()
    (tmp_path / name / "one.warc").write_bytes("".join(r + "\r\n\r\n" for r in records).encode())
    return warc.read_warc(spark, str(tmp_path / name))


def test_missing_segment_is_an_error(spark, tmp_path):
    import pytest
    records = list(warc.page_records("k", 1, "u", b"z" * 100_000, "d", None))
    assert len(records) > 3
    whole = archive(spark, tmp_path, "whole", records[::-1]).collect()
    assert [(r.page, bytes(r.payload)) for r in whole] == [("1", b"z" * 100_000)]
    for name, kept in (("middle", records[:1] + records[2:]), ("first", records[1:]), ("last", records[:-1]), ("twice", records + records[1:2])):
        with pytest.raises(Exception, match="lacks a segment|bytes, not"):
            archive(spark, tmp_path, name, kept).collect()
    with pytest.raises(Exception, match="not as long as it says"):
        archive(spark, tmp_path, "cut", [records[0][:-5], *records[1:]]).collect()
    with pytest.raises(ValueError):
        warc.unframe_chunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_revisits_name_their_profile(spark, tmp_path):
    (one,) = warc.page_records("k", 5, "u", b"x" * 200, "d", 2)
    fields, block = next(iter(warc.parse_records((one + "\r\n\r\n").encode())))
    assert fields["WARC-Type"] == "revisit" and fields["WARC-Profile"].endswith("/revisit/identical-payload-digest") and not block


def plain_extract(rows):
    """(id, text) a row: templates counted in one dictionary, pages parsed one by one."""
    import re
    from collections import Counter, defaultdict
    host = lambda u: (m := re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", u or "")) and m[1].lower() or ""
    different = defaultdict(dict)
    for _, url, page in sorted(rows, key=lambda r: html_text._word_hash(r[2] or "")):
        root = html_text.parse(page or "")
        text = html_text.main_text(root, frozenset())
        h = np.uint64(html_text._word_hash(page or "")).view(np.int64)
        held = different[host(url)].get(text)
        if held is None or h < held[0]:
            different[host(url)][text] = (h, set(html_text.hash_subtrees(root)))
    template = {}
    for h, pages in different.items():
        counts = Counter(x for _, found in pages.values() for x in found)
        template[h] = frozenset(x for x, n in counts.items() if n >= 10 and n >= len(pages) / 2)
    out = []
    for i, url, page in rows:
        root = html_text.parse(page or "")
        html_text.hash_subtrees(root)
        out.append((i, html_text.main_text(root, template[host(url)])))
    return out


def test_against_a_plain_version(spark):
    import random
    r = random.Random(3)
    parts = ["<div class='tool'><p>Get our app today</p></div>", "<ul class=links><li>One<li>Two</ul>", "<p>Follow us</p>", "<section><h2>More stories</h2></section>"]
    rows = []
    for i in range(300):
        mine = [p for p in parts if r.random() < 0.7]
        r.shuffle(mine)
        body = f"<h1>T{i}</h1><p>{prose(i, 12)}</p>"
        kind = r.choice(["main", "main", "article", "div"])
        around = f"<{kind}>{mine[0] if mine and kind == 'main' else ''}{body}</{kind}>"
        rows.append((i, f"http://h{min(r.randrange(12), 3)}.example/{i}", f"<body>{''.join(mine)}{around}</body>"))
    rows += [(1000 + i, "http://h1.example/copy", rows[5][2]) for i in range(40)] + [(2000, None, None), (2001, None, "")]
    pages = spark.createDataFrame([(*x, "s", 1) for x in rows], "page_id long, url string, html string, host string, salt int").repartition(4)
    got = sorted((x.page_id, x.text) for x in html_text.extract(pages).collect())
    assert got == sorted(plain_extract(rows))
    assert not any("Get our app today" in t for i, t in got if i < 1000 and "h3" in rows[i][1])


def test_broken_markup_takes_linear_time():
    import time
    for page_html in ("<a " * 300_000, "<i>" * 80_000 + "</b>" * 120_000, '<a ""' * 150_000 + '">', "<a" * 300_000 + ' ">', "<ul>" + "<div>" * 40_000 + "<li></li>" * 40_000,
                      "<i>" * 80_000 + "<div></div>" * 50_000, "<script>" + "</script " * 100_000, "<!--" * 200_000, "<a \"'\"" * 120_000 + ">"):
        start = time.process_time()
        root = html_text.parse(page_html)
        html_text.main_text(root, frozenset())
        assert time.process_time() - start < 20


def test_quotes_and_odd_tags():
    assert text_of("<p title='a>b'>x</p><p title=\"'>\">y") == "x\ny"
    assert text_of("a <3 b < c <p \"x> d</p> e") == 'a <3 b < c <p "x> d e'
    assert text_of("<p>a<!-- <p>b --!>c<? x ?>d</P >e<BR/>f") == "acd\ne f"
