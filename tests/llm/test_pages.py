"""Page text, URL rules and WARC bundles."""

import hashlib
import random
import struct

import helpers as H
import pytest
import zstandard
from pyspark.sql import functions as F

from lapwise.llm import page_text, url_rules, warc_bundles
from lapwise.session import shared_dir

PAGES = "page_id long, url string, html string, id long, key string, host string, at int"


def pages(spark, rows):
    """Rows (page_id, url, html) with columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(*r, 5, "k", "x", 2) for r in rows], PAGES)


def lcs(a, b):
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
    return size[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(1500):
        a, b = ([r.randrange(6) for _ in range(r.randrange(14))] for _ in range(2))
        at = page_text.shared_places(a, b)
        assert at == sorted(set(at)) and len(at) == lcs(a, b) == lcs([a[i] for i in at], b)


@pytest.mark.parametrize(("html", "text"), [
    ("", ""),
    ("plain &amp; text\n  only", "plain & text only"),
    ("<p>a<b>b</b> c<br>d</p>e", "ab c d e"),
    ("<title>t</title><script>var x='</p><p>no';</script><style>p{}</style><p>yes &lt;p&gt; &#233;&eacute;&nbsp;x", "yes <p> éé x"),
    ("<nav>n</nav><header><h1>site</h1></header><article><header><h1>T</h1></header><p>one<p>two<aside>s</aside></article><footer>f", "T one two"),
    ("<main><p>m</p><form>f<input></form></main><div>outside</div>", "m"),
    ('<body class="has-sidebar"><div class="cookie-notice">c</div><div id="content"><p>x</p><ul class="comments"><li>no</ul><p>y', "x y"),
    ('<article><p>a</p><section class="comments"><article class="comment"><p>c</p></article></section></article>', "a"),
    ('<div hidden>h</div><div style="display:none">d</div><div role="navigation">r</div><p>v', "v"),
    ("<head><title>x</title><meta charset=u><p>no head end", "no head end"),
    ("a < b and <!-- gone --> c <unclosed", "a < b and c <unclosed"),
    ("<p title='a > b'>q</p></div></article>", "q"),
    ("<textarea><p>no</p></textarea><template><p>no</p></template><p>yes", "yes"),
])
def test_structure(html, text):
    assert page_text.main_text(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("<div>Menu</div><main><p>A long story of its own.</p><article class='card'><p>Teaser</p></article><p>The end.</p></main>", "A long story of its own. Teaser The end."),
    ("<div class='post-content'><p>Prose by name.</p></div><article class=card>Teaser</article><div>Foot</div>", "Prose by name. Teaser"),
    ("<div>Prose that nothing marks, and much of it.</div><div class='post'>Card</div>", "Prose that nothing marks, and much of it. Card"),
    ("<div>Menu</div><div class='post'>A whole story under one name.</div>", "A whole story under one name."),
    ("<div>Much text beside the main region.</div><div role=main>m<article>a</article></div>", "m a"),
])
def test_small_regions_do_not_drop_the_rest(html, text):
    assert page_text.main_text(html) == text


def template(i, story):
    return f"<div class=a1><div>Menu</div><div>Home of {i % 2}</div><p>{story}</p><div><a href=/x>More</a></div><p>All rights</p></div>"


def test_lines_of_the_nearest_page_are_cut(spark):
    rows = [(i, f"http://h.com/a/{i}", template(i, f"story {i}")) for i in range(6)]
    rows += [(20 + i, f"https://g.org/{'x' * i}", template(0, f"tale {i}")) for i in range(3)]
    rows += [(30, "http://solo.net/1", template(0, "alone")), (31, None, None), (32, "no scheme", "<p>x</p>")]
    rows += [(3, "http://h.com/a/3", template(3, "story 3")), (40, "http://h.com/a/3.html#top", template(3, "story 3"))]
    out = page_text.extract_text(pages(spark, rows))
    text = {(r["page_id"], r["url"]): r["text"] for r in out.collect()}
    assert out.count() == len(rows)
    # Neighbours differ in the second line.
    assert text[2, "http://h.com/a/2"] == "Home of 0 story 2" and text[40, "http://h.com/a/3.html#top"] == "Home of 1 story 3"
    assert text[21, "https://g.org/x"] == "tale 1"
    assert text[30, "http://solo.net/1"] == "Menu Home of 0 alone More All rights"
    assert text[31, None] == "" and text[32, "no scheme"] == "x"
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_copies_are_no_partners(spark, monkeypatch):
    monkeypatch.setattr(page_text, "BLOCK_ROWS", 4)
    story = "<p>" + "A long passage of the story. " * 20 + "</p>"
    page = "<div>Menu</div>{}<div>All rights</div>"
    rows = [(i, f"http://h.com/a/{i:02}", page.format(story + f"<p>Seen {i % 3}</p>")) for i in range(11)]
    rows += [(20, "http://h.com/b", page.format("<p>Another tale.</p>")), (21, "http://h.com/c", page.format("<p>A third.</p>"))]
    rows += [(30 + i, f"http://twin.net/{i}", page.format(story)) for i in range(2)]
    text = {r["page_id"]: r["text"] for r in page_text.extract_text(pages(spark, rows)).collect()}
    whole = " ".join(("A long passage of the story. " * 20).split())
    assert [text[i] for i in range(11)] == [f"{whole} Seen {i % 3}" for i in range(11)]
    assert text[20] == "Another tale." and text[21] == "A third."
    assert text[30] == text[31] == f"Menu {whole} All rights"


def test_marked_articles_keep_what_pages_share(spark):
    article = "<article><h1>Same</h1><p>A passage that repeats.</p><p>{}</p><p><a>Share</a></p></article>"
    rows = [(i, f"http://h.com/{i}", "<nav>n</nav>" + article.format(i)) for i in range(4)]
    out = {r["page_id"]: r["text"] for r in page_text.extract_text(pages(spark, rows)).collect()}
    assert out == {i: f"Same A passage that repeats. {i}" for i in range(4)}
    assert page_text.extract_text(pages(spark, [])).count() == 0


def test_shuffled_cuts_give_the_same(spark, monkeypatch):
    rows = [(i, f"http://h.com/a/{i}", template(i, f"story {i}")) for i in range(8)]
    want = sorted(map(tuple, page_text.extract_text(pages(spark, rows)).collect()))
    monkeypatch.setattr(page_text, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, page_text.extract_text(pages(spark, rows)).collect())) == want


def test_aliases_of_blocked_urls_are_blocked(spark):
    rows = [
        (1, "http://a.example.org/en/1x", "<link rel=\"canonical\" href='http://b.net/p'>"),
        (2, "https://b.net/p#f", "x"),
        (3, "http://c.com/fr/1", "<LINK href=//b.net/p rel=canonical>"),
        (4, "http://d.net/q/r", "<meta http-equiv=refresh content=\"0; url='/s'\">"),
        (5, "http://d.net/s", "<link rel=canonical href=p?a=1&amp;b=2>"),
        (6, None, None), (7, "ftp:x", ""), (8, "http://d.net/t/u", "<link href='http://b.net/p' rel=\"canonical\">"),
        (9, "HTTP://ORG", ""), (10, "http://x.ORG/a?b", ""), (11, "http://y.org#a/b", ""), (2, "https://b.net/p#f", "x"),
        (12, "http://example.org/es/1", ""), (13, "http://notexample.org/es/", ""), (14, "http://z.com/de/a", ""),
        (15, "http://e.net/p?a=1&b=2", None), (16, "http://f.net/old", None), (17, "http://g.com/de/9", None),
    ]
    redirects = spark.createDataFrame([("http://f.net/old", "http://f.net/mid"), ("http://f.net/mid", "http://g.com/de/9"), (None, "x")], "src string, dst string")
    out = url_rules.judge_urls(pages(spark, rows), redirects=redirects).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}
    assert len(out) == len(rows)
    assert got == {
        1: ("a.example.org", "/en/1x", "example.org/en/1", "block"), 2: ("b.net", "/p", None, "block"),
        3: ("c.com", "/fr/1", "com/fr/", "allow"), 4: ("d.net", "/q/r", None, "allow"), 5: ("d.net", "/s", None, "allow"),
        6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("d.net", "/t/u", None, "block"), 9: ("org", "", None, "allow"),
        10: ("x.org", "/a", "org/", "allow"), 11: ("y.org", "", None, "allow"), 12: ("example.org", "/es/1", "example.org/es/", "block"),
        13: ("notexample.org", "/es/", "org/", "allow"), 14: ("z.com", "/de/a", "com/de/", "block"),
        15: ("e.net", "/p", None, "allow"), 16: ("f.net", "/old", None, "block"), 17: ("g.com", "/de/9", "com/de/", "block"),
    }
    assert url_rules.judge_urls(pages(spark, [])).count() == 0


def test_a_page_gives_its_canonical_link_and_its_refresh(spark):
    both = "<link rel=canonical href='{}'><meta http-equiv=refresh content='0; url={}'>"
    rows = [
        # Canonical to itself, refresh to a blocked URL; an alias of it; one with two harmless targets.
        (1, "http://a.net/p", both.format("http://a.net/p", "http://g.com/de/1")),
        (2, "http://b.net/q", "<link rel=canonical href='http://a.net/p'>"),
        (3, "http://c.net/r", both.format("/r", "/s")), (4, "http://c.net/s", ""),
        # The canonical link still joins where the refresh is harmless.
        (5, "http://d.net/t", both.format("http://g.com/de/2", "/u")), (6, "http://d.net/u", None),
    ]
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(pages(spark, rows)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "block"}


ROWS = [(5, "http://a/1", "x" * 200), (3, "http://a/2\r\nX: y", "x" * 200), (9, None, "x" * 200), (9, None, "x" * 200), (1, "u", "short"),
        (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "é" * 50), (8, "u", "é" * 50), (11, "u", "<p>\r\n\r\n" * 300_000), (None, "u", "x" * 200)]


def test_archives_round_trip(spark):
    out = warc_bundles.archive_round_trip(spark, pages(spark, ROWS)).collect()
    want = []
    for i, _, html in ROWS:
        body = (html or "").encode()
        first = min((p for p, _, h in ROWS if (h or "") == (html or "") and p is not None), default=None)
        revisit = len(body) >= 100 and i != first
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    H.same([tuple(r) for r in out], want)
    assert warc_bundles.archive_round_trip(spark, pages(spark, [])).count() == 0


def test_frames_are_independent_and_indexed(spark):
    rows = [(i, f"http://a/{i}", f"{i} " * (50 + i)) for i in range(200)]
    index = warc_bundles.write_bundles(pages(spark, rows).coalesce(1), shared_dir(spark, "bundles"), frame_bytes=5_000, bundle_bytes=8_000)
    entries = index.collect()
    assert len({e["bundle"] for e in entries}) > 1 and max(e["frame"] for e in entries) > 2
    for e in random.Random(2).sample(entries, 25):
        record = warc_bundles.read_record(e["bundle"], e["frame"], e["offset"], e["length"])
        assert record.startswith(b"WARC/1.1\r\n") and e["record_id"].encode() in record
        i = int(e["page_id"])
        assert record.endswith(f"{i} ".encode() * (50 + i) + b"\r\n\r\n")
    path = entries[0]["bundle"].removeprefix("file://").removeprefix("file:")
    with open(path, "rb") as file:
        data = file.read()
    assert struct.unpack("<I", data[-4:])[0] == warc_bundles.SEEKABLE
    # A plain reader skips the seek table.
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == sum(e["bundle"] == entries[0]["bundle"] for e in entries)
    back = warc_bundles.read_bundles(index)
    assert back.agg(F.sum("payload_bytes")).first()[0] == sum(len(h) for *_, h in rows)


def test_any_text_may_be_an_identifier(spark, tmp_path):
    rows = [("a:b", "u", "x" * 200), ("a b/%3A", "u", "x" * 200), ("<ü>", "u", "z"), (None, "u", "y")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    index = warc_bundles.write_bundles(df, f"{tmp_path}/plain")
    assert all(r["bundle"].startswith("file:") for r in index.collect())
    got = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc_bundles.read_bundles(index, df.schema["page_id"].dataType).collect()}
    assert got == {("a b/%3A", "response", None), ("a:b", "revisit", "a b/%3A"), ("<ü>", "response", None), (None, "response", None)}


def test_damage_is_noticed(spark):
    index = warc_bundles.write_bundles(pages(spark, [(1, "u", "y" * 500)]), shared_dir(spark, "bundles"))
    wrong = index.withColumn("offset", F.col("offset") + 1)
    with pytest.raises(Exception, match="index is wrong"):
        warc_bundles.read_bundles(wrong).collect()
