"""Main text of pages and web archives."""

import base64
import hashlib
import html
import random
import re
from collections import Counter

import pytest

from punctua.llm import html_tree, warc
from punctua.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return html_tree.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def article_text(source):
    """The blocks of the article element, for pages of simple markup."""
    found = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)
    blocks = re.split(r"</?p>|</?h1>", re.sub(r"<[^>]*$", "", found[1])) if found else []
    plain = [re.sub(r"[ \t-\r]+", " ", html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " ")))).strip(" ") for b in blocks]
    return "\n".join(b for b in plain if b)


def test_articles_of_the_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op4_html_main_text"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    wrong = [r.page_id for r in got if r.text != article_text(pages[r.page_id].html)]
    assert not wrong and all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got)


BODY = "<h1>Head line</h1><p>The first paragraph is long enough to be a text. It goes on &amp; on.</p><ul><li>one item</li><li>two item</li></ul><p>The last paragraph\n of the\tpage.</p>"
TEXT = "Head line\nThe first paragraph is long enough to be a text. It goes on & on.\none item\ntwo item\nThe last paragraph of the page."
PAGES = {
    "article": f"<html><body><nav><a href=x>Home</a></nav><article>{BODY}</article><footer><p>&copy; us</p></footer></body></html>",
    "main": f"<header><p>Logo</p></header><main>{BODY}</main><aside><p>Related stories for you.</p></aside>",
    "classes": f"<body><div class='topbar'>Site name</div><div id='menu'><ul><li><a href=x>Home</a></li></ul></div><div class='cookie-notice'><p>We use cookies on this site.</p></div><div class='content'>{BODY}</div><div class='sidebar'><p>Read this too.</p></div><div id='comments'><div class='comment'><p>Nice words, I like them very much.</p></div></div><form><label>Mail</label><input><button>Go</button></form></body>",
    "advert inside": f"<article>{BODY.replace('<ul>', '<div class=ad>Buy this now and save a lot.</div><ul>')}</article>",
    "cut off": f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=a>a</a></li></ul></nav><article>{BODY}<footer",
    "scripts": f"<body><script>var t='</p><p>no</p>';</script><article>{BODY}<script>if (a < b) c();</script></article><noscript>no</noscript>",
}


@pytest.mark.parametrize("name", PAGES)
def test_page_forms(model, name):
    assert html_tree.extract(PAGES[name], model) == TEXT


UNCLOSED = {
    "body ends head": f"<html><head><title>t</title><body><article>{BODY}</article>",
    "block ends head": f"<head><meta charset=utf-8><title>t</title><style>p{{}}</style><article>{BODY}</article>",
    "text ends head": f"<head><title>t</title> \n Words <article>{BODY}</article>",
    "noscript in head": f"<head><noscript><style>p{{}}</style><body><article>{BODY}</article>",
    **{f"{tag} in article": f"<body><article>{BODY.replace('<ul>', f'<{tag}>hidden words<ul>')}</article>" for tag in ("button", "select", "object", "svg", "video", "noscript")},
    "option": f"<body><select><option>a<option>b<article>{BODY}</article>",
    "next one is closed": f"<body><button>Go<article>{BODY}</article><button>Go</button>",
    "closed with its ancestor": f"<body><div><object>no</div><article>{BODY}</article>",
}


@pytest.mark.parametrize("name", UNCLOSED)
def test_unseen_elements_left_open(model, name):
    text = html_tree.extract(UNCLOSED[name], model)
    assert text.removeprefix("Words\n") == TEXT and "hidden" not in text


def test_closed_unseen_elements_keep_their_blocks(model):
    page = f"<body><article>{BODY}<button><div>Label</div></button><object><object>x</object><p>Instead</p></object><select><option>a</select></article>"
    assert html_tree.extract(page, model) == TEXT


def test_pages_that_break_parsers(spark, model):
    deep = "<div>" * 30_000 + "x" + "</div>" * 10
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<p"), (2, "u", deep), (3, "u", "<a href='" * 2000), (4, "u", "<!-- open"), (5, "u", "</p></div>&#x;&bogus;<<>>"), (6, "u", "<article>" + "<p>word. </p>" * 20_000 + "</article>")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = html_tree.main_texts(frame, model).collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    assert [r.text.count("word.") for r in got if r.page_id == 6] == [20_000]
    assert html_tree.main_texts(frame.limit(0), model).count() == 0
    assert html_tree.fit(frame.limit(0)).evidence == {}


def test_marginals_equal_all_labelings():
    import itertools

    draw = random.Random(3)
    nodes = [html_tree.Node("#page", -1), html_tree.Node("body", 0)]
    nodes += [html_tree.Node(draw.choice("pqr"), draw.randrange(1, k)) for k in range(2, 9)]
    page = html_tree.Page(nodes)
    model = html_tree.TreeModel({f"tag={t}": draw.uniform(-2, 2) for t in ("#page", "body", "p", "q", "r")}, 0.4, ((0.9, 0.1), (0.25, 0.75)))
    top = 1 / (1 + 2.718281828459045**-0.4)
    total, share = 0.0, [0.0] * len(nodes)
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        w = 1.0
        for k, y in enumerate(labels):
            p = 1 / (1 + 2.718281828459045 ** -model.evidence[f"tag={nodes[k].tag}"])
            w *= p if y else 1 - p
            parent = nodes[k].parent
            w *= (top if y else 1 - top) if parent < 0 or html_tree._free(nodes[parent]) else model.follow[labels[parent]][y]
        total += w
        for k, y in enumerate(labels):
            share[k] += w * y
    got = model.marginals(page)
    assert all(abs(a - b / total) < 1e-9 for a, b in zip(got, share))


def test_archive_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    rows = [(k, f"http://a/{k}", chr(97 + k % 26) * size) for k, size in enumerate([10] * 600 + [40_000 + j for j in range(60)] + [300_000 + j for j in range(8)] + [3_000_000, 0])]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    warc.write(frame, str(tmp_path / "files"))
    files = [f.read_bytes() for f in (tmp_path / "files").glob("part-*")]
    found = [list(warc.parse(content)) for content in files]
    assert all(len(content) <= 1 << 20 or len(own) == 1 for content, own in zip(files, found))
    assert sorted(r[2] for own in found for r in own if r[5] == "response") == sorted({html: k for k, _, html in reversed(rows)}.values())
    assert sum(map(len, found)) == len(rows)
    assert len(warc.archive(frame).select("page_id").distinct().collect()) == len(rows)


def test_archive_round_trip(spark):
    trap = "<p>WARC/1.1\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n\n"
    rows = [(k, f"http://www.Site{k % 3}.com:80/p?q={k % 5}#f", f"page {k % 40} ä") for k in range(300)]
    rows += [(1000, "http://a/x y\r\n", trap), (1001, None, trap), (1002, "u", None), (1003, "u", ""), (None, "u", trap), (None, "v", "only null"), (1004, "v", "z" * 300_000), (1004, "v", "z" * 300_000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS digest", "2 AS value", "3 AS again")
    got = warc.archive(frame).collect()
    first = {}
    for k, _, body in rows:
        if k is not None:
            first[body or ""] = min(first.get(body or "", k), k)
    want = Counter()
    for k, _, body in rows:
        body = body or ""
        again = body in first and first[body] != k
        digest = base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        want[k, len(body.encode()), digest, "revisit" if again else "response", first[body] if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    got.sort(key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    keys = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    assert warc.archive(frame.limit(0)).count() == 0


def test_small_payloads_are_not_referred_to(spark):
    frame = spark.createDataFrame([(1, "u", "short"), (2, "u", "short"), (3, "u", "long enough"), (4, "u", "long enough")], "page_id bigint, url string, html string")
    kinds = {re.search(r"urn:x-page:(\d+)", r.value)[1]: re.search(r"WARC-Type: (\w+)", r.value)[1] for r in warc.records(frame, least=6).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_loser_tree():
    draw = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        lists = [sorted((draw.randrange(30),) for _ in range(draw.randrange(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(lists, lambda r: r)) == sorted(sum(lists, []))


def test_url_keys():
    assert warc.url_key("https://user@www2.Blog.Example.com:443/A/b?q=1#top") == "com,example,blog)/A/b?q=1"
    assert warc.url_key("http://example.com?x") == "com,example)/?x"
    assert warc.url_key("") == ")/"
