import random
import re
import time
import tracemalloc

import pytest

from opinara.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Home</a></li><li>About</li></ul></nav><!-- ad --><div class="ad">Buy &amp; now, please do.</div>
<article><h1>Head &amp; line</h1><p><b>First   part&nbsp;of it.<br><p>Second <i>one</i>, with &eacute; and &#x41;.</p>
<aside>Related things to read.</aside><ul><li>item one<li>item two</ul><form><p>Subscribe here</p></form></article>
<section id="comments"><p>Reader says: a very long comment, longer than all else on the page. It goes on, and on, and on.</p></section>
<footer>&copy; us</footer></body></html>"""


def text_of(page, winners=()):
    return html_extract.article(html_extract.parse(page), winners)


def test_article_without_its_surroundings():
    assert text_of(PAGE) == "Head & line\nFirst part of it.\nSecond one, with é and A.\nitem one\nitem two"


def test_winning_path_decides_and_missing_ones_do_not_matter():
    page = "<body><div class=post7>" + "<p>short text.</p></div><div class='big'><p>a much longer text, with more of it.</p></div>"
    assert text_of(page) == "a much longer text, with more of it."
    assert text_of(page, ["body/div.none", "body/div.post"]) == "short text."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain words only", "plain words only"),
        ("<p>one<p>two", "one\ntwo"),
        (" \n<!-- nothing --> ", ""),
        ("<!DOCTYPE html><title>T</title><h1>Big news</h1><p>First, one.</p><p>Second.</p>", "Big news\nFirst, one.\nSecond."),
        ("<html><head><title>T</title></head><h1>Big news</h1><p>First, one.</p>", "Big news\nFirst, one."),
        ("<html><head><meta charset=utf-8><body><article><header><h1>T</h1></header><p>Some text.</p></article>", "T\nSome text."),
        ("<html><head><title>x</title><p>No end of the head.</p><header>top</header>", "No end of the head."),
        ("<body><article><p>Start, of it.</p><section class='related-work'><p>" + "Others did, too. " * 30 + "</p></section></article>", "Start, of it.\n" + " ".join(["Others did, too."] * 30)),
        ("<body><article><p>Start, of it.</p><div class='related-posts'><p><a href=x>" + "Others did, too. " * 30 + "</a></p></div></article>", "Start, of it."),
        ("<body><article><p>Start, of it. It goes on.</p><div class='sidebar'><p>Others.</p></div></article>", "Start, of it. It goes on."),
        ("<body><div>loose text<br>next line</div>", "loose text\nnext line"),
        ("<body><main><p>cut off <b>he", "cut off he"),
        ("<body><main><p>cut off <a href='x", "cut off"),
        ("<body><main><p>a < b and c > d</p></main>", "a < b and c > d"),
        ("<body><main><p title='x>y'>quoted</p></main>", "quoted"),
        ('<body><main><p title="broken>still here</p><p>end</p></main>', "still here\nend"),
        ("<body><div class='post-comments'><p>nice post</p></div><div id=content><p>real</p></div>", "real"),
        ("<body><main><div style='display: none'><p>hidden</p></div><p>seen</p></main>", "seen"),
        ("<body><article><header><h1>Title</h1><p>by me</p></header><p>Body.</p></article>", "Title\nBody."),
        ("<body><main><p>x &lt;tag&gt; &am</p><table><tr><td>a<td>b<tr><td>c</table></main>", "x <tag> &am\na\nb\nc"),
        ("<body><main><p>" + "deep " * 3 + "<span>" * 3000 + "text</p></main>", "deep deep deep text"),
        ("<body><div class='has-sidebar'><div class=entry><p>Text of it, long enough.</p></div><div class=sidebar><p>x y</p></div></div>", "Text of it, long enough."),
        ("<body><div class=entry><p>Short.</p></div><div class=comments><article><p>A long, long, long remark, longer by far.</p></article></div>", "Short."),
        ("<body>" + "<div>" * 2000 + "<p>inner text, far down.</p>", "inner text, far down."),
    ],
)
def test_odd_pages(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "far down", "<div><p>" * 20_000 + "far down", "<ul><li>" * 20_000 + "far down", "<body>" + "</p></div>" * 50_000 + "far down"])
def test_deep_pages_take_linear_time_and_memory(page):
    tracemalloc.start()
    began = time.perf_counter()
    assert text_of(page) == "far down"
    assert time.perf_counter() - began < 20 and tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def plain_winners(pages):
    """Votes of each host added up page by page."""
    votes = {}
    for url, page in pages:
        host = re.match(r"[a-z]+://([^/:]+)", url.lower())[1]
        for path, share in html_extract.ballot(html_extract.parse(page)):
            own = votes.setdefault(host, {})
            own[path] = own.get(path, 0) + share
    winners = {}
    for host, own in votes.items():
        kept = [p for p, v in own.items() if v >= 0.15 * max(own.values()) and v >= 0.01 * sum(own.values())]
        winners[host] = sorted(kept, key=lambda p: (-round(own[p], 6), -len(p), p))
    return winners


def test_extraction_equals_plain_voting(spark):
    rng = random.Random(4)
    words = "some words of a page and more of them, as they come. Then again, others.".split()
    rows = []
    for i in range(240):
        parts = [f"<div class='{rng.choice(['story', 'box', 'tail'])}{i}'><p>{' '.join(rng.choices(words, k=rng.randrange(1, 40)))}</p></div>" for _ in range(3)]
        own = f"<div class='{''.join(rng.choices('abcdefgh', k=6))}'>" if i % 3 == 0 else "<div>"  # a hot host whose paths all differ
        rows.append((f"http://{'hot' if i % 3 == 0 else rng.choice('ab')}.example/{i}", f"<body>{own}{''.join(parts)}</div></body>"))
    winners = plain_winners(rows)
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(5)
    found = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for i, (url, page) in enumerate(rows):
        assert found[i] == text_of(page, winners[url.split("/")[2]])
    assert max(map(len, winners.values())) <= 100


def test_consensus_of_a_host(spark):
    good = "<body><div class='story{0}'><p>Some text of page {0}, long enough, well.</p></div><div class='box'><p>{1}</p></div></body>"
    rows = [(i, "http://a.example/x", good.format(i, "tiny")) for i in range(8)]
    odd = good.format(9, "This box is much longer than the story, so alone it would win, wouldn't it, here and now.")
    rows += [(9, "https://A.example:80/y", odd), (10, None, odd), (11, "nonsense", odd), (12, "http://a.example/", None), (13, None, ""), (9, "https://A.example:80/y", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    assert found[9] == found[3].replace("3", "9") == "Some text of page 9, long enough, well."
    assert found[10] == found[11] and found[10].startswith("This box")
    assert found[12] == found[13] == ""
    assert html_extract.extract(pages).count() == len(rows)
    assert html_extract.extract(pages.limit(0)).count() == 0
    clash = pages.withColumnsRenamed({"page_id": "text"}).withColumns({"host": pages.url, "votes": pages.url, "path": pages.url})
    assert html_extract.extract(clash, text="body").columns == [*clash.columns, "body"]
