"""Main text: markup zones, repeated runs per host, awkward pages."""

import pytest

from tickloom.llm import html_extract as h

PAGES = [
    ("<article><h1>T &amp; t</h1><p>a<br>b</p><p> c\n\td </p></article>", "T & t\n\na b\n\nc d"),
    ("<nav>menu</nav><main><header><h1>H</h1></header><p>x</p><aside>y</aside><footer>z</footer></main><footer>f</footer>", "H\n\nx"),
    ("<article><p>one<p>two<b>bold<br><p>three", "one\n\ntwobold\n\nthree"),
    ("<script>var t='</p><article>no</article>';</script><article>yes</article>", "yes"),
    ("<article>a<!-- <p>no</p> -->b<style>p{}</style>c</article>", "abc"),
    ("<article>&lt;p&gt; &#233;&eacute; &nbsp; &notit; &am &amp</article>", "<p> éé ¬it; &am &"),
    ("<div class='ad banner'>no</div><p>open text</p>", "open text"),
    ("<article><div class=comments><article>no</article></div><p title='a>b'>yes</p></article>", "yes"),
    ("<article><p>x</p><form><p>no</p></form><div class='cookie-notice'>no</div><p hidden>keep</p></article>", "x\n\nkeep"),
    ("<ARTICLE CLASS=main><P>Up</P></ARTICLE><DIV ID=sidebar>no</DIV>", "Up"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></article>", "1\n\n2\n\n3\n\n4"),
    ("plain only", "plain only"),
    ("<p>cut <a href='", "cut"),
    ("<article>a < b and 1<2</article>", "a < b and 1<2"),
    ("<article></article>", ""),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_pages(page, want):
    assert h.main_text(h.blocks(page), set()) == want


def brute_cover(pages):
    """page -> covered token numbers, by comparing all windows of a host."""
    streams = [(host, h.stream(h.blocks(page))) for host, page in pages]
    seen = {}
    for n, (host, parts) in enumerate(streams):
        for tokens, _ in parts:
            for i in range(len(tokens) - h.DEPTH + 1):
                seen.setdefault((host, tuple(tokens[i : i + h.DEPTH])), set()).add(pages[n])
    out = []
    for host, parts in streams:
        covered, start = set(), 0
        for tokens, mine in parts:
            for i in range(len(tokens) - h.DEPTH + 1):
                if any(mine[i : i + h.DEPTH]) and len(seen[host, tuple(tokens[i : i + h.DEPTH])]) > 1:
                    covered |= set(range(start + i, start + i + h.DEPTH))
            start += len(tokens)
        out.append(covered)
    return out


def test_repeated_runs_go_on_pages_without_marked_text(spark):
    notice = "we use cookies to improve your visit please accept them all"
    rows = []
    for i in range(30):
        host = "a.org" if i % 3 else "b.org"
        own = " ".join(f"own{i}x{j}" for j in range(12))
        rows.append((i, f"http://{host}/{i}", f"<div>{notice}</div><p>{own}</p><p>short one</p><div>{notice} and more{i}</div>"))
    rows.append((30, "http://c.org/", f"<div>{notice}</div>"))
    rows.append((30, "http://c.org/", f"<div>{notice}</div>"))  # the same page again is no repeat
    rows.append((31, None, f"<article>{notice}</article>"))
    rows.append((32, None, f"<article>{notice}</article>"))
    rows.append((33, "http://a.org/", None))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS _page", "'t' AS text", "2 AS host")
    out = h.extract(df)
    assert out.columns == ["page_id", "url", "_page", "host", "text"]
    got = sorted((r.page_id, r.text) for r in out.collect())
    cover = brute_cover([((u or "://").split("://")[1].split("/")[0], p) for _, u, p in rows])
    want = sorted((i, h.main_text(h.blocks(p), c)) for (i, _, p), c in zip(rows, cover, strict=True))
    assert got == want
    texts = dict(got)
    assert texts[30] == notice == texts[31] == texts[32] and notice not in texts[1] and "own1x3" in texts[1] and "more1" in texts[1]
    assert h.extract(df.limit(0)).count() == 0


def test_long_page(spark):
    words = " ".join(f"w{i}" for i in range(60_000))
    (row,) = h.extract(spark.createDataFrame([(1, "u", f"<article><p>{words}</p></article>")], "page_id long, url string, html string")).collect()
    assert row.text == words


def test_query(spark):
    import html
    import re

    from tickloom.llm.queries import op10_html

    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op10_html(spark, sf).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", re.sub("<br>", " ", x))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def texts_of(spark, rows):
    return {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_copies_and_chance_phrases_stay(spark):
    import random

    rng = random.Random(3)
    article = "<h1>A title of some words here</h1><p>" + " ".join(f"w{i}" for i in range(80)) + "</p>"
    rows = [(i, "http://copies.org/", f"<nav>menu {i}</nav>{article}") for i in range(4)]
    notice = "this site is run by volunteers and paid for by its many kind readers"
    phrase = "at the end of the day"
    bodies = {}
    for i in range(10, 410):
        words = [f"{rng.choice('abcdef')}{rng.randrange(500)}" for _ in range(40)]
        if i % 2:
            words[20:20] = phrase.split()
        bodies[i] = "The " + " ".join(words)
        rows.append((i, "http://large.org/", f"<nav>home</nav><div>{notice}</div><p>{bodies[i]}</p>"))
    quoted = " ".join(f"q{i}" for i in range(30))
    for i in (12, 14, 16, 18):  # a passage that few pages cite
        bodies[i] += " " + quoted
        rows[i - 6] = (i, "http://large.org/", f"<div>{notice}</div><p>{bodies[i]}</p>")
    got = texts_of(spark, rows)
    plain = "A title of some words here\n\n" + " ".join(f"w{i}" for i in range(80))
    assert [got[i] for i in range(4)] == [plain] * 4
    assert {i: got[i] for i in bodies} == bodies


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>t</title><meta charset=x><body><article>yes</article></body></html>", "yes"),
        ("<head><title>t</title><p>open</p>", "open"),
        ("<head><title>t</title></head><svg><p>no</p></svg><p>open</p>", "open"),
        ("<body class='single comments-open'><article class='reviews'>yes</article></body>", "yes"),
        ("<html class='no-js has-sidebar'><body class='comments-open sidebar' hidden><p>yes</p></body></html>", "yes"),
        ("<form id=aspnet><nav>no</nav><article>yes</article></form>", "yes"),
        ("<body><form action=x><div>open</div></form></body>", "open"),
        ("<div><form><article>yes</article></form><p>no</p></div>", "yes"),
        ("<article title='the hidden valley'>yes</article>", "yes"),
        ("<div class='card hidden md'><article>yes</article></div>", "yes"),
        ("<article data-note='display:none'>yes</article>", "yes"),
        ("<article>yes</article><div style='color:red; DISPLAY : none'><article>no</article></div>", "yes"),
        ("<p>open</p><div hidden>no</div><div aria-hidden=true>no</div><div HIDDEN=''>no</div>", "open"),
        ("<div class='has-sidebar'><p>open</p></div>", "open"),
        ("<div class='site-footer'>no</div><div class='main_nav'>no</div><p>open</p>", "open"),
        ("<div class='comments'><article>yes</article></div>", "yes"),
        ("<p>open</p><div class='comments'>no<article>yes</article></div>", "open\n\nyes"),
        ("<article>yes</article><div id=comments><article>no</article></div>", "yes"),
        ("<p>open</p><div id=comments><article>no</article><article>no</article></div>", "open"),
        ("<p>open</p><ol class='comment-list'><li><article>no</article></ol>", "open"),
        ("<article>yes<ol class='comment-list'><li><article>no</article></ol></article>", "yes"),
        ("<div class=comments-area><article>yes<div class=replies>no</div></article></div>", "yes"),
        ("<div role=main><p>yes</p></div><p>no</p>", "yes"),
    ],
)
def test_wrappers_do_not_lose_the_text(page, want):
    assert h.main_text(h.blocks(page), set()) == want
