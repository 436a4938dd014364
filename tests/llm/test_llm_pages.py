"""Main text of pages: zones, differencing with the nearest URL, order of pages, and edge cases."""

import random

from cabflow.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; T</title><style>p{{}}</style><script>var t="</p><article>";</script></head>
<body><header class="site"><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- <p>no</p> -->
<div id="cookieNotice">We use cookies</div><div class="sidebar"><p>Side</p></div>
<article><h1>Head&nbsp;line {0}</h1><p>One <b>two</b> &lt;3 &#233;<p>Three<br>
 four<aside>aside</aside><form><label>x</label><input></form><div class="ad banner">buy</div>
<table><tr><td>c1<td>c2</table><ul><li>a<li>b</ul><section id="comments"><article class="comment"><p>nice</p></article></section></article>
<footer>&copy; all</footer></body></html>"""


def text(html):
    return pages.main_text(pages.lines(html), [])


def test_article_without_its_frame():
    assert text(PAGE.format(1)) == "Head line 1\nOne two <3 é\nThree four\nc1\nc2\na\nb"
    assert text("<main><p>in main</p><nav>n</nav></main><p>out</p>") == "in main"
    assert text("") == "" and text("plain &amp; simple") == "plain & simple"
    assert text("<p>a<p hidden>b</p><p style='display: none'>c</p><div role=navigation>d</div><p>e") == "a\ne"
    assert text("<article><p>cut off <b>here") == "cut off here"
    assert text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"


def test_shared_lines_go_and_copies_do_not():
    a, b = (pages.lines(f"<p>Welcome to us</p><p>Own text of page {i}, long enough.</p><p>Call now</p>") for i in "ab")
    assert pages.main_text(a, [b]) == "Own text of page a, long enough."
    assert pages.main_text(a, [a]) == pages.main_text(a, [])  # a copy says nothing
    assert pages.main_text(a, [a, b]) == "Own text of page a, long enough."


def test_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        hit = sorted(pages.shared(a, b))
        rest = iter(b)
        assert len(hit) == best[-1][-1] and all(a[i] in rest for i in hit)


def test_pairs_are_the_nearest_urls_of_the_host(spark):
    """Against a brute-force order, over a host with most of the pages."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        host = "hot.example" if i % 3 else f"h{i % 7}.example"
        body = f"<p>Site of {host}</p><p>Body {i} says {rng.random()}</p>" + ("<p>Section line</p>" if i % 2 else "")
        rows.append((i, f"http://{host}/{'ab'[i % 2]}/{rng.randint(0, 50)}?q={i}", body))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    place = lambda u: u.split("://")[1].split("?")[0].split("/", 1)
    order = sorted(rows, key=lambda r: (place(r[1])[0], "/" + place(r[1])[1], str(r[0])))
    assert len(got) == len(rows)
    for k, (i, u, h) in enumerate(order):
        near = []
        for j in (k - 1, k + 1):
            if 0 <= j < len(order) and place(order[j][1])[0] == place(u)[0]:
                p, q = place(u)[1].split("/"), place(order[j][1])[1].split("/")
                n = next((m for m, (x, y) in enumerate(zip(p, q)) if x != y), len(p))
                near.append((-n, len(near), order[j][2]))
        assert got[i] == pages.main_text(pages.lines(h), [pages.lines(x) for *_, x in sorted(near)]), i


def test_edges(spark):
    rows = [(1, None, None, 1), (2, "http://a/x", "", 2), (None, "http://a/x", PAGE.format(2), 3), (3, "http://a/x", PAGE.format(2), 3),
            (3, "http://a/x", PAGE.format(2), 3), (4, "no url at all", "<p>" + "long " * 60_000, 4), (5, "http://[bad", "<<<>>&&&;<p", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = pages.extract(df).collect()
    assert sorted((r.page_id or 0) for r in got) == [0, 1, 2, 3, 3, 4, 5]
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[1].n_chars == 0 and by[4].n_chars == 60_000 * 5 - 1
    assert by[None].text == by[3].text and by[3].n_chars == len(by[3].text)
    assert pages.extract(df.limit(0)).isEmpty()


def test_query_returns_the_article_of_every_page(spark):
    from cabflow.llm.queries import op6_pages

    sf = "/root/testdata/sf0.001"
    rows = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op6_pages(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        inside = rows[r.page_id].html.partition("<article>")[2].partition("</article>")[0]
        assert r.text == text(inside) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url


def test_main_around_an_article_card_is_kept():
    page = "<nav>n</nav><main><h1>Headline</h1><p>First.</p><article><p>Card</p></article><p>Last.</p><aside>x</aside></main><p>out</p>"
    assert text(page) == "Headline\nFirst.\nCard\nLast."
    assert text("<div role=main><h1>Head</h1><article>Text</article></div><footer>f</footer>") == "Head\nText"


def test_neighbours_are_asked_whatever_their_markup(spark):
    """A page without an article loses the menu it shares with pages that have one."""
    menu = "<p>Home of all</p><p>Call us now</p>"
    rows = [(i, f"http://a.example/x/{i}", f"{menu}<article><p>Text of {i}</p></article>") for i in (1, 3)]
    rows += [(2, "http://a.example/x/2", f"{menu}<p>Own text, in no article.</p>")]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "Text of 1", 2: "Own text, in no article.", 3: "Text of 3"}


def test_all_copies_get_one_text(spark):
    """Runs of equal pages, some longer than many buckets, against a brute-force pairing of runs."""
    rng = random.Random(4)
    runs, rows = [], []
    for i in range(24):
        host, path = f"h{i // 8}.example", f"{'ab'[i % 2]}/{i:03d}"
        html = f"<p>Site of {host}</p><p>Body {i} says {rng.random()}</p>" + "<p>Section line</p>" * (i % 2)
        urls = [f"http://{host}/{path}" + f"/{j:03d}" * (i % 3 == 0) for j in range(rng.choice([1, 2, 3, 5, 150]))]
        runs.append((host, path, html, urls))
        rows += [(len(rows) + j, u, f"<!-- {j} -->" * (i % 4 == 0) + html) for j, u in enumerate(urls)]
    rng.shuffle(rows)
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.url) for r in got) == sorted(r[:2] for r in rows)
    texts = {}
    for r in got:
        texts.setdefault(r.url, set()).add(r.text)
    runs.sort(key=lambda r: (r[0], f"/{r[1]}"))
    for k, (host, path, html, urls) in enumerate(runs):
        near = []
        for j in (k - 1, k + 1):
            if 0 <= j < len(runs) and runs[j][0] == host:
                near.append((-(runs[j][1][0] == path[0]), len(near), pages.lines(runs[j][2])))
        want = pages.main_text(pages.lines(html), [n for *_, n in sorted(near, key=lambda x: x[:2])])
        assert {t for u in urls for t in texts[u]} == {want} and "Site of" not in want, k


def test_copies_are_told_by_their_own_lines():
    menu = "".join(f"<p>Menu entry {i} with many more words around it</p>" for i in range(20))
    a, b = (pages.lines(f"{menu}<p>Only {x}.</p>") for x in ("this", "that"))
    assert pages.main_text(a, [b]) == "Only this." and pages.main_text(b, [a, a]) == "Only that."
    whole, stamped = pages.lines("<p>A long text of many words that two pages have.</p>"), pages.lines(
        "<p>A long text of many words that two pages have.</p><p>Copied.</p>"
    )
    for page, other in ((whole, stamped), (stamped, whole), (whole, whole)):
        assert pages.main_text(page, [other]) == pages.main_text(page, [])


def test_embedded_elements_lose_no_text_around_them():
    assert text('<article><h1>T</h1><p>one <svg class="i"/> two</p><p>three</p></article>') == "T\none two\nthree"
    assert text("<article><p>one <svg><path d='M0'/><text>label</text></svg> two</p></article>") == "one two"
    for tag in ("<iframe src=x/>", "<video src=x>", "<object data=x>", "<canvas>", "<select>", "<title>", "<audio src=x>", "<math/>", "<textarea>"):
        assert text(f"<article><p>one</p>{tag}<p>two</p></article>") == "one\ntwo", tag
        name = tag.strip("<>/").split()[0]
        again = f"<article><p>one</p>{tag}<p>two</p><{name}>inner</{name}><p>three</p></article>"
        assert text(again) == "one\ntwo\nthree", tag
    assert text("<p>a</p><video><source src=x><p>Your browser has no video</p></video><p>b</p>") == "a\nb"
    assert text("<p>a</p><script>if (x < '<p>') {}</script><style>p{}</style><p>b</p>") == "a\nb"


def test_names_do_not_decide_about_an_articles_text():
    page = '<article><h1>T</h1><h2 id="search">Search</h2><p class="alert">Mind this.</p><section id="related"><p>Related work</p></section>'
    page += '<p id="share">We share.</p><div class="ads">Buy!</div><section id="comments"><p>Nice</p></section><p>End.</p></article>'
    assert text(page) == "T\nSearch\nMind this.\nRelated work\nWe share.\nEnd."
    assert text('<div class="menu">m</div><h2 id="comments">On comments</h2><p>Text.</p><div id="newsletter">n</div>') == "On comments\nText."


def test_an_article_card_beside_the_text_keeps_the_text():
    page = '<nav>n</nav><div class="content"><h1>Head</h1><p>A long text of the page.</p></div><article><p>card</p></article>'
    assert text(page) == "Head\nA long text of the page.\ncard"
    assert text("<div>Teaser</div><article><p>The article, which is far longer.</p></article>") == "The article, which is far longer."


def test_differencing_decides_on_pages_without_articles(spark):
    """The given pages with neither article nor frame elements: what pages of a host share goes, all else stays."""
    from urllib.parse import urlsplit

    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    rows, want = [], {}
    for r in given:
        inside = r.html.partition("<article>")[2].partition("</article>")[0]
        host = urlsplit(r.url).netloc
        menu = "".join(f"<div><a href=/{i}>{host} section {i}</a></div>" for i in range(4))
        rows.append((r.page_id, r.url, f"<body>{menu}<div>{inside}</div><p>Imprint of {host}</p><p>Read on the same site</p></body>"))
        want[r.page_id] = pages.main_text(pages.lines(f"<article>{inside}</article>"), [])
    alone = {h for h in {urlsplit(u).netloc for _, u, _ in rows} if sum(urlsplit(u).netloc == h for _, u, _ in rows) == 1}
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    decided = 0
    for i, u, _ in rows:
        if urlsplit(u).netloc not in alone:
            decided += got[i] == want[i]
            assert "section 1" not in got[i] and "Imprint of" not in got[i], u
    assert decided >= 0.9 * (len(rows) - len(alone))  # pages with passages that neighbours share lose these
