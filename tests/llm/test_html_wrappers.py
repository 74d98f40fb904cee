"""Main-text extraction: planted pages of several templates."""

import html
import random

from rivulet.llm import html_wrappers as H

WORDS = "alpha beta gamma délta & <tag> \"q\" 5 € ok".split()


def page(rng, template, k):
    paras = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(4, 30))) for _ in range(rng.randint(1, 6))]
    esc = [html.escape(p).replace(" ", rng.choice([" ", "\n  ", "&nbsp;" if False else " "])) for p in paras]
    menu = "".join(f'<li><a href="/{i}">menu {i}</a></li>' for i in range(rng.randint(2, 7)))
    junk = f"<nav><ul>{menu}</ul></nav><!-- ad {k} --><div class='ad'>buy now {k}</div>"
    tail = f"<div class=\"comments\"><article><p>comment {k}</p></article></div>" if k % 2 else ""
    if template == 0:  # marked article, sloppy markup
        body = f"{junk}<article><h1>Head {k}</h1><p><b>{'</p><p>'.join(esc)}<br></article>{tail}<footer>&copy; x</footer>"
        want = [f"Head {k}", *paras]
    elif template == 1:  # plain divs
        body = (f"<div id='top-menu'>{menu}</div><div id='wrap'><div class='side sidebar'><p>side {k}</p></div>"
                f"<div id='text'>{''.join(f'<p>{p}</p>' for p in esc)}<form><input><p>send</p></form></div></div>"
                f"<div class='footer'>f</div>")
        want = paras
    else:  # marked by class, with a script and a cookie notice in the article
        body = (f"{junk}<div class=\"post entry-content x{k}\"><script>var t='<p>no</p>';</script><style>p{{}}</style>"
                f"{''.join(f'<p>{p}</p>' for p in esc)}<div class=\"cookie-notice\">we use cookies</div>"
                f"<ul><li>one<li>two &#65;&amp;amp;</ul><table><tr><td>c1<td>c2</table></div>")
        want = [*paras, "one", "two A&amp;", "c1", "c2"]
    head = "<!DOCTYPE html><html><head><title>t</title></head><body>"
    return head + body + ("</body></html>" if rng.random() < 0.8 else ""), "\n".join(" ".join(w.split()) for w in want)


def test_planted_pages(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(120):
        t = i % 3
        h, w = page(rng, t, i)
        rows.append((i, f"https://u@host{t}.example.com:80/p/{i}?q", h, "x", "y"))
        want[i] = w
    rows += [(500, "http://host0.example.com/", None, "x", "y"), (501, None, "", "x", "y"), (502, "odd", "plain text", "x", "y"),
             (503, None, "<p>only <b>this", "x", "y"), (504, "http://deep.example.com/", "<div>" * 5000 + "deep" + "</div>" * 3, "x", "y"),
             (505, "http://quote.example.com/", '<a title="un>' * 300 + "q</a>", "x", "y")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, path string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert len(got) == len(rows)
    for i, w in want.items():
        assert got[i] == w, i
    assert [got[k] for k in (500, 501, 502, 503, 504)] == ["", "", "plain text", "only this", "deep"]


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a/", "<article><p>x</article>")] * 3, "page_id bigint, url string, html string")
    assert [r.text for r in H.extract(df).collect()] == ["x"] * 3
    assert H.extract(df.limit(0)).collect() == []


def test_templates_of_one_host(spark):
    """Copies of one page, and a rare template whose place of the article holds a teaser."""
    def usual(k):
        return f"<html><body><div class='content'>{f'<p>usual text number {k} of many words</p>' * 8}</div></body></html>"

    def rare(k, teaser):
        return (f"<html><body><div class='content'>{teaser}</div><div class='long'>"
                f"{f'<p>rare article {k} with quite a lot of words</p>' * 9}</div></body></html>")

    rows = [(i, "http://one.org/x", usual(0 if i < 40 else i)) for i in range(200)]
    rows += [(1000 + i, "http://one.org/y", rare(i, "<p>read on</p>" if i % 2 else "")) for i in range(5)]
    # the same containers, but this page has its text elsewhere
    rows += [(2000 + i, "http://two.org/y", "<body><div class='content'>" + "<p>text here</p>" * 40 + "</div><div class='b'>x</div></body>")
             for i in range(70)]
    rows += [(3000, "http://two.org/z", "<body><div class='content'>teaser</div><div class='b'>" + "<p>all is here</p>" * 9 + "</div></body>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for fan in (64, 4):
        got = {r.page_id: r.text for r in H.extract(df, fan=fan).collect()}
        assert len(got) == len(rows)
        assert all(got[i] == "\n".join([f"usual text number {0 if i < 40 else i} of many words"] * 8) for i in range(200))
        assert all(got[1000 + i] == "\n".join([f"rare article {i} with quite a lot of words"] * 9) for i in range(5))
        assert got[3000] == "\n".join(["all is here"] * 9)
    signs = {H.signature(H.page_items(h)) for _, u, h in rows if "one.org" in u}
    assert len(signs) == 2
    distinct = H.marked_pages(df, "page_id", "url", "html").where("host = 'one.org' AND items IS NOT NULL")
    assert distinct.select("items").distinct().count() == 1 + 160 + 5


def test_article_among_very_many_children(spark):
    tags = ("p", "div", "h2", "section", "ul", "pre", "h3")

    def wide(k, article):  # siblings that do not fold, unlabelled
        junk = [f"<{t}>remark {k} {i}</{t}>" for i in range(700) for t in (tags[i * i % 7 - (i % 3)],)]
        return f"<body>{''.join(junk[:350])}{article}{''.join(junk[350:])}</body>"

    rows = [(i, f"http://h{i % 3}.org/", wide(i, f"<article><p>it is {i}</p></article>")) for i in range(7)]  # the third host: two
    rows += [(10, "http://lone.org/", wide(10, "<div><div class='entry-content'><p>it is 10</p></div></div>")),
             (11, "http://rows.org/", "<body>" + "<p>row</p>" * 3000 + "<main>it is 11</main></body>")]
    assert len(H.page_items(wide(0, ""))[0][3]) < 10
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in H.extract(df).collect()} == {i: f"it is {i}" for i, _, _ in rows}


def test_wrapper_is_a_union_free_expression():
    pages = ["<html><body><ul><li>a</li><li>b</li></ul><article><h1>A</h1><p>x</p></article><footer>f</footer></body></html>",
             "<html><body><ul><li>a</li></ul><article><h1>B</h1><p>y</p><p>z</p><hr></article><footer>f</footer></body></html>"]
    w, path = H.infer(pages)
    assert path == ["html", "body", "article"]
    assert "(<p>#slot</p>)+" in w and "(<hr></hr>)?" in w and "<h1>#slot</h1>" in w and '<footer>"f"</footer>' in w


def test_unlabelled_furniture_goes_by_the_wrapper(spark):
    """Menus, notices and links without a telling name, in one container with
    an article that nothing marks: a page alone cannot tell them, the template
    can."""
    def article(k, n):
        return [f"page {k} paragraph {i} says this" for i in range(n)]

    def html_of(k, n):
        text = "".join(f"<p>{t}</p>" for t in article(k, n))
        return (f"<html><body><div class='z1'><a href=/a>Start</a><a href=/b>Fruit</a><a href=/c>Trees</a></div>"
                f"<div class='zz'><div class='q'><span>You read this for free</span></div><h1>Title {k}</h1>{text}"
                f"<ul class='k'><li>Print it</li><li>Send it on</li><li>Keep it</li></ul><p>Written <i>by {k}</i></p>"
                f"<p>{'same end' if k % 2 else 'other end'}</p></div></body></html>")

    want = lambda k, n: "\n".join([f"Title {k}", *article(k, n), f"Written by {k}", "same end" if k % 2 else "other end"])
    rows = [(k, "http://many.org/p", html_of(k, 1 + k % 4)) for k in range(20)]
    rows += [(100 + k, "http://few.org/p", html_of(k, 2)) for k in range(H.MIN_PAGES - 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for fan in (64, 3):
        got = {r.page_id: r.text for r in H.extract(df, fan=fan).collect()}
        for k in range(20):
            assert got[k] == want(k, 1 + k % 4)
            alone = H.read(html_of(k, 1 + k % 4), H.article_path(H.page_items(html_of(k, 1 + k % 4))))
            assert "You read this for free" in alone and "Send it on" in alone  # the page's own rule keeps them
    # too few pages to know: all texts stay
    assert all("Keep it" in got[100 + k] and f"Title {k}" in got[100 + k] for k in range(H.MIN_PAGES - 1))


def test_time_per_byte_is_flat_on_broken_markup():
    import time
    for bit in ('<a "', '<b x="y" ', "<b x='y ", "<div>", "<div><span>", "<", "</span>", "<ul><li>y", '<i a="">', "<!-- ",
                "<table><tr><td>", "<span><div></span>", "<! ", "<script>", "<b><i>x", "<p>x"):
        took = []
        for n in (150_000, 900_000):
            page = bit * (n // len(bit))
            t = time.process_time()
            H.page_items(page)
            H.read(page, [])
            took.append(time.process_time() - t)
        assert took[1] < 6 * 2.5 * took[0] + 0.5, (bit, took)  # linear: six times


def test_quotes_in_tags():
    text = lambda p: H.read(p, [])
    assert text('<p title="a > b">x</p>') == "x"
    assert text("<p title='it is > \"b'>x</p><p>y") == "x\ny"
    assert text('<p title="open>x</p><p>y</p>') == "x\ny"  # closed only after the next tag begins
    assert text('a < b <p>c 1<2</p> <') == "a < b\nc 1<2\n<"
    assert text("x<script>if (a < b) '</p>'</script>y<SCRIPT >z") == "xy"


def test_whole_table(spark):
    """Against the page templates of the table: paragraphs of the article."""
    import re
    from rivulet.llm.queries import QUERIES
    from tests.conftest import SF_SMALL
    got = {r.page_id: r for r in QUERIES["op9_html_wrappers"](spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        want = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in want if x)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)
