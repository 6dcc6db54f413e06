from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm.html_text import extract, main_text

SF = "/root/testdata/sf0.01"
P1 = "The first paragraph tells, at some length, what happened; it has marks, and words enough to count."
P2 = "A second one follows it. It is about as long, and no less dull, than the first of the two."


class Article(HTMLParser):
    """The blocks inside <article>, read another way."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [[]]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag == "br":
            self.blocks[-1].append(" ")
        elif tag != "b":
            self.blocks.append([])

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag != "b":
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)

    def text(self):
        return "\n\n".join(t for b in self.blocks if (t := " ".join("".join(b).split())))


def test_query_against_another_reading(spark):
    from riverbend.llm.queries import op9_html
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = op9_html(spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == Article(pages[r.page_id].html).text()


def test_what_is_left_out():
    page = f"""<html><head><title>T</title><script>var a = "<p>x, y.</p>";</script></head><body>
      <header><a href="/">Home, sweet home.</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
      <div class="cookie-notice"><p>We use cookies, as all do. Accept, please, or leave; it is up to you.</p></div>
      <div id="content"><h1>Head &amp; line</h1><p>{P1}</p><div class="ad">Buy, buy, buy!</div><p>{P2}<br>more
      <a href="x">of it</a>, &#8211; end.<ul class="links"><li><a>Other</a></li></ul>
      <div class="comments"><p>I disagree, as always. {P1}</p></div><form>Mail: <input name="m"> Send, now.</form></div>
      <aside>{P2}</aside><footer>(c) us, 2020.</footer></body></html>"""
    assert main_text(page) == f"Head & line\n\n{P1}\n\n{P2} more of it, – end."


def test_articles_of_several_parts():
    page = "<body><nav><a>Home</a></nav>{}<footer>(c) us, 2020.</footer></body>"
    long, short = f"<p>{P1}</p><p>{P2}</p><p>{P1}</p><p>{P2}</p><p>{P1}</p>", f"<p>{P2}</p>"
    body = "\n\n".join([P1, P2, P1, P2, P1])
    for tag in ("article", "main", "div"):
        assert main_text(page.format(f"<{tag}><section>{long}</section><section>{short}</section></{tag}>")) == f"{body}\n\n{P2}"
    assert main_text(page.format(f"<article><h1>A head</h1><div class=intro><p>Intro, short.</p></div><div class=body>{long}</div></article>")) == f"A head\n\nIntro, short.\n\n{body}"
    assert main_text(page.format(f"<div><article>{long}</article><article>{short}</article></div>")) == f"{body}\n\n{P2}"
    assert main_text(page.format(f"<main><h1>A head</h1><article>{long}</article></main>")) == f"A head\n\n{body}"


def test_only_lists_of_links_go():
    page = f"""<article><h2><a>A linked head</a></h2><p>{P1}</p><p><a>Read the report</a></p><p>{P2}</p>
      <ul><li><a>One</a></li><li><a>Two</a></li></ul><div><a>Three</a> <a>Four</a></div><p>{P1}</p><div><a>Five</a></div><div><a>Six</a></div></article>"""
    assert main_text(page) == f"A linked head\n\n{P1}\n\nRead the report\n\n{P2}\n\n{P1}"


def test_wrappers_with_names():
    inner = f"<p>{P1}</p><p>{P2}</p>"
    side = '<div class="sidebar"><p>Aside, short.</p></div><form>Mail, please. <input></form>'
    wrappers = ['<body class="single has-sidebar">{}</body>', '<main id="main-with-menu">{}</main>', '<main><article class="post no-comments">{}</article></main>',
                '<article id="social-policy">{}</article>', '<body><div class="page with-menu">{}</div><footer>Us.</footer></body>', '<body><form id="f">{}</form></body>',
                '<form><div id="nav-open">{}</div></form>', '<html class="nav-closed"><body><div class="post no-comments">{}</div></body></html>']
    for w in wrappers:
        assert main_text(w.format(inner + side)) == f"{P1}\n\n{P2}", w
    replies = f'<div id="comments">{inner}{inner}</div>'
    assert main_text(f"<body><div>{inner}{inner}</div>{replies}</body>") == "\n\n".join([P1, P2] * 2)


def test_odd_pages():
    assert main_text("") == main_text("<p>") == main_text("<script>var x = 1;") == ""
    assert main_text("just text, no tags.") == "just text, no tags."
    assert main_text(f"<body><p>{P1}<p><b>{P2}") == f"{P1}\n\n{P2}"
    assert main_text(f"<div><p title='a > b'>{P1}</p><!-- <p>no</p> --><p>1 < 2, {P2}") == f"{P1}\n\n1 < 2, {P2}"
    deep = "<div>" * 3000 + P1
    assert main_text(deep) == P1


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>/abp &#;\"'=!-x\n", max_size=120))
def test_any_page_gives_a_text(page):
    assert isinstance(main_text(page), str)


def test_small_tables(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", f"<p>{P1}</p>", "t"), (2, None, "", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, len(P1)), (1, 0), (2, 0), (2, 0)]
    assert extract(df.limit(0)).count() == 0


def test_names_cut_no_headings_sections_or_parts_of_names():
    inner = f"<p>{P1}</p><p>{P2}</p><p>{P1}</p>"
    keep = ['<h2 id="related-work">Related work</h2>', '<h2 id="search">Related work</h2>', '<section class="share-prices"><p>Related work</p></section>',
            '<section id="social-history"><p>Related work</p></section>', '<p class="ad-free">Related work</p>', '<p id="ad">Related work</p>',
            '<section id="search"><p>Related work</p></section>', '<div class="has-comments"><p>Related work</p></div>']
    for tag in ("article", "main"):
        for part in keep:
            assert main_text(f"<body><{tag}>{inner}{part}<p>{P2}</p></{tag}></body>") == f"{P1}\n\n{P2}\n\n{P1}\n\nRelated work\n\n{P2}", part
        for part in ('<div class="share-buttons">Share, now.</div>', '<section id="comments"><p>No, no.</p></section>', '<div class="ad-box"><p>Buy.</p></div>',
                     '<div id="related-posts">More.</div>', '<p class="advert">Buy.</p>', '<div class="cookie_notice">Yes.</div>', '<header hidden>Head.</header>'):
            assert main_text(f"<body><{tag}>{inner}{part}</{tag}></body>") == f"{P1}\n\n{P2}\n\n{P1}", part


def test_references_stay():
    refs = "<ol><li><a href=1>Smith and Jones</a></li><li><a href=2>The other book</a></li></ol>"
    assert main_text(f"<article><p>{P1}</p><p>{P2}</p>{refs}</article>") == f"{P1}\n\n{P2}\n\nSmith and Jones\n\nThe other book"


def test_a_page_of_divs_loses_banner_and_foot():
    body = "".join(f"<p>{P1 if i % 2 else P2}</p>" for i in range(30))
    page = f"<body><div>My site</div><div><h1>A head</h1>{body}</div><div>Copyright 2020 by us</div><div>Posted in: <a>News</a></div></body>"
    assert main_text(page) == "A head\n\n" + "\n\n".join(P1 if i % 2 else P2 for i in range(30))


def test_deep_pages_take_linear_time():
    import time
    pages = ["<div>" * 100_000 + P1, "<div>x, " * 50_000, "<b>" * 100_000 + P1, "<div></p>" * 50_000, "<p><div>" + "<center>x" * 50_000, "<b><div>" + "<i>" * 50_000 + "</b>" * 50_000,
             "<div class=ad>x" * 50_000, "<p>" + "<section><p>x." * 30_000, "<a <" * 30_000, "<ul><li>x" * 30_000]
    for page in pages:
        began = time.perf_counter()
        assert isinstance(main_text(page), str)
        assert time.perf_counter() - began < 8, page[:20]
