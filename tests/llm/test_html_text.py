"""HTML extraction: boilerplate parts go, article text stays, broken markup, edges."""

import pytest

from tidewater.llm import html_text as h

TREE = h.train()
PAGE = """<!DOCTYPE html><html><head><title>Not &amp; this</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header class="site"><h1>Site</h1><nav><ul><li><a href="/a">Home</a></li></ul></nav></header>
<div class="cookie-notice">We use cookies on this site for a great many reasons, all of them good.</div>
<article><h1>Title &amp; more</h1><p><b>First&nbsp;para with <a href="x">a link</a>.<br><p>Second
   line &lt;b&gt; &eacute;&#233;<!-- hidden -->end<div class="ad">Buy the best of the best products here now</div>
<section id="comments"><h2>Comments</h2><p>A long reader comment about all that was said above, at length.</p></section></article>
<aside>Some side text that is long enough to look like text of the article itself</aside>
<form><label>Name</label><input value="x"><p>Sign up for our letter, which comes once a week by mail</p></form>
<footer>&copy; site &middot; A footer sentence of some length stands here.</footer></body></html>"""


def test_article_only():
    assert h.main_text(PAGE, TREE) == "Title & more\nFirst para with a link.\nSecond line <b> éé" + "end"


def test_training_table_is_learned():
    table = h.examples()
    assert all(h.classify(TREE, r[:-1]) == bool(r[-1]) for r in table)


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<article><p>One<p>Two", "One\nTwo"), ("<article>a<b>b</b>c</article>", "abc"),
    ("<nav><a href=x>Home</a><article><p>Text that stands in an unclosed menu</p></article>", "Text that stands in an unclosed menu"),
    ("<article><p>kept</p><script>never ends <p>no", "kept"), ("<article><p>kept</p><!-- never ends <p>no", "kept"),
    ("<article><p>a < b and c > d</p></article>", "a < b and c > d"), ("<article></div></p>x</article>", "x"),
    ("<ARTICLE><P CLASS='x'>Upper</P></ARTICLE>", "Upper"), ("<article><p title=\"a>b\">quoted</p></article>", "quoted"),
])
def test_markup(page, want):
    assert h.main_text(page, TREE) == want


def test_page_without_article():
    text = "A sentence of the page that has no article part but is long enough to be read as text. " * 4
    page = f"<body><div id=menu><a href=1>Home</a> <a href=2>About</a></div><h1>Big news today</h1><p>{text}</p><p>Short one.</p><p>{text}</p><div class=footer>Copyright</div>"
    assert h.main_text(page, TREE) == "\n".join(["Big news today", text.strip(), "Short one.", text.strip()])


def test_long_and_hostile_pages_end_soon():
    assert len(h.main_text("<article><p>" + "word " * 400000 + "</p></article>", TREE)) == 5 * 400000 - 1
    assert h.main_text("<a href=\"x" * 20000, TREE) is not None
    assert h.main_text("<div>" * 50000 + "x", TREE) is not None


def test_operator(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "<article><p>hi</p></article>", "x"), (1, "u", PAGE, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = h.extract(df).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got) == sorted((i or 0, u or "", len(h.main_text(p, TREE))) for i, u, p, _ in rows)
    assert all(r.n_chars == len(r.text) for r in got) and h.extract(df.limit(0)).count() == 0


LONG = "A sentence of the page that is long enough to be read as text of its own by any reader. " * 4


@pytest.mark.parametrize("part", ['<div class="sidebar-content"><p>Side text here</p></div>', '<div class="footer-main">Some words</div>',
                                  '<aside class="entry"><p>Side text here</p></aside>'])
def test_boilerplate_is_no_main_part(part):
    assert h.main_text(f"<body><div><p>{LONG}</p><p>{LONG}</p></div>{part}</body>", TREE) == "\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize("name", ["page has-sidebar", "with-comments", "no-ads", "sticky-header-layout", "sidebar"])
def test_wrapper_names_leave_the_article(name):
    assert h.main_text(f'<div class="{name}"><nav>Menu here</nav><article><h1>Title</h1><p>{LONG}</p></article></div>', TREE) == f"Title\n{LONG.strip()}"


@pytest.mark.parametrize("name", ["page has-sidebar", "with-comments", "no-ads", "sticky-header-layout"])
def test_wrapper_names_leave_plain_pages(name):
    assert h.main_text(f'<div class="{name}"><p>{LONG}</p></div>', TREE) == LONG.strip()


def test_articles_inside_boilerplate_stay_out():
    page = (f'<article><p>{LONG}</p><div id="comments"><article><p>{LONG} one</p></article></div></article><nav><div><article>x</article></div></nav>'
            f'<div id="comments"><article class="comment-body"><p>{LONG} two</p></article></div><aside><article><p>{LONG} three</p></article></aside>')
    assert h.main_text(page, TREE) == LONG.strip()


SENTENCE = "A sentence of the article that says something about its subject. "


@pytest.mark.parametrize("inside, want", [
    ('<p>{s}</p><p><a href="x">One linked paragraph of it</a></p><p>{s}</p>', "{s}\nOne linked paragraph of it\n{s}"),
    ('<ul><li>{s}</li><li><a href="x">A linked item</a></li><li>{s}</li></ul>', "{s}\nA linked item\n{s}"),
    ('<p>{s}</p><ul><li><a href=1>Tag one</a></li><li><a href=2>Tag two</a></li><li><a href=3>Tag three</a></li></ul>', "{s}"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", "so x=1 holds"), ("<p>{s}</p><noscript><p>{s}</p></noscript>", "{s}\n{s}"),
    ("<p>press <button>Start</button> to begin</p>", "press Start to begin"), ("<p>{s}</p><button>Subscribe</button>", "{s}"),
    *[(f'<section class="{n}"><h2>Part</h2><p>{{s}}</p></section>', "Part\n{s}") for n in
      ("legal-background", "discussion-of-results", "form-of-government", "social-history", "hidden-gems", "entry-header")],
    *[(f'<p>{{s}}</p><section class="{n}"><p>{{s}} more</p></section>', "{s}") for n in
      ("comment-list", "related-posts", "cookie-notice", "ad-728x90", "newsletter_signup", "social-share-buttons", "comments", "widget-12")],
])
def test_parts_of_an_article(inside, want):
    page = f"<body><nav><a href=x>Home</a></nav><article>{inside.replace('{s}', SENTENCE)}</article></body>"
    assert h.main_text(page, TREE) == want.replace("{s}", SENTENCE.strip())


def test_only_the_first_article_is_free_of_marks():
    page = f'<div id="thread"><article><p>{LONG}</p></article><article><p>{LONG} a reply</p></article></div>'
    assert h.main_text(page, TREE) == LONG.strip()
    other = f'<article><p>{LONG}</p></article><div id="thread"><article><p>{LONG} a reply</p></article></div>'
    assert h.main_text(other, TREE) == LONG.strip()


def test_given_pages_against_a_plain_reader():
    """The driver's pages mark every part by its element or the name ``ad``: a tree walk with ``html.parser`` reads them."""
    from html.parser import HTMLParser

    import pyarrow.parquet as pq

    class Reader(HTMLParser):
        void = {"br", "img", "input", "hr", "meta", "link", "wbr"}
        out = {"nav", "header", "footer", "aside", "form", "script", "style"}
        inline = {"a", "b", "i", "em", "strong", "span", "code", "u", "small"}

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.open, self.texts, self.now = [], [], []

        def flush(self):
            text = " ".join("".join(self.now).split())
            self.texts += [text] if text else []
            self.now = []

        def handle_starttag(self, tag, attrs):
            if tag in self.void:
                self.now.append(" ")
                return
            if tag not in self.inline:
                self.flush()
                if tag in ("p", "li"):
                    self.close(tag)
                self.open.append((tag, tag in self.out or dict(attrs).get("class") == "ad"))

        def close(self, tag):
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    del self.open[k:]
                    return
                if tag in ("p", "li") and self.open[k][0] not in ("p", "li"):
                    return

        def handle_endtag(self, tag):
            if tag not in self.inline and tag not in self.void:
                self.flush()
                self.close(tag)

        def handle_data(self, data):
            tags = [t for t, _ in self.open]
            if "article" in tags and not any(gone for t, gone in self.open[tags.index("article"):]):
                self.now.append(data)

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    same = 0
    for page in pages:
        r = Reader()
        r.feed(page)
        r.flush()
        same += "\n".join(r.texts) == h.main_text(page, TREE)
    assert same >= 0.95 * len(pages)          # the rest: menus and articles that are not closed
