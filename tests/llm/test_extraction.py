from meterline.llm import extraction, queries

PAGES = "page_id long, url string, html string, text string, subtree long"


def text_of(html, template=()):
    root = extraction.parse(html)
    extraction.hash_subtrees(root)
    return extraction.article_text(root, set(template))


def test_blocks_references_and_white_space():
    html = ("<body><nav><a>Menu</a></nav><article><h1>A &amp; B&nbsp;&#x4E2D;</h1>\n<p>one\n two<br>three"
            "<p>four <b>fi</b>ve<ul><li>x<li>y</ul><pre>a  b</pre></article><footer>f</footer>")
    assert text_of(html) == "A & B 中\n\none two three\n\nfour five\n\nx\n\ny\n\na b"


def test_noise_goes():
    parts = ["<header>h</header>", "<aside>s</aside>", "<div class='ad'>ad</div>", "<form>f</form>",
             "<div id=cookieNotice>c</div>", "<script>if (a < b) x = '</p>'</script>", "<!-- c > d -->",
             "<style>p{}</style>", "<section class='post-comments'><p>nice</p></section>",
             "<div role=navigation>n</div>", "<div hidden>h</div>", "<div style='display: none'>n</div>"]
    for part in parts:
        assert text_of(f"<html><head><title>t</title></head><body>{part}<p>text</p>{part}</body>") == "text"
        assert text_of(f"<body><article><p>text</p>{part.replace('header', 'nav')}</article></body>") == "text"
    kept = "<article class='with-sidebar'><header><h1>title</h1></header><p>text</p></article>"
    assert text_of(kept) == "title\n\ntext"


def test_malformed_pages():
    assert text_of("") == text_of(None) == ""
    assert text_of("plain < text & more") == "plain < text & more"
    assert text_of("<p>a</b></i>b<div>c</p>d") == "ab\n\nc\n\nd"
    assert text_of("<article><p>open <b>bold") == "open bold"
    assert text_of("<p title=\"a > b\">x</p><br/><div/>y") == "x\n\ny"
    assert text_of("<div>" * 5000 + "deep") == "deep"
    assert text_of("<script>never closed <p>x</p>") == ""
    assert text_of("<textarea><p>no</p></textarea>yes<!-- open") == "yes"


def test_template_of_a_host_goes(spark):
    def page(i):
        return (f"<body><div><p>Welcome to our site</p></div><div><p>story {i} is here</p></div>"
                f"<div><p>{'Even' if i % 2 else 'Odd'} line</p></div></body>")

    rows = [(i, f"https://Site.example:80/p{i}", page(i), "x", 1) for i in range(20)]
    rows += [(100 + i, f"http://small.example/{i}", page(i), "x", 1) for i in range(5)]
    # Copies of one page are no template.
    rows += [(200 + i, f"http://copies.example/{i}", page(7), "x", 1) for i in range(30)]
    rows += [(300, None, page(3), None, None), (301, "no host", None, None, None)]
    found = {r["page_id"]: r["text"] for r in extraction.extract(
        spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert found[4] == "story 4 is here\n\nOdd line"
    assert found[104] == "Welcome to our site\n\nstory 4 is here\n\nOdd line"
    assert found[200].startswith("Welcome") and found[300].startswith("Welcome")
    assert found[301] == ""
    assert len(found) == len(rows)


def test_query_on_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    result = queries.op9_html_text(spark, sf)
    assert result.columns == ["page_id", "url", "text", "n_chars"]
    for r in result.collect():
        assert r["n_chars"] == len(r["text"]) > 0
        # The given pages hold the article between these two tags.
        inner = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert "".join(r["text"].split()) == "".join(text_of(f"<div>{inner}</div>").split())
        assert "track(" not in r["text"] and "\n\n\n" not in r["text"]


def test_no_pages(spark):
    assert extraction.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_article_shared_by_most_pages_of_a_host_stays(spark):
    def page(i, article, advert=""):
        return (f"<body><nav>menu {i}</nav><div><p>Welcome here</p></div><div><article><h1>One</h1>"
                f"<p>{article}</p><div class=ad>ad {i}</div>{advert}</article></div></body>")

    rows = [(i, f"http://same.example/{i}", page(i, "same story"), "x", 1) for i in range(20)]
    rows += [(100 + i, f"http://most.example/{i}", page(i, "same story" if i < 14 else f"story {i}"), "x", 1)
             for i in range(24)]
    rows += [(200 + i, f"http://edited.example/{i}", page(i, "same story", f"<p>line {i}</p>"), "x", 1)
             for i in range(20)]
    # Without an article element, what most texts hold is still the template.
    rows += [(300 + i, f"http://plain.example/{i}", f"<body><p>Welcome here</p><p>story {i}</p></body>", "x", 1)
             for i in range(20)]
    found = {r["page_id"]: r["text"] for r in extraction.extract(
        spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert {found[i] for i in range(20)} == {"One\n\nsame story"}
    assert found[105] == "One\n\nsame story" and found[120] == "One\n\nstory 20"
    assert found[207] == "One\n\nsame story\n\nline 7"
    assert found[304] == "story 4"


def test_main_shared_by_most_pages_of_a_host_stays(spark):
    rows = [(i, f"http://main.example/{i}",
             f"<body><div>menu {i}</div><main><p>same story</p><p>line {i}</p></main></body>", "x", 1)
            for i in range(20)]
    found = extraction.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["text"] for r in found} == {f"same story\n\nline {i}" for i in range(20)}


def test_stray_quotes_in_tags():
    assert text_of("<p title=it's>Hello world</p><p>rest of page</p>") == "Hello world\n\nrest of page"
    stray = '<a href="x"">link text</a><p>more text</p> <b class="y">z</b>'
    assert text_of(stray) == "link text\n\nmore text\n\nz"
    assert text_of("<p title = 'a > b' x=\"c > d\" y==>x</p>") == "x"
    assert text_of('<p title="open > <b>x') == ""
