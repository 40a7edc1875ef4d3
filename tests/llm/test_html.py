import html as entities
import re

from salesflow.llm import html
from salesflow.llm.html import read_page, without


def text_of(page):
    return " ".join(read_page(page).texts)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = html.extract_text(pages).collect()
    assert len(got) == len(source)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|<footer|$)", source[r["page_id"]], re.S)[1]
        want = re.sub(r"\s+", " ", entities.unescape(re.sub("<[^>]*>", " ", inner))).strip()
        assert r["text"] == want and r["n_chars"] == len(want)


def test_parts_that_are_not_the_article():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="comments-open"><header>H</header>
    <nav>N</nav><div class="cookie-notice">C</div><main><article><header><h1>Head &amp; line</h1></header>
    <p>One<b>two</b> <i>three</i><p>a &lt;b&gt; &eacute;&#233;&nbsp;x<script>var t="</p>";</script><form>F</form>
    <div class="ad">AD</div><ul><li>1<li>2</ul><aside>S</aside><!-- no --><section id="comments">R</section></article>
    <div>beside</div></main><footer>&copy;</footer></body></html>"""
    assert text_of(page) == "Head & line Onetwo three a <b> éé x 1 2"


def test_malformed_pages():
    assert text_of(None) == text_of("") == text_of("<div></div>") == ""
    assert text_of("plain < text & more") == "plain < text & more"
    assert text_of("<article><p>open <b>bold<br>next<p>two") == "open bold next two"
    assert text_of("<article>a</div>b</p>c</article>") == "abc"
    assert text_of("<p>x<script>never closed <p>y") == "x"
    assert text_of("<article><p title='a > b'>q</p><p data-x=\"1>2\">r</p></article> after") == "q r"
    assert text_of("<article>cut <p>text <im") == "cut text"
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    nested = read_page("<div>a" * 20_000)
    assert len(nested.texts) == 20_000
    # every level may be deleted: the innermost block, and all from the 5,000th on
    judged = {first: digest for digest, first, _ in nested.judged}
    assert len(judged) == 20_000
    assert without(nested.texts, nested.judged, {judged[19_999]}) == ["a"] * 19_999
    assert without(nested.texts, nested.judged, {judged[5_000]}) == ["a"] * 5_000
    assert len(text_of("<article>" + "<p>word</p>" * 50_000)) == 5 * 50_000 - 1


def page_rows(n=12):
    rows = []
    for i in range(n):
        body = f"<div><div><span>Shop of the week</span></div><p>text number {i} is here</p></div><div>All rights {i % 2}</div>"
        rows.append((i, "http://site.org/a", f"<body>{body}</body>"))
    rows += [(100 + i, "http://other.org/", "<body><p>same everywhere</p></body>") for i in range(9)]
    box = "<div>Read our letter</div>"
    rows += [(200 + i, "http://news.org/", f"<article><p>shared by all pages here</p>{box}<p>own {i}</p></article>") for i in range(8)]
    return rows


def test_recurring_subtrees_go(spark):
    pages = spark.createDataFrame(page_rows(), "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_text(pages).collect()}
    for i in range(12):  # the box and both notes recur, the texts do not
        assert got[i] == f"text number {i} is here"
    for i in range(9):  # copies of one page are no template
        assert got[100 + i] == "same everywhere"
    for i in range(8):  # in main content only boxes go, not paragraphs
        assert got[200 + i] == f"shared by all pages here own {i}"


def test_odd_rows(spark):
    rows = [(1, None, None, "t", 1), (None, "http://a.org", "<p>x</p>", "t", 1), (None, "http://a.org", "<p>x</p>", "t", 1), (2, "", "", None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, _host int")
    pages = pages.selectExpr("*", "1 as deleted", "2 as host", "3 as hash")
    got = html.extract_text(pages)
    assert sorted(got.columns) == ["_host", "deleted", "hash", "host", "n_chars", "page_id", "text", "url"]
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got.collect()) == [
        ("1", "", 0), ("2", "", 0), ("None", "x", 1), ("None", "x", 1),
    ]
    assert html.extract_text(pages.limit(0)).count() == 0


def test_whole_pages_are_counted(spark):
    """A box in few articles that stands beside the article on the host's other pages."""
    box = "<div>Read our letter</div>"
    pages = [
        f"<body><article><p>own {i}</p>{box}<p>and more of page {i}</p></article></body>" if i < 3 else f"<body>{box}<article><p>own {i}</p></article></body>"
        for i in range(10)
    ]
    rows = [(i, "http://news.org/", page) for i, page in enumerate(pages)]
    got = html.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"own {i} and more of page {i}" if i < 3 else f"own {i}" for i in range(10)}


def test_wrappers_with_common_class_words():
    for names in ("site has-sidebar", "post comments-open", "social", "widget", "no-share"):
        for tag in ("article", "main", "p"):
            page = f'<body><nav>N</nav><div class="{names}"><div><{tag}>the text itself</{tag}></div></div><div class="ad">AD</div></body>'
            assert text_of(page) == "the text itself", page
    teaser = '<div class="sidebar"><article>teaser</article></div>'
    assert text_of(f"<body>{teaser}<article>the longer text</article></body>") == "the longer text"
    assert text_of(f"<body>{teaser}<div class='widget'><main>the main text</main></div></body>") == "the main text"
    assert text_of(f"<main><div>{teaser}</div><article>the longer text</article></main>") == "the longer text"
    assert text_of(f"<body><div class='social'>{teaser}<article>the longer text</article></div></body>") == "the longer text"
    assert text_of('<body><p>a long own text</p><div class="cookie-notice">C</div><div id="share">S</div></body>') == "a long own text"


def test_article_parts_with_telling_names_stay():
    lead = "<p>" + "a long first paragraph of the article " * 3 + "</p>"
    text = re.sub("<[^>]*>", "", lead).strip()

    def of(part):
        return text_of(f"<body><nav>N</nav><article>{lead}{part}</article></body>").removeprefix(text).strip()

    assert of('<pre>x = 1 <span class="token comment"># keep me</span></pre>') == "x = 1 # keep me"
    assert of('<p>on <a class="share">the shared bike</a> and <em class="related">kin</em></p>') == "on the shared bike and kin"
    assert of('<section id="related"><h2>Related work</h2><p>Others did so too.</p></section>') == "Related work Others did so too."
    assert of('<div class="social"><p>What the clubs were like.</p></div>') == "What the clubs were like."
    # a second sign: links
    assert of('<div class="related"><ul><li><a href="/1">Next story</a></li><li><a href="/2">Another</a></li></ul></div>') == ""
    assert of('<div class="share">Share: <a href="/f">Facebook or so</a></div>') == ""
    # names that no part of an article has
    assert of('<div class="ad">AD</div><section id="comments"><p>Nice one!</p></section><ul class="breadcrumb"><li>B</li></ul>') == ""
    assert of('<div class="cookie-notice">C</div>') == ""


def test_a_section_template_goes_on_hosts_of_any_size(spark):
    """A box on ten pages of a section, below more than a hundred levels, of hosts with 10 to 600 pages."""
    deep = "<div>" * 150 + "Join the club" + "</div>" * 150
    rows = []
    for n in (10, 40, 600):
        for i in range(n):
            box = deep if i < 10 else ""
            rows.append((n, f"http://h{n}.org/{i}", f"<body><p>own text {i}</p>{box}</body>"))
            rows.append((n, f"http://m{n}.org/{i}", f"<main><p>own text {i} that is longer than the box</p>{box}</main>"))
    got = html.extract_text(spark.createDataFrame(rows, "n int, url string, html string")).collect()
    assert len(got) == 2 * 650 and not [r for r in got if "club" in r["text"]]
    assert all(r["text"].startswith(f"own text {r['url'].split('/')[-1]}") for r in got)
