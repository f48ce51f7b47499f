import html
import re

from lodestrata.llm import html_text as H


def text_of(page):
    return " ".join(t for t, _ in H.parse(page))


def test_parts_that_are_no_article():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header><div class="wrap with-sidebar"><div class=cookie-banner>We use cookies</div>
    <main><article class="post"><header><h1>Ti<b>tle</b></h1></header><p>One &lt;b&gt; &amp;amp; two<p>Three<br>four<script>if(a<b){x("</p>")}</script><div class="share">tweet</div><ul><li>a<li>b</ul><form>mail<input></form>
    <blockquote>Q</blockquote><!-- c --> tail a < b &nbsp; c</article><section id="comments"><article class="comment">bad</article></section></main><aside>side</aside></div><footer>f</footer>"""
    assert text_of(page) == "Title One <b> &amp; two Three four a b Q tail a < b c"
    assert text_of('<body><div class="content has-sidebar"><p>kept</p><div class="sidebarBox">gone</div><ul id=mainMenu><li>x</ul></div>') == "kept"
    assert text_of("just <i>text</i>only<div>x</div>") == "just textonly x"
    assert text_of("") == "" and text_of("<p>a<!-- unclosed") == "a" and text_of("<div hidden>h</div><p title='a>b'>ok</p>") == "ok"


def test_test_pages_match_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in H.extract_text(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inside))).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_site_templates_go_and_copies_stay(spark):
    rows = []
    for k in range(30):
        body = f"<div class='c1'><span>Read more on our site</span></div><div class='c2'><p>Story number {k} of many</p><p>Shared passage</p></div><div class='x9'>Imprint of the house</div>"
        rows.append((k, f"http://Host.example/{k}", f"<body>{body}</body>"))
        rows.append((100 + k, f"http://other.example/{k}", f"<body><article><p>Same words</p><p>own {k}</p></article></body>"))
    rows += [(200, None, "<body><div>Imprint of the house</div></body>"), (201, "http://host.example/x", None)]
    got = {r["page_id"]: r["text"] for r in H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story number 3 of many" and got[103] == "Same words own 3" and got[200] == "Imprint of the house" and got[201] == ""


def test_edges(spark):
    kind = "page_id long, url string, html string, text string, host string, found int"
    df = spark.createDataFrame([(1, "u", "<p>x" * 20000, "t", "h", 1), (1, "u", "<p>y", None, None, None), (None, None, None, None, None, None)], kind)
    got = sorted((r["n_chars"] for r in H.extract_text(df).collect()))
    assert got == [0, 1, 39999]
    assert H.extract_text(df.limit(0)).count() == 0


def test_whole_pages_are_counted_before_markup_decides(spark):
    """Menus, adverts and footers are counted too, and counted parts are gone before any rule on markup."""
    page = "<body><nav><ul><li>Home<li>News</ul></nav><div class=ad>Buy {k}</div><article><h1>T</h1><p>own {k}</p></article><footer>Imprint</footer></body>"
    rows = [(k, f"http://host.example/{k}", page.format(k=k)) for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", H.host_of("url"))
    parsed = pages.mapInArrow(H._parsed, H.PARSED)
    found = set(H.templates(parsed).collect()[0]["found"])
    whole = H.tree(rows[3][2])
    bare = H.choose(H.Tree(whole.keys, whole.parents, [f & H.COUNTED for f in whole.flags], whole.texts, whole.owners), found)
    assert [whole.texts[k] for k in bare] == ["Buy 3", "T own 3"]
    assert {r["page_id"]: r["text"] for r in H.extract_text(pages).collect()} == {k: f"T own {k}" for k in range(30)}


def test_markup_does_not_drop_most_of_a_page():
    story = "A long story with many words that is what the page is about. " * 20
    teasers = "".join(f"<article><h2>Teaser {k}</h2></article>" for k in range(3))
    assert story.strip() in text_of(f"<body><main><div>{story}</div>{teasers}</main></body>")
    assert text_of(f"<body><main><div>{story}</div></main><section>{teasers}</section></body>") == story.strip()
    assert story.strip() in text_of(f"<body><div>{story}</div>{teasers}</body>")
    assert text_of(f"<body><article><div class='elementor-widget-container'>{story}</div><div class=share>Tweet</div></article></body>") == story.strip()
    assert text_of(f"<body><form id=aspnetForm><div class=menu>Home</div><div>{story}</div><input type=hidden></form></body>") == story.strip()
    assert text_of(f"<body><form><nav>Home</nav><article>{story}</article></form></body>") == story.strip()
    assert text_of(f"<body><main><p>Short story.</p><section id=comments>{story}</section></main></body>") == "Short story."
    assert text_of(f"<body><article>Short story.</article><div class=ad>{story}</div><footer>{story}</footer></body>") == "Short story."


def test_recurrence_does_not_depend_on_the_host_size(spark):
    """A block on all pages of a host of 7, and one on 8 pages of hosts of 40 and of 400, are templates; one on 2 pages is none."""
    rows = []
    for pages in (7, 40, 400):
        for k in range(pages):
            twice = "<div>On two pages</div>" if k < 2 else ""
            block = "<div>Section block</div>" if k < 8 else ""
            rows.append((1000 * pages + k, f"http://h{pages}.example/{k}", f"<body><div>Story number {k}</div>{block}{twice}</body>"))
    got = {r["page_id"]: r["text"] for r in H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1000 * pages + k: f"Story number {k}" + " On two pages" * (k < 2) for pages in (7, 40, 400) for k in range(pages)}


def test_comments_go_and_page_text_stays():
    assert text_of("<body><p>Main story here.</p><div class='comment-list'><article><p>reader</p></article></div></body>") == "Main story here."
    assert text_of("<body><article><p>Story.</p></article><div class='comment-list'><article><p>reader, who says more than the story</p></article></div></body>") == "Story."
    assert text_of("<body><div class='comments-open'><article><p>Story.</p></article></div></body>") == "Story."
    assert "m" in text_of("<body><main><p>m</p></main><article class='card'>card</article></body>").split()
    assert text_of("<body><main><p>A story of some length.</p></main><article class='card'>card</article></body>") == "A story of some length."
    part = "<body><article><p>Long story text, and more of it.</p><div class='{}'><p>x</p></div></article></body>"
    assert all(text_of(part.format(name)).endswith(" x") for name in ("related-work", "notice-board", "menu-engineering"))
    assert not any(text_of(part.format(name)).endswith(" x") for name in ("related-posts", "notice", "share", "alert alert-info", "banner-top", "sidebar"))


def test_broken_markup_is_linear():
    import time

    million = 1_000_000
    pages = ["<a b='" * (million // 6), "<a b='" * (million // 6) + "'>x", "<a b='" * (million // 6) + ">x", "<" * million, "<a" * (million // 2) + ">", "<div>" * (million // 5), "<!--" * (million // 4), "</p>" * (million // 4),
             "<div>" * 100_000 + "x" + "</p></b>" * 100_000, "<p " + "class=x " * 100_000 + ">y", "<script>" * (million // 8), "&" * million]
    for k, page in enumerate(pages):
        began = time.process_time()
        H.choose(H.tree(page))
        assert time.process_time() - began < 5, k
    began = time.process_time()
    H.tree(pages[0])
    assert time.process_time() - began < 1


def test_deep_elements_are_part_of_the_one_above():
    assert text_of("<div>" * 2000 + "deep" + "</div>" * 2000 + "<p>after</p>") == "deep after"


def test_counts_alone_tell_templates(spark):
    """Hosts whose parts have no telling names: what stays is what a brute-force count over the host's pages leaves."""
    import random
    from collections import defaultdict

    rng = random.Random(6)
    rows, parts = [], {}
    for host in range(4):
        fixed = [f"<div class='z{j}'><span>Part {j} of house {host}</span></div>" for j in range(6)]
        for k in range(24):
            mine = [f"<div class='q'><span>Own words {host} {k} {j}</span></div>" for j in range(3)] + rng.sample(fixed, rng.choice([1, 2, 4])) + (["<div class='q'><span>A rare part</span></div>"] if k < 5 else [])
            rng.shuffle(mine)
            parts[100 * host + k] = mine
            rows.append((100 * host + k, f"https://h{host}.example/{k}", f"<html><body>{''.join(mine)}</body></html>"))
    on = defaultdict(set)
    for page, mine in parts.items():
        for part in mine:
            on[page // 100, part].add(page)
    plain = lambda part: re.sub("<[^>]*>", "", part)
    want = {page: " ".join(plain(x) for x in mine if len(on[page // 100, x]) < H.CONTAINER_PAGES[0]) for page, mine in parts.items()}
    got = {r["page_id"]: r["text"] for r in H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want and any("rare" in t for t in got.values())


def test_comments_and_notices_inside_an_article_go_and_anchors_stay():
    story = "".join(f"<p>Paragraph {k} of the story with some words to read.</p>" for k in range(30))
    text = lambda part: " ".join(t for t, _ in H.parse(f"<html><body><article><h1>Title</h1>{story}{part}</article></body></html>"))
    whole = text("")
    for part in ("<section class='reader-comments'><p>gone</p></section>", "<div id='discussion'><p>gone</p></div>", "<div id='comments'><p>gone</p></div>", "<div class='breaking-alert'>gone</div>", "<div class='share-this'>gone</div>", "<ul class='social-media-links'><li>gone</li></ul>", "<div class='articleComments'><p>gone</p></div>"):
        assert text(part) == whole, part
    for part in ("<section id='consent'><p>stays</p></section>", "<section id='cookies'><p>stays</p></section>", "<div id='navigation'><p>stays</p></div>", "<div class='story ad-free'><p>stays</p></div>", "<pre><span class='comment'>stays</span></pre>", "<div class='no-comments'>stays</div>", "<div class='related-work'>stays</div>"):
        assert text(part) == whole + " stays", part
