"""Main text of pages."""

import html
import random

import pytest

from tamarind.llm import page_text

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text &amp; more &am", "just text & more &am"),
        ("<p>one<p>two<b>three</b>four<br>five", "one twothreefour five"),
        ("<body><nav>menu</nav><p>a  \n b</p><footer>foot</footer></body>", "a b"),
        ("<article><h1>T</h1><p><b>x<br><p>y</p></article><p>after</p>", "T x y"),
        ("<main><p>x</p><div class='ad box'>ad</div><section id=comments>c</section><p>z</p></main>", "x z"),
        ("<article><header><h1>T</h1></header><p>x</p></article><header>site</header>", "T x"),
        ("<article>x<article class=comment>c</article></article>", "x"),
        ("<script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p>", "yes"),
        ("<!-- <p>no</p> --><p>&lt;yes&gt; &#233;&nbsp;&hellip;</p>", "<yes> é …"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
        ("<div>a</b></i>b</div></div></p>c", "ab c"),
        ("<p>a&#xD800;b", "a�b"),
        ("<div role=navigation>n</div><div hidden>h</div><p aria-hidden=true>h</p><p>t</p>", "t"),
    ],
)
def test_main_text(source, text):
    assert page_text.main_text(source) == text


@pytest.mark.parametrize(
    "source",
    [
        '<div class="layout with-sidebar"><p>kept text</p></div>',
        '<article class="post comments-open"><p>kept text</p></article>',
        '<article class="post no-comments"><p>kept text</p></article>',
        '<div id="social-science"><p>kept text</p></div>',
        '<form id="aspnetForm"><div><p>kept text</p></div></form>',
        '<form><div class="nav">x</div><article><p>kept text</p></article><input></form>',
        '<div class="sidebar"><main><p>kept text</p></main></div>',
        '<div class="promo"><p>kept text</p></div>',
        '<article><div class="entry-header"><h1>kept</h1></div><p>text</p></article>',
        '<article><div class="header"><h1>kept</h1></div><p>text</p></article>',
        '<div class="site-header">Site</div><div id="mainMenu">m</div><p>kept text</p><div class="cookie-banner">c</div>',
        '<p>kept text</p><div class="comments-list">c</div><div class="page__footer">f</div><form><p>Join</p><input></form>',
    ],
)
def test_names_of_wrappers(source):
    assert page_text.main_text(f"<body>{source}</body>") == "kept text"


def plain_templates(rows, share, least):
    """A counter per host over plain dictionaries: hash -> the signatures it stands on."""
    hosts = {}
    for _, url, source in rows:
        host = (url or "").partition("//")[2].partition("/")[0]
        page = page_text.parsed(source or "")
        signatures, places = hosts.setdefault(host, (set(), {}))
        signatures.add(page_text.signature(page))
        for digest in set(page_text.subtrees(page).values()):
            places.setdefault(digest, set()).add(page_text.signature(page))
    return {
        host: {d for d, on in places.items() if len(on) >= least and len(on) >= share * len(signatures)}
        for host, (signatures, places) in hosts.items()
    }


def sections(n=240):
    """Six sections of a host, each with its own menu without a telling name, adverts that
    rotate, and a wrapper with prose inside every article of a section."""
    draw, rows, texts = random.Random(8), [], []
    for i in range(n):
        words = " ".join("".join(draw.choices("abcdef", k=5)) for _ in range(40))
        menu = f"<div class=x1><div>Section {i % 6}</div><div>Topics</div></div>"
        advert = f"<div class=x2><p>Buy {i % 4} now</p></div>"
        inner = f"<div class=x3><p>Read more in part {i % 6}</p></div>"
        body = f"<article><h1>T {i}</h1><p>{words}</p>{inner}</article>" if i % 2 else f"<div><p>{words}</p></div>"
        rows.append((i, f"https://{'hot' if i % 5 else 'cold'}.example/{i}", f"<body>{menu}{body}{advert}</body>"))
        texts.append(f"T {i} {words}" if i % 2 else words)
    return rows, texts


def test_templates_on_a_part_of_a_host(spark):
    rows, texts = sections()
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.text for r in page_text.extracted(df).orderBy("page_id").collect()] == texts
    off = [r.text for r in page_text.extracted(df, least=10**9).orderBy("page_id").collect()]
    assert all(len(a) > len(b) for a, b in zip(off, texts)), "every page has something only the counts tell"
    found = {r.host: set(r.templates) for r in page_text.templates(df.withColumn("host", page_text.host_of(df.url))).collect()}
    assert found == {h: t for h, t in plain_templates(rows, page_text.SHARE, page_text.LEAST_PAGES).items() if t}


def test_near_copies_are_no_templates(spark):
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdef", k=5)) for _ in range(200)]
    rows = []
    for i in range(12):
        changed = [*words[:100], f"edit{i}", *words[101:]]
        rows.append((i, "https://a.example/", f"<body><div><p>{' '.join(changed)}</p></div><div><p>shared end</p></div></body>"))
    own, _ = sections(60)
    rows += [(100 + i, "https://a.example/x", html_) for i, _, html_ in own]
    found = {r.page_id: r.text for r in page_text.extracted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum("shared end" in found[i] for i in range(12)) == 12


def test_depth_is_no_matter():
    assert page_text.main_text("<div>" * 50_000 + "x") == "x"


def site(n=60):
    draw = random.Random(2)
    rows, texts = [], []
    for i in range(n):
        words = " ".join("".join(draw.choices("abcdef", k=5)) for _ in range(30))
        menu = "<div><div>Home</div><div>About us</div></div>"
        rows.append((i, f"https://{'hot' if i % 3 else 'cold'}.example/{i}", f"<body>{menu}<div><p>{words}</p></div><div>All about us</div></body>"))
        texts.append(words)
    return rows, texts


def test_recurring_subtrees_go(spark):
    rows, texts = site()
    found = {r.page_id: r for r in page_text.extracted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [found[i].text for i in range(len(rows))] == texts
    assert all(r.n_chars == len(r.text) for r in found.values())
    # under the least number of pages nothing is template
    few = page_text.extracted(spark.createDataFrame(rows[:4], SCHEMA)).collect()
    assert all("Home" in r.text for r in few)


def test_copied_articles_stay(spark):
    page = "<body><nav>x</nav><article><h1>T</h1><p>the same article</p><div>Share this</div></article></body>"
    rows = [(i, "http://a.example/", page) for i in range(20)]
    assert {r.text for r in page_text.extracted(spark.createDataFrame(rows, SCHEMA)).collect()} == {"T the same article"}


def test_copied_pages_without_article_stay(spark):
    rows, texts = site(30)
    copy = "<body><div><div>Home</div><div>About us</div></div><div><p>the same page many times</p></div><div>All about us</div></body>"
    # copies differ in what is no text, and some have no url
    copies = [(100 + i, f"https://hot.example/c{i}", f"<!-- {i} --><script>{i}</script>{copy}") for i in range(40)]
    copies += [(200 + i, None, copy) for i in range(20)]
    found = {r.page_id: r.text for r in page_text.extracted(spark.createDataFrame(rows + copies, SCHEMA)).collect()}
    assert [found[i] for i in range(len(rows))] == texts
    assert all(found[100 + i] == "the same page many times" for i in range(40))
    assert all("the same page many times" in found[200 + i] for i in range(20))


def test_subtree_with_all_text_stays():
    source = "<body><nav>menu</nav><div><div>all there is</div></div></body>"
    page = page_text.parsed(source)
    assert page_text.main_text(source, set(page_text.subtrees(page).values())) == "all there is"


def test_odd_pages(spark):
    rows = [(1, None, None), (1, None, None), (None, "no url", ""), (2, "http://[bad", "<p>x"), (3, "HTTP://u@H.example:8/", "y" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS host", "'clash' AS text", "1 AS `a.b`")
    found = sorted(page_text.extracted(df).collect(), key=lambda r: (r.n_chars, str(r.page_id)))
    assert [(r.page_id, r.text[:1], r.n_chars) for r in found] == [(1, "", 0), (1, "", 0), (None, "", 0), (2, "x", 1), (3, "y", 200_000)]
    assert found[-1].host == "h.example"
    assert page_text.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


def test_references_round_trip(spark):
    text = "a < b & c > \"d\" é 'e'"
    assert page_text.main_text(f"<article><p>{html.escape(text)}</p></article>") == text
