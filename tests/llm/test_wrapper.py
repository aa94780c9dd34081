import html
import re
import time

from conftest import as_files

from datashelf.llm.wrapper import extract_main_text, parse, shape, simple_tree_matching, tree_of


def run(spark, pages):
    df = as_files(spark.createDataFrame(pages, "page_id long, url string, html string"))
    return {r["page_id"]: r for r in extract_main_text(df).collect()}


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", r["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", article))
        assert r["text"] == " ".join(html.unescape(plain).split()) and r["n_chars"] == len(r["text"])


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><nav><a href=x>Home</a></nav>
<div class="cookie-notice">We use cookies</div><div id=c{i}><h1>Head {i}</h1><p>Text &amp; more {i}<br>line &lt;two&gt;<p>Second  <b>bo</b>ld {i}
<p>Call us any time</div><form><p>Sign up</form><aside>Side</aside><div class="comments"><p>Nice {i}</div><script>var a="<p>";</script><footer>End</footer>"""


def test_wrapper_of_a_host(spark):
    pages = [(i, f"http://a.example/{i}", PAGE.format(i=i)) for i in range(8)]
    got = run(spark, pages)
    for i in range(8):  # the line that all pages have is template
        assert got[i]["text"] == f"Head {i} Text & more {i} line <two> Second bold {i}"


def test_few_pages_and_copies_are_no_template(spark):
    pages = [(i, f"http://b.example/{i}", PAGE.format(i=0)) for i in range(20)]  # copies of one page
    got = run(spark, pages)
    assert {r["text"] for r in got.values()} == {"Head 0 Text & more 0 line <two> Second bold 0 Call us any time"}


def test_odd_pages(spark):
    pages = [
        (1, None, None), (2, "http://c.example/", ""), (3, "nonsense", "plain &eacute; text\n  here"), (None, None, "<p>a<p>b"),
        (5, "http://c.example/", "<p>open <b>bold <i>x"), (6, "http://c.example/", "<!-- a <p> --><p hidden>no<p>yes<!-- open"),
        (7, "http://c.example/", "<main><article><p>in</p></article>out</main>aside"), (8, "http://c.example/", "<script>never closed <p>x"),
        (9, "http://c.example/", "a < b and c > d"), (10, "http://c.example/", "<p>" + "w " * 50_000), (10, "http://c.example/", "<p>twice"),
        (11, "x", "<div class=menu>m</div><table><tr><td>1<td>2<tr><td>3</table>"), (12, "x", "<p title='a>b'>t</p>"),
    ]
    df = as_files(spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, row string"))
    got = extract_main_text(df).collect()
    assert len(got) == len(pages)
    text = {r["page_id"]: r["text"] for r in got if r["page_id"] != 10}
    assert text == {
        1: "", 2: "", 3: "plain é text here", None: "a b", 5: "open bold x", 6: "yes", 7: "in", 8: "", 9: "a < b and c > d",
        11: "1 2 3", 12: "t",
    }
    assert sorted(r["n_chars"] for r in got if r["page_id"] == 10) == [5, 99_999]
    assert extract_main_text(as_files(df.limit(0))).count() == 0


def test_names_do_not_hide_main_content(spark):
    article = "<article class='post has-comments'><div class='entry-header'><h1>Head</h1></div><h2 id='related-work'>Work</h2>" \
        "<section id='social-impact'><p>Impact</p></section><p class='notice'>Note</p><div class='ad'>Buy</div></article>"  # fmt: skip
    wraps = ["{}", "<div class='layout has-sidebar'>{}</div>", "<div class='with-navigation'><main>{}</main></div>",
             "<div class='search'>{}</div>", "<form>{}</form>", "<div id=header><main><div>{}</div></main></div>"]
    pages = [(i, f"http://h{i}.example/", w.format(article)) for i, w in enumerate(wraps)]
    pages.append((6, "http://i.example/", article + "<div class='related'><article>Teaser</article></div>"
                  "<div class='comments'><article>Nice</article></div><aside><article>Side</article></aside>"))  # fmt: skip
    assert {r["text"] for r in run(spark, pages).values()} == {"Head Work Impact Note"}


def size(tree):
    return 1 + sum(map(size, tree[2]))


def best(a, b):
    """Simple tree matching by plain recursion."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[2]) + 1) for _ in range(len(a[2]) + 1)]
    for i, x in enumerate(a[2], 1):
        for j, y in enumerate(b[2], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + best(x, y))
    return 1 + m[-1][-1]


def test_simple_tree_matching():
    shapes = ["a(b()c(d()e())f())", "a(c(e())b()f())", "a(b()b()c(x()e())f(g()))", "z(b())", "a()"]
    for s in shapes:
        for t in shapes:
            x, y = tree_of(s), tree_of(t)
            mapped = simple_tree_matching(x, y)
            assert len(mapped) == best(x, y) and len(set(mapped.values())) == len(mapped)
            if s == t:
                assert mapped == {i: i for i in range(size(x))}


def test_lists_of_any_length_have_one_shape():
    one, many = (shape(parse("<ul>" + "<li><p>x</p></li>" * n + "</ul><p>y")[0])[0] for n in (1, 9))
    assert one == many


def test_copies_with_other_surroundings_are_no_template(spark):
    page = "<div id=c><h1>Head</h1><p>One line<p>Another</div><!-- ad {0} --><script>track({0})</script><div class=ad>Buy {0}</div>"
    pages = [(i, f"http://d.example/{i}", page.format(i)) for i in range(8)]
    assert {r["text"] for r in run(spark, pages).values()} == {"Head One line Another"}


def test_alignment_decides_where_names_do_not(spark):
    page = "<div><p>Our shop</p><b>Call us</b></div><div><h1>Head {0}</h1><p>Text {0}<p>More {0}</div><section><p>All rights</section>"
    pages = [(i, f"http://e.example/{i}", page.format(i)) for i in range(9)]
    got = run(spark, pages)
    assert all(got[i]["text"] == f"Head {i} Text {i} More {i}" for i in range(9))


def test_quotes(spark):
    pages = [(1, "x", "<p data-x=it's>Hello world</p><p>don't worry</p><p>end</p>"), (2, "x", "<p title = 'a>b' id=\"c>d\">t</p>"),
             (3, "x", "<p class=a=\"b>t</p><p 'x\">u</p>"), (4, "x", "<div data-1='class=ad'>t</div>")]
    assert {k: r["text"] for k, r in run(spark, pages).items()} == {1: "Hello world don't worry end", 2: "t", 3: "t u", 4: "t"}


def test_deep_and_unclosed(spark):
    deep = 20_000
    pages = [(i, f"http://f.example/{i}", "<div>" * deep + f"<p>Text {i}</p><p>Same" + "</div>" * deep) for i in range(6)]
    pages += [
        (10, "x", "<p>a</p>" + "<a " * 400_000), (11, "x", "<p>a</p>" + "<!x" * 400_000), (12, "x", "<p>a</p>" + "<a x='\"" * 200_000),
        (13, "x", "<p>a</p>" + "<script></script " * 60_000), (14, "x", "<p>a" + "<div>" * 100_000 + "</section>" * 100_000),
    ]
    started = time.monotonic()
    got = run(spark, pages)
    assert time.monotonic() - started < 60
    assert all(got[i]["text"] == f"Text {i}" for i in range(6)) and all(got[i]["text"] == "a" for i in range(10, 15))
