"""Operator 6 on pages with known articles."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.html_extract import Node, Page, _tree, extract_pages, simple_tree_matching

SCHEMA = "page_id long, url string, html string"


def words(r, n):
    return " ".join("".join(r.choice("abcdefgé") for _ in range(r.randint(2, 7))) for _ in range(n))


def page(r, i, kind, shared="Share this story with friends"):
    title, paras = words(r, 5), [words(r, 20) + " &amp; 5 &lt; 6&nbsp;x" for _ in range(r.randint(2, 6))]
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in words(r, 5).split())
    head = (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
            f"<nav><ul>{menu}</ul></nav><!-- c {i} --><div class='ad'>{words(r, 8)}</div>")
    foot = f"<footer>&copy; host &middot; {words(r, 4)}</footer></body></html>"
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>\n" for p in paras)
    want = " ".join([title, *[p.replace("&amp;", "&").replace("&lt;", "<").replace("&nbsp;", " ") for p in paras]])
    if kind == "article":
        return f"{head}<article>{body}<p>{shared}</p></article><div class='comments'><p>{words(r, 9)}</p></div>{foot}", want
    if kind == "main":
        return f"{head}<div id=sidebar>{words(r, 30)}</div><main><form>{words(r, 3)}</form>{body}</main>{foot}", want
    return f"{head}<p class='cookie-notice'>{words(r, 6)}</p><div class=text>{body}</div><div class=text>{shared}</div>{foot}", want


@pytest.mark.parametrize("kind", ["article", "main", "plain"])
def test_article_text(spark, kind):
    r = random.Random(kind)
    made = [page(r, i, kind) for i in range(60)]
    rows = [(i, f"https://www.{kind}.example.com:80/p/{i}?q#f", h) for i, (h, _) in enumerate(made)]
    got = {x.page_id: (x.text, x.n_chars) for x in extract_pages(spark.createDataFrame(rows, SCHEMA), block=16).collect()}
    for i, (_, want) in enumerate(made):
        assert got[i] == (want, len(want)), i


def test_copies_are_no_template(spark):
    r = random.Random(3)
    h, want = page(r, 0, "main")
    rows = [(i, "http://one.example.com/a", h.replace("<!-- c 0 -->", f"<!-- {i} -->")) for i in range(8)]
    assert {x.text for x in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()} == {want}


def test_near_copies_are_no_template(spark):
    r = random.Random(4)
    h, want = page(r, 0, "main")
    rows = [(i, "http://two.example.com/a", h.replace("<h1>", f"<h1>v{i} ")) for i in range(6)]
    got = {x.page_id: x.text for x in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"v{i} {want}" for i in range(6)}


def test_broken_markup_and_edges(spark):
    cases = {
        "<p>one<p>two <b>three<br>four": "one two three four",
        "<article><h1>T</h1><p><b>T.<br><p>U</p><p>V": "T T. U V",
        "text only &eacute; &#233; &unknown; < 5": "text only é é &unknown; < 5",
        "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>": "a b c d",
        "<script>x<article>no</article></script>yes": "yes",
        "<div title=\"a > b\">in</div><a href='x>y'>link</a>": "in link",
        "<article><header><h1>H</h1></header><p>b</p></article><article><p>c</p></article>": "H b c",
        "in<b>li</b>ne <i>x</i>": "inline x",
        "": "", None: "", "<nav>n</nav>": "", "<!-- open": "", "<p \"a'b>c</p>": "c",
    }
    rows = [(i, None if i % 2 else "notaurl", h) for i, h in enumerate(cases)] + [(None, "", "<p>z</p>"), (0, "notaurl", "<p>z")]
    got = extract_pages(spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("x"))).collect()
    assert len(got) == len(rows)
    by = sorted(((r.page_id, r.text) for r in got if r.page_id is not None))
    assert by == sorted([(i, w) for i, w in enumerate(cases.values())] + [(0, "z")])
    assert extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_nested_scopes_stay_whole():
    cases = {
        "<main><h1>T</h1><p>intro</p><article><p>a longer body</p></article><p>end</p></main>": "T intro a longer body end",
        "<article><h1>T</h1><div itemprop=articleBody><p>a longer body</p></div></article>": "T a longer body",
        "<main><article><p>one</p></article><article><p>two</p></article></main><p>out</p>": "one two",
        "<article><p>b</p><article class=comment><p>a reader's remark</p></article></article>": "b",
        "<article><p>b</p></article><article class=comment><p>a longer reader's remark</p></article>": "b",
        "<article><p>part one</p></article><div>advert</div><article><p>two</p></article><main>three</main>": "part one two three",
        "<article class='post related'><p>alone</p></article><p>out</p>": "alone",
    }
    assert [Page(h).content() for h in cases] == list(cases.values())


def test_very_long_and_deep_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000 + "<p>" + "word " * 200_000
    assert len(Page(deep).content()) == 1 + 5 * 200_000
    open_only = "<div>" * 200_000 + "<b>" * 1000 + "x" + "<li>y" * 1000 + "</i>" * 100_000
    assert Page(open_only).content() == "x" + " y" * 1000
    assert Page("<" * 50_000 + "a").content().endswith("a")
    assert Page("<a " + "b='c" * 5000).content() is not None


def test_simple_tree_matching():
    a = _tree(["", "/body", "/body/nav", "/body/div.x", "/body/div.x/p", "/body/footer"])
    b = _tree(["", "/body", "/body/div.x", "/body/div.x/p", "/body/div.x/h1", "/body/aside", "/body/footer"])
    score, pairs = simple_tree_matching(a, b)
    assert score == 5 and {n.path() for n, _ in pairs} == {"", "/body", "/body/div.x", "/body/div.x/p", "/body/footer"}
    assert simple_tree_matching(Node("a", None), Node("b", None)) == (0, [])


def test_tree_matching_against_all_matchings_and_many_siblings():
    def size(x, y):
        if x.label != y.label:
            return 0
        one, two = list(x.children.values()), list(y.children.values())
        best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
        for i, m in enumerate(one):
            for j, n in enumerate(two):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + size(m, n))
        return best[-1][-1] + 1

    r = random.Random(9)

    def tree(depth):
        paths = [""]
        for _ in range(depth * 6):
            paths.append(r.choice(paths) + "/" + r.choice("abcdef"))
        return _tree(paths)

    for _ in range(300):
        x, y = tree(r.randrange(4)), tree(r.randrange(4))
        score, pairs = simple_tree_matching(x, y)
        assert score == size(x, y) == len(pairs)
        assert all(m.label == n.label and m.depth == n.depth for m, n in pairs)
    labels = [f"/x{i}" for i in range(20_000)]
    assert simple_tree_matching(_tree([""] + labels), _tree([""] + labels[::-1]))[0] == 2
    assert simple_tree_matching(_tree([""] + labels), _tree([""] + labels[1::2]))[0] == 10_001
