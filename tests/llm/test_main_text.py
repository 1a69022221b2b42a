import html
import itertools
import re

import numpy as np
import pytest
from brute import as_dicts, rows

from tripmill.llm import dom, main_text, queries


def article(page):
    """The article of the test pages by its tag."""
    inside = re.search(r"(?s)<article>(.*?)</article>", page or "")
    blocks = re.split(r"</?(?:p|h1)>", inside.group(1) if inside else "")
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_every_page(spark, sf_dir):
    pages = {p["page_id"]: p for p in rows(sf_dir, "pages")}
    got = as_dicts(queries.op11_tree_marginals(spark, sf_dir))
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_marginals_are_those_of_all_states():
    """Sum-product against the sum over every state of small trees."""
    rng = np.random.default_rng(3)
    pages = ["<div class='ad'>a<p>b.<a href=x>c</a></div>", "<article><h1>t</h1><ul><li>x<li>y</ul></article>",
             "plain", "<nav><a href=x>y</a></nav><p>long text here.</p><footer>&copy; z</footer>"]
    model = main_text.Model(rng.normal(0, 1, main_text.N_FEATURES),
                            rng.normal(0, 1, (2 * main_text.N_TAGS, 2, 2)))
    for page in pages:
        trees = main_text.forest([dom.parse(page)])
        n = len(trees.parents)
        own = np.zeros(n)
        for row, column in zip(trees.rows, trees.columns):
            own[row] += model.weights[column]
        weight, content, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for state in itertools.product((0, 1), repeat=n):
            score = sum(own[i] for i in range(n) if state[i])
            for i, parent in enumerate(trees.parents):
                if parent >= 0:
                    score += model.edges[trees.kinds[i], state[parent], state[i]]
                    score += model.edges[main_text.N_TAGS + trees.kinds[parent], state[parent], state[i]]
            weight += np.exp(score)
            content += np.exp(score) * np.array(state)
            for i, parent in enumerate(trees.parents):
                if parent >= 0:
                    pairs[i, state[parent], state[i]] += np.exp(score)
        chance, joint = main_text.marginals(model, trees)
        assert np.allclose(chance, content / weight)
        assert np.allclose(joint, pairs / weight)


def test_laid_out_pages_that_were_not_trained_on():
    model = main_text.standard_model()
    trees = main_text.forest([dom.parse(p) for p in main_text.labelled_pages(300, seed=7)])
    chance, _ = main_text.marginals(model, trees)
    leaves = [v for _, v, _ in trees.leaves]
    said, true = chance[leaves] >= 0.5, trees.labels[leaves] == 1
    assert (said & true).sum() / said.sum() > 0.95 and (said & true).sum() / true.sum() > 0.94


def test_parts_of_an_article_that_are_none():
    model = main_text.standard_model()
    page = """<!doctype html><html><head><title>No</title><style>p{}</style></head><body>
      <header class="masthead"><h2>Paper</h2><a href="/">Home</a></header>
      <nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
      <article><h1>A  title &amp; more</h1><p>First sentence of the text, which goes on.
      <p>Second <a href="/x">linked</a> sentence&nbsp;here.</p><div class="ad">Buy this now.</div>
      <p>Third sentence of it.</p><script>var x = "<p>no</p>";</script></article>
      <section class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with this.</p></div></section>
      <form><label>Mail</label><input><button>Send</button></form>
      <aside class="sidebar"><a href="/c">Related</a></aside>
      <div class="cookie-notice">We use cookies. <button>Ok</button></div>
      <footer>&copy; Paper</footer></body></html>"""
    assert main_text.extract(model, [page]) == [
        "A title & more\nFirst sentence of the text, which goes on.\nSecond linked sentence here.\n"
        "Third sentence of it."]


def texts(page):
    return [t for t, *_ in dom.parse(page).texts.values()]


@pytest.mark.parametrize("page,want", [
    ("", []), ("a<br>b", ["a b"]), ("<p>a<p>b", ["a", "b"]), ("<p><b>a<br><p>b</p>c", ["a", "b", "c"]),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>4", ["1", "2", "3", "4"]),
    ("a<!-- <p>no</p> -->b", ["ab"]), ("<script>if (a<b) '</p>'</script>x", ["x"]), ("1 < 2", ["1 < 2"]),
    ("x<p", ["x"]), ("x<!-- y", ["x"]), ("<div title='a>b'>c</div>", ["c"]), ("</p></div>a</td>", ["a"]),
    ("&lt;p&gt; &am &amp x &#65;", ["<p> &am & x A"]), ("<svg><text>no</text></svg>y", ["y"]),
    ("<p>a <span>b</span>c</p>", ["a bc"]), ("<select><option>a<option>b</select>", ["a", "b"]),
])
def test_trees(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page", [
    "<div>" * 30_000 + "</i>" * 30_000, "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000,
    "<ul><li>" * 20_000 + "</td>" * 20_000, "<a \"" * 30_000, "<button>" * 20_000 + "</td>" * 20_000,
    "<table><td>" * 10_000 + "</table>" * 10_000, "<" * 50_000, "<!--" * 50_000])
def test_hostile_pages_end(page):
    assert isinstance(main_text.extract(main_text.standard_model(), [page])[0], str)


def test_defined_cases(spark):
    long = "<article><h1>T</h1>" + "<p>A sentence of words.</p>" * 20_000 + "</article>"
    data = [(1, None, None), (2, "u", ""), (None, "u", long), (None, "u", long), (3, "u", "<p></p>")]
    df = spark.createDataFrame([(*d, 7) for d in data], "page_id long, url string, html string, `x.y` int")
    got = sorted(((r["page_id"] or 0, r["n_chars"], r["x.y"]) for r in
                  main_text.with_main_text(df).collect()))
    n = len("T" + "\nA sentence of words." * 20_000)
    assert got == [(0, n, 7), (0, n, 7), (1, 0, 7), (2, 0, 7), (3, 0, 7)]
    assert main_text.with_main_text(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        main_text.with_main_text(df.withColumnRenamed("x.y", "Text"))
