import itertools
import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from boxloom.llm import op04_html as extraction
from boxloom.llm.labelled_pages import PAGES
from llm_cases import tables


@pytest.fixture(scope="module")
def model():
    return extraction.train(PAGES)


def labelled(page):
    tree, own = extraction.parse(page), []
    for parent, attributes in zip(tree.parent, tree.attributes, strict=True):
        m = re.search(r'\bkeep="([01])"', attributes)
        own.append(int(m[1]) if m else own[parent] if parent >= 0 else 0)
    return " ".join(words for node, words in tree.texts if own[node])


def test_held_out_labelled_pages():
    right = 0
    for fold in range(3):
        model = extraction.train([p for i, p in enumerate(PAGES) if i % 3 != fold])
        rest = [p for i, p in enumerate(PAGES) if i % 3 == fold]
        right += sum(got == labelled(page) for page, got in zip(rest, extraction.extract(rest, model), strict=True))
    assert right >= 0.8 * len(PAGES)


def test_marginals_against_all_labellings(model):
    rng = np.random.default_rng(2)
    trees = [extraction.parse(p) for p in ("<div><p>a<p>b</div><ul><li>c</ul>", "<p>x")]
    forest, unary, edges = extraction.Forest.of(trees), rng.normal(size=extraction.N_FEATURES), rng.normal(size=(extraction.N_KINDS, 2, 2))
    got = extraction.marginals(forest, unary, edges)[0][:, 1]
    scores, n = forest.features @ unary, len(forest.parent)
    total, on = 0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        y = np.array(y)
        weight = np.exp(scores @ y + sum(edges[forest.kinds[i], y[p], y[i]] for i, p in enumerate(forest.parent) if p >= 0))
        total += weight
        on += weight * y
    assert np.allclose(got, on / total)


def test_pages(spark, tmp_path):
    article = "<nav><a href=/>Home</a></nav><article><h1>A&amp;amp;B &lt;i&gt;</h1><p>one\n two<b>three</b><br>four<p>five<div class='comments'><p>a long reader comment, " + "words " * 60 + "</p></div><script>x='</p>'</script><p>six"
    rows = [(1, "u", article), (1, "u", article), (2, None, None), (3, "u", ""), (4, "u", "<nav>only a menu</nav>"), (5, "u", "<article><p>" + "word " * 50_000 + "</p></article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "html AS text")
    got = sorted(extraction.query(spark, tables(tmp_path, pages=frame)).collect(), key=lambda r: r.page_id)
    assert [r.text for r in got[:5]] == ["A&amp;B <i> one twothree four five six"] * 2 + ["", "", ""]
    assert [r.n_chars for r in got] == [len(r.text) for r in got] and got[5].n_chars == 249_999 and got[2].url is None
    assert extraction.main_text(frame.where("false")).count() == 0


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p>a</p><noscript>b<p>c</p>", ["a", "b", "c"]),
        ("<p>a<object data=x>b</p><p>c</p>", ["ab", "c"]),
        ("<p>a<iframe src=x><p>b</p>", ["a", "b"]),
        ("<p>a <svg/>b</p><p>c <svg><text>no</text></svg>d</p>", ["a b", "c d"]),
        ("<p>a</p><script>b<p>c</p>", ["a"]),
        ("<p>a</p><title>b</title><p>c</p><textarea>d", ["a", "c"]),
        ("<p>1 < 2</p><p>4 <!-- 5", ["1 < 2", "4"]),
        ("<p>1</p><p>4 <b 5", ["1", "4 <b 5"]),
        ("<p>a <? b <p>c", ["a c"]),
        ("<p>x<p title='a>b\"' class=\"c>'\">d", ["x", "d"]),
    ],
)
def test_texts_of_raw_and_broken_markup(page, texts):
    assert [words for _, words in extraction.parse(page).texts] == texts


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<a<a" * 250_000, "<noscript>" * 100_000, "<p><button>" + "<div>" * 100_000, "<a ''" * 200_000 + '"', "</x>" * 200_000 + "<y>" * 50_000 + "</x>" * 50_000])
def test_pages_are_read_in_one_pass(page):
    started = time.process_time()
    extraction.parse(page)
    assert time.process_time() - started < 10  # what is not linear takes minutes


class Plain(HTMLParser):
    """Trees of pages without implied end tags, by the standard library."""

    def __init__(self, page):
        super().__init__()
        self.tree, self.stack, self.text = extraction.Tree(), [], []
        self.handle_starttag("html", [])
        self.feed(page)
        self.flush()

    def flush(self):
        if words := " ".join("".join(self.text).split()):
            self.tree.texts.append((self.stack[-1], words))
        self.text = []

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.tree.parent.append(self.stack[-1] if self.stack else -1)
        self.tree.depth.append(len(self.stack))
        self.tree.tags.append(tag)
        self.tree.attributes.append("".join(f' {k}="{v}"' for k, v in attrs))
        self.tree.linked.append(0)
        self.stack.append(len(self.tree.tags) - 1)

    def handle_endtag(self, tag):
        self.flush()
        self.stack.pop()

    def handle_data(self, data):
        self.text.append(data)


def test_query_against_all_labellings(spark, tmp_path, model):
    """Whole small pages: an independent parser, and marginals summed over every labelling of the tree."""
    rng = random.Random(8)
    words = lambda n: "".join(rng.choice(["word ", "&amp; ", "Größe ", "\n"]) for _ in range(n))

    def block(left):
        name, mark = rng.choice(["div", "section", "article", "nav", "footer", "aside"]), rng.choice(["", ' class="comments"', ' id="content"', ' class="ad"'])
        inside = "".join(block(left - 1) if left and rng.random() < 0.4 else f"<p>{words(rng.choice([2, 8, 70]))}</p>" for _ in range(rng.randint(1, 3)))
        return f"<{name}{mark}>{inside}</{name}>"

    pages = []
    while len(pages) < 25:
        page = "".join(block(1) for _ in range(rng.randint(1, 2)))
        if page.count("</") <= 9:
            pages.append(page)
    unary, edges = model
    want = []
    for page in pages:
        tree = Plain(page).tree
        forest = extraction.Forest.of([tree])
        scores, n = forest.features @ unary, len(forest.parent)
        total, on = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            weight = np.exp(scores @ np.array(y) + sum(edges[forest.kinds[i], y[p], y[i]] for i, p in enumerate(forest.parent) if p >= 0))
            total, on = total + weight, on + weight * np.array(y)
        want.append(" ".join(words for node, words in tree.texts if on[node] > total / 2))
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").selectExpr("*", "'u' AS url")
    got = extraction.query(spark, tables(tmp_path, pages=frame)).collect()
    assert {r.page_id: r.text for r in got} == dict(enumerate(want)) and len({bool(w) for w in want}) == 2
