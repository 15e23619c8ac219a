from html.parser import HTMLParser

import pytest

from logcube.llm import html_extract as he
from logcube.llm.html_blocks import blocks
from logcube.llm.html_samples import page
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def model():
    return he.train()


def texts(html):
    return [b.text for b in blocks(html)]


def test_blocks_of_broken_html():
    assert texts('<p><b>one<br>two <i>x</i><p>three<ul><li>a<li>b &amp;&lt; c</ul>d') == ["one two x", "three", "a", "b &< c", "d"]
    assert texts('<script>var t="</p><p>no</p>";</script><style>p{}</style><!-- <p>no</p> --><title>no</title>yes') == ["yes"]
    assert texts('<div a="x>y">in</div></p></section> 3 < 4 <') == ["in", "3 < 4 <"]
    assert texts("") == texts("<p> \n </p>") == []
    path = blocks('<div class="a B-2" id=c><p>x</div>')[0].path
    assert path == ("div", ".a", ".b", ".2", ".c", "p")
    assert blocks('<p>ab <a href="/">cd</a></p>')[0].link_chars == 2


def test_drawings_formulas_and_frames_keep_the_text_around_them():
    assert texts('<p>one <svg class="i"/> two</p><iframe src=x /><p>three</p>') == ["one two", "three"]
    assert texts('<svg class="i"><p>one</p><p>two</p>') == ["one", "two"]  # never closed
    assert texts('<p>so <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds</p>') == ["so E=m holds"]
    assert texts("<noscript><p>one</p></noscript><object data=x>two</object><iframe>three</iframe>") == ["one", "two", "three"]
    assert texts("<template><p>no</p></template>yes") == ["yes"]
    assert texts("<div><template><p>no</div>yes") == ["yes"]
    assert texts('<script src="x" /><p>yes</p>') == ["yes"] and texts("<script>no<p>no") == texts("<textarea>no<p>no") == []
    assert [b.path for b in blocks("<svg><div>a</div>b")] == [("div",), ()]


class Article(HTMLParser):
    """Text inside <article>, by the standard library's parser: white space between
    block-level tags is one space, the outermost scripts and the like are left out."""

    LINE = {"a", "b", "i", "em", "strong", "span", "br", "svg", "path", "g", "text", "math", "mi", "mo", "mn", "code"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.hidden, self.parts = 0, 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.hidden += tag in ("script", "style", "title", "textarea", "template")
        self.parts.append(" " if tag == "br" else "" if tag in self.LINE else "\n") if self.inside else None

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if self.inside:
            self.parts.append("" if tag in self.LINE else "\n")
        self.inside -= tag == "article"
        self.hidden -= tag in ("script", "style", "title", "textarea", "template")

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.parts.append(data)

    @classmethod
    def of(cls, html):
        parser = cls()
        parser.feed(html or "")
        parser.close()
        return " ".join("".join(parser.parts).split())


EMBEDDED = [
    ('<h1>Title here</h1><p>First paragraph of it.</p><svg class="i"/><p>Second paragraph, which is longer than the first one.</p><p>Third of them.</p>', "Title here First paragraph of it. Second paragraph, which is longer than the first one. Third of them."),
    ("<h1>Title here</h1><p>First paragraph of it.</p><iframe src=x /><p>Second paragraph, which is longer.</p>", "Title here First paragraph of it. Second paragraph, which is longer."),
    ('<h1>Title here</h1><p>The law is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> in short.</p><p>And so on it goes.</p>', "Title here The law is E=m in short. And so on it goes."),
    ("<h1>Title here</h1><noscript><p>The picture shows a ship in the harbour.</p></noscript><p>Second paragraph, which is longer.</p>", "Title here The picture shows a ship in the harbour. Second paragraph, which is longer."),
    ('<h1>Title here</h1><object data="x"><p>The film shows a ship in the harbour.</p></object><p>Second paragraph, which is longer.</p>', "Title here The film shows a ship in the harbour. Second paragraph, which is longer."),
    ('<h1>Title here</h1><svg class="i"><p>First paragraph of it, behind a drawing that never ends.</p><p>Second paragraph.</p>', "Title here First paragraph of it, behind a drawing that never ends. Second paragraph."),
]


@pytest.mark.parametrize("article,want", EMBEDDED)
def test_articles_with_embedded_content(model, article, want):
    page = f'<html><head><title>x</title></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/a">All</a></li></ul></nav><article>{article}</article><footer><p>Imprint and other notices.</p></footer></body></html>'
    assert he.main_texts([blocks(page)], model) == [want]
    if "svg" not in article and "iframe" not in article:
        assert Article.of(page) == want


def test_long_and_unclosed_input_takes_linear_time():
    assert len(texts("<p>x" * 50_000)) == 50_000
    assert texts('<a href="' * 5_000 + "x")  # quotes that never end
    assert texts("<!-- never ends " + "<p>x" * 1000) == []


def test_held_out_pages(model):
    right = total = 0
    for k in range(10**6, 10**6 + 120):
        found, labels = page(k)
        if found:
            x, mask = he._padded([he.features(found)])
            right += sum((model.logits(x, mask)[0][:, 0] > 0) == labels)
            total += len(labels)
    assert right >= 0.985 * total


def test_gradients_are_those_of_the_loss():
    import numpy as np

    net, rng = he.Labeller(1), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = he._padded([rng.normal(size=(n, he.INPUTS)) for n in (5, 3)])
    x, y = x.astype(np.float64), rng.integers(0, 2, mask.shape)
    found, _ = net.gradients(x, mask, y)
    for name in ("fh", "bx", "out", "bb"):
        at = tuple(rng.integers(0, s) for s in net.p[name].shape)
        loss = []
        for step in (1e-3, -1e-3):
            net.p[name][at] += step
            loss.append(net.gradients(x, mask, y)[1])
            net.p[name][at] -= step
        assert abs((loss[0] - loss[1]) / 2e-3 - found[name][at]) < 1e-4, name


def test_pages_of_the_table(spark, model):
    """Every page of the tables gives its article, as another parser reads it."""
    for sf in (SF, SF.replace("0.001", "0.1")):
        pages = spark.read.parquet(f"{sf}/pages.parquet")
        got = {r.page_id: r.text for r in he.extract(pages, model).collect()}
        assert got == {r.page_id: Article.of(r.html) for r in pages.collect()}


def test_awkward_rows(spark, model):
    long = "<article>" + "<p>word word word.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>a b</p></article>", "x"), (3, "u", "no tags", "x"), (4, "u", long, "x"), (4, "u", long, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = he.extract(pages, model).collect()
    assert len(got) == 6 and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert [r.text for r in got if r.page_id == 4] == [" ".join(["word word word."] * 20_000)] * 2
    assert he.extract(pages.limit(0), model).count() == 0
