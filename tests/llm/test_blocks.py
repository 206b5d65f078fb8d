import numpy as np
import pytest
from data import prose

from tidemark.llm import blocks


def page(k, main="article", paragraphs=6):
    text = [" ".join(prose(100 * k + j, 25)).capitalize() + "." for j in range(paragraphs)]
    nav = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in prose(k, 5))
    tag = main.split()[0]
    body = f"<h1>Title {k}</h1>" + "".join(f"<p><b>{t[:20]}</b>{t[20:]}" for t in text)
    html = (
        f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head><body><nav><ul>{nav}</ul></nav>'
        f'<!-- c --><div class="ad">Buy &amp; go</div><{main}>{body}</{tag}><aside><p>{text[0]}</p></aside><footer>&copy; x</footer></body></html>'
    )
    return html, " ".join([f"Title {k}", *text])


@pytest.fixture(scope="module")
def labeller(spark):
    rows = [(k, "u", page(k)[0]) for k in range(60)] + [(99, "u", None), (98, "u", "")]
    return blocks.fit(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_main_text_of_new_pages(spark, labeller):
    rows = [(k, "u", page(k, main)[0], "x") for k, main in ((200, "article"), (201, "main"), (202, 'div class="content"'), (203, "article"))]
    found = blocks.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), labeller).collect()
    assert {r.page_id: r.text for r in found} == {k: page(k, m)[1] for k, m in ((200, "article"), (201, "main"), (202, 'div class="content"'), (203, "article"))}
    assert all(r.n_chars == len(r.text) for r in found)


def test_hard_pages(spark, labeller):
    long = page(7, "article", 4000)
    rows = [(1, "u", None), (2, None, ""), (3, "u", "just text"), (4, "u", "<<<>< <p"), (5, "u", long[0]), (5, "u", long[0]), (None, "u", "<script>x")]
    found = blocks.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"), labeller).collect()
    assert len(found) == 7 and all(r.text is not None for r in found)
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == texts[2] == texts[None] == "" and texts[5] == long[1]
    assert blocks.extracted(spark.createDataFrame([], "page_id long, url string, html string"), labeller).collect() == []


def test_no_pages_to_learn_from(spark):
    assert isinstance(blocks.fit(spark.createDataFrame([], "page_id long, url string, html string")), blocks.Labeller)


def test_blocks_of_broken_html():
    found = blocks.blocks_of('<div id=Main-Box><p>a<br>b &lt;c&gt;<p>d <i>e</i>f<ul><li>g<li>h</ul></div>x<script>if(a<b)"</p>"</script> y<textarea><p>z</textarea>&am')
    assert [b.text for b in found] == ["a b <c>", "d ef", "g", "h", "x", "y", "&am"]
    assert found[0].path == ("div", ".main", ".box", "p") and found[2].path[-2:] == ("ul", "li") and found[4].path == ()


def test_gradients_of_the_network():
    """Backpropagation against differences of the loss."""
    rng = np.random.default_rng(1)
    net, d = blocks.Labeller(), blocks.PATH + blocks.WORDS + blocks.FIGURES
    x, mask = net._padded([rng.standard_normal((n, d)).astype(np.float32) for n in (5, 3)])
    up = rng.standard_normal((5, 2, blocks.UNITS)).astype(np.float32) * mask[..., None]
    wx, wh, b = (w.astype(np.float64) for w in net.weights[:3])
    loss = lambda *w: float((net._run(x, mask, *w)[0] * up).sum())
    states, kept = net._run(x, mask, wx, wh, b)
    grads = net._back(x, kept, up, wx, wh)
    for g, w in zip(grads, (wx, wh, b)):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape)
            keep = w[at]
            w[at] = keep + 1e-3
            high = loss(wx, wh, b)
            w[at] = keep - 1e-3
            low = loss(wx, wh, b)
            w[at] = keep
            assert abs((high - low) / 2e-3 - g[at]) < 2e-2 * max(1, abs(g[at]))


def test_a_head_that_is_not_closed():
    texts = lambda page: [b.text for b in blocks.blocks_of(page)]
    inside = "<meta charset=utf-8><title>t</title><link rel=x><style>p{}</style><script>1</script><template><p>u</p></template>\n"
    for start in ("<body>", "<div>", "", "<img src=x>", "<p>"):
        assert texts(f"<html><head>{inside}{start}one<p>two</p></html>") == ["one", "two"]
    assert texts(f"<html><head>{inside}</head><body>one<p>two</p>") == ["one", "two"]
    assert texts(f"<head><head><!-- c -->{inside}<body>one") == ["one"]


def test_quotes_in_a_tag():
    """A quote opens a string after = alone; markup never becomes text."""
    texts = lambda page: [b.text for b in blocks.blocks_of(page)]
    assert texts("<a title=it's href=x>hello</a> there") == ["hello there"]
    assert texts("""<p title="a > b" x='>' y = "1>2">one<p "odd" '>two<p a=">three""") == ["one", "two", "three"]
    assert texts("<p b=\"it's\">two</p>") == ["two"]
    assert blocks.blocks_of("<div class=it's id='Post \"x\"'>t</div>")[0].path == ("div", ".it", ".post", ".x")


NEUTRAL = {"article": "div", "main": "div", "nav": "div", "header": "div", "footer": "div", "aside": "div", "section": "div", "form": "div"}


def neutral(html):
    """The page with containers that say nothing: all are plain divisions without class, id or role."""
    import re

    html = re.sub(r"""\s(?:class|id|role)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", "", html)
    return re.sub(r"(</?)(\w+)", lambda m: m[1] + NEUTRAL.get(m[2].lower(), m[2]), html)


def test_pages_whose_containers_say_nothing(spark, sf):
    """The given pages, half of them to learn from; of the other half the names are taken away before labelling."""
    pages = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/pages.parquet")
    fitted = blocks.fit(pages.where("page_id % 2 = 0"))
    held = [(r.page_id, r.html) for r in pages.where("page_id % 2 = 1").collect()]
    main = kept_main = other = kept_other = 0
    for _, html in held:
        named, bare = blocks.blocks_of(html), blocks.blocks_of(neutral(html))
        if [b.text for b in named] != [b.text for b in bare]:
            continue
        marks = [blocks.marked(b.path) for b in named]
        assert all(blocks.marked(b.path) == -1 for b in bare)
        kept = fitted.probabilities([blocks.inputs(bare)])[0] >= 0.5
        main, kept_main = main + sum(m == 1 for m in marks), kept_main + sum(k for k, m in zip(kept, marks) if m == 1)
        other, kept_other = other + sum(m == 0 for m in marks), kept_other + sum(k for k, m in zip(kept, marks) if m == 0)
    assert main > 300 and other > 300
    assert kept_main >= 0.97 * main and kept_other <= 0.03 * other


def test_a_copied_page_is_drawn_once(spark):
    rows = [(k, "u", page(0)[0]) for k in range(400)] + [(k, "u", page(k)[0]) for k in range(1, 40)]
    fitted = blocks.fit(spark.createDataFrame(rows, "page_id long, url string, html string"), 30)
    again = blocks.fit(spark.createDataFrame(rows[399:], "page_id long, url string, html string"), 30)
    assert all(np.array_equal(a, b) for a, b in zip(fitted.weights, again.weights))
