"""Main text of pages: parsing, decoding against all choices, trees, whole pages."""

from __future__ import annotations

import random
import re
from html.parser import HTMLParser
from itertools import product

import numpy as np
import pytest

from pathgauge.llm import pages as g
from pathgauge.llm.boosting import Trees, boost


def blocks(html):
    nodes = g.Nodes()
    g.parse(nodes, 0, html)
    return nodes.text


def test_blocks_of_text():
    cases = {
        "": [],
        "plain  text": ["plain text"],
        "<p>a<p>b</p>c": ["a", "b", "c"],
        "<p><b>t<br><p>u": ["t", "u"],
        "<ul><li>a<li>b <i>c</i></ul>d": ["a", "b c", "d"],
        "<table><tr><td>1<td>2<tr><td>3</table>": ["1", "2", "3"],
        "x<!-- no -->y<!doctype z><?p?>": ["xy"],
        "<!-- never closed <p>x": [],
        "<script>var t='</p>';</script>a<style>p{}</style >b": ["ab"],
        "<script>never closed <p>x": [],
        "a &amp; b&nbsp;&#x41;&am &lt;p&gt;": ["a & b A&am <p>"],
        "&am<b>p;</b>": ["&amp;"],
        '<p title="a > b">x</p>': ["x"],
        "a < b <3 </> c": ["a < b <3 c"],
        "text <a href='x": ["text"],
        "<a " * 5: [],
        "</div></b>t": ["t"],
        "<h1>a<h2>b": ["a", "b"],
        "<div>a<span>b</div>c</span>d": ["ab", "cd"],
        "<svg><text>no</text></svg>yes": ["yes"],
        "<TITLE>no</TITLE><P>Yes": ["Yes"],
        "a" * 300_000: ["a" * 300_000],
    }
    for html, expected in cases.items():
        assert blocks(html) == expected, html[:80]


def test_deep_and_broken_pages_take_linear_time():
    for html in ("<div>" * 20_000 + "x", "<p>" * 20_000, "</b>" * 20_000, "<b>" * 20_000 + "</i>" * 20_000, "<a \"" * 20_000, "<" * 50_000):
        g.main_texts([html], g.by_element())


def test_decoding_against_all_choices():
    source = random.Random(2)
    for _ in range(60):
        nodes = g.Nodes()
        for k in range(source.randrange(2, 9)):
            parent = -1 if k == 0 else source.randrange(k)
            nodes.add(0, parent, 0 if k == 0 else nodes.depth[parent] + 1, "div", "")
        score = np.array([source.uniform(-2, 2) for _ in nodes.page])
        best = max(
            sum(s for s, open_ in zip(score[1:], choice) if open_)
            for choice in product((0, 1), repeat=len(score) - 1)
            if all(not o or p == 0 or choice[p - 1] for o, p in zip(choice, nodes.parent[1:]))
        )
        kept = g.kept_nodes(nodes, score)
        # Opened nodes are the kept ones and the wrappers above them.
        opened = set()
        for k in np.flatnonzero(kept):
            while k > 0:
                opened.add(int(k))
                k = nodes.parent[k]
        assert abs(sum(score[k] for k in opened) - best) < 1e-9


def test_trees_learn_an_interaction():
    source = np.random.default_rng(3)
    x = source.uniform(size=(3000, 5))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = boost(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95
    assert len(model.score(x[:0])) == 0


def article(source, k):
    sentence = lambda n: " ".join(f"word{source.randrange(99)}" for _ in range(n)).capitalize() + "."
    title, paragraphs = sentence(5), [sentence(source.randrange(5, 60)) for _ in range(source.randrange(1, 9))]
    links = "".join(f"<li><a href=/{w}>{w}</a>" for w in sentence(6).split())
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}" for p in paragraphs)
    around = [
        f"<nav><ul>{links}</ul></nav><article>{body}</article><footer>{sentence(6)}</footer>",
        f"<div class='top menu'>{links}</div><main>{body}</main><div class=comments><p>{sentence(30)}</div>",
        f"<div id=cookie-notice>{sentence(9)}</div><div class=post>{body}</div><aside>{sentence(20)}</aside><form>{sentence(3)}</form>",
    ][k % 3]
    return f"<!DOCTYPE html><html><head><title>{title}</title></head><body><script>x('<p>')</script>{around}</body></html>", "\n".join([title, *paragraphs])


def test_whole_pages(spark):
    source = random.Random(7)
    made = [article(source, k) for k in range(120)]
    rows = [(k, f"u{k}", html) for k, (html, _) in enumerate(made)]
    rows += [(500, None, None), (501, "u", ""), (None, "u", made[0][0]), (3, "u3", made[3][0])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as at")
    found = g.extract(frame).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.n_chars == len(r.text)
        if r.page_id is not None and r.page_id < 500:
            assert r.text == made[r.page_id][1]
    assert {r.page_id: r.text for r in found if r.page_id in (500, 501)} == {500: "", 501: ""}
    assert g.extract(frame.where("false")).collect() == []
    unnamed = g.extract(frame.where("page_id >= 500"))  # nothing to learn from
    assert {r.text for r in unnamed.collect()} == {""}


def test_names_decide_without_training(spark):
    html = "<nav>no</nav><article><p>yes</p><aside>no</aside></article>"
    assert g.main_texts([html], g.by_element()) == ["yes"]


def test_stray_quotes_and_unclosed_elements_keep_the_page():
    cases = {
        '<p class="x"">First part. </p><p class="y">Second part.</p>': ["First part.", "Second part."],
        "<p title=it's>First. </p><p>Second. </p>": ["First.", "Second."],
        "<p title=it's>First. </p><p title=it's>Second. </p>": ["First.", "Second."],
        "<p 'a>b</p>": ["b"],
        '<p title="never closed>a</p><p>b</p>': ["a", "b"],
        "<p title = 'a > b' x=\"c > d\"y=/>e": ["e"],
        "<svg><path d=x /><p>a</p>": ["a"],
        "<div>a<svg><text>no</text><style/></div>b": ["a", "b"],
        "<p>a<svg/>b <math><mi>x</mi></math>c": ["ab c"],
        "<svg><foreignObject><div>a</svg>b": ["ab"],
        "<script>no": [],
    }
    cases |= {f"<{name}><p>a</p><p>b</p>": ["a", "b"] for name in "noscript object video audio canvas template".split()}
    for html, expected in cases.items():
        assert blocks(html) == expected, html


def test_quotes_take_linear_time():
    for html in ("<a href='x\">" * 20_000, "<a x='" * 20_000 + ">", '<a x="\'>' * 20_000, "<svg><p>" * 20_000, "<a =" * 50_000 + ">"):
        blocks(html)


MISLEADING = [
    lambda h: h.replace("<article>", '<article class="post has-comments">').replace("<main>", '<main class="sidebar ads">'),
    *[
        lambda h, c=c: h.replace("<article>", f"<div class={c}>").replace("</article>", "</div>").replace("<main>", f"<div id={c}>").replace("</main>", "</div>")
        for c in ("related", "search", "form", "header", "share", "login", "legal", "notice")
    ],
    lambda h: h.replace("<nav>", '<div class="content main">').replace("</nav>", "</div>").replace("class='top menu'", "class=article-body"),
    lambda h: re.sub(r"<(/?)(article|main|nav|footer|aside|form|div)\b[^>]*>", r"<\1div>", h),  # no name at all
]


@pytest.mark.parametrize("change", range(len(MISLEADING)))
def test_names_that_mislead(change):
    """Shape decides against the words of class and id, and without any name."""
    source = random.Random(change)
    made = [article(source, 3 * (k // 2) + k % 2) for k in range(200)]
    made = [(MISLEADING[change](html), text) for html, text in made if len(text) >= g.SHOWN]
    nodes = g.Nodes()
    for k, (html, _) in enumerate(made):
        g.parse(nodes, k, html)
    x, y = g.features(nodes), g.seeds(nodes)
    model = g.learn(x[y >= 0], y[y >= 0].astype(float))
    found = g.main_texts([html for html, _ in made], model)
    assert sum(a == b for a, (_, b) in zip(found, made)) >= 0.95 * len(made)


def test_no_word_of_class_or_id_is_a_label():
    source = random.Random(4)
    pages = [article(source, k)[0] for k in range(60)]
    plain, named = g.Nodes(), g.Nodes()
    for k, html in enumerate(pages):
        g.parse(plain, k, re.sub(r" (class|id)=('[^']*'|[\w-]+)", "", html))
        g.parse(named, k, html)
    assert plain.hashed != named.hashed
    assert (g.seeds(plain) == g.seeds(named)).all()


def test_wrappers_are_no_side_matter():
    prose = "<p>" + "Some words of prose, and more. " * 20
    for html in (f"<form><nav>a</nav><article>{prose}</article></form>", f"<form>{prose}</form>"):
        nodes = g.Nodes()
        g.parse(nodes, 0, html)
        assert g.main_texts([html], g.by_element()) == [" ".join(prose[3:].split())]


class Plain(HTMLParser):
    """All text outside scripts and styles, as the standard library reads it."""

    def __init__(self):
        super().__init__()
        self.text, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


def test_no_text_is_lost_or_made_on_random_pages():
    source = random.Random(9)
    pieces = ["<p>", "</p>", "<div class='a b'>", "</div>", "<b>", "</b>", "<a href=x>", "</a>", "<ul><li>", "</ul>", "<br>", "<img src=x />", "<!-- c -->"]
    pieces += ["<table><tr><td>", "</table>", "<h2>", "</h3>", "word", " two words ", "&amp;", "&eacute;", "x &lt; y", "\n", "<script>if (a < b) '</p>'</script>", "<style>p{}</style>"]
    for _ in range(400):
        html = "".join(source.choice(pieces) for _ in range(source.randrange(40)))
        plain = Plain()
        plain.feed(html)
        plain.close()
        assert "".join("".join(blocks(html)).split()) == "".join("".join(plain.text).split()), html
