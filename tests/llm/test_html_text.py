"""Main text: marginals against all assignments, pages of known text."""

import itertools
import math

from ledgerbrook.llm import html_examples, html_text

MODEL = html_text.fit()


def test_marginals_are_exact():
    html = '<nav><ul><li><a href="/">a</a></li></ul></nav><div class="post"><p>Some text.</p><p>More.</p></div><p>x</p>'
    page = html_text.Page(html)
    nodes = page.nodes
    weight = dict.fromkeys(nodes, 0.0)
    total = 0.0
    for states in itertools.product((0, 1), repeat=len(nodes)):
        of = dict(zip(nodes, states, strict=True))
        if of[page.root]:
            continue
        log = 0.0
        for n in nodes:
            log += sum(MODEL.looks[x][of[n]] for x in html_text.looks(n) if x in MODEL.looks)
            if n.parent is not None:
                log += MODEL.edge(n)[of[n.parent]][of[n]]
        total += math.exp(log)
        for n in nodes:
            weight[n] += math.exp(log) * of[n]
    found = MODEL.marginals(page)
    assert all(math.isclose(found[n], weight[n] / total, abs_tol=1e-9) for n in nodes)


def test_the_layouts_themselves():
    right = total = 0
    for html in html_examples.pages():
        page = html_text.Page(html)
        html_text.label_by_marks(page)
        content = MODEL.marginals(page)
        for node, text in page.blocks:
            total += len(text)
            right += len(text) * ((content[node] >= 0.5) == bool(node.label))
    assert right / total > 0.97


PAGES = {
    "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    "<article><h1>A  title&nbsp;here</h1><p><b>Bold &amp; more<br><p>First para&#8217;s text.\n  Next line.</p><p>Of.</p>"
    "<script>var t='</p>';</script></article><footer>&copy; me &middot; you</footer></body></html>":
        "A title here\nBold & more\nFirst para’s text. Next line.\nOf.",
    '<body><div class="cookie-banner"><p>We use cookies to make things work for you.</p></div><main><h1>Head</h1><p>Body text one.</p>'
    '<form><p>Your mail</p><input></form><p>Body text two.</p></main><section id="comments"><p>Nice post, thank you for it.</p></section></body>':
        "Head\nBody text one.\nBody text two.",
    "": "",
}


def test_known_pages(spark):
    rows = [(i, None, h, "x") for i, h in enumerate(PAGES)] + [(7, "u", None, "x"), (None, "u", "<p", "x"), (1, "u", list(PAGES)[1], "x")]
    rows.append((8, "u", "<div><article><p>" + "Long words here. " * 30000 + "</p></article>", "x"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.extract(df, MODEL)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    by_id = {r["page_id"]: r for r in out.collect()}
    for i, text in enumerate(PAGES.values()):
        assert by_id[i]["text"] == text and by_id[i]["n_chars"] == len(text)
    assert by_id[7]["text"] == "" and by_id[8]["n_chars"] == 17 * 30000 - 1
    assert html_text.extract(df.where("false")).count() == 0


def test_the_pages_table(spark):
    """All of the article and nothing else, against a plain cut of the fixture's own template."""
    import html as entities
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [entities.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", body)]
        want = [" ".join(b.split()) for b in blocks]
        assert found[r["page_id"]] == "\n".join(b for b in want if b)


def test_formulas_stay_and_their_sources_do_not():
    page = html_text.Page(
        "<article><p>The formula <math><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow>"
        "<annotation encoding='tex'>E=mc^2</annotation></math> holds</p><object>Shown <b>instead</b></object></article>"
    )
    assert [text for _, text in page.blocks] == ["The formula E=mc2 holds", "Shown instead"]


def test_only_hidden_styles_hide():
    of = lambda style: "hidden" in html_text.Page(f"<div style='{style}'>x</div>").nodes[1].hints
    assert of("display:none") and of("color:red; DISPLAY : none") and of("visibility:hidden")
    assert not of("text-decoration:none") and not of("border:none;list-style:none") and not of("display:nonesuch")


def test_all_words_of_a_class_count():
    names = " ".join(f"aa{chr(97 + i)}" for i in range(20))
    node = html_text.Page(f"<div class='{names} widget'>x</div>").nodes[1]
    assert "hint=widget" in html_text.looks(node) and len([x for x in html_text.looks(node) if x.startswith("hint=")]) == 21


def test_stray_end_tags_take_linear_time():
    import time

    def took(n):
        start = time.perf_counter()
        html_text.Page("<div>" * n + "</section>" * n + "<dd>x" * 50)
        return time.perf_counter() - start

    took(1000)
    assert took(20_000) < 12 * max(took(4_000), 0.01)
