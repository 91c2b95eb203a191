import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from citemill.llm import boosting, html_extract
from citemill.llm.html_dom import Blocks


@pytest.fixture(scope="module")
def model():
    return html_extract.train()


PROSE = "This is a sentence of the article, which goes on for a while. Then there is another one."
CASES = {
    "tags": (
        f"<html><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav><article><h1>Title &amp;c</h1>"
        f"<p>{PROSE}</p><p>a<b>b</b>c &lt;x&gt;<br>d</p></article><footer>&copy; nobody</footer></body></html>",
        f"Title &c\n{PROSE}\nabc <x> d",
    ),
    "divs": (
        f'<body><div class="header"><a href="/">Site</a></div><div id="menu"><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></div>'
        f'<div class="content"><h1>Head</h1><p>{PROSE}</p><p>{PROSE} More.</p><div class="ad">Buy this now.</div></div>'
        f'<div class="comments"><h3>Replies</h3><div class="comment"><p>I like it a lot.</p></div></div>'
        f'<div id="footer"><p>All about the site.</p></div>',
        f"Head\n{PROSE}\n{PROSE} More.",
    ),
    "untidy": (
        f"<nav><li><a href='q>'>Go</a><li><a href=r>On</a></nav><article><p><b>{PROSE}<br><p>Next  one\n\n here.",
        f"{PROSE}\nNext one here.",
    ),
    "silent": (f"<article><p>{PROSE}<script>var a='</p>';</script></p><style>p{{}}</style><p>End of it.</article>", f"{PROSE}\nEnd of it."),
    "empty": ("", ""),
    "only markup": ("<html><body><div></div>", ""),
    "comment": (f"<article><p>{PROSE}<!-- no <p> here --></p></article><!-- open", PROSE),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(model, name):
    html, want = CASES[name]
    assert html_extract.extract(model, [html]) == [want]


SILENT = "button select option svg annotation video audio canvas template noscript datalist".split()


@pytest.mark.parametrize("tag", SILENT)
def test_silent_elements_end_where_they_do(model, tag):
    article = f"<article><h1>Head</h1><p>{PROSE}</p><p>{PROSE} More.</p></article>"
    want = f"Head\n{PROSE}\n{PROSE} More."
    rest = f"<footer><{tag}>zzz</{tag}> &copy; nobody</footer></body>"
    for page in (
        f"<body><{tag}>zzz{article}",
        f"<body><div><{tag}>zzz</div>{article}{rest}",
        f"<body><{tag}>zzz{article}{rest}",
        f"<body><{tag}>zzz{article}<div>&copy; nobody</{tag}></div>".replace(f"</{tag}>", ""),
        f"<body>{article.replace('</h1>', f'<{tag}>zzz</h1>')}{rest}",
        f"<body>{article.replace('</h1>', f' <{tag}><p>zzz</p><!-- </{tag}> -->zzz</{tag}></h1>')}{rest}",
    ):
        assert "zzz" not in (found := html_extract.extract(model, [page])[0]), page
        assert found.startswith(want), page
    for raw in ("script", "style", "textarea", "title"):
        assert html_extract.extract(model, [f"<body>{article}<{raw}>zzz<p>{PROSE}</p>"]) == [want]


def test_formulas_and_objects_are_text(model):
    formula = (
        "<math><semantics><mrow><mi>E</mi> <mo>=</mo> <mi>mc</mi></mrow>"
        "<annotation encoding='application/x-tex'>zzz</annotation></semantics></math>"
    )
    page = f"<body><article><h1>Head</h1><p>{PROSE}</p><p>So {formula} <object data='a.b'>as drawn</object> holds. {PROSE}</p></article>"
    assert html_extract.extract(model, [page]) == [f"Head\n{PROSE}\nSo E = mc as drawn holds. {PROSE}"]


def test_many_open_silent_elements_take_linear_time():
    start = time.time()
    for page in ("<svg>" * 100_000, "<div><svg></div>" * 50_000, "<svg></p>" * 50_000, "<select><option>x" * 50_000):
        Blocks().add_page(page)
    assert time.time() - start < 30


def test_pages_do_not_influence_each_other(model):
    pages = [html for html, _ in CASES.values()]
    assert html_extract.extract(model, pages) == [html_extract.extract(model, [p])[0] for p in pages]


def test_unseen_made_up_pages(model):
    rows, labels = html_extract.training_rows(150, seed=77)
    assert ((model.score(rows) > 0) == (labels > 0)).mean() > 0.98


def test_given_pages(spark, small, model):
    """The article's own blocks, cut out by pattern, as all given pages have an article."""
    import re
    from html import unescape

    pages = spark.read.parquet(f"{small}/pages.parquet")
    for x in html_extract.main_text(pages, model).collect():
        inside = re.search(r"<article>(.*?)</article>", x.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert x.text == "\n".join(b for b in blocks if b)


def test_what_is_kept_lies_in_what_is_kept():
    r = np.random.default_rng(1)
    blocks = Blocks()
    for html, _ in CASES.values():
        blocks.add_page(html)
    judged, _ = blocks.features()
    for _ in range(200):
        scores = r.normal(size=len(judged))
        kept = blocks.decode(judged, scores)
        full = np.zeros(len(kept))
        full[judged] = scores
        assert all(kept[p] for k, p in enumerate(blocks.parent) if kept[k] and p >= 0)
        # No single subtree could be dropped, or one child added, to gain.
        for k, p in enumerate(blocks.parent):
            if p >= 0 and kept[p] and not kept[k]:
                assert full[k] <= 0 or blocks.leaf[k] is None


def test_trees_learn_what_no_single_number_tells():
    r = np.random.default_rng(2)
    rows = r.normal(size=(4000, 5)).astype(np.float32)
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(rows, labels)
    fresh = r.normal(size=(1000, 5)).astype(np.float32)
    truth = (fresh[:, 0] > 0) ^ (fresh[:, 1] > 0.3)
    assert ((trees.score(fresh) > 0) == truth).mean() > 0.95


def test_odd_pages(spark, model):
    rows = [(1, None), (2, ""), (3, "plain words without markup"), (3, "plain words without markup"), (4, "<p"), (5, "<a href=\"")]
    frame = spark.createDataFrame(rows, "id long, html string").withColumns({"text": F.lit(7), "_page": F.lit("p")})
    got = html_extract.main_text(frame, model).collect()
    assert sorted(got[0].asDict()) == ["_page", "html", "id", "text"] and len(got) == 6
    assert {x["_page"] for x in got} == {"p"} and all(x.text is not None for x in got)
    assert [x.text for x in got if x.id in (1, 2)] == ["", ""]
    assert html_extract.main_text(frame.limit(0), model).isEmpty()


def test_long_and_deep_pages_take_linear_time(model):
    start = time.time()
    long = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    assert html_extract.extract(model, [long])[0].count("\n") == 19_999
    html_extract.extract(model, ["<div>" * 3000 + PROSE, "<a href=\"" * 20_000, "<" * 50_000, "<p><b>" * 20_000 + "x"])
    assert time.time() - start < 60
