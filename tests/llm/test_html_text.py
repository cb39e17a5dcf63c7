import html
import re

import pytest

from riskframe.llm import html_text as H


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return H.train(pages)


def article(page):
    """What the article element of a generated page holds."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in parts if x)


def test_held_out_pages(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    w = model.weigh()
    assert sum(H.main_text(r.html, model, w) == article(r.html) for r in rows) >= 0.99 * len(rows)
    bare = [re.sub(r"</?article>", "", r.html) for r in rows]
    assert sum(H.main_text(b, model, w) == article(r.html) for b, r in zip(bare, rows)) >= 0.95 * len(rows)


def test_pages_labelled_by_hand(model):
    right = total = 0
    for page in H.LABELLED:
        found = H.blocks(page)
        got = model.viterbi([model.weigh()(tuple(f for f in a + b if f != "data-main")) for _, a, b in found])
        right += sum(y == ("data-main" in a) for y, (_, a, _) in zip(got, found))
        total += len(found)
    assert right >= 0.95 * total


def test_odd_pages(spark, pages, model):
    deep = "<div>" * 5000 + "<p>Deep text.</p>" + "</div>" * 5000
    odd = [None, "", "   ", "plain words only", "<p>a &amp; b &lt;c&gt; &#233;&nbsp;&unknown; d", "<p>one<p>two<li>three<li>four",
           "<script>var x='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes, indeed.</p>", "<a href='x>y'>link</a", "<<>><p", deep,
           "<article>" + "<p>Word and word, again.</p>" * 20000 + "</article>", "<p title=\"unclosed quote>text</p>", "</div></p></x>"]
    df = spark.createDataFrame([(i, f"u{i}", h, "clash") for i, h in enumerate(odd)] + [(None, None, odd[6], None), (3, "u3", odd[3], "clash")],
                               "page_id long, url string, html string, text string")
    out = H.extract(df, model=model).collect()
    assert len(out) == len(odd) + 2 and all(r.n_chars == len(r.text) for r in out)
    by = {r.page_id: r.text for r in out}
    assert by[0] == by[1] == by[2] == "" and "no" not in by[6].split()
    assert by[10].count("\n\n") == 19999
    assert H.extract(pages.limit(0)).count() == 0


def test_blocks():
    got = [t for t, _, _ in H.blocks("<p>a\n b<b>c</b> d&amp;e<p>two<br>lines</p><ul><li>x<li>y</ul>tail<script>z</script>")]
    assert got == ["a bc d&e", "two lines", "x", "y", "tail"]


def test_viterbi_is_the_best_path(model):
    import itertools
    scores = [0.7, -1.2, 0.1, 2.0, -0.4, 0.3]
    s = model.steps

    def value(path):
        return s[2, path[0]] + sum(e * y for e, y in zip(scores, path)) + sum(s[a, b] for a, b in zip(path, path[1:]))
    assert tuple(model.viterbi(scores)) == max(itertools.product((0, 1), repeat=len(scores)), key=value)


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>t</title><body><article><p>Text</p></article>", ["Text"]),
    ("<head><meta charset=x><title>t</title><style>a</style><p>Text</p></head>", ["Text"]),
    ("<head><title>t</title>Plain words", ["Plain words"]),
    ("<head><script>no</script></head><body>Text", ["Text"]),
    ("<p>A <svg class='x'/>b</p><p>c</p>", ["A b", "c"]),
    ("<p>A <svg><svg/><title/><path/></svg>b</p><p>c</p>", ["A b", "c"]),
    ("<div><svg><title>no</title><g></div><p>Text</p>", ["Text"]),
    ("<article><svg><path d='x'><p>Text</p></article>", ["Text"]),
    ("<svg><g><svg>no</svg>no</g></svg><p>Text</p>", ["Text"]),
    ("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> holds.</p>", ["So x=1 holds."]),
    ("<p>A<math/>b</p>", ["Ab"]),
    ("<datalist><option>no<option>no</datalist><p>Text</p>", ["Text"]),
    ("<option>no<option>no<p>Text</p>", ["Text"]),
    ("<p>A<option>no</option>b", ["Ab"]),
    ("<select><option>no<option>no</select><p>Text</p>", ["Text"]),
    ("<noscript><iframe src=x></noscript><p>Text</p>", ["Text"]),
    ("<div><noscript>no</div><p>Text</p><noscript>no</noscript>", ["Text"]),
    ("<p>a</p><script>no <p>no</p>", ["a"]),
    ("<script>no</script foo><p>Text</p>", ["Text"]),
    *((f"<div>a<{x} id='y'>no<b>no</b></div><p>Text</p><{x}>no</{x}><p>more</p>", ["a", "Text", "more"])
      for x in ("object", "video", "audio", "canvas", "noscript", "select", "template")),
])
def test_elements_without_text_reach_no_further_than_they_do(page, want):
    assert [t for t, _, _ in H.blocks(page)] == want


def test_end_tags_find_their_element_at_any_depth():
    page = "<nav>" + "<font size=1>menu" * 100 + "</nav><article><p>" + "<a name=x>" * 100 + "<p>Text</p></article><ul><li>" + "<b>" * 100 + "<li>end</ul>"
    got = {t: a for t, a, _ in H.blocks(page)}
    assert got["menu" * 100][0] == "t:nav" and got["Text"] == ("t:article", "t:p") and got["end"] == ("t:ul", "t:li")
    many = "<font>".join(f"<p>{i}</p>" for i in range(20000))      # all stay open
    assert len(H.blocks(many, lambda f: 0.0)) == 20000
