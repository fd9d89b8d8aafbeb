"""Nested markup: whose text is whose."""

from lodestone.operators import markup as M
from lodestone.operators import requirements as R


def blocks(spark, html):
    rows = M.text_blocks(spark.createDataFrame([(1, html)], "k int, html string"), "k", "html").orderBy("ord").collect()
    return [(r.tag, r.text) for r in rows]


def required(spark, html):
    return sorted((r.number, r.title, r.text) for r in R.extract_requirements(spark.createDataFrame([(1, html)], "k int, html string"), "k", "html").collect())


def test_heading_spans_have_their_own_text(spark):
    page = (
        "<body><header><h2>Disclosure 1-1 In the head</h2><p>no</p></header><div class='doc-body'><h2>Disclosure 302-3 Energy intensity</h2><p>Report the ratio.</p>"
        "<div><span class='heading'><span class='heading'>Disclosure 302-4</span><span class='heading'>Reduction of energy</span></span></div><p>Report <b>reductions</b>.</p></div><footer><p>About us</p></footer></body>"
    )
    assert required(spark, page) == [("302-3", "Energy intensity", "Report the ratio."), ("302-4", "Reduction of energy", "Report reductions.")]


def test_items_have_their_own_text(spark):
    html = "<ul><li>a<ul><li>i. one<li>ii. two<ol><li>deep</li></ol> more</ul>tail</li><li><p>para</p> rest</li></ul><li>alone<p>x<p>y"
    assert blocks(spark, html) == [("li", "atail"), ("li", "i. one"), ("li", "ii. two more"), ("li", "deep"), ("li", "rest"), ("p", "para"), ("li", "alone"), ("p", "x"), ("p", "y")]


def test_text_between_elements_is_nobodys(spark):
    html = "before<p>a</p>between<ul>in a list<li>b</li>after an item</ul><div>in a div</div><h2>c</h2>after<table><tr><td>cell</table>"
    assert blocks(spark, html) == [("p", "a"), ("li", "b"), ("h2", "c")]


def test_scope_ends_with_its_div(spark):
    assert blocks(spark, "<p>0</p><div class='doc-body'><div><p>1</p></div><p>2</div><p>3</p><div class='doc-body'><p>4</div>") == [("p", "1"), ("p", "2")]
    assert blocks(spark, "</div></div><p>0</p><div class=doc-body><p>1</div></div><p>2") == [("p", "1")]
    assert blocks(spark, "<div class='doc-bodyx'><p>0</div><p>1") == [("p", "0"), ("p", "1")]
    assert blocks(spark, "<div class='doc-body'><p>0<div><p>1") == [("p", "0"), ("p", "1")]


def test_hidden_elements(spark):
    html = "<nav><p>no<nav><p>no</nav><p>no</nav><p>a</p></header><p>b</p><header><h1>no</h1><footer><p>no</footer><p>no</header><p>c<footer><p>no"
    assert blocks(spark, html) == [("p", "a"), ("p", "b"), ("p", "c")]


def test_spans(spark):
    html = "<p>a <span>b</span></p></span><span class='x h2'>one<span>two</span><span class='heading'>three<br>four</span></span> rest<p><span class='heading'>in a paragraph</span> of it</p><span class='heading'>open"
    assert blocks(spark, html) == [("p", "a b"), ("h2", "one two three four"), ("p", "of it"), ("h2", "in a paragraph"), ("h2", "open")]
    assert blocks(spark, "<header><span class='heading'>no</span></header><h3>A<i>B</i></h3><span class='headings'>no</span><p>C<i>D</i>") == [("h3", "A B"), ("p", "CD")]


def test_odd_pages(spark):
    assert blocks(spark, None) == [] and blocks(spark, "") == [] and blocks(spark, "plain text, 1 < 2") == []
    assert blocks(spark, "<!-- <p>no</p> --><style>p{}</style><script>'<p>no</p>'</script><P CLASS=x>1 < 2 &lt;b&gt; &amp;lt; &#8217;&#x2019;&#0;&#233;\xa0&nbsp;z") == [("p", "1 < 2 <b> &lt; ’’&#0;é z")]
    rows = M.text_blocks(spark.createDataFrame([(1, "<p>a"), (2, "<p>b<ul>"), (3, "<li>c")], "k int, html string").repartition(1), "k", "html").collect()
    assert sorted((r.k, r.text) for r in rows) == [(1, "a"), (2, "b"), (3, "c")]


def test_guidance_ends_what_is_binding(spark):
    of = lambda line: required(spark, f"<h2>Disclosure 1-1 T</h2><p>a</p>{line}<p>b</p><h2>Disclosure 1-2 U</h2><p>c</p>")
    cut = [("1-1", "T", "a"), ("1-2", "U", "c")]
    assert of("<h3>Guidance</h3>") == of("<p>Background:</p>") == of("<li>Guidance for Disclosure 1-1</li>") == of("<p>GLOSSARY</p>") == cut
    assert of("<p>Guidance on it</p>")[0] == ("1-1", "T", "a\nGuidance on it\nb")


def test_tasks_grow_in_number_not_in_size(spark, monkeypatch):
    pages = spark.range(400).selectExpr("id k", "concat('<h2>T', id, '</h2>', repeat('<p>a &amp; b', 20)) html").repartition(2)
    whole = sorted(tuple(r) for r in M.text_blocks(pages, "k", "html").collect())
    monkeypatch.setattr(M, "TASK_CHARS", 10_000)
    found = M.text_blocks(pages, "k", "html")
    size = pages.selectExpr("sum(length(html)) n").first().n
    assert size > 80_000 and found.rdd.getNumPartitions() == -(-size // 10_000)
    assert sorted(tuple(r) for r in found.collect()) == whole and len(whole) == 400 * 21


def test_texts_without_references_stay(spark):
    assert blocks(spark, "<p>a; #38; b<p>&lt;&#38;&#x26;amp;<p>R&D") == [("p", "a; #38; b"), ("p", "<&&"), ("p", "R&D")]


def test_size_stands_for_the_length_of_markup(spark, monkeypatch):
    monkeypatch.setattr(M, "TASK_CHARS", 100)
    pages = spark.range(40).selectExpr("id k", "concat('<p class>a<i>b</i><p>', id) html", "50 size")
    found = M.text_blocks(pages, "k", "html", size="size")
    assert found.rdd.getNumPartitions() == 20
    assert sorted((r.k, r.text) for r in found.collect()) == sorted((k, t) for k in range(40) for t in ("ab", str(k)))
