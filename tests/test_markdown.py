import pytest
from pyspark.sql import functions as F

from lodestone.functions import markdown as M

CASES = [
    ("# A *b*\n\none\ntwo\n\nthree", "<h1>A <em>b</em></h1>\n<p>one\ntwo</p>\n<p>three</p>"),
    ("###### six ##\n####### seven\n#no", "<h6>six</h6>\n<p>####### seven\n#no</p>"),
    ("text\n- a\n* b\n+ **c** d\nafter\n1. x\n2) y", "<p>text</p>\n<ul><li>a</li>\n<li>b</li>\n<li><strong>c</strong> d</li></ul>\n<p>after</p>\n<ol><li>x</li>\n<li>y</li></ol>"),
    ("- a\n\n- b", "<ul><li>a</li></ul>\n<ul><li>b</li></ul>"),
    ("| A | B |\n|---|:-:|\n| 1 | **2** |\n| x \\| y | a<br>b |", "<table><thead><tr><th>A</th><th>B</th></tr></thead>\n<tbody><tr><td>1</td><td><strong>2</strong></td></tr>\n<tr><td>x | y</td><td>a<br>b</td></tr></tbody></table>"),
    ("| A |\n|---|", "<table><thead><tr><th>A</th></tr></thead>\n</table>"),
    ("| a |\n| b |", "<table><tbody><tr><td>a</td></tr>\n<tr><td>b</td></tr></tbody></table>"),
    ("---\n***\n- - -\n--", "<hr>\n<hr>\n<hr>\n<p>--</p>"),
    ("a & b &amp; &#233; < c > <script>x</script>", "<p>a &amp; b &amp; &#233; &lt; c &gt; &lt;script&gt;x&lt;/script&gt;</p>"),
    ("`a * b * <i>` and ``\\*not\\* \\[x\\] \\> 2 * 3 * 4", "<p><code>a * b * &lt;i&gt;</code> and <code></code>*not* [x] &gt; 2 * 3 * 4</p>"),
    ("one ` tick", "<p>one ` tick</p>"),
    ("[t*u*](https://x/a_b?c=1&d) ![p](q.png) [no] (x)", '<p><a href="https://x/a_b?c=1&amp;d">t<em>u</em></a> <img alt="p" src="q.png"> [no] (x)</p>'),
    ("<div class='x'>\ntext\n</div>", "<div class='x'>\n<p>text</p>\n</div>"),
    ("", ""),
    ("a\r\nb\rc", "<p>a\nb\nc</p>"),
    ("\\# not a heading\n\\- nor an item", "<p># not a heading\n- nor an item</p>"),
]


@pytest.fixture(scope="module")
def made(spark):
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)] + [(99, None)], "k int, t string")
    return {r.k: r.h for r in rows.select("k", M.to_html(F.col("t")).alias("h")).collect()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_blocks(made, k):
    assert made[k] == CASES[k][1]


def test_null_and_pages(spark, made):
    assert made[99] is None
    page = spark.createDataFrame([("A & B", "# x")], "a string, t string").select(M.page(F.col("a"), F.col("t"))).first()[0]
    assert page == '<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>A &amp; B</title></head><body>\n<h1>x</h1>\n</body></html>\n'


def test_a_long_document(spark):
    text = "\n".join(["# h", "", "| a | b |", "|---|---|", *["| 1 | *2* |"] * 3000, "", *["- item **x**"] * 3000, "", *["line"] * 3000])
    (html,) = spark.createDataFrame([(text,)], "t string").select(M.to_html(F.col("t"))).first()
    assert html.count("<td>") == 6000 and html.count("<li>") == 3000 and html.count("<p>") == 1 and html.endswith("line</p>")


def test_short_rows_are_dealt_out(spark):
    from lodestone.functions.sizes import dealt_out

    rows = dealt_out(spark.range(0, 1050, 1, 1), 100)
    assert rows.rdd.getNumPartitions() == 11 and sorted(r.id for r in rows.collect()) == list(range(1050))
    assert dealt_out(spark.range(0), 100).count() == 0
