"""Markup removal on small pages."""

import time

import pytest
from pyspark.sql import functions as F

from termscape.functions import markup


def apply(spark, function, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()
    return [r["v"] for r in rows]


@pytest.mark.parametrize("source, plain", [
    ("plain text", "plain text"),
    ("'''Bold''' and ''italic''", "Bold and italic"),
    ("a [[Target|label]] b [[Plain]] c", "a label b Plain c"),
    ("x {{one|{{two|{{three}}}}}} y", "x y"),
    ("x {{a}} {{b|c=d}} y", "x y"),
    ("[[File:A.svg|thumb|A [[nested|caption]] here]] after", "after"),
    ("[[Category:Things]]end", "end"),
    ("see [https://example.org/x the page] and https://example.org/y .", "see the page and ."),
    ("fact<ref name=\"a\">source {{cite}}</ref> more<ref name=b/> end", "fact more end"),
    ("a <!-- hidden\nnote --> b", "a b"),
    ("== Heading ==\ntext", "Heading\ntext"),
    ("* one\n* two\n# three", "one\ntwo\nthree"),
    ("before\n{| class=\"t\"\n|-\n| cell {| inner |} \n|}\nafter", "before\nafter"),
    ("5 &lt; 6 &amp;amp; &#65;&#x42;", "5 < 6 &amp; AB"),
    ("A fact.<ref name=\"a/b\" /> Kept sentence. Second.<ref>x</ref> End.",
     "A fact. Kept sentence. Second. End."),
    ("url <ref name=http://x.org/y/>kept<ref name=\"c/d\">gone</ref> end", "url kept end"),
    ("<references/> caf&eacute; &uuml;ber &alpha;&beta; &nosuch; &AMP; &#38;lt;b&#38;gt; &amp;lt;",
     "café über αβ &nosuch; & &lt;b&gt; &lt;"),
    ("&#x0000041;&#00000000066; a&nbsp;b AT&T; x & y", "AB a b AT&T; x & y"),
    ("}} stray {{a}} {{b", "}} stray {{b"),
    ("unbalanced {{ stays [[ here", "unbalanced {{ stays [[ here"),
    ("a <b>c</b> d", "a c d"),
])
def test_wiki_text(spark, source, plain):
    assert apply(spark, markup.wiki_text, source) == [plain]


def test_deep_nesting_is_removed_whole(spark):
    deep = "start " + "{{x|" * 60 + "core" + "}}" * 60 + " end"
    assert apply(spark, markup.wiki_text, deep) == ["start end"]


def test_a_long_page_does_not_overflow(spark):
    page = "{|\n" + "| cell || cell\n" * 20000 + "|}\n" + "[[a|b]] word " * 20000
    (plain,) = apply(spark, markup.wiki_text, page)
    assert plain.split() == ["b", "word"] * 20000


def test_unclosed_markers_take_no_passes(spark):
    pages = ["{{" * 100_000 + "a", "[[" * 100_000 + "{{b}}", "}}" * 50_000 + "{{c}}" * 1000]
    start = time.time()
    first, second, third = apply(spark, markup.wiki_text, *pages)
    assert time.time() - start < 20
    assert first == pages[0] and second == "[[" * 100_000 and third == "}}" * 50_000


def test_html(spark):
    page = (
        "<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style></head><body>"
        "<script>var t=\"</p>\";</script><p>One<br>two &middot; &#8364;&#x20AC;</p><!-- no --></body>"
    )
    assert apply(spark, markup.html_title, page, "<p>no title</p>") == ["A & B", ""]
    assert apply(spark, markup.html_text, page) == ["One two · €€"]


def test_references_outside_unicode_stay(spark):
    assert apply(spark, markup.unescaped, "&#1114112; &#55296; &#0; &#128512;", None) == [
        "&#1114112; &#55296; &#0; 😀", None
    ]


UNCLOSED = ["<ref>", "<ref ", "<ref name=x/", "<!--", "[http://a ", "[http://a", "<a", "<script>", "<head ", "<style", "<title>", "{{", "{|", "[[", "]]", "[[a|", "''", "= ", "=  \t", "&", "&#", "__", "<math", "</ref ", "http:// "]


@pytest.mark.parametrize("function", [markup.wiki_text, markup.html_text, markup.html_title])
def test_unclosed_and_nested_markers_take_linear_time(spark, function):
    """100,000 markers without a partner, alone and before one that closes, and 10,000 nested pairs."""
    pages = [m * 100_000 for m in UNCLOSED] + [m * 100_000 + end for m, end in zip(UNCLOSED[:12], ("</ref>", "</ref>", "/>", "-->", "]", "]", ">", "</script>", "</head>", "</style>", "</title>", "}}"), strict=True)]
    pages += [a * 10_000 + "core" + b * 10_000 for a, b in (("{{", "}}"), ("{|", "|}"), ("[[", "]]"), ("[[a|", "]]"), ("<ref>", "</ref>"), ("<script>", "</script>"), ("<!--", "-->"))]
    start = time.time()
    assert len(apply(spark, function, *pages)) == len(pages)
    assert time.time() - start < 60  # one quadratic step on one page takes minutes


def test_pairs_inside_each_other(spark):
    deep = "[[a|x " * 2000 + "core" + " y]]" * 2000
    assert apply(spark, markup.wiki_text, deep, "[[File:x|" + deep + "]] z", "[[a|b [[c|d|e]] f|g]]", "<ref>a <ref name=b/> c</ref> d <ref>e", "<!-- a -- b --> c <!-- d", "{{a [[b}} c]]", "[[a <ref>]]</ref> b]]", "<ref>x</ref>a <ref name=http://x.org/y/>b") == [
        "x " * 2000 + "core" + " y" * 2000, "z", "g", "d e", "c <!-- d", "c]]", "a b", "a b",
    ]
