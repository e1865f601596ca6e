"""Dumps, tables and exports."""

import pytest
from pyspark.sql import functions as F

from termscape.operators import filters
from termscape.sources import dump, tables


def page(doc_id, title, text, ns=0, redirect=None, attributes=' xml:space="preserve" bytes="10"'):
    mark = f'<redirect title="{redirect}" />' if redirect else ""
    return (
        f"  <page>\n    <title>{title}</title>\n    <ns>{ns}</ns>\n    <id>{doc_id}</id>\n    {mark}"
        f"<revision>\n      <id>9{doc_id}</id>\n      <timestamp>2017-03-22T19:38:52Z</timestamp>\n"
        f"      <text{attributes}>{text}</text>\n    </revision>\n  </page>\n"
    )


PAGES = [
    page(1, "Sorting network", "'''Sorting''' [[networks|nets]] &amp; wires"),
    page(2, "Old name", "#REDIRECT [[Sorting network]]", redirect="Sorting network"),
    page(3, "Talk:Sorting", "chat", ns=1),
    page(4, "Mercury (disambiguation)", "may refer to"),
    page(5, "List", "a list"),
    page(6, "List of rivers", "rivers"),
    page(7, "Category:Rivers", "rivers"),
    page(8, "Template", "x"),
    page(9, "Empty", ""),
    page(10, "No attributes", "body text", attributes=""),
    page(11, "Café", "Über {{infobox|a=1}} größe"),
    page(12, "Mercury", "{{Disambig}} planets"),
    page(13, "redirected by text", "  #redirect [[x]]"),
    page(14, "The List", "not a listing"),
]


@pytest.fixture(scope="module")
def dump_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "dump.xml"
    path.write_text(
        "<mediawiki>\n  <siteinfo><sitename>W</sitename></siteinfo>\n" + "".join(PAGES) + "</mediawiki>\n"
    )
    return str(path)


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_every_page_is_read(spark, dump_file):
    pages = dump.parse_pages(dump.read_page_xml(spark, dump_file))
    assert ids(pages) == list(range(1, 15))
    by_id = {r["doc_id"]: r for r in pages.collect()}
    assert by_id[1]["markup"] == "'''Sorting''' [[networks|nets]] & wires"
    assert by_id[2]["redirect"] == "Sorting network" and by_id[3]["ns"] == 1
    assert by_id[10]["markup"] == "body text" and by_id[9]["markup"] == ""


def test_a_file_split_anywhere_gives_the_same_pages(spark, dump_file):
    whole = sorted(r["page_xml"] for r in dump.read_page_xml(spark, dump_file).collect())
    for size in ("97", "350"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            split = dump.read_page_xml(spark, dump_file)
            assert split.rdd.getNumPartitions() > 4
            assert sorted(r["page_xml"] for r in split.collect()) == whole
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_articles(spark, dump_file):
    docs = dump.read_dump(spark, dump_file)
    assert ids(docs) == [1, 10, 11, 14]
    contents = {r["doc_id"]: r["content"] for r in docs.collect()}
    assert contents[1] == "Sorting network\nSorting nets & wires"
    assert contents[11] == "Café\nÜber größe"


def test_exact_listing_titles(spark, dump_file):
    assert ids(dump.read_dump(spark, dump_file, match="exact")) == [1, 6, 7, 10, 11, 14]
    with pytest.raises(ValueError):
        dump.read_dump(spark, dump_file, match="other")


def test_broken_and_null_records_are_dropped(spark):
    raw = spark.createDataFrame(
        [(PAGES[0],), (None,), ("<page><title>Broken</page>",)], "page_xml string"
    )
    assert ids(dump.parse_pages(raw)) == [1]


@pytest.fixture
def docs(spark):
    rows = [(1, "A, \"quoted\" title", "line one\nline, two"), (2, "Ünï", "x\ty \"z\""), (3, "C", "")]
    return spark.createDataFrame(rows, "doc_id bigint, title string, content string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_documents_in_parquet(spark, docs, tmp_path):
    path = str(tmp_path / "docs")
    tables.write_documents(docs, path)
    assert rows(tables.read_documents(spark, path)) == rows(docs)
    with pytest.raises(Exception, match="exists"):
        tables.write_documents(docs, path)


def test_documents_in_csv(spark, docs, tmp_path):
    path = str(tmp_path / "docs")
    full = docs.where("content <> ''")
    tables.write_documents_csv(full, path)
    back = tables.read_documents_csv(spark, path)
    assert back.columns == ["doc_id", "title", "content"]
    assert rows(back) == rows(full)


def test_odd_texts_in_csv(spark, tmp_path):
    texts = [None, "", "a\nb\r\n", "back\\slash \\n \\\\n", "\\N", '"quoted", "x"', "\n", ",", "é\tx "]
    odd = spark.createDataFrame([(i, "t", t) for i, t in enumerate(texts)], tables.DOCUMENT_SCHEMA)
    tables.write_documents_csv(odd, str(tmp_path / "odd"))
    assert rows(tables.read_documents_csv(spark, str(tmp_path / "odd"))) == rows(odd)


def test_vocabulary_in_text(spark, tmp_path):
    vocabulary = spark.createDataFrame([(0, "der"), (1, "tab\there")], "term_id int, term string")
    tables.write_vocabulary_text(vocabulary, str(tmp_path / "v"))
    assert rows(tables.read_vocabulary_text(spark, str(tmp_path / "v"))) == rows(vocabulary)


def test_doc_ids_in_json(spark, docs, tmp_path):
    tables.write_doc_ids_json(docs, str(tmp_path / "ids"))
    back = tables.read_doc_ids_json(spark, str(tmp_path / "ids"))
    assert rows(back) == rows(docs.select("doc_id", "title"))


def test_stop_word_file(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\nand\n\nthe\n")
    assert tables.read_stop_words(spark, str(tmp_path / "stop.txt")) == ["and", "the"]


def test_locations(spark):
    at = tables.Locations.of(spark)
    assert at.matrix == "termscape-data/matrix"
    spark.conf.set("spark.termscape.base", "/data/x")
    try:
        assert tables.Locations.of(spark).concepts == "/data/x/svd"
    finally:
        spark.conf.unset("spark.termscape.base")


def test_title_filter(spark):
    titles = ["A", "List of x", "My Category", "Top 10", "Cat", "Category:x", "The List"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    assert [r["title"] for r in filters.filter_titles(df).collect()] == ["Cat", "The List"]


def test_title_lookups(spark, docs):
    assert filters.title_of(docs, 2) == "Ünï" and filters.title_of(docs, 99) == ""
    asked = spark.createDataFrame([(2,), (2,), (99,)], "doc_id bigint")
    assert rows(filters.titles_of(docs, asked)) == [(2, "Ünï"), (99, "")]
    assert ids(filters.find_by_title(docs, "QUOTED")) == [1]
    assert ids(filters.find_by_title(docs, "QUOTED", case_sensitive=True)) == []


def test_samples(spark):
    numbers = spark.range(20000).withColumnRenamed("id", "doc_id")
    first = filters.hash_sample(numbers, "doc_id", 0.3)
    assert abs(first.count() - 6000) < 300
    assert ids(first) == ids(filters.hash_sample(numbers.repartition(3), "doc_id", 0.3))
    assert abs(filters.random_sample(numbers, 0.3, seed=1).count() - 6000) < 400
    assert filters.random_sample(numbers, 1.5).count() == 20000
    assert filters.first_documents(numbers, -1).count() == 20000
    assert ids(filters.first_documents(numbers, 3)) == [0, 1, 2]


def test_hash_sample_does_not_depend_on_type(spark):
    as_int = spark.range(100).select(F.col("id").cast("int").alias("doc_id"))
    as_long = spark.range(100).withColumnRenamed("id", "doc_id")
    assert ids(filters.hash_sample(as_int, "doc_id", 0.5)) == ids(
        filters.hash_sample(as_long, "doc_id", 0.5)
    )


def test_pages_that_name_no_target_or_id(spark):
    page = "<page><title>{t}</title><ns>0</ns>{head}<revision><id>9</id><text>x {body}</text></revision></page>"
    raw = [
        page.format(t="a", head="<id>1</id><redirect/>", body=""),
        page.format(t="b", head='<id>2</id><redirect title="z" />', body=""),
        page.format(t="c", head="", body=""),
        page.format(t="d", head="<id>4</id>", body="&lt;redirect/&gt;"),
        "<page><broken", None,
    ]
    parsed = dump.parse_pages(spark.createDataFrame([(r,) for r in raw], "page_xml string"))
    assert [(r["doc_id"], r["redirect"]) for r in parsed.orderBy("doc_id").collect()] == [(1, ""), (2, "z"), (4, None)]
    assert [r["doc_id"] for r in dump.article_documents(parsed).collect()] == [4]
