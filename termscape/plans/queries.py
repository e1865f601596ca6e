"""Registered queries: name to function of (session, table folder).

Documents come from ``documents`` (title = source-id), markup from ``pages``, free-text questions
from ``benchmark`` and unseen documents from ``conversations``. Every query runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termscape.functions import markup
from termscape.functions import text as tx
from termscape.functions.stopwords import ENGLISH_174
from termscape.operators import (
    corpus_counts, dictionary, filters, matrix, postings, relevance, stats, svd, topic_queries, topics,
)
from termscape.operators.preprocessing import TermExtractor
from termscape.operators.terms import (
    analysed_forms, computed, document_lemmas, document_terms, lemma_words, terms_with,
)
from termscape.plans import jobs
from termscape.session import Scratch, discard, frozen, scratch_path, spread
from termscape.sources import dump, models, tables
from termscape.sources.growing import GrowingTable
from termscape.sources.tables import corpus
from termscape.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary of the full-rank concept model, of the EM topic model and of the checks of Spark's models by SQL.
SMALL_VOCABULARY = 200
EM_TOPICS, EM_STEPS = 4, 3
#: Topics and iterations of Spark's models, and of the small ones that SQL checks.
LDA_TOPICS, LDA_STEPS = 20, 20
SMALL_TOPICS, SMALL_STEPS = 5, 10

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str, *key: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"), *key)


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return corpus(table(spark, folder, "documents", "doc_id"))


def titles(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and titles alone; the text is not read."""
    return corpus(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "title")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages", "page_id")


def terms(spark: SparkSession, folder: str) -> DataFrame:
    return document_terms(docs(spark, folder))


# Fitted matrices and models, kept per application as a user keeps a saved model: the first query
# that needs one fits it and writes its tables, the others read them.
_fitted: dict[tuple, object] = {}


def _once(spark: SparkSession, folder: str, name: str, fit: Callable[[], object]):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _fitted:
        _fitted[key] = fit()
    return _fitted[key]


def full_matrix(spark, folder) -> matrix.TermMatrix:
    return _once(spark, folder, "matrix", lambda: matrix.build_matrix(terms(spark, folder)))


def full_postings(spark, folder) -> postings.Postings:
    def store():
        path = scratch_path(spark, "postings")
        postings.write_postings(full_matrix(spark, folder), path)
        return postings.read_postings(spark, path)

    return _once(spark, folder, "postings", store)


def small_matrix(spark, folder) -> matrix.TermMatrix:
    return _once(
        spark, folder, "small", lambda: matrix.build_matrix(terms(spark, folder), SMALL_VOCABULARY)
    )


def full_rank_concepts(spark, folder) -> svd.ConceptModel:
    """With as many concepts as terms, every answer equals one on the matrix itself."""
    small = small_matrix(spark, folder)
    return _once(spark, folder, "full rank", lambda: svd.fit_concepts(small, small.n_terms))


def truncated_concepts(spark, folder) -> svd.ConceptModel:
    return _once(
        spark, folder, "concepts", lambda: svd.fit_concepts(full_matrix(spark, folder), 20)
    )


def em_topics(spark, folder) -> topics.TopicModel:
    return _once(
        spark, folder, "em",
        lambda: topics.fit_em(small_matrix(spark, folder), EM_TOPICS, EM_STEPS),
    )


def ml_topics(spark, folder) -> topics.TopicModel:
    return _once(
        spark, folder, "lda",
        lambda: topics.fit_lda(full_matrix(spark, folder), LDA_TOPICS, LDA_STEPS),
    )


def small_ml_topics(spark, folder) -> topics.TopicModel:
    return _once(
        spark, folder, "small lda",
        lambda: topics.fit_lda(small_matrix(spark, folder), SMALL_TOPICS, SMALL_STEPS),
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def token_digest(source: DataFrame, tokens: Column) -> DataFrame:
    """Count, distinct count and a digest of the token sequence of every document."""
    counted = computed(source, ["doc_id"], tokens=tokens)
    return counted.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).cast("bigint").alias("n_unique"),
        F.md5(F.array_join("tokens", " ")).alias("digest"),
    )


# Text and terms


@query
def tok_whitespace(spark, folder):
    return token_digest(docs(spark, folder), tx.whitespace_tokens(F.col("content")))


@query
def tok_letters(spark, folder):
    return token_digest(docs(spark, folder), tx.words(F.col("content")))


@query
def stopwords_default(spark, folder):
    tokens = tx.without_stop_words(tx.whitespace_tokens(F.col("content")))
    return token_digest(docs(spark, folder), tokens)


@query
def stopwords_file_case(spark, folder):
    tokens = tx.without_stop_words(tx.words(F.col("content")), ENGLISH_174, case_sensitive=True)
    return token_digest(docs(spark, folder), tokens)


@query
def terms_clean(spark, folder):
    return token_digest(docs(spark, folder), tx.clean_terms(F.col("content")))


@query
def terms_clean_case(spark, folder):
    """As in the second preprocessing path: 174 stop words, matched in their own case."""
    tokens = tx.clean_terms(F.col("content"), ENGLISH_174, case_sensitive=True)
    return token_digest(docs(spark, folder), tokens)


@query
def suffix_lemmas(spark, folder):
    tokens = tx.clean_terms(F.col("content"), normalizer=tx.strip_suffix)
    return token_digest(docs(spark, folder), tokens)


def corpus_lemmas(source: DataFrame) -> DataFrame:
    """Lemma table of the corpus: a form and its stem where the stem is a word of the corpus too."""
    words = computed(source, [], words=F.array_distinct(tx.words(F.col("content"))))
    forms = frozen(words.select(F.explode("words").alias("word")).select(
        F.lower("word").alias("form")
    ).distinct(), "forms")
    stems = forms.select("form", tx.strip_suffix(F.col("form")).alias("lemma")).where(
        F.col("form") != F.col("lemma")
    )
    return stems.join(forms.withColumnRenamed("form", "lemma"), "lemma", "left_semi")


@query
def lemma_lookup(spark, folder):
    source = docs(spark, folder)
    profile = stats.term_profile(lemma_words(source, corpus_lemmas(source)), "words")
    return profile.withColumnRenamed("term", "lemma")


@query
def lemma_terms(spark, folder):
    source = docs(spark, folder)
    found = document_lemmas(source, corpus_lemmas(source))
    return token_digest(found, F.sort_array("terms"))


@query
def normalizer_hook(spark, folder):
    """Terms of a text analyser of the user's own, set up once per task."""

    def make():
        import re

        word = re.compile(r"[^\W\d_]+")
        return lambda text: word.findall(text.lower())

    return token_digest(terms_with(docs(spark, folder), make), F.col("terms"))


@query
def analyser_lemmas(spark, folder):
    """A word analyser of the user's own, run once per distinct form of the corpus: here one that cuts suffixes."""
    rules = tx.SUFFIX_RULES

    def make():
        def analyse(form):
            for suffix, replacement, shortest in rules:
                if form.endswith(suffix) and len(form) >= shortest:
                    return form[: len(form) - len(suffix)] + replacement
            return None

        return analyse

    source = docs(spark, folder)
    return token_digest(document_lemmas(source, frozen(analysed_forms(source, make), "analysed")), F.col("terms"))


# Pages


@query
def html_to_text(spark, folder):
    read = computed(
        pages(spark, folder), ["page_id"],
        title=markup.html_title(F.col("html")), content=markup.html_text(F.col("html")),
    )
    return read.select(
        F.col("page_id").alias("doc_id"), "title",
        F.length("content").cast("bigint").alias("n_chars"), F.md5("content").alias("digest"),
    )


@query
def title_filter(spark, folder):
    titled = computed(pages(spark, folder), ["page_id"], title=markup.html_title(F.col("html")))
    return filters.filter_titles(titled)


@query
def page_filter(spark, folder):
    """Articles among dump records of all kinds: the id of a page says which kind its record is."""
    def kind(n: int, k: int) -> Column:
        return F.pmod(F.col("page_id"), F.lit(n)) == k

    read = computed(
        pages(spark, folder), ["page_id"],
        plain=markup.html_title(F.col("html")), visible=markup.html_text(F.col("html")),
    )
    title = F.when(kind(13, 3), F.concat("plain", F.lit(" (disambiguation)"))).when(
        kind(17, 4), F.concat(F.lit("List of "), "plain")
    ).otherwise(F.concat(F.lit("About "), "plain"))
    text = (
        F.when(kind(19, 5), F.concat(F.lit("#REDIRECT [[x]] "), "visible"))
        .when(kind(23, 6), F.concat(F.lit("{{Disambig}} "), "visible"))
        .when(kind(29, 7), F.lit(" "))
        .otherwise(F.col("visible"))
    )
    head = F.when(kind(11, 2), F.lit('<redirect title="x" />')).when(kind(7, 6), F.lit("<redirect/>"))
    record = page_records("page_id", title, text, F.when(kind(5, 1), 1).otherwise(0), F.coalesce(head, F.lit("")))
    nameless = F.regexp_replace(record, "<id>[0-9]+</id>\\s*<revision>", "<revision>")
    broken = F.when(kind(31, 8), F.lit(None)).when(kind(37, 9), F.substring(record, F.lit(1), F.length(record) - 20))
    records = read.select(F.when(kind(31, 8) | kind(37, 9), broken).when(kind(41, 10), nameless).otherwise(record).alias("page_xml"))
    kept = dump.article_documents(dump.parse_pages(records), title_line=False)
    return kept.select(F.col("doc_id").alias("page_id"), "title")


def page_records(
    key: str, title: Column, text: Column, namespace: Column | None = None, head: Column | None = None
) -> Column:
    """Dump records of pages."""
    def escaped(text: Column) -> Column:
        for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(char), F.lit(name))
        return text

    return F.concat(
        F.lit("<page>\n  <title>"), escaped(title),
        F.lit("</title>\n  <ns>"), (F.lit("0") if namespace is None else namespace.cast("string")),
        F.lit("</ns>\n  "), (F.lit("") if head is None else head), F.lit("<id>"), F.col(key).cast("string"),
        F.lit("</id>\n  <revision>\n    <id>1</id>\n    <text xml:space=\"preserve\" bytes=\"1\">"),
        escaped(text), F.lit("</text>\n  </revision>\n</page>"),
    ).alias("page_xml")


def page_xml(source: DataFrame) -> DataFrame:
    """The web pages as dump records, their visible text as the page text."""
    html = F.col("html")
    return source.select(
        page_records("page_id", markup.html_title(html), markup.html_text(html))
    )


def page_digest(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "doc_id", "title", F.length("markup").cast("bigint").alias("n_chars"),
        F.md5("markup").alias("digest"),
    )


@query
def xml_pages(spark, folder):
    """XML held in a column."""
    return page_digest(dump.parse_pages(page_xml(pages(spark, folder))))


@query
def xml_scan(spark, folder):
    """XML in files: the pages are written as a dump and read back as page records."""
    path = scratch_path(spark, "dump")
    page_xml(pages(spark, folder)).write.text(path)
    return page_digest(dump.parse_pages(dump.read_page_xml(spark, path)))


def wiki_markup(words: Column) -> Column:
    """An article that shows the words one by one, each in some markup, after a box, a table and a
    heading."""
    forms = (
        ("", ""), ("'''", "'''"), ("[[Some page|", "]]"), ("[[", "]]"), ("<!-- a {{b}} -->", ""),
        ("", "<ref name=\"r\">see {{cite|{{x}}}}</ref>"), ("[https://example.org/a ", "]"),
        ("''", "''"), ("{{note|[[x]]}} ", ""), ("[[File:a.png|thumb|[[b|c]] d]] ", ""),
        ("", "<ref name=\"a/b\" />"), ("<ref name=http://x.org/y/>", ""),
    )
    # accented letters as the references that stand for them
    references = {"é": "&eacute;", "ü": "&#252;", "ñ": "&#x0000F1;"}

    def marked(word: Column, i: Column) -> Column:
        variant = F.pmod(i, F.lit(len(forms)))
        for char, reference in references.items():
            word = F.replace(word, F.lit(char), F.lit(reference))
        shown = F.concat(F.lit(forms[0][0]), word, F.lit(forms[0][1]))
        for at, (before, after) in enumerate(forms[1:], 1):
            wrapped = F.concat(F.lit(before), word, F.lit(after))
            shown = F.when(variant == at, wrapped).otherwise(shown)
        return shown

    box = "{{Infobox|a={{b|{{c}}}}|d=1}}\n{| class=x\n| cell || {| inner |}\n|}\n== History ==\n"
    return F.concat(F.lit(box), F.array_join(F.transform(words, marked), " "))


def wiki_pages(spark, folder) -> DataFrame:
    """Page records whose markup shows the words of the documents."""
    found = computed(docs(spark, folder), ["doc_id", "title"], words=tx.words(F.col("content")))
    return found.select(page_records("doc_id", F.col("title"), wiki_markup(F.col("words"))))


@query
def wiki_to_text(spark, folder):
    """Articles of a dump in plain text. The markup shows the words of the documents, so the text
    must be those words."""
    articles = dump.article_documents(dump.parse_pages(wiki_pages(spark, folder)))
    read = computed(articles, ["doc_id", "title"], content=F.col("content"))
    return read.select(
        "doc_id", "title", F.length("content").cast("bigint").alias("n_chars"),
        F.md5("content").alias("digest"),
    )


# Filters, samples and lookups


@query
def min_terms(spark, folder):
    usable = filters.with_min_terms(terms(spark, folder))
    return usable.select("doc_id", "title", F.size("terms").cast("bigint").alias("n_terms"))


# Written and read again


def reread(spark, write, read, label):
    """Write below a new folder, read back, and keep a copy, so that the folder can go."""
    path = scratch_path(spark, label)
    write(path)
    kept = frozen(read(path), label)
    discard(spark, path)
    return kept


def document_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "title", F.length("content").cast("bigint").alias("n_chars"), F.md5("content").alias("digest")
    )


@query
def saved_documents(spark, folder):
    source = docs(spark, folder)
    return reread(
        spark, lambda path: tables.write_documents(source, path),
        lambda path: document_digest(tables.read_documents(spark, path)), "saved-documents",
    )


@query
def saved_documents_csv(spark, folder):
    source = docs(spark, folder)
    return reread(
        spark, lambda path: tables.write_documents_csv(source, path),
        lambda path: document_digest(tables.read_documents_csv(spark, path)), "saved-csv",
    )


@query
def saved_doc_ids(spark, folder):
    source = titles(spark, folder)
    return reread(
        spark, lambda path: tables.write_doc_ids_json(source, path),
        lambda path: tables.read_doc_ids_json(spark, path), "saved-ids",
    )


@query
def saved_matrix(spark, folder):
    """Below the folder that the session's settings name."""
    built = full_matrix(spark, folder)

    def read(path):
        return rounded(models.load_matrix(spark, tables.Locations(path).matrix).named_entries(), 6, "tfidf")

    return reread(
        spark, lambda path: models.save_matrix(built, tables.Locations(path).matrix), read, "saved-matrix"
    )


@query
def saved_vocabulary(spark, folder):
    vocabulary = full_matrix(spark, folder).vocabulary
    return reread(
        spark, lambda path: tables.write_vocabulary_text(vocabulary, path),
        lambda path: tables.read_vocabulary_text(spark, path), "saved-vocabulary",
    )


@query
def saved_graph(spark, folder):
    built = full_matrix(spark, folder)
    return reread(
        spark, lambda path: models.save_graph(built, path),
        lambda path: rounded(spark.read.parquet(f"{path}/edges"), 6, "weight"), "saved-graph",
    )


@query
def saved_stop_words(spark, folder):
    """Terms cleaned with a stop-word list that was read from a file: the corpus' 50 commonest tokens."""
    found = stats.term_frequency(terms(spark, folder)).orderBy(F.desc("tf"), "term").limit(50)
    path = scratch_path(spark, "stop-words")
    found.select("term").write.text(path)
    words = tables.read_stop_words(spark, path)
    discard(spark, path)
    cleaned = document_terms(docs(spark, folder), words)
    return stats.term_frequency(cleaned)


@query
def saved_concepts(spark, folder):
    model = full_rank_concepts(spark, folder)

    def read(path):
        back = models.load_concepts(spark, path)
        return rounded(relevance.docs_for_terms(back), 6, "score")

    return reread(spark, lambda path: models.save_concepts(model, path), read, "saved-concepts")


@query
def saved_topics(spark, folder):
    model = em_topics(spark, folder)

    def read(path):
        back = models.load_topics(spark, path)
        return rounded(topic_queries.document_topics(back), 6, "weight")

    return reread(spark, lambda path: models.save_topics(model, path), read, "saved-topics")


@query
def fold_in_of_training(spark, folder):
    """The corpus' own documents, folded in, give the entries that the matrix has, whatever its threshold."""
    found = terms(spark, folder)
    loose = matrix.build_matrix(found, min_tf=1)
    again = matrix.with_new_documents(loose, filters.with_min_terms(found))
    return again.entries().groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("tfidf"), 5).alias("total")
    )


def folded_training(spark, folder, extractor: TermExtractor, **sizes: int) -> DataFrame:
    """Entries of the corpus' own documents by a matrix that was saved and loaded: those that the matrix has."""
    source = docs(spark, folder)

    def read(path):
        back = models.load_matrix(spark, path)
        again = matrix.with_new_documents(back, filters.with_min_terms(back.extractor.transform(source)))
        return rounded(again.named_entries(), 6, "tfidf")

    built = matrix.build_from(source, extractor, **sizes)
    return reread(spark, lambda path: models.save_matrix(built, path), read, "folded-training")


@query
def fold_in_training_default(spark, folder):
    return folded_training(spark, folder, TermExtractor())


@query
def fold_in_training_book(spark, folder):
    extractor = TermExtractor(ENGLISH_174, case_sensitive=True)
    return folded_training(spark, folder, extractor, size=20000, min_df=1, min_tf=1)


@query
def fold_in_training_suffixes(spark, folder):
    return folded_training(spark, folder, TermExtractor(normalizer=tx.suffix_rules_sql()))


@query
def fold_in_training_lemmas(spark, folder):
    return folded_training(spark, folder, TermExtractor(lemmas=corpus_lemmas(docs(spark, folder))))


@query
def concept_rank(spark, folder):
    """As many concepts as the matrix has independent columns, each column of U of length 1."""
    model = full_rank_concepts(spark, folder)
    sums = model.doc_factors.select(F.posexplode("us").alias("concept", "x")).groupBy("concept").agg(F.sum(F.col("x") * F.col("x")).alias("square"))
    joined = sums.join(model.concepts, "concept")
    unit = F.abs(F.sqrt("square") / F.col("sigma") - 1) < 1e-6
    return joined.agg(F.bool_and(unit).alias("unit"), F.round(F.sum(F.col("sigma") * F.col("sigma")), 2).alias("energy"))


@query
def sample_hash(spark, folder):
    return filters.hash_sample(titles(spark, folder), "doc_id", 0.25)


@query
def sample_random(spark, folder):
    return filters.random_sample(titles(spark, folder), 0.25, seed=7)


@query
def doc_cap(spark, folder):
    return filters.first_documents(titles(spark, folder), 100)


@query
def docs_by_title(spark, folder):
    return filters.find_by_title(titles(spark, folder), "SRC1-")


@query
def docs_by_body(spark, folder):
    return rounded(postings.find_by_term(full_postings(spark, folder), "und"), 6, "weight")


@query
def docs_by_body_rare(spark, folder):
    """The vocabulary's last term: fewer documents than asked for have it, so others follow."""
    lists = full_postings(spark, folder)
    last = lists.vocabulary.agg(F.max("term_id")).first()[0]
    return rounded(postings.find_by_term(lists, last, 1000), 6, "weight")


@query
def docs_by_body_each_term(spark, folder):
    """Every term of the vocabulary in one pass."""
    lists = full_postings(spark, folder)
    return rounded(postings.find_by_terms(lists, lists.vocabulary), 6, "weight")


@query
def doc_title(spark, folder):
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    ids = conversations.select((F.col("conv_id") * 7).alias("doc_id"))
    return filters.titles_of(titles(spark, folder), ids)


@query
def row_ids(spark, folder):
    """Unique ids for rows without a key: as many ids as documents."""
    numbered = matrix.with_row_ids(titles(spark, folder).select("title"))
    return numbered.agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("id").alias("ids")
    )


# Corpus statistics


@query
def funnel_report(spark, folder):
    report = stats.preprocessing_funnel(docs(spark, folder), normalizer=tx.strip_suffix)
    return rounded(report, 6, "tokens_per_doc", "unique_per_doc")


@query
def token_totals(spark, folder):
    return rounded(stats.token_totals(terms(spark, folder)), 6, "tokens_per_doc")


@query
def distinct_totals(spark, folder):
    return rounded(stats.distinct_totals(terms(spark, folder)), 6, "unique_per_doc")


@query
def distinct_totals_sketch(spark, folder):
    """The sketched distinct count lies within 10 percent of the exact one."""
    found = terms(spark, folder)
    exact = stats.distinct_totals(found).first()["unique_tokens"]
    sketch = stats.distinct_totals(found, approximate=True)
    close = F.abs(F.col("unique_tokens") / F.lit(exact) - 1) < 0.1
    return sketch.select(close.alias("close"), F.round("unique_per_doc", 6).alias("unique_per_doc"))


@query
def longest_document(spark, folder):
    return stats.longest_document(terms(spark, folder))


@query
def usable_documents(spark, folder):
    return stats.usable_documents(terms(spark, folder))


@query
def term_freq(spark, folder):
    return stats.term_frequency(terms(spark, folder)).orderBy(F.desc("tf"), "term")


@query
def doc_freq(spark, folder):
    return stats.document_frequency(terms(spark, folder)).orderBy(F.desc("df"), "term")


@query
def tf_df_join(spark, folder):
    return stats.term_profile(terms(spark, folder))


@query
def column_summary(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    summary = stats.column_summary(documents, "lang", "source", "n_chars")
    return summary.withColumn("n_chars", F.round(F.col("n_chars").cast("double"), 4))


@query
def vocab_diff(spark, folder):
    """Vocabularies of the two stop-word treatments, term by term."""
    source = docs(spark, folder)
    left = matrix.fit_vocabulary(document_terms(source), min_df=1)
    right = matrix.fit_vocabulary(
        document_terms(source, ENGLISH_174, case_sensitive=True), min_df=1
    )
    return stats.vocabulary_difference(left, right)


# Document-term matrix


@query
def vocab_fit(spark, folder):
    usable = filters.with_min_terms(terms(spark, folder))
    return matrix.fit_vocabulary(usable)


@query
def tf_matrix(spark, folder):
    return full_matrix(spark, folder).named_entries().select("doc_id", "term", "tf")


@query
def idf_weights(spark, folder):
    return rounded(full_matrix(spark, folder).vocabulary, 9, "idf")


@query
def tfidf_matrix(spark, folder):
    """The whole path from text to weights, fitted afresh."""
    built = matrix.build_matrix(terms(spark, folder))
    return rounded(built.named_entries(), 6, "tfidf")


@query
def tfidf_matrix_lemmas(spark, folder):
    """The whole path with words brought to their lemmas first."""
    source = docs(spark, folder)
    built = matrix.build_from(source, TermExtractor(lemmas=corpus_lemmas(source)))
    return rounded(built.named_entries(), 6, "tfidf")


@query
def book_matrix_lemmas(spark, folder):
    """The second path with words brought to their lemmas first; stop words are lemmas in their own case."""
    source = docs(spark, folder)
    extractor = TermExtractor(ENGLISH_174, case_sensitive=True, lemmas=corpus_lemmas(source))
    built = matrix.build_from(source, extractor, size=20000, min_df=1, min_tf=1)
    return rounded(built.named_entries(), 6, "tfidf")


@query
def book_matrix(spark, folder):
    """The second path: 174 case-sensitive stop words, no minimum counts, a larger vocabulary."""
    found = document_terms(docs(spark, folder), ENGLISH_174, case_sensitive=True)
    built = matrix.build_matrix(found, size=20000, min_df=1, min_tf=1)
    return rounded(built.named_entries(), 6, "tfidf")


@query
def doc_top_terms(spark, folder):
    return matrix.top_terms_per_document(full_matrix(spark, folder), 5)


@query
def tf_vs_tfidf(spark, folder):
    entries = full_matrix(spark, folder).named_entries("title")
    return rounded(entries.drop("term_id"), 6, "tfidf")


@query
def graph_edges(spark, folder):
    return rounded(matrix.graph_edges(full_matrix(spark, folder)), 6, "weight")


@query
def graph_nodes(spark, folder):
    return matrix.graph_nodes(full_matrix(spark, folder))


# Concepts


@query
def svd_sigma0(spark, folder):
    """Largest singular value, and the sum of all squares, which is that of the matrix."""
    sigma = full_rank_concepts(spark, folder).concepts.agg(
        F.max("sigma").alias("sigma0"), F.sum(F.col("sigma") * F.col("sigma")).alias("energy")
    )
    return rounded(sigma, 3, "sigma0", "energy")


@query
def svd_concept0_terms(spark, folder):
    return rounded(svd.top_terms_for_concept(full_rank_concepts(spark, folder), 0), 6, "weight")


@query
def svd_concept0_docs(spark, folder):
    return rounded(
        svd.top_documents_for_concept(full_rank_concepts(spark, folder), 0), 6, "weight"
    )


def _norm(vector: str) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    return F.round(F.sqrt(squares), 5)


@query
def term_norms(spark, folder):
    """Lengths of the rows of V diag(s): those of the columns of the matrix."""
    factors = full_rank_concepts(spark, folder).term_factors
    return factors.select("term_id", "term", _norm("vs").alias("norm"))


@query
def doc_norms(spark, folder):
    """Lengths of the rows of U diag(s): those of the rows of the matrix."""
    return full_rank_concepts(spark, folder).doc_factors.select("doc_id", _norm("us").alias("norm"))


@query
def docs_for_term(spark, folder):
    return rounded(relevance.docs_for_terms(full_rank_concepts(spark, folder)), 6, "score")


@query
def terms_for_term(spark, folder):
    return rounded(relevance.terms_for_terms(full_rank_concepts(spark, folder)), 6, "score")


def longest_by_source(spark, folder) -> DataFrame:
    """The longest document of every source; its id settles ties."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.groupBy("source").agg(
        F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("doc_id")
    )


@query
def docs_for_doc(spark, folder):
    asked = [r["doc_id"] for r in longest_by_source(spark, folder).collect()]
    return rounded(relevance.docs_for_docs(full_rank_concepts(spark, folder), doc_ids=asked), 6, "score")


@query
def docs_for_title(spark, folder):
    """As ``docs_for_doc``, the documents named by title."""
    asked = corpus_titles(longest_by_source(spark, folder))
    return rounded(relevance.docs_for_docs(full_rank_concepts(spark, folder), titles=asked), 6, "score")


def corpus_titles(chosen: DataFrame) -> list[str]:
    return [f"{r['source']}-{r['doc_id']}" for r in chosen.collect()]


def benchmark_queries(spark, folder) -> DataFrame:
    texts = table(spark, folder, "benchmark", "item_id")
    return relevance.text_queries(
        texts.select(F.col("item_id").alias("query_id"), F.col("text").alias("content"))
    )


@query
def query_vector(spark, folder):
    vocabulary = small_matrix(spark, folder).vocabulary
    weighed, _ = relevance.query_terms(benchmark_queries(spark, folder), vocabulary)
    return rounded(weighed, 9, "weight")


@query
def query_vector_full(spark, folder):
    """As ``query_vector``, with the whole vocabulary."""
    weighed, _ = relevance.query_terms(benchmark_queries(spark, folder), full_matrix(spark, folder).vocabulary)
    return rounded(weighed, 9, "weight")


@query
def query_unknown_terms(spark, folder):
    vocabulary = small_matrix(spark, folder).vocabulary
    _, unknown = relevance.query_terms(benchmark_queries(spark, folder), vocabulary)
    return unknown


@query
def docs_for_query(spark, folder):
    vocabulary = small_matrix(spark, folder).vocabulary
    weighed, _ = relevance.query_terms(benchmark_queries(spark, folder), vocabulary)
    return rounded(relevance.docs_for_queries(full_rank_concepts(spark, folder), weighed), 6, "score")


def three_concepts(spark, folder) -> svd.ConceptModel:
    return _once(
        spark, folder, "three", lambda: svd.fit_concepts(small_matrix(spark, folder), 3)
    )


@query
def svd3_sigmas(spark, folder):
    return rounded(three_concepts(spark, folder).concepts, 4, "sigma")


@query
def svd3_concept_terms(spark, folder):
    return rounded(svd.concept_terms(three_concepts(spark, folder)), 6, "weight")


@query
def svd3_concept_words(spark, folder):
    return svd.concept_words(three_concepts(spark, folder), 5)


@query
def svd3_concept_docs(spark, folder):
    return rounded(relevance.concept_documents(three_concepts(spark, folder)), 6, "weight")


@query
def svd3_docs_for_term(spark, folder):
    return rounded(relevance.docs_for_terms(three_concepts(spark, folder)), 6, "score")


@query
def svd3_docs_for_doc(spark, folder):
    asked = [r["doc_id"] for r in longest_by_source(spark, folder).collect()]
    return rounded(relevance.docs_for_docs(three_concepts(spark, folder), doc_ids=asked), 6, "score")


@query
def svd3_terms_for_term(spark, folder):
    return rounded(relevance.terms_for_terms(three_concepts(spark, folder)), 6, "score")


@query
def svd3_docs_for_query(spark, folder):
    vocabulary = small_matrix(spark, folder).vocabulary
    weighed, _ = relevance.query_terms(benchmark_queries(spark, folder), vocabulary)
    return rounded(relevance.docs_for_queries(three_concepts(spark, folder), weighed), 6, "score")


@query
def svd_concepts_k(spark, folder):
    """Words of the leading concepts of a truncated model."""
    return svd.concept_words(truncated_concepts(spark, folder))


@query
def svd_concept_terms_k(spark, folder):
    return svd.concept_terms(truncated_concepts(spark, folder), n_concepts=10)


@query
def svd_concept_docs_k(spark, folder):
    return relevance.concept_documents(truncated_concepts(spark, folder), n_concepts=10)


@query
def lsa_docs_for_query_k(spark, folder):
    """Free-text questions on a truncated model."""
    vocabulary = full_matrix(spark, folder).vocabulary
    weighed, _ = relevance.query_terms(benchmark_queries(spark, folder), vocabulary)
    return rounded(relevance.docs_for_queries(truncated_concepts(spark, folder), weighed), 6, "score")


# Topics


@query
def lda_em_topic_terms(spark, folder):
    model = em_topics(spark, folder)
    long = model.topic_terms.select(
        "term_id", "term", F.posexplode("counts").alias("topic", "count")
    )
    return rounded(long, 5, "count")


@query
def lda_em_topic_words(spark, folder):
    return topic_queries.topic_words(em_topics(spark, folder))


@query
def lda_em_topic_word_weights(spark, folder):
    return rounded(topic_queries.words_per_topic(em_topics(spark, folder)), 6, "weight")


@query
def lda_em_doc_topics(spark, folder):
    return rounded(topic_queries.document_topics(em_topics(spark, folder)), 6, "weight")


@query
def top_topics_for_doc(spark, folder):
    best = topic_queries.top_topics_per_document(em_topics(spark, folder), 2)
    return rounded(best, 6, "weight")


@query
def top_docs_for_topic(spark, folder):
    best = topic_queries.top_documents_per_topic(em_topics(spark, folder))
    return rounded(best, 6, "weight")


@query
def top_docs_for_one_topic(spark, folder):
    best = topic_queries.top_documents_for_topic(em_topics(spark, folder), 1)
    return rounded(best, 6, "weight")


@query
def top_topics_for_term(spark, folder):
    return rounded(topic_queries.top_topics_for_terms(em_topics(spark, folder)), 5, "weight")


@query
def topics_labelled(spark, folder):
    return topic_queries.topic_labels(em_topics(spark, folder))


@query
def doc_topics_labelled(spark, folder):
    model = em_topics(spark, folder)
    best = topic_queries.top_topics_per_document(model, 1)
    return rounded(topic_queries.labelled(best, model, 3), 6, "weight")


@query
def topic_table(spark, folder):
    return topic_queries.topic_table(em_topics(spark, folder))


@query
def topic_json(spark, folder):
    return topic_queries.topic_terms_json(em_topics(spark, folder))


@query
def lda_ml_em(spark, folder):
    return topic_queries.words_per_topic(ml_topics(spark, folder))


@query
def lda_ml_em_doc_topics(spark, folder):
    return topic_queries.top_topics_per_document(ml_topics(spark, folder), 3)


@query
def lda_ml_topic_words(spark, folder):
    """Words of the topics of Spark's EM model, as report lines."""
    return topic_queries.topic_labels(ml_topics(spark, folder))


@query
def lda_ml_topic_json(spark, folder):
    return topic_queries.topic_terms_json(ml_topics(spark, folder))


@query
def lda_ml_topic_docs(spark, folder):
    return topic_queries.top_documents_per_topic(ml_topics(spark, folder))


@query
def lda_ml_term_topics(spark, folder):
    return topic_queries.top_topics_for_terms(ml_topics(spark, folder))


@query
def lda_ml_term_totals(spark, folder):
    """Spark's EM model divides what a column of the whole matrix weighs among the topics, and ranks them all."""
    found = topic_queries.top_topics_for_terms(ml_topics(spark, folder)).groupBy("term").agg(
        F.count(F.lit(1)).alias("topics"), F.max("rank").cast("bigint").alias("last_rank"), F.sum("weight").alias("weight")
    )
    return rounded(found, 4, "weight")


@query
def lda_ml_doc_totals(spark, folder):
    """Each document's shares of all topics of Spark's EM model, ranked, falling and adding up to one."""
    ranked = topic_queries.top_topics_per_document(ml_topics(spark, folder), LDA_TOPICS)
    shares = F.transform(F.sort_array(F.collect_list(F.struct("rank", "weight"))), lambda e: e["weight"])
    # a document has as many rows as there are topics; equal to the digits by which shares rank
    found = ranked.groupBy("doc_id", "title").agg(F.count(F.lit(1)).alias("topics"), shares.alias("shares"))
    fall = F.forall(F.sequence(F.lit(1), F.lit(LDA_TOPICS - 1)), lambda i: F.get("shares", i) <= F.get("shares", i - 1) + 1e-6)
    total = F.aggregate("shares", F.lit(0.0), lambda t, x: t + x)
    whole = (F.abs(total - 1) < 1e-9) | (total == 0)  # a document without a term of the vocabulary has no shares
    return found.select("doc_id", "title", "topics", fall.alias("falling"), whole.alias("adds_up"))


@query
def lda_ml_online(spark, folder):
    model = topics.fit_lda(full_matrix(spark, folder), LDA_TOPICS, LDA_STEPS, optimizer="online")
    return topic_queries.words_per_topic(model)


@query
def lda_quality(spark, folder):
    return topics.model_quality(ml_topics(spark, folder).fitted, full_matrix(spark, folder))


@query
def lda_ml_em_totals(spark, folder):
    """Spark's EM model spreads the weight of the whole matrix over the topics, and each document's shares add up."""
    model = small_ml_topics(spark, folder)

    def total(column: str) -> Column:
        return F.aggregate(column, F.lit(0.0), lambda t, x: t + x)

    weight = model.topic_terms.agg(F.round(F.sum(total("counts")), 2).alias("weight"))
    shares = model.doc_topics.select(total("weights").alias("s"))
    whole = F.abs(F.col("s") - 1) < 1e-9
    found = shares.agg(
        F.count_if(whole).alias("documents"), F.bool_and(whole | (F.col("s") == 0)).alias("shares_add_up")
    )
    return found.select("*", F.lit(weight.first()["weight"]).alias("weight"))


@query
def lda_ml_online_totals(spark, folder):
    """The words of each topic of the online model make up the whole of it."""
    small = small_matrix(spark, folder)
    model = topics.fit_lda(small, SMALL_TOPICS, SMALL_STEPS, optimizer="online")
    every = topic_queries.words_per_topic(model, n=small.n_terms)
    sums = every.groupBy("topic").agg(F.sum("weight").alias("s"), F.count(F.lit(1)).alias("terms"))
    return sums.select("topic", "terms", (F.abs(F.col("s") - 1) < 1e-9).alias("adds_up"))


@query
def lda_quality_totals(spark, folder):
    """Likelihood over perplexity is the weight of the corpus."""
    quality = topics.model_quality(small_ml_topics(spark, folder).fitted, small_matrix(spark, folder))
    weight = F.round(-F.col("log_likelihood") / F.col("log_perplexity"), 2)
    return quality.select(weight.alias("weight"), (F.col("log_perplexity") > 0).alias("positive"))


@query
def stream_score_equals_batch(spark, folder):
    stages = scoring.scoring_stages(small_matrix(spark, folder), small_ml_topics(spark, folder).fitted)
    stream = _stream_scores(spark, folder, stages).withColumnRenamed("weight", "streamed")
    both = _folded_in(spark, folder, stages).join(stream, ["doc_id", "title", "topic"], "full")
    same = F.coalesce(F.abs(F.col("weight") - F.col("streamed")) < 1e-12, F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("differing"))


@query
def svd_k_factors(spark, folder):
    """The truncated model's V has orthonormal columns, and its sigmas are the lengths of A V."""
    model = truncated_concepts(spark, folder)
    entry = model.term_factors.select("v", F.posexplode("v").alias("i", "x"))
    products = entry.select("i", F.posexplode(F.transform("v", lambda y: y * F.col("x"))).alias("j", "p"))
    gram = products.groupBy("i", "j").agg(F.sum("p").alias("p"))
    off = F.abs(F.col("p") - (F.col("i") == F.col("j")).cast("double"))
    lengths = model.doc_factors.select(F.posexplode("us").alias("concept", "x")).groupBy("concept").agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length")
    ).join(model.concepts, "concept").agg(F.max(F.abs(F.col("length") / F.col("sigma") - 1)).alias("off"))
    return gram.agg(
        F.count_if(F.col("i") == F.col("j")).alias("concepts"), (F.max(off) < 1e-8).alias("orthonormal")
    ).withColumn("lengths", F.lit(lengths.first()["off"] < 1e-8))


@query
def sample_random_bounds(spark, folder):
    """A quarter of the documents, give or take, none twice, none from elsewhere."""
    whole = titles(spark, folder)
    sample = filters.random_sample(whole, 0.25, seed=7)
    share = F.count(F.lit(1)) / F.lit(whole.count())
    found = sample.join(whole, ["doc_id", "title"], "left_semi")
    return found.agg(
        share.between(0.15, 0.35).alias("about_a_quarter"),
        (F.count(F.lit(1)) == F.count_distinct("doc_id")).alias("distinct"),
    )


def unseen(conversations: DataFrame) -> DataFrame:
    title = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return conversations.select(
        (F.col("conv_id") * (1 << 32) + F.col("turn")).alias("doc_id"), title.alias("title"),
        F.col("text").alias("content"),
    )


@query
def fold_in_em(spark, folder):
    """Topics of documents that were not in the training corpus, by the EM steps."""
    seen = document_terms(unseen(table(spark, folder, "conversations", "conv_id", "turn")))
    vectors = matrix.with_new_documents(small_matrix(spark, folder), seen)
    shares = topics.score_em(em_topics(spark, folder), vectors, EM_STEPS)
    long = shares.select("doc_id", "title", F.posexplode("weights").alias("topic", "weight"))
    return rounded(long, 6, "weight")


@query
def fold_in(spark, folder):
    """Topics of documents that were not in the training corpus."""
    return _folded_in(spark, folder, scoring.scoring_stages(full_matrix(spark, folder), ml_topics(spark, folder).fitted))


def _folded_in(spark, folder, stages) -> DataFrame:
    shares = scoring.topic_shares(unseen(table(spark, folder, "conversations", "conv_id", "turn")), stages)
    return shares.select("doc_id", "title", F.posexplode("weights").alias("topic", "weight"))


# Streams


def _stream(spark, folder, name: str) -> DataFrame:
    """A table as a stream, in one file or in a folder of files: a pattern, unlike a plain path, may stand for either."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}.parquet}}")


@query
def stream_score(spark, folder):
    """``fold_in`` on a stream."""
    return _stream_scores(spark, folder, scoring.scoring_stages(full_matrix(spark, folder), ml_topics(spark, folder).fitted))


def _stream_scores(spark, folder, stages) -> DataFrame:
    shares = scoring.topic_shares(unseen(_stream(spark, folder, "conversations")), stages)
    path = scratch_path(spark, "scores")
    run = (
        shares.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", scratch_path(spark, "scores-progress"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    scored = spark.read.schema(shares.schema).parquet(path)
    return scored.select("doc_id", "title", F.posexplode("weights").alias("topic", "weight"))


def streamed_training(spark, folder, extractor: TermExtractor) -> DataFrame:
    """The corpus' documents as a stream through saved and loaded stages: the entries that the matrix has."""
    built = matrix.build_from(docs(spark, folder), extractor)
    path = scratch_path(spark, "stages")
    PipelineModel(stages=[built.extractor, *matrix.feature_stages(built)]).write().save(f"{path}/stages")
    stages = PipelineModel.load(f"{path}/stages")
    found = stages.transform(corpus(_stream(spark, folder, "documents"))).where("size(terms) > 1").drop("terms")
    run = (
        found.writeStream.format("parquet").option("path", f"{path}/vectors")
        .option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    streamed = replace(built, vectors=spark.read.schema(found.schema).parquet(f"{path}/vectors"))
    kept = frozen(rounded(streamed.named_entries(), 6, "tfidf"), "streamed-training")
    discard(spark, path)
    return kept


@query
def stream_training_suffixes(spark, folder):
    return streamed_training(spark, folder, TermExtractor(normalizer=tx.suffix_rules_sql()))


@query
def stream_training_lemmas(spark, folder):
    return streamed_training(spark, folder, TermExtractor(lemmas=corpus_lemmas(docs(spark, folder))))


@query
def stream_term_counts(spark, folder):
    """``term_freq`` on a stream: each batch writes the terms it changed, the latest count of a term holds.

    A batch that is run again overwrites its own folder.
    """
    counts = scoring.running_term_counts(corpus(_stream(spark, folder, "documents")))
    path = scratch_path(spark, "term-counts")
    run = (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}"))
        .option("checkpointLocation", scratch_path(spark, "term-counts-progress"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    written = spark.read.schema("term string, tf bigint, batch bigint").parquet(path)
    return written.groupBy("term").agg(F.max_by("tf", "batch").alias("tf"))


# Corpora that grow

#: Batches in which the documents arrive.
BATCHES = 5


def batch_of(source: DataFrame, *numbers: int) -> DataFrame:
    return source.where(F.pmod("doc_id", F.lit(BATCHES)).isin(*numbers))


def grown_table(spark, label: str, merge, delta) -> GrowingTable:
    """All batches, of which one arrives twice."""
    made = GrowingTable(spark, scratch_path(spark, label), merge)
    for number in (0, 1, 2, 2, 3, 4):
        made.add(number, delta(number))
    return made


def growing(spark, folder) -> GrowingTable:
    def store():
        found = terms(spark, folder)
        return grown_table(
            spark, "growing", corpus_counts.merge_counts,
            lambda number: corpus_counts.count_delta(batch_of(found, number)),
        )

    return _once(spark, folder, "growing", store)


@query
def growing_counts(spark, folder):
    """Counts of all terms, added up batch by batch."""
    return growing(spark, folder).read()


@query
def growing_idf(spark, folder):
    """``idf_weights`` from the added counts."""
    return rounded(corpus_counts.weighed_vocabulary(growing(spark, folder).read()), 9, "idf")


@query
def growing_matrix(spark, folder):
    """A matrix of the first three batches, with the documents of the others and the weights of all."""
    found = terms(spark, folder)
    early = matrix.build_matrix(batch_of(found, 0, 1, 2))
    whole = corpus_counts.grown(early, batch_of(found, 3, 4), growing(spark, folder).read())
    return rounded(whole.named_entries(), 6, "tfidf")


@query
def growing_funnel(spark, folder):
    """The funnel by source, each batch sketched once; the sketched number of distinct tokens is within 10 percent."""
    source = docs(spark, folder).withColumn("source", F.regexp_extract("title", "^(.*)-[^-]*$", 1))
    made = grown_table(
        spark, "growing-funnel", corpus_counts.merge_funnel("source"),
        lambda number: corpus_counts.funnel_delta(batch_of(source, number), ["source"], normalizer=tx.strip_suffix),
    )
    whole = corpus_counts.funnel_estimate(corpus_counts.merge_funnel()(made.read()))
    exact = stats.preprocessing_funnel(source, normalizer=tx.strip_suffix).select("stage", F.col("unique_tokens").alias("exact"))
    close = F.abs(F.col("unique_tokens") / F.col("exact") - 1) < 0.1
    found = whole.join(exact, "stage").select("stage", "tokens", "tokens_per_doc", "unique_per_doc", close.alias("close"))
    return rounded(found, 6, "tokens_per_doc", "unique_per_doc")


@query
def stream_growing_counts(spark, folder):
    """``growing_counts`` on a stream."""
    made = GrowingTable(spark, scratch_path(spark, "stream-counts"), corpus_counts.merge_counts)
    arriving = document_terms(corpus(_stream(spark, folder, "documents")))
    run = (
        scoring.keep_counts(arriving, made)
        .option("checkpointLocation", scratch_path(spark, "stream-counts-progress"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return made.read()


# Vocabularies of any size

#: Terms looked up in the broadcast table here, so that few terms already take both ways.
FEW_FREQUENT = 256


def coded_matrix_of(spark, folder) -> dictionary.CodedMatrix:
    return _once(
        spark, folder, "coded", lambda: dictionary.build_coded(terms(spark, folder), frequent=FEW_FREQUENT)
    )


@query
def vocab_coded(spark, folder):
    """All terms of at least two documents, with ids and weights."""
    return rounded(coded_matrix_of(spark, folder).vocabulary, 9, "idf")


@query
def matrix_coded(spark, folder):
    """Entries of all terms of at least two documents."""
    return rounded(coded_matrix_of(spark, folder).entries, 6, "tfidf")


# Saved models and whole jobs


def _saved_scores(spark, folder, name: str, model: topics.TopicModel, distributed: bool) -> DataFrame:
    """Documents whose topics differ between a fitted model and the same one saved and loaded."""
    path = scratch_path(spark, name)
    models.save_topics(model, path)
    back = models.load_topics(spark, path, models.load_fitted(path, distributed))
    scored = topics.score_documents(back.fitted, full_matrix(spark, folder).vectors)
    both = model.doc_topics.join(scored.withColumnRenamed("weights", "loaded"), ["doc_id", "title"], "full").join(
        back.doc_topics.withColumnRenamed("weights", "stored"), ["doc_id", "title"], "full"
    )
    def same(other: str) -> Column:
        return F.forall(F.zip_with("weights", other, lambda a, b: F.abs(a - b) < 1e-9), lambda x: F.coalesce(x, F.lit(False)))

    fits = F.coalesce(same("loaded") & same("stored"), F.lit(False))
    counted = frozen(both.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(~fits).alias("differing"),
        F.max(F.size("weights")).cast("bigint").alias("topics"),
    ), name)
    discard(spark, path)
    return counted


@query
def saved_lda_em(spark, folder):
    """Spark's EM model, saved and loaded, scores the corpus as before."""
    return _saved_scores(spark, folder, "saved-lda-em", ml_topics(spark, folder), True)


@query
def saved_lda_online(spark, folder):
    """Spark's online model, saved and loaded, scores the corpus as before."""
    built = full_matrix(spark, folder)
    model = topics.fit_lda(built, LDA_TOPICS, 5, "online")
    return _saved_scores(spark, folder, "saved-lda-online", model, False)


@query
def lda_priors(spark, folder):
    """The concentrations that are asked for are those of the fitted models; the usual ones follow from topics and terms."""
    built = small_matrix(spark, folder)
    rows = []
    for optimizer in ("em", "online"):
        doc, topic = topics.suggested_priors(SMALL_TOPICS, built.n_terms, optimizer)
        fitted = topics.fit_lda(built, SMALL_TOPICS, 1, optimizer, doc, topic).fitted
        rows.append((optimizer, round(float(fitted.getOrDefault("docConcentration")[0]), 9), round(float(fitted.getOrDefault("topicConcentration")), 9)))
    return spark.createDataFrame(rows, "optimizer string, doc_concentration double, topic_concentration double")


@query
def configured_jobs(spark, folder):
    """The job from a dump to documents, with the dump and the documents where the session's settings name them."""
    path = scratch_path(spark, "jobs")
    names = {"spark.termscape.base": f"{path}/base", "spark.termscape.dump": f"{path}/dump"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        at = tables.Locations.of(spark)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    wiki_pages(spark, folder).write.text(at.dump)
    jobs.documents_job(spark, at)
    found = frozen(document_digest(tables.read_documents(spark, f"{path}/base/documents")), "jobs")
    discard(spark, path)
    return found


@query
def lsa_run(spark, folder):
    """The whole run on the book's way of preprocessing: at full rank its documents for a term are the matrix's columns."""
    source = docs(spark, folder)
    reports = jobs.lsa_reports(source, SMALL_VOCABULARY, SMALL_VOCABULARY, terms=lsa_terms(spark, folder), n=10)
    return rounded(reports["documents for terms"], 6, "score")


def lsa_terms(spark, folder) -> list[str]:
    """The five most used terms."""
    found = document_terms(docs(spark, folder), ENGLISH_174, case_sensitive=True)
    return [r["term"] for r in matrix.fit_vocabulary(filters.with_min_terms(found), 5, 1).collect()]
