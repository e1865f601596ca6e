"""Documents to term arrays, with pluggable word normalization."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.functions import text as tx
from termscape.functions.stopwords import ENGLISH_DEFAULT
from termscape.session import at_most, frozen


def computed(df: DataFrame, keep: Sequence[str | Column], **columns: Column) -> DataFrame:
    """``keep`` plus costly columns that are evaluated exactly once per row.

    The optimizer would move a later filter on such a column below it, in front of the scan's other
    work, and evaluate the column a second time there. It does not move filters below a generator.
    """
    row = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*keep, F.inline(F.array(row)))


def document_terms(
    docs: DataFrame,
    stop_words: Sequence[str] = ENGLISH_DEFAULT,
    case_sensitive: bool = False,
    min_length: int = 3,
    normalizer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``docs(doc_id, title, content)`` to ``(doc_id, title, terms)`` without a shuffle."""
    terms = tx.clean_terms(F.col("content"), stop_words, case_sensitive, min_length, normalizer)
    return computed(docs, ["doc_id", "title"], terms=terms)


#: Lemma tables up to this many rows (some 50 MB) are sent to every Python worker; beyond it, the lemmas of
#: this many of the most frequent forms are broadcast and the other words are joined.
MAX_BROADCAST_LEMMAS = 1_000_000
FREQUENT_FORMS = 10_000


def lemma_table(lemmas: DataFrame) -> DataFrame:
    """One lemma per lower-cased form, the smallest of several, as a stored table."""
    one = lemmas.groupBy(F.lower("form").alias("form")).agg(F.min("lemma").alias("lemma"))
    return frozen(one.where("form is not null and lemma is not null"), "lemmas")


def lemma_lookup(table: DataFrame) -> Callable[[Column], Column]:
    """Function of an array of words to their lemmas, a word without one standing for itself.

    ``table`` comes from ``lemma_table`` and has at most ``MAX_BROADCAST_LEMMAS`` rows. The lookup is inside the
    row: no word is shuffled, and it works on streams. Of a batch of texts each distinct form is looked up once.
    """
    rows = table.toArrow()
    # as Arrow columns: a dict of the same table takes several times their memory in every worker
    held = table.sparkSession.sparkContext.broadcast(tuple(rows[c].combine_chunks().cast(pa.string()) for c in ("form", "lemma")))

    @F.arrow_udf("array<string>")
    def lemmas_of(forms: pa.Array) -> pa.Array:
        coded = forms.flatten().dictionary_encode()
        form, lemma = held.value
        known = lemma.take(pc.index_in(coded.dictionary, value_set=form))
        sizes = pc.fill_null(pc.list_value_length(forms), 0)
        ends = pc.cumulative_sum(sizes).cast(pa.int32())
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(offsets, known.take(coded.indices))

    return lambda words: F.zip_with(words, lemmas_of(tx.lower_all(words)), lambda word, lemma: F.coalesce(lemma, word))


def lemma_words(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``(doc_id, title, words)``: every word brought to its lemma, in the order of the text.

    ``lemmas(form, lemma)`` is looked up by the lower-cased form. Not for a table of more than
    ``MAX_BROADCAST_LEMMAS`` rows.
    """
    table = lemma_table(lemmas)
    if not at_most(table, MAX_BROADCAST_LEMMAS):
        raise ValueError(f"more than {MAX_BROADCAST_LEMMAS} lemmas")
    return _looked_up(docs, lemma_lookup(table))


def _looked_up(docs: DataFrame, lookup: Callable[[Column], Column]) -> DataFrame:
    split = computed(docs, ["doc_id", "title"], words=tx.words(F.col("content")))
    return split.select("doc_id", "title", lookup(F.col("words")).alias("words"))


def lemma_counts(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Lemma of every word with its count: ``(doc_id, lemma, n)``.

    ``lemmas(form, lemma)`` is looked up by the lower-cased form; of several lemmas for one form the
    smallest is used, and a form without one stands for itself. With a table of checked size
    words are looked up where they are; for a larger one see ``_joined_lemmas``.
    """
    table = lemma_table(lemmas)
    if at_most(table, MAX_BROADCAST_LEMMAS):
        titled = docs.select("doc_id", F.lit(None).cast("string").alias("title"), "content")
        found = _looked_up(titled, lemma_lookup(table)).select("doc_id", F.explode("words").alias("lemma"))
        return found.groupBy("doc_id", "lemma").agg(F.count(F.lit(1)).alias("n"))
    words = (
        computed(docs, ["doc_id"], words=tx.words(F.col("content")))
        .select("doc_id", F.explode("words").alias("word"))
        .select("doc_id", "word", F.lower("word").alias("form"), F.lit(1).cast("bigint").alias("n"))
    )
    return _joined_lemmas(words, table).groupBy("doc_id", F.coalesce("lemma", "word").alias("lemma")).agg(
        F.sum("n").alias("n")
    )


def _joined_lemmas(words: DataFrame, table: DataFrame) -> DataFrame:
    """``words`` with the lemmas of a table too large to broadcast.

    Words are counted per document first, so one moves once per document. The most frequent forms,
    each of which may be in every document, are looked up in a broadcast excerpt of the table; only
    the rest is shuffled by form.
    """
    counted = frozen(
        words.groupBy("doc_id", "word", "form").agg(F.sum("n").alias("n")), "word-counts"
    )
    frequent = frozen(
        counted.groupBy("form").agg(F.count(F.lit(1)).alias("docs"))
        .orderBy(F.desc("docs"), "form").limit(FREQUENT_FORMS)
        .select("form", F.lit(True).alias("frequent")),
        "frequent-forms",
    )
    known = table.join(F.broadcast(frequent.select("form")), "form")
    excerpt = frequent.join(F.broadcast(known), "form", "left")
    marked = counted.join(F.broadcast(excerpt), "form", "left")
    rare = marked.where(F.col("frequent").isNull()).drop("lemma").join(table, "form", "left")
    return marked.where("frequent").unionByName(rare)


def document_lemmas(
    docs: DataFrame,
    lemmas: DataFrame,
    stop_words: Sequence[str] = ENGLISH_DEFAULT,
    min_length: int = 3,
    case_sensitive: bool = False,
) -> DataFrame:
    """As ``document_terms`` with a lemma table as the normalizer.

    With a table of up to ``MAX_BROADCAST_LEMMAS`` rows there is no shuffle and terms keep their order. A larger
    one is joined: terms then come in any order, and documents with one id share their terms.
    """
    table = lemma_table(lemmas)
    if at_most(table, MAX_BROADCAST_LEMMAS):
        return lemma_terms(docs, lemma_lookup(table), stop_words, min_length, case_sensitive)
    kept = lemma_counts(docs, table).where(
        (F.length("lemma") >= min_length) & F.col("lemma").rlike(r"^\p{L}+$")
    )
    if case_sensitive:
        kept = kept.where(~F.col("lemma").isin(list(stop_words)))
    else:
        kept = kept.where(~F.lower("lemma").isin(sorted({w.lower() for w in stop_words})))
    per_document = kept.groupBy("doc_id").agg(
        F.flatten(
            F.collect_list(F.array_repeat(F.lower("lemma"), F.col("n").cast("int")))
        ).alias("terms")
    )
    empty = F.array().cast("array<string>")
    return docs.select("doc_id", "title").join(per_document, "doc_id", "left").select(
        "doc_id", "title", F.coalesce("terms", empty).alias("terms")
    )


def lemma_terms(
    docs: DataFrame,
    lookup: Callable[[Column], Column],
    stop_words: Sequence[str] = ENGLISH_DEFAULT,
    min_length: int = 3,
    case_sensitive: bool = False,
) -> DataFrame:
    """``document_terms`` with a lookup from ``lemma_lookup``; map-only, so also for streams."""
    terms = tx.terms_of(F.col("words"), stop_words, case_sensitive, min_length)
    return computed(_looked_up(docs, lookup), ["doc_id", "title"], terms=terms)


def analysed_forms(docs: DataFrame, make_analyser: Callable[[], Callable[[str], str | None]]) -> DataFrame:
    """A lemma table of the corpus made by a user's word analyser: ``(form, lemma)``.

    Every distinct lower-cased form of the corpus is analysed once, however often it occurs. ``make_analyser()``
    runs once in every task and returns the function from a form to its lemma (None: it stands for itself).
    """
    forms = computed(docs, [], words=F.array_distinct(tx.lower_all(tx.words(F.col("content")))))
    forms = forms.select(F.explode("words").alias("form")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        analyse = make_analyser()
        for batch in batches:
            lemmas = [analyse(form) for form in batch.column("form").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("form"), pa.array(lemmas, pa.string())], names=["form", "lemma"])

    return forms.mapInArrow(run, "form string, lemma string").where("lemma is not null and lemma <> form")


#: Texts of a batch that are Python lists of terms at a time.
ANALYSED_ROWS = 64


def terms_with(
    docs: DataFrame, make_normalizer: Callable[[], Callable[[str], list[str]]]
) -> DataFrame:
    """Terms from a user's own text analyser, set up once per partition.

    ``make_normalizer()`` runs once in every task and returns the function that turns one text into
    its terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        analyse = make_normalizer()
        for batch in batches:
            for at in range(0, len(batch), ANALYSED_ROWS):
                piece = batch.slice(at, ANALYSED_ROWS)
                terms = [list(analyse(t.as_py())) if t.is_valid else [] for t in piece.column("content")]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("title"), pa.array(terms, pa.list_(pa.string()))],
                    names=["doc_id", "title", "terms"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "title", "content").mapInArrow(
        run, "doc_id bigint, title string, terms array<string>"
    )
