"""The way from text to terms as a Spark ML stage, so that it is stored with what was fitted on its terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscape.functions import text as tx
from termscape.functions.stopwords import ENGLISH_DEFAULT
from termscape.operators import terms
from termscape.session import at_most


class TermExtractor(Transformer, MLReadable, MLWritable):
    """``(doc_id, title, content)`` to ``(doc_id, title, terms)``, batch or stream.

    ``normalizer`` is SQL text on ``word`` that gives a word's normal form (``text.suffix_rules_sql()`` is one), ``lemmas``
    a table ``(form, lemma)``; with both, the rule is applied to what the table gives. Saving writes the
    settings, and the lemmas as a table beside them. Only a table of more than ``terms.MAX_BROADCAST_LEMMAS`` rows
    needs a shuffle; it cannot be used on a stream, nor together with a rule.
    """

    stop_words = Param(Params._dummy(), "stop_words", "words that are no terms", TypeConverters.toListString)
    case_sensitive = Param(Params._dummy(), "case_sensitive", "stop words in their own case", TypeConverters.toBoolean)
    min_length = Param(Params._dummy(), "min_length", "code points of a term at least", TypeConverters.toInt)
    normalizer = Param(Params._dummy(), "normalizer", "SQL text on word, or empty", TypeConverters.toString)
    has_lemmas = Param(Params._dummy(), "has_lemmas", "whether a lemma table belongs to it", TypeConverters.toBoolean)

    def __init__(
        self, stop_words: Sequence[str] = ENGLISH_DEFAULT, case_sensitive: bool = False, min_length: int = 3,
        normalizer: str = "", lemmas: DataFrame | None = None,
    ):
        super().__init__()
        self._set(
            stop_words=list(stop_words), case_sensitive=case_sensitive, min_length=min_length,
            normalizer=normalizer, has_lemmas=lemmas is not None,
        )
        self.lemmas = lemmas
        self._prepared: tuple | None = None

    def _lookup(self):
        """The stored table and, if it is small enough, the lookup in it; made once per session."""
        if self._prepared is None:
            table = terms.lemma_table(self.lemmas)
            small = at_most(table, terms.MAX_BROADCAST_LEMMAS)
            self._prepared = (table, terms.lemma_lookup(table) if small else None)
        return self._prepared

    def _transform(self, docs: DataFrame) -> DataFrame:
        stop_words, cased, shortest = (self.getOrDefault(p) for p in (self.stop_words, self.case_sensitive, self.min_length))
        rule = self.getOrDefault(self.normalizer)
        if self.lemmas is None and not rule:
            return terms.document_terms(docs, stop_words, cased, shortest)
        if self.lemmas is not None:
            table, lookup = self._lookup()
            if lookup is None:
                if docs.isStreaming or rule:
                    raise ValueError(f"more than {terms.MAX_BROADCAST_LEMMAS} lemmas: not on a stream, nor with a rule")
                return terms.document_lemmas(docs, table, stop_words, shortest, cased)
            if not rule:
                return terms.lemma_terms(docs, lookup, stop_words, shortest, cased)
            words = terms._looked_up(docs, lookup)
        else:
            words = terms.computed(docs, ["doc_id", "title"], words=tx.words(F.col("content")))
        words = words.select("doc_id", "title", F.expr(f"transform(words, word -> {rule})").alias("words"))
        return terms.computed(words, ["doc_id", "title"], terms=tx.terms_of(F.col("words"), stop_words, cased, shortest))

    def copy(self, extra=None) -> TermExtractor:
        made = super().copy(extra)
        made.lemmas, made._prepared = self.lemmas, self._prepared
        return made

    def write(self) -> DefaultParamsWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _Reader(cls)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.lemmas is not None:
            self.instance.lemmas.select("form", "lemma").write.parquet(f"{path}/lemmas")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> TermExtractor:
        made = super().load(path)
        if made.getOrDefault(made.has_lemmas):
            made.lemmas = SparkSession.active().read.parquet(f"{path}/lemmas")
        return made
