"""The registered queries as SQL on the same tables, for checking.

Each statement is written from the definitions, not from the Spark code. Answers of the full-rank
concept model are checked against the matrix itself: with as many concepts as terms, U diag(s) V'
equals the matrix, so documents for a term are its TF-IDF column, similar terms and documents are
cosines of columns and rows, and a free-text query is a weighted sum of columns.
"""

from __future__ import annotations

from termscape.functions.stopwords import ENGLISH_174, ENGLISH_DEFAULT
from termscape.functions.text import SUFFIX_RULES
from termscape.plans.queries import BATCHES, EM_STEPS, EM_TOPICS, LDA_TOPICS, SMALL_TOPICS, SMALL_VOCABULARY

#: Rounds of squaring A'A; the leading direction wins by the power 2**rounds.
SQUARINGS = 8


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words) -> str:
    return "(" + ", ".join(map(_quoted, words)) + ")"


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


DOCS = "docs AS (SELECT doc_id, concat(source, '-', doc_id) AS title, text AS content FROM documents)"

# Token lists of a text expression
SPACE = r"[ \t\n\x0b\f\r]"
WHITESPACE = (
    "CASE WHEN rtrim(lower({0}), e' \\t\\n\\x0b\\f\\r') = '' AND {0} <> '' THEN [] ELSE "
    "string_split_regex(rtrim(lower({0}), e' \\t\\n\\x0b\\f\\r'), '[ \\t\\n\\x0b\\f\\r]') END"
)
WORDS = r"regexp_extract_all({0}, '[\p{{L}}\p{{M}}\p{{N}}]+')"
SHAPED = r"list_filter({0}, lambda w: length(w) > 2 AND regexp_full_match(w, '\p{{L}}+'))"
LOWERED = "list_transform({0}, lambda w: lower(w))"
STEMMED = "list_transform({0}, lambda w: " + "{stem})"


def stem(word: str) -> str:
    cases = " ".join(
        f"WHEN ends_with(lower({word}), '{suffix}') AND length({word}) >= {shortest} "
        f"THEN substr({word}, 1, length({word}) - {len(suffix)}) || '{replacement}'"
        for suffix, replacement, shortest in SUFFIX_RULES
    )
    return f"(CASE {cases} ELSE {word} END)"


def _nested(expression: str, *wrappers: str) -> str:
    for wrapper in wrappers:
        expression = wrapper.format(expression)
    return expression


NOT_DEFAULT = "list_filter({0}, lambda w: lower(w) NOT IN " + _list(ENGLISH_DEFAULT) + ")"
NOT_174 = "list_filter({0}, lambda w: w NOT IN " + _list(ENGLISH_174) + ")"
STEMS = "list_transform({0}, lambda w: " + stem("w") + ")"

CLEAN = _nested("content", WORDS, SHAPED, NOT_DEFAULT, LOWERED)
CLEAN_CASE = _nested("content", WORDS, SHAPED, NOT_174, LOWERED)
CLEAN_STEMS = _nested("content", WORDS, STEMS, NOT_DEFAULT, SHAPED, LOWERED)


def tokens(expression: str) -> str:
    return f"tokens AS MATERIALIZED (SELECT doc_id, title, {expression} AS t FROM docs)"


DIGEST = """SELECT doc_id, len(t)::BIGINT AS n_tokens, len(list_distinct(t))::BIGINT AS n_unique,
    md5(coalesce(array_to_string(t, ' '), '')) AS digest FROM tokens"""


def digest(expression: str) -> str:
    return _with(DOCS, tokens(expression), select=DIGEST)


LONG = "terms AS MATERIALIZED (SELECT doc_id, unnest(t) AS term FROM tokens)"
TERM_ROWS = (DOCS, tokens(CLEAN), LONG)

# Lemma table of the corpus
LEMMAS = (
    DOCS,
    tokens(_nested("content", WORDS)),
    "used AS MATERIALIZED (SELECT doc_id, unnest(t) AS word FROM tokens)",
    "forms AS MATERIALIZED (SELECT DISTINCT lower(word) AS form FROM used)",
    f"stems AS (SELECT form, {stem('form')} AS lemma FROM forms)",
    "lemmas AS MATERIALIZED (SELECT form, lemma FROM stems WHERE form <> lemma "
    "AND lemma IN (SELECT form FROM forms))",
    "lemmatized AS MATERIALIZED (SELECT doc_id, coalesce(lemma, word) AS lemma FROM used "
    "LEFT JOIN lemmas ON lower(word) = form)",
)

# Markup
# The references that the pages hold, written out here so that the SQL shares no table
# with the library. The ampersand comes last, so that nothing is decoded twice.
REFERENCES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"),
    ("&eacute;", "é"), ("&uuml;", "ü"), ("&amp;", "&"),
)
BLANKS = r"'[ \t\n\r\f]+'"


def _html(expression: str) -> str:
    for name, char in REFERENCES:
        expression = f"replace({expression}, {_quoted(name)}, {_quoted(char)})"
    return f"trim(regexp_replace({expression}, {BLANKS}, ' ', 'g'), ' ')"


def _visible() -> str:
    text = "html"
    for pattern in (
        "(?s)<!--.*?-->", "(?is)<head[^>]*>.*?</head>", "(?is)<script[^>]*>.*?</script>",
        "(?is)<style[^>]*>.*?</style>", "(?s)<[a-zA-Z/!][^>]*>",
    ):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return _html(text)


READ_PAGES = (
    "read AS (SELECT page_id, "
    + _html("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    + " AS title, " + _visible() + " AS content FROM pages)"
)
PAGE_DIGEST = _with(READ_PAGES, select="""SELECT page_id AS doc_id, title,
    length(content)::BIGINT AS n_chars, md5(content) AS digest FROM read""")


SAVED = _with(DOCS, select="""SELECT doc_id, title, length(content)::BIGINT AS n_chars,
    md5(content) AS digest FROM docs""")


# Matrix

def matrix(
    expression: str = CLEAN, size: int = 2000, min_df: int = 2, min_tf: int = 2
) -> tuple[str, ...]:
    return (
        DOCS,
        tokens(expression),
        "usable AS MATERIALIZED (SELECT doc_id, title, t FROM tokens WHERE len(t) > 1)",
        "counts AS MATERIALIZED (SELECT doc_id, term, count(*) AS n FROM "
        "(SELECT doc_id, unnest(t) AS term FROM usable) GROUP BY ALL)",
        "vocab AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY tf DESC, term) - 1)::INTEGER "
        "AS term_id, term, tf, df FROM (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df "
        f"FROM counts GROUP BY term HAVING count(*) >= {min_df} ORDER BY tf DESC, term LIMIT {size}))",
        "kept AS MATERIALIZED (SELECT doc_id, term_id, n FROM counts JOIN vocab USING (term) "
        f"WHERE n >= {min_tf})",
        "weights AS MATERIALIZED (SELECT term_id, term, tf, df, count(doc_id) AS matrix_df, "
        "ln(((SELECT count(*) FROM usable) + 1.0) / (count(doc_id) + 1.0)) AS idf "
        "FROM vocab LEFT JOIN kept USING (term_id) GROUP BY term_id, term, tf, df)",
        "a AS MATERIALIZED (SELECT doc_id, term_id, term, n::DOUBLE AS tf, n * idf AS tfidf "
        "FROM kept JOIN weights USING (term_id))",
    )


def lemma_matrix(stop: str, size: int, min_df: int, min_tf: int) -> tuple[str, ...]:
    """The matrix of lemmas that are terms and not ``stop``."""
    return (
        *LEMMAS,
        "clean AS (SELECT doc_id, lower(lemma) AS term FROM lemmatized WHERE length(lemma) > 2 "
        rf"AND regexp_full_match(lemma, '\p{{L}}+') AND NOT {stop})",
        "listed AS (SELECT doc_id, any_value(title) AS title, "
        "coalesce(list(term) FILTER (term IS NOT NULL), []) AS t "
        "FROM docs LEFT JOIN clean USING (doc_id) GROUP BY doc_id)",
        *(cte.replace("FROM tokens", "FROM listed") for cte in matrix(size=size, min_df=min_df, min_tf=min_tf)[2:]),
    )


SMALL = matrix(size=SMALL_VOCABULARY)
DEFAULT_LEMMA = f"lower(lemma) IN {_list(ENGLISH_DEFAULT)}"
ENTRIES = "SELECT doc_id, term_id, term, tf, round(tfidf, 6) AS tfidf FROM a"


def _leading(k: int = 1) -> tuple[str, ...]:
    """v0..: right singular vectors, by squaring A'A and taking each one found out of it; sigma0..:
    their singular values. The largest entry of each vector is positive."""
    steps = [
        "pairs AS (SELECT x.term_id AS i, y.term_id AS j, sum(x.tfidf * y.tfidf) AS g "
        "FROM a x JOIN a y USING (doc_id) GROUP BY ALL)",
        "g0 AS MATERIALIZED (SELECT x.term_id AS i, y.term_id AS j, coalesce(g, 0) AS g "
        "FROM vocab x CROSS JOIN vocab y LEFT JOIN pairs ON i = x.term_id AND j = y.term_id)",
    ]
    for c in range(k):
        steps.append(f"p{c}_0 AS MATERIALIZED (SELECT i, j, g / (SELECT max(g) FROM g{c}) AS g FROM g{c})")
        for n in range(1, SQUARINGS + 1):
            last, this = f"p{c}_{n - 1}", f"{c}_{n}"
            steps.append(
                f"q{this} AS MATERIALIZED (SELECT x.i, y.j, sum(x.g * y.g) AS g "
                f"FROM {last} x JOIN {last} y ON x.j = y.i GROUP BY ALL)"
            )
            steps.append(
                f"p{this} AS MATERIALIZED (SELECT i, j, g / (SELECT max(g) FROM q{this}) AS g "
                f"FROM q{this})"
            )
        last = f"p{c}_{SQUARINGS}"
        steps += [
            f"peak{c} AS (SELECT i FROM {last} WHERE i = j ORDER BY g DESC, i LIMIT 1)",
            f"w{c} AS MATERIALIZED (SELECT i AS term_id, g / sqrt(sum(g * g) OVER ()) AS v "
            f"FROM {last} WHERE j = (SELECT i FROM peak{c}))",
            f"v{c} AS MATERIALIZED (SELECT term_id, v * (SELECT CASE WHEN arg_max(v, abs(v)) < 0 "
            f"THEN -1 ELSE 1 END FROM w{c}) AS v FROM w{c})",
            f"sigma{c} AS MATERIALIZED (SELECT sqrt(sum(x.v * g.g * y.v)) AS s FROM g{c} g "
            f"JOIN v{c} x ON x.term_id = g.i JOIN v{c} y ON y.term_id = g.j)",
            f"g{c + 1} AS MATERIALIZED (SELECT i, j, g - x.v * y.v * s * s AS g FROM g{c} "
            f"JOIN v{c} x ON x.term_id = i JOIN v{c} y ON y.term_id = j CROSS JOIN sigma{c})",
        ]
    each = " UNION ALL ".join(f"SELECT {c} AS concept, term_id, v FROM v{c}" for c in range(k))
    sigmas = " UNION ALL ".join(f"SELECT {c} AS concept, s FROM sigma{c}" for c in range(k))
    steps += [
        f"sigmas AS MATERIALIZED (SELECT concept::INTEGER AS concept, s FROM ({sigmas}))",
        f"v AS MATERIALIZED (SELECT concept::INTEGER AS concept, term_id, coalesce(v, 0) AS v FROM "
        f"(SELECT * FROM sigmas CROSS JOIN vocab) LEFT JOIN ({each}) USING (concept, term_id))",
        "us AS MATERIALIZED (SELECT concept, u.doc_id, coalesce(sum(tfidf * v), 0) AS us "
        "FROM usable u CROSS JOIN sigmas LEFT JOIN a ON a.doc_id = u.doc_id "
        "LEFT JOIN v USING (concept, term_id) GROUP BY ALL)",
    ]
    return tuple(steps)


CONCEPT_RANK = ("ranked AS (SELECT concept, term, v, (row_number() OVER (PARTITION BY concept "
                "ORDER BY round(v, 9) DESC, term_id))::INTEGER AS rank FROM v JOIN vocab USING (term_id))")
TITLES = "titles AS (SELECT doc_id, title FROM usable)"


def _best(scores: str, key: str, order_id: str = "doc_id", k: int = 10) -> str:
    """Ranked CTE: first k per key of ``scores`` by (score descending, id ascending)."""
    return (
        f"best AS (SELECT *, (row_number() OVER (PARTITION BY {key} "
        f"ORDER BY score DESC, {order_id}))::INTEGER AS rank FROM ({scores}) "
        f"QUALIFY rank <= {k})"
    )


ASKED = ("asked AS (SELECT DISTINCT item_id AS query_id, term FROM "
         "(SELECT item_id, unnest(" + CLEAN.replace("content", "text") + ") AS term FROM benchmark))")
LONGEST = ("longest AS (SELECT doc_id AS query_id FROM documents QUALIFY row_number() OVER "
           "(PARTITION BY source ORDER BY n_chars DESC, doc_id) = 1)")
NORMS = "norms AS MATERIALIZED (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM a GROUP BY doc_id)"
DOCS_FOR_DOC = _with(
    *SMALL, TITLES, LONGEST, NORMS,
    "dots AS (SELECT query_id, y.doc_id, sum(x.tfidf * y.tfidf) AS dot FROM longest "
    "JOIN a x ON x.doc_id = query_id JOIN a y USING (term_id) GROUP BY ALL)",
    _best("SELECT query_id, n.doc_id, round(coalesce(dot, 0) / (n.norm * q.norm), 6) AS score "
          "FROM longest JOIN norms q ON q.doc_id = query_id CROSS JOIN norms n "
          "LEFT JOIN dots USING (query_id, doc_id)".replace("USING (query_id, doc_id)",
          "ON dots.query_id = longest.query_id AND dots.doc_id = n.doc_id")
          .replace("SELECT query_id, n", "SELECT longest.query_id, n"), "query_id"),
    select="SELECT query_id, rank, doc_id, title, score FROM best JOIN titles USING (doc_id)",
)


# Topics by expectation maximization

def _em() -> tuple[str, ...]:
    alpha, eta = 50.0 / EM_TOPICS + 1.0, 1.1
    steps = [
        f"topics AS (SELECT range::INTEGER AS topic FROM range({EM_TOPICS}))",
        "g0 AS MATERIALIZED (SELECT doc_id, term_id, topic, CASE WHEN "
        f"(31 * doc_id + 17 * term_id) % {EM_TOPICS} = topic THEN tfidf ELSE 0.0 END AS g "
        "FROM a CROSS JOIN topics)",
    ]
    for step in range(EM_STEPS + 1):
        steps += [
            f"t{step} AS MATERIALIZED (SELECT term_id, topic, sum(g) AS c FROM g{step} GROUP BY ALL)",
            f"d{step} AS MATERIALIZED (SELECT doc_id, topic, sum(g) AS c FROM g{step} GROUP BY ALL)",
            f"n{step} AS MATERIALIZED (SELECT topic, sum(c) AS c FROM t{step} GROUP BY ALL)",
        ]
        if step < EM_STEPS:
            steps += [
                f"u{step} AS MATERIALIZED (SELECT a.doc_id, a.term_id, t.topic, a.tfidf, "
                f"(t.c + {eta - 1}) * (d.c + {alpha - 1}) "
                f"/ (n.c + (SELECT count(*) FROM vocab) * {eta - 1}) AS u FROM a "
                f"JOIN t{step} t ON t.term_id = a.term_id "
                f"JOIN d{step} d ON d.doc_id = a.doc_id AND d.topic = t.topic "
                f"JOIN n{step} n ON n.topic = t.topic)",
                f"g{step + 1} AS MATERIALIZED (SELECT doc_id, term_id, topic, "
                f"tfidf * u / sum(u) OVER (PARTITION BY doc_id, term_id) AS g FROM u{step})",
            ]
    return tuple(steps) + (
        f"tt AS MATERIALIZED (SELECT term_id, term, topic, c AS count FROM t{EM_STEPS} "
        "JOIN vocab USING (term_id))",
        "ww AS MATERIALIZED (SELECT topic, term_id, term, count / sum(count) OVER "
        "(PARTITION BY topic) AS weight FROM tt)",
        "words AS MATERIALIZED (SELECT topic, term, weight, (row_number() OVER (PARTITION BY topic "
        "ORDER BY round(weight, 6) DESC, term_id))::INTEGER AS rank FROM ww)",
        f"dt AS MATERIALIZED (SELECT doc_id, title, topic, c / sum(c) OVER (PARTITION BY doc_id) "
        f"AS weight FROM d{EM_STEPS} JOIN usable USING (doc_id))",
    )


EM = SMALL + _em()


def _fold_in() -> tuple[str, ...]:
    """The EM steps on the documents of ``conversations`` alone, words of the topics held fixed."""
    alpha, eta = 50.0 / EM_TOPICS + 1.0, 1.1
    steps = [
        "seen AS MATERIALIZED (SELECT conv_id * 4294967296 + turn AS doc_id, conv_id || '-' || turn AS title, "
        + CLEAN.replace("content", "text") + " AS t FROM conversations)",
        "na AS MATERIALIZED (SELECT doc_id, term_id, count(*) * any_value(idf) AS w FROM "
        "(SELECT doc_id, unnest(t) AS term FROM seen) JOIN weights USING (term) "
        "GROUP BY doc_id, term_id HAVING count(*) >= 2)",
        "ng0 AS MATERIALIZED (SELECT doc_id, term_id, topic, CASE WHEN "
        f"(31 * doc_id + 17 * term_id) % {EM_TOPICS} = topic THEN w ELSE 0.0 END AS g "
        "FROM na CROSS JOIN topics)",
        "nd0 AS MATERIALIZED (SELECT doc_id, topic, sum(g) AS c FROM ng0 GROUP BY ALL)",
    ]
    for step in range(EM_STEPS):
        steps += [
            f"nu{step} AS MATERIALIZED (SELECT na.doc_id, na.term_id, t.topic, w, "
            f"(t.c + {eta - 1}) * (d.c + {alpha - 1}) "
            f"/ (n.c + (SELECT count(*) FROM vocab) * {eta - 1}) AS u FROM na "
            f"JOIN t{EM_STEPS} t ON t.term_id = na.term_id "
            f"JOIN nd{step} d ON d.doc_id = na.doc_id AND d.topic = t.topic "
            f"JOIN n{EM_STEPS} n ON n.topic = t.topic)",
            f"ng{step + 1} AS MATERIALIZED (SELECT doc_id, term_id, topic, "
            f"w * u / sum(u) OVER (PARTITION BY doc_id, term_id) AS g FROM nu{step})",
            f"nd{step + 1} AS MATERIALIZED (SELECT doc_id, topic, sum(g) AS c FROM ng{step + 1} "
            "GROUP BY ALL)",
        ]
    return tuple(steps)


DOC_RANK = ("ranked AS (SELECT *, (row_number() OVER (PARTITION BY doc_id "
            "ORDER BY round(weight, 6) DESC, topic))::INTEGER AS rank FROM dt)")
TOPIC_RANK = ("ranked AS (SELECT *, (row_number() OVER (PARTITION BY topic "
              "ORDER BY round(weight, 6) DESC, doc_id))::INTEGER AS rank FROM dt)")


def _labels(n: int) -> str:
    return (f"labels_ AS (SELECT topic, string_agg(term, '-' ORDER BY rank) AS label "
            f"FROM words WHERE rank <= {n} GROUP BY topic)")


def _funnel() -> str:
    stages = {
        "1 tokenize": _nested("content", WHITESPACE),
        "2 stop words": _nested(_nested("content", WHITESPACE), NOT_DEFAULT),
        "3 lemmatize": _nested("content", WORDS, STEMS, NOT_DEFAULT),
        "4 filter": _nested("content", WORDS, STEMS, NOT_DEFAULT, SHAPED, LOWERED),
    }
    parts = []
    for stage, expression in stages.items():
        parts.append(
            f"SELECT '{stage}' AS stage, sum(len(t))::BIGINT AS tokens, "
            "(SELECT count(DISTINCT term) FROM (SELECT unnest(t) AS term FROM s))::BIGINT AS unique_tokens, "
            "round(avg(len(t)), 6) AS tokens_per_doc, "
            "round(avg(len(list_distinct(t))), 6) AS unique_per_doc FROM s"
        )
        parts[-1] = f"(WITH s AS MATERIALIZED (SELECT {expression} AS t FROM docs) {parts[-1]})"
    return _with(DOCS, select="\nUNION ALL\n".join(parts))


WIKI_TEXT = _with(
    DOCS, tokens(_nested("content", WORDS)),
    "read AS (SELECT doc_id, title, title || e'\\nHistory' || CASE WHEN len(t) > 0 "
    "THEN e'\\n' || array_to_string(t, ' ') ELSE '' END AS content FROM tokens)",
    select="""SELECT doc_id, title, length(content)::BIGINT AS n_chars,
    md5(content) AS digest FROM read""")

GROWING_COUNTS = _with(*matrix(), select="""SELECT term, sum(n)::BIGINT AS tf, count(*) AS df,
    count(*) FILTER (n >= 2) AS matrix_df FROM counts GROUP BY term
    UNION ALL SELECT NULL, 0, count(*), 0 FROM usable""")
SAVED_LDA = _with(DOCS, tokens(CLEAN), select=f"""SELECT count(*) AS documents, CAST(0 AS BIGINT) AS differing,
    CAST({LDA_TOPICS} AS BIGINT) AS topics FROM tokens WHERE len(t) > 1""")


def oracle_sql() -> dict[str, str]:
    term_freq = _with(*TERM_ROWS, select="SELECT term, count(*) AS tf FROM terms GROUP BY term")
    docs_for_term = _with(
        *SMALL, TITLES,
        _best("SELECT v.term, u.doc_id, round(coalesce(a.tfidf, 0), 6) AS score FROM vocab v "
              "CROSS JOIN usable u LEFT JOIN a ON a.term_id = v.term_id AND a.doc_id = u.doc_id",
              "term"),
        select="SELECT term, rank, doc_id, title, score FROM best JOIN titles USING (doc_id)")
    return {
        "tok_whitespace": digest(_nested("content", WHITESPACE)),
        "tok_letters": digest(_nested("content", WORDS)),
        "stopwords_default": digest(_nested(_nested("content", WHITESPACE), NOT_DEFAULT)),
        "stopwords_file_case": digest(_nested("content", WORDS, NOT_174)),
        "terms_clean": digest(CLEAN),
        "terms_clean_case": digest(CLEAN_CASE),
        "suffix_lemmas": digest(CLEAN_STEMS),
        "lemma_lookup": _with(*LEMMAS, select="""SELECT lemma, count(*) AS tf,
            count(DISTINCT doc_id) AS df FROM lemmatized GROUP BY lemma"""),
        "lemma_terms": _with(
            *LEMMAS,
            "clean AS (SELECT doc_id, lower(lemma) AS term FROM lemmatized WHERE length(lemma) > 2 "
            rf"AND regexp_full_match(lemma, '\p{{L}}+') AND lower(lemma) NOT IN {_list(ENGLISH_DEFAULT)})",
            "listed AS (SELECT doc_id, coalesce(list(term ORDER BY term) FILTER (term IS NOT NULL), [])"
            " AS t FROM docs LEFT JOIN clean USING (doc_id) GROUP BY doc_id)",
            select=DIGEST.replace("FROM tokens", "FROM listed"),
        ),
        "normalizer_hook": digest(r"regexp_extract_all(lower(content), '[\p{L}\p{Nl}\p{No}]+')"),
        "analyser_lemmas": digest(_nested("content", WORDS, LOWERED, STEMS, SHAPED, NOT_DEFAULT)),
        "fold_in_training_default": _with(*matrix(), select=ENTRIES),
        "fold_in_training_book": _with(*matrix(CLEAN_CASE, 20000, 1, 1), select=ENTRIES),
        "fold_in_training_suffixes": _with(*matrix(CLEAN_STEMS), select=ENTRIES),
        "fold_in_training_lemmas": _with(*lemma_matrix(DEFAULT_LEMMA, 2000, 2, 2), select=ENTRIES),
        "stream_training_suffixes": _with(*matrix(CLEAN_STEMS), select=ENTRIES),
        "stream_training_lemmas": _with(*lemma_matrix(DEFAULT_LEMMA, 2000, 2, 2), select=ENTRIES),
        "html_to_text": PAGE_DIGEST,
        "xml_pages": PAGE_DIGEST,
        "xml_scan": PAGE_DIGEST,
        "wiki_to_text": WIKI_TEXT,
        "title_filter": _with(READ_PAGES, select="""SELECT page_id, title FROM read WHERE NOT
            regexp_matches(title, '(^(List)|(Category))|([0-9]+)') AND length(title) > 1"""),
        # the expectation follows from the kinds of record alone
        "page_filter": _with(READ_PAGES, select=r"""SELECT page_id, 'About ' || title AS title FROM read
            WHERE content <> '' AND page_id % 13 <> 3 AND page_id % 17 <> 4 AND page_id % 19 <> 5
            AND page_id % 23 <> 6 AND page_id % 29 <> 7 AND page_id % 11 <> 2 AND page_id % 7 <> 6
            AND page_id % 5 <> 1 AND page_id % 31 <> 8 AND page_id % 37 <> 9 AND page_id % 41 <> 10"""),
        "saved_documents": SAVED,
        "saved_documents_csv": SAVED,
        "saved_doc_ids": _with(DOCS, select="SELECT doc_id, title FROM docs"),
        "saved_matrix": _with(*matrix(), select="""SELECT doc_id, term_id, term, tf,
            round(tfidf, 6) AS tfidf FROM a"""),
        "saved_vocabulary": _with(*matrix(), select="SELECT term_id, term FROM vocab"),
        "saved_graph": _with(*matrix(), select="""SELECT 'd' || doc_id AS src, 't' || term_id AS dst,
            round(tfidf, 6) AS weight FROM a"""),
        "saved_stop_words": _with(*TERM_ROWS,
            "stopped AS (SELECT term FROM terms GROUP BY term ORDER BY count(*) DESC, term LIMIT 50)",
            "found AS (SELECT unnest(" + _nested("content", WORDS, SHAPED) + ") AS word FROM docs)",
            select="""SELECT lower(word) AS term, count(*) AS tf FROM found
            WHERE lower(word) NOT IN (SELECT term FROM stopped) GROUP BY lower(word)"""),
        "fold_in_of_training": _with(*matrix(min_tf=1), select="""SELECT doc_id, count(*) AS n,
            round(sum(tfidf), 5) AS total FROM a GROUP BY doc_id"""),
        "concept_rank": _with(*SMALL, select=
            "SELECT true AS unit, round(sum(tfidf * tfidf), 2) AS energy FROM a"),
        "min_terms": _with(DOCS, tokens(CLEAN), select="""SELECT doc_id, title,
            len(t)::BIGINT AS n_terms FROM tokens WHERE len(t) > 1"""),
        "sample_hash": _with(DOCS, select="""SELECT doc_id, title FROM docs WHERE
            ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT < 1073741824"""),
        "doc_cap": _with(DOCS, select="SELECT doc_id, title FROM docs ORDER BY doc_id LIMIT 100"),
        "docs_by_title": _with(DOCS, select="""SELECT doc_id, title FROM docs
            WHERE contains(lower(title), 'src1-') ORDER BY doc_id LIMIT 15"""),
        "docs_by_body": _with(*matrix(), select="""SELECT u.doc_id, title,
            round(coalesce(tfidf, 0), 6) AS weight FROM usable u
            LEFT JOIN (SELECT * FROM a WHERE term = 'und') x USING (doc_id)
            ORDER BY coalesce(tfidf, 0) DESC, doc_id LIMIT 10"""),
        "docs_by_body_rare": _with(*matrix(), select="""SELECT u.doc_id, title,
            round(coalesce(tfidf, 0), 6) AS weight FROM usable u
            LEFT JOIN (SELECT * FROM a WHERE term_id = (SELECT max(term_id) FROM vocab)) x USING (doc_id)
            ORDER BY coalesce(tfidf, 0) DESC, doc_id LIMIT 1000"""),
        "docs_by_body_each_term": _with(*matrix(), select="""SELECT term, (row_number() OVER (PARTITION BY
            term ORDER BY tfidf DESC, doc_id))::INTEGER AS rank, doc_id, title, round(tfidf, 6) AS weight
            FROM a JOIN usable USING (doc_id) QUALIFY rank <= 10"""),
        "doc_title": _with(DOCS, select="""SELECT i.doc_id, coalesce(title, '') AS title FROM
            (SELECT DISTINCT conv_id * 7 AS doc_id FROM conversations) i LEFT JOIN docs USING (doc_id)"""),
        "row_ids": "SELECT count(*) AS documents, count(*) AS ids FROM documents",
        "funnel_report": _funnel(),
        "token_totals": _with(DOCS, tokens(CLEAN), select="""SELECT sum(len(t))::BIGINT AS tokens,
            round(avg(len(t)), 6) AS tokens_per_doc FROM tokens"""),
        "distinct_totals": _with(*TERM_ROWS, select="""SELECT
            (SELECT count(DISTINCT term) FROM terms) AS unique_tokens,
            round(avg(len(list_distinct(t))), 6) AS unique_per_doc FROM tokens"""),
        "distinct_totals_sketch": _with(DOCS, tokens(CLEAN), select="""SELECT true AS close,
            round(avg(len(list_distinct(t))), 6) AS unique_per_doc FROM tokens"""),
        "longest_document": _with(DOCS, tokens(CLEAN), select=
            "SELECT max(len(t))::BIGINT AS max_tokens FROM tokens"),
        "usable_documents": _with(DOCS, tokens(CLEAN), select=
            "SELECT count(*) AS documents FROM tokens WHERE len(t) > 1"),
        "term_freq": term_freq,
        "stream_term_counts": term_freq,
        "doc_freq": _with(*TERM_ROWS, select=
            "SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY term"),
        "tf_df_join": _with(*TERM_ROWS, select="""SELECT term, count(*) AS tf,
            count(DISTINCT doc_id) AS df FROM terms GROUP BY term"""),
        "column_summary": """
            SELECT 'count' AS summary, count(lang)::VARCHAR AS lang, count(source)::VARCHAR AS source,
                count(n_chars)::DOUBLE AS n_chars FROM documents
            UNION ALL SELECT 'mean', NULL, NULL, round(avg(n_chars), 4) FROM documents
            UNION ALL SELECT 'stddev', NULL, NULL, round(stddev_samp(n_chars), 4) FROM documents
            UNION ALL SELECT 'min', min(lang), min(source), min(n_chars) FROM documents
            UNION ALL SELECT 'max', max(lang), max(source), max(n_chars) FROM documents""",
        "vocab_diff": _with(
            DOCS,
            f"l AS (SELECT unnest({CLEAN}) AS term FROM docs)",
            f"r AS (SELECT unnest({CLEAN_CASE}) AS term FROM docs)",
            "lv AS (SELECT term FROM l GROUP BY term ORDER BY count(*) DESC, term LIMIT 2000)",
            "rv AS (SELECT term FROM r GROUP BY term ORDER BY count(*) DESC, term LIMIT 2000)",
            select="""SELECT term, 'left' AS only_in FROM lv WHERE term NOT IN (SELECT term FROM rv)
                UNION ALL SELECT term, 'right' FROM rv WHERE term NOT IN (SELECT term FROM lv)"""),
        "vocab_fit": _with(*matrix(), select="SELECT term_id, term, tf, df FROM vocab"),
        "tf_matrix": _with(*matrix(), select="SELECT doc_id, term, tf FROM a"),
        "idf_weights": _with(*matrix(), select="""SELECT term_id, term, tf, df, matrix_df,
            round(idf, 9) AS idf FROM weights"""),
        "tfidf_matrix": _with(*matrix(), select="""SELECT doc_id, term_id, term, tf,
            round(tfidf, 6) AS tfidf FROM a"""),
        "book_matrix": _with(*matrix(CLEAN_CASE, 20000, 1, 1), select="""SELECT doc_id, term_id, term,
            tf, round(tfidf, 6) AS tfidf FROM a"""),
        "tfidf_matrix_lemmas": _with(*lemma_matrix(DEFAULT_LEMMA, 2000, 2, 2), select="""SELECT doc_id,
            term_id, term, tf, round(tfidf, 6) AS tfidf FROM a"""),
        "book_matrix_lemmas": _with(*lemma_matrix(f"lemma IN {_list(ENGLISH_174)}", 20000, 1, 1), select="""SELECT doc_id,
            term_id, term, tf, round(tfidf, 6) AS tfidf FROM a"""),
        "doc_top_terms": _with(*matrix(), select="""SELECT doc_id, (row_number() OVER (PARTITION BY
            doc_id ORDER BY tf DESC, term_id))::INTEGER AS rank, term, tf FROM a QUALIFY rank <= 5"""),
        "tf_vs_tfidf": _with(*matrix(), select="""SELECT title, term, tf, round(tfidf, 6) AS tfidf
            FROM a JOIN usable USING (doc_id)"""),
        "graph_edges": _with(*matrix(), select="""SELECT 'd' || doc_id AS src, 't' || term_id AS dst,
            round(tfidf, 6) AS weight FROM a"""),
        "graph_nodes": _with(*matrix(), select="""SELECT 'd' || doc_id AS id, title AS label FROM usable
            UNION ALL SELECT 't' || term_id, term FROM vocab"""),
        "svd_sigma0": _with(*SMALL, *_leading(), select="""SELECT round(s, 3) AS sigma0,
            (SELECT round(sum(tfidf * tfidf), 3) FROM a) AS energy FROM sigmas"""),
        "svd_concept0_terms": _with(*SMALL, *_leading(), select="""SELECT term_id, term,
            round(v, 6) AS weight FROM v JOIN vocab USING (term_id)
            ORDER BY round(v, 9) DESC, term_id LIMIT 10"""),
        "svd_concept0_docs": _with(*SMALL, *_leading(), select="""SELECT
            (row_number() OVER (ORDER BY round(us, 6) DESC, doc_id))::INTEGER AS rank,
            doc_id, title, round(round(us, 6) / s, 6) AS weight
            FROM us JOIN usable USING (doc_id) JOIN sigmas USING (concept) QUALIFY rank <= 10"""),
        "svd3_sigmas": _with(*SMALL, *_leading(3), select=
            "SELECT concept, round(s, 4) AS sigma FROM sigmas"),
        "svd3_concept_terms": _with(*SMALL, *_leading(3), CONCEPT_RANK, select="""SELECT concept, rank,
            term, round(v, 6) AS weight FROM ranked WHERE rank <= 10"""),
        "svd3_concept_words": _with(*SMALL, *_leading(3), CONCEPT_RANK, select="""SELECT concept,
            string_agg(term, ', ' ORDER BY rank) AS words FROM ranked WHERE rank <= 5
            GROUP BY concept"""),
        "svd3_concept_docs": _with(*SMALL, *_leading(3), _best(
            "SELECT concept, doc_id, round(us, 6) AS score FROM us", "concept"), TITLES,
            select="""SELECT concept, rank, doc_id, title, round(score / s, 6) AS weight
            FROM best JOIN titles USING (doc_id) JOIN sigmas USING (concept)"""),
        "svd3_docs_for_term": _with(*SMALL, *_leading(3), _best(
            "SELECT term, doc_id, round(sum(us * v), 6) AS score FROM v JOIN vocab USING (term_id) "
            "JOIN us USING (concept) GROUP BY term, doc_id", "term"), TITLES,
            select="SELECT term, rank, doc_id, title, score FROM best JOIN titles USING (doc_id)"),
        "svd3_docs_for_doc": _with(*SMALL, *_leading(3), LONGEST,
            "unit AS MATERIALIZED (SELECT doc_id, concept, us / sqrt(sum(us * us) OVER "
            "(PARTITION BY doc_id)) AS x FROM us QUALIFY sqrt(sum(us * us) OVER "
            "(PARTITION BY doc_id)) > 1e-9)", _best(
            "SELECT query_id, y.doc_id, round(sum(x.x * y.x), 6) AS score FROM longest "
            "JOIN unit x ON x.doc_id = query_id JOIN unit y ON y.concept = x.concept "
            "GROUP BY query_id, y.doc_id", "query_id"), TITLES,
            select="SELECT query_id, rank, doc_id, title, score FROM best JOIN titles USING (doc_id)"),
        "svd3_terms_for_term": _with(*SMALL, *_leading(3),
            "unit AS MATERIALIZED (SELECT term_id, concept, v * s / sqrt(sum(v * s * v * s) OVER "
            "(PARTITION BY term_id)) AS x FROM v JOIN sigmas USING (concept) "
            "QUALIFY sqrt(sum(v * s * v * s) OVER (PARTITION BY term_id)) > 1e-9)", _best(
            "SELECT x.term_id AS asked, y.term_id, round(sum(x.x * y.x), 6) AS score FROM unit x "
            "JOIN unit y USING (concept) GROUP BY ALL", "asked", "term_id"),
            select="""SELECT q.term, rank, r.term AS related, score FROM best
            JOIN vocab q ON q.term_id = asked JOIN vocab r ON r.term_id = best.term_id"""),
        "svd3_docs_for_query": _with(*SMALL, *_leading(3), ASKED,
            "q AS MATERIALIZED (SELECT query_id, concept, sum(idf * v) AS x FROM asked "
            "JOIN weights USING (term) JOIN v USING (term_id) GROUP BY ALL)", _best(
            "SELECT query_id, doc_id, round(sum(x * us), 6) AS score FROM q JOIN us USING (concept) "
            "GROUP BY ALL", "query_id"), TITLES,
            select="SELECT query_id, rank, doc_id, title, score FROM best JOIN titles USING (doc_id)"),
        "term_norms": _with(*SMALL, select="""SELECT term_id, v.term,
            round(coalesce(sqrt(sum(tfidf * tfidf)), 0), 5) AS norm
            FROM vocab v LEFT JOIN a USING (term_id) GROUP BY term_id, v.term"""),
        "doc_norms": _with(*SMALL, select="""SELECT u.doc_id,
            round(coalesce(sqrt(sum(tfidf * tfidf)), 0), 5) AS norm
            FROM usable u LEFT JOIN a USING (doc_id) GROUP BY u.doc_id"""),
        "docs_for_term": docs_for_term,
        "saved_concepts": docs_for_term,
        "terms_for_term": _with(
            *SMALL,
            "lengths AS (SELECT term_id, term, sqrt(sum(tfidf * tfidf)) AS norm FROM a GROUP BY ALL)",
            "dots AS (SELECT x.term_id AS i, y.term_id AS j, sum(x.tfidf * y.tfidf) AS dot "
            "FROM a x JOIN a y USING (doc_id) GROUP BY ALL)",
            _best("SELECT x.term, y.term_id, y.term AS related, "
                  "round(coalesce(dot, 0) / (x.norm * y.norm), 6) AS score FROM lengths x "
                  "CROSS JOIN lengths y LEFT JOIN dots ON i = x.term_id AND j = y.term_id",
                  "term", "term_id"),
            select="SELECT term, rank, related, score FROM best"),
        "docs_for_doc": DOCS_FOR_DOC,
        "docs_for_title": DOCS_FOR_DOC,
        "query_vector": _with(*SMALL, ASKED, select="""SELECT query_id, term_id, term,
            round(idf, 9) AS weight FROM asked JOIN weights USING (term)"""),
        "query_vector_full": _with(*matrix(), ASKED, select="""SELECT query_id, term_id, term,
            round(idf, 9) AS weight FROM asked JOIN weights USING (term)"""),
        "query_unknown_terms": _with(*SMALL, ASKED, select="""SELECT query_id, term FROM asked
            WHERE term NOT IN (SELECT term FROM vocab)"""),
        "docs_for_query": _with(
            *SMALL, TITLES, ASKED,
            "q AS MATERIALIZED (SELECT query_id, term_id, idf FROM asked JOIN weights USING (term))",
            "dots AS (SELECT query_id, doc_id, sum(idf * tfidf) AS dot FROM q JOIN a USING (term_id) "
            "GROUP BY ALL)",
            _best("SELECT k.query_id, u.doc_id, round(coalesce(dot, 0), 6) AS score FROM "
                  "(SELECT DISTINCT query_id FROM q) k CROSS JOIN usable u LEFT JOIN dots "
                  "ON dots.query_id = k.query_id AND dots.doc_id = u.doc_id", "query_id"),
            select="SELECT query_id, rank, doc_id, title, score FROM best JOIN titles USING (doc_id)"),
        "lda_em_topic_terms": _with(*EM, select=
            "SELECT term_id, term, topic, round(count, 5) AS count FROM tt"),
        "lda_em_topic_words": _with(*EM, select="""SELECT topic,
            string_agg(term, ', ' ORDER BY rank) AS words FROM words WHERE rank <= 10 GROUP BY topic"""),
        "lda_em_topic_word_weights": _with(*EM, select="""SELECT topic, rank, term,
            round(weight, 6) AS weight FROM words WHERE rank <= 10"""),
        "lda_em_doc_topics": _with(*EM, select=
            "SELECT doc_id, title, topic, round(weight, 6) AS weight FROM dt"),
        "saved_topics": _with(*EM, select=
            "SELECT doc_id, title, topic, round(weight, 6) AS weight FROM dt"),
        "top_topics_for_doc": _with(*EM, DOC_RANK, select="""SELECT doc_id, title, rank, topic,
            round(weight, 6) AS weight FROM ranked WHERE rank <= 2"""),
        "top_docs_for_topic": _with(*EM, TOPIC_RANK, select="""SELECT topic, rank, doc_id, title,
            round(weight, 6) AS weight FROM ranked WHERE rank <= 10"""),
        "top_docs_for_one_topic": _with(*EM, TOPIC_RANK, select="""SELECT rank, doc_id, title,
            round(weight, 6) AS weight FROM ranked WHERE rank <= 10 AND topic = 1"""),
        "top_topics_for_term": _with(*EM, select="""SELECT term, (row_number() OVER (PARTITION BY term
            ORDER BY round(count, 6) DESC, topic))::INTEGER AS rank, topic, round(count, 5) AS weight
            FROM tt"""),
        "topics_labelled": _with(*EM, _labels(10), select="""SELECT topic, label,
            'TOPIC ' || topic || ': ' || replace(label, '-', ', ') AS line FROM labels_"""),
        "doc_topics_labelled": _with(*EM, DOC_RANK, _labels(3), select="""SELECT topic, doc_id, title,
            rank, round(weight, 6) AS weight, label FROM ranked JOIN labels_ USING (topic)
            WHERE rank <= 1"""),
        "topic_json": _with(*EM, select="""SELECT '[' || string_agg('{"term":"' || term ||
            '","probability":' || round(weight, 6)::VARCHAR || ',"topicId":' || topic || '}',
            ',' ORDER BY topic, rank) || ']' AS json FROM words WHERE rank <= 10"""),
        "lda_ml_em_totals": _with(*SMALL, select="""SELECT count(DISTINCT doc_id) AS documents,
            true AS shares_add_up, round(sum(tfidf), 2) AS weight FROM a"""),
        "lda_ml_term_totals": _with(*matrix(), select=f"""SELECT term, {LDA_TOPICS}::BIGINT AS topics,
            {LDA_TOPICS}::BIGINT AS last_rank, round(coalesce(sum(tfidf), 0), 4) AS weight
            FROM vocab LEFT JOIN a USING (term_id, term) GROUP BY term"""),
        "lda_ml_doc_totals": _with(*matrix(), TITLES, select=f"""SELECT doc_id, title,
            {LDA_TOPICS}::BIGINT AS topics, true AS falling, true AS adds_up FROM titles"""),
        "lda_ml_online_totals": _with(*SMALL, select="""SELECT CAST(topic AS INTEGER) AS topic,
            (SELECT count(*) FROM vocab) AS terms, true AS adds_up FROM range(5) r(topic)"""),
        "lda_quality_totals": _with(*SMALL, select=
            "SELECT round(sum(tfidf), 2) AS weight, true AS positive FROM a"),
        "stream_score_equals_batch":
            "SELECT count(*) * 5 AS rows, CAST(0 AS BIGINT) AS differing FROM conversations",
        "svd_k_factors": "SELECT CAST(20 AS BIGINT) AS concepts, true AS orthonormal, true AS lengths",
        "sample_random_bounds": "SELECT true AS about_a_quarter, true AS distinct",
        "fold_in_em": _with(*EM, *_fold_in(), select="""SELECT doc_id, title, topic,
            round(c / sum(c) OVER (PARTITION BY doc_id), 6) AS weight
            FROM nd""" + str(EM_STEPS) + " JOIN seen USING (doc_id)"),
        "growing_counts": GROWING_COUNTS,
        "stream_growing_counts": GROWING_COUNTS,
        "growing_idf": _with(*matrix(), select="""SELECT term_id, term, tf, df, matrix_df,
            round(idf, 9) AS idf FROM weights"""),
        "growing_matrix": _with(*(cte.replace(
            "FROM counts GROUP BY term HAVING", f"FROM counts WHERE doc_id % {BATCHES} < 3 GROUP BY term HAVING"
        ) for cte in matrix()), select=ENTRIES),
        "growing_funnel": "SELECT stage, tokens, tokens_per_doc, unique_per_doc, true AS close FROM (" + _funnel() + ")",
        "vocab_coded": _with(*matrix(size=1 << 31), select="""SELECT term_id::BIGINT AS term_id, term, tf, df, matrix_df,
            round(idf, 9) AS idf FROM weights"""),
        "matrix_coded": _with(*matrix(size=1 << 31), select=
            "SELECT doc_id, term_id::BIGINT AS term_id, tf, round(tfidf, 6) AS tfidf FROM a"),
        "saved_lda_em": SAVED_LDA,
        "saved_lda_online": SAVED_LDA,
        "lda_priors": _with(*SMALL, "n AS (SELECT count(*) AS n FROM vocab)", select=f"""
            SELECT 'em' AS optimizer, 50.0::DOUBLE / {SMALL_TOPICS} + 1 AS doc_concentration,
                round(200.0::DOUBLE / n + 1, 9) AS topic_concentration FROM n
            UNION ALL SELECT 'online', 50.0::DOUBLE / {SMALL_TOPICS}, round(200.0::DOUBLE / n, 9) FROM n"""),
        "configured_jobs": WIKI_TEXT,
        "lsa_run": _with(
            *matrix(CLEAN_CASE, SMALL_VOCABULARY, 1, 1), TITLES,
            _best("SELECT v.term, u.doc_id, round(coalesce(a.tfidf, 0), 6) AS score FROM vocab v "
                  "CROSS JOIN usable u LEFT JOIN a ON a.term_id = v.term_id AND a.doc_id = u.doc_id "
                  "WHERE v.term_id < 5", "term"),
            select="SELECT term, rank, doc_id, title, score FROM best JOIN titles USING (doc_id)"),
        "topic_table": _with(*EM, select="SELECT topic, " + ", ".join(
            f"max(CASE WHEN rank = {i} THEN term END) AS w{i}" for i in range(1, 6)
        ) + " FROM words GROUP BY topic"),
    }
