"""Text to words to count vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import entries
from ..functions import text as words
from ..functions.stopwords import STOP_WORDS
from ..operators.partitions import explode_once, spread
from ..operators.relational import sum_of_row_maxima
from ..plans.heavy_hitters import heavy_hitters
from ..plans.topics import TopicSettings, annotate, count_vector_stage, count_vectors, stem_vocabulary, vocabulary
from ..session import stored
from .registry import query, table

_STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
_VC = "^[^aeiouy]*[aeiouy]+[^aeiouy]+"

# Stems of all distinct words by SQL pattern functions; kept(doc_id, pos, word)
# are the words left after the stop words. m0, m1: measure above 0 and above 1.
KEPT_SQL = rf"""
WITH split AS (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}]+'), lambda w: w <> '') AS words FROM documents
), kept AS (
    SELECT * FROM (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM split)
    WHERE word NOT IN ({_STOP_LIST})
)"""

STEMS_SQL = (
    KEPT_SQL
    + rf""", s0 AS (
    SELECT word, replace(regexp_replace(regexp_replace(word, '^y', 'Y'), '([aeiou])y', '\1Y', 'g'), 'yy', 'yY') AS w
    FROM (SELECT DISTINCT word FROM kept)
), s1a AS (
    SELECT word, CASE WHEN regexp_matches(w, '(sses|ies)$') THEN w[:-3] WHEN regexp_matches(w, '([^s]|^)s$') THEN w[:-2] ELSE w END AS w
    FROM s0
), s1b AS (
    SELECT word, w, CASE WHEN w LIKE '%eed' THEN NULL
                         WHEN w LIKE '%ed' AND regexp_matches(left(w, length(w) - 2), '[aeiouy]') THEN left(w, length(w) - 2)
                         WHEN w LIKE '%ing' AND regexp_matches(left(w, length(w) - 3), '[aeiouy]') THEN left(w, length(w) - 3) END AS r
    FROM s1a
), s1 AS (
    SELECT word, CASE
        WHEN w LIKE '%eed' THEN CASE WHEN regexp_matches(left(w, length(w) - 3), '{_VC}') THEN left(w, length(w) - 1) ELSE w END
        WHEN r IS NULL THEN w
        WHEN regexp_matches(r, '(at|bl|iz)$') THEN r || 'e'
        WHEN length(r) > 1 AND right(r, 1) = left(right(r, 2), 1) AND regexp_matches(r, '[^aeiouylsz]$') THEN left(r, length(r) - 1)
        WHEN regexp_matches(r, '^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]*$') AND regexp_matches(r, '[^aeiouy][aeiouy][^aeiouywxY]$') THEN r || 'e'
        ELSE r END AS w
    FROM s1b
), s1c AS (
    SELECT word, CASE WHEN regexp_matches(w, '[aeiouy].*[yY]$') THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM s1
), s2 AS (
    SELECT word, w, regexp_extract(w, '(ational|tional|enci|anci|izer|abli|alli|entli|eli|ousli|ization|ation|ator|alism|iveness|fulness|ousness|aliti|iviti|biliti)$') AS x FROM s1c
), s2d AS (
    SELECT word, CASE WHEN x <> '' AND regexp_matches(left(w, length(w) - length(x)), '{_VC}')
        THEN left(w, length(w) - length(x)) || CASE
            WHEN x IN ('ational', 'ation', 'ator') THEN 'ate' WHEN x = 'tional' THEN 'tion' WHEN x = 'enci' THEN 'ence'
            WHEN x = 'anci' THEN 'ance' WHEN x IN ('izer', 'ization') THEN 'ize' WHEN x = 'abli' THEN 'able'
            WHEN x IN ('alli', 'alism', 'aliti') THEN 'al' WHEN x = 'entli' THEN 'ent' WHEN x = 'eli' THEN 'e'
            WHEN x IN ('ousli', 'ousness') THEN 'ous' WHEN x IN ('iveness', 'iviti') THEN 'ive'
            WHEN x = 'fulness' THEN 'ful' ELSE 'ble' END
        ELSE w END AS w
    FROM s2
), s3 AS (
    SELECT word, w, regexp_extract(w, '(icate|ative|alize|iciti|ical|ful|ness)$') AS x FROM s2d
), s3d AS (
    SELECT word, CASE WHEN x <> '' AND regexp_matches(left(w, length(w) - length(x)), '{_VC}')
        THEN left(w, length(w) - length(x)) || CASE WHEN x IN ('icate', 'iciti', 'ical') THEN 'ic' WHEN x = 'alize' THEN 'al' ELSE '' END
        ELSE w END AS w
    FROM s3
), s4 AS (
    SELECT word, w, regexp_extract(w, '(al|ance|ence|er|ic|able|ible|ant|ement|ment|ent|ion|ou|ism|ate|iti|ous|ive|ize)$') AS x FROM s3d
), s4d AS (
    SELECT word, CASE WHEN x <> '' AND regexp_matches(left(w, length(w) - length(x)), '{_VC}[aeiouy]+[^aeiouy]+')
            AND (x <> 'ion' OR regexp_matches(w, '[st]ion$')) THEN left(w, length(w) - length(x)) ELSE w END AS w
    FROM s4
), s5 AS (
    SELECT word, CASE WHEN w LIKE '%e' AND (regexp_matches(left(w, length(w) - 1), '{_VC}[aeiouy]+[^aeiouy]+')
            OR (regexp_matches(left(w, length(w) - 1), '{_VC}') AND NOT regexp_matches(w, '[^aeiouy][aeiouy][^aeiouywxY]e$')))
        THEN left(w, length(w) - 1) ELSE w END AS w
    FROM s4d
), stems AS (
    SELECT word, CASE WHEN length(word) <= 2 THEN word
                      WHEN w LIKE '%ll' AND regexp_matches(w, '{_VC}[aeiouy]+[^aeiouy]+') THEN lower(left(w, length(w) - 1))
                      ELSE lower(w) END AS stem
    FROM s5
)"""
)

# vectors(doc_id, index, value): entries of the count vectors at the default settings.
WORDS_SQL = (
    STEMS_SQL
    + """, counted AS (
    SELECT doc_id, stem, count(*) AS n FROM kept JOIN stems USING (word) GROUP BY doc_id, stem
), vocab AS (
    SELECT stem, sum(n)::BIGINT AS n, CAST(row_number() OVER (ORDER BY sum(n) DESC, stem) - 1 AS INTEGER) AS index
    FROM counted GROUP BY stem ORDER BY index LIMIT 500
), vectors AS (
    SELECT doc_id, index, CAST(counted.n AS DOUBLE) AS value FROM counted JOIN vocab USING (stem) WHERE counted.n >= 3
)
"""
)


def documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


@query(
    "doc_shrink",
    r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS document FROM documents",
)
def doc_shrink(spark, sf):
    return table(spark, sf, "documents").select("doc_id", words.shrink("text").alias("document"))


@query(
    "tokenize",
    r"""
    SELECT doc_id, CAST(len(words) AS INTEGER) AS n, array_to_string(words, ' ') AS tokens
    FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda w: w <> '') AS words FROM documents)
    """,
)
def tokenize(spark, sf):
    tokens = documents(spark, sf).select("doc_id", words.tokenize("text").alias("tokens"))
    return tokens.select("doc_id", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("tokens"))


@query(
    "normalize_tokens",
    r"""
    SELECT conv_id, turn, array_to_string(list_filter(
        list_transform(string_split(text, ' '), lambda w: regexp_replace(w, '[^\p{L}]', '', 'g')), lambda w: w <> ''), ' ') AS tokens
    FROM conversations
    """,
)
def normalize_tokens(spark, sf):
    raw = table(spark, sf, "conversations").select("conv_id", "turn", F.split("text", " ").alias("raw"))
    return raw.select("conv_id", "turn", F.array_join(words.normalize("raw"), " ").alias("tokens"))


@query(
    "remove_stop_words",
    f"""
    SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '[^\\p{{L}}]+'),
        lambda w: w <> '' AND lower(w) NOT IN ({_STOP_LIST})), ' ') AS tokens
    FROM documents
    """,
)
def remove_stop_words(spark, sf):
    raw = F.filter(F.split("text", words.NOT_LETTERS + "+"), lambda w: w != "")
    left = words.remove_stop_words(raw)
    return documents(spark, sf).select("doc_id", F.array_join(left, " ").alias("tokens"))


@query(
    "stem_vocab",
    STEMS_SQL
    + """
    SELECT word, stem, regexp_replace(regexp_replace(word, '(ss|i)es$', '\\1'), '([^s])s$', '\\1') AS singular, count(*) AS n
    FROM kept JOIN stems USING (word) GROUP BY ALL
    """,
)
def stem_vocab(spark, sf):
    clean = explode_once(annotate(documents(spark, sf), "text", stems=False), "tokens", "word")
    counts = clean.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    singular = F.regexp_replace(F.regexp_replace("word", "(ss|i)es$", "$1"), "([^s])s$", "$1")
    return counts.select("word", words.stem_word("word").alias("stem"), singular.alias("singular"), "n")


@query(
    "text_stages",
    STEMS_SQL
    + r""", joined AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS clean, string_agg(stem, ' ' ORDER BY pos) AS tokens, count(*) AS n
    FROM kept JOIN stems USING (word) GROUP BY doc_id
    )
    SELECT split.doc_id, CAST(len(words) AS INTEGER) AS n_token, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens,
           coalesce(clean, '') AS clean, coalesce(tokens, '') AS tokens
    FROM split LEFT JOIN joined USING (doc_id)
    """,
)
def text_stages(spark, sf):
    done = annotate(documents(spark, sf), "text")
    return done.select(
        "doc_id",
        F.size("token").alias("n_token"),
        F.size("tokens").alias("n_tokens"),
        F.array_join("cleanTokens", " ").alias("clean"),
        F.array_join("tokens", " ").alias("tokens"),
    )


def words_of(spark, sf):
    return annotate(documents(spark, sf), "text").select("doc_id", "tokens")


@query("vocabulary", WORDS_SQL + "SELECT stem AS word, n FROM vocab")
def vocabulary_query(spark, sf):
    return stem_vocabulary(annotate(documents(spark, sf), "text", stems=False), 500)


@query(
    "vocabulary_heavy_hitters",
    """SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[^ \\t\\n\\v\\f\\r]+')) AS word FROM documents)
       GROUP BY word ORDER BY n DESC, word LIMIT 300""",
)
def vocabulary_heavy_hitters(spark, sf):
    runs = F.regexp_extract_all(F.lower("text"), F.lit(r"[^ \t\n\x0B\f\r]+"), F.lit(0))
    tokens = stored(documents(spark, sf).select(runs.alias("tokens")), "runs")
    return heavy_hitters(tokens, 300, counters=4096).words


@query("count_vectors", WORDS_SQL + "SELECT doc_id, index, stem AS word, value FROM vectors JOIN vocab USING (index)")
def count_vectors_query(spark, sf):
    tokens = stored(words_of(spark, sf), "words")
    vocab = [r.word for r in vocabulary(tokens, 500).collect()]
    listed = F.broadcast(spark.createDataFrame(list(enumerate(vocab)), "index int, word string"))
    entry = explode_once(count_vectors(tokens, vocab, 3.0), entries("features"), "e", "doc_id")
    return entry.select("doc_id", "e.index", "e.value").join(listed, "index")


@query("sum_row_max", WORDS_SQL + "SELECT sum(top) AS total FROM (SELECT max(value) AS top FROM vectors GROUP BY doc_id)")
def sum_row_max(spark, sf):
    tokens = stored(words_of(spark, sf), "words")
    vocab = [r.word for r in vocabulary(tokens, 500).collect()]
    return sum_of_row_maxima(count_vectors(tokens, vocab, 3.0))


@query(
    "count_vector_stage",
    WORDS_SQL
    + """
    SELECT documents.doc_id, CAST(count(index) AS INTEGER) AS n_entries, max(value) AS top
    FROM documents LEFT JOIN vectors ON documents.doc_id = vectors.doc_id
    GROUP BY documents.doc_id HAVING (SELECT count(*) FROM vectors) > 0
    """,
)
def count_vector_stage_query(spark, sf):
    stage = count_vector_stage(words_of(spark, sf), TopicSettings(), "doc_id")
    if stage is None:
        return spark.createDataFrame([], "doc_id bigint, n_entries int, top double")
    found = stage.vectors.select("doc_id", entries("features").alias("e"))
    top = F.array_max(F.transform("e", lambda p: p["value"]))
    out = stored(found.select("doc_id", F.size("e").alias("n_entries"), top.alias("top")), "counted")
    stage.release()
    return out
