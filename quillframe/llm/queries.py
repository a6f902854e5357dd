"""The numbered queries of this folder, each beside its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from .token_counts import count_tokens

    path = public_tokenizers.path
    rows = count_tokens(
        table(spark, folder, "documents", "doc_id", "text"), fresh_path(spark, "token-cache"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")
    )
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op4_minhash_near_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from .near_dedup import DedupSettings, near_duplicates

    return near_duplicates(table(spark, folder, "documents", "doc_id", "text"), settings=DedupSettings(shingle=2, percent=80))


@query("op6_benchmark_decontamination")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from .phrase_index import contamination

    found = contamination(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


@query(
    "op9_line_dedup",
    """
    WITH lines AS (
        SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    ), trimmed AS (
        SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM lines
    ), keyed AS (
        SELECT *, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM trimmed
    ), often AS (
        SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
    ), marked AS (
        SELECT d.*, coalesce(d.doc_id <> o.keeper, FALSE) AS lost FROM keyed d LEFT JOIN often o ON d.k = o.k
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from .line_runs import dedupe_lines

    rows = dedupe_lines(table(spark, folder, "documents", "doc_id", "text"), min_chars=40, min_docs=5)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op10_quality_rules")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from .quality_rules import judge

    rows = judge(table(spark, folder, "documents", "doc_id", "text"))
    return rows.drop("text")


#: Rules of the url query: (verdict, host, path prefix).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query("op3_url_filters")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from .url_templates import Rule, filter_urls

    return filter_urls(table(spark, folder, "pages", "page_id", "url"), [Rule(*r) for r in URL_RULES]).drop("url")


@query("op8_importance_resampling")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from .importance import Resampler

    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    model = Resampler(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "labels", "doc_id", "quality", "toxic"), good)
    return model.scores.select(F.col("_id").alias("doc_id"), "n_features", "log_weight", model.kept().alias("kept"))


@query("op5_bpe_automaton")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from .bpe_automaton import encode

    rows = encode(table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_warc_capture_index")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from .warc_index import archive_and_read

    rows = archive_and_read(table(spark, folder, "pages", "page_id", "url", "html"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op1_html_template")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from .html_template import extract

    rows = extract(table(spark, folder, "pages", "page_id", "url", "html"), keep=["page_id", "url"])
    return rows.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from .periodic_runs import find_runs

    docs = table(spark, folder, "documents", "doc_id", "text")
    # A tenth of the texts, told by their id's checksum, repeat their tail with a period of its own.
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.withColumn("g", F.floor(checksum / 10)).withColumn(
        "words", F.when(checksum % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    )
    placed = chosen.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), 1, F.col("n") - F.col("a"))
    altered = F.array_join(F.concat(F.slice("words", 1, F.col("a")), tail), " ")
    rows = find_runs(placed.select("doc_id", F.when(F.col("a").isNotNull(), altered).otherwise(F.col("text")).alias("text")), min_length=6, min_exponent=4)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = rows.select("doc_id", "runs", "collapsed", longest.alias("longest"))
    length, start, period = (F.col(f"longest.{part}") for part in ("length", "start", "period"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.floor(1000 * length / -period).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_source_mixing",
    r"""
    WITH docs AS (
        SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, 'null')) AS key,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
        FROM documents
    ), numbered AS (
        SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM docs GROUP BY source
    ), filled AS (
        SELECT *, sum(2 * source_size) OVER f - 2 * source_size AS limits, sum(weight) OVER () - sum(weight) OVER f + weight AS left_weight,
            150 * sum(source_size) OVER () AS budget
        FROM numbered
        WINDOW f AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
    ), stopped AS (
        SELECT *, 100 * (limits * weight + 2 * source_size * left_weight) <= budget * weight AS stopped FROM filled
    ), sources AS (
        SELECT source, source_size, CASE WHEN stopped THEN (2 * source_size)::DOUBLE
            ELSE ((budget - 100 * coalesce(sum(2 * source_size) FILTER (WHERE stopped) OVER (), 0)) * weight)::DOUBLE
                / (100.0 * sum(weight) FILTER (WHERE NOT stopped) OVER ())::DOUBLE END AS target
        FROM stopped
    ), placed AS (
        SELECT d.*, s.source_size, s.target, greatest(1, floor(s.target / 1000)::BIGINT) AS packet,
            (sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS first
        FROM docs d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
    ), turns AS (
        SELECT *, first + turn * source_size AS queued, least(size, ceil(target)::BIGINT + 2 * packet - first - turn * source_size) AS reach
        FROM placed, (VALUES (0), (1)) t(turn)
    ), packets AS (
        SELECT *, unnest(range(0, reach, packet)) AS off FROM turns WHERE reach > 0
    ), sized AS (
        SELECT *, least(packet, size - off) AS words, (queued + off + least(packet, size - off))::DOUBLE / target AS finish FROM packets
    ), sorted AS (
        SELECT *, sum(words) OVER (ORDER BY finish, key, source NULLS LAST, turn, off ROWS UNBOUNDED PRECEDING) - words AS before FROM sized
    ), taken AS (
        SELECT doc_id, sum(greatest(0, least(words, (SELECT sum(size) * 150 // 100 FROM docs) - before)))::BIGINT AS taken FROM sorted GROUP BY doc_id
    )
    SELECT p.doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM placed p LEFT JOIN taken t ON p.doc_id = t.doc_id
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, folder, "documents", "doc_id", "source", "text"))


@query(
    "op13_phrase_collocations",
    r"""
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang,
            string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
        FROM documents
    ), pieces AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM texts)
    ), grams AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k)
    ), counted AS MATERIALIZED (
        SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*)::HUGEINT AS f FROM grams GROUP BY lang, k, phrase
    ), totals AS (
        SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang
    ), candidates AS MATERIALIZED (
        SELECT * FROM counted WHERE k > 1 AND f >= 30
    ), split AS MATERIALIZED (
        SELECT lang, phrase, f, cut, array_to_string(w[1:cut], ' ') AS left_part, array_to_string(w[cut + 1:k], ' ') AS right_part
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
    ), cuts AS (
        SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, cut, 2000000 * c.f // (l.f + r.f) AS score
        FROM split c
        JOIN counted l ON l.lang = c.lang AND l.phrase = left_part
        JOIN counted r ON r.lang = c.lang AND r.phrase = right_part
    ), weakest AS (
        SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM cuts
    ), covered AS (
        SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(f) AS longer
        FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM candidates, (VALUES (2), (3)) s(j) WHERE k > j) GROUP BY ALL
    ), ranked AS (
        SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
        FROM weakest w LEFT JOIN covered v ON w.lang = v.lang AND w.phrase = v.phrase
        WHERE nth = 1 AND (longer IS NULL OR 100 * longer < 80 * a)
    )
    SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from .phrase_mining import top_phrases

    return top_phrases(table(spark, folder, "documents", "lang", "text"))
