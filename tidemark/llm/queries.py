"""The registered queries of the training-data operators, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import read_table
from tidemark.llm.mixing import mix_sources
from tidemark.llm.neardup import near_duplicates, with_duplicate_cluster
from tidemark.llm.neighbours import nearest_neighbours
from tidemark.llm.ngramjoin import ngram_join
from tidemark.llm.packing import pack
from tidemark.llm.pii import personal_data
from tidemark.llm.repair import token_files
from tidemark.llm.repetition import (
    LINE_CHARS_LIMIT,
    LINE_COUNT_LIMIT,
    NGRAM_LIMITS,
    repetition_signals,
)
from tidemark.llm.spelling import spelling_groups
from tidemark.llm.substrings import without_repeats
from tidemark.llm.token_counts import token_counts
from tidemark.llm.toxicity import fit, toxicity_scores
from tidemark.llm.whitening import whiten


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_signals(read_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files(read_table(spark, sf_dir, "documents"), path)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return toxicity_scores(documents, fit(documents, read_table(spark, sf_dir, "labels")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    rows = with_duplicate_cluster(documents, "_duplicates", "_words", ["source"])
    return pack(rows, F.col("_words"), F.col("_duplicates"))


def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeats(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts(read_table(spark, sf_dir, "documents"), path)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_repetition": op1_repetition,
    "op2_token_files": op2_token_files,
    "op3_mixing": op3_mixing,
    "op4_neighbours": op4_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_repeated_substrings": op7_repeated_substrings,
    "op8_token_counts": op8_token_counts,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_personal_data": op10_personal_data,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_whitening": op12_whitening,
    "op13_ngram_join": op13_ngram_join,
}


def _gram_chars(n: int) -> str:
    """Word characters inside n-grams that a document holds twice or more."""
    return f"""
    (SELECT doc_id, CAST(sum(length(word)) AS BIGINT) AS chars, count(*) AS words
     FROM words JOIN (
        SELECT DISTINCT doc_id, unnest(range(pos, pos + {n})) AS pos FROM (
            SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS times
            FROM (SELECT doc_id, pos, list(word) OVER (PARTITION BY doc_id ORDER BY pos
                    ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS gram FROM words)
            WHERE len(gram) = {n}) WHERE times > 1) USING (doc_id, pos)
     GROUP BY doc_id)"""


_OP1_JOINS = "\n".join(f"LEFT JOIN {_gram_chars(n)} AS g{n} USING (doc_id)" for n in NGRAM_LIMITS)
_OP1_CHARS = ", ".join(f"coalesce(g{n}.chars, 0) AS dup_{n}gram_chars" for n in NGRAM_LIMITS)
_OP1_KEPT = " AND ".join(
    f"100 * dup_{n}gram_chars <= {share} * word_chars" for n, share in NGRAM_LIMITS.items()
)

OP1_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT doc_id, unnest(list) AS word, unnest(range(len(list))) AS pos
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS list FROM texts)),
sizes AS (
    SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars
    FROM words GROUP BY doc_id),
lines AS (
    SELECT doc_id, line, count(*) AS times,
        length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line),
line_sums AS (
    SELECT doc_id, CAST(sum(times) AS BIGINT) AS n_lines,
        CAST(sum(times - 1) AS BIGINT) AS n_dup_lines,
        CAST(sum((times - 1) * chars) AS BIGINT) AS dup_line_chars
    FROM lines GROUP BY doc_id),
measured AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(dup_line_chars, 0) AS dup_line_chars,
        coalesce(g8.words, 0) AS n_repeat_words, {_OP1_CHARS}
    FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN line_sums USING (doc_id)
    {_OP1_JOINS}),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND {_OP1_KEPT}
    AND 100 * dup_line_chars <= {LINE_CHARS_LIMIT} * word_chars
    AND 100 * n_dup_lines <= {LINE_COUNT_LIMIT} * n_lines AS kept
FROM judged
"""

OP3_SQL = """
WITH sized AS (
    SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source),
levels AS (
    SELECT *, (SELECT sum(source_size) FROM sources)
            - 3 * coalesce(sum(source_size) OVER (ahead ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ahead ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM sources WINDOW ahead AS (ORDER BY source_size / weight, source NULLS LAST)),
judged AS (SELECT *, 3 * source_size * open_weight <= rest * weight AS clamped FROM levels),
final AS (
    SELECT rest, open_weight FROM judged WHERE NOT clamped
    ORDER BY open_weight DESC LIMIT 1),
targets AS (
    SELECT source, source_size, CASE WHEN clamped THEN CAST(3 * source_size AS DOUBLE)
        ELSE CAST(weight * (SELECT rest FROM final) AS DOUBLE)
            / CAST((SELECT open_weight FROM final) AS DOUBLE) END AS target
    FROM judged),
placed AS (
    SELECT s.*, source_size, target,
        CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
        coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id NULLS FIRST, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
    SELECT *, whole + CASE WHEN target - whole * source_size > 0
        AND 2 * ahead + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS repeats
    FROM placed)
SELECT doc_id, size, source_size, target, CAST(repeats * size AS BIGINT) AS taken, source,
    CAST(repeats AS BIGINT) AS repeats
FROM taken
"""

OP11_SQL = """
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
runs AS (
    SELECT key || run AS named, run, count(*) AS times FROM (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS key,
            unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS run
        FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
    SELECT run, times, list_transform(range(1, 2 * strlen(named), 2),
        lambda i: CAST('0x' || substr(hex(encode(named)), i, 2) AS BIGINT)) AS b FROM runs),
checked AS (
    SELECT run, times, xor(list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295),
        4294967295) AS h FROM bytes, crc_table),
spelled AS (
    SELECT times, CASE WHEN h % 199 = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM checked),
words AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6
    GROUP BY word HAVING sum(times) >= 5),
shorter AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n
    FROM shorter a JOIN shorter b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT w.word, w.n, s.word, s.n FROM words w JOIN shorter s ON w.word = s.rest
    UNION SELECT s.word, s.n, w.word, w.n FROM words w JOIN shorter s ON w.word = s.rest),
ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM pairs),
forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN near_n >= 5 * words.n THEN near END AS form,
        CASE WHEN near_n >= 5 * words.n THEN near_n END AS form_n
    FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1),
chain AS (
    SELECT word, word AS stop, 0 AS steps FROM forms
    UNION ALL SELECT chain.word, forms.form, steps + 1 FROM chain JOIN forms ON chain.stop = forms.word
    WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(stop, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

OP13_SQL = """
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 2 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS gram
    FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b USING (gram) JOIN sizes s ON a.doc_id = s.doc_id
        JOIN sizes t ON b.doc_id = t.doc_id
    WHERE a.doc_id <> b.doc_id AND 100 * least(s.n, t.n) >= 90 * greatest(s.n, t.n)
    GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 190 * count(*) >= 90 * (s.n + t.n)),
reach AS (
    SELECT a, b FROM links
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
    least(doc_id, coalesce(low, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""

LLM_ORACLE_SQL: dict[str, str] = {
    "op1_repetition": OP1_SQL,
    "op3_mixing": OP3_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op13_ngram_join": OP13_SQL,
}
