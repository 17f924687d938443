"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tailwake.llm import chat, lexical, lm, packing, pieces, pii, quality, secrets, simhash, spelling, topk, toxicity, urls
from tailwake.llm.common import documents, ship


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(documents(spark, sf_dir)))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(documents(spark, sf_dir)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.digest(packing.pack_documents(documents(spark, sf_dir), tokenizer))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(documents(spark, sf_dir, "pages"), urls.rules_table(spark))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.conversation_calls(documents(spark, sf_dir, "conversations"))
    return chat.link_calls(calls, results, chat.REPLY)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digest(pieces.encode_documents(documents(spark, sf_dir), model))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


def op9_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.judge_documents(documents(spark, sf_dir)))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(spelling.variants(documents(spark, sf_dir)))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(documents(spark, sf_dir)))


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


_QUERIES = (
    op1_secret_scans,
    op2_simhash_near_dedup,
    op3_toxicity,
    op4_packing,
    op5_url_filters,
    op6_chat_formatting,
    op7_sentencepiece,
    op8_lm_scoring,
    op9_exact_top_k_search,
    op10_quality_rules,
    op11_spelling_variants,
    op12_pii,
    op13_ranked_lexical_search,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query):
        return lambda spark, sf_dir: query(ship(spark), str(sf_dir))

    return {query.__name__: shipped(query) for query in _QUERIES}


OP5_SQL = """
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting AS (
  SELECT s.page_id, s.host, s.path, r.rule_host || r.rule_path AS rule, r.rule_verdict
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rule_host OR s.host LIKE '%.' || r.rule_host) AND starts_with(s.path, r.rule_path)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
       coalesce(arg_max(rule_verdict, length(rule)), 'allow') AS verdict
FROM fitting GROUP BY page_id, host, path
"""


OP9_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS weights
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.weights, c.weights) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
  FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

OP10_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(source, '') AS host,
         coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), starts AS (
  SELECT row_id, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1),
                               lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS gram
  FROM docs WHERE len(w) > 2
), repeated AS (
  SELECT row_id, i
  FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM starts)
  WHERE n > 1
), repeat_words AS (
  SELECT row_id, count(DISTINCT i + d) AS n_repeat_words
  FROM repeated, (VALUES (0), (1), (2)) AS shifts(d) GROUP BY row_id
), all_lines AS (
  SELECT row_id, host, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM docs
), lines AS (
  SELECT *, trim(regexp_replace(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS normal
  FROM all_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup_lines AS (
  SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY row_id
), doc_lines AS (
  SELECT row_id, host, left(md5(normal), 16) AS hash,
         sum(len(string_split(normal, ' '))) AS words
  FROM lines GROUP BY row_id, host, normal
), contents AS (
  SELECT row_id, string_agg(normal, chr(10) ORDER BY place) AS content FROM lines GROUP BY row_id
), frequent AS (
  SELECT host, hash FROM doc_lines JOIN contents USING (row_id)
  GROUP BY host, hash HAVING count(DISTINCT content) > 10
), removed AS (
  SELECT row_id, sum(words) AS removed_words FROM doc_lines JOIN frequent USING (host, hash)
  GROUP BY row_id
), counted AS (
  SELECT d.row_id, doc_id, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
  FROM docs d LEFT JOIN dup_lines USING (row_id) LEFT JOIN repeat_words USING (row_id)
    LEFT JOIN removed USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT (n_words - removed_words < 0.2 * n_words) AS kept,
  removed_words
FROM counted
"""


# The named runs are hashed byte by byte with a crc32 table made by its rule; two words are near if
# they are equal once the same place is left out of both, or any place out of the longer one.
OP11_SQL = r"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) AS t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS entries FROM steps WHERE k = 8
), runs AS (
  SELECT name, run, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name,
          unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
        FROM documents)
  GROUP BY name, run
), bytes AS (
  SELECT *, flatten(list_transform(string_split(name || ':' || run, ''), lambda s:
      CASE WHEN unicode(s) < 128 THEN [CAST(unicode(s) AS BIGINT)]
           ELSE [CAST(195 AS BIGINT), unicode(s) - 64] END)) AS code
  FROM runs
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), code), lambda c, b:
      xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, crc
), vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0
          THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM hashed)
  GROUP BY word HAVING sum(n) >= 3 AND length(word) >= 5
), gaps AS (
  SELECT word, n, i, length(word) AS l, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), longer AS (
  SELECT DISTINCT g.word AS word, g.n AS n, v.word AS shorter, v.n AS shorter_n
  FROM gaps g JOIN vocabulary v ON g.rest = v.word
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n
  FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.l = b.l AND a.word <> b.word
  UNION ALL SELECT word, shorter, shorter_n FROM longer
  UNION ALL SELECT shorter, word, n FROM longer
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS best_n,
         min(near) FILTER (near_n = most) AS best
  FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)
), walk(word, place) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT w.word, f.form FROM walk w JOIN forms f ON w.place = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.place AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON f.word = w.word JOIN forms last ON last.word = w.place AND last.form IS NULL
"""


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), totals AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS size FROM docs WHERE len(terms) > 0
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term
), items AS (
  SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (SELECT i, item_id, unnest(terms) AS term FROM items) GROUP BY i, item_id, term
), sized AS (
  SELECT r, doc_id, 100 - 75 + (75 * len(terms) * t.docs) // t.size AS m FROM docs, totals t
), scored AS (
  SELECT i, item_id, s.r, s.doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sized s ON tf.r = s.r
  GROUP BY i, item_id, s.r, s.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_url_filters": OP5_SQL,
        "op9_exact_top_k_search": OP9_SQL,
        "op10_quality_rules": OP10_SQL,
        "op11_spelling_variants": OP11_SQL,
        "op13_ranked_lexical_search": OP13_SQL,
    }
