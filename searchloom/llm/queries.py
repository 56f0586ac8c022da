"""One query per operator on the driver's tables, and its SQL where SQL can express it.

Each query reads whole tables with the operator's production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from searchloom.llm import (
    bpe_automaton, filter_audit, id_files, line_dedup, merkle, minhash_dedup, ngram_join, packing, qda, quality_rules, resampling,
    substring_dedup, suffix_dedup,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), i AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM w
), s AS (
  SELECT doc_id, p, words[p] AS word,
         CASE WHEN p + 34 <= len(words) THEN array_to_string(words[p:p + 34], ' ') END AS win FROM i
), c AS (
  SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS twice FROM s
), g AS (
  SELECT *, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM c
), d AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM g GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(d.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(d.kept, '')) AS kept_sha256
FROM w LEFT JOIN d USING (doc_id)
"""

def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), s AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY p) AS nth, count(*) OVER (PARTITION BY doc_id, line) AS times FROM l
), r AS (
  SELECT *, length(array_to_string(words, '')) AS chars, len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
         len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) AS lettered,
         len(regexp_extract_all(line, '[\x20\x09-\x0D](?:[|>•·»]|-{1,2}>?)[\x20\x09-\x0D]')) AS parts,
         regexp_matches(line, '(?i)all rights reserved|cookie|privacy policy|terms of (?:use|service)|subscribe|newsletter|click here|sign (?:in|up)|log ?in|javascript|lorem ipsum') AS boilerplate
  FROM s
), b AS (
  SELECT *, len(words) > 0 AND (4 * symbols >= chars OR 2 * lettered < len(words) OR parts >= 2 OR boilerplate
         OR (times > 1 AND len(words) <= 3 AND right(words[-1], 1) NOT IN ('.', '!', '?', ':', ';'))) AS bad FROM r
), d AS (
  SELECT doc_id, sum(len(words)) AS n_words, sum(chars) AS word_chars, sum(symbols) AS n_symbols,
         count(*) FILTER (WHERE nth > 1 AND len(words) > 0) AS n_dup_lines, count(*) FILTER (WHERE bad) AS n_bad_lines,
         coalesce(sum(chars) FILTER (WHERE NOT bad), 0) AS kept_chars FROM b GROUP BY doc_id
), w AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)
), t AS (
  SELECT doc_id, p, CASE WHEN p + 2 <= len(words) THEN array_to_string(words[p:p + 2], ' ') END AS win FROM w
), c AS (
  SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS twice FROM t
), g AS (
  SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS repeated FROM c
), e AS (
  SELECT doc_id, count(*) FILTER (WHERE repeated) AS n FROM g GROUP BY doc_id
), f AS (
  SELECT d.*, coalesce(e.n, 0) AS n_repeat_words, d.n_words < 50 OR 100 * coalesce(e.n, 0) > 50 * d.n_words AS base_failed
  FROM d LEFT JOIN e USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       CAST(n_bad_lines AS BIGINT) AS n_bad_lines, CAST(kept_chars AS BIGINT) AS kept_chars, base_failed,
       NOT base_failed AND 2 * kept_chars >= word_chars AS kept
FROM f
"""


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ') ELSE array_to_string(words[p:p + 3], ' ') END AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS p FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT r.a AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.digest(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), often AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), m AS (
  SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.digest(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH b AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS steps
), d AS (
  SELECT doc_id AS id, true AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT item_id, false, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), f AS (
  SELECT id, source, unnest(words) AS feature FROM d
  UNION ALL
  SELECT id, source, unnest(list_transform(range(1, len(words)), lambda p: words[p] || ' ' || words[p + 1])) FROM d
), u AS (
  SELECT id, source, feature, count(*) AS n FROM f GROUP BY ALL
), h AS (
  SELECT feature, xor(list_reduce(list_transform(range(length(hex(encode(feature))) // 2),
             lambda p: CAST('0x' || hex(encode(feature))[2 * p + 1:2 * p + 2] AS BIGINT)),
             lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM u), b
), c AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE source), 0) AS s, coalesce(sum(n) FILTER (WHERE NOT source), 0) AS t
  FROM u JOIN h USING (feature) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain FROM c
), m AS (
  SELECT id, sum(n) AS n, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS mean
  FROM u JOIN h USING (feature) JOIN g USING (bucket) WHERE source GROUP BY id
), w AS (
  SELECT id AS doc_id, len(words) >= 20 AS able, coalesce(m.n, 0) AS n_features, coalesce(mean, 0) AS weight,
         CAST('0x' || sha256('7:' || id)[1:8] AS BIGINT) AS h
  FROM d LEFT JOIN m USING (id) WHERE source
), v AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM w
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM v WHERE able
)
SELECT v.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN 100 * rank <= 25 * total THEN rank END AS rank
FROM v LEFT JOIN r USING (doc_id)
"""


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.digest(table(spark, sf_dir, "documents"))


OP12_SQL = f"""
SELECT *, doc_id = component_id AS kept FROM ({OP3_SQL.replace("len(words) < 4", "len(words) < 5").replace("words[p:p + 3]", "words[p:p + 4]").replace("len(words) - 3", "len(words) - 4")})
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), f AS (
  SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) IS TRUE AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) IS TRUE AS toxic FROM t
), g AS (
  SELECT part, good, toxic, concat(if(a, 'A', ''), if(b, 'B', ''), if(c, 'C', ''), if(d, 'D', ''), if(e, 'E', '')) AS fails, count(*) AS n
  FROM f GROUP BY ALL
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT concat(p.x, q.x, r.x, s.x, t.x) AS filter_order FROM l p, l q, l r, l s, l t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), u AS (
  SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o)
), v AS (
  SELECT part, filter_order, step, letter, n, good, toxic, length(fails) AS k, contains(fails, letter) AS mine,
         length(translate(fails, earlier, '')) < length(fails) AS gone FROM g, u
), w AS (
  SELECT part, filter_order, step, letter, sum(n) FILTER (WHERE NOT gone AND NOT mine) AS kept, sum(n) FILTER (WHERE mine AND NOT gone) AS removed,
         sum(n) FILTER (WHERE mine AND gone) AS redundant, sum(n) FILTER (WHERE mine AND k = 1) AS unique_fails,
         sum(n) FILTER (WHERE mine AND NOT gone AND good) AS good_lost, sum(n) FILTER (WHERE mine AND NOT gone AND toxic) AS toxic_lost
  FROM v GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM w
"""


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_ngram_join": op3_ngram_join,
    "op4_packing": op4_packing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_id_files": op6_id_files,
    "op7_line_dedup": op7_line_dedup,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_quality_rules": OP2_SQL,
    "op3_ngram_join": OP3_SQL,
    "op7_line_dedup": OP7_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_minhash_dedup": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
