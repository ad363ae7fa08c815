"""Registered queries of the corpus operators, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from tagloom.llm import alignment, bpe, decontaminate, jaccard, licenses, lm, quality, shards, simhash, substrings, token_counts, token_files, whitening
from tagloom.llm.common import table


def _tokenizer(name: str) -> str:
    return public_tokenizers.path(name)


def op1(spark, sf_dir) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op2(spark, sf_dir) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"), licenses.templates(spark))


def op3(spark, sf_dir) -> DataFrame:
    return token_counts.prefix_counts(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op4(spark, sf_dir) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5(spark, sf_dir) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"))


def op6(spark, sf_dir) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7(spark, sf_dir) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8(spark, sf_dir) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


def op9(spark, sf_dir) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op10(spark, sf_dir) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op11(spark, sf_dir) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op12(spark, sf_dir) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13(spark, sf_dir) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1,
    "op2_license_scan": op2,
    "op3_token_counts": op3,
    "op4_bpe": op4,
    "op5_shards": op5,
    "op6_simhash": op6,
    "op7_decontaminate": op7,
    "op8_repeated_passages": op8,
    "op9_token_files": op9,
    "op10_lm_scores": op10,
    "op11_alignment": op11,
    "op12_whitening": op12,
    "op13_ngram_jaccard": op13,
}

_W = r"[^\x20\x09-\x0D]+"
_A = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_W}') AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 4] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '{_W}') GROUP BY doc_id),
base AS (SELECT d.doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
                coalesce(rep.n, 0)::BIGINT AS n_repeat_words
         FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT)::BIGINT AS k FROM r WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT sum(k) / sum(n) AS m, sum(n)::DOUBLE AS n, sum(k * k / n) / sum(n) AS kk, count(*) AS hosts FROM h),
v AS (SELECT *, kk - m * m - m * (1 - m) * (hosts - 1) / n AS spread FROM s),
p AS (SELECT m, least(CASE WHEN spread > 1e-12 THEN greatest(m * (1 - m) / spread - 1, 1.0) ELSE n END, n) AS st FROM v),
hv AS (SELECT source, n AS host_docs, k AS host_fails, round((k + m * st) / (n + st), 6) AS host_rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_rate > 0.8, false) AS kept, host_docs, host_fails, host_rate
FROM r LEFT JOIN hv USING (source)""",
    "op7_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_A}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '{_A}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS x
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
spans AS (SELECT DISTINCT len(x) AS n FROM win),
runs AS (SELECT doc_id, i, n, w[i:i + n - 1] AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, spans WHERE len(w) >= n)),
found AS (SELECT DISTINCT doc_id, i, n, item_id FROM runs JOIN win USING (x)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
