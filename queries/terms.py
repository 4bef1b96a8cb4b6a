"""Queries with a dictionary: the three-word phrases and long words of all conversations, sought in all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.redaction import ASCII_PATTERNS, MERGED_SQL, REDACTED_SQL, documents, hits_sql
from queries.registry import query
from queries.tables import load, spread
from reportloom.fixed_values import PII_PATTERNS
from reportloom.operators import redaction as R
from reportloom.operators.terms import redact_terms

WORDS = r"[\p{L}\p{N}_]+"
LONG_WORD = 9


def dictionary(spark, sf_dir):
    """(term, label)"""
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORDS), F.lit(0))
    said = spread(load(spark, sf_dir, "conversations").select("text")).select(words.alias("w"))
    triples = F.when(F.size("w") > 2, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
    phrases = said.select(F.explode(triples).alias("term"), F.lit("PHRASE").alias("label"))
    long_words = said.select(F.explode("w").alias("term"), F.lit("TERM").alias("label")).filter(F.length("term") >= LONG_WORD)
    return phrases.union(long_words).distinct()


TERMS_SQL = rf"""said AS (SELECT regexp_extract_all(lower(text), '{WORDS.replace("{", "{{").replace("}", "}}")}') AS w FROM {{conversations}}),
dictionary AS (SELECT DISTINCT unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) AS gram, 'PHRASE' AS label FROM said
               UNION SELECT gram, 'TERM' FROM (SELECT unnest(w) AS gram FROM said) WHERE length(gram) >= {LONG_WORD}),
parts AS (SELECT doc_id, string_split(regexp_replace(text, '({WORDS.replace("{", "{{").replace("}", "}}")})', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS p FROM {{documents}}),
pieces_of AS (SELECT doc_id, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS i FROM parts),
placed AS (SELECT doc_id, i, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM pieces_of),
in_text AS (SELECT doc_id, CAST(e - length(piece) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, lower(piece) AS w, i FROM placed WHERE i % 2 = 0),
runs AS (SELECT doc_id, s, e, w, lead(e, 2) OVER seen AS e3,
                w || ' ' || lead(w, 1) OVER seen || ' ' || lead(w, 2) OVER seen AS w3
         FROM in_text WINDOW seen AS (PARTITION BY doc_id ORDER BY i)),
grams AS (SELECT doc_id, s, e, w AS gram FROM runs UNION ALL SELECT doc_id, s, e3, w3 FROM runs WHERE w3 IS NOT NULL),
term_hits AS (SELECT doc_id, s, max(e) AS e, arg_max(label, e) AS label FROM grams JOIN dictionary USING (gram) GROUP BY doc_id, s),
term_found AS (SELECT t.doc_id, {len(PII_PATTERNS)} AS ord, t.label, s, e, substring(d.text, s + 1, e - s) AS original
               FROM term_hits t JOIN {{documents}} d ON d.doc_id = t.doc_id)"""

BOTH_SQL = f"""WITH {hits_sql(ASCII_PATTERNS).replace("found AS", "pattern_found AS")}, {TERMS_SQL},
found AS (SELECT doc_id, ord, label, s, e, original FROM pattern_found UNION ALL SELECT doc_id, ord, label, s, e, original FROM term_found),
{MERGED_SQL}"""


@query("terms_redacted", f"{BOTH_SQL}{REDACTED_SQL} SELECT doc_id, redacted FROM redacted")
def terms_redacted(spark, sf_dir):
    return redact_terms(documents(spark, sf_dir), dictionary(spark, sf_dir)).select("doc_id", "redacted")


@query("term_spans", f"{BOTH_SQL} SELECT doc_id, label, s AS span_start, e AS span_end, original FROM merged")
def term_spans(spark, sf_dir):
    return R.span_rows(redact_terms(documents(spark, sf_dir), dictionary(spark, sf_dir)), "doc_id")
