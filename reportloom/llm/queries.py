"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import binary_codes, fertility, mixing, packing, piece_table, preference, rank_order, secrets, simhash, token_automaton, variants, warc, wfst
from reportloom.llm.storage import documents, public_vocabulary, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Fixed values of the queries' contracts.
END_ID = 1
HELD_OUT = 1
FOLDS = 3
MIX_EXPONENT = 0.7


def query(name: str, sql: str | None = None) -> Callable:
    def add(make: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = make
        if sql is not None:
            SQL[name] = sql
        return make

    return add


@query("op1_packed_token_files")
def op1_packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.round_trip(documents(spark, sf_dir), public_vocabulary("word_bpe_49k.json"), END_ID)


# Every conversation against itself with the last answer of the next one, turn by turn.
PREFERENCE_SQL = """
WITH turns AS (SELECT conv_id, turn, replace(coalesce(role, ''), '<|im_', '< |im_') AS role, replace(coalesce(text, ''), '<|im_', '< |im_') AS text FROM conversations),
answers AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS place
            FROM turns WHERE role = 'assistant'),
last_answers AS (SELECT * FROM answers WHERE place = 1),
others AS (
  SELECT t.conv_id, t.turn, t.role, CASE WHEN l.turn IS NOT NULL THEN o.text ELSE t.text END AS text,
         l.turn IS NOT NULL AND o.conv_id IS NULL AS gone
  FROM turns t LEFT JOIN last_answers l ON l.conv_id = t.conv_id AND l.turn = t.turn AND t.role = 'assistant'
  LEFT JOIN last_answers o ON o.conv_id = t.conv_id + 1),
sides AS (
  SELECT 'c' AS side, conv_id, turn, role, text FROM turns
  UNION ALL SELECT 'r', conv_id, turn, role, text FROM others WHERE NOT gone),
placed AS (SELECT *, row_number() OVER (PARTITION BY side, conv_id ORDER BY turn, role, text) AS place FROM sides),
equal AS (
  SELECT conv_id, place, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same
  FROM placed GROUP BY conv_id, place),
common AS (SELECT conv_id, coalesce(min(place) FILTER (WHERE NOT same) - 1, max(place)) AS n FROM equal GROUP BY conv_id),
shown AS (
  SELECT p.conv_id, p.side, p.place, c.n, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown,
         length(role) + 13 || ':0,' || (length(text) + 11) || CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END AS run
  FROM placed p JOIN common c ON c.conv_id = p.conv_id)
SELECT conv_id, max(n) AS n_common,
       coalesce(string_agg(shown, '' ORDER BY place) FILTER (WHERE side = 'c' AND place <= n), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY place) FILTER (WHERE side = 'c' AND place > n), '') AS chosen,
       coalesce(string_agg(run, ',' ORDER BY place) FILTER (WHERE side = 'c' AND place > n), '') AS chosen_mask,
       coalesce(string_agg(shown, '' ORDER BY place) FILTER (WHERE side = 'r' AND place > n), '') AS rejected,
       coalesce(string_agg(run, ',' ORDER BY place) FILTER (WHERE side = 'r' AND place > n), '') AS rejected_mask,
       count(*) FILTER (WHERE side = 'c' AND place > n) > 0 AND count(*) FILTER (WHERE side = 'r' AND place > n) > 0 AS has_preference
FROM shown GROUP BY conv_id
"""


@query("op2_preference_pairs", PREFERENCE_SQL)
def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preference.with_other_answer(table(spark, sf_dir, "conversations"))
    return preference.preference_rows(chosen, rejected).withColumnRenamed("pair_id", "conv_id")


@query("op3_pfair_mix")
def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return mixing.schedule(docs, mixing.tempered(mixing.source_sizes(docs), MIX_EXPONENT))


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in word)


_BLANK = "\\x20"
_KEYS = "|".join([*map(_either, ["password", "passwd", "secret", "token"]), _either("api") + "_?" + _either("key")])
SECRET_PATTERNS = {
    "assign": f"""({_KEYS})["'']?{_BLANK}*[:=]{_BLANK}*["'']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+",
    "github": "gh[pousr]_[A-Za-z0-9]{36}", "npm": "npm_[A-Za-z0-9]{36}", "age": "AGE-SECRET-KEY-1[A-Z0-9]{58}",
}
_CRC = """xor(list_reduce(list_transform(range(30), lambda i: CAST(ascii(substr(split_part(hit, '_', 2), CAST(i + 1 AS bigint), 1)) AS bigint)),
  lambda crc, byte: list_reduce(range(8), lambda a, j: CASE WHEN a % 2 = 1 THEN xor(a >> 1, CAST(3988292384 AS bigint)) ELSE a >> 1 END, xor(crc, byte)),
  CAST(4294967295 AS bigint)), CAST(4294967295 AS bigint))"""
_BASE62 = f"""list_reduce(range(6), lambda a, i: a * 62 + instr('{secrets.BASE62}', substr(hit, CAST(35 + i AS bigint), 1)) - 1, CAST(0 AS bigint))"""
_POLYMOD = "xor((c & 33554431) << 5, v)"
for _i, _step in enumerate(secrets.BECH32_STEPS):
    _POLYMOD = f"xor({_POLYMOD}, CASE WHEN (c >> {25 + _i}) % 2 = 1 THEN CAST({_step} AS bigint) ELSE CAST(0 AS bigint) END)"
_PREFIX = [ord(c) >> 5 for c in "age-secret-key-"] + [0] + [ord(c) & 31 for c in "age-secret-key-"]
_BECH32 = f"""regexp_full_match(lower(substr(hit, 17)), '[{secrets.BECH32}]+') AND list_reduce(list_concat(CAST({_PREFIX} AS bigint[]),
  list_transform(range(58), lambda i: CAST(instr('{secrets.BECH32}', lower(substr(hit, CAST(17 + i AS bigint), 1))) - 1 AS bigint))), lambda c, v: {_POLYMOD}, CAST(1 AS bigint)) = 1"""
SECRET_FITS = {
    "assign": f"length(regexp_extract(hit, '{SECRET_PATTERNS['assign']}', 2)) >= 6", "access": "length(hit) >= 20", "hex": "length(hit) >= 24",
    "github": f"NOT regexp_matches(following, '^[A-Za-z0-9]') AND {_CRC} = {_BASE62}", "npm": f"NOT regexp_matches(following, '^[A-Za-z0-9]') AND {_CRC} = {_BASE62}",
    "age": f"NOT regexp_matches(following, '^[A-Z0-9]') AND {_BECH32}",
}


def _spans_sql(place: int, kind: str) -> str:
    """Places of the matches: the lengths of what stands between them and of the matches before."""
    pattern = SECRET_PATTERNS[kind]
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, first, first + length(hit) AS past FROM (
  SELECT *, substr(text, CAST(first + length(hit) + 1 AS bigint), 1) AS following FROM (
  SELECT doc_id, text, hits[i] AS hit,
         list_sum(list_transform(pieces[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS first
  FROM (SELECT doc_id, text, hits, pieces, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS pieces
              FROM documents WHERE regexp_matches(text, '{pattern if kind != 'hex' else '[0-9a-f]{24}'}')))))
WHERE {SECRET_FITS[kind]}"""


_SPAN = "kind || ':' || first || ':' || past"
SECRETS_SQL = f"""
WITH spans AS ({' UNION ALL '.join(_spans_sql(i, k) for i, k in enumerate(SECRET_PATTERNS))}),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg({_SPAN}, ',' ORDER BY first, place) FILTER (place < 3) AS base, string_agg({_SPAN}, ',' ORDER BY first, place) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id
"""


@query("op4_secret_spans", SECRETS_SQL)
def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(secrets.BASE_KINDS))
    return found.select("doc_id", *[_of_kind(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
                        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def _of_kind(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


@query("op5_sentencepiece_ids")
def op5_sentencepiece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.encoded(documents(spark, sf_dir), public_vocabulary("piece_bpe_32k.model"))


@query("op6_simhash_near_duplicates")
def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)


@query("op7_tokeniser_fertility")
def op7_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fertility.rated(documents(spark, sf_dir), public_vocabulary("piece_bpe_32k.model"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*first, "n_tokens", *fertility.MEASURES)


# SHA-1 in base 32: five hex digits are four symbols.
WARC_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
newest AS (SELECT html, max(page_id) AS newest FROM payloads GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS bigint) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + (CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS bigint), 5) AS bigint) >> CAST(5 * (3 - i % 4) AS bigint)) % 32 AS bigint), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM payloads p JOIN newest n ON n.html = p.html
"""


@query("op8_warc_members", WARC_SQL)
def op8_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op9_rank_order_language")
def op9_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT
    docs = documents(spark, sf_dir)
    profiles = rank_order.learn(docs.where(~F.coalesce(held_out, F.lit(False))))
    return rank_order.predict(docs, profiles).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


COSINES_SQL = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, list_transform(embedding, lambda x: CAST(x AS double)) AS v FROM embeddings),
good AS (SELECT i, vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM given
         WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.i, b.i AS j FROM good a JOIN good b ON a.i <> b.i AND len(a.v) = len(b.v)
          WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) / (a.norm * b.norm) >= CAST(0.95 AS double)),
reached(i, j) AS (SELECT i, i FROM given UNION SELECT r.i, l.j FROM reached r JOIN links l ON l.i = r.j),
least AS (SELECT r.i, min(g.vec_id) AS component_id FROM reached r JOIN given g ON g.i = r.j GROUP BY r.i),
counts AS (SELECT i, count(*) AS n FROM links GROUP BY i)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM given JOIN least USING (i) LEFT JOIN counts USING (i)
"""


@query("op10_rotated_binary_codes", COSINES_SQL)
def op10_rotated_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_codes.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query("op11_token_automaton_counts")
def op11_token_automaton_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_automaton.token_counts(documents(spark, sf_dir), public_vocabulary("byte_bpe_50k.json"), limit=512)


# CRC-32 by a table made from its polynomial, byte by byte over the hex digits of the key's UTF-8.
VARIANTS_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, CAST(3988292384 AS bigint)) ELSE a >> 1 END,
    CAST(b AS bigint))) AS steps),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT coalesce(CAST(doc_id AS varchar), '') AS doc_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]{7,}')) AS run FROM documents)
  GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, xor(list_reduce(
    list_transform(range(strlen(doc_id || ':' || run)), lambda i: CAST('0x' || substr(hex(encode(doc_id || ':' || run)), CAST(2 * i + 1 AS bigint), 2) AS bigint)),
    lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]), CAST(4294967295 AS bigint)), CAST(4294967295 AS bigint)) AS h
  FROM runs, crc_table),
typed AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS bigint) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT DISTINCT word, substr(word, 1, i - 1) || substr(word, i + 1) AS shorter FROM cuts),
masked AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM cuts),
pairs AS (
  SELECT a.word, b.word AS near FROM masked a JOIN masked b ON a.i = b.i AND a.a = b.a AND a.b = b.b AND a.word <> b.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON w.word = l.shorter
  UNION SELECT w.word, l.word FROM less l JOIN words w ON w.word = l.shorter),
ranked AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
  FROM pairs p JOIN words w ON w.word = p.near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
followed(word, reached) AS (
  SELECT word, word FROM formed UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.reached WHERE g.form IS NOT NULL),
ends AS (SELECT f.word, f.reached AS root FROM followed f JOIN formed g ON g.word = f.reached WHERE g.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


@query("op12_spelling_variants", VARIANTS_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.word_counts(documents(spark, sf_dir), least_chars=7, least_count=2, every=31), ratio=10)


# Lines end behind a line break or at the end of the text; what stands before a line is the lines before it.
FIM_SQL = """
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || coalesce(CAST(doc_id AS varchar), '')) AS hex FROM documents),
drawn AS (
  SELECT *, len(lines) AS n, list_transform([0, 1, 2, 3], lambda i: CAST('0x' || substr(hex, CAST(1 + 8 * i AS bigint), 8) AS bigint)) AS h FROM given),
formed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(lines[1:low], '') AS prefix, array_to_string(lines[low + 1:high], '') AS middle, array_to_string(lines[high + 1:], '') AS suffix FROM formed)
SELECT doc_id, CAST(n AS bigint) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_fill_in_middle", FIM_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = piece_table.fill_in_middle(documents(spark, sf_dir), seed=7, rate=100, spm_rate=50)
    return piece_table.restored(done).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
