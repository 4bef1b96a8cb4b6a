"""Personal-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.registry import query
from queries.tables import NOTES, load, spread, table
from reportloom.fixed_values import PII_PATTERNS
from reportloom.functions.markup import ENTITIES, HTML_RULES, SPACE_RULES, html_to_text
from reportloom.functions.pii import DEFAULT_PATTERNS, STRICT_PATTERNS, Pattern, find_spans, with_user_patterns
from reportloom.functions.text import WHITESPACE, utf8_dropping_bad_bytes, words
from reportloom.operators import redaction as R
from reportloom.session import fresh_folder
from reportloom.streaming.redaction import count_labels_stream, read_label_counts, redact_stream
from reportloom.streaming.versions import read_latest, redact_latest_stream

BY_LABEL = {p.label: p for p in DEFAULT_PATTERNS}


def documents(spark, sf_dir):
    return spread(load(spark, sf_dir, "documents").select("doc_id", "text"))


def notes(spark, sf_dir):
    return table(spark, sf_dir, NOTES)


def braces(sql: str) -> str:
    return sql.replace("{", "{{").replace("}", "}}")


# ---- standard SQL for spans in the given documents -------------------------------------------
# The given texts hold no Cyrillic letters, so only these patterns can match in them.
ASCII_LABELS = ["EMAIL", "PHONE", "DATE", "SNILS"]
REGEX = dict(PII_PATTERNS)


def hits_sql(patterns: list[tuple[int, str, str]]) -> str:
    marked = " UNION ALL ".join(
        f"SELECT doc_id, {order} AS ord, '{label}' AS label, string_split(regexp_replace(text, '({braces(regex)})', "
        f"chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS parts FROM {{documents}}"
        for order, label, regex in patterns
    )
    return f"""marked AS ({marked}),
numbered AS (SELECT *, unnest(range(1, len(parts) // 2 + 1)) AS i FROM marked),
hits AS (SELECT doc_id, ord, label, length(array_to_string(parts[1:2*i-1], '')) - CAST(0 AS BIGINT) AS s_raw, parts[2*i] AS original,
                length(array_to_string(list_transform(range(1, i + 1), lambda x: parts[2*x-1]), '')) +
                length(array_to_string(list_transform(range(1, i), lambda x: parts[2*x]), '')) AS s FROM numbered),
found AS (SELECT doc_id, ord, label, s, s + length(original) AS e, original FROM hits)"""


MERGED_SQL = """
swept AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM found),
islands AS (SELECT *, sum(CASE WHEN before IS NULL OR s >= before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s, ord) AS island FROM swept),
merged AS (SELECT doc_id, min(s) AS s, max(e) AS e, arg_min(label, s * 100 + ord) AS label,
                  string_agg(CASE WHEN before IS NULL OR s >= before OR e > before THEN original END, '|' ORDER BY s, ord) AS original
           FROM islands GROUP BY doc_id, island)"""
ASCII_PATTERNS = [(i, label, regex) for i, (label, regex) in enumerate(PII_PATTERNS) if label in ASCII_LABELS]
DOC_SPANS = f"WITH {hits_sql(ASCII_PATTERNS)}, {MERGED_SQL}"
TOKENS_SQL = "CASE label WHEN 'SNILS' THEN '[ID]' ELSE '[' || label || ']' END"
REDACTED_SQL = f""", cuts AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS prev FROM merged),
pieces AS (SELECT c.doc_id, string_agg(substring(d.text, prev + 1, s - prev) || {TOKENS_SQL}, '' ORDER BY s) AS head, max(e) AS tail
           FROM cuts c JOIN {{documents}} d ON d.doc_id = c.doc_id GROUP BY c.doc_id),
redacted AS (SELECT d.doc_id, CASE WHEN p.head IS NULL THEN d.text ELSE p.head || substring(d.text, p.tail + 1) END AS redacted
             FROM {{documents}} d LEFT JOIN pieces p ON p.doc_id = d.doc_id)"""


@query("label_counts", f"{DOC_SPANS} SELECT label, count(*) AS n FROM merged GROUP BY label")
def label_counts(spark, sf_dir):
    return R.counts_by_label(R.redact(documents(spark, sf_dir)).select("spans"))


@query("label_counts_per_text", f"{DOC_SPANS} SELECT doc_id, label, count(*) AS n FROM merged GROUP BY doc_id, label")
def label_counts_per_text(spark, sf_dir):
    return R.counts_per_text(R.redact(documents(spark, sf_dir)), key="doc_id")


@query("spans_found", f"WITH {hits_sql(ASCII_PATTERNS)} SELECT doc_id, label, s AS span_start, e AS span_end, original FROM found")
def spans_found(spark, sf_dir):
    return R.span_rows(documents(spark, sf_dir).withColumn("spans", find_spans(F.col("text"))), "doc_id")


@query("spans_merged", f"{DOC_SPANS} SELECT doc_id, label, s AS span_start, e AS span_end, original FROM merged")
def spans_merged(spark, sf_dir):
    return R.span_rows(R.redact(documents(spark, sf_dir)), "doc_id")


@query("texts_redacted", f"{DOC_SPANS}{REDACTED_SQL} SELECT doc_id, redacted FROM redacted")
def texts_redacted(spark, sf_dir):
    return R.redact(documents(spark, sf_dir)).select("doc_id", "redacted")


@query("redaction_totals", f"{DOC_SPANS} SELECT (SELECT count(*) FROM {{documents}}) AS files_processed, count(*) AS total_replacements FROM merged")
def redaction_totals(spark, sf_dir):
    return R.totals(R.redact(documents(spark, sf_dir)))


USER_PATTERN = ("SECRET", r"token\s*=\s*\S+")
USER_HITS = hits_sql([*ASCII_PATTERNS, (len(PII_PATTERNS), "SECRET", "(?i:" + r"token\s*=\s*\S+" + ")")])


@query("user_patterns", f"WITH {USER_HITS}, {MERGED_SQL}{REDACTED_SQL} SELECT doc_id, redacted FROM redacted")
def user_patterns(spark, sf_dir):
    stage = R.RegexStage(with_user_patterns([USER_PATTERN]))
    return R.redact(documents(spark, sf_dir), stage).select("doc_id", "redacted")


# ---- one query per pattern, on texts whose spans follow from the lengths of their parts ---------
def pattern_query(label: str, text: str, before: str, hit: str) -> None:
    sql = f"""SELECT report_id, length({before}) AS span_start, length({before}) + length({hit}) AS span_end, {hit} AS original
FROM ({NOTES}) n"""

    @query(f"pattern_{label.lower()}", sql)
    def run(spark, sf_dir):
        found = notes(spark, sf_dir).withColumn("spans", find_spans(F.col(text), [BY_LABEL[label]]))
        return R.span_rows(found, "report_id").drop("label")


_TO_DOB = "concat(part0, email, '; ', phone, '; ')"
pattern_query("EMAIL", "text", "part0", "email")
pattern_query("PHONE", "text", "concat(part0, email, '; ')", "phone")
pattern_query("DATE", "text", "concat(part0, email, '; ', phone, '; Дата рождения: ')", "dob")
pattern_query("DOB", "text", _TO_DOB, "concat('Дата рождения: ', dob)")
pattern_query("ADDRESS", "text", "concat(part0, email, '; ', phone, '; Дата рождения: ', dob, '; ')", "address")
pattern_query("NAME", "long_text", "'Врач '", "person")
pattern_query("POLICY", "long_text", "concat('Врач ', person, 'Осмотр; ')", "policy")
pattern_query("SNILS", "long_text", "concat('Врач ', person, 'Осмотр; ', policy, '; ')", "snils")
pattern_query("ORG", "long_text", "concat('Врач ', person, 'Осмотр; ', policy, '; ', snils, '; ')", "org")
pattern_query("LOCATION", "long_text", "concat('Врач ', person, 'Осмотр; ', policy, '; ', snils, '; ', org, '; ')", "place")


@query("notes_redacted", f"SELECT report_id, 'Пациент № [EMAIL]; [PHONE]; [DATE]; [ADDRESS]; конец' AS redacted, CAST(4 AS BIGINT) AS n FROM ({NOTES}) n")
def notes_redacted(spark, sf_dir):
    return R.redact(notes(spark, sf_dir)).select("report_id", "redacted", F.size("spans").alias("n"))


@query("name_at_word_end", f"SELECT report_id, concat(part0, '[NAME] ', email) AS redacted FROM ({NOTES}) n")
def name_at_word_end(spark, sf_dir):
    texts = notes(spark, sf_dir).select("report_id", F.concat("part0", "person", F.lit(" "), "email").alias("text"))
    stage = R.RegexStage([p for p in STRICT_PATTERNS if p.label == "NAME"])
    return R.redact(texts, stage).select("report_id", "redacted")


@query("unknown_label_token", f"SELECT report_id, concat(part0, '[MAIL]; ', phone) AS redacted FROM ({NOTES}) n")
def unknown_label_token(spark, sf_dir):
    texts = notes(spark, sf_dir).select("report_id", F.concat("part0", "email", F.lit("; "), "phone").alias("text"))
    return R.redact(texts, R.RegexStage([Pattern("MAIL", BY_LABEL["EMAIL"].regex)])).select("report_id", "redacted")


@query("stages_chained", f"""
SELECT report_id, CAST(0 AS BIGINT) AS stage, 'EMAIL' AS label, length(part0) AS span_start, length(part0) + length(email) AS span_end, email AS original FROM ({NOTES}) n
UNION ALL
SELECT report_id, CAST(1 AS BIGINT), 'PHONE', length(part0) + length('[EMAIL]; '), length(part0) + length('[EMAIL]; ') + length(phone), phone FROM ({NOTES}) n""")
def stages_chained(spark, sf_dir):
    stages = [R.RegexStage([BY_LABEL["EMAIL"]]), R.RegexStage([BY_LABEL["PHONE"]])]
    staged = R.redact_in_stages(notes(spark, sf_dir), stages).select("report_id", F.explode_outer("spans").alias("x")).dropna()
    return staged.select("report_id", "x.stage", "x.label", F.col("x.start").alias("span_start"), F.col("x.end").alias("span_end"), "x.original")


# ---- chunks and model responses ------------------------------------------------------------
CHUNKS_SQL = """SELECT doc_id, i AS chunk_no, i * 750 AS chunk_start, substring(text, i * 750 + 1, 750) AS chunk
FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 749) // 750)) AS i FROM {documents})"""


@query("text_chunks", CHUNKS_SQL)
def text_chunks(spark, sf_dir):
    return R.chunks(documents(spark, sf_dir), key="doc_id")


@query("chunk_requests", f"SELECT doc_id, chunk_no, md5(replace('{braces(R.REDACTION_REQUEST.format(chunk='@@'))}', '@@', chunk)) AS prompt_md5 FROM ({CHUNKS_SQL})")
def chunk_requests(spark, sf_dir):
    asked = R.redaction_requests(R.chunks(documents(spark, sf_dir), key="doc_id"))
    return asked.select("doc_id", "chunk_no", F.md5("prompt").alias("prompt_md5"))


CHUNK_ANSWERS = """SELECT doc_id, 1 AS chunk_no,
       CASE lang WHEN 'en' THEN concat('```json', chr(10), '{{"text": "D', cast(doc_id AS string), '", "spans": [{{"start": 1, "end": 3, "label": "NAME", "text": "x"}}]}}', chr(10), '```')
                 WHEN 'de' THEN '{{"spans": [{{"start": 0, "end": 1, "label": "DATE", "text": "y"}}]}}'
                 WHEN 'fr' THEN ' not JSON ' ELSE NULL END AS content
FROM {documents}"""


@query("chunk_responses_applied", f"""
WITH chunks AS ({CHUNKS_SQL}), texts AS (
SELECT c.doc_id, c.chunk_no, CASE WHEN c.chunk_no <> 1 THEN chunk WHEN lang = 'en' THEN concat('D', cast(c.doc_id AS string))
                 WHEN lang = 'fr' THEN 'not JSON' ELSE chunk END AS text,
       CASE WHEN c.chunk_no = 1 AND lang = 'en' THEN 'NAME@751-753:x' WHEN c.chunk_no = 1 AND lang = 'de' THEN 'DATE@750-751:y' END AS span
FROM chunks c JOIN {{documents}} d ON d.doc_id = c.doc_id)
SELECT doc_id, string_agg(text, '' ORDER BY chunk_no) AS redacted, coalesce(string_agg(span, ',' ORDER BY chunk_no), '') AS spans
FROM texts GROUP BY doc_id""")
def chunk_responses_applied(spark, sf_dir):
    whole = R.apply_chunk_responses(documents(spark, sf_dir), table(spark, sf_dir, CHUNK_ANSWERS), key="doc_id")
    shown = F.transform("spans", lambda s: F.format_string("%s@%d-%d:%s", s["label"], s["start"], s["end"], s["original"]))
    return whole.select("doc_id", "redacted", F.array_join(shown, ",").alias("spans"))


# ---- markup, bytes, words --------------------------------------------------------------------
def _sql_chain(text: str) -> str:
    for pattern, new in HTML_RULES:
        text = f"regexp_replace({text}, '{braces(pattern)}', '{new}', 'g')"
    for name, char in ENTITIES:
        text = "replace({}, '{}', '{}')".format(text, name, char.replace("'", "''"))
    text = f"replace({text}, '&amp;', '&')"
    for pattern, new in SPACE_RULES:
        text = f"regexp_replace({text}, '{braces(pattern)}', '{new}', 'g')"
    return f"trim({text}, '{WHITESPACE}')"


@query("pages_to_text", f"SELECT page_id, {_sql_chain('html')} AS text FROM {{pages}}")
def pages_to_text(spark, sf_dir):
    return spread(load(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", html_to_text(F.col("html")).alias("text"))


@query("bad_bytes_dropped", "SELECT doc_id, text FROM {documents}")
def bad_bytes_dropped(spark, sf_dir):
    bad = F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"), F.unhex(F.lit("C3")))
    return documents(spark, sf_dir).select("doc_id", utf8_dropping_bad_bytes(bad).alias("text"))


@query("word_tokens", r"SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')) AS word FROM {documents}) GROUP BY doc_id, word")
def word_tokens(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.explode_outer(words(F.col("text"))).alias("word")).dropna().groupBy("doc_id", "word").agg(F.count("*").alias("n"))


# ---- streams -----------------------------------------------------------------------------------
def arriving(spark, sf_dir):
    schema = load(spark, sf_dir, "documents").schema
    # A pattern, as a table can be one file or a folder of files and a stream takes only folders by name.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")


@query("stream_redacted", f"{DOC_SPANS}{REDACTED_SQL} SELECT doc_id, redacted FROM redacted")
def stream_redacted(spark, sf_dir):
    target, checkpoint = fresh_folder(spark, "stream"), fresh_folder(spark, "stream-state")
    redact_stream(arriving(spark, sf_dir), target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("doc_id", "redacted")


@query("stream_label_counts", f"{DOC_SPANS} SELECT label, count(*) AS n FROM merged GROUP BY label")
def stream_label_counts(spark, sf_dir):
    target, checkpoint = fresh_folder(spark, "stream"), fresh_folder(spark, "stream-state")
    count_labels_stream(arriving(spark, sf_dir), target, checkpoint).awaitTermination()
    return read_label_counts(spark, target)


FIRST_SENT = 1_714_521_600  # seconds; what the times below count from


def sent_again(docs, number):
    """The reports that arrive in one of three deliveries: all; English ones unchanged and German ones in a version ten
    minutes newer; older French ones and the new German ones once more."""
    row = lambda part, text, minutes: part.select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"),
        F.timestamp_seconds(F.lit(FIRST_SENT + 60 * minutes)).alias("modified"), text.alias("content"))
    text, of = F.col("text"), lambda lang: docs.filter(F.col("lang") == lang)
    german = row(of("de"), F.concat(text, F.lit("; v2")), 10)
    return [row(docs, text, 0), row(of("en"), text, 0).union(german), row(of("fr"), F.lit("older"), -5).union(german)][number]


@query("stream_reports_sent_again", f"""{DOC_SPANS}{REDACTED_SQL}
SELECT source || '/' || CAST(d.doc_id AS VARCHAR) AS path, CASE WHEN lang = 'de' THEN 10 ELSE 0 END AS minutes,
       CASE WHEN lang = 'de' THEN r.redacted || '; v2' ELSE r.redacted END AS redacted,
       CAST(CASE WHEN lang = 'de' THEN 2 ELSE 1 END AS BIGINT) AS n_versions
FROM {{documents}} d JOIN redacted r ON r.doc_id = d.doc_id""")
def stream_reports_sent_again(spark, sf_dir):
    source, target, checkpoint = (fresh_folder(spark, n) for n in ("sent", "latest", "latest-state"))
    docs = spread(load(spark, sf_dir, "documents"))
    for number in range(3):  # every delivery is a run of its own, which goes on from the checkpoint
        sent_again(docs, number).write.mode("append").parquet(source, compression="zstd")
        arriving = spark.readStream.schema("path string, modified timestamp, content string").parquet(source)
        redact_latest_stream(arriving, target, checkpoint, lateness="1 hour").awaitTermination()
    minutes = ((F.unix_seconds("modified") - FIRST_SENT) / 60).cast("bigint")
    return read_latest(spark, target).select("path", minutes.alias("minutes"), "redacted", "n_versions")
