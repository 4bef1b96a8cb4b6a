"""Report folders, compiled tables, splits and prompt tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.redaction import REGEX, braces
from queries.registry import query
from queries.tables import CHAT, COMPILED, NOTES, ORGANS, REPORTS, load, table
from reportloom.fixed_values import CT, EXTRACTION_REQUEST, MR, NA_TEXTS, PROMPTS
from reportloom.functions.modality import folder_modality, folder_of, modality, modality_hint, path_part
from reportloom.functions.text import WHITESPACE, has_text
from reportloom.operators import compiling as C
from reportloom.operators import redaction as R
from reportloom.operators import reports as P
from reportloom.operators.split import number_rows, split_sizes, three_way_split, train_eval_split, with_row_number
from reportloom.plans.prepare import prepare

TRIM = f"'{WHITESPACE}'"


def reports(spark, sf_dir):
    return table(spark, sf_dir, REPORTS)


def compiled(spark, sf_dir):
    return table(spark, sf_dir, COMPILED)


# ---- report folders ---------------------------------------------------------------------------
STATUS_SQL = f"""SELECT *, CASE WHEN ext NOT IN ('txt', 'pdf', 'doc', 'docx', 'rtf') THEN 'skipped'
       WHEN ext <> 'txt' OR content IS NULL THEN 'failed' ELSE 'ok' END AS status
FROM (SELECT *, lower(regexp_extract(path, '\\.([^./]+)$', 1)) AS ext FROM ({REPORTS}) r)"""
TEXTS_SQL = f"SELECT *, regexp_replace(path, '/[^/]*$', '') AS folder FROM ({REPORTS}) r WHERE path LIKE '%.txt' AND length(content) > 0"


@query("report_status", f"SELECT report_id, ext, status FROM ({STATUS_SQL})")
def report_status(spark, sf_dir):
    return R.with_status(reports(spark, sf_dir)).select("report_id", "ext", "status")


@query("report_failures", f"""SELECT path, CASE WHEN ext <> 'txt' THEN concat('no decoder for .', ext) ELSE 'unreadable' END AS error
FROM ({STATUS_SQL}) WHERE status = 'failed'""")
def report_failures(spark, sf_dir):
    return R.failures(R.with_status(reports(spark, sf_dir)))


@query("anonymisation_totals", f"""SELECT count(*) FILTER (status <> 'failed') AS files_processed,
       CAST(coalesce(sum(len(regexp_extract_all(content, '{braces(REGEX['EMAIL'])}')))
            FILTER (status = 'ok'), 0) AS BIGINT) AS total_replacements FROM ({STATUS_SQL})""")
def anonymisation_totals(spark, sf_dir):
    marked = R.with_status(reports(spark, sf_dir)).withColumn("text", F.when(F.col("status") == "ok", F.col("content")))
    emails = R.RegexStage([p for p in R.DEFAULT_PATTERNS if p.label == "EMAIL"])
    return R.totals(R.redact(marked, emails), status="status")


@query("path_columns", f"""SELECT report_id, string_split(path, '/')[-1] AS file_name, string_split(path, '/')[-2] AS organ,
       string_split(path, '/')[-3] AS modality_folder, regexp_replace(path, '/[^/]*$', '') AS folder FROM ({REPORTS}) r""")
def path_columns(spark, sf_dir):
    path = F.col("path")
    return reports(spark, sf_dir).select(
        "report_id", path_part(path, 1).alias("file_name"), path_part(path, 2).alias("organ"),
        path_part(path, 3).alias("modality_folder"), folder_of(path).alias("folder"),
    )


@query("folder_reports", f"SELECT folder, count(*) AS n_reports FROM ({TEXTS_SQL}) GROUP BY folder")
def folder_reports(spark, sf_dir):
    return P.folder_counts(P.text_reports(reports(spark, sf_dir)))


EXTRACTED = """
SELECT doc_id AS report_id,
       CASE lang WHEN 'en' THEN concat('{{"finding": "F', cast(doc_id AS string), '", "conclusion": "C"}}')
                 WHEN 'de' THEN '{{"finding": "only"}}' WHEN 'fr' THEN 'no JSON' ELSE NULL END AS content
FROM {documents}
"""
PAIRS_SQL = f"""SELECT r.report_id, CASE d.lang WHEN 'en' THEN concat('F', cast(r.report_id AS string)) WHEN 'de' THEN 'only' ELSE '' END AS finding,
       string_split(r.path, '/')[-1] AS file_name, CASE d.lang WHEN 'en' THEN 'C' ELSE '' END AS result, r.folder,
       CASE d.lang WHEN 'es' THEN 'failed' ELSE 'ok' END AS status
FROM ({TEXTS_SQL}) r JOIN {{documents}} d ON d.doc_id = r.report_id"""


def extracted(spark, sf_dir):
    found = P.text_reports(reports(spark, sf_dir))
    return P.extracted_pairs(found, table(spark, sf_dir, EXTRACTED), key="report_id")


@query("extraction_requests", f"SELECT report_id, md5(replace('{braces(EXTRACTION_REQUEST.format(report='@@'))}', '@@', content)) AS prompt_md5 FROM ({TEXTS_SQL})")
def extraction_requests(spark, sf_dir):
    asked = P.extraction_requests(P.text_reports(reports(spark, sf_dir)))
    return asked.select("report_id", F.md5("prompt").alias("prompt_md5"))


@query("extraction_answers", PAIRS_SQL)
def extraction_answers(spark, sf_dir):
    return extracted(spark, sf_dir)


@query("reports_without_row", f"SELECT report_id, path FROM ({TEXTS_SQL}) WHERE report_id NOT IN (SELECT doc_id FROM {{labels}})")
def reports_without_row(spark, sf_dir):
    found = P.text_reports(reports(spark, sf_dir)).select("report_id", "path")
    done = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("report_id"))
    return P.unprocessed(found, done, key="report_id")


@query("extraction_run_summary", f"""SELECT count(*) AS found, count(l.doc_id) AS processed, count(DISTINCT CASE WHEN l.doc_id IS NOT NULL THEN folder END) AS folders,
       count(*) - count(l.doc_id) AS missing
FROM ({TEXTS_SQL}) r LEFT JOIN (SELECT DISTINCT doc_id FROM {{labels}}) l ON l.doc_id = r.report_id""")
def extraction_run_summary(spark, sf_dir):
    found = P.text_reports(reports(spark, sf_dir)).select("report_id", "folder")
    return P.run_summary(found, load(spark, sf_dir, "labels").select(F.col("doc_id").alias("report_id")), key="report_id")


# ---- modalities ---------------------------------------------------------------------------------
def _modality_sql(text: str, mr: str, ct: str, other: str) -> str:
    any_of = lambda words: " OR ".join(f"contains({text}, '{w}')" for w in words.split())
    return f"CASE WHEN {any_of(mr)} THEN '{MR}' WHEN {any_of(ct)} THEN '{CT}' ELSE {other} END"


@query("modality_from_folder", f"SELECT report_id, {_modality_sql('f', 'мр mrt mri mr_', 'кт ct kt_', 'upper(f)')} AS modality FROM (SELECT report_id, lower(string_split(path, '/')[-3]) AS f FROM ({REPORTS}) r)")
def modality_from_folder(spark, sf_dir):
    return reports(spark, sf_dir).select("report_id", folder_modality(path_part(F.col("path"), 3)).alias("modality"))


@query("modality_from_text", f"SELECT row_id, md5({_modality_sql('f', 'мр mri мрт', 'кт ct', 'replace(upper(f), chr(7838), chr(223))')}) AS modality FROM (SELECT row_id, lower(trim(coalesce(finding, ''), {TRIM})) AS f FROM ({COMPILED}) c)")
def modality_from_text(spark, sf_dir):
    # One engine upper-cases a sharp s to "SS", the other leaves it.
    kept = modality(F.replace(F.col("finding"), F.lit("ß"), F.lit("\ue0df")))
    return compiled(spark, sf_dir).select("row_id", F.md5(F.replace(kept, F.lit("\ue0df"), F.lit("ß"))).alias("modality"))


@query("modality_inferred", f"SELECT row_id, {_modality_sql('f', 'мр мрт mri', 'кт ct', chr(39) * 2)} AS modality FROM (SELECT row_id, lower(coalesce(finding, '')) AS f FROM ({COMPILED}) c)")
def modality_inferred(spark, sf_dir):
    return compiled(spark, sf_dir).select("row_id", modality(F.col("finding"), fallback="").alias("modality"))


@query("modality_hint", f"SELECT row_id, CASE WHEN contains(coalesce(finding, ''), 'МР') THEN '{MR}' ELSE '{CT}' END AS hint FROM ({COMPILED}) c")
def hint(spark, sf_dir):
    return compiled(spark, sf_dir).select("row_id", modality_hint(F.col("finding")).alias("hint"))


# ---- compiled tables --------------------------------------------------------------------------
@query("tables_united", """SELECT source AS origin_folder, 'МРТ' AS modality, '' AS extra, doc_id || '.txt' AS file_name, text AS finding, '' AS result FROM {documents}
UNION ALL SELECT role, 'КТ', coalesce(CAST(turn AS string), ''), '', '', text FROM {conversations}""")
def tables_united(spark, sf_dir):
    first = load(spark, sf_dir, "documents").select(
        F.col("source").alias("origin_folder"), F.lit("МРТ").alias("modality"), F.col("text").alias("finding"),
        F.concat("doc_id", F.lit(".txt")).alias("file_name"),
    )
    second = load(spark, sf_dir, "conversations").select(
        F.col("text").alias("result"), F.col("turn").alias("extra"), F.col("role").alias("origin_folder"), F.lit("КТ").alias("modality"),
    )
    return C.union_tables([first, second])


NA_LIST = ", ".join(f"'{t}'" for t in NA_TEXTS)


@query("missing_texts", f"SELECT row_id, CASE WHEN finding IN ({NA_LIST}) THEN NULL ELSE finding END AS finding, CASE WHEN result IN ({NA_LIST}) THEN NULL ELSE result END AS result FROM ({COMPILED}) c")
def missing_texts(spark, sf_dir):
    return C.na_to_null(compiled(spark, sf_dir).select("row_id", "finding", "result"))


@query("columns_renamed", f"SELECT row_id, origin_folder AS organ_abbr, finding AS finding_text, result AS result_text FROM ({COMPILED}) c")
def columns_renamed(spark, sf_dir):
    checked = C.require_columns(compiled(spark, sf_dir), ["origin_folder", "finding", "result", "modality"])
    return checked.withColumnsRenamed(
        {"origin_folder": "organ_abbr", "finding": "finding_text", "result": "result_text"}
    ).drop("modality")


ORGAN_SQL = "CASE origin_folder " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ORGANS.items()) + " ELSE origin_folder END"


@query("organs_looked_up", f"SELECT row_id, {ORGAN_SQL} AS organ FROM ({COMPILED}) c")
def organs_looked_up(spark, sf_dir):
    return C.look_up(compiled(spark, sf_dir).select("row_id", "origin_folder"), "origin_folder", ORGANS, out="organ").drop("origin_folder")


@query("organs_joined", f"SELECT c.row_id, coalesce(m.v, c.origin_folder) AS organ FROM ({COMPILED}) c LEFT JOIN (SELECT source AS k, concat(min(lang), '/', CAST(count(*) AS string)) AS v FROM {{documents}} WHERE lang <> 'en' GROUP BY source) m ON m.k = c.origin_folder")
def organs_joined(spark, sf_dir):
    names = load(spark, sf_dir, "documents").filter("lang <> 'en'").groupBy(F.col("source").alias("k")).agg(
        F.concat(F.min("lang"), F.lit("/"), F.count("*").cast("string")).alias("v")
    )
    return C.look_up(compiled(spark, sf_dir).select("row_id", "origin_folder"), "origin_folder", names, out="organ").drop("origin_folder")


@query("inference_rows", f"""SELECT CAST(row_id AS string) AS id, origin_folder AS organ, coalesce(finding, '') AS finding, coalesce(result, '') AS reference,
       coalesce(modality, CASE WHEN contains(lower(coalesce(finding, '')), 'ct') THEN 'КТ' ELSE 'other' END) AS modality FROM ({COMPILED}) c""")
def inference_rows(spark, sf_dir):
    rows = C.inference_rows(compiled(spark, sf_dir), {"id": "uid", "organ": "origin_folder"}, index="row_id")
    # Texts without a modality word stand for themselves; shown here as "other".
    return rows.withColumn("modality", F.when(F.col("modality").isin(MR, CT), F.col("modality")).otherwise("other"))


@query("first_filled", f"SELECT row_id, coalesce(nullif(finding, ''), result) AS text FROM ({COMPILED}) c")
def first_filled(spark, sf_dir):
    return compiled(spark, sf_dir).select("row_id", C.first_filled(F.col("finding"), F.col("result")).alias("text"))


NOT_BLANK = lambda c: f"trim({c}, {TRIM}) <> ''"
NOT_NONE = lambda c: f"lower(trim({c}, {TRIM})) <> 'none'"


@query("usable_pairs", f"SELECT row_id FROM ({COMPILED}) c WHERE {NOT_BLANK('finding')} AND {NOT_BLANK('result')}")
def usable_pairs(spark, sf_dir):
    return C.usable_pairs(compiled(spark, sf_dir), prompt="finding", answer="result").select("row_id")


@query("indexable_pairs", f"SELECT row_id, trim(finding, {TRIM}) AS finding, trim(result, {TRIM}) AS result FROM ({COMPILED}) c WHERE {NOT_BLANK('finding')} AND {NOT_BLANK('result')} AND {NOT_NONE('finding')} AND {NOT_NONE('result')}")
def indexable_pairs(spark, sf_dir):
    pairs = C.indexable_pairs(compiled(spark, sf_dir), finding=F.col("finding"), result=F.col("result"))
    return pairs.select("row_id", "finding", "result")


@query("rows_with_finding", f"SELECT row_id FROM ({COMPILED}) c WHERE {NOT_BLANK('finding')}")
def rows_with_finding(spark, sf_dir):
    return compiled(spark, sf_dir).filter(has_text(F.col("finding"))).select("row_id")


@query("training_text", f"SELECT md5(concat(trim(finding, {TRIM}), chr(10), chr(10), trim(result, {TRIM}))) AS text_md5 FROM ({COMPILED}) c WHERE finding IS NOT NULL AND result IS NOT NULL")
def training_text(spark, sf_dir):
    texts = C.training_text(compiled(spark, sf_dir), prompt="finding", answer="result")
    return texts.select(F.md5("text").alias("text_md5"))


# ---- splits -------------------------------------------------------------------------------------
def ranked_sql(source: str, key: str) -> str:
    return f"""SELECT *, row_number() OVER (ORDER BY md5(concat('42:', CAST({key} AS string)))) - 1 AS pos, count(*) OVER () AS total FROM ({source}) s"""


FIRST = "round_even(total * CAST(0.2 AS double), 0)"
SECOND = f"round_even((total - {FIRST}) * CAST(0.4 AS double), 0)"
SHARE = f"CASE WHEN pos < {FIRST} THEN 'simple' WHEN pos < {FIRST} + {SECOND} THEN 'medium' ELSE 'cot' END"
EVAL = "CASE WHEN pos < ceil(total * CAST(0.1 AS double)) THEN 'eval' ELSE 'train' END"


@query("split_three_ways", f"SELECT doc_id, {SHARE} AS split FROM ({ranked_sql('SELECT doc_id FROM {documents}', 'doc_id')})")
def split_three_ways(spark, sf_dir):
    return three_way_split(load(spark, sf_dir, "documents").select("doc_id"), key="doc_id")


@query("split_train_eval", f"SELECT doc_id, {EVAL} AS split FROM ({ranked_sql('SELECT doc_id FROM {documents}', 'doc_id')})")
def split_train_eval(spark, sf_dir):
    return train_eval_split(load(spark, sf_dir, "documents").select("doc_id"), key="doc_id")


@query("split_sizes", f"SELECT split, count(*) AS n FROM (SELECT {SHARE} AS split FROM ({ranked_sql('SELECT event_id FROM {events}', 'event_id')})) GROUP BY split")
def sizes(spark, sf_dir):
    return split_sizes(three_way_split(load(spark, sf_dir, "events").select("event_id"), key="event_id"))


@query("rows_numbered", f"SELECT event_id, pos AS orig_index FROM ({ranked_sql('SELECT event_id FROM {events}', 'event_id')})")
def rows_numbered(spark, sf_dir):
    return number_rows(load(spark, sf_dir, "events").select("event_id"), key="event_id")


# Keys that are NULL or shared: sizes stay exact and no row is lost.
WORN_KEYS = """SELECT event_id, CASE WHEN event_id % 10 < 3 THEN NULL WHEN event_id % 10 < 6 THEN 7 ELSE event_id END AS k FROM {events}"""
SIZES_SQL = f"SELECT {{cases}} AS split, count(*) AS n FROM (SELECT row_number() OVER () - 1 AS pos, count(*) OVER () AS total FROM {{{{events}}}}) GROUP BY 1"


@query("split_with_null_keys", SIZES_SQL.format(cases=SHARE))
def split_with_null_keys(spark, sf_dir):
    rows = table(spark, sf_dir, WORN_KEYS).withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    return split_sizes(three_way_split(rows, key="k"))


@query("split_with_repeated_keys", SIZES_SQL.format(cases=EVAL))
def split_with_repeated_keys(spark, sf_dir):
    return split_sizes(train_eval_split(table(spark, sf_dir, WORN_KEYS), key="k"))


@query("rows_numbered_with_null_keys", "SELECT event_id, CAST(row_number() OVER (ORDER BY event_id) - 1 AS bigint) AS number FROM {events}")
def rows_numbered_with_null_keys(spark, sf_dir):
    numbered = number_rows(table(spark, sf_dir, WORN_KEYS), key="k")
    ids = number_rows(numbered.select("event_id"), key="event_id", out="number").select("event_id")
    places = numbered.select(F.col("orig_index").alias("number"))
    return with_row_number(ids.join(numbered.select("event_id"), "event_id").orderBy("event_id"), out="number").join(places, "number").select("event_id", "number")


@query("organs_joined_repeated_key", f"SELECT c.row_id, coalesce(m.v, c.origin_folder) AS organ FROM ({COMPILED}) c LEFT JOIN (SELECT source AS k, min(lang) AS v FROM {{documents}} WHERE lang <> 'en' GROUP BY source) m ON m.k = c.origin_folder")
def organs_joined_repeated_key(spark, sf_dir):
    names = load(spark, sf_dir, "documents").filter("lang <> 'en'").select(F.col("source").alias("k"), F.col("lang").alias("v"))
    return C.look_up(compiled(spark, sf_dir).select("row_id", "origin_folder"), "origin_folder", names, out="organ").drop("origin_folder")


# ---- prompts and messages -------------------------------------------------------------------------
HINT_SQL = f"CASE WHEN contains(coalesce(finding, ''), 'МР') THEN '{MR}' ELSE '{CT}' END"


def prompt_sql(kind: str, form: str) -> str:
    """concat() of the wording's literals and columns."""
    marks = {"organ": "\x01", "finding": "\x02", "modality": "\x03"}
    wording = PROMPTS[kind, form].format(**marks).replace("'", "''")
    wording = braces(wording).replace("\x01", f"', {ORGAN_SQL}, '").replace("\x02", "', coalesce(finding, ''), '")
    return "concat('" + wording.replace("\x03", f"', {HINT_SQL}, '") + "')"


for kind, form in PROMPTS:
    @query(f"prompt_{kind}_{form}", f"SELECT row_id, md5({prompt_sql(kind, form)}) AS prompt_md5 FROM ({COMPILED}) c")
    def wording(spark, sf_dir, kind=kind, form=form):
        rows = C.look_up(compiled(spark, sf_dir), "origin_folder", ORGANS, out="organ")
        text = C.prompt(kind, form, C.prompt_columns(rows, finding="finding"))
        return rows.select("row_id", F.md5(text).alias("prompt_md5"))


TYPE = f"CASE WHEN {SHARE} = 'simple' THEN 'simple' ELSE 'medium' END"
PROMPT_TABLE = f"""SELECT row_id, modality, finding, result, {ORGAN_SQL} AS organ, {TYPE} AS type,
       CASE {TYPE} WHEN 'simple' THEN {prompt_sql('simple', 'text')} ELSE {prompt_sql('medium', 'text')} END AS prompt_text,
       CASE {TYPE} WHEN 'simple' THEN {prompt_sql('simple', 'json')} ELSE {prompt_sql('medium', 'json')} END AS prompt_json
FROM ({ranked_sql(COMPILED, 'row_id')})"""


@query("prompt_table", f"""SELECT row_id, type, modality, organ, finding AS finding_text, result AS result_text, prompt_text, prompt_json,
       concat('{{{{''result'': ''', coalesce(result, ''), '''}}}}') AS result_json,
       CAST(json_object('result', coalesce(result, '')) AS string) AS result_json_strict FROM ({PROMPT_TABLE})""")
def prompt_table(spark, sf_dir):
    return C.build_prompts(compiled(spark, sf_dir), key="row_id", organs=ORGANS)


@query("chat_messages", f"""SELECT conv_id, turn, CAST(m AS bigint) AS position, CASE m WHEN 0 THEN 'user' ELSE 'assistant' END AS role,
       trim(CASE m WHEN 0 THEN prompt_text ELSE result_text END, {TRIM}) AS content
FROM ({CHAT}) c, (SELECT unnest([0, 1]) AS m) WHERE {NOT_BLANK('prompt_text')} AND {NOT_BLANK('result_text')}""")
def chat_messages(spark, sf_dir):
    rows = C.chat_messages(table(spark, sf_dir, CHAT)).select("conv_id", "turn", F.posexplode("messages").alias("position", "m"))
    return rows.select("conv_id", "turn", "position", "m.role", "m.content")


VALID = f"SELECT * FROM ({PROMPT_TABLE}) WHERE {NOT_BLANK('prompt_text')} AND {NOT_BLANK('result')}"


def prepared(spark, sf_dir):
    return prepare(compiled(spark, sf_dir), key="row_id", organs=ORGANS)


@query("retrieval_train_rows", f"""SELECT organ, coalesce(finding, '') AS finding_text, result AS result_text, coalesce(modality, '') AS modality
FROM ({ranked_sql(VALID, 'row_id')}) WHERE pos >= ceil(total * CAST(0.1 AS double))""")
def retrieval_train_rows(spark, sf_dir):
    return C.retrieval_train_rows(prepared(spark, sf_dir))


@query("retrieval_test_rows", f"""SELECT pos AS id, organ, coalesce(finding, '') AS finding_text, result AS result_text,
       coalesce(modality, {_modality_sql("lower(coalesce(finding, ''))", 'мр мрт mri', 'кт ct', chr(39) * 2)}) AS modality
FROM ({ranked_sql(VALID, 'row_id')}) WHERE pos < ceil(total * CAST(0.1 AS double))""")
def retrieval_test_rows(spark, sf_dir):
    return C.retrieval_test_rows(prepared(spark, sf_dir), key="row_id")


@query("split_row_counts", f"SELECT split, count(*) AS n FROM (SELECT {EVAL} AS split FROM ({ranked_sql(VALID, 'row_id')})) GROUP BY split")
def split_row_counts(spark, sf_dir):
    return split_sizes(prepared(spark, sf_dir))


@query("notes_by_modality", f"SELECT modality, count(*) AS n FROM (SELECT {_modality_sql('lower(long_text)', 'мр mri мрт', 'кт ct', chr(39) + 'OTHER' + chr(39))} AS modality FROM ({NOTES}) n) GROUP BY modality")
def notes_by_modality(spark, sf_dir):
    return table(spark, sf_dir, NOTES).select(modality(F.col("long_text"), fallback="OTHER").alias("modality")).groupBy("modality").agg(F.count("*").alias("n"))
