"""Answers, metrics and whole evaluation runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.preparing import TRIM
from queries.registry import query
from queries.retrieval import COUNTS, EVAL_CASES, EXAMPLES, asked, cases, few_shot_sql, known
from queries.tables import CHAT, PAIRS, RESPONSES, load, spread, table
from reportloom.functions import vectors as V
from reportloom.functions.answers import parse_answer, parse_extraction, parse_redaction
from reportloom.functions.similarity import (
    edit_similarity, exact_match, has_finding_hit, modality_hit, organ_hit, true_has_finding,
)
from reportloom.functions.text_scores import text_scores
from reportloom.operators import evaluation as E
from reportloom.operators.fewshot import PromptStyle
from reportloom.operators.models import answer_log, encode, score_once, score_requests
from reportloom.operators.overlap import equal_word_scores
from reportloom.plans.answering import evaluate, infer, inference_table, summary
from reportloom.session import fresh_folder
from reportloom.sources.readers import read_log_runs
from reportloom.sources.writers import append_log


def pairs(spark, sf_dir):
    return table(spark, sf_dir, PAIRS)


# ---- answers ------------------------------------------------------------------------------------
TRIMMED = f"trim(content, {TRIM})"
UNFENCED = f"trim(regexp_replace(regexp_replace({TRIMMED}, '^```json', ''), '```$', ''), {TRIM})"


def objects_sql(body: str) -> str:
    """Responses with ``o``, the JSON object their body is, if it is one."""
    return f"""SELECT req_id, content, {body} AS body, CASE WHEN json_valid({body}) AND left({body}, 1) = '{{{{' THEN CAST({body} AS json) END AS o
FROM ({RESPONSES}) r"""


OBJECT = objects_sql(UNFENCED)
ANSWERS = f"""SELECT req_id, trim(coalesce(content, ''), {TRIM}) AS text,
       coalesce(nullif(trim(o->>'result', {TRIM}), ''), trim(coalesce(content, ''), {TRIM})) AS result, o->>'reasoning' AS reasoning,
       CASE WHEN o IS NOT NULL THEN coalesce(lower(o->>'has_finding') = 'true', false) END AS has_finding,
       o->>'organ' AS organ, o->>'modality' AS modality FROM ({OBJECT})"""


@query("answers_parsed", ANSWERS)
def answers_parsed(spark, sf_dir):
    rows = table(spark, sf_dir, RESPONSES).withColumn("a", parse_answer(F.col("content")))
    return rows.select("req_id", "a.text", "a.result", "a.reasoning", "a.has_finding", "a.organ", "a.modality")


@query("answers_as_plain_text", f"SELECT req_id, trim(coalesce(content, ''), {TRIM}) AS result FROM ({RESPONSES}) r")
def answers_as_plain_text(spark, sf_dir):
    rows = table(spark, sf_dir, RESPONSES)
    return rows.select("req_id", parse_answer(F.col("content"), expect_json=False)["result"].alias("result"))


@query("redaction_answers", f"SELECT req_id, CASE WHEN content IS NULL THEN NULL WHEN o IS NULL THEN body ELSE o->>'text' END AS text, CASE WHEN content IS NULL THEN CAST(-1 AS bigint) ELSE 0 END AS n_spans FROM ({OBJECT})")
def redaction_answers(spark, sf_dir):
    rows = table(spark, sf_dir, RESPONSES).withColumn("a", parse_redaction(F.col("content")))
    return rows.select("req_id", "a.text", F.coalesce(F.size("a.spans"), F.lit(-1)).alias("n_spans"))


@query("extraction_parsed", f"SELECT req_id, coalesce(o->>'finding', '') AS finding, coalesce(o->>'conclusion', '') AS conclusion FROM ({objects_sql(TRIMMED)})")
def extraction_parsed(spark, sf_dir):
    rows = table(spark, sf_dir, RESPONSES).select("req_id", parse_extraction(F.col("content")).alias("p"))
    return rows.select("req_id", "p.finding", "p.conclusion")


# ---- single metrics -----------------------------------------------------------------------------
@query("exact_matches", f"SELECT id, CASE WHEN trim(reference, {TRIM}) = trim(predicted, {TRIM}) THEN CAST(1 AS double) ELSE 0 END AS exact FROM ({PAIRS}) p")
def exact_matches(spark, sf_dir):
    return pairs(spark, sf_dir).select("id", exact_match(F.col("reference"), F.col("predicted")).alias("exact"))


FOLD = ("'éèêçÉÈÊÇöäüßÖÄÜóíñÓÍÑ'", "'eeecEEECoausOAUoinOIN'")


@query("edit_similarities", f"""SELECT conv_id, turn, round(CASE WHEN a = b THEN CAST(1 AS double) ELSE 1 - levenshtein(a, b) / CAST(greatest(length(a), length(b)) AS double) END, 6) AS similarity
FROM (SELECT conv_id, turn, translate(prompt_text, {FOLD[0]}, {FOLD[1]}) AS a, translate(result_text, {FOLD[0]}, {FOLD[1]}) AS b FROM ({CHAT}) c)""")
def edit_similarities(spark, sf_dir):
    # Accents are folded because the SQL side counts bytes where Spark counts characters.
    fold = lambda c: F.translate(c, FOLD[0].strip("'"), FOLD[1].strip("'"))
    return spread(table(spark, sf_dir, CHAT)).select("conv_id", "turn", F.round(edit_similarity(fold(F.col("prompt_text")), fold(F.col("result_text"))), 6).alias("similarity"))


def _tokens_sql(column: str) -> str:
    text = f"rtrim({column}, {TRIM})"
    for old, new in [("<skipped>", "''"), ("-' || chr(10) || '", "''"), ("' || chr(10) || '", "' '"), ("&quot;", "chr(34)"), ("&amp;", "'&'"), ("&lt;", "'<'"), ("&gt;", "'>'")]:
        text = f"replace({text}, '{old}', {new})"
    text = f"' ' || {text} || ' '"
    for pattern, new in [(r"([\{{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "), (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")]:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return rf"list_filter(regexp_split_to_array({text}, '[\s\x1c-\x1f\x{{{{85}}}}\p{{{{Z}}}}]+'), lambda t: t <> '')".replace("{{{{", "{{").replace("}}}}", "}}")


COUNTS_SQL = f"""toks AS (SELECT id, {_tokens_sql('reference')} AS r, {_tokens_sql('predicted')} AS c FROM ({PAIRS}) p),
placed AS (SELECT id, 0 AS side, unnest(r) AS w, generate_subscripts(r, 1) AS i FROM toks
           UNION ALL SELECT id, 1, unnest(c), generate_subscripts(c, 1) FROM toks),
runs AS (SELECT id, side, w AS w1, w || ' ' || lead(w, 1) OVER o AS w2, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS w3,
                w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o AS w4
         FROM placed WINDOW o AS (PARTITION BY id, side ORDER BY i)),
grams AS (SELECT id, side, 1 AS n, w1 AS g FROM runs UNION ALL SELECT id, side, 2, w2 FROM runs WHERE w2 IS NOT NULL
          UNION ALL SELECT id, side, 3, w3 FROM runs WHERE w3 IS NOT NULL UNION ALL SELECT id, side, 4, w4 FROM runs WHERE w4 IS NOT NULL),
orders AS (SELECT id, r, c, unnest([1, 2, 3, 4]) AS n FROM toks),
counted AS (SELECT id, n, g, count(*) FILTER (side = 0) AS in_ref, count(*) FILTER (side = 1) AS in_cand FROM grams GROUP BY id, n, g),
hits AS (SELECT id, n, sum(least(in_ref, in_cand)) AS m FROM counted GROUP BY id, n),
counts AS (SELECT o.id, o.n, CAST(len(r) AS bigint) AS ref_len, CAST(len(c) AS bigint) AS sys_len, CAST(coalesce(h.m, 0) AS bigint) AS m, greatest(len(c) - o.n + 1, 0) AS t
           FROM orders o LEFT JOIN hits h ON h.id = o.id AND h.n = o.n)"""


def bleu_sql(source: str, key: str) -> str:
    """BLEU from rows (key, n, ref_len, sys_len, m, t)."""
    return f"""SELECT {key}, CASE WHEN sum(m) = 0 THEN CAST(0 AS double) ELSE round(
    CASE WHEN any_value(sys_len) >= any_value(ref_len) THEN 1 ELSE exp(1 - any_value(ref_len) / CAST(any_value(sys_len) AS double)) END
    * exp(sum(CASE WHEN t > 0 THEN ln(CASE WHEN m > 0 THEN 100.0 * m / t ELSE 100.0 / (pow(2, misses) * t) END) ELSE 0 END) / count(*) FILTER (t > 0)), 6) END AS bleu
FROM (SELECT *, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY n) AS misses FROM ({source})) GROUP BY {key}"""


@query("bleu_per_row", f"WITH {COUNTS_SQL} {bleu_sql('SELECT * FROM counts', 'id')}")
def bleu_per_row(spark, sf_dir):
    return E.sentence_bleu(pairs(spark, sf_dir)).select("id", F.round("bleu", 6).alias("bleu"))


@query("bleu_of_corpus", f"WITH {COUNTS_SQL} SELECT bleu FROM ({bleu_sql('SELECT 1 AS one, n, sum(ref_len) AS ref_len, sum(sys_len) AS sys_len, sum(m) AS m, sum(t) AS t FROM counts GROUP BY n', 'one')})")
def bleu_of_corpus(spark, sf_dir):
    return E.corpus_bleu(pairs(spark, sf_dir)).select(F.round("bleu", 6).alias("bleu"))


_WORDS = r"regexp_extract_all(lower({}), '[\p{{{{L}}}}\p{{{{N}}}}_]+|[^\p{{{{L}}}}\p{{{{N}}}}_\s]')".replace("{{{{", "{{{{").replace("}}}}", "}}}}")
METEOR_SQL = f"""WITH sides AS (SELECT id, {_WORDS.format('reference')} AS r, {_WORDS.format('predicted')} AS c FROM ({PAIRS}) p),
ref AS (SELECT id, w, i, row_number() OVER (PARTITION BY id, w ORDER BY i DESC) AS k FROM (SELECT id, unnest(r) AS w, generate_subscripts(r, 1) AS i FROM sides)),
cand AS (SELECT id, w, i, row_number() OVER (PARTITION BY id, w ORDER BY i DESC) AS k FROM (SELECT id, unnest(c) AS w, generate_subscripts(c, 1) AS i FROM sides)),
al AS (SELECT c.id, c.i, r.i AS j FROM cand c JOIN ref r ON r.id = c.id AND r.w = c.w AND r.k = c.k),
ch AS (SELECT *, CASE WHEN i = lag(i) OVER w + 1 AND j = lag(j) OVER w + 1 THEN 0 ELSE 1 END AS new FROM al WINDOW w AS (PARTITION BY id ORDER BY i)),
agg AS (SELECT id, count(*) AS m, sum(new) AS chunks FROM ch GROUP BY id)
SELECT s.id, coalesce(round((1 - 0.5 * pow(chunks / CAST(m AS double), 3)) * ((m / CAST(len(c) AS double)) * (m / CAST(len(r) AS double))
       / (CAST(0.9 AS double) * (m / CAST(len(c) AS double)) + CAST(0.1 AS double) * (m / CAST(len(r) AS double)))), 6), 0) AS meteor
FROM sides s LEFT JOIN agg a ON a.id = s.id"""


@query("meteor_by_equal_words", METEOR_SQL)
def meteor_by_equal_words(spark, sf_dir):
    scored = equal_word_scores(pairs(spark, sf_dir), key="id")
    return scored.select("id", F.round("meteor", 6).alias("meteor"))


@query("alignment_scores")
def alignment_scores(spark, sf_dir):
    scored = pairs(spark, sf_dir).withColumn("s", text_scores(F.col("reference"), F.col("predicted"), ["rouge", "meteor"]))
    return scored.select("id", F.round("s.rouge", 6).alias("rouge"), F.round("s.meteor", 6).alias("meteor"))


@query("all_text_metrics")
def all_text_metrics(spark, sf_dir):
    chat = table(spark, sf_dir, CHAT).withColumnsRenamed({"prompt_text": "reference", "result_text": "predicted"})
    scored = E.text_metrics(spread(chat), zero_without_reference=True)
    return scored.select("conv_id", "turn", *[F.round(c, 6).alias(c) for c in E.TEXT_METRICS])


# ---- class metrics --------------------------------------------------------------------------------
@query("class_hits", f"""SELECT req_id, CAST(CASE WHEN has_finding = (length(trim(text, {TRIM})) > 15) THEN 1 ELSE 0 END AS bigint) AS acc_has_finding,
       CAST(CASE WHEN lower(organ) = 'печень' THEN 1 ELSE 0 END AS bigint) AS acc_organ,
       CAST(CASE WHEN coalesce(modality, '') IN ('МРТ', 'ct') AND CASE modality WHEN 'ct' THEN 'КТ' ELSE modality END = 'КТ' THEN 1 ELSE 0 END AS bigint) AS acc_modality
FROM ({ANSWERS})""")
def class_hits(spark, sf_dir):
    rows = table(spark, sf_dir, RESPONSES).withColumn("a", parse_answer(F.col("content")))
    return rows.select(
        "req_id", has_finding_hit(true_has_finding(F.col("a.text")), F.col("a.has_finding")).alias("acc_has_finding"),
        organ_hit(F.lit(" Печень "), F.col("a.organ")).alias("acc_organ"),
        modality_hit(F.lit("КТ органов"), F.col("a.modality")).alias("acc_modality"),
    )


@query("finding_stated", f"SELECT id, length(trim(predicted, {TRIM})) > 15 AS evaluated, length(trim(predicted, {TRIM})) > 0 AS inferred FROM ({PAIRS}) p")
def finding_stated(spark, sf_dir):
    return pairs(spark, sf_dir).select("id", true_has_finding(F.col("predicted")).alias("evaluated"), true_has_finding(F.col("predicted"), 0).alias("inferred"))


@query("metric_means", f"SELECT coalesce(round(avg(CASE WHEN trim(reference, {TRIM}) = trim(predicted, {TRIM}) THEN 1 ELSE 0 END), 9), 0) AS accuracy, CAST(0 AS double) AS of_nothing FROM ({PAIRS}) p")
def metric_means(spark, sf_dir):
    scored = pairs(spark, sf_dir).select(exact_match(F.col("reference"), F.col("predicted")).alias("x"), F.lit(None).cast("double").alias("y"))
    return E.mean_metrics(scored, {"accuracy": "x", "of_nothing": "y"}).withColumn("accuracy", F.round("accuracy", 9))


@query("scores_formatted", "SELECT event_id, printf('%.4f', value) AS value FROM {events}")
def scores_formatted(spark, sf_dir):
    return E.formatted(load(spark, sf_dir, "events").select("event_id", "value"), ["value"])


@query("references_aligned", f"SELECT d.doc_id AS id, d.lang AS truth, CAST(l.quality AS bigint) AS predicted FROM {{documents}} d JOIN {{labels}} l ON l.doc_id = d.doc_id")
def references_aligned(spark, sf_dir):
    truth = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("truth"))
    return E.align(truth, load(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("bigint").alias("predicted")))


def letters():
    """Stand-in encoder for checks."""
    import numpy as np

    return lambda texts: np.array([[t.count(c) for c in "aent"] for t in texts], dtype=np.float32)


_PAIR_VECTORS = f"SELECT id, {COUNTS.format('reference')} AS a, {COUNTS.format('predicted')} AS b FROM ({PAIRS}) p"
_LENGTH = "sqrt(list_sum(list_transform({0}, lambda y: CAST(y * y AS double))))"


@query("organs_soft_match", f"SELECT id, round(list_sum(list_transform(list_zip(a, b), lambda z: CAST(z[1] * z[2] AS double))) / ({_LENGTH.format('a')} * {_LENGTH.format('b')} + CAST('1e-12' AS double)), 5) AS cosine FROM ({_PAIR_VECTORS})")
def organs_soft_match(spark, sf_dir):
    both = encode(encode(pairs(spark, sf_dir), letters, text="reference", out="a", normalize=False), letters, text="predicted", out="b", normalize=False)
    soft = E.with_soft_organ(both, V.cosine(F.col("a"), F.col("b")))
    return soft.select("id", F.round("acc_organ_cosine", 5).alias("cosine"))


# ---- scorer and whole runs ----------------------------------------------------------------------
def echo_scorer():
    """Stand-in model: fails on empty prompts, else states the prompt's length."""

    def score(prompts):
        if any(not p for p in prompts):
            raise ValueError("empty prompt")
        return ['{"result": "%d", "has_finding": true, "organ": "src1", "modality": "MRI"}' % len(p) for p in prompts]

    return score


@query("requests_scored", f"""SELECT report_id, CASE WHEN content <> '' THEN concat('{{{{"result": "', length(content), '", "has_finding": true, "organ": "src1", "modality": "MRI"}}}}') END AS answer,
       CASE WHEN content <> '' THEN 'ok' ELSE 'failed' END AS status, CASE WHEN content <> '' THEN NULL ELSE 'ValueError: empty prompt' END AS error
FROM (SELECT doc_id AS report_id, CASE source WHEN 'src5' THEN '' ELSE text END AS content FROM {{documents}})""")
def requests_scored(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    asked_ = docs.select(F.col("doc_id").alias("report_id"), F.when(F.col("source") == "src5", "").otherwise(F.col("text")).alias("prompt"))
    return score_requests(spread(asked_), echo_scorer).select("report_id", F.col("content").alias("answer"), "status", "error")


RUN = f"""SELECT e.row_id AS id, e.organ, e.modality, e.finding, e.result AS reference, x.examples,
       {few_shot_sql(False, True, 'x.examples')} AS prompt FROM ({EVAL_CASES}) e JOIN ({EXAMPLES}) x ON x.query_id = e.row_id"""


@query("evaluation_run", f"""SELECT id, modality, organ, md5(finding) AS finding_md5, CAST(length(prompt) AS string) AS predicted_result, CAST(0 AS bigint) AS is_exact_match, CAST(0 AS double) AS bleu,
       CAST(CASE WHEN length(trim(finding, {TRIM})) > 15 THEN 1 ELSE 0 END AS bigint) AS acc_has_finding,
       CAST(CASE organ WHEN 'src1' THEN 1 ELSE 0 END AS bigint) AS acc_organ_exact, CAST(0 AS bigint) AS acc_modality FROM ({RUN})""")
def evaluation_run(spark, sf_dir):
    df = cases(spark, sf_dir)
    rows = evaluate(asked(df), known(df), echo_scorer).withColumn("finding_md5", F.md5("finding"))
    return rows.withColumn("bleu", F.round("bleu", 6)).drop("finding", "rouge", "meteor", "acc_organ_cosine")


@query("evaluation_summary", f"""SELECT CAST(0 AS double) AS accuracy, round(avg(CASE WHEN length(trim(finding, {TRIM})) > 15 THEN 1 ELSE 0 END), 9) AS acc_has_finding,
       round(avg(CASE organ WHEN 'src1' THEN 1 ELSE 0 END), 9) AS acc_organ_exact, CAST(0 AS double) AS acc_modality FROM ({RUN})""")
def evaluation_summary(spark, sf_dir):
    df = cases(spark, sf_dir)
    means = summary(evaluate(asked(df), known(df), echo_scorer))
    return means.select("accuracy", F.round("acc_has_finding", 9).alias("acc_has_finding"), F.round("acc_organ_exact", 9).alias("acc_organ_exact"), "acc_modality")


@query("inference_run", f"""SELECT id, md5(finding) AS finding_md5, modality AS gt_modality, organ AS gt_organ, md5(reference) AS result_md5, 'MRI' AS pred_modality, 'src1' AS pred_organ,
       CAST(length(prompt) AS string) AS pred_result FROM ({RUN})""")
def inference_run(spark, sf_dir):
    df = cases(spark, sf_dir)
    flat = inference_table(infer(asked(df), known(df), echo_scorer, style=PromptStyle()))
    return flat.withColumns({"finding_md5": F.md5("finding"), "result_md5": F.md5("gt_result")}).drop("finding", "gt_result")


@query("inference_log", f"SELECT id, md5(prompt) AS prompt_md5, CAST(5 AS bigint) AS n_examples, 'run-1' AS run_id FROM ({RUN})")
def inference_log(spark, sf_dir):
    df = cases(spark, sf_dir)
    folder = fresh_folder(spark, "log")
    append_log(infer(asked(df), known(df), echo_scorer), folder, run_id="run-1")
    return read_log_runs(spark, folder).select("id", F.md5("prompt").alias("prompt_md5"), F.size("examples").alias("n_examples"), "run_id")


def first_try():
    """Stand-in model that is down for every prompt of odd length."""

    def score(prompts):
        if any(len(p) % 2 for p in prompts):
            raise ConnectionError("down")
        return [f"first {len(p)}" for p in prompts]

    return score


def second_try():
    return lambda prompts: [f"second {len(p)}" for p in prompts]


def asked_texts(spark, sf_dir):
    return spread(load(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt")))


@query("scoring_resumed", """SELECT doc_id, CASE length(text) % 2 WHEN 0 THEN concat('first ', length(text)) ELSE concat('second ', length(text)) END AS content, 'ok' AS status FROM {documents}""")
def scoring_resumed(spark, sf_dir):
    """What the first run got is not asked again; the second run asks for the rest."""
    log, rows = fresh_folder(spark, "answer-log"), asked_texts(spark, sf_dir)
    score_once(rows, first_try, log)
    return score_once(rows, second_try, log).select("doc_id", "content", "status")


@query("scoring_log", """SELECT status, error, content, count(*) AS n FROM (
SELECT DISTINCT text, 'ok' AS status, NULL AS error, CASE length(text) % 2 WHEN 0 THEN concat('first ', length(text)) ELSE concat('second ', length(text)) END AS content FROM {documents}
UNION SELECT text, 'failed', 'ConnectionError: down', NULL FROM {documents} WHERE length(text) % 2 = 1) GROUP BY status, error, content""")
def scoring_log(spark, sf_dir):
    """The log after both runs: every distinct prompt once, and once more where its first try failed."""
    log, rows = fresh_folder(spark, "answer-log"), asked_texts(spark, sf_dir)
    score_once(rows, first_try, log)
    score_once(rows, second_try, log)
    return answer_log(spark, log).groupBy("status", "error", "content").agg(F.count("*").alias("n"))
