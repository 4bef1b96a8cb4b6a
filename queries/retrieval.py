"""Vectors, neighbours, few-shot requests and the retrieval index."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import functions as F

from queries.preparing import compiled, ranked_sql
from queries.redaction import braces
from queries.registry import query
from queries.tables import CASES, COMPILED, load, spread, table
from reportloom.fixed_values import ANSWER_FORMAT, FEW_SHOT_PROMPTS, NO_EXAMPLES
from reportloom.functions import vectors as V
from reportloom.functions.text import WHITESPACE
from reportloom.operators import fewshot as X
from reportloom.operators.models import encode, encode_offline, fit_offline_encoder
from reportloom.operators.neighbours import top_k
from reportloom.operators.split import train_eval_split, with_row_number
from reportloom.operators.vector_index import build_index, load_index, save_index
from reportloom.plans.answering import few_shot_requests
from reportloom.session import fresh_folder
from reportloom.sources.writers import write_splits

K = 5


def vectors(spark, sf_dir):
    return spread(load(spark, sf_dir, "embeddings"))


def as_queries(df):
    return df.select(F.col("vec_id").alias("query_id"), "embedding")


def as_corpus(df):
    return df.select(F.col("vec_id").alias("corpus_id"), "embedding")


DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: CAST(z[1] AS double) * CAST(z[2] AS double)))"
DISTANCE = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (CAST(z[1] AS double) - CAST(z[2] AS double)) * (CAST(z[1] AS double) - CAST(z[2] AS double))))"


def top_sql(queries: str, corpus: str, score: str = DOT, order: str = "DESC", k: int = K) -> str:
    """Both sides as SQL giving (query_id | corpus_id, embedding)."""
    return f"""SELECT query_id, corpus_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, corpus_id) AS rank FROM (
    SELECT q.query_id, c.corpus_id, {score.format(a='q.embedding', b='c.embedding')} AS score FROM ({queries}) q, ({corpus}) c))
WHERE rank <= {k}"""


ALL_QUERIES = "SELECT vec_id AS query_id, embedding FROM {embeddings}"
ALL_CORPUS = "SELECT vec_id AS corpus_id, embedding FROM {embeddings}"


@query("nearest_by_product", top_sql(ALL_QUERIES, ALL_CORPUS))
def nearest_by_product(spark, sf_dir):
    df = vectors(spark, sf_dir)
    return top_k(as_queries(df), as_corpus(df), K)


@query("nearest_by_distance", top_sql(ALL_QUERIES, ALL_CORPUS, DISTANCE, "ASC"))
def nearest_by_distance(spark, sf_dir):
    df = vectors(spark, sf_dir)
    return top_k(as_queries(df), as_corpus(df), K, normalized=False)


@query("nearest_in_blocks", top_sql(ALL_QUERIES, ALL_CORPUS))
def nearest_in_blocks(spark, sf_dir):
    df = vectors(spark, sf_dir)
    return top_k(as_queries(df), as_corpus(df), K, block_rows=200)


LABEL_VECTORS = """SELECT CAST(label AS bigint) AS corpus_id, list(m ORDER BY i) AS embedding FROM (
  SELECT label, i, round(avg(CAST(x AS double)), 9) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM {embeddings}) GROUP BY label, i) GROUP BY label"""


@query("more_asked_than_there", top_sql(ALL_QUERIES, LABEL_VECTORS, k=25))
def more_asked_than_there(spark, sf_dir):
    df = vectors(spark, sf_dir)
    means = df.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(
        F.round(F.avg(F.col("x").cast("double")), 9).alias("m")
    )
    corpus = means.groupBy(F.col("label").cast("bigint").alias("corpus_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("embedding")
    )
    return top_k(as_queries(df), corpus, 25)


@query("unit_vectors", f"SELECT vec_id, i - 1 AS i, round(CAST(x AS double) / sqrt({DOT.format(a='embedding', b='embedding')}), 6) AS x FROM (SELECT vec_id, embedding, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM {{embeddings}})")
def unit_vectors(spark, sf_dir):
    return vectors(spark, sf_dir).select("vec_id", F.posexplode(V.unit(F.col("embedding"))).alias("i", "x")).withColumn("x", F.round("x", 6))


NEXT = "FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1"


@query("cosines", f"SELECT a.vec_id, round({DOT.format(a='a.embedding', b='b.embedding')} / (sqrt({DOT.format(a='a.embedding', b='a.embedding')}) * sqrt({DOT.format(a='b.embedding', b='b.embedding')}) + 1e-12), 6) AS cosine, round({DISTANCE.format(a='a.embedding', b='b.embedding')}, 6) AS distance {NEXT}")
def cosines(spark, sf_dir):
    a = vectors(spark, sf_dir)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select(
        "vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"),
        F.round(V.squared_distance(F.col("embedding"), F.col("other")), 6).alias("distance"),
    )


# ---- few-shot requests: eval documents ask, train documents answer ------------------------------
def cases(spark, sf_dir):
    folder = fresh_folder(spark, "cases")
    write_splits(train_eval_split(table(spark, sf_dir, CASES), key="row_id"), folder)
    return spark.read.parquet(folder)


def asked(df):
    return df.filter("split = 'eval'").select(F.col("row_id").alias("id"), "organ", "modality", "finding", F.col("result").alias("reference"), "embedding")


def known(df):
    return df.filter("split = 'train'").select(F.col("row_id").alias("corpus_id"), "finding", "result", "embedding")


RANKED_CASES = ranked_sql(CASES, "row_id")
EVAL_CASES = f"SELECT * FROM ({RANKED_CASES}) WHERE pos < ceil(total * CAST(0.1 AS double))"
TRAIN_CASES = f"SELECT * FROM ({RANKED_CASES}) WHERE pos >= ceil(total * CAST(0.1 AS double))"
NEAR = top_sql(f"SELECT row_id AS query_id, embedding FROM ({EVAL_CASES})", f"SELECT row_id AS corpus_id, embedding FROM ({TRAIN_CASES})")
EXAMPLES = f"""SELECT query_id, 'Примеры:' || chr(10) || string_agg('Пример ' || rank || ':' || chr(10) || 'Находка: ' || t.finding || chr(10) || 'Заключение: ' || t.result || chr(10), chr(10) ORDER BY rank) AS examples
FROM ({NEAR}) n JOIN ({TRAIN_CASES}) t ON t.row_id = n.corpus_id GROUP BY query_id"""


@query("examples_gathered", f"SELECT query_id, md5(examples) AS context_md5 FROM ({EXAMPLES})")
def examples_gathered(spark, sf_dir):
    df = cases(spark, sf_dir)
    near = top_k(asked(df).withColumnRenamed("id", "query_id"), known(df), K)
    return X.gather_examples(near, known(df)).select("query_id", F.md5(X.context(F.col("examples"))).alias("context_md5"))


def few_shot_sql(cot: bool, as_json: bool, examples: str) -> str:
    wording = FEW_SHOT_PROMPTS[cot, as_json].format(examples="\x01", organ="\x02", finding="\x03").replace("'", "''")
    wording = braces(wording).replace("\x01", f"', {examples}, '").replace("\x02", "', organ, '")
    return "concat('" + wording.replace("\x03", "', finding, '") + "')"


for cot, as_json in FEW_SHOT_PROMPTS:
    name = f"few_shot_{'steps' if cot else 'plain'}_{'json' if as_json else 'text'}"

    @query(name, f"SELECT row_id AS id, md5({few_shot_sql(cot, as_json, 'x.examples')}) AS prompt_md5 FROM ({EVAL_CASES}) e JOIN ({EXAMPLES}) x ON x.query_id = e.row_id")
    def few_shot(spark, sf_dir, cot=cot, as_json=as_json):
        df = cases(spark, sf_dir)
        style = X.PromptStyle(json_output=as_json, cot=cot, max_examples=K)
        return few_shot_requests(asked(df), known(df), k=K, style=style).select("id", F.md5("prompt").alias("prompt_md5"))


@query("few_shot_without_examples", f"SELECT row_id, md5({few_shot_sql(False, True, chr(39) + NO_EXAMPLES + chr(39))}) AS prompt_md5 FROM (SELECT row_id, origin_folder AS organ, coalesce(finding, '') AS finding FROM ({COMPILED}) c)")
def few_shot_without_examples(spark, sf_dir):
    rows = compiled(spark, sf_dir)
    none = spark.createDataFrame([], "query_id bigint, examples array<struct<finding:string,result:string,score:double>>")
    made = X.with_prompts(rows.withColumnRenamed("row_id", "query_id"), none, organ="origin_folder")
    return made.select(F.col("query_id").alias("row_id"), F.md5("prompt").alias("prompt_md5"))


PAYLOAD = """SELECT doc_id, CAST(json_object('model', 'm-1', 'messages', json_array(json_object('role', 'system', 'content', 'Отвечай кратко'), json_object('role', 'user', 'content', text)),
       'temperature', CAST(0.2 AS double), 'max_tokens', 512) AS string) AS body FROM {documents}"""


@query("request_payload", PAYLOAD)
def request_payload(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", X.payload(F.col("text"), model="m-1", system="Отвечай кратко").alias("body"))


@query("request_payload_structured", f"""SELECT doc_id, json_extract_string(body, '$.messages[0].content') AS content, CAST(json_extract(body, '$.response_format.json_schema.schema.required') AS string) AS required
FROM (SELECT doc_id, json_object('messages', json_array(json_object('content', text)), 'response_format', CAST('{braces(json.dumps(ANSWER_FORMAT))}' AS json)) AS body FROM {{documents}})""")
def request_payload_structured(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    body = X.payload(F.col("text"), model="m-1", structured=True)
    return docs.select(
        "doc_id", F.get_json_object(body, "$.messages[0].content").alias("content"),
        F.get_json_object(body, "$.response_format.json_schema.schema.required").alias("required"),
    )


# ---- encoders and the index ------------------------------------------------------------------
def letter_counts():
    """Stand-in encoder for checks: how often four letters occur."""

    def predict(texts: np.ndarray) -> np.ndarray:
        return np.array([[t.count(c) for c in "aent"] for t in texts], dtype=np.float32)

    return predict


COUNTS = "[" + ", ".join(f"length({{0}}) - length(replace({{0}}, '{c}', ''))" for c in "aent") + "]"


def encoded_sql(source: str, key: str, text: str) -> str:
    counts = COUNTS.format(text)
    return f"""SELECT {key}, i - 1 AS i, round(CAST(CAST(CASE WHEN n > 0 THEN x / n ELSE 0 END AS FLOAT) AS double), 5) AS x FROM (
SELECT {key}, unnest(v) AS x, generate_subscripts(v, 1) AS i, sqrt(list_sum(list_transform(v, lambda y: CAST(y * y AS double)))) AS n
FROM (SELECT {key}, {counts} AS v FROM ({source}) s))"""


@query("texts_encoded", encoded_sql("SELECT * FROM {documents}", "doc_id", "text"))
def texts_encoded(spark, sf_dir):
    made = encode(spread(load(spark, sf_dir, "documents").select("doc_id", "text")), letter_counts)
    return made.select("doc_id", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.round(F.col("x").cast("double"), 5))


@query("texts_encoded_offline")
def texts_encoded_offline(spark, sf_dir):
    texts = spread(load(spark, sf_dir, "documents").select("doc_id", "text"))
    made = encode_offline(texts, fit_offline_encoder(texts))
    return made.select("doc_id", F.size("embedding").alias("size"), F.round(V.norm(F.col("embedding")), 4).alias("length"))


INDEXABLE = f"""SELECT row_id AS vec_id, trim(finding, '{WHITESPACE}') AS finding, trim(result, '{WHITESPACE}') AS result FROM ({COMPILED}) c
WHERE trim(finding, '{WHITESPACE}') <> '' AND trim(result, '{WHITESPACE}') <> '' AND lower(trim(finding, '{WHITESPACE}')) <> 'none' AND lower(trim(result, '{WHITESPACE}')) <> 'none'"""


@query("index_built", f"SELECT x.vec_id, x.i, x.x, s.finding, s.result FROM ({encoded_sql(INDEXABLE, 'vec_id', 'finding')}) x JOIN ({INDEXABLE}) s ON s.vec_id = x.vec_id")
def index_built(spark, sf_dir):
    pairs = compiled(spark, sf_dir).withColumnsRenamed({"finding": "finding_text", "result": "result_text"})
    index = build_index(pairs, lambda df: encode(df, letter_counts, text="finding"), key="row_id")
    folder = fresh_folder(spark, "index")
    save_index(index, folder, model_name="letters")
    loaded, settings = load_index(spark, folder, model_name="letters")
    assert settings["normalize"]
    return loaded.select("vec_id", "finding", "result", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.round(F.col("x").cast("double"), 5))


@query("index_leaves_out_eval_rows", f"SELECT CAST(0 AS bigint) AS leaked, count(*) AS kept FROM ({TRAIN_CASES})")
def index_leaves_out_eval_rows(spark, sf_dir):
    df = cases(spark, sf_dir)
    kept = known(df).select("corpus_id")
    leaked = kept.join(asked(df).select(F.col("id").alias("corpus_id")), "corpus_id", "left_semi").withColumn("l", F.lit(1))
    return kept.join(leaked, "corpus_id", "left").agg(F.count("l").alias("leaked"), F.count("*").alias("kept"))


# ---- rows that need care ---------------------------------------------------------------------------
WITH_NAN = """SELECT vec_id AS {0}, CASE WHEN vec_id % 7 = 0 THEN NULL ELSE embedding END AS embedding FROM {{embeddings}}"""
FAR = "SELECT vec_id AS {0}, list_transform(embedding, lambda x: CAST(x AS double) + 1000000) AS embedding FROM {{embeddings}}"


@query("nearest_with_nan", top_sql(WITH_NAN.format("query_id"), WITH_NAN.format("corpus_id") + " WHERE vec_id % 7 <> 0").replace("WHERE rank <= 5", "WHERE rank <= 5 AND score IS NOT NULL"))
def nearest_with_nan(spark, sf_dir):
    broken = F.transform("embedding", lambda x, i: F.when(i == 3, F.lit(float("nan"))).otherwise(x))
    df = vectors(spark, sf_dir).withColumn("embedding", F.when(F.col("vec_id") % 7 == 0, broken).otherwise(F.col("embedding")))
    return top_k(as_queries(df), as_corpus(df), K)


@query("nearest_by_distance_long_vectors", top_sql(FAR.format("query_id"), FAR.format("corpus_id"), DISTANCE, "ASC"))
def nearest_by_distance_long_vectors(spark, sf_dir):
    df = vectors(spark, sf_dir).withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") + 1e6))
    return top_k(as_queries(df), as_corpus(df), K, normalized=False)


TWO_EXAMPLES = EXAMPLES.replace(" GROUP BY query_id", " WHERE rank <= 2 GROUP BY query_id")


@query("few_shot_two_of_five", f"SELECT row_id AS id, md5({few_shot_sql(False, True, 'x.examples')}) AS prompt_md5 FROM ({EVAL_CASES}) e JOIN ({TWO_EXAMPLES}) x ON x.query_id = e.row_id")
def few_shot_two_of_five(spark, sf_dir):
    df = cases(spark, sf_dir)
    made = few_shot_requests(asked(df), known(df), k=K, style=X.PromptStyle(max_examples=2))
    return made.select("id", F.md5("prompt").alias("prompt_md5"))


@query("rows_without_id_retrieved", "SELECT count(*) AS n, count(*) AS ids, CAST(min(vec_id) AS bigint) AS first_id, CAST(max(vec_id) AS bigint) AS last_id, count(*) * 5 AS neighbours FROM {embeddings}")
def rows_without_id_retrieved(spark, sf_dir):
    df = vectors(spark, sf_dir)
    numbered = with_row_number(df.select("embedding"), out="query_id")
    near = top_k(numbered, as_corpus(df), K)
    asked_ = numbered.select("query_id", F.lit(0).alias("neighbours")).unionByName(near.select("query_id", F.lit(1).alias("neighbours")))
    return asked_.agg(
        F.count_if(F.col("neighbours") == 0).alias("n"), F.count_distinct("query_id").alias("ids"),
        F.min("query_id").alias("first_id"), F.max("query_id").alias("last_id"), F.sum("neighbours").alias("neighbours"),
    )
