"""Input tables of the registered queries.

The texts below are valid in Spark SQL and in standard SQL alike; ``{name}`` marks a
given table. Every one covers all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = ["documents", "conversations", "embeddings", "pages", "events", "customer", "labels"]

REPORTS = """
SELECT doc_id AS report_id,
       concat('/data/', CASE lang WHEN 'en' THEN 'MRT_2024' WHEN 'de' THEN 'kt_archive' WHEN 'fr' THEN 'КТ' ELSE 'xray' END,
              '/', source, '/', cast(doc_id AS string),
              CASE source WHEN 'src0' THEN '.PDF' WHEN 'src1' THEN '.xlsx' ELSE '.txt' END) AS path,
       CASE source WHEN 'src5' THEN '' WHEN 'src6' THEN NULL ELSE text END AS content
FROM {documents}
"""

PEOPLE = """
SELECT c_custkey AS report_id, 'Пациент № ' AS part0,
       concat('u', cast(c_custkey AS string), '@mail.example.com') AS email,
       concat('912', ' ', lpad(cast(c_custkey % 1000 AS string), 3, '0'), ' ', lpad(cast(c_custkey % 97 AS string), 2, '0')) AS phone,
       concat(lpad(cast(1 + c_custkey % 28 AS string), 2, '0'), '.0', cast(1 + c_custkey % 9 AS string), '.', cast(1940 + c_custkey % 60 AS string)) AS dob,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'ул. Ленина' WHEN 'MACHINERY' THEN 'проспект Мира' ELSE 'пер. Садовый' END AS address,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Иванов И.И.' WHEN 'MACHINERY' THEN 'Петров П. С.' ELSE 'Ёлкина А.Б.' END AS person,
       concat('полис: ', lpad(cast(c_custkey AS string), 10, '0')) AS policy,
       concat('123-456-', lpad(cast(c_custkey % 1000 AS string), 3, '0'), ' ', lpad(cast(c_custkey % 97 AS string), 2, '0')) AS snils,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'ООО Диагност-1' WHEN 'MACHINERY' THEN 'Клиника Здоровье' ELSE 'ФГБУ' END AS org,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'г. Москва' WHEN 'MACHINERY' THEN 'город Тверь' ELSE 'г  Омск' END AS place
FROM {customer}
"""

NOTES = f"""
SELECT p.*, concat(part0, email, '; ', phone, '; Дата рождения: ', dob, '; ', address, '; конец') AS text,
       concat('Врач ', person, 'Осмотр; ', policy, '; ', snils, '; ', org, '; ', place, '; конец') AS long_text
FROM ({PEOPLE}) p
"""

COMPILED = """
SELECT doc_id AS row_id, source AS origin_folder,
       CASE lang WHEN 'en' THEN 'МРТ' WHEN 'de' THEN 'КТ' ELSE NULL END AS modality,
       CASE source WHEN 'src3' THEN NULL WHEN 'src7' THEN '' WHEN 'src11' THEN 'None' WHEN 'src13' THEN '   '
            ELSE concat(CASE lang WHEN 'en' THEN 'МР-картина: ' ELSE '' END, text) END AS finding,
       CASE source WHEN 'src5' THEN NULL WHEN 'src9' THEN 'none' ELSE text END AS result
FROM {documents}
"""

CHAT = """
SELECT u.conv_id AS conv_id, u.turn AS turn, u.text AS prompt_text, a.text AS result_text
FROM {conversations} u JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
"""

RESPONSES = """
SELECT event_id AS req_id,
       CASE WHEN event_type = 'signup' AND value < 5 THEN concat('{{"result": "R', cast(event_id AS string), '", "has_finding": true, "organ": "печень", "modality": "МРТ"}}')
            WHEN event_type = 'signup' THEN concat('```json', chr(10), '{{"result": "R', cast(event_id AS string), '", "has_finding": false}}', chr(10), '```')
            WHEN event_type = 'purchase' AND value < 5 THEN 'plain text, not JSON'
            WHEN event_type = 'purchase' THEN '{{"result": "", "organ": null}}'
            WHEN event_type = 'error' AND value < 5 THEN '[1, 2]'
            WHEN event_type = 'error' THEN '{{"has_finding": "false", "modality": "ct"}}'
            WHEN event_type = 'view' THEN '  {{"result": "trimmed", "reasoning": "r"}}  '
            ELSE NULL END AS content
FROM {events}
"""

PAIRS = """
SELECT d.doc_id AS id, d.text AS reference,
       CASE d.lang WHEN 'en' THEN replace(d.text, 'th', 'z') WHEN 'de' THEN concat('  ', d.text, ' ')
            WHEN 'fr' THEN concat(d.text, ' ', coalesce(n.text, '')) ELSE coalesce(n.text, '') END AS predicted
FROM {documents} d LEFT JOIN {documents} n ON n.doc_id = d.doc_id + 1
"""

ORGANS = {"src0": "брюшная полость", "src1": "головной мозг", "src2": "малый таз"}

# Documents that have a vector: what retrieval works on.
CASES = """
SELECT d.doc_id AS row_id, d.source AS organ, d.lang AS modality, d.text AS finding, concat('Итог: ', d.text) AS result,
       e.embedding AS embedding
FROM {documents} d JOIN {embeddings} e ON e.vec_id = d.doc_id
"""


def standard(sql: str) -> str:
    """The text for an engine where the given tables are views of the same name."""
    return sql.format(**{n: n for n in NAMES})


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input too small for all cores, dealt out to them; large inputs stay as they are."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the texts above on the tables it names."""
    used = {n: spread(load(spark, sf_dir, n)) for n in NAMES if "{" + n + "}" in sql}
    return spark.sql(sql, **used)


def flat(df: DataFrame) -> DataFrame:
    """Integer columns widened to 64 bit."""
    return df.select(*[F.col(f"`{n}`").cast("bigint").alias(n) if t in ("int", "smallint", "tinyint") else F.col(f"`{n}`")
                       for n, t in df.dtypes])
