"""Tables written in each format and read back."""

from __future__ import annotations

import uuid

from pyspark import TaskContext
from pyspark.sql import functions as F

from queries.preparing import EVAL, TRIM, compiled, ranked_sql
from queries.redaction import DOC_SPANS, REDACTED_SQL, documents
from queries.registry import query
from queries.tables import CHAT, COMPILED, load, spread, table
from reportloom.fixed_values import RESULT_COLUMNS
from reportloom.operators import compiling as C
from reportloom.operators.evaluation import mean_metrics
from reportloom.operators.redaction import redact
from reportloom.operators.reports import folder_counts
from reportloom.operators.split import train_eval_split
from reportloom.plans.anonymise import anonymise_folder
from reportloom.session import fresh_folder
from reportloom.sources import readers as S
from reportloom.sources import writers as K
from reportloom.sources.runs import stage_run, with_run


# What Spark puts in place of characters that a folder name of a partitioned table cannot have.
FOLDER_ESCAPES = {c: f"%{c:02X}" for c in [*range(1, 32), *map(ord, "\"#%'*/:=?\\{[]^"), 127]}


def report_files(spark, sf_dir):
    """One text file per document, below a folder per source.

    Tasks write the files in their place: a table written with a file a row renames every one of them on the driver.
    Names follow from partition and row, so a repeated task writes the same files again.
    """
    root = fresh_folder(spark, "reports")
    docs = spread(load(spark, sf_dir, "documents").select("source", "text"))

    def write(batches):
        files, folder = S.file_system(root)
        task, row, made = TaskContext.get().partitionId(), 0, set()
        for batch in batches:
            for source, text in zip(batch.column("source").to_pylist(), batch.column("text").to_pylist()):
                place = f"{folder}/source={source.translate(FOLDER_ESCAPES) if source else '__HIVE_DEFAULT_PARTITION__'}"
                if place not in made:
                    files.create_dir(place, recursive=True)
                    made.add(place)
                with files.open_output_stream(f"{place}/part-{task:05d}-{row:09d}.txt") as out:
                    out.write(f"{text or ''}\n".encode())
                row += 1
            yield batch.slice(0, 0)

    docs.mapInArrow(write, docs.schema).write.format("noop").mode("overwrite").save()
    return root


@query("report_files_read", "SELECT concat('source=', source) AS folder, md5(concat(text, chr(10))) AS content_md5 FROM {documents}")
def report_files_read(spark, sf_dir):
    found = S.read_text_reports(spark, report_files(spark, sf_dir))
    return found.select(F.substring_index("folder", "/", -1).alias("folder"), F.md5("content").alias("content_md5"))


@query("report_files_by_folder", "SELECT concat('source=', source) AS folder, count(*) AS n_reports FROM {documents} GROUP BY source")
def report_files_by_folder(spark, sf_dir):
    found = S.read_text_reports(spark, report_files(spark, sf_dir))
    return folder_counts(found.withColumn("folder", F.substring_index("folder", "/", -1)))


@query("folder_anonymised", f"{DOC_SPANS}{REDACTED_SQL} SELECT md5(concat(redacted, chr(10))) AS text_md5 FROM redacted")
def folder_anonymised(spark, sf_dir):
    target = fresh_folder(spark, "anonymised-out")
    anonymise_folder(spark, report_files(spark, sf_dir), target)
    return spark.read.parquet(f"{target}/texts").select(F.md5("text").alias("text_md5"))


@query("folder_anonymised_summary", f"{DOC_SPANS} SELECT label, count(*) AS n FROM merged GROUP BY label")
def folder_anonymised_summary(spark, sf_dir):
    target = fresh_folder(spark, "anonymised-out")
    anonymise_folder(spark, report_files(spark, sf_dir), target)
    return spark.read.schema("label string, n bigint").json(f"{target}/summary/labels")


@query("redacted_table_kept", f"{DOC_SPANS}{REDACTED_SQL} SELECT concat('r/', CAST(doc_id AS string), '.pdf') AS rel_path, concat('r/', CAST(doc_id AS string), '.txt') AS out_path, redacted AS text FROM redacted")
def redacted_table_kept(spark, sf_dir):
    folder = fresh_folder(spark, "redacted")
    done = redact(documents(spark, sf_dir)).withColumn("rel_path", F.concat(F.lit("r/"), "doc_id", F.lit(".pdf")))
    K.write_redacted(done, folder)
    return spark.read.parquet(folder)


PAIR_ROWS = f"SELECT origin_folder AS folder, coalesce(finding, '') AS finding, concat(CAST(row_id AS string), '.txt') AS file_name, coalesce(result, '') AS result FROM ({COMPILED}) c"


def pair_rows(spark, sf_dir):
    return compiled(spark, sf_dir).select(
        F.col("origin_folder").alias("folder"), "finding", F.concat("row_id", F.lit(".txt")).alias("file_name"), "result"
    )


@query("pairs_by_folder_kept", PAIR_ROWS)
def pairs_by_folder_kept(spark, sf_dir):
    folder = fresh_folder(spark, "pairs")
    K.write_pairs_by_folder(pair_rows(spark, sf_dir), folder)
    return S.read_pairs_by_folder(spark, folder)


@query("pairs_kept", f"SELECT finding, file_name, result FROM ({PAIR_ROWS})")
def pairs_kept(spark, sf_dir):
    folder = fresh_folder(spark, "pairs")
    K.write_pairs(pair_rows(spark, sf_dir), folder)
    return S.read_csv(spark, folder)


@query("compiled_kept", f"SELECT folder AS origin_folder, 'КТ' AS modality, file_name, finding, result, (SELECT count(*) FROM {{documents}}) AS written FROM ({PAIR_ROWS})")
def compiled_kept(spark, sf_dir):
    folder = fresh_folder(spark, "compiled")
    rows = pair_rows(spark, sf_dir).withColumn("path", F.concat(F.lit("/x/ct_2024/"), "folder", F.lit("/processed_result.csv")))
    united = C.union_tables([C.with_origin(rows).drop("path", "folder")])
    written = K.write_compiled(united, folder, spark)
    return S.read_csv(spark, folder).withColumn("written", F.lit(written).cast("bigint"))


@query("inference_rows_from_csv", f"SELECT CAST(file_name AS string) AS id, folder AS organ, finding, result AS reference FROM ({PAIR_ROWS})")
def inference_rows_from_csv(spark, sf_dir):
    folder = fresh_folder(spark, "rows")
    pair_rows(spark, sf_dir).write.options(**K.CSV_OPTIONS).csv(folder)
    rows = S.read_rows(spark, folder, columns={"id": "file_name", "organ": "folder", "reference": "result"})
    return rows.drop("modality")


@query("chat_lines_kept", f"SELECT trim(prompt_text, {TRIM}) AS asked, trim(result_text, {TRIM}) AS answered FROM ({CHAT}) c")
def chat_lines_kept(spark, sf_dir):
    folder = fresh_folder(spark, "chat")
    K.write_jsonl(C.chat_messages(table(spark, sf_dir, CHAT)).select("messages"), folder)
    back = S.read_jsonl(spark, folder, "messages array<struct<role:string,content:string>>")
    return C.training_messages(back).select(F.col("messages")[0]["content"].alias("asked"), F.col("messages")[1]["content"].alias("answered"))


@query("splits_kept", f"SELECT doc_id, {EVAL} AS split FROM ({ranked_sql('SELECT doc_id FROM {documents}', 'doc_id')})")
def splits_kept(spark, sf_dir):
    folder = fresh_folder(spark, "splits")
    K.write_splits(train_eval_split(load(spark, sf_dir, "documents").select("doc_id"), key="doc_id"), folder)
    parts = S.read_splits(spark, folder)
    return parts["train"].withColumn("split", F.lit("train")).unionByName(parts["eval"].withColumn("split", F.lit("eval")))


@query("old_eval_part_removed", "SELECT CAST(count(*) AS bigint) AS train_rows, CAST(0 AS bigint) AS eval_parts FROM {documents}")
def old_eval_part_removed(spark, sf_dir):
    folder = fresh_folder(spark, "splits")
    docs = load(spark, sf_dir, "documents").select("doc_id")
    K.write_splits(train_eval_split(docs, key="doc_id"), folder)
    K.write_splits(train_eval_split(docs, key="doc_id", enabled=False), folder)
    parts = S.read_splits(spark, folder)
    return parts["train"].agg(F.count("*").alias("train_rows")).withColumn("eval_parts", F.lit(int("eval" in parts)).cast("bigint"))


@query("runs_appended", "SELECT CAST(event_id AS string) AS event_id, printf('%.4f', value) AS value, run_id FROM {events}, (SELECT unnest(['a', 'b']) AS run_id)")
def runs_appended(spark, sf_dir):
    folder = fresh_folder(spark, "runs")
    rows = load(spark, sf_dir, "events").select("event_id", F.format_string("%.4f", "value").alias("value"))
    for run_id in ("a", "b"):
        K.append_csv(rows, folder, run_id=run_id)
    return S.read_csv_runs(spark, folder)


@query("runs_appended_again", """SELECT CAST(event_id AS string) AS event_id, printf('%.4f', CASE run_id WHEN 'a' THEN value + 1 ELSE value END) AS value, run_id
FROM {events}, (SELECT unnest(['a', 'b']) AS run_id)""")
def runs_appended_again(spark, sf_dir):
    """Run a is done twice with other values, run b breaks off after its rows were written and is done again."""
    folder = fresh_folder(spark, "runs")
    events = load(spark, sf_dir, "events")
    rows = events.select("event_id", F.format_string("%.4f", "value").alias("value"))
    K.append_csv(rows, folder, run_id="a")
    stage_run(with_run(rows, "b"), folder, lambda df, path: df.write.options(**K.CSV_OPTIONS).csv(path))
    K.append_csv(rows, folder, run_id="b")
    K.append_csv(events.select("event_id", F.format_string("%.4f", F.col("value") + 1).alias("value")), folder, run_id="a")
    return S.read_csv_runs(spark, folder)


@query("summary_kept", "SELECT round(avg(value), 6) AS mean FROM {events}")
def summary_kept(spark, sf_dir):
    folder = fresh_folder(spark, "summary")
    K.write_summary(mean_metrics(load(spark, sf_dir, "events"), {"mean": "value"}).withColumn("mean", F.round("mean", 6)), folder)
    return spark.read.schema("mean double").json(folder)


def renamed_parts(spark, folder, name):
    """Give the one CSV part of every directory in ``folder`` a name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for child in files.listStatus(path):
        if child.isDirectory():
            part = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(child.getPath(), "part-*.csv"))[0].getPath()
            files.rename(part, spark._jvm.org.apache.hadoop.fs.Path(child.getPath(), name))


@query("result_tables_compiled", """SELECT concat('source=', source) AS origin_folder, 'КТ' AS modality, CAST(doc_id AS string) AS file_name,
       CASE WHEN source IN ('src1', 'src2') THEN '' ELSE text END AS finding, CASE WHEN source IN ('src1', 'src2') THEN text ELSE '' END AS result FROM {documents}""")
def result_tables_compiled(spark, sf_dir):
    root = fresh_folder(spark, "tables")
    docs = spread(load(spark, sf_dir, "documents"))
    for folder, text, sources, name in [("ct_1", "result", ["src1", "src2"], "Processed_Results.CSV"), ("ct_2", "finding", None, "processed_result.csv")]:
        own = docs.filter(F.col("source").isin("src1", "src2") if sources else ~F.col("source").isin("src1", "src2"))
        rows = own.select("source", F.col("doc_id").cast("string").alias("file_name"), F.col("text").alias(text))
        rows.repartition("source").write.partitionBy("source").options(**K.CSV_OPTIONS).csv(f"{root}/{folder}")
        renamed_parts(spark, f"{root}/{folder}", name)
    return S.compile_result_tables(spark, root)


def many_headers(spark, sf_dir):
    """A result table per document: its columns and their order follow from the document, so that headers differ in
    thousands of ways; one name holds a line break."""
    root = fresh_folder(spark, "headers")
    docs = spread(load(spark, sf_dir, "documents").select("doc_id", "lang", "source"))

    def write(batches):
        files, folder = S.file_system(root)
        for batch in batches:
            for doc_id, lang, source in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "source"))):
                mixed = doc_id * 40503 % 65536
                names = [f"c{i}" for i in range(HEADER_COLUMNS) if mixed >> i & 1] + ["doc_id", 'a "b"\nc']
                names = names[mixed % len(names):] + names[:mixed % len(names)]
                cells = [str(doc_id) if n == "doc_id" else f"{n[:2]}, {lang or ''}" for n in names]
                place = f"{folder}/ct_{doc_id % 7}/{source}/d{doc_id}"
                files.create_dir(place, recursive=True)
                with files.open_output_stream(f"{place}/processed_result.csv") as out:
                    out.write("".join(",".join('"' + v.replace('"', '""') + '"' for v in row) + "\r\n" for row in (names, cells)).encode())
            yield batch

    docs.mapInArrow(write, docs.schema).write.format("noop").mode("overwrite").save()
    return root


HEADER_COLUMNS = 14
_CELLS = ", ".join(f"CASE WHEN ((doc_id * 40503 % 65536) >> {i}) % 2 = 1 THEN 'c{str(i)[:1]}, ' || coalesce(lang, '') ELSE '' END AS c{i}" for i in range(HEADER_COLUMNS))


@query("many_headers_compiled", f"""SELECT 'd' || doc_id AS origin_folder, upper(source) AS modality, 'a , ' || coalesce(lang, '') AS "a ""b""\nc", {_CELLS},
       CAST(doc_id AS string) AS doc_id FROM {{documents}}""")
def many_headers_compiled(spark, sf_dir):
    return S.compile_result_tables(spark, many_headers(spark, sf_dir))


@query("tree_listed", """SELECT concat('ct_', doc_id % 7) AS top, source, count(*) AS files, min('d' || doc_id) AS first, max('d' || doc_id) AS last
FROM {documents} GROUP BY ALL""")
def tree_listed(spark, sf_dir):
    """A tree of a folder per document, three levels deep."""
    found = S.list_files(spark, many_headers(spark, sf_dir))
    part = lambda i: F.element_at(F.split("path", "/"), i)
    return found.where("size > 0 AND error IS NULL").groupBy(part(-4).alias("top"), part(-3).alias("source")).agg(
        F.count(F.lit(1)).alias("files"), F.min(part(-2)).alias("first"), F.max(part(-2)).alias("last"))


@query("empty_and_other_files_listed", """SELECT concat('source=', source) AS folder, CASE WHEN source = 'src4' THEN 'failed' WHEN source = 'src5' THEN 'skipped' ELSE 'ok' END AS status,
       CASE WHEN source NOT IN ('src4', 'src5') THEN md5(CASE WHEN source = 'src3' THEN '' ELSE concat(text, chr(10)) END) END AS content_md5 FROM {documents}""")
def empty_and_other_files_listed(spark, sf_dir):
    root = fresh_folder(spark, "reports")
    docs = spread(load(spark, sf_dir, "documents").select("source", "text"))
    ending = {"src4": ".pdf", "src5": ".xlsx"}

    def write(batches):
        files, folder = S.file_system(root)
        for batch in batches:
            for source, text in zip(batch.column("source").to_pylist(), batch.column("text").to_pylist()):
                files.create_dir(f"{folder}/source={source}", recursive=True)
                with files.open_output_stream(f"{folder}/source={source}/{uuid.uuid4().hex}{ending.get(source, '.txt')}") as out:
                    out.write(b"" if source == "src3" else f"{text}\n".encode())
            yield batch

    docs.mapInArrow(write, docs.schema).write.format("noop").mode("overwrite").save()
    found = S.read_report_files(spark, root)
    return found.select(F.substring_index("folder", "/", -1).alias("folder"), "status", F.md5("content").alias("content_md5"))


@query("folder_names_kept", "SELECT DISTINCT printf('%03d', event_id % 50) AS folder, CAST(1 AS bigint) AS rows FROM {events}")
def folder_names_kept(spark, sf_dir):
    folder = fresh_folder(spark, "pairs")
    names = load(spark, sf_dir, "events").select(F.format_string("%03d", F.col("event_id") % 50).alias("folder")).distinct()
    K.write_pairs_by_folder(names.select("folder", *[F.lit("x").alias(c) for c in RESULT_COLUMNS]), folder)
    return S.read_pairs_by_folder(spark, folder).groupBy("folder").agg(F.count(F.lit(1)).alias("rows"))
