import pytest
from pyspark.sql import functions as F

from reportloom.functions.modality import extension_of, folder_modality, folder_of, modality, path_part
from reportloom.operators import compiling as C
from reportloom.operators.reports import extracted_pairs, run_summary, text_reports
from reportloom.plans.prepare import prepare


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t"))).first()[0]


@pytest.mark.parametrize("name,want", [("МРТ головы", "МРТ"), (" mri_2 ", "МРТ"), ("kt_1", "КТ"), ("fracture", "КТ"), ("Рентген", "РЕНТГЕН"), ("", ""), (None, "")])
def test_folder_modality(spark, name, want):
    assert one(spark, name, folder_modality) == want


def test_text_modality_with_fallback(spark):
    assert one(spark, "кт органов", modality) == "КТ"
    assert one(spark, "узи", lambda c: modality(c, fallback="")) == ""


def test_paths(spark):
    path = "/root/КТ/печень/отчёт.v1.TXT"
    assert one(spark, path, lambda c: path_part(c, 1)) == "отчёт.v1.TXT"
    assert one(spark, path, lambda c: path_part(c, 9)) == ""
    assert one(spark, path, folder_of) == "/root/КТ/печень"
    assert one(spark, path, extension_of) == "txt"
    assert one(spark, "/a/.hidden", extension_of) == "" == one(spark, "/a/plain", extension_of)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="lacks b"):
        C.require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"])


def test_header_union():
    assert C.header_union([["result", "finding"], ["modality", " ", "a"], []]) == ["origin_folder", "modality", "a", "finding", "result"]


def test_look_up_by_map_and_by_table(spark):
    df = spark.createDataFrame([("гм",), ("zz",), (None,)], "o string")
    table = spark.createDataFrame([("гм", "головной мозг")], "k string, v string")
    for names in ({"гм": "головной мозг"}, table):
        assert sorted((r.x or "") for r in C.look_up(df, "o", names, out="x").collect()) == ["", "zz", "головной мозг"]
    assert C.look_up(df, "o", {}, out="x").count() == 3
    large = {f"k{i}": f"v{i}" for i in range(5000)} | {"zz": "там"}
    assert sorted((r.x or "") for r in C.look_up(df, "o", large, out="x").collect()) == ["", "гм", "там"]
    twice = spark.createDataFrame([("гм", "б"), ("гм", "а"), (None, "x")], "k string, v string")
    assert sorted((r.x or "") for r in C.look_up(df, "o", twice, out="x").collect()) == ["", "zz", "а"]


def compiled(spark, n=40):
    rows = [(i, "гм", "МРТ" if i % 2 else None, f"МР {i}" if i % 3 else f"{i}", f"it's {i}" if i % 5 else " ") for i in range(n)]
    return spark.createDataFrame(rows, "row_id int, origin_folder string, modality string, finding string, result string")


def test_prompts(spark):
    rows = C.build_prompts(compiled(spark), key="row_id", organs={"гм": "головной мозг"}).collect()
    kinds = [r.type for r in rows]
    assert (kinds.count("simple"), kinds.count("medium")) == (8, 32)
    row = next(r for r in rows if r.type == "simple" and r.finding_text.startswith("МР") and r.result_text.strip())
    assert row.prompt_text.endswith(f"Орган: головной мозг\nНаходка: {row.finding_text}\n\nОтвет:")
    assert row.result_json == "{'result': '" + row.result_text + "'}"
    assert row.result_json_strict == '{"result":"' + row.result_text + '"}'
    assert "{'result': '...'}" in row.prompt_json
    medium = next(r for r in rows if r.type == "medium" and not r.finding_text.startswith("МР"))
    assert "Исследование: КТ." in medium.prompt_text
    with_steps = C.build_prompts(compiled(spark), key="row_id", cot_enabled=True)
    assert {r.type: r.n for r in with_steps.groupBy("type").agg(F.count("*").alias("n")).collect()} == {"simple": 8, "medium": 13, "cot": 19}
    with pytest.raises(ValueError):
        C.build_prompts(compiled(spark).drop("modality"), key="row_id")


def test_prepare(spark):
    chat = prepare(compiled(spark), key="row_id")
    usable = 32
    assert chat.count() == usable
    train, test = C.retrieval_train_rows(chat), C.retrieval_test_rows(chat, key="row_id")
    assert (train.count(), test.count()) == (28, 4)
    assert {r.id for r in test.collect()} == set(range(4))
    assert {r.modality for r in test.collect()} <= {"МРТ", ""}
    turns = chat.select("messages").first().messages
    assert [t.role for t in turns] == ["user", "assistant"] and turns[1].content.startswith("it's")
    with pytest.raises(ValueError):
        prepare(compiled(spark).withColumn("result", F.lit("")), key="row_id")


def test_training_text(spark):
    df = spark.createDataFrame([(" a ", "b"), (None, "c"), ("d", None)], "prompt_text string, result_text string")
    assert [r.text for r in C.training_text(df).collect()] == ["a\n\nb"]
    assert [r.text for r in C.training_text(df, "<{prompt}|{response}>{{x}}").collect()] == ["<a|b>{x}"]


def test_inference_rows(spark):
    df = spark.createDataFrame([(7, None, "печень", "МРТ: киста", None, None), (8, "x", None, None, "кт", "ref")],
                               "n int, uid string, organ_abbr string, finding_text string, finding string, result string")
    rows = C.inference_rows(df, {"id": "uid", "finding": "finding"}, index="n").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("7", "печень", "МРТ: киста", "", "МРТ"), ("x", "", "кт", "ref", "КТ")]


def test_extraction_keeps_failed_reports(spark):
    reports = text_reports(spark.createDataFrame(
        [(1, "/a/x.txt", "t"), (2, "/a/y.txt", "t"), (3, "/b/z.txt", "t"), (4, "/b/w.txt", ""), (5, "/b/v.pdf", "t")],
        "id int, path string, content string"))
    answers = spark.createDataFrame([(1, '{"finding": "F", "conclusion": "C"}'), (2, "oops"), (3, None)], "id int, content string")
    rows = {r.id: (r.finding, r.result, r.file_name, r.status) for r in extracted_pairs(reports, answers, key="id").collect()}
    assert rows == {1: ("F", "C", "x.txt", "ok"), 2: ("", "", "y.txt", "ok"), 3: ("", "", "z.txt", "failed")}
    assert tuple(run_summary(reports, answers.filter("id < 3"), key="id").first()) == (3, 2, 1, 1)
