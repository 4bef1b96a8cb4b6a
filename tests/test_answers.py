import json

import pytest
from pyspark.sql import functions as F

from reportloom.functions.answers import parse_answer, parse_extraction, parse_redaction
from reportloom.functions.markup import html_to_text
from reportloom.functions.similarity import has_finding_hit, modality_hit, organ_hit
from reportloom.operators.fewshot import PromptStyle, few_shot_prompt, payload

RAW = (None, None, None, None)
ANSWERS = {
    '{"result": "r", "reasoning": "w", "has_finding": true, "organ": "o", "modality": "m"}': ("r", "w", True, "o", "m"),
    '```json\n{"result": "r"}\n```': ("r", None, False, None, None),
    '  {"result": " r "} ': ("r", None, False, None, None),
    "text": ("text", *RAW), "[1, 2]": ("[1, 2]", *RAW), '"s"': ('"s"', *RAW), "": ("", *RAW),
    '{"result": "x"} and more': ('{"result": "x"} and more', *RAW),
    "{'result': 'x'}": ("{'result': 'x'}", *RAW), '{"result": "x"': ('{"result": "x"', *RAW),
    '{"result": null, "has_finding": "false"}': ('{"result": null, "has_finding": "false"}', None, False, None, None),
    '{"result": 5, "has_finding": 1, "organ": null}': ("5", None, True, None, None),
    '{"result": "x", "has_finding": "yes"}': ("x", None, True, None, None),
}


def test_answers(spark):
    df = spark.createDataFrame([(a,) for a in ANSWERS], "c string").withColumn("a", parse_answer(F.col("c")))
    got = {r.c: (r.a.result, r.a.reasoning, r.a.has_finding, r.a.organ, r.a.modality) for r in df.collect()}
    assert got == ANSWERS
    row = spark.createDataFrame([(None,)], "c string").select(parse_answer(F.col("c")).alias("a")).first().a
    assert (row.result, row.has_finding) == ("", None)


def test_redaction_answers(spark):
    cases = {'```json\n{"text": "T", "spans": [{"start": 0, "end": 1, "label": "NAME"}]}\n```': ("T", [(0, 1, "NAME", "T")]),
             "plain": ("plain", []), '{"spans": []}': (None, []), '{"text": "x"}': ("x", [])}
    df = spark.createDataFrame([(c,) for c in cases], "c string").withColumn("a", parse_redaction(F.col("c")))
    assert {r.c: (r.a.text, [tuple(s) for s in r.a.spans]) for r in df.collect()} == cases


def test_extraction_answers(spark):
    cases = {'{"finding": "f", "conclusion": "c"}': ("f", "c"), "no": ("", ""), '{"finding": "f"}': ("f", ""), '```json\n{"finding": "f"}\n```': ("", "")}
    df = spark.createDataFrame([(c,) for c in cases], "c string").withColumn("a", parse_extraction(F.col("c")))
    assert {r.c: tuple(r.a) for r in df.collect()} == cases


def test_class_hits(spark):
    df = spark.createDataFrame([(True, True, " Печень", "печень ", "мрт гм", "MRI"), (True, None, "а", None, "кт", None), (False, False, "а", "б", "", "")],
                               "t boolean, p boolean, o string, q string, m string, n string")
    got = df.select(has_finding_hit(F.col("t"), F.col("p")), organ_hit(F.col("o"), F.col("q")), modality_hit(F.col("m"), F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(1, 1, 1), (0, 0, 0), (1, 0, 0)]


def test_few_shot_prompt(spark):
    df = spark.createDataFrame([([("f1", "r1", 0.9), ("f2", "r2", 0.5)],), ([],), (None,)], "e array<struct<finding:string,result:string,score:double>>")
    style = PromptStyle(json_output=False, max_examples=1)
    texts = [r[0] for r in df.select(few_shot_prompt(F.lit("печень"), F.lit("киста"), F.col("e"), style)).collect()]
    assert texts[0] == ("Ты — медицинская LLM. Сформируй краткое заключение по находке.\n\nПримеры:\nПример 1:\nНаходка: f1\nЗаключение: r1\n\n\n"
                        "Орган: печень\nНаходка: киста\n\nОтвет:")
    assert texts[1] == texts[2] and "(нет подходящих примеров)" in texts[1]


@pytest.mark.parametrize("structured", [False, True])
def test_payload(spark, structured):
    text = 'кавычка " и \\ и\nстрока'
    body = spark.createDataFrame([(text,)], "p string").select(payload(F.col("p"), model="m", system="s", structured=structured)).first()[0]
    parsed = json.loads(body)
    assert parsed["messages"] == [{"role": "system", "content": "s"}, {"role": "user", "content": text}]
    assert (parsed["temperature"], parsed["max_tokens"], "response_format" in parsed) == (0.2, 512, structured)


def test_html(spark):
    html = ("<html><head><title>t</title></head><body><!-- c --><script>var a='</p>';</script><h1>A&amp;lt;B</h1><p>x<br/>y &#1082;&#x442; &copy; </p>"
            "<ul><li>one<li>two</ul><table><tr><td>1</td><td>2</td></tr></table>&#0;</body></html>")
    got = spark.createDataFrame([(html,), (None,)], "h string").select(html_to_text(F.col("h")).alias("t")).collect()
    assert got[0].t == "A&lt;B\n\nx\ny кт ©\n\n- one\n- two\n\n1 2\n\n�" and got[1].t is None
