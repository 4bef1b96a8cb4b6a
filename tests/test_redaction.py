"""Spans against a plain-Python restatement of the rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from reportloom.fixed_values import LABEL_TOKENS, PII_PATTERNS
from reportloom.functions.pii import DEFAULT_PATTERNS, STRICT_PATTERNS, Pattern, with_user_patterns
from reportloom.functions.text import between, cut, strip, utf8_dropping_bad_bytes, words
from reportloom.operators.redaction import (
    RegexStage, apply_chunk_responses, chunks, counts_by_label, counts_per_text, redact, redact_in_stages, totals,
)

HAND = {
    "Клиника №1": "[ORG]№1",
    "123-456-789 01": "[PHONE]",
    "Иванов И.И. ": "Иванов И.И. ",
    "Иванов И.И.Петров": "[NAME]Петров",
    "Клиника Здоровье, 8 912 345 67 89, 12.03.2020, тел": "[ORG]",
    "😀😀 a@b.com, x 12.03.2020 😀 c@d.org": "😀😀 [EMAIL], x [DATE] 😀 [EMAIL]",
    "": "",
    "нет данных": "нет данных",
    "a@b.com": "[EMAIL]",
}


def expected(text, patterns=PII_PATTERNS, tokens=LABEL_TOKENS):
    spans = []
    for order, (label, regex) in enumerate(patterns):
        spans += [(m.start(), order, m.end(), label, m.group()) for m in re.finditer(regex, text)]
    merged = []
    for start, _, end, label, original in sorted(spans):
        if not merged or start >= merged[-1][1]:
            merged.append([start, end, label, original])
        elif end > merged[-1][1]:
            merged[-1][1] = end
            merged[-1][3] += "|" + original
    out, at = "", 0
    for start, end, label, _ in merged:
        out += text[at:start] + tokens.get(label, f"[{label}]")
        at = end
    return out + text[at:], merged


def check(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for row in redact(df).collect():
        text, spans = expected(row.text)
        assert row.redacted == text
        assert [list(s) for s in row.spans] == spans


def test_hand_rows(spark):
    df = spark.createDataFrame([(t,) for t in HAND], "text string")
    assert {r.text: r.redacted for r in redact(df).collect()} == HAND
    check(spark, list(HAND))


def test_null_text_has_no_spans(spark):
    row = redact(spark.createDataFrame([(None,)], "text string")).first()
    assert row.redacted is None and row.spans == []


def test_random_texts_match_the_plain_rules(spark):
    rng = random.Random(5)
    bits = ["Иванов И.И.", "Петров П. С.", "u1@mail.ru", "8 912 345 67 89", "12.03.2020", "2020-1-5", "март 3, 2020",
            "Дата рождения: 1.2.1980", "полис ОМС: 1234 5678", "123-456-789 01", "ул. Ленина", "г. Москва", "Клиника №1",
            "ООО Ромашка", "😀", "\n", " ", " ", ", ", "; ", "é", "МРТ", "﷐", "слово", "город"]
    check(spark, ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 25))) for _ in range(400)])


def test_addresses_that_touch(spark):
    check(spark, ["a@b.com_x@y.org", "a@b.com.x@y.org", "-a@b.co1@c.de", "a@@b.com", "x@y z@w.com@q.org", "a@b.c a@b.cd@e.fg", "é_a@b.com"])


def test_a_long_run_of_letters_stays_fast(spark):
    blob = "QUJD" * 250_000
    df = spark.createDataFrame([(blob + " a@b.com " + blob + "@c.de",)], "text string")
    row = redact(df, RegexStage([p for p in DEFAULT_PATTERNS if p.label == "EMAIL"])).first()
    assert row.redacted == blob + " [EMAIL] [EMAIL]"


def test_more_matches_than_one_block(spark):
    text = "; ".join(f"u{i}@mail.com, 12.0{i % 9 + 1}.2020" for i in range(900))
    check(spark, [text, "x" * 3000 + " a@b.com " + "y" * 3000])


def test_redacted_text_holds_no_further_match(spark):
    texts = ["a@b.com и 12.03.2020", "тел 8 912 345 67 89", "Дата рождения: 1.2.1980; ул. Ленина"]
    df = redact(spark.createDataFrame([(t,) for t in texts], "text string")).select(F.col("redacted").alias("text"))
    stage = RegexStage([p for p in DEFAULT_PATTERNS if p.label in ("EMAIL", "PHONE", "DATE")])
    assert redact(df, stage).filter("size(spans) > 0").count() == 0


def test_user_pattern_ignores_case_and_gets_its_own_token(spark):
    df = spark.createDataFrame([("Карта № 7 КАРТА № 8",)], "text string")
    assert redact(df, RegexStage(with_user_patterns([("CARD", r"карта № \d")]))).first().redacted == "[CARD] [CARD]"


def test_strict_names(spark):
    df = spark.createDataFrame([("Врач Иванов И.И. принял",)], "text string")
    assert redact(df, RegexStage(STRICT_PATTERNS)).first().redacted == "Врач [NAME] принял"


def test_token_map_can_be_replaced(spark):
    df = spark.createDataFrame([("a@b.com",)], "text string")
    assert redact(df, RegexStage(tokens={"EMAIL": "<mail>"})).first().redacted == "<mail>"


def test_stages_refer_to_their_own_input(spark):
    stages = [RegexStage([Pattern("A", "bb+")]), RegexStage([Pattern("B", r"\[A\]c")])]
    row = redact_in_stages(spark.createDataFrame([("xbbbc",)], "text string"), stages).first()
    assert row.redacted == "x[B]"
    assert [tuple(s) for s in row.spans] == [(0, 1, 4, "A", "bbb"), (1, 1, 5, "B", "[A]c")]
    assert redact_in_stages(spark.createDataFrame([("t",)], "text string"), []).first().redacted == "t"


def test_counts(spark):
    done = redact(spark.createDataFrame([(1, "a@b.com c@d.com"), (2, "12.03.2020 a@b.com"), (3, "-")], "id int, text string"))
    assert {(r.id, r.label, r.n) for r in counts_per_text(done, key="id").collect()} == {
        (1, "EMAIL", 2), (2, "EMAIL", 1), (2, "DATE", 1)}
    assert {(r.label, r.n) for r in counts_by_label(done).collect()} == {("EMAIL", 3), ("DATE", 1)}
    assert tuple(totals(done).first()) == (3, 4)
    assert tuple(totals(done.limit(0)).first()) == (0, 0)


def test_chunks_and_their_responses(spark):
    text = "😀" * 800 + "конец"
    texts = spark.createDataFrame([(1, text), (2, ""), (3, "ab")], "id int, text string")
    assert {(r.id, r.chunk_no, r.chunk_start, r.chunk) for r in chunks(texts, key="id").collect()} == {
        (1, 0, 0, text[:750]), (1, 1, 750, text[750:]), (3, 0, 0, "ab")}
    answers = spark.createDataFrame([(1, 1, '{"text": "T", "spans": [{"start": 2, "end": 4, "label": "NAME"}]}'),
                                     (3, 0, None), (3, 5, "beyond the text")], "id int, chunk_no int, content string")
    answers = answers.union(answers.filter("id = 1"))  # a repeated response counts once
    whole = {r.id: r for r in apply_chunk_responses(texts, answers, key="id").collect()}
    assert whole[1].redacted == text[:750] + "T" and tuple(whole[1].spans[0])[:3] == (752, 754, "NAME")
    assert whole[3].redacted == "ab" and whole[3].spans == [] and whole[2].redacted == ""


def test_piecewise_substring(spark):
    text = "".join(chr(0x400 + i % 64) + "😀" for i in range(30))
    df = spark.createDataFrame([(text,)], "t string")
    pairs = [(a, b) for a in range(0, 60, 7) for b in range(a, 61, 5)]
    got = df.select(*[between(cut(F.col("t"), 8), F.lit(a), F.lit(b), 8).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]).first()
    assert list(got) == [text[a:b] for a, b in pairs]


@pytest.mark.parametrize("raw,want", [(b"ab\xff\xd0c", "abc"), ("я�ю".encode() + b"\xd1", "я�ю"), (b"", ""), ("😀".encode(), "😀")])
def test_bad_bytes_are_dropped(spark, raw, want):
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    assert df.select(utf8_dropping_bad_bytes(F.col("b"))).first()[0] == want == raw.decode("utf-8", errors="ignore")


def test_strip_and_words(spark):
    text = "　\t a b, c_1! \x1f\n"
    row = spark.createDataFrame([(text,)], "t string").select(strip(F.col("t")).alias("s"), words(F.col("t")).alias("w")).first()
    assert row.s == text.strip() and row.w == re.findall(r"\w+|[^\w\s]", text)


def test_every_pattern_runs_once_per_text(spark):
    df = spark.createDataFrame([(1, "a@b.com")], "id int, text string")
    done = redact(df)
    for job in (done, counts_by_label(done), counts_per_text(done, key="id"), totals(done)):
        assert job._jdf.queryExecution().executedPlan().toString().count("regexp_replace(") == len(PII_PATTERNS)
