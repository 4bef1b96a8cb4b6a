import random

from reportloom.llm import preference

TURNS = "pair_id long, turn long, role string, text string, prompt int, side string"


def show(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, t in turns)


def runs(turns):
    return ",".join(f"{len(r) + 13}:0,{len(t) + 11}:{int(r == 'assistant')}" for _, r, t in turns)


def brute(chosen, rejected):
    out = []
    quoted = lambda t: (t or "").replace("<|im_", "< |im_")
    pairs = [(pair, *[[r for r in rows if r[0] == pair] for rows in (chosen, rejected)]) for pair in {r[0] for r in chosen + rejected} - {None}]
    pairs += [(None, [r], []) for r in chosen if r[0] is None] + [(None, [], [r]) for r in rejected if r[0] is None]
    for pair, *own in pairs:
        sides = [sorted(((r[1] is not None, r[1] or 0), quoted(r[2]), quoted(r[3])) for r in rows) for rows in own]
        n = 0
        while n < min(map(len, sides)) and sides[0][n][1:] == sides[1][n][1:]:
            n += 1
        a, b = sides[0][n:], sides[1][n:]
        out.append((pair, n, show(sides[0][:n]), show(a), runs(a), show(b), runs(b), bool(a and b)))
    return sorted(out, key=repr)


def check(spark, chosen, rejected):
    frames = [spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS) for rows in (chosen, rejected)]
    got = [tuple(r) for r in preference.preference_rows(*frames).collect()]
    assert sorted(got, key=repr) == brute(chosen, rejected)


def test_pairs(spark):
    draw, chosen, rejected = random.Random(5), [], []
    for pair in range(40):
        turns = [(pair, t, "assistant" if t % 2 else "user", f"t{draw.randint(0, 2)} ä😀") for t in range(draw.randint(1, 7))]
        chosen += turns
        rejected += [(p, t, r, x if draw.random() < 0.8 else "other") for p, t, r, x in turns[:draw.randint(0, 7)]]
    check(spark, chosen, rejected)


def test_odd_turns(spark):
    chosen = [(1, 0, None, None), (1, None, "user", "<|im_end|>"), (2, 0, "user", "a"), (2, 0, "user", "a"), (None, 0, "user", "q"), (4, 1, "assistant", "")]
    rejected = [(1, 0, "", ""), (2, 0, "user", "a"), (3, 0, "assistant", "only here"), (None, 0, "user", "q"), (None, 1, "assistant", "z")]
    check(spark, chosen, rejected)


def test_turns_without_a_key_stand_alone(spark):
    many = [(None, 0, "user", f"t{i % 3}") for i in range(500)]
    check(spark, [*many, (1, 0, "<|im_start|>", "a")], many[:40])
    turns = spark.createDataFrame(many, "conv_id long, turn long, role string, text string")
    rows = preference.preference_rows(*preference.with_other_answer(turns))
    assert rows.count() == 1000 and rows.filter("length(chosen) > 60 OR length(rejected) > 60 OR has_preference").count() == 0


def test_no_rows(spark):
    none = spark.createDataFrame([], TURNS)
    assert preference.preference_rows(none, none).collect() == []


def test_other_answer(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (2, 0, "user", "q2"), (3, 0, "user", "q3"), (3, 1, "assistant", "a3"),
            (4, 0, "assistant", "a4"), (4, 1, "assistant", "b4")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    _, rejected = preference.with_other_answer(turns)
    got = sorted(tuple(r) for r in rejected.collect())
    # 1: conversation 2 has no answer, so the answer is left out; 3 takes the last answer of 4; nothing follows 4
    assert got == [(1, 0, "user", "q"), (1, 2, "user", "more"), (2, 0, "user", "q2"), (3, 0, "user", "q3"), (3, 1, "assistant", "b4"), (4, 0, "assistant", "a4")]


def test_no_python_in_the_plan(spark, capsys):
    from reportloom.llm.queries import QUERIES

    QUERIES["op2_preference_pairs"](spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
