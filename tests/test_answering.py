"""A whole evaluation run with a stand-in model whose answers differ from row to row."""

import json
import re

import numpy as np
import pytest

from reportloom.functions.text_scores import lcs_f_score, meteor
from reportloom.plans.answering import SUMMARY, evaluate, infer, summary

ROWS = [(i, ["печень", "почки", "мозг"][i % 3], ["МРТ", "КТ"][i % 2], f"очаг номер {i} в правой доле, признаки {i % 4}", ref, [float(i % 5), 1.0 + i])
        for i, ref in enumerate(["киста почки", "киста печени и почки", "норма", "", "очаг в правой доле", "киста почки"])]
KNOWN = [(100 + i, f"пример {i}", ["киста почки", "норма", "киста правой почки", "очаг в доле"][i % 4], [float(i % 5), 1.0 + i]) for i in range(12)]


def first_example():
    """Answers with the first example's result, and an organ and a modality that depend on it."""
    def score(prompts):
        out = []
        for p in prompts:
            result = re.search(r"Заключение: (.*)", p)[1]
            out.append(json.dumps({"result": result, "has_finding": len(result) % 2 == 0, "organ": "Почки" if "поч" in result else "печень",
                                   "modality": "mri" if "норма" in result else "КТ"}, ensure_ascii=False))
        return out
    return score


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.createDataFrame(ROWS, "id bigint, organ string, modality string, finding string, reference string, embedding array<double>")
    known = spark.createDataFrame(KNOWN, "corpus_id bigint, finding string, result string, embedding array<double>")
    return rows, known


def nearest(vector):
    scores = [(-float(np.dot(vector, v)), k, r) for k, _, r, v in KNOWN]
    return min(scores)[2]


def test_evaluation_columns(tables):
    got = {r.id: r for r in evaluate(*tables, first_example, k=3).collect()}
    assert set(got) == {r[0] for r in ROWS}
    for id_, organ, modality, finding, reference, vector in ROWS:
        r, said = got[id_], nearest(vector)
        assert (r.predicted_result, r.is_exact_match) == (said, int(said == reference))
        assert r.rouge == pytest.approx(lcs_f_score(reference, said)) and r.meteor == pytest.approx(meteor(reference, said))
        assert (r.bleu > 0) == bool(set(reference.split()) & set(said.split()))
        assert r.acc_organ_exact == int(organ == ("почки" if "поч" in said else "печень"))
        assert r.acc_modality == int(modality == ("МРТ" if "норма" in said else "КТ"))
        assert r.acc_has_finding == int((len(finding) > 15) == (len(said) % 2 == 0))
    assert {r.is_exact_match for r in got.values()} == {0, 1} or any(r.bleu > 0 for r in got.values())


def test_summary_is_the_mean_of_all_columns(tables):
    rows = evaluate(*tables, first_example, k=3)
    means, each = summary(rows).first().asDict(), rows.collect()
    assert means == {name: pytest.approx(np.mean([float(r[column]) for r in each])) for name, column in SUMMARY.items()}
    assert sum(v > 0 for v in means.values()) >= 5


def test_inference_scores_nothing_without_a_reference(tables):
    got = {r.id: r for r in infer(*tables, first_example, k=3).collect()}
    assert all(v == 0.0 for v in got[3].metrics.asDict().values())
    for id_, _, _, _, reference, vector in ROWS:
        if reference:
            assert got[id_].metrics.rouge == pytest.approx(lcs_f_score(reference, nearest(vector)))


def test_a_log_of_answers_changes_nothing_and_is_not_asked_past(tables, tmp_path):
    log, shown = str(tmp_path / "log"), ["id", "predicted_result", "bleu", "rouge", "acc_modality"]

    def never():
        raise AssertionError("asked again")

    want = sorted(evaluate(*tables, first_example, k=3).select(*shown).collect())
    assert sorted(evaluate(*tables, first_example, k=3, log=log, asker="m").select(*shown).collect()) == want
    assert sorted(evaluate(*tables, never, k=3, log=log, asker="m").select(*shown).collect()) == want
