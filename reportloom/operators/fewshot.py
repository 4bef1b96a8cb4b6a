"""Few-shot requests: retrieved examples, prompt text, request payload."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.fixed_values import ANSWER_FORMAT, EXAMPLE, EXAMPLES_HEAD, FEW_SHOT_PROMPTS, NO_EXAMPLES
from reportloom.functions.text import fill


@dataclass(frozen=True)
class PromptStyle:
    json_output: bool = True
    cot: bool = False
    max_examples: int = 5


def gather_examples(neighbours: DataFrame, corpus: DataFrame, *, query_id: str = "query_id",
                    corpus_id: str = "corpus_id") -> DataFrame:
    """(query_id, examples): the k neighbours of a query as an array in rank order."""
    example = F.struct("rank", "finding", "result", "score")
    return (
        neighbours.join(corpus.select(corpus_id, "finding", "result"), corpus_id)
        .groupBy(query_id)
        .agg(F.sort_array(F.collect_list(example)).alias("ranked"))
        .select(query_id, F.transform("ranked", lambda e: F.struct(
            e["finding"].alias("finding"), e["result"].alias("result"), e["score"].alias("score")
        )).alias("examples"))
    )


def context(examples: Column) -> Column:
    """Numbered examples under a heading."""
    lines = F.transform(
        examples,
        lambda e, i: fill(EXAMPLE, number=(i + 1).cast("string"), finding=e["finding"], result=e["result"]),
    )
    return F.array_join(F.concat(F.array(F.lit(EXAMPLES_HEAD)), lines), "\n")


def few_shot_prompt(organ: Column, finding: Column, examples: Column, style: PromptStyle = PromptStyle()) -> Column:
    shown = F.slice(examples, 1, style.max_examples) if style.max_examples > 0 else F.slice(examples, 1, 0)
    block = F.when(F.coalesce(F.size(examples), F.lit(0)) > 0, context(shown)).otherwise(NO_EXAMPLES)
    return fill(FEW_SHOT_PROMPTS[style.cot, style.json_output], examples=block, organ=organ, finding=finding)


def with_prompts(rows: DataFrame, examples: DataFrame, *, query_id: str = "query_id", organ: str = "organ",
                 finding: str = "finding", style: PromptStyle = PromptStyle()) -> DataFrame:
    """Add ``examples`` and ``prompt``; a row without examples gets the fixed text instead."""
    return rows.join(examples, query_id, "left").withColumn(
        "prompt", few_shot_prompt(F.col(organ), F.col(finding), F.col("examples"), style)
    )


def payload(prompt: Column, *, model: str, temperature: float = 0.2, max_tokens: int = 512,
            system: str | None = None, structured: bool = False) -> Column:
    """Chat request body as JSON text."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    turns = ([turn("system", F.lit(system))] if system else []) + [turn("user", prompt)]
    body = F.to_json(F.struct(
        F.lit(model).alias("model"),
        F.array(*turns).alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(int(max_tokens)).alias("max_tokens"),
    ))
    if not structured:
        return body
    form = json.dumps(ANSWER_FORMAT, ensure_ascii=False, separators=(",", ":"))
    return F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(',"response_format":' + form + "}"))
