"""Parsing of model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.functions.text import let, or_empty, strip

_STRICT = {"allowSingleQuotes": "false"}


def unfenced(content: Column) -> Column:
    """Content without a leading ```json fence, a trailing fence and outer whitespace."""
    head = F.regexp_replace(strip(content), r"\A```json", "")
    return strip(F.regexp_replace(head, r"```\z", ""))


def json_object(content: Column, fields: str) -> Column:
    """The content as ``struct<fields>``, or NULL unless it is exactly one JSON object.

    Read as an array of one element: ``from_json`` alone ignores text after a first object.
    """
    wrapped = F.from_json(F.concat(F.lit("["), content, F.lit("]")), f"array<struct<{fields}>>", _STRICT)
    alone = let(wrapped, lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))))
    return F.when(content.startswith("{"), alone)


def parse_redaction(content: Column) -> Column:
    """``struct<text, spans>`` of a redaction answer.

    Content that is no JSON object counts as the text itself, without spans; NULL stays NULL.
    """
    spans = "array<struct<start:int,end:int,label:string,text:string>>"
    none = F.array().cast("array<struct<start:int,end:int,label:string,original:string>>")

    def build(body: Column) -> Column:
        return let(
            json_object(body, f"text:string,spans:{spans}"),
            lambda o: F.struct(
                F.when(o.isNull(), body).otherwise(o["text"]).alias("text"),
                F.coalesce(
                    F.transform(o["spans"], lambda s: F.struct(
                        s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"),
                        F.coalesce(s["text"], F.substring(o["text"], s["start"] + 1, s["end"] - s["start"]))
                        .alias("original"),
                    )),
                    none,
                ).alias("spans"),
            ),
        )

    return F.when(content.isNotNull(), let(unfenced(content), build))


def _truth(text: Column) -> Column:
    """JSON scalar as a boolean: false, null, missing, "", 0 and "false" are false."""
    return F.coalesce(~F.lower(strip(text)).isin("false", "", "0", "0.0", "null", "none"), F.lit(False))


def parse_answer(content: Column, expect_json: bool = True) -> Column:
    """``struct<text, result, reasoning, has_finding, organ, modality>`` of an answer.

    Plain mode, content that is no JSON object and a blank ``result`` all give the
    trimmed content as the result; the class fields are NULL unless an object was read.
    """
    trimmed = strip(F.coalesce(content, F.lit("")))
    nothing = F.lit(None).cast("string")
    if not expect_json:
        return let(trimmed, lambda t: F.struct(
            t.alias("text"), t.alias("result"), nothing.alias("reasoning"),
            F.lit(None).cast("boolean").alias("has_finding"), nothing.alias("organ"), nothing.alias("modality"),
        ))

    def build(t: Column) -> Column:
        fields = "result:string,reasoning:string,has_finding:string,organ:string,modality:string"
        return let(
            json_object(unfenced(t), fields),
            lambda o: F.struct(
                t.alias("text"),
                F.coalesce(F.nullif(strip(o["result"]), F.lit("")), t).alias("result"),
                o["reasoning"].alias("reasoning"),
                F.when(o.isNotNull(), _truth(o["has_finding"])).alias("has_finding"),
                o["organ"].alias("organ"),
                o["modality"].alias("modality"),
            ),
        )

    return let(trimmed, build)


def parse_extraction(content: Column) -> Column:
    """``struct<finding, conclusion>``; anything unreadable gives empty strings."""
    return let(
        json_object(strip(content), "finding:string,conclusion:string"),
        lambda o: F.struct(or_empty(o["finding"]).alias("finding"), or_empty(o["conclusion"]).alias("conclusion")),
    )
