"""From per-folder result tables to prompt, chat and retrieval tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.fixed_values import NA_TEXTS, PROMPTS
from reportloom.functions.modality import folder_modality, modality, modality_hint, path_part
from reportloom.functions.text import fill, has_text, or_empty, strip
from reportloom.operators.split import number_rows, three_way_split, with_row_number, written

ORIGIN = ["origin_folder", "modality"]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks {', '.join(missing)} among {df.columns}")
    return df


def with_origin(df: DataFrame, *, path: str = "path") -> DataFrame:
    """Organ folder and modality from the path of the file a row came from."""
    return df.withColumn("origin_folder", path_part(F.col(path), 2)).withColumn(
        "modality", folder_modality(path_part(F.col(path), 3))
    )


def header_union(headers: Sequence[Sequence[str]]) -> list[str]:
    """Origin columns first, then all other non-blank names in sorted order."""
    names = {name for header in headers for name in header if name and name.strip()}
    return ORIGIN + sorted(names - set(ORIGIN))


def distinct_names(names: Sequence[str]) -> dict[str, str]:
    """Column names of a table whose names must differ in more than case: a later one gets a number behind it."""
    taken: dict[str, int] = {}
    out = {}
    for name in names:
        taken[name.lower()] = count = taken.get(name.lower(), 0) + 1
        out[name] = name if count == 1 else f"{name}__{count}"
    return out


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Bag union by exact name; absent columns and missing cells become empty strings.

    Names that differ in case only are columns of their own, see ``distinct_names``.
    """
    if not tables:
        raise ValueError("no table to union")
    columns = distinct_names(header_union([t.columns for t in tables]))
    result = None
    for t in tables:
        places = t.toDF(*[f"__{i}" for i in range(len(t.columns))])
        at = {name: f"__{i}" for i, name in enumerate(t.columns)}
        aligned = places.select(*[or_empty(F.col(at[c])).alias(out) if c in at else F.lit("").alias(out) for c, out in columns.items()])
        result = aligned if result is None else result.unionByName(aligned)
    return result


def na_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Texts an inferring CSV reader takes for missing become NULL."""
    chosen = columns or [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(NA_TEXTS), F.col(c)) for c in chosen})


def look_up(df: DataFrame, column: str, names: Mapping[str, str] | DataFrame, *, out: str) -> DataFrame:
    """Replace values found in a dictionary, keep the others; the number of rows stays.

    A mapping or a two-column table (k, v) is joined, and Spark decides from its size whether to
    broadcast it. Of several values for one key the smallest counts; NULL keys match nothing.
    """
    if not isinstance(names, DataFrame):
        names = df.sparkSession.createDataFrame(list(names.items()), "k string, v string")
    table = names.select(F.col(names.columns[0]).alias("__k"), F.col(names.columns[1]).alias("__v"))
    single = table.groupBy("__k").agg(F.min("__v").alias("__v"))
    joined = df.join(single, df[column] == F.col("__k"), "left")
    return joined.withColumn(out, F.coalesce("__v", column)).drop("__k", "__v")


def first_filled(*values: Column) -> Column:
    """First value that is neither NULL nor empty, else the last one."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values[:-1]], values[-1])


def prompt_columns(df: DataFrame, *, organ: str = "organ", finding: str = "finding_text") -> dict[str, Column]:
    return {"organ": F.col(organ), "finding": F.col(finding), "modality": modality_hint(F.col(finding))}


def prompt(kind: str, form: str, fields: Mapping[str, Column]) -> Column:
    """One of the three prompt wordings ("simple", "medium", "cot") as "text" or "json"."""
    return fill(PROMPTS[kind, form], **fields)


def answer_json(result: Column) -> Column:
    """Single-quoted object as the training format has it; not escaped, so not always valid JSON."""
    return F.concat(F.lit("{'result': '"), or_empty(result), F.lit("'}"))


def build_prompts(df: DataFrame, *, key: str, columns: Mapping[str, str] | None = None,
                  organs: Mapping[str, str] | DataFrame | None = None, first: float = 0.2, second: float = 0.4,
                  seed: int = 42, cot_enabled: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """Prompt table with exact shares of each prompt kind.

    ``keys`` may give the key column of ``df`` as a table of its own.

    ``columns`` names the organ, finding and result columns of the input.
    Without ``cot_enabled`` the last share gets the medium prompt.
    """
    names = {"organ": "origin_folder", "finding": "finding", "result": "result", **(columns or {})}
    require_columns(df, [key, names["organ"], names["finding"], names["result"], "modality"])
    renamed = df.withColumnsRenamed(
        {names["organ"]: "organ_abbr", names["finding"]: "finding_text", names["result"]: "result_text"}
    )
    mapped = look_up(renamed, "organ_abbr", {} if organs is None else organs, out="organ")
    split = three_way_split(mapped, key=key, first=first, second=second, seed=seed, out="share", keys=keys)
    kind = F.when(F.col("share") == "cot", "cot" if cot_enabled else "medium").otherwise(F.col("share"))
    fields = prompt_columns(split)

    def wording(form: str) -> Column:
        return (
            F.when(F.col("type") == "simple", prompt("simple", form, fields))
            .when(F.col("type") == "cot", prompt("cot", form, fields))
            .otherwise(prompt("medium", form, fields))
        )

    return split.withColumn("type", kind).select(
        key, "type", "modality", "organ", "finding_text", "result_text",
        wording("text").alias("prompt_text"),
        answer_json(F.col("result_text")).alias("result_json"),
        F.to_json(F.struct(or_empty(F.col("result_text")).alias("result"))).alias("result_json_strict"),
        wording("json").alias("prompt_json"),
    )


def usable_pairs(df: DataFrame, *, prompt: str = "prompt_text", answer: str = "result_text") -> DataFrame:
    """Rows with a non-blank prompt and a non-blank answer."""
    return df.filter(has_text(F.col(prompt)) & has_text(F.col(answer)))


def indexable_pairs(df: DataFrame, *, finding: Column, result: Column) -> DataFrame:
    """Trimmed pairs fit for retrieval: non-blank and not the word "none"."""
    pairs = df.withColumn("finding", strip(finding)).withColumn("result", strip(result))
    good = [has_text(F.col(c)) & (F.lower(c) != "none") for c in ("finding", "result")]
    return pairs.filter(good[0] & good[1])


def chat_messages(df: DataFrame, *, prompt: str = "prompt_text", answer: str = "result_text") -> DataFrame:
    """Add ``messages``: a user and an assistant turn, both trimmed."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), strip(F.col(c)).alias("content"))
    return usable_pairs(df, prompt=prompt, answer=answer).withColumn(
        "messages", F.array(turn("user", prompt), turn("assistant", answer))
    )


def retrieval_train_rows(df: DataFrame, *, split: str = "split") -> DataFrame:
    return df.filter(F.col(split) == "train").select(
        *[or_empty(F.col(c)).alias(c) for c in ("organ", "finding_text", "result_text", "modality")]
    )


def retrieval_test_rows(df: DataFrame, *, key: str, seed: int = 42, split: str = "split") -> DataFrame:
    """Eval rows with a dense ``id``; a missing modality is read from the finding.

    Eval rows come first in hash order, so their numbers among all rows are their
    numbers among themselves and the train rows need not be numbered.
    """
    stated = F.nullif(F.col("modality"), F.lit(""))
    held_out = df.filter(F.col(split) == "eval")
    keys = written(held_out.select(key), "eval-keys")
    return number_rows(held_out, key=key, seed=seed, out="id", keys=keys).select(
        "id",
        *[or_empty(F.col(c)).alias(c) for c in ("organ", "finding_text", "result_text")],
        F.coalesce(stated, modality(F.col("finding_text"), fallback="")).alias("modality"),
    )


def training_text(df: DataFrame, template: str = "{prompt}\n\n{response}", *, prompt: str = "prompt_text",
                  answer: str = "result_text") -> DataFrame:
    """One ``text`` column from a template; rows with a NULL field are dropped."""
    return df.dropna(subset=[prompt, answer]).select(
        fill(template, prompt=strip(F.col(prompt)), response=strip(F.col(answer))).alias("text")
    )


def training_messages(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["messages"]).select("messages")


def inference_rows(df: DataFrame, columns: Mapping[str, str] | None = None, *, index: str | None = None) -> DataFrame:
    """Five fixed columns from user-named ones, with fallback names per row.

    A row without an id gets the column ``index``, or else its number in the table, from 0.
    """
    names = {"id": "id", "organ": "organ", "finding": "finding", "reference": "result_text",
             "modality": "modality", **(columns or {})}

    def pick(*candidates: str | None) -> Column:
        present = [F.col(c).cast("string") for c in candidates if c and c in df.columns]
        return F.coalesce(*present, F.lit(""))

    own = names["id"] in df.columns
    if index is None and (not own or not df.filter(F.col(names["id"]).isNull()).isEmpty()):
        df, index = with_row_number(df, out="__number"), "__number"
    finding = pick(names["finding"], "finding_text")
    return df.select(
        pick(names["id"], index).alias("id"),
        pick(names["organ"], "organ_abbr").alias("organ"),
        finding.alias("finding"),
        pick(names["reference"], "result", "result_text").alias("reference"),
        F.coalesce(F.nullif(pick(names["modality"]), F.lit("")), modality(finding)).alias("modality"),
    )


def with_finding(df: DataFrame, *, finding: str = "finding") -> DataFrame:
    return df.filter(has_text(F.col(finding)))
