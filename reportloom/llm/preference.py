"""Preference pairs as training text: one shared prompt, two masked completions. DataFrame functions only.

Both sides of a pair meet in one shuffle by the pair's key; everything else happens inside the row. The longest
common prefix of turns (equal role and text) is rendered once as prompt, the turns behind it as completions. A mask
gives the run lengths of characters that count for the loss (assistant texts with their end marker) or do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The turn markers.
TURN = "<|im_start|>"
TURN_END = "<|im_end|>\n"
MARK, MARK_QUOTED = "<|im_", "< |im_"
TRAINED_ROLE = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(TURN), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(TURN_END))


def rendered(turns: Column) -> Column:
    """Turns as text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """``length:flag`` of consecutive characters of the rendered turns, comma-joined; flag 1 counts for the loss."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.length(_head(t)), F.lit(":0,"), F.length(_body(t)), F.when(t["role"] == TRAINED_ROLE, ":1").otherwise(":0"))), ",")


def _side(turns: DataFrame, side: str) -> DataFrame:
    quoted = [F.replace(F.coalesce(c, F.lit("")), F.lit(MARK), F.lit(MARK_QUOTED)).alias(c) for c in ("role", "text")]
    return turns.select("pair_id", F.when(F.col("pair_id").isNull(), F.monotonically_increasing_id()).alias("alone"),
                        F.struct(F.col("turn").cast("long").alias("turn"), *quoted, F.lit(side).alias("side")).alias("t"))


def preference_rows(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, n_common, prompt, chosen, chosen_mask, rejected, rejected_mask, has_preference), one row per pair_id on
    either side.

    Both inputs have pair_id, turn, role, text; other columns are ignored. Turns are ordered by turn (NULL first), then
    role and text; repeated turns stay. NULL roles and texts are empty. A side without turns is an empty conversation.
    Equal sides give a prompt and empty completions. ``has_preference`` is true where both completions hold a turn; a
    pair of which one side is a beginning of the other states none. Turn markers inside roles and texts are broken up by
    a blank. A turn without a pair_id belongs to no conversation: it is a row of its own, with a NULL pair_id and without
    a partner. A pair is one row, so a conversation must fit a row, as in any text format.
    """
    met = _side(chosen, "chosen").unionByName(_side(rejected, "rejected")).groupBy("pair_id", "alone", F.when(
        F.col("pair_id").isNull(), F.col("t.side")).alias("alone_side")).agg(F.sort_array(F.collect_list("t")).alias("all"))
    own = met.select("pair_id", _of_side("chosen"), _of_side("rejected"))
    same = F.zip_with("chosen", "rejected", lambda c, r: F.coalesce((c["role"] == r["role"]) & (c["text"] == r["text"]), F.lit(False)))
    first_off = F.array_position(same, F.lit(False))
    counted = own.withColumn("n", F.when(first_off == 0, F.size(same)).otherwise(first_off - 1).cast("int"))
    rest = {s: F.slice(s, F.col("n") + 1, F.greatest(F.size(s) - F.col("n"), F.lit(0))) for s in ("chosen", "rejected")}
    return counted.select(
        "pair_id", F.col("n").cast("long").alias("n_common"), rendered(F.slice("chosen", F.lit(1), F.col("n"))).alias("prompt"),
        rendered(rest["chosen"]).alias("chosen"), mask(rest["chosen"]).alias("chosen_mask"),
        rendered(rest["rejected"]).alias("rejected"), mask(rest["rejected"]).alias("rejected_mask"),
        ((F.size("chosen") > F.col("n")) & (F.size("rejected") > F.col("n"))).alias("has_preference"))


def _of_side(side: str) -> Column:
    return F.filter("all", lambda t: t["side"] == side).alias(side)


def with_other_answer(turns: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: the conversation is chosen, rejected is the same one with its last assistant
    turn's text taken from the last assistant turn of the conversation whose key is larger by one. Where that is not there
    or has no answer, the answer is left out and the pair has no preference.

    Turns behind the last assistant turn stay on both sides. Conversations without an assistant turn are equal on both
    sides. Turns without a key stay on both sides, each alone.
    """
    all_turns = turns.select(F.col(key).alias("pair_id"), "turn", "role", "text")
    answers = all_turns.where(F.col("role") == TRAINED_ROLE).groupBy("pair_id").agg(
        F.max(F.struct("turn", "text")).alias("last"))
    other = answers.select((F.col("pair_id") - 1).alias("pair_id"), F.col("last.text").alias("other_text"), F.lit(True).alias("known"))
    known = answers.select("pair_id", F.col("last.turn").alias("last_turn")).join(other, "pair_id", "left")
    met = all_turns.join(known, "pair_id", "left")
    replaced = (F.col("role") == TRAINED_ROLE) & (F.col("turn") == F.col("last_turn"))
    rejected = met.where(~F.coalesce(replaced & F.col("known").isNull(), F.lit(False))).select(
        "pair_id", "turn", "role", F.when(replaced, F.col("other_text")).otherwise(F.col("text")).alias("text"))
    return all_turns, rejected
