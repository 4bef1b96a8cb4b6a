"""Text scores that need an alignment: summary-level LCS F-score and METEOR with stems.

Both come out of one Arrow-batched call, so a text crosses to Python once, and the row stays where it is.
Definitions: Lin 2004 (union LCS); Banerjee & Lavie 2005; Porter 1980.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.fixed_values import (
    METEOR_ALPHA, METEOR_BETA, METEOR_GAMMA, STEM_IRREGULAR, STEM_STEP_2, STEM_STEP_3, STEM_STEP_4,
)

_WORD = re.compile(r"[^\W_]+")
_ASCII_WORD = re.compile(r"[a-z0-9]+")
_PIECE = re.compile(r"\w+|[^\w\s]")


def _shape(word: str) -> str:
    """'c' or 'v' per letter; y is a vowel after a consonant."""
    out = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or (len(word) == 2 and shape == "vc")


def _rules(word: str, rules: Sequence[tuple[str, str]], least: int) -> str:
    for old, new in rules:
        if word.endswith(old):
            return word[: -len(old)] + new if _measure(word[: -len(old)]) >= least else word
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if len(word) <= 2 or not word.isascii():
        return word
    if word in STEM_IRREGULAR:
        return STEM_IRREGULAR[word]
    # plurals
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("ies"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past and progressive forms
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for ending in ("ed", "ing"):
            base = word[: -len(ending)]
            if word.endswith(ending) and "v" in _shape(base):
                if base.endswith(("at", "bl", "iz")):
                    word = base + "e"
                elif _double(base):
                    word = base if base[-1] in "lsz" else base[:-1]
                else:
                    word = base + "e" if _measure(base) == 1 and _short_end(base) else base
                break
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    # derivational endings
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    if word.endswith("logi"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        word = _rules(word, STEM_STEP_2, 1)
    word = _rules(word, STEM_STEP_3, 1)
    for ending in sorted(STEM_STEP_4, key=len, reverse=True):
        if word.endswith(ending):
            base = word[: -len(ending)]
            if _measure(base) > 1 and (ending != "ion" or base.endswith(("s", "t"))):
                word = base
            break
    # tidy up
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def _table_rows(ref: Sequence[str], places: Mapping[str, int], full: int) -> list[int]:
    """Rows of the LCS length tables of ``ref`` against all candidate sentences at once.

    A row is one integer; a zero bit is a step up in the table, so a row costs one
    addition. A bit that is always zero between sentences stops the carry.
    """
    rows = [full]
    for token in ref:
        v = rows[-1]
        u = v & places.get(token, 0)
        rows.append(((v + u) | (v - u)) & full)
    return rows


def _lcs_members(ref: Sequence[str], cand: Sequence[str], rows: Sequence[int], offset: int,
                 places: Mapping[str, int]) -> set[int]:
    """Positions of ``ref`` on a longest common subsequence with the sentence at ``offset``.

    Walks the table from its end: up while the length stays, else left to the last
    equal token of the row; so one step per token of ``ref``. It reads the rows it
    passes and ends when the subsequence is whole.
    """
    i, j, members = len(ref), len(cand), set()
    left = j - ((rows[i] >> offset) & ((1 << j) - 1)).bit_count()
    while left:
        below = (1 << j) - 1
        if ref[i - 1] == cand[j - 1]:
            j -= 1
        elif j - ((rows[i - 1] >> offset) & below).bit_count() == left:
            i -= 1
            continue
        else:
            j = ((places[ref[i - 1]] >> offset) & below).bit_length() - 1
        i, left = i - 1, left - 1
        members.add(i)
    return members


def _places_of(ref: Sequence[str], union: set[int], places: Mapping[str, int]) -> int:
    """Candidate positions of the reference tokens not yet in ``union``."""
    bits = 0
    for token in {w for i, w in enumerate(ref) if i not in union}:
        bits |= places.get(token, 0)
    return bits


def lcs_f_score(reference: str, prediction: str, *, stemmed: bool = True, ascii_only: bool = False) -> float:
    """F-score of the union LCS over newline-separated sentences."""
    pattern = _ASCII_WORD if ascii_only else _WORD

    def sentences(text: str) -> list[list[str]]:
        lines = [pattern.findall(line.lower()) for line in text.split("\n")]
        return [[stem(w) if stemmed and len(w) > 3 else w for w in line] for line in lines if line]

    refs, cands = sentences(reference), sentences(prediction)
    ref_left = Counter(w for s in refs for w in s)
    cand_left = Counter(w for s in cands for w in s)
    n_ref, n_cand = ref_left.total(), cand_left.total()
    if not n_ref or not n_cand:
        return 0.0
    places: dict[str, int] = defaultdict(int)
    offsets, full, at = [], 0, 0
    for cand in cands:
        offsets.append(at)
        full |= ((1 << len(cand)) - 1) << at
        for j, w in enumerate(cand):
            places[w] |= 1 << (at + j)
        at += len(cand) + 1
    hits, known = 0, set(map(tuple, cands))
    for ref in refs:
        union: set[int] = set(range(len(ref))) if tuple(ref) in known else set()
        open_ = _places_of(ref, union, places)
        rows = _table_rows(ref, places, full) if open_ else []
        for cand, offset in zip(cands, offsets):
            # A sentence can add only positions whose token it holds.
            if (open_ >> offset) & ((1 << len(cand)) - 1):
                union |= _lcs_members(ref, cand, rows, offset, places)
                open_ = _places_of(ref, union, places)
        for i in sorted(union):
            if ref_left[ref[i]] > 0 and cand_left[ref[i]] > 0:
                ref_left[ref[i]] -= 1
                cand_left[ref[i]] -= 1
                hits += 1
    precision, recall = hits / n_cand, hits / n_ref
    return 2 * precision * recall / (precision + recall) if hits else 0.0


def meteor(reference: str, prediction: str, *, stemmed: bool = True,
           synonyms: Mapping[str, Sequence[str]] | None = None) -> float:
    """Alignment by equal words, then equal stems, then synonyms, each from the text's end."""
    ref = [w.lower() for w in _PIECE.findall(reference)]
    cand = [w.lower() for w in _PIECE.findall(prediction)]
    pairs: dict[int, int] = {}
    free = set(range(len(ref)))

    def match_key(key) -> None:
        """Words with an equal key, the last with the last."""
        stacks: dict[str, list[int]] = defaultdict(list)
        for j in sorted(free):
            stacks[key(ref[j])].append(j)
        for i in range(len(cand) - 1, -1, -1):
            if i not in pairs:
                stack = stacks.get(key(cand[i]))
                if stack:
                    pairs[i] = stack.pop()
        free.difference_update(pairs.values())

    def match_any(keys_of_cand) -> None:
        stacks: dict[str, list[int]] = defaultdict(list)
        for j in sorted(free):
            stacks[ref[j]].append(j)
        for i in range(len(cand) - 1, -1, -1):
            if i in pairs:
                continue
            options = []
            for key in keys_of_cand(cand[i]):
                stack = stacks.get(key, [])
                while stack and stack[-1] not in free:
                    stack.pop()
                if stack:
                    options.append(stack[-1])
            if options:
                pairs[i] = max(options)
                free.discard(pairs[i])

    match_key(str)
    if stemmed and free and len(pairs) < len(cand):
        match_key(stem)
    if synonyms:
        match_any(lambda w: (w, *synonyms.get(w, ())))
    n = len(pairs)
    if not n:
        return 0.0
    order = sorted(pairs)
    chunks = 1 + sum(1 for a, b in zip(order, order[1:]) if b != a + 1 or pairs[b] != pairs[a] + 1)
    precision, recall = n / len(cand), n / len(ref)
    mean = precision * recall / (METEOR_ALPHA * precision + (1 - METEOR_ALPHA) * recall)
    return (1 - METEOR_GAMMA * (chunks / n) ** METEOR_BETA) * mean


SCORES = ("rouge", "meteor")


def text_scores(reference: Column, prediction: Column, scores: Sequence[str] = SCORES, *, stemmed: bool = True,
                ascii_only: bool = False, synonyms: Column | None = None) -> Column:
    """Struct of the chosen scores of two text columns. ``synonyms`` is a map column: word of the prediction -> words
    that count as equal."""
    unknown = set(scores) - set(SCORES)
    if unknown:
        raise ValueError(f"unknown scores {sorted(unknown)}")

    def score(references: pd.Series, predictions: pd.Series, others: pd.Series) -> pd.DataFrame:
        rows = list(zip(references.fillna(""), predictions.fillna(""), others))
        out = pd.DataFrame(index=range(len(rows)))
        if "rouge" in scores:
            out["rouge"] = [lcs_f_score(r, p, stemmed=stemmed, ascii_only=ascii_only) for r, p, _ in rows]
        if "meteor" in scores:
            out["meteor"] = [meteor(r, p, stemmed=stemmed, synonyms=dict(m) if m is not None else None) for r, p, m in rows]
        return out

    score.__annotations__ = {"references": pd.Series, "predictions": pd.Series, "others": pd.Series, "return": pd.DataFrame}
    none = F.lit(None).cast("map<string,array<string>>")
    fields = [f"{f} double" for f in ("rouge", "meteor") if f in scores]
    return F.pandas_udf(score, ", ".join(fields))(reference, prediction, none if synonyms is None else synonyms)
