"""Language identification by rank order of n-grams.

A language's profile is its most frequent character n-grams (one to three characters, blanks at word borders) over all
labelled texts. A text is ranked the same way; for each language, the places by which its n-grams are off their rank
in the profile are added up, n-grams that the profile lacks counting as the full profile length, and the language
with the smallest sum wins (ties: the first by name).
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportloom.llm.storage import Batches, batches_of, mapped, sliced, stored

UNKNOWN = "und"
PROFILE = 300
LONGEST = 3
BLANK = 1  # stands for everything that is not a letter
SHIFT = 21  # bits of a code point
PIECE = 1 << 20  # characters handled at once
GRAMS_AT_ONCE = 1 << 19  # n-grams of texts held before they are summed
LEAST_SHARE = 0.5  # of the middle score of labelled texts; a text with less counts as no language
LEAST_ROWS = 30  # labelled texts of a length for a middle of their own


class Profiles(NamedTuple):
    """Languages by name; all their n-grams, sorted; ranks[i, j] of n-gram i in language j, PROFILE where absent."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """Letters of the lowered text as code points, runs of anything else as one BLANK, BLANK at both ends."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), "<u4").astype(np.int64)
    points = np.where(_letters()[points], points, BLANK)
    return points[np.concatenate(([True], (points[1:] != BLANK) | (points[:-1] != BLANK)))]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts; none without a letter. An n-gram of up to three code points is one
    64-bit number; blanks stand only at its ends, and a blank alone does not count."""
    parts = [_grams_of(_codes(text[at:at + PIECE])) for at in range(0, len(text), PIECE)]
    if len(parts) == 1:
        return parts[0]
    return _summed(parts)


def _grams_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = codes[codes != BLANK]
    two = codes[:-1] << SHIFT | codes[1:]
    three = (two[:-1] << SHIFT | codes[2:])[codes[1:-1] != BLANK]
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(found), np.int64)
    np.add.at(counts, place, np.concatenate([p[1] for p in parts]))
    return found, counts


def learn(docs: DataFrame, text: str = "text", language: str = "lang", profile: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``docs`` with a language and a text. Counts are summed in the task before they shuffle;
    only the finished profiles (``profile`` numbers per language) reach the driver."""
    schema = pa.schema([("language", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def work(batches: Batches) -> Batches:
        parts: dict[str, list] = {}
        held = 0

        def summed() -> Batches:
            for name in list(parts):
                found, counts = _summed(parts.pop(name))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array(found), pa.array(counts)], schema=schema)

        for batch in sliced(batches):
            for name, value in zip(batch.column("language").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = grams(value)
                parts.setdefault(name, []).append(own)
                held += len(own[0])
            if held >= GRAMS_AT_ONCE:
                yield from summed()
                held = 0
        yield from summed()

    labelled = docs.select(F.col(language).cast("string").alias("language"), F.col(text).alias("text")).dropna()
    counted = mapped(labelled, work, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "gram"))
    top = stored(counted.withColumn("place", place).where(F.col("place") <= profile), "language-profiles")
    rows = top.select("language", "gram", "place").collect()  # at most `profile` rows per language
    languages = sorted({r.language for r in rows})
    known = np.array(sorted({r.gram for r in rows}), np.int64)
    ranks = np.full((len(known), len(languages)), profile, np.int64)
    for r in rows:
        ranks[np.searchsorted(known, r.gram), languages.index(r.language)] = r.place - 1
    return Profiles(languages, known, ranks)


def identify(text: str | None, profiles: Profiles, profile: int = PROFILE) -> tuple[str, float]:
    """(language, score from 0 to 1): 1 if every n-gram has its rank in the profile, 0 if none is in it.
    ``und`` and 0 for NULL, a text without letters, or no profiles."""
    found, counts = grams(text) if text else ((), ())
    if not len(found) or not profiles.languages:
        return UNKNOWN, 0.0
    order = np.argsort(-counts, kind="stable")[:profile]
    mine = found[order]
    at = np.minimum(np.searchsorted(profiles.grams, mine), len(profiles.grams) - 1)
    known = profiles.grams[at] == mine
    off = np.abs(profiles.ranks[at] - np.arange(len(mine))[:, None])
    off[~known] = profile
    off = np.where(profiles.ranks[at] == profile, profile, off)
    sums = off.sum(axis=0)
    best = int(sums.argmin())
    return profiles.languages[best], float(1 - sums[best] / (profile * len(mine)))


def predict(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score), one row per row of ``docs``, from the text alone. No shuffle."""
    schema = pa.schema([("key", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batches: Batches) -> Batches:
        rows = ((k, *identify(t, profiles)) for b in sliced(batches)
                for k, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True))
        return batches_of(rows, schema)

    found = mapped(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")), work,
                   "key long, lang_pred string, score double")
    return found.withColumnRenamed("key", key)


def least_scores(docs: DataFrame, profiles: Profiles, text: str = "text", language: str = "lang") -> dict[int, float]:
    """LEAST_SHARE of the middle score of all labelled texts, under 0, and by length (bits of the number of characters)
    where the texts of that length have a lower middle. Only numbers are written, and a row per length reaches the driver."""
    schema = pa.schema([("length", pa.int32()), ("score", pa.float64())])

    def work(batches: Batches) -> Batches:
        found = ((t, *identify(t, profiles)) for b in sliced(batches) for t in b.column("text").to_pylist())
        return batches_of(((len(t).bit_length(), score) for t, name, score in found if name != UNKNOWN), schema)

    labelled = docs.select(F.col(text).alias("text"), F.col(language).alias("language")).dropna().select("text")
    scored = stored(mapped(labelled, work, "length int, score double"), "language-scores")
    middle = F.percentile_approx("score", 0.5, 10000).alias("middle")
    whole = scored.agg(middle).first().middle
    if whole is None:
        return {}
    own = scored.groupBy("length").agg(middle, F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS).collect()
    return {0: LEAST_SHARE * whole, **{r.length: LEAST_SHARE * min(r.middle, whole) for r in own}}


def accepted(docs: DataFrame, profiles: Profiles, least: float, text: str = "text",
             by_length: dict[int, float] | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of at least ``least`` and, with ``by_length``, of what
    ``least_scores`` found for its length; columns unchanged."""
    at, limits = docs.columns.index(text), by_length or {}

    def enough(value: str | None, score: float) -> bool:
        return score >= max(least, limits.get(len(value or "").bit_length(), limits.get(0, least)))

    def work(batches: Batches) -> Batches:
        for batch in sliced(batches):
            found = [(t, *identify(t, profiles)) for t in batch.column(at).to_pylist()]
            yield batch.filter(pc.and_(pa.array([n != UNKNOWN for _, n, _ in found], pa.bool_()),
                                       pa.array([enough(t, s) for t, _, s in found], pa.bool_())))

    return mapped(docs, work, docs.schema)
