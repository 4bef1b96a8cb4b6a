"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback is run over every word of a text; characters per token, the share of byte
pieces and the evenness of the token distribution (entropy over its largest value) show text the vocabulary was not
made for: symbol noise, broken encodings, repetition. Evenness falls with the length of a text, so what counts is its
distance from the line that the middle texts of all lengths follow. Bands for the three come from all documents of a
language (of a script where no language is given): the median and a multiple of the distance of the quartiles, wider
for texts with fewer tokens than the median one, as a mean over n tokens strays by 1 / sqrt(n). Plain word and line
rules come first.
"""

from __future__ import annotations

import functools
import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from reportloom.llm.storage import Batches, batches_of, mapped, rows_of, stored
from reportloom.llm.words import WordCache

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words
BAND_WIDTH = 4.0  # quartile distances on either side of the median
LEAST_SPREAD = 0.05  # no band is narrower than this share of its median on either side
LEAST_BYTE_SHARE = 0.05  # a share of byte pieces up to this is no fault anywhere
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]
MEASURES = ["chars_per_token", "byte_share", "evenness"]
BANDED = {"chars_per_token": "chars_per_token", "byte_share": "byte_share", "evenness": "evenness_off"}

# First and last code point of the letters that tell scripts apart.
SCRIPTS = {
    "latin": (0x41, 0x24F), "greek": (0x370, 0x3FF), "cyrillic": (0x400, 0x52F), "hebrew": (0x590, 0x5FF),
    "arabic": (0x600, 0x6FF), "devanagari": (0x900, 0x97F), "thai": (0xE00, 0xE7F), "kana": (0x3040, 0x30FF),
    "han": (0x4E00, 0x9FFF), "hangul": (0xAC00, 0xD7AF),
}


def script(text: str) -> str:
    """The script with the most letters in the text (ties: as listed), ``other`` without any."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "other"
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    points = np.sort(points[(points < 0xAA) & ((points | 32) >= 97) & ((points | 32) <= 122) | (points >= 0xAA)])
    counts = {name: int(np.searchsorted(points, last, "right") - np.searchsorted(points, first)) for name, (first, last) in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, found = set(), 0
    for line in text.split("\n"):
        if line in seen:
            found += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return found


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five that occurs twice or more in the text, its first place included."""
    if len(words) < WINDOW + 1:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    pairs = _renumbered(ids[:-1], ids[1:])
    fours = _renumbered(pairs[:-2], pairs[2:])
    fives = _renumbered(fours[:-1], ids[WINDOW - 1:])
    often = np.bincount(fives)[fives] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    covered[:len(often)] += often
    covered[WINDOW:] -= often[:len(words) - WINDOW + 1]
    return int((np.cumsum(covered)[:-1] > 0).sum())


def _renumbered(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers for pairs of numbers; equal exactly for equal pairs."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


@functools.cache
def _vocabulary(path: str) -> tuple[SentencePieceProcessor, np.ndarray]:
    model = SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


@functools.cache
def _cache(path: str) -> WordCache:
    model, _ = _vocabulary(path)
    wide = "<u2" if model.get_piece_size() <= 1 << 16 else "<u4"
    return WordCache(lambda words: [np.array(ids, wide).tobytes() for ids in
                                    model.encode([w.decode() for w in words], num_threads=1)])


def most_entropy(n_tokens: int, path: str) -> float:
    """Bits of entropy a text of so many tokens can have; 0 without any."""
    return math.log2(max(1, min(n_tokens, len(_vocabulary(path)[1]))))


def measure(text: bytes | None, path: str) -> tuple:
    """FIELDS, MEASURES and script of a UTF-8 text; zeros and ``other`` for NULL or a text without words. The measures
    are NULL without tokens."""
    words = text.split() if text else []
    if not words:
        return (0,) * len(FIELDS) + (None,) * len(MEASURES) + ("other",)
    plain = text.decode()
    word_chars = len(plain) - sum(map(plain.count, BLANKS))
    _, is_byte = _vocabulary(path)
    ids = np.frombuffer(_cache(path).joined(words), "<u2" if len(is_byte) <= 1 << 16 else "<u4")
    if not len(ids):
        return (len(words), word_chars, 0, 0, 0, 0) + (None,) * len(MEASURES) + ("other",)
    counts = np.unique(ids, return_counts=True)[1] if len(ids) < len(is_byte) else np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    most = most_entropy(len(ids), path) or 1.0
    return (len(words), word_chars, sum(map(plain.count, SYMBOLS)), repeated_lines(plain), repeated_words(words), len(ids),
            word_chars / len(ids), float(is_byte[ids].mean()), float(abs((share * np.log2(share)).sum()) / most), script(plain))


def measures(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """(key, FIELDS, MEASURES, most, band), most the largest entropy, band the language or else the script.
    ``vocabulary`` is the path of a sentencepiece model that every executor has."""
    schema = pa.schema([("key", pa.int64()), ("language", pa.string()), *((n, pa.int64()) for n in FIELDS),
                        *((n, pa.float64()) for n in MEASURES), ("script", pa.string()), ("most", pa.float64())])

    tokens = FIELDS.index("n_tokens")

    def work(batches: Batches) -> Batches:
        rows = ((k, name.decode() if name else None, *(found := measure(t, vocabulary)), most_entropy(found[tokens], vocabulary))
                for k, name, t in rows_of(batches, "key", "language", "text"))
        return batches_of(rows, schema)

    given = F.col(language).cast("string") if language in docs.columns else F.lit(None).cast("string")
    picked = docs.select(F.col(key).cast("long").alias("key"), given.alias("language"), F.col(text).alias("text"))
    found = mapped(picked, work, ", ".join(["key long", "language string", *(f"{n} long" for n in FIELDS),
                                            *(f"{n} double" for n in MEASURES), "script string", "most double"]))
    return found.withColumn("band", F.coalesce("language", "script")).drop("language", "script")


def lines(measured: DataFrame) -> DataFrame:
    """Per band the line of evenness over the largest entropy, laid by least squares through the medians of the lengths
    (powers of two of tokens), so that few odd texts do not bend it; level where all have one length."""
    lengths = measured.where(~failed()).groupBy("band", F.floor("most")).agg(
        F.avg("most").alias("x"), F.percentile_approx("evenness", 0.5, 10000).alias("y"), F.count("evenness").alias("n")).where("n > 0")
    sums = lengths.groupBy("band").agg(*(F.sum(F.expr(e)).alias(a) for a, e in
                                         {"n": "n", "x": "n * x", "y": "n * y", "xx": "n * x * x", "xy": "n * x * y"}.items()))
    across = F.col("n") * F.col("xx") - F.col("x") * F.col("x")
    flat = across <= 1e-9 * F.col("n") * F.col("xx")
    slope = F.when(flat, 0.0).otherwise((F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.when(~flat, across))
    return sums.select("band", slope.alias("slope"), ((F.col("y") - slope * F.col("x")) / F.col("n")).alias("level"))


def levelled(measured: DataFrame) -> DataFrame:
    """Adds ``evenness_off``: evenness less what the line of the band has at the text's length."""
    straight = stored(lines(measured), "lines")
    return measured.join(straight, "band", "left").withColumn(
        "evenness_off", F.col("evenness") - F.col("level") - F.col("slope") * F.col("most")).drop("level", "slope")


def bands(measured: DataFrame, width: float = BAND_WIDTH) -> DataFrame:
    """Per band the middle and the room on either side of each measure (of evenness: of its distance from the line), and
    the middle number of tokens, over all documents that pass the plain rules."""
    def middle(name: str):
        return F.percentile_approx(name, 0.5, 10000)

    def room(name: str, of: str):
        q1, q3 = (F.percentile_approx(of, p, 10000) for p in (0.25, 0.75))
        return F.greatest(width * (q3 - q1), LEAST_SPREAD * middle(name))

    return measured.where(~failed()).groupBy("band").agg(
        middle("n_tokens").alias("tokens"),
        *chain.from_iterable((middle(of).alias(f"{n}_middle"), room(n, of).alias(f"{n}_room")) for n, of in BANDED.items()))


def inside():
    """Whether all measures lie in their bands. byte_share has no lower and evenness no upper limit, as neither end is
    a fault."""
    wider = F.sqrt(F.greatest(F.col("tokens") / F.col("n_tokens"), F.lit(1.0)))
    off = {n: (F.col(of) - F.col(f"{n}_middle")) / wider for n, of in BANDED.items()}
    room = {n: F.col(f"{n}_room") for n in MEASURES}
    return ((F.abs(off["chars_per_token"]) <= room["chars_per_token"]) & (-off["evenness"] <= room["evenness"])
            & (off["byte_share"] <= F.greatest(room["byte_share"], F.lit(LEAST_BYTE_SHARE))))


def failed():
    """Fewer than ten words, or over a fifth of the words in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rated(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", language: str = "lang",
          width: float = BAND_WIDTH) -> DataFrame:
    """(key, FIELDS, MEASURES, band, base_failed, kept), one row per row of ``docs``.

    kept: passes the plain rules and all three measures lie in the bands of its language or script. NULL, empty and
    blank texts fail the plain rules; NULL keys stay; other columns are ignored. Only numbers are shuffled: the lines
    and bands are one row per language or script, the texts are read once.
    """
    own = levelled(stored(measures(docs, vocabulary, key, text, language), "measures"))
    limits = stored(bands(own, width), "bands")
    return own.join(limits, "band", "left").select(
        F.col("key").alias(key), *FIELDS, *MEASURES, "band", failed().alias("base_failed"),
        F.when(failed(), False).otherwise(F.coalesce(inside(), F.lit(False))).alias("kept"))
