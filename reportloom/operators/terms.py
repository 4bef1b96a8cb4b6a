"""Redaction with dictionaries: literal terms of any number, given as a table.

A term is its words in order, whatever their case and whatever stands between them, so
``Anna  BERG`` and ``anna-berg`` both match the term ``Anna Berg``. Words are runs of
letters, digits and underscores.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.functions.pii import FOUND, find_spans, merge_spans, replace_spans
from reportloom.functions.text import CHUNK, between, cut, let
from reportloom.operators.redaction import RegexStage
from reportloom.session import fresh_folder, shuffles_dropped

WORD = re.compile(r"\w+")
NO_WORD = re.compile(r"\W")
DOT_ABOVE, DOTTED = "i\u0307", "\ufdd0"  # the only lower case of two characters, and what stands for it
ROWS_A_BATCH = 20_000
CHARS_AT_ONCE = 1 << 18  # of texts cut into words together
BITS_A_TERM, MARKS_A_TERM = 16, 4
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 30  # what a task reads at most: 128 MB
SLICE_BITS = 1 << 20  # the marks of one term lie in one slice of all bits
STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so a power of it has an inverse
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MATCHES = "array<struct<start:int,end:int,label:string>>"


def spelled_terms(terms: DataFrame, *, term: str = "term", label: str = "label") -> DataFrame:
    """(gram, n_words, label): one row per sequence of words; of several labels the smallest counts.

    Terms that are NULL or hold no word, and those without a label, are left out.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [[w.lower() for w in WORD.findall(t or "")] for t in batch.column(0).to_pylist()]
            yield pa.record_batch({
                "gram": pa.array([" ".join(w) for w in words], pa.string()),
                "n_words": pa.array([len(w) for w in words], pa.int32()),
                "label": batch.column(1).cast(pa.string()),
            })

    spelled = terms.select(F.col(term).cast("string"), F.col(label).cast("string")).mapInArrow(
        spell, "gram string, n_words int, label string")
    usable = spelled.filter((F.col("n_words") > 0) & F.col("label").isNotNull())
    return usable.groupBy("gram", "n_words").agg(F.min("label").alias("label"))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _in_words() -> np.ndarray:
    """Per character, whether words hold it."""
    table = np.zeros(sys.maxunicode + 1, bool)
    for run in WORD.finditer("".join(map(chr, range(sys.maxunicode + 1)))):
        table[run.start():run.end()] = True
    table[ord(DOTTED)] = True
    return table


def _lowered(text: str) -> str:
    """The text with its words in lower case, every character at its place."""
    if not any(c in text for c in ("\u0130", "\u03a3", DOTTED)):  # a dotted I; a sigma, whose lower case depends on what follows
        return text.lower()
    return WORD.sub(lambda m: m.group().lower().replace(DOT_ABOVE, DOTTED), text.replace(DOTTED, " "))


class _Runs:
    """Numbers of the runs in a list of numbers: equal runs have equal numbers, wherever they stand."""

    def __init__(self, values: np.ndarray) -> None:
        powers, self.back = (np.cumprod(np.append(np.uint64(1), np.full(len(values), x))) for x in (STEP, BACK))
        self.up_to = np.append(np.uint64(0), np.cumsum(values * powers[:-1]))

    def numbers(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.up_to[ends] - self.up_to[starts]) * self.back[starts])


def _words_in(text: str, in_words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and numbers of the words: all between blanks, or of the characters given."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    inside = np.zeros(len(points) + 2, np.int8)
    inside[1:-1] = points != ord(" ") if in_words is None else in_words[points]
    turns = np.diff(inside)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    return starts, ends, _Runs(points + np.uint64(1)).numbers(starts, ends)


def _bit_places(numbers: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of each number, one array after another; all of a number lie in one slice."""
    within = np.uint64(min(bits, SLICE_BITS) - 1)
    first = ((numbers >> np.uint64(40)) * np.uint64(SLICE_BITS)) & np.uint64(bits - 1)
    apart = (numbers >> np.uint64(20)) | np.uint64(1)
    for k in range(MARKS_A_TERM):
        yield first | ((numbers + np.uint64(k) * apart) & within)


def _marked(known: DataFrame) -> np.ndarray:
    """Bits of the terms, ``MARKS_A_TERM`` each and ``BITS_A_TERM`` times as many as terms but ``MOST_BITS`` at most: of the
    runs of words that are no term few have all their bits set. Terms are numbered and marked in the tasks; slices of
    bits reach the driver one after another, not the terms."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_TERM * known.count() - 1).bit_length()))
    size = min(bits, SLICE_BITS)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [gram.replace(DOT_ABOVE, DOTTED) for gram in batch.column(0).to_pylist()]
            ends = np.cumsum(np.fromiter((gram.count(" ") + 1 for gram in grams), np.int64, len(grams)))
            numbers = _Runs(_words_in(" ".join(grams))[2]).numbers(np.append(0, ends[:-1]), ends)
            slices = next(_bit_places(numbers, bits)) // np.uint64(size)
            yield pa.record_batch({"slice": pa.array(slices.astype(np.int32)), "number": pa.array(numbers.view(np.int64))})

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: dict[int, np.ndarray] = {}
        for batch in batches:
            slices, numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for at in np.unique(slices).tolist():
                own = marks.setdefault(at, np.zeros(size // 8, np.uint8))
                for place in _bit_places(numbers[slices == at], bits):
                    place = place & np.uint64(size - 1)
                    np.bitwise_or.at(own, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        for at, own in marks.items():
            yield pa.record_batch({"slice": pa.array([at], pa.int32()), "bits": pa.array([own.tobytes()], pa.binary())})

    numbered = known.select("gram").mapInArrow(number, "slice int, number bigint")
    packed = numbered.repartition("slice").mapInArrow(mark, "slice int, bits binary")
    folder = fresh_folder(known.sparkSession, "term-marks")
    packed.write.parquet(folder)
    marks = np.zeros((bits // size, size // 8), np.uint8)
    for row in known.sparkSession.read.parquet(folder).toLocalIterator():
        marks[row.slice] = np.frombuffer(row.bits, np.uint8)
    return marks.ravel()


def _grams(texts: DataFrame, lengths: Sequence[int], marks: np.ndarray) -> DataFrame:
    """(digest, start, end, gram): the runs of words of the given lengths that may be terms, by their bits in ``marks``, in
    batches of bounded size. The words of many texts are looked up together; a long text comes in parts."""
    shared = texts.sparkSession.sparkContext.broadcast(marks.tobytes())
    longest = lengths[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(shared.value, np.uint8)
        parts, size = [], 0
        for batch in batches:
            for digest, text in zip(batch.column(0), batch.column(1)):
                for part in _parts(digest.as_py(), text.as_py(), longest):
                    if size + len(part[2]) > CHARS_AT_ONCE:
                        yield from _candidates(parts, lengths, marked)
                        parts, size = [], 0
                    parts.append(part)
                    size += len(part[2])
        yield from _candidates(parts, lengths, marked)

    return texts.mapInArrow(run, "digest binary, start int, end int, gram string")


def _parts(digest: bytes, text: str, longest: int) -> Iterator[tuple[bytes, int, str, int]]:
    """(digest, place of the part in its text, part, words at its start that the part before has too); no word is cut."""
    at = start = seen = 0
    while len(text) - at > CHARS_AT_ONCE and (end := NO_WORD.search(text, at + CHARS_AT_ONCE)):
        part = text[start:end.start()]
        yield digest, start, part, seen
        shared = _words_in(_lowered(part), _in_words())[0][-(longest - 1):] if longest > 1 else ()
        at, seen = end.start(), len(shared)
        start = start + int(shared[0]) if seen else at
    yield digest, start, text[start:], seen


def _candidates(parts: list[tuple[bytes, int, str, int]], lengths: Sequence[int], marked: np.ndarray) -> Iterator[pa.RecordBatch]:
    text = "\n".join(_lowered(part) for _, _, part, _ in parts)
    begins = np.cumsum([0] + [len(part) + 1 for _, _, part, _ in parts[:-1]])
    starts, ends, numbers = _words_in(text, _in_words())
    owners = np.searchsorted(begins, starts, "right") - 1
    in_text = np.array([at for _, at, _, _ in parts], np.int64) - begins
    # The first words that end a run of their own, per part.
    unseen = np.searchsorted(starts, begins) + np.array([seen for _, _, _, seen in parts], np.int64)
    runs, digests = _Runs(numbers), pa.array([digest for digest, _, _, _ in parts], pa.binary())
    for n in lengths:
        firsts = np.arange(max(len(starts) - n + 1, 0))
        lasts = firsts + n - 1
        firsts = firsts[(owners[firsts] == owners[lasts]) & (lasts >= unseen[owners[firsts]])]
        numbers = runs.numbers(firsts, firsts + n)
        for k in range(MARKS_A_TERM):
            place = next(islice(_bit_places(numbers, marked.size * 8), k, None))
            there = (marked[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            firsts, numbers = firsts[there], numbers[there]
        for at in range(0, len(firsts), ROWS_A_BATCH):
            first = firsts[at:at + ROWS_A_BATCH]
            owner, last = owners[first], first + n - 1
            grams = [" ".join([text[a:b] for a, b in zip(starts[i:i + n].tolist(), ends[i:i + n].tolist())]) for i in first.tolist()]
            yield pa.record_batch({
                "digest": digests.take(pa.array(owner)), "start": pa.array(starts[first] + in_text[owner], pa.int32()),
                "end": pa.array(ends[last] + in_text[owner], pa.int32()),
                "gram": pa.array([gram.replace(DOTTED, DOT_ABOVE) for gram in grams], pa.string()),
            })


def term_matches(texts: DataFrame, terms: DataFrame, *, text: str = "text", term: str = "term",
                 label: str = "label") -> DataFrame:
    """(digest, matches): per different text, by its MD5, where terms stand, by start; a written table.

    Of the terms that start at one word the longest counts. Runs of words meet the terms by
    equality; the terms are written once, so Spark knows their size: it sends a small table to
    the tasks and shuffles both sides otherwise, where AQE splits words that are very frequent.
    A run of words leaves its task only if all bits of its number say that it may be a term; the join
    decides. Matches meet once, by text; copies of a text fall together in the partial aggregation.
    """
    spark = texts.sparkSession
    known_folder, found_folder = fresh_folder(spark, "terms"), fresh_folder(spark, "term-matches")
    with shuffles_dropped(spark):  # what a step has shuffled is gone before the next one, and before whole texts are
        spelled_terms(terms, term=term, label=label).write.parquet(known_folder)
        known = spark.read.parquet(known_folder)
        lengths = sorted(r.n_words for r in known.select("n_words").distinct().collect())
        if not lengths:
            return spark.createDataFrame([], f"digest binary, matches {MATCHES}")
        given = texts.select(F.unhex(F.md5(text)).alias("digest"), F.col(text).cast("string").alias("text")).filter("text <> ''")
        hits = _grams(given, lengths, _marked(known)).join(known.select("gram", "label"), "gram")
        met = hits.groupBy("digest").agg(F.sort_array(F.collect_set(F.struct("start", "end", "label"))).alias("met"))
        # In this order the longest match of a word is the last one with its start.
        longest = let(F.col("met"), lambda met: F.filter(
            met, lambda m, i: ~F.coalesce(F.get(met, i + 1)["start"] == m["start"], F.lit(False))))
        met.select("digest", longest.cast(MATCHES).alias("matches")).write.parquet(found_folder)
    return spark.read.parquet(found_folder)


def redact_terms(df: DataFrame, terms: DataFrame, stage: RegexStage | None = None, *, text: str = "text",
                 term: str = "term", label: str = "label", out: str = "redacted", spans: str = "spans") -> DataFrame:
    """Add the spans of patterns and terms together, overlapping ones united, and the text with tokens in their place.

    Terms come after the patterns where both start alike. Texts are matched by content, so rows
    need no key and repeated rows and NULL keys are like all others; a NULL text has no spans.
    """
    stage = stage or RegexStage()
    matches = term_matches(df, terms, text=text, term=term, label=label).select(
        F.col("digest").alias("__digest"), F.col("matches").alias("__matches"))
    order = F.lit(len(stage.patterns))

    def located(pieces):
        return F.transform("__matches", lambda m: F.struct(
            m["start"].alias("start"), order.alias("order"), m["end"].alias("end"), m["label"].alias("label"),
            between(pieces, m["start"], m["end"]).alias("original")))

    by_term = F.coalesce(let(cut(F.col(text), CHUNK), located), F.array().cast(FOUND))
    by_pattern = find_spans(F.col(text), stage.patterns) if stage.patterns else F.array().cast(FOUND)
    # Patterns run where the rows are read; behind the join AQE may leave few tasks.
    ready = df.withColumns({"__digest": F.unhex(F.md5(F.col(text))), "__found": by_pattern})
    met = ready.join(matches, "__digest", "left")
    found = met.withColumn(spans, merge_spans(F.sort_array(F.concat("__found", by_term))))
    return found.withColumn(out, replace_spans(F.col(text), F.col(spans), stage.tokens)).drop("__digest", "__found", "__matches")
