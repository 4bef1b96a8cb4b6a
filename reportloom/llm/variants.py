"""Spelling variants by a relational trie frontier.

The distinct words, read forwards and backwards, form two compressed tries that exist only as a table of edges (node,
label, child). A frontier of states (word, position, node, edits) starts at the node of every word's first half and is
joined with the edges level by level: an edge is passed unchanged or with its one edit, and a state that
has used its edit and its whole word at a node where another word ends makes the two neighbours. As one edit leaves
either the first or the second half of a word as it is, each trie tries edits in the second half of what it reads
only, where few edges leave a node, and holds no nodes further up. A pair is found once: by deleting from its longer
word, or by replacing a character with a larger one; then it counts both ways.

A node is the 128-bit digest of its prefix, so no string travels but the rest of a state's word. Nodes that many words
pass are salted by that number, which the edges carry. Every level is written, so a lost executor repeats one at most.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.llm.storage import Batches, batches_of, mapped, rows_of, sliced, stored

RUNS = "[A-Za-zÀ-ÿ]"
WORDS_HELD = 200_000  # words a task sums up before it hands them on
WORDS_A_SALT = 20_000  # words below a node that share one salt
FORWARDS, BACKWARDS = 0, 1


def _mistyped(run: bytes, prefix: int, every: int) -> str:
    """A lowered run without the code point its checksum names, if that is a multiple of ``every``."""
    word, hashed = run.decode(), zlib.crc32(run, prefix)
    if not every or hashed % every:
        return word
    at = hashed % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 7, least_count: int = 2,
                every: int = 31) -> DataFrame:
    """(word, n) of the runs of letters in all texts, A-Z lowered, with every so manieth one mistyped.

    Where ``every`` divides the CRC-32 of ``<key>:<run>``, the run loses the code point at that number modulo its length
    (0 mistypes none). Words have ``least_chars`` code points after that and occur ``least_count`` times. NULL texts have
    no words, a NULL key counts as empty, repeated rows count each. Other columns are ignored. Tasks sum what they can
    hold before the shuffle.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    runs = re.compile(f"{RUNS}{{{max(1, least_chars)},}}")

    def counted(batches: Batches) -> Iterator[tuple]:
        held: Counter[str] = Counter()
        for one, value in rows_of(batches, "key", "text"):
            prefix = zlib.crc32((one or b"") + b":")
            own: Counter[bytes] = Counter()
            for run, times in Counter(m[0] for m in runs.finditer((value or b"").decode())).items():
                own[run.encode().lower()] += times  # of bytes, only A-Z are lowered
            for run, times in own.items():
                held[_mistyped(run, prefix, every)] += times
            if len(held) >= WORDS_HELD:
                yield from held.items()
                held.clear()
        yield from held.items()

    def work(batches: Batches) -> Batches:
        return batches_of((row for row in counted(batches) if len(row[0]) >= least_chars), schema, size=1 << 14)

    found = mapped(docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")), work, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _prefixes_of(words: Iterator[tuple[int, str]]) -> Iterator[tuple]:
    """(id, side, depth, node, following, starts) of the prefixes in both directions, from the half on.

    A word is looked for by words at least as long, so nobody starts at a node of it further up.
    """
    for number, word in words:
        for side, read in ((FORWARDS, word), (BACKWARDS, word[::-1])):
            half = len(word) // 2 if side == FORWARDS else len(word) - len(word) // 2
            state = hashlib.blake2b(bytes([side]), digest_size=16)
            for depth in range(len(read) + 1):
                if depth >= half:
                    following = ord(read[depth]) if depth < len(read) else None
                    yield number, side, depth, state.copy().digest(), following, depth == half
                if depth < len(read):
                    state.update(read[depth].encode())


def _prefixes(words: DataFrame) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("side", pa.int32()), ("depth", pa.int32()), ("node", pa.binary()),
                        ("following", pa.int32()), ("starts", pa.bool_())])

    def work(batches: Batches) -> Batches:
        rows = (row for batch in sliced(batches) for row in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True))
        return batches_of(_prefixes_of(rows), schema)

    return mapped(words.select("id", "word"), work, "id long, side int, depth int, node binary, following int, starts boolean")


def _bit(code_point: Column) -> Column:
    """One of 64 bits for a character."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (code_point % 64).cast("int"))


def _trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges (node, salt, label, child, below, ends, leads) of both tries, and the states at which the words start.

    Nodes are the prefixes behind which words part, halves of words, and whole words. ``below``: words that pass the
    child; ``ends``: the word that ends there; ``leads``: bits of the characters that follow.
    """
    prefixes = stored(_prefixes(words), "prefixes")
    nodes = prefixes.groupBy("node").agg(
        F.count(F.lit(1)).alias("below"), F.max(F.when(F.col("following").isNull(), F.col("id"))).alias("ends"),
        F.min("following").alias("least"), F.max("following").alias("most"), F.bool_or("starts").alias("start"),
        F.coalesce(F.bit_or(_bit(F.col("following"))), F.lit(0).cast("long")).alias("leads"))
    kept = nodes.where("start OR ends IS NOT NULL OR least < most").select("node", "below", "ends", "leads")
    path = stored(prefixes.drop("following").join(kept, "node"), "paths")
    reading = F.when(F.col("side") == FORWARDS, F.col("word")).otherwise(F.reverse("word"))
    along = Window.partitionBy("id", "side").orderBy("depth")  # as many rows as a word has characters, at most
    steps = path.withColumns({"parent": F.lag("node").over(along), "from": F.lag("depth").over(along), "passed": F.lag("below").over(along)})
    # Every word that passes an edge says the same of it.
    said = ["id", "side", "from", "depth", "passed", "below", "ends", "leads"]
    single = steps.where("parent IS NOT NULL").groupBy("parent", F.col("node").alias("child")).agg(*[F.min(c).alias(c) for c in said])
    salts = F.sequence(F.lit(0), F.floor((F.col("passed") - 1) / WORDS_A_SALT).cast("int"))
    label = F.substring(reading, F.col("from") + 1, F.col("depth") - F.col("from"))
    edges = single.join(words.select("id", "word"), "id").select(
        F.col("parent").alias("node"), F.explode(salts).alias("salt"), label.alias("label"), "child", "below", "ends", "leads")
    start = path.where("starts").join(words.select("id", "word"), "id").select(
        "id", F.col("depth").alias("position"), F.substring(reading, F.col("depth") + 1, F.length("word")).alias("rest"),
        "node", "below", "ends", F.lit(0).alias("edits"))
    return stored(edges, "edges"), start


def _met(state: DataFrame) -> DataFrame:
    """States with the word they found, if any: one that has made its edit and is used up, or that only lacks its last character."""
    used_up = (F.col("edits") == 1) & (F.col("rest") == "")
    last_left_out = (F.col("edits") == 0) & (F.length("rest") == 1)
    return state.withColumn("near", F.when(used_up | last_left_out, F.col("ends")))


def _advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """All states one edge further.

    An unchanged edge is the beginning of the rest. An edit lies where the two first differ, so it is found on one edge
    only: the label then is at distance one of as many characters (one is replaced) or one more (one is deleted). Of two
    words of one length the one with the smaller character looks for the other.
    """
    salt = F.pmod(F.xxhash64("id"), F.floor((F.col("below") - 1) / WORDS_A_SALT) + 1).cast("int")
    rest, label, size = F.col("rest"), F.col("label"), F.length("label")
    met = states.withColumn("salt", salt).drop("below", "ends").join(edges.hint("shuffle_hash"), ["node", "salt"])
    begins = met.withColumn("begins", F.substring(rest, F.lit(1), size)).withColumn("same", F.col("begins") == label)

    def way(holds: Column, used: Column, edits: Column) -> Column:
        return F.when(holds, F.struct(used.alias("used"), edits.alias("edits")))

    def near(used: Column, one: Column) -> Column:
        apart = F.levenshtein(label, F.substring(rest, F.lit(1), used), 1) == 1
        return (F.col("edits") == 0) & ~F.col("same") & (F.length(rest) >= used) & F.when(size == 1, one).otherwise(apart)

    ways = F.array(way(F.col("same"), size, F.col("edits")),
                   way((F.col("begins") < label) & near(size, F.lit(True)), size, F.lit(1)),
                   way(near(size + 1, F.substring(rest, 2, 1) == label), size + 1, F.lit(1)))
    walked = begins.where((F.col("edits") == 0) | F.col("same")).withColumn("way", F.explode(ways)).where("way IS NOT NULL")
    used = F.col("way")["used"]
    further = walked.select("id", (F.col("position") + used).alias("position"), F.substring(rest, used + 1, F.length(rest)).alias("rest"),
                            F.col("child").alias("node"), "below", "ends", F.col("way")["edits"].alias("edits"), "leads")
    # With its edit used, a state whose next character surely leads nowhere ends here.
    leads = F.col("leads").bitwiseAND(_bit(F.ascii("rest"))) != 0
    return further.where((F.col("edits") == 0) | F.when(F.col("rest") == "", F.col("ends").isNotNull()).otherwise(leads)).drop("leads")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, near): ids of all words that differ by exactly one inserted, deleted or replaced code point, both ways round.

    ``words``: (id long, word), distinct and not empty, written.
    """
    edges, start = _trie(words)
    found, level = [], stored(_met(start), "frontier")
    while not level.isEmpty():
        found.append(level.where("near IS NOT NULL").select("id", "near"))
        going = level.where("rest <> ''").drop("near")
        level = stored(_met(_advanced(going, edges)), "frontier")
    if not found:
        return level.select("id", "near")
    pairs = functools.reduce(DataFrame.unionByName, found)
    # Both tries may find a pair, if its edit can be seen at several places.
    return pairs.unionByName(pairs.select(F.col("near").alias("id"), F.col("id").alias("near"))).distinct()


def grouped(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n), words distinct.

    form: the neighbour of largest n (ties: the smallest word), if that is ``ratio`` times the word's own; else NULL.
    root: where the forms lead in the end, the word itself if it has none. NULL and empty words are left out, a NULL n is
    0; no words give no rows. Other columns are ignored.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than the word")
    known = stored(words.where(F.col("word") != "").select(F.monotonically_increasing_id().alias("id"), "word", F.coalesce(F.col("n").cast("long"), F.lit(0).cast("long")).alias("n")), "words")
    pairs = stored(neighbours(known), "neighbours")
    other = known.select(F.col("id").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    best = pairs.join(other, "near").groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near_word", "near")).alias("best"))
    rated = known.join(best, "id", "left").withColumn("fits", F.coalesce(-F.col("best")["less"] >= ratio * F.col("n"), F.lit(False)))
    formed = stored(rated.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(F.col("fits"), value).alias(name) for name, value in
          (("form", F.col("best")["near_word"]), ("form_n", -F.col("best")["less"]), ("form_id", F.col("best")["near"]))]), "forms")
    roots = _roots(formed.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root")))
    named = roots.join(known.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return formed.join(named, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Where links (id, root) lead, by doubling: chains are short, as every form is many times as frequent."""
    now = stored(links, "roots")
    while True:
        further = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        met = stored(now.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = met.select("id", "root")
        if met.where("moved").isEmpty():
            return now
