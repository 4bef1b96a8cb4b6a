"""Token counts of a byte-level BPE tokenizer by finite automata.

Two deterministic transducers are compiled from a tokenizer file. The first reads classes of characters and marks where
words start; a transition may also mark the character before, as a few words are only known one character later. The
second reads the bytes of a word, and each of its transitions carries by how much the number of tokens changes. Its
states are what the future can depend on: the beginnings of longer tokens that end here, each with the token before it
and the difference in tokens. Two tokens can stand side by side exactly if no merge crosses their border, so there is
one way to cut any beginning of a word and it extends that of a shorter one. States are numbered when a text first
reaches them, and a table of bounded size holds them.

Texts are cut into chunks of equal length. A chunk's state map takes each state in which it can be entered to the one in
which it is left; these maps are composed by a parallel prefix scan, which gives every chunk its true first state.
All chunks, and then all words, are read side by side in numpy.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reportloom.llm.storage import Batches, batches_of, mapped, rows_of

Runs = list[tuple[int, int, int]]  # (first code point, one behind the last, class)

CHUNK = 64  # characters
BLOCK_BYTES = 1 << 20  # text read at once
TABLE_STATES = 1 << 18  # word states held
SLOT_BITS = 21  # of the transitions' table, at most half full
SLOTS = 1 << SLOT_BITS
FEW = 48  # words still running below which they are read one by one
UNKNOWN = -1
SHIFT_BITS = 10
SHIFT = 1 << SHIFT_BITS  # a transition is (next state * SHIFT) + change in tokens + SHIFT // 2

# Classes of characters.
LETTER, S_LIKE, R_LIKE, L_SMALL, E_SMALL, NUMBER, BLANK, SPACE, APOSTROPHE, OTHER, END = range(11)
_SMALL = {"s": S_LIKE, "t": S_LIKE, "m": S_LIKE, "d": S_LIKE, "r": R_LIKE, "v": R_LIKE, "l": L_SMALL, "e": E_SMALL}
_LETTERS = (LETTER, S_LIKE, R_LIKE, L_SMALL, E_SMALL)
# States of the first transducer: what the last word is so far.
(START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST, QUOTE, QUOTE_R, QUOTE_L, DONE) = range(12)
HERE, BEFORE = 1, 2  # a word starts at this character, at the one before
# Fixed value: how the tokenizer cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _begun(kind: int) -> int:
    """State after the first character of a word."""
    if kind in _LETTERS:
        return IN_LETTERS
    return {NUMBER: IN_NUMBERS, BLANK: ONE_BLANK, SPACE: ONE_SPACE, APOSTROPHE: QUOTE}.get(kind, IN_OTHERS)


def _step(state: int, kind: int) -> tuple[int, int]:
    """(next state, marks) of the first transducer."""
    if kind == END:  # the text is over; what was held back is settled
        return START, BEFORE if state in (QUOTE_R, QUOTE_L) else 0
    fresh = _begun(kind), HERE
    blank = {BLANK: BLANK_LAST, SPACE: SPACE_LAST}.get(kind)
    if state in (START, DONE):
        return fresh
    if state in (ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST):
        if blank is not None:
            return blank, 0
        # The last of several goes to the next word if it is a blank, and else is a word of its own.
        marks = BEFORE if state in (BLANK_LAST, SPACE_LAST) else 0
        if state in (ONE_BLANK, BLANK_LAST):
            return (IN_OTHERS if kind == APOSTROPHE else fresh[0]), marks
        return fresh[0], marks | HERE
    if state == QUOTE:
        if kind == S_LIKE:
            return DONE, 0
        if kind in (R_LIKE, L_SMALL):
            return (QUOTE_R if kind == R_LIKE else QUOTE_L), 0
        return (IN_OTHERS, 0) if kind in (APOSTROPHE, OTHER) else fresh
    if (state, kind) in ((QUOTE_R, E_SMALL), (QUOTE_L, L_SMALL)):
        return DONE, 0
    if state in (QUOTE_R, QUOTE_L):  # not one of the endings: the letter before starts a word
        after, marks = _step(IN_LETTERS, kind)
        return after, marks | BEFORE
    goes_on = {IN_LETTERS: _LETTERS, IN_NUMBERS: (NUMBER,), IN_OTHERS: (APOSTROPHE, OTHER)}[state]
    return (state, 0) if kind in goes_on else fresh


KINDS, STATES = END + 1, DONE + 1
_STEPS = np.array([[_step(s, k) for k in range(KINDS)] for s in range(STATES)])
NEXT, MARKS = _STEPS[:, :, 0].reshape(-1).astype(np.int16), _STEPS[:, :, 1].reshape(-1).astype(np.uint8)


def _state_maps() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All maps of states to states that any text can have, numbered, the map that changes nothing first.

    Returns the number of each map followed by one more character, that of each map followed by another, and the states
    to which the maps take START.
    """
    letters = [tuple(int(NEXT[s * KINDS + k]) for s in range(STATES)) for k in range(KINDS)]
    maps = {tuple(range(STATES)): 0}
    for one in (found := list(maps)):  # grows while it is read
        for letter in letters:
            longer = tuple(letter[s] for s in one)
            if longer not in maps:
                maps[longer] = len(maps)
                found.append(longer)
    table = np.array(found)
    longer = [[maps[tuple(letter[s] for s in one)] for letter in letters] for one in found]
    composed = [[maps[tuple(row)] for row in table[:, list(one)].tolist()] for one in found]
    return np.array(longer, np.int16).reshape(-1), np.array(composed, np.int16).reshape(-1), table[:, START].astype(np.int16)


LONGER, COMPOSED, FROM_START = _state_maps()
MAPS = len(FROM_START)


def class_runs(tokenizer: str) -> Runs:
    """Classes of all code points as runs, learned from the tokenizers library, whose Unicode tables decide.

    Neighbouring characters of one class are one word, so one pass over all code points finds the runs.
    """
    cut = Tokenizer.from_file(tokenizer).pre_tokenizer.pre_tokenize_str
    special = set(map(ord, " '" + "".join(_SMALL))) | set(range(0x09, 0x0E)) | set(range(0xD800, 0xE000))
    kinds: Runs = [(ord(c), ord(c) + 1, k) for c, k in {**_SMALL, " ": BLANK, "'": APOSTROPHE}.items()]
    kinds += [(0x09, 0x0E, SPACE)]
    points = [c for c in range(0x110000) if c not in special]
    text, firsts = "".join(map(chr, points)), []
    step = 1 << 14
    for at in range(0, len(points), step):
        firsts += [at + first for _, (first, _) in cut(text[at:at + step])]
    firsts.append(len(points))

    def joins(before: str, c: str) -> bool:
        return len(cut(before + c)) == 1

    for first, past in zip(firsts, firsts[1:], strict=False):
        c = text[first]
        kind = LETTER if joins("a", c) else NUMBER if joins("1", c) else OTHER if joins("!", c) else SPACE
        low = points[first]
        for place in range(first, past):  # a run may jump over characters with a class of their own
            if place + 1 == past or points[place + 1] != points[place] + 1:
                kinds.append((low, points[place] + 1, kind))
                low = points[place + 1] if place + 1 < past else low
    return kinds


def _slot(key: int) -> int:
    return (key * 2654435761 & 0xFFFFFFFF) >> 32 - SLOT_BITS


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint32) * np.uint32(2654435761) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)


class WordAutomaton:
    """The second transducer, numbered as texts reach it."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]], most: int = TABLE_STATES):
        self.ids, self.most = vocabulary, most
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}  # rank of the merge that makes a token
        for place, (a, b) in enumerate(merges):
            left, right, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.rank.setdefault((left, right), place)
            if whole not in self.made:
                self.made[whole], self.halves[whole] = place, (left, right)
        self._compile_trie()
        self.fits = functools.lru_cache(1 << 17)(self._fits)
        self._forget()

    def _compile_trie(self) -> None:
        """Trie of all tokens; of each node the next shorter end of it that begins a token (fail) and the token it is."""
        self.child: list[dict[int, int]] = [{}]
        self.depth, self.token = [0], [UNKNOWN]
        for word, token in self.ids.items():
            node = 0
            for byte in word:
                after = self.child[node].get(byte)
                if after is None:
                    after = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.depth.append(self.depth[node] + 1)
                    self.token.append(UNKNOWN)
                node = after
            self.token[node] = token
        self.fail = [0] * len(self.child)
        level = list(self.child[0].values())
        while level:
            following = []
            for node in level:
                for byte, after in self.child[node].items():
                    self.fail[after] = self._go(self.fail[node], byte)
                    following.append(after)
            level = following

    def _go(self, node: int, byte: int) -> int:
        while byte not in self.child[node]:
            if node == 0:
                return 0
            node = self.fail[node]
        return self.child[node][byte]

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay as they are side by side.

        Their merges are undone from the last one back; the two tokens at the border, while they stood there, must not
        have a merge of their own that came before the merge that took one of them away. Of equal merges the one further
        left comes first.
        """
        never = len(self.rank)
        limit = never  # merges across the border below this rank would have come first
        while True:
            if self.rank.get((left, right), never) < limit:
                return False
            made_left, made_right = self.made.get(left, UNKNOWN), self.made.get(right, UNKNOWN)
            if made_left == made_right == UNKNOWN:
                return True
            if made_left > made_right:
                left, limit = self.halves[left][1], made_left
            else:
                right, limit = self.halves[right][0], made_right + 1

    def _forget(self) -> None:
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.keys, self.entries = np.full(SLOTS, UNKNOWN, np.int32), np.zeros(SLOTS, np.int32)
        self.transitions = 0
        self._number((0, ((0, UNKNOWN, 0),)))

    def _number(self, state: tuple) -> int:
        found = self.known.get(state)
        if found is None:
            found = self.known[state] = len(self.states)
            self.states.append(state)
        return found

    def _entries(self, keys: np.ndarray) -> np.ndarray:
        """The transitions of keys (state * 256 + byte), compiled where they are new, by open addressing."""
        slots = _slots(keys)
        held = self.keys[slots]
        entries = self.entries[slots]
        open_ = np.flatnonzero(held != keys)
        while len(open_):
            free = held[open_] == UNKNOWN
            if free.any():
                for key in np.unique(keys[open_[free]]).tolist():
                    self._compile(key >> 8, key & 255)
            slots[open_[~free]] = (slots[open_[~free]] + 1) % SLOTS
            held[open_], entries[open_] = self.keys[slots[open_]], self.entries[slots[open_]]
            open_ = open_[held[open_] != keys[open_]]
        return entries

    def _entry(self, key: int) -> int:
        slot = _slot(key)
        while (held := self.keys[slot]) != key:
            if held == UNKNOWN:
                return self._compile(key >> 8, key & 255)
            slot = (slot + 1) % SLOTS
        return int(self.entries[slot])

    def _compile(self, number: int, byte: int) -> int:
        """The transition of a state over a byte. A state is (trie node, per end of what was read that begins a longer
        token: its length, the token before it, the tokens up to there less those of all that was read)."""
        node, ends = self.states[number]
        before = {length: (last, tokens) for length, last, tokens in ends}
        after = self._go(node, byte)
        chain, at = [], after
        while at:
            chain.append(at)
            at = self.fail[at]
        for reached in chain:  # from the longest
            token = self.token[reached]
            if token == UNKNOWN:
                continue
            last, tokens = before[self.depth[reached] - 1]
            if last == UNKNOWN or self.fits(last, token):
                break
        else:
            raise ValueError(f"no token ends with byte {byte}")
        change = tokens + 1
        kept = [(0, token, 0)]
        lives = 0
        for reached in reversed(chain):
            if self.child[reached]:
                last, tokens = before[self.depth[reached] - 1]
                kept.append((self.depth[reached], last, tokens - change))
                lives = reached
        entry = self._number((lives, tuple(kept))) * SHIFT + change + SHIFT // 2
        key = number * 256 + byte
        slot = _slot(key)
        while self.keys[slot] != UNKNOWN:
            slot = (slot + 1) % SLOTS
        self.keys[slot], self.entries[slot] = key, entry
        self.transitions += 1
        return entry

    def _full(self) -> bool:
        """Before the table is crowded; one step of all words of a block may come on top."""
        return len(self.states) > self.most or self.transitions > SLOTS // 2

    def _renewed(self, live: np.ndarray) -> np.ndarray:
        """Forget all states but ``live`` ones; their new numbers."""
        kept = [self.states[number] for number in live.tolist()]
        self._forget()
        return np.array([self._number(state) for state in kept], np.int32)

    def count_one(self, word: bytes, state: int = 0, tokens: int = 0) -> int:
        """Tokens of one word, or of the rest of one."""
        for byte in word:
            if self._full():
                state = int(self._renewed(np.array([state]))[0])
            state, change = divmod(self._entry(state * 256 + byte), SHIFT)
            tokens += change - SHIFT // 2
        return tokens

    def count(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of the words text[start:end], all read side by side, the longest first in order."""
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        first, sizes = starts[order], lengths[order]
        running = len(order) - np.searchsorted(sizes[::-1], np.arange(1, int(sizes[0]) + 1 if len(sizes) else 1))
        state, tokens = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        done = 0
        for done, active in enumerate(running.tolist()):
            if active <= FEW:
                break
            if self._full():
                live, which = np.unique(state[:active], return_inverse=True)
                state[:active] = self._renewed(live)[which]
            entry = self._entries(state[:active] * 256 + text[first[:active] + done])
            state[:active] = entry >> SHIFT_BITS
            tokens[:active] += (entry & SHIFT - 1) - SHIFT // 2
        else:
            done = len(running)
        left = int(running[done]) if done < len(running) else 0
        ends_of = [self.states[number] for number in state[:left].tolist()]
        for place in range(left):
            rest = text[first[place] + done:first[place] + sizes[place]].tobytes()
            tokens[place] = self.count_one(rest, self._number(ends_of[place]), int(tokens[place]))
        out = np.empty(len(order), np.int64)
        out[order] = tokens
        return out


def entry_states(columns: np.ndarray) -> np.ndarray:
    """The first transducer's state in front of every chunk, the first entered at START; ``columns`` holds the first
    characters of all chunks, then their second ones, and so on."""
    maps = np.zeros(columns.shape[1], np.int16)
    for column in columns:
        maps = LONGER.take(maps.astype(np.int32) * KINDS + column)
    # Prefix scan: after a round, maps[i] is the composition of the chunks i - 2 * reach + 1 to i.
    reach = 1
    while reach < len(maps):
        maps[reach:] = COMPOSED.take(maps[:-reach].astype(np.int32) * MAPS + maps[reach:])
        reach *= 2
    return np.concatenate([np.array([START], np.int16), FROM_START[maps[:-1]]])


def word_starts(kinds: np.ndarray) -> np.ndarray:
    """Where words start in a text given by the classes of its characters; END settles all before it."""
    padded = np.full(-(-(len(kinds) + 1) // CHUNK) * CHUNK, END, np.uint8)
    padded[:len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(-1, CHUNK).T)
    state, marks = entry_states(columns), np.empty_like(columns)
    for place, column in enumerate(columns):
        at = state.astype(np.int32) * KINDS + column
        MARKS.take(at, out=marks[place])
        state = NEXT.take(at)
    flat = marks.T.reshape(-1)
    here = (flat & HERE) > 0
    here[:-1] |= (flat[1:] & BEFORE) > 0
    return np.flatnonzero(here[:len(kinds)])


class TokenCounter:
    """A compiled tokenizer."""

    def __init__(self, tokenizer: str, runs: Runs):
        with open(tokenizer, encoding="utf-8") as source:
            given = json.load(source)
        model, cut = given["model"], given["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk",
                                              "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or not plain or given["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError("only byte-level BPE without a normaliser")
        added = [t for t in given["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("only added tokens that are found as they are")
        # The longest first, where several begin at one place.
        self.added = regex.compile(b"|".join(regex.escape(t["content"].encode()) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        letters = _byte_letters()
        spelled = {word: bytes(letters[c] for c in word) for word in model["vocab"] if all(c in letters for c in word)}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.words = WordAutomaton({spelled[w]: i for w, i in model["vocab"].items() if w in spelled}, [(spelled[a], spelled[b]) for a, b in merges])
        self.kinds = np.full(0x110000, OTHER, np.uint8)
        for low, past, kind in runs:
            self.kinds[low:past] = kind

    def pieces(self, texts: Iterator[bytes]) -> Iterator[tuple[int, int, bytes]]:
        """(place of the text, special tokens in front, stretch between them) in blocks; a block of a long text ends
        where a word surely starts, and nothing before such a place matters behind it."""
        for place, text in enumerate(texts):
            stretches = self.added.split(text) if self.added else [text]
            for number, stretch in enumerate(stretches):
                size = BLOCK_BYTES
                tokens = int(number > 0)
                while len(stretch) > size:
                    cut = self._last_start(stretch[:size])
                    if cut:
                        yield place, tokens, stretch[:cut]
                        stretch, size, tokens = stretch[cut:], BLOCK_BYTES, 0
                    else:
                        size *= 2  # one word fills the block
                yield place, tokens, stretch

    def _last_start(self, block: bytes) -> int:
        """Byte offset of the last word start in a block that what follows can't undo; 0 if there is none."""
        while block and block[-1] & 0xC0 == 0x80:
            block = block[:-1]
        known = block[:-1].decode()  # without the first byte of a character that may be cut
        kinds = self._kinds(known)
        starts = word_starts(kinds)
        # The end of the block is taken for the end of the text, which settles its last two characters, and blanks in
        # front of the cut would be.
        starts = starts[(starts > 0) & (starts < len(kinds) - 2)]
        starts = starts[~np.isin(kinds[starts - 1], (BLANK, SPACE))]
        return len(known[:starts[-1]].encode()) if len(starts) else 0

    def _kinds(self, text: str) -> np.ndarray:
        return self.kinds[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        held, size = [], 0
        for piece in self.pieces(iter(texts)):
            held.append(piece)
            size += len(piece[2]) + 1
            if size >= BLOCK_BYTES:
                self._add(held, out)
                held, size = [], 0
        if held:
            self._add(held, out)
        return out

    def _add(self, pieces: list[tuple[int, int, bytes]], out: np.ndarray) -> None:
        """Count many stretches as one text, each ended by a byte that is read as END."""
        np.add.at(out, [p for p, _, _ in pieces], [t for _, t, _ in pieces])
        ends = np.cumsum([len(s) + 1 for _, _, s in pieces])
        joined = np.frombuffer(b"\0".join([*(s for _, _, s in pieces), b""]), np.uint8)
        # A character starts at every byte but the following ones.
        begins = np.flatnonzero((joined & 0xC0) != 0x80)
        kinds = self._kinds(joined.tobytes().decode())
        closing = np.searchsorted(begins, ends - 1)
        kinds[closing] = END
        starts = begins[word_starts(kinds)]
        # A word ends where the next one starts or its stretch ends.
        stretch = np.searchsorted(ends, starts, side="right")
        past = np.minimum(np.append(starts[1:], ends[-1]), ends[stretch] - 1) if len(starts) else starts
        np.add.at(out, np.array([p for p, _, _ in pieces])[stretch], self.words.count(joined, starts, past))


def _byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies spell bytes: printable Latin-1 as it is, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(0x100 + i): b for i, b in enumerate(others)}}


@functools.lru_cache(2)
def _counter(tokenizer: str, runs: tuple) -> TokenCounter:
    return TokenCounter(tokenizer, list(runs))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    As the tokenizers library counts without added begin and end: special tokens inside a text count one each. NULL and
    empty texts have no tokens. NULL and repeated keys and repeated rows are kept, no rows give none. Other columns are
    ignored; the key must have another name than the columns added. Memory is bounded by the longest word, not the text.
    """
    kind = docs.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("key", to_arrow_type(kind)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    runs = tuple(class_runs(tokenizer))

    def counted(batches: Batches) -> Iterator[tuple]:
        counter = _counter(tokenizer, runs)
        held, size = [], 0
        for row in rows_of(batches, "key", "text"):
            held.append(row)
            size += len(row[1] or b"")
            if size >= BLOCK_BYTES:
                yield from _rows(counter, held)
                held, size = [], 0
        yield from _rows(counter, held)

    made = mapped(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), lambda batches: batches_of(counted(batches), schema),
                  f"key {kind.simpleString()}, n_bytes long, n_tokens long")
    return made.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _rows(counter: TokenCounter, held: list[tuple]) -> Iterator[tuple]:
    texts = [text or b"" for _, text in held]
    counts = counter.counts(texts).tolist()
    for (key, _), text, tokens in zip(held, texts, counts, strict=True):
        yield key.decode() if isinstance(key, bytes) else key, len(text), tokens
