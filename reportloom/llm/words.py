"""Encodings of words, remembered within a worker process."""

from __future__ import annotations

from collections.abc import Callable
from typing import Generic, TypeVar

Word = TypeVar("Word", str, bytes)

LONGEST = 64  # longer words are encoded each time, so that the memory is bounded
REMEMBERED = 150_000  # words of each of two generations


class WordCache(Generic[Word]):
    """Word -> bytes of its encoding. ``encode`` takes a list of words and returns their encodings in order.

    Two generations: when the young one is full it becomes the old one, and words found there move up.
    """

    def __init__(self, encode: Callable[[list[Word]], list[bytes]], remembered: int = REMEMBERED):
        self.encode, self.remembered = encode, remembered
        self.young: dict[Word, bytes] = {}
        self.old: dict[Word, bytes] = {}

    def joined(self, words: list[Word]) -> bytes:
        """The encodings of all words, one after the other."""
        found = list(map(self.young.get, words))
        places = [at for at, code in enumerate(found) if code is None]
        if places:
            self._fill(words, found, places)
        return b"".join(found)

    def _fill(self, words: list[Word], found: list[bytes | None], places: list[int]) -> None:
        missing = dict.fromkeys(map(words.__getitem__, places))
        unknown = []
        for word in missing:
            missing[word] = self.old.get(word)
            if missing[word] is None:
                unknown.append(word)
        for word, code in zip(unknown, self.encode(unknown) if unknown else [], strict=True):
            missing[word] = code
        for at in places:
            found[at] = missing[words[at]]
        if len(self.young) + len(missing) > self.remembered:
            self.old, self.young = self.young, {}
        if len(missing) <= self.remembered:
            self.young.update((w, c) for w, c in missing.items() if len(w) <= LONGEST)
