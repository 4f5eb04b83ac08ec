"""Cutting text into short strings that a byte-level BPE encodes independently.

The vocabulary's pre-tokeniser joins at most one leading space to a word and
keeps runs of white space apart, so a text may be cut before any space whose
neighbour on one side is not white space: the pieces on both sides are the
same as in the whole text.  Distinct cuts are few, so each is encoded once per
worker and kept in a bounded cache.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space with white space before and white space (or the end) after it: such texts are not cut there.
_UNSAFE = re.compile(r" (?<=\s\s)(?=\s|\Z)")


def chunks(text: str) -> list[str]:
    """Strings that concatenate to ``text`` and can be encoded one by one."""
    if not text:
        return []
    if _UNSAFE.search(text):
        return _careful(text)
    parts = text.split(" ")
    out = [" " + p for p in parts]
    out[0] = parts[0]
    return out if parts[0] else out[1:]


def _careful(text: str) -> list[str]:
    """As ``chunks``, cutting only before a space that stands before a non-space."""
    return [c for c in re.split(r"(?= \S)", text) if c]


#: White space next to white space, or a space at the end, may be cut only with care (more than needed match).
_SPACES = r"\s\x0b\x1c-\x1f\x85\p{Z}"
UNSAFE = rf"[{_SPACES}] [{_SPACES}]|[{_SPACES}] \z"
#: A space and what does not begin or end in white space.
APART = rf"(?s)\A [^{_SPACES}](?:.*[^{_SPACES}])?\z"


class ChunkNumbers:
    """Numbers of the chunks met so far; what is known of a chunk stands at its number.

    Number 0 is the empty chunk.  Above ``limit`` chunks or ``limit_chars`` characters the
    less used ones are forgotten, at least half of all, and learned again if they come back.
    """

    def __init__(self, limit: int, limit_chars: int = 32 << 20):
        self._limit, self._limit_chars = limit, limit_chars
        self._number, self._chars, self._uses = {"": 0}, 0, np.zeros(1, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Find out what is to be known of new distinct chunks, and name them (others besides, in any order)."""
        raise NotImplementedError

    def _kept(self, numbers: np.ndarray) -> None:
        """Drop what is known of all chunks but these."""
        raise NotImplementedError

    def _name(self, chunks: list[str]) -> None:
        first = len(self._number)
        self._number.update(zip(chunks, range(first, first + len(chunks)), strict=True))
        self._chars += sum(map(len, chunks))
        self._uses = np.concatenate([self._uses, np.zeros(len(chunks), np.int64)])

    def numbers(self, chunks: list[str]) -> np.ndarray:
        found = np.array(list(map(self._number.get, chunks, repeat(-1))), np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            unknown = [chunks[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(unknown)))
            found[new] = list(map(self._number.__getitem__, unknown))
        return found

    def make_room(self) -> None:
        """Forget less used chunks if there are too many; numbers given before are void then."""
        if len(self._number) <= self._limit and self._chars <= self._limit_chars:
            return
        names = list(self._number)
        size = np.fromiter(map(len, names), np.int64, len(names))
        order = np.argsort(-self._uses, kind="stable")
        order = order[(self._uses[order] > 1) & (np.cumsum(size[order]) <= self._limit_chars // 2)][:self._limit // 2]
        keep = np.union1d(order, [0])
        self._kept(keep)
        self._number = {names[i]: n for n, i in enumerate(keep.tolist())}
        self._chars, self._uses = int(size[keep].sum()), self._uses[keep] // 2

    def _count(self, numbers: np.ndarray) -> None:
        self._uses += np.bincount(numbers, minlength=len(self._uses))

    def plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Chunk numbers of texts that may be cut before every space, and where each text's end."""
        lists = pc.split_pattern(texts, " ")
        off = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
        off = off - off[0]
        words, place = coded.dictionary, coded.indices.to_numpy()
        spaced = pc.binary_join_element_wise(" ", words, "")
        numbers = self.numbers(spaced.to_numpy(zero_copy_only=False).tolist())[place]
        numbers[off[:-1]] = self.numbers(words.take(pa.array(place[off[:-1]])).to_pylist())
        self._count(numbers)
        return numbers, off[1:]

    def careful(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of any texts."""
        cut = [chunks(t) for t in texts.to_pylist()]
        numbers = self.numbers([c for cs in cut for c in cs])
        self._count(numbers)
        return numbers, np.cumsum([len(cs) for cs in cut])


def unsafe(texts: pa.Array) -> np.ndarray:
    """Which texts may not be cut before every space."""
    return pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)


def apart(chunks: list[str]) -> np.ndarray:
    """Which chunks stay apart when they are joined: those of a space and no white space next to it or at the end."""
    return pc.match_substring_regex(pa.array(chunks, pa.large_string()), APART).to_numpy(zero_copy_only=False)
