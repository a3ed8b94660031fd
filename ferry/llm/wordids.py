"""Encoding by distinct units.

A tokenizer whose merges never cross a unit (a word with its leading space)
gives a text the concatenation of its units' ids. Units repeat far more often
than texts, so each Python worker keeps a table from unit to packed ids and
asks the tokenizer only for units it has not met, many at a time. The table is
bounded by units and by bytes: when it is full the older half is dropped, which
costs time, never rows. A worker that goes on to another operator empties the tables of the last
one (``only``), so a worker holds the tables of one operator at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np

MAX_UNITS = 400_000
MAX_BYTES = 96 << 20
UNIT_BYTES = 160  # of a unit in the table, beside its characters and ids
CHUNK_BYTES = 1 << 20


_TABLES: list[UnitTable] = []


def only(*tables: UnitTable) -> None:
    """Empty all other tables of this worker."""
    for t in _TABLES:
        if not any(t is x for x in tables):
            t.young, t.old, t.size = {}, {}, 0


class UnitTable:
    """``encode_units(units)`` behind a bounded table: a list of id lists (or of
    packed ids), or all ids in one array with the number of each unit's."""

    def __init__(self, encode_units: Callable[[list], list | tuple], dtype: str):
        self.encode_units = encode_units
        self.dtype = np.dtype(dtype)
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0
        _TABLES.append(self)

    def pack(self, unit_lists: list[list]) -> list[bytes]:
        """The packed ids of each list of units."""
        missing = set(chain.from_iterable(unit_lists)).difference(self.young)
        if self.old and missing:
            held = {u: self.old[u] for u in missing if u in self.old}
            self._keep(held)
            missing.difference_update(held)
        if missing:
            units = list(missing)
            self._keep(dict(zip(units, self._packed(self.encode_units(units)), strict=True)))
        get = self.young.__getitem__
        out = [b"".join(map(get, units)) for units in unit_lists]
        if len(self.young) > MAX_UNITS // 2 or self.size > MAX_BYTES // 2:
            self.young, self.old, self.size = {}, self.young, 0
        return out

    def _keep(self, packed: dict) -> None:
        self.young.update(packed)
        self.size += (UNIT_BYTES * len(packed) + sum(map(len, packed))
                      + sum(map(len, packed.values())))

    def _packed(self, found: list | tuple) -> list[bytes]:
        if isinstance(found, tuple):
            ids, counts = found
            data = np.asarray(ids, self.dtype).tobytes()
            ends = (np.cumsum(counts) * self.dtype.itemsize).tolist()
            return [data[a:b] for a, b in zip([0, *ends], ends)]
        return [x if isinstance(x, bytes) else np.asarray(x, self.dtype).tobytes() for x in found]


def chunks(texts: Iterable, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list]]:
    """``(first index, texts)`` in runs of about ``limit`` characters."""
    first, run, size = 0, [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= limit:
            yield first, run
            first, run, size = first + len(run), [], 0
    if run:
        yield first, run


# Where a word starts: see ``cut_words``.
_CUT = re.compile(r"(?<! )(?= \S)|(?<!\s)(?=\n)")


def cut_words(text: str) -> list[str]:
    """``space + text`` in words: cut at a space that stands behind another
    character and before a word, and at a line break behind a word. A word is
    given without its leading space; one that starts with a line break has
    none. A text that starts with one would be taken for such a word: no cut,
    no words."""
    if not text or text[0] == "\n":
        return []
    words = text.replace("\n", " \n").split(" ")
    # Printable text holds no other white space; then an empty word or a bare
    # line break is all that tells two white-space characters side by side.
    if "" in words or "\n" in words or not text.replace("\n", "").isprintable():
        return [w[1:] if w[0] == " " else w for w in _CUT.split(" " + text) if w]
    return words
