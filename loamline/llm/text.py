"""Word-level helpers on Arrow string arrays, used inside Arrow UDFs.

They work on slices of a few megabytes of text, so a worker's memory does not grow with the
partition, only with its longest single text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one slice holds, if no single text is longer.
SLICE_BYTES = 4 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: As _FOLD, and every ASCII byte that is no letter or digit becomes a space.
_ALNUM = _FOLD.copy()
_ALNUM[[b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)]] = 32


def slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of ``text`` of about ``limit`` bytes each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
        yield text.slice(at, to - at)
        at = to


def by_slices(text: pa.Array, f: Callable[[pa.Array], pa.Array], empty: pa.DataType) -> pa.Array:
    """``f`` over the slices of ``text`` with nulls read as empty texts; ``empty`` types no rows."""
    parts = [f(pc.fill_null(part, "")) for part in slices(text)]
    return pa.concat_arrays(parts) if parts else pa.array([], empty)


def mapped(text: pa.Array, table: np.ndarray) -> pa.Array:
    """``text``, each byte replaced through ``table``, which must keep UTF-8 valid."""
    text = pa.concat_arrays([text.cast(pa.large_string())])
    _, offsets, data = text.buffers()
    n, o = len(text), text.offset
    ends = np.frombuffer(offsets, np.int64)[o : o + n + 1] if offsets is not None else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(ends - ends[0])), pa.py_buffer(table[raw]))


def lower_ascii(text: pa.Array) -> pa.Array:
    """``text`` with A-Z lower-cased and all else as it is."""
    return mapped(text, _FOLD)


def alnum_ascii(text: pa.Array) -> pa.Array:
    """``text`` with A-Z lower-cased and spaces for ASCII that is no letter or digit."""
    return mapped(text, _ALNUM)


@dataclass
class Words:
    """Words of consecutive texts: text i has the words ids[offsets[i]:offsets[i + 1]]."""

    offsets: np.ndarray
    ids: np.ndarray
    names: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def per_text(self, of_name: np.ndarray) -> np.ndarray:
        """Sums over each text of a number that belongs to each distinct word."""
        total = np.concatenate(([0], np.cumsum(of_name[self.ids]))) if len(self.ids) else np.zeros(1, of_name.dtype)
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and words ``[^\\x20\\x09-\\x0D]+`` of null-free texts."""
    lists = pc.ascii_split_whitespace(text)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if len(lists) else lists.values
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False).astype(np.int64))))
    return kept[offsets], flat.filter(full)


def words_of(text: pa.Array) -> Words:
    """The words of null-free texts with a dictionary of the distinct ones."""
    offsets, flat = split_words(text)
    coded = flat.dictionary_encode()
    return Words(offsets, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit integers (the splitmix finaliser)."""
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(x: pa.Array) -> np.ndarray:
    """An integer Arrow array as 64-bit numpy."""
    return x.to_numpy(zero_copy_only=False).astype(np.int64)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i] + 1, ... (sizes[i] of them) for each i, one after another."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
