"""Words of many texts as numbers, straight from Arrow buffers: no Python object per word."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidelog.llm.common import give_back, slices

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """``codes`` are the word numbers of all texts in a row, ``spellings`` the words they stand for;
    text i has the words from ``bounds[i]`` to ``bounds[i + 1]``."""

    codes: np.ndarray
    spellings: pa.LargeBinaryArray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def texts(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1, dtype=np.int32), self.counts)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """The words between the six ASCII spaces; a null text has none.  ``lower`` turns A-Z to a-z first."""
    texts = pc.fill_null(texts, "")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1] or np.zeros(1, width), width)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    edges = ends.astype(np.int64) - ends[0]
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    starts = np.flatnonzero(first)
    kept = data[inside]
    if lower:
        kept = np.where((kept >= 65) & (kept <= 90), kept | 32, kept)
    # how many bytes of words come before each start
    before = np.cumsum(inside, dtype=np.int64)[starts] - 1 if len(starts) else np.zeros(0, np.int64)
    offsets = np.append(before, len(kept)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    return Words(coded.indices.to_numpy(), coded.dictionary, np.searchsorted(starts, edges))


def joined(words: Words, kept: np.ndarray) -> pa.Array:
    """Per text, the words at the ascending positions ``kept`` joined by one space."""
    lists = pa.LargeListArray.from_arrays(np.searchsorted(kept, words.bounds).astype(np.int64),
                                          words.spellings.take(pa.array(words.codes[kept])))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of every 64-bit value."""
    x = x.astype(np.uint64) + _MIX
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_slices(df: DataFrame, text_at: int, schema, work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``work`` on Arrow slices of bounded text; ``text_at`` is the place of the text among the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_at):
                yield work(part)
        give_back()

    return df.mapInArrow(run, schema)


def others(df: DataFrame, taken: list[str]) -> list[str]:
    """The columns of ``df`` but those that Spark would take for one of the names ``taken``."""
    names = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in names]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
