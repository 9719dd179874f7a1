"""SentencePiece encoding and decoding through a table of distinct marked words.

Where no piece of a byte-pair model holds a whitespace marker after another character, merges never
cross from a word into the next marker: a text is a row of independent chunks (markers, then a word).
Each Arrow slice of bounded size splits its texts into chunks, segments every distinct chunk once, in
one call, and joins ids and surfaces back by position.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidelog.llm.common import appended, long, string

MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ChunkTable:
    """Tables of distinct chunks for one model."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.splits = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(pieces)]
        self.names = [str(i) for i in range(n)]
        self.splits = self.splits and self._plain()

    def _plain(self) -> bool:
        """Whether the model neither normalises nor drops spaces, and marks the start of a text."""
        probe = "ﬁ a  b ① x "
        return (self.model.decode(self.model.encode(probe)) == probe
                and self.model.encode("a") == self.model.encode("b a")[-len(self.model.encode("a")):]
                and not any(self.model.is_control(i) for i in self.model.encode("<s></s>")))

    @staticmethod
    def chunks(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The marked words of all texts in a row, with spaces for markers, and where each text begins.

        The model puts a marker before a text that is not empty.  A chunk starts at a space that follows
        another character, so runs of spaces stay with the word behind them.
        """
        parts = [b" " + t.replace(MARK, " ").encode() if t else b"" for t in texts]
        data = np.frombuffer(b"".join(parts), np.uint8)
        begins = np.cumsum([0, *map(len, parts)])
        space = data == 0x20
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[begins[:-1][begins[:-1] < len(data)]] = True
        starts = np.flatnonzero(first)
        offsets = np.append(starts, len(data)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
        return words, np.searchsorted(starts, begins)

    def segmented(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk; the model adds the first marker itself, but none to an empty text."""
        alone = [self.model.piece_to_id(MARK)]
        found = self.model.encode([c[1:] for c in chunks], num_threads=1)
        return [ids if c != " " else alone for c, ids in zip(chunks, found)]

    def joined(self, texts: list[str], want: tuple[str, ...]) -> dict[str, pa.Array]:
        """What is wanted of ``ids``, ``names`` (ids joined by commas), ``n_tokens`` and ``surface`` (the bytes that
        the ids decode to), per text."""
        if not self.splits:  # pieces may cross markers: whole texts, and the model's own decoder
            found = self.model.encode(texts, num_threads=1)
            made = {"ids": lambda: pa.array(found, IDS), "n_tokens": lambda: pa.array(list(map(len, found)), pa.int64()),
                    "names": lambda: pa.array([",".join(map(str, ids)) for ids in found], pa.large_string()),
                    "surface": lambda: pa.array([self.model.decode(ids).encode() for ids in found], pa.large_binary())}
            return {c: made[c]() for c in want}
        words, begins = self.chunks(texts)
        coded = words.dictionary_encode()
        at = coded.indices
        found = self.segmented(coded.dictionary.to_pylist())
        rows = pa.array(begins, pa.int64())
        out = {}
        if "ids" in want or "n_tokens" in want:
            counts = np.append(0, np.cumsum(np.array(list(map(len, found)), np.int64)[at.to_numpy()]))[begins]
            out["n_tokens"] = pa.array(np.diff(counts))
        if "ids" in want:
            out["ids"] = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(found, IDS).take(at).flatten())
        if "names" in want:
            ids = pa.array([",".join(map(self.names.__getitem__, x)) for x in found], pa.large_string())
            out["names"] = pc.binary_join(pa.LargeListArray.from_arrays(rows, ids.take(at)), pa.scalar(",", pa.large_string()))
        if "surface" in want:
            surface = pa.array([b"".join(map(self.bytes.__getitem__, x)) for x in found], pa.large_binary())
            surface = pc.binary_join(pa.LargeListArray.from_arrays(rows, surface.take(at)), pa.scalar(b"", pa.large_binary()))
            # the first marker stands for no character: decoding drops its space
            out["surface"] = pa.array([s[1:] for s in surface.to_pylist()], pa.large_binary())
        return out


IDS = pa.list_(pa.int32())
#: What an output is made of, where it is not given as it is.
SOURCES = {"ids_sha256": "names", "decoded": "surface", "decoded_sha256": "surface"}


def _start(model: str, want: tuple[str, ...]):
    table = ChunkTable(model)

    def work(texts: list[str | None]):
        made = table.joined([t or "" for t in texts], tuple(SOURCES.get(c, c) for c in want))
        for c in want:
            values = made[SOURCES.get(c, c)]
            yield (values.cast(pa.large_string()).cast(pa.string()) if c == "decoded" else
                   [hashlib.sha256(v.as_buffer() or b"").hexdigest() for v in values] if c in SOURCES else values)

    return work


KINDS = {"ids": T.StructField("ids", T.ArrayType(T.IntegerType())), "n_tokens": long("n_tokens"),
         "decoded": string("decoded"), "ids_sha256": string("ids_sha256"), "decoded_sha256": string("decoded_sha256")}


def encode(docs: DataFrame, model: str | None = None, text_col: str = "text", keep: list[str] | None = None,
           outputs: tuple[str, ...] = ("ids", "n_tokens", "decoded")) -> DataFrame:
    """Ids of every whole text and the text they decode to, with the ``keep`` columns (all by default).

    ``outputs`` may name ids, n_tokens, decoded, ids_sha256 and decoded_sha256.  A null text counts as
    empty: no ids, and it decodes to the empty text.  A chunk may be as long as its text.  A kept column
    named like an output is replaced.  Rows are not shuffled; equal texts give equal rows.
    """
    return appended(docs, [text_col], docs.columns if keep is None else keep, [KINDS[c] for c in outputs],
                    partial(_start, model or default_model(), outputs))


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the decoded text."""
    return encode(docs, model, keep=["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
