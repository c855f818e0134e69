"""SentencePiece encoding and decoding through a table of distinct chunks.

A chunk is a run of whitespace markers with the characters that follow it. Where no piece of the vocabulary has a
marker after another character, no piece can cross the start of a chunk, so that the ids of a text are those of its
chunks in order. A batch is therefore cut into chunks, every distinct chunk is segmented once (the table of a worker
serves later batches too, up to a fixed size), and ids are joined back by position.

Models with pieces that cross markers are applied to whole texts instead.
"""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millstream.llm.arrow import add_columns

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Distinct chunks that a worker's table holds before it starts afresh, and characters cut into chunks at a time.
TABLE_CHUNKS = 100_000
SLICE_CHARS = 500_000


def _load(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def crosses_markers(sp: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether a piece holds a marker after another character, or markers aren't what separates words."""
    if any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size())):
        return True
    return sp.piece_to_id(MARK) == sp.unk_id() or not sp.normalize("a b").startswith(MARK)


class ChunkTable:
    """Ids of the distinct chunks seen so far, one after the other, with the place of each chunk."""

    def __init__(self, sp: sentencepiece.SentencePieceProcessor, limit: int = TABLE_CHUNKS):
        self.sp, self.limit = sp, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def places(self, chunks: list[str]) -> np.ndarray:
        """Place of each chunk; chunks not seen before are segmented, each once."""
        if len(self.place) > self.limit:
            self.clear()
        if new := list(set(chunks).difference(self.place)):
            # The library puts a marker before every text, which stands for the first marker of the chunk.
            found = self.sp.encode([c[1:] for c in new], num_threads=1)
            if MARK in new:
                found[new.index(MARK)] = [self.sp.piece_to_id(MARK)]
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) + self.starts[-1]
            self.starts = np.concatenate([self.starts, ends])
            self.ids = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), np.int32)])
        return np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))

    def join(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks at these places in order, and the number of ids of each."""
        sizes = self.starts[places + 1] - self.starts[places]
        before = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(self.starts[places] - before, sizes) + np.arange(sizes.sum())], sizes


def _encode_slice(table: ChunkTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and their number for each text."""
    chunks: list[str] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = CHUNK.findall(table.sp.normalize(text)) if text else []
        counts[i] = len(own)
        chunks += own
    ids, sizes = table.join(table.places(chunks))
    done = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.cumsum(counts)
    return ids, done[ends] - done[ends - counts]


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with the ids of the whole text as column `ids` (array of int, replaced if there).

    As the library's `encode` without begin or end ids and without sampling. Null and empty texts have no ids; every
    row stands for itself, so repeated rows stay; other columns pass unchanged. The driver reads the model file, and
    tasks get its content.
    """
    model = Path(model_path).read_bytes()
    whole = crosses_markers(_load(model))

    def start():
        sp = _load(model)
        table = ChunkTable(sp)

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            texts = [t or "" for t in columns[0].to_pylist()]
            if whole:
                return [pa.array(sp.encode(texts, num_threads=1), pa.list_(pa.int32()))]
            parts, first, size = [], 0, 0
            for i, t in enumerate(texts, 1):
                size += len(t)
                if size >= SLICE_CHARS or i == len(texts):
                    parts.append(_encode_slice(table, texts[first:i]))
                    first, size = i, 0
            if not parts:
                return [pa.array([], pa.list_(pa.int32()))]
            ends = np.cumsum(np.concatenate([n for _, n in parts]))
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            values = np.concatenate([v for v, _ in parts])
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))]

        return work

    return add_columns(docs, [text], [T.StructField(ids, T.ArrayType(T.IntegerType(), True))], start)


def decode(df: DataFrame, model_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`df` with the text of column `ids` as column `decoded` (replaced if there), as the library's `decode(ids)`.

    Null and empty lists give an empty text. A null inside a list is left out.
    """
    model = Path(model_path).read_bytes()

    def start():
        sp = _load(model)

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            rows = columns[0]
            if rows.flatten().null_count:
                rows = pa.array([[i for i in x or () if i is not None] for x in rows.to_pylist()], pa.list_(pa.int32()))
            # From numpy a row at a time: as Python objects the ids of a whole batch take many times their bytes.
            values, offsets = rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
            return [pa.array([sp.decode(values[a:b].tolist()) if a < b else "" for a, b in zip(offsets, offsets[1:])], pa.string())]

        return work

    return add_columns(df, [ids], [T.StructField(decoded, T.StringType())], start)
