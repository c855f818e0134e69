"""Fingerprints of documents: quartile digests of hashed byte triplets.

The triplets of a text's UTF-8 bytes (three bytes, GAP apart from each other) are hashed into BUCKETS buckets and counted.
A bucket is then told by the quartile of all buckets' counts that it lies in, two bits each, behind a byte for the length
on a logarithmic scale. Texts that share most of their triplets have digests that differ in few buckets by few quartiles,
however the text is shifted, and a digest has the same small size for any text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm.arrow import add_columns

BUCKETS, GAP = 512, 3
#: Steps of the length for twice as long a text, what a step of difference counts, and the most that it counts in all.
_OCTAVE, _STEP, _LENGTHS = 6, 4, 128
#: Bytes of a text that are hashed at a time, and texts whose counts are held at a time.
_BYTES, _TEXTS = 1 << 18, 1024
_U = np.uint32


def counts(text: bytes) -> np.ndarray:
    """How many of the text's triplets fall into each bucket; none for texts of 2 * GAP bytes or fewer."""
    x, made = np.frombuffer(text, np.uint8), np.zeros(BUCKETS, np.int64)
    for at in range(0, len(x) - 2 * GAP, _BYTES):
        part = x[at : at + _BYTES + 2 * GAP].astype(_U)
        h = part[: -2 * GAP] | part[GAP:-GAP] << _U(8) | part[2 * GAP :] << _U(16)
        h *= _U(0x9E3779B1)  # the finaliser of a 32-bit hash
        h ^= h >> _U(15)
        h *= _U(0x85EBCA6B)
        made += np.bincount((h >> _U(32 - (BUCKETS - 1).bit_length())).astype(np.int64), minlength=BUCKETS)
    return made


def digests(texts: list[str | None]) -> list[str]:
    """The fingerprint of each text in hexadecimal digits; null counts as empty."""
    found = []
    for at in range(0, len(texts), _TEXTS):
        raw = [(t or "").encode() for t in texts[at : at + _TEXTS]]
        held = np.stack([counts(t) for t in raw])
        ranks = np.sort(held, axis=1)[:, [BUCKETS * q // 4 - 1 for q in (1, 2, 3)]]
        quartile = (held[:, :, None] > ranks[:, None, :]).sum(2).astype(np.uint8).reshape(len(raw), -1, 4)
        body = quartile[:, :, 0] | quartile[:, :, 1] << 2 | quartile[:, :, 2] << 4 | quartile[:, :, 3] << 6
        length = np.log2(1 + np.fromiter(map(len, raw), np.float64, len(raw))) * _OCTAVE
        whole = np.concatenate([np.rint(length).clip(max=255).astype(np.uint8)[:, None], body], axis=1)
        found += [row.tobytes().hex() for row in whole]
    return found


def _read(prints: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Digests as bytes, and which of them are digests."""
    size, rows, good = 1 + BUCKETS // 4, [], []
    for p in prints:
        try:
            row = bytes.fromhex(p or "")
        except ValueError:
            row = b""
        good.append(len(row) == size)
        rows.append(row if good[-1] else bytes(size))
    return np.array([np.frombuffer(r, np.uint8) for r in rows], np.uint8).reshape(-1, size), np.array(good, bool)


def alike(left: list[str | None], right: list[str | None]) -> np.ma.MaskedArray:
    """Likeness of each pair of fingerprints, from 0 to 1 for equal ones; masked where one is none."""
    (a, one), (b, two) = _read(left), _read(right)
    apart = np.zeros(len(a), np.int64)
    for bit in (0, 2, 4, 6):
        apart += np.abs((a[:, 1:] >> bit & 3).astype(np.int64) - (b[:, 1:] >> bit & 3)).sum(1)
    apart += np.minimum(_STEP * np.abs(a[:, 0].astype(np.int64) - b[:, 0]), _LENGTHS)
    return np.ma.masked_array(1 - apart / (3 * BUCKETS + _LENGTHS), ~(one & two))


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """`docs` with `out`, the fingerprint of its whole text in hexadecimal digits.

    Equal texts have equal fingerprints; null counts as empty. Texts of 6 bytes or fewer have no triplet and differ by
    their lengths only. A column named `out` is replaced; all others pass, and repeated rows stay.
    """

    def start():
        return lambda columns: [pa.array(digests(columns[0].to_pylist()), pa.string())]

    return add_columns(docs, [text], [T.StructField(out, T.StringType())], start)


def likeness(rows: DataFrame, left: str, right: str, out: str = "likeness") -> DataFrame:
    """`rows` with `out`, the likeness of two fingerprints from 0 to 1; null where either isn't one."""

    def start():
        def work(columns: list[pa.Array]) -> list[pa.Array]:
            found = alike(columns[0].to_pylist(), columns[1].to_pylist())
            return [pa.array(found.data, pa.float64(), mask=np.ma.getmaskarray(found))]

        return work

    return add_columns(rows, [left, right], [T.StructField(out, T.DoubleType())], start)
