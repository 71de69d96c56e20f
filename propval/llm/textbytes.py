"""Vectorised work on the UTF-8 bytes of Arrow string columns.

Every function takes the bytes of many texts at once (``data`` and the
``offsets`` of the texts in it) and runs in numpy over all of them, so a
Python call costs per batch, not per row or per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

U = np.uint64
SLICE_BYTES = 1 << 20                     # text handled at once by one numpy pass

IS_WORD = np.ones(256, bool)              # words are runs of [^\x20\x09-\x0D]
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)    # A-Z only
LOWER[65:91] += 32

BASE = U(0x9E3779B97F4A7C15)              # odd, so it has an inverse mod 2^64
_INVERSE = U(pow(int(BASE), -1, 1 << 64))
_power, _inverse = np.ones(1, U), np.ones(1, U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every input bit (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


CODES = mix(np.arange(1, 257, dtype=U))   # a random 64-bit code for each byte value
CODES_LOWER = CODES[LOWER]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _inverse
    if len(_power) < n:
        m = max(n, SLICE_BYTES + 1)
        step = np.full(m, BASE, U), np.full(m, _INVERSE, U)
        step[0][0] = step[1][0] = U(1)
        _power, _inverse = np.cumprod(step[0]), np.cumprod(step[1])
    return _power[:n], _inverse[:n]


class SpanHash:
    """64-bit hashes of any spans of ``data`` (equal spans, equal hashes)."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        n = len(data)
        power, self.inverse = _powers(n + 1)
        self.prefix = np.zeros(n + 1, U)
        np.cumsum((CODES_LOWER if lower else CODES)[data] * power[:n], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, body = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, size[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; words don't cross texts."""
    inside = IS_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    edge = offsets[:-1][full]
    first[edge] = inside[edge]
    edge = offsets[1:][full] - 1
    last[edge] = inside[edge]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    run = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def windows(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word number, hash) of every window of n words inside one text."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    key = hashes[:m].copy()
    for i in range(1, n):
        key = key * BASE + hashes[i:m + i]
    at = np.flatnonzero(owner[:m] == owner[n - 1:])
    return at, mix(key[at] + U(n))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks every key that occurs twice or more."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def seen_before(keys: np.ndarray) -> np.ndarray:
    """Marks every key that is equal to one before it."""
    out = np.zeros(len(keys), bool)
    again = np.flatnonzero(repeated(keys))
    if len(again):
        order = again[np.argsort(keys[again], kind="stable")]
        out[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return out


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without the columns called like one of names, in any case."""
    lower = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str], list]:
    """df with columns named so that no operator's own can clash, those names
    by the old ones, and the expressions that give the old columns back."""
    names = {c: f"_{i}_{c}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names, [F.col(f"`{n}`").alias(c) for c, n in names.items()]


def append_columns(df: DataFrame, text: str, fields: list[T.StructField],
                   compute: Callable[[pa.Array], list]) -> DataFrame:
    """df with columns that ``compute`` derives from the texts, in Arrow
    batches.  Input columns that have the name of a new one are replaced."""
    df = without(df, [f.name for f in fields])
    schema = T.StructType(df.schema.fields + fields)

    def run(batches):
        for part in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*part.columns, *compute(part.column(text))],
                                             names=[*part.schema.names, *(f.name for f in fields)])
    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, text: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of df, in its own columns, whose text ``keep`` marks."""
    def run(batches):
        for part in slices(batches, text):
            yield part.filter(pa.array(keep(part.column(text))))
    return df.mapInArrow(run, df.schema)
