"""Vectorised access to the text of Arrow batches.

A document's words are the runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; every function here works on
one bounded block of documents at a time, so a task's memory follows the block size and not the batch or
the partition. A single document longer than a block makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text per block.
BLOCK_BYTES = 1 << 20
#: Bytes of an Arrow batch on its way to Python, and the setting's default.
BATCH_BYTES = "4m"
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys64(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
        return mix64(base) | np.uint64(1)


BYTE_KEYS = keys64(256, 11)
_places = keys64(1024, 23)


def place_keys(n: int) -> np.ndarray:
    """Keys of the first n byte places of a word."""
    global _places
    if n > len(_places):
        _places = keys64(max(n, 2 * len(_places)), 23)
    return _places


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def small_batches(df) -> None:
    """Let the session send smaller batches to Python, unless it has a size of its own.

    Rows of text are large: batches of the default size take several times it in the JVM's buffers and again
    in each worker.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING).rstrip("b") == _BATCH_DEFAULT:
        conf.set(_BATCH_SETTING, BATCH_BYTES)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; a run ends where its document does."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    before[edges] = False
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of the first word of each document (one entry more than documents)."""
    starts, ends = runs(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each non-empty span; spans ascend without overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    total = int(at[-1] + lengths[-1])
    place = np.arange(total, dtype=np.int64)
    place -= np.repeat(at, lengths)
    where = place + np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(BYTE_KEYS[data[where]] * place_keys(int(lengths.max()))[place], at)
        return mix64(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def code_points(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte place (one entry more than bytes)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def plain_names(docs) -> tuple:
    """(docs with columns c0, c1, ..., the new name of each old one): no name of docs meets one that an operator adds."""
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*at.values()), at
