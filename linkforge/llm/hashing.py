"""Words of Arrow text columns and their hashes, for whole batches at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that are worked on at once; a longer text is worked on alone. Hashing takes some fifty
#: times as much at its peak, in each of an executor's Python workers.
PIECE_BYTES = 1 << 18
SPACES = (9, 10, 11, 12, 13, 32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: An odd base of the words' polynomials.
BASE = 0x5851F42D4C957F2B


class Memo:
    """What a process has made already. It travels empty, with the functions that use it."""

    def __init__(self) -> None:
        self.made: dict[str, object] = {}

    def __reduce__(self) -> tuple:
        return Memo, ()

    def __call__(self, name: str, make: Callable) -> object:
        if name not in self.made:
            self.made[name] = make()
        return self.made[name]


MEMO = Memo()


def byte_values() -> np.ndarray:
    return MEMO("bytes", lambda: mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        power, back = (np.full(n + 1, x, np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64)))
        power[0] = back[0] = 1
        return np.multiply.accumulate(power), np.multiply.accumulate(back)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the 0 to n, and its inverse to the 0 to n; made once a task for usual pieces."""
    return MEMO("powers", lambda: _powers(PIECE_BYTES)) if n <= PIECE_BYTES else _powers(n)


class Words:
    """The words of a run of texts. data: their bytes; bounds: where each text begins, and the end;
    start, end: of each word; first: the number of each text's first word, and the count."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        space = np.zeros(256, bool)
        space[list(SPACES)] = True
        solid = ~space[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = ~solid[:-1]
        edge[bounds] = True
        after = np.ones(len(data) + 1, bool)
        after[1:-1] = ~solid[1:]
        after[bounds] = True
        self.data, self.bounds = data, bounds
        self.start = np.flatnonzero(solid & edge[:-1])
        self.end = np.flatnonzero(solid & after[1:]) + 1
        self.first = np.searchsorted(self.start, bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial of its bytes, from prefix sums, then mixed."""
        n = len(self.data)
        power, back = powers(n)
        total = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.multiply(byte_values()[self.data], power[:n], out=total[1:])
            np.cumsum(total, out=total)
            return mix((total[self.end] - total[self.start]) * back[self.start])

    def joined(self, i: int, j: int) -> bytes:
        """Words i to j-1 of one text, a space between two."""
        return b" ".join(self.data[self.start[i] : self.end[j - 1]].tobytes().split()) if j > i else b""


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k hashes from each place on; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out = out * np.uint64(0x2545F4914F6CDD1D) + h[i : i + n]
    return mix(out)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a text column; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z made a-z; other bytes, also those of other letters, stay."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def release() -> None:
    """Give free memory back to the machine: Python workers stay between tasks, with what they have held
    at their peak, and an executor's limit counts them all. What a worker has loaded by then is no more
    looked through for garbage, which Spark collects after each task: that took 30 ms a task."""
    if not gc.get_freeze_count():
        gc.collect()
        gc.freeze()
    pa.default_memory_pool().release_unused()
    MEMO("trim", lambda: getattr(ctypes.CDLL(None), "malloc_trim", int))(0)


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with about PIECE_BYTES of text: (rows, bytes, bounds)."""
    place = batch.schema.get_field_index(column)
    release()
    size = np.cumsum(np.r_[0, np.diff(text_buffer(batch.column(place))[1])])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, size[at] + PIECE_BYTES, "right")) - 1)
        some = batch.slice(at, to - at)
        yield some, *text_buffer(some.column(place))
        at = to
    release()
