"""Helpers shared by the operators: table access, the shared folder, Arrow plumbing and hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import forget, shared_path, stored

__all__ = ["forget", "shared_path", "stored"]

#: Texts handled together inside a Python worker; bounds the memory of one step whatever Arrow's batch size is.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to about limit; one larger row is a range of its own."""
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def as_list(texts: pa.Array) -> list:
    """The same as to_pylist(), for texts and bytes several times faster."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def text_slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches with their texts as Python values (bytes for binary columns, null as empty)."""
    for batch in batches:
        texts = batch.column(column)
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        empty = b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else ""
        for a, b in slices(sizes):
            yield batch.slice(a, b - a), as_list(pc.fill_null(texts.slice(a, b - a), empty))


def array_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 * SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches with their texts as Arrow arrays (null as empty)."""
    for batch in batches:
        texts = batch.column(column)
        for a, b in slices(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), limit):
            yield batch.slice(a, b - a), pc.fill_null(texts.slice(a, b - a), "")


def map_arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(step, schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0]+1, ... of all ranges one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (public constants of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_held: dict[str, Callable[[], object]] = {}


def hold_memory(name: str, forget: Callable[[], object]) -> None:
    """Called where a worker begins to use its caches of that name: what other operators left in this worker goes.

    Workers serve one stage after the other, so without this the caches of all stages would add up.
    """
    for other in [x for x in _held if x != name]:
        _held.pop(other)()
    _held[name] = forget


class Interned(dict):
    """Gives each new key the next number and remembers it as pending."""

    def __init__(self) -> None:
        super().__init__()
        self.pending: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.pending.append(key)
        return number
