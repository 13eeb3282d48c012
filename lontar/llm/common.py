"""Helpers that the operators of this subpackage share: checkpoints, Arrow slices and vectorised word hashes."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lontar.operators.cut import shared_dir

#: Java and Python pattern of one word: a run of anything but space, tab, line ends, vertical tab and form feed.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0xD1342543DE82EF95), np.uint64(0x2545F4914F6CDD1D))
_FACTORS = (np.uint64(0x9FB21C651E98DF27), np.uint64(0xD6E8FEB86659FD93))
_STRIDE = 1 << 18
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: lost executors do not lose it, and its lineage ends."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/lontar-{name}-{uuid.uuid4().hex}"

    def remove() -> None:
        with contextlib.suppress(Exception):  # the session may have ended already
            _delete(spark, path)

    atexit.register(remove)
    return path


class Shelf:
    """Tables that an operator writes to the shared folder on its way: lost executors do not lose them, lineage ends at
    them, joins know their true sizes, and a table that nothing reads any more is deleted. Shuffle files of a write go
    as soon as it has ended."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, scratch(spark, name), []

    def put(self, df: DataFrame) -> DataFrame:
        conf, path = self.spark.conf, f"{self.root}/{len(self.paths)}"
        before = conf.get(_CLEANUP, None) if conf.isModifiable(_CLEANUP) else None
        try:
            if before is not None:
                conf.set(_CLEANUP, "true")
            df.write.parquet(path)
        finally:
            if before is not None:
                conf.set(_CLEANUP, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((table, path))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables; what is still to be computed must not read them."""
        for table, path in self.paths:
            if any(table is t for t in tables):
                _delete(self.spark, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_HELD: dict[str, object] = {}
TEXTS_IN_BATCH = 512


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``TEXTS_IN_BATCH`` rows: whole texts are large rows, and batches
    of the default 10,000 take tens of megabytes several times over in each task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= TEXTS_IN_BATCH:
        conf.set(name, str(TEXTS_IN_BATCH))
    return df


def held(name: str, make: Callable[[], object] = lambda: None) -> object:
    """The one object that this Python worker keeps between tasks. Workers serve one operator after another, so asking
    for another name lets go of what the last operator kept."""
    if name not in _HELD:
        if any(v is not None for v in _HELD.values()):
            _HELD.clear()
            gc.collect()
            with contextlib.suppress(OSError, AttributeError):  # hands freed memory back, where the C library can
                ctypes.CDLL(None).malloc_trim(0)
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose ``column`` holds about ``limit`` bytes; a longer text is a run of its own."""
    array = batch.column(batch.schema.get_field_index(column))
    if not len(array):
        return
    sizes = np.frombuffer(array.buffers()[1], dtype=np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32)[array.offset : array.offset + len(array) + 1]
    at = 0
    while at < len(array):
        end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1)
        yield batch.slice(at, min(end, len(array)) - at)
        at = end


def as_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary array, and where each value starts, with the end of all; nulls are empty."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    large = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]] if data is not None and starts[-1] > starts[0] else np.zeros(0, np.uint8)
    return raw, starts - starts[0]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(place: np.ndarray, which: int) -> np.ndarray:
    """A pseudorandom 64-bit key for each place in a span; those of the first places come from a table."""
    if len(place) and int(place.max()) >= len(_TABLES[which]):
        return mix(place.astype(np.uint64) * _STEP + _SEEDS[which])
    return _TABLES[which][place]


_TABLES = tuple(mix(np.arange(1 << 12, dtype=np.uint64) * _STEP + seed) for seed in _SEEDS)


def bytes_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit multilinear hash of ``raw[start:end]`` for each of some spans in ascending order that do not overlap:
    the sum of each byte times the key of its place. Keys of different places are independent, so no pattern of bytes
    makes spans collide more often than chance. ``which`` picks one of two functions."""
    at_start, at_end, total = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64), np.uint64(0)
    for p in range(0, len(raw), _STRIDE):
        q = min(p + _STRIDE, len(raw))
        low, high = max(int(np.searchsorted(starts, p, "right")) - 1, 0), int(np.searchsorted(starts, q))
        if high <= low:
            continue
        marks = np.maximum(starts[low:high], p)
        lead = int(marks[0])
        place = np.arange(lead, q) - np.repeat(starts[low:high], np.diff(np.append(marks, q)))
        sums = np.empty(q - lead + 1, np.uint64)
        sums[0] = total
        np.cumsum((raw[lead:q].astype(np.uint64) + np.uint64(1)) * _keys(place, which), out=sums[1:])
        sums[1:] += total
        total = sums[-1]
        own = slice(int(np.searchsorted(starts, lead)), high)
        at_start[own] = sums[starts[own] - lead]
        own = slice(int(np.searchsorted(ends, lead, "right")), int(np.searchsorted(ends, q, "right")))
        at_end[own] = sums[ends[own] - lead]
    at_start[starts >= len(raw)] = total
    return mix(at_end - at_start + (ends - starts).astype(np.uint64) * _STEP + _SEEDS[which])


def _joined(a: np.ndarray, b: np.ndarray, which: int) -> np.ndarray:
    return mix((a ^ _SEEDS[which]) * _FACTORS[which] + b)


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of the 64-bit ``values[start:end]`` for each span: hashes of 1, 2, 4, ... values in a row are mixed
    from halves, and a span from those of the bits of its length. ``which`` picks one of two functions."""
    lengths = ends - starts
    out, at, level, k = np.full(len(starts), _SEEDS[which]), starts.copy(), values, 0
    most = int(lengths.max(initial=0))
    while 1 << k <= most:
        if k:
            half = 1 << (k - 1)
            level = _joined(level[:-half], level[half:], which)
        take = np.flatnonzero(lengths & (1 << k))
        if len(take):
            out[take] = _joined(out[take], level[at[take]], which)
            at[take] += 1 << k
        k += 1
    return mix(out + lengths.astype(np.uint64) * _STEP)


def words_of(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the number of the first word of each text (with the end of all)."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    ink = ~space
    first, last = ink.copy(), ink.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    inner = starts[(starts > 0) & (starts < len(raw))]
    first[inner] = ink[inner]
    last[inner - 1] = ink[inner - 1]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, starts)


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case, everything else as it is."""
    upper = (raw >= 65) & (raw <= 90)
    return np.where(upper, raw + 32, raw).astype(np.uint8) if upper.any() else raw


def spread(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[start : start + size]`` of each span, one after the other."""
    return flat[np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(int(sizes.sum()))]


class Known:
    """Piece of text -> its number, and the ids of all pieces by number. Number 0 is that of the key None, whose ids are
    given. A dictionary of numbers and a few arrays take a fraction of what lists of ids would."""

    def __init__(self, ids: list[int]):
        self.number: dict[str | None, int] = {None: 0}
        self.flat, self.starts, self.sizes = np.array(ids, np.int32), np.array([0]), np.array([len(ids)])
        self.added: list[tuple[np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, keys: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.number)
        self.number.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.added.append((flat, sizes))
        self.bytes += 200 * len(keys) + 2 * sum(map(len, keys)) + 4 * len(flat)

    def settle(self) -> None:
        """Makes what was added readable."""
        if self.added:
            self.flat = np.concatenate([self.flat, *[f for f, _ in self.added]])
            self.sizes = np.concatenate([self.sizes, *[s for _, s in self.added]])
            self.starts, self.added = np.cumsum(self.sizes) - self.sizes, []

    def ids(self, keys: Iterable[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.fromiter(map(self.number.__getitem__, keys), np.int64, n)
        return spread(self.flat, self.starts[numbers], self.sizes[numbers]), self.sizes[numbers]
