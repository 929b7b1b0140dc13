"""Helpers shared by the text operators: lineage cuts, Arrow text buffers, word and window hashes."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = b" \t\n\x0b\x0c\r"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = _LOCAL.setdefault("folder", tempfile.mkdtemp(prefix="tidemark-"))
    return folder.rstrip("/")


_LOCAL: dict[str, str] = {}


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder, so that a lost executor loses no work."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back."""
    path = f"{shared_folder(df.sparkSession)}/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands Python batches of bounded rows and bytes.

    Texts differ in length by orders of magnitude, so a row count alone bounds nothing.  Every task holds
    a few batches on both sides of its pipes, outside the heap.
    """
    for key, value in (("maxRecordsPerBatch", "2000"), ("maxBytesPerBatch", str(1 << 20))):
        df.sparkSession.conf.set(f"spark.sql.execution.arrow.{key}", value)
    return df


def lean(run):
    """``run`` over batches, after which the worker gives freed memory back to the system.

    Workers live on between stages, and several of them wait beside those at work.
    """
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            pa.system_memory_pool().release_unused()

    return tidy


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a null id falls in fold 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4, F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null.  Runs in the JVM."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


# ------------------------------------------------------------------ Arrow text


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of every row (one more than rows).

    Workers live on between stages, so freed buffers go back to the system and not to Arrow's own pool.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int):
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 18)
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        for name, base in (("up", _ODD), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for every pair, by one running sum."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def word_bounds(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Start and end of every word and the row it is in; words end where rows do."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


def _spaces() -> np.ndarray:
    table = np.ones(256, bool)
    table[list(SPACE)] = False
    return table


IS_WORD = _spaces()


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words given by their bounds in ``raw``."""
    return range_hash(_BYTE[raw], start, end)


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:n], out[rest:rest + n]) if rest else out[:n]


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of ``n`` nodes under the links ``a[i] - b[i]``."""
    label = np.arange(n)
    while True:
        left, right = label[a], label[b]
        open_ = left != right
        if not open_.any():
            return label
        a, b, left, right = a[open_], b[open_], left[open_], right[open_]
        low = np.minimum(left, right)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
