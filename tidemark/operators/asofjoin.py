"""As-of join of any two tables: for every left row the newest right row known by its time.

Both sides are put in one order of key and time by a range partition, each with one exchange, and a
sweep carries the newest right row of a key down the rows.  No row meets more than one other, however
many right rows a key has, and a hot key spans as many partitions as it fills.  The last right row of
each partition is then carried over the border to rows whose key begins in an earlier one: one row
per partition, looked up by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialised

#: Values among which rows of one key and time are spread before the range partition.
SPREAD = 1 << 16


def _starts(columns: list[pa.Array]) -> np.ndarray:
    """Whether a row's key differs from that of the row before it; nulls equal each other."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n < 2:
        return new
    new[1:] = False
    for c in columns:
        if pa.types.is_dictionary(c.type):
            c = c.dictionary_decode()
        a, b = c.slice(1), c.slice(0, n - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        differ = pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= differ.to_numpy(zero_copy_only=False)
    return new


def _sweep(keys: int):
    """Left rows with the newest right row above them in their key, and the last right row of the partition.

    Columns are the keys, then ``_side`` (0 right, 1 left), ``_left`` and ``_right``.  ``_open`` marks rows of the
    first key of a partition that have met no right row yet: what they need may lie in an earlier one.
    """
    def run(batches):
        names, last, first_key = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if last is not None:
                table = pa.concat_tables([last, table])
            table = table.combine_chunks()
            cols = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
            names, n = table.schema.names, table.num_rows
            new = _starts(cols[:keys])
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            side = cols[keys].to_numpy()
            seen = np.maximum.accumulate(np.where(side == 0, np.arange(n), -1))
            known = seen >= begin
            # Rows of the first key of the partition, as far as this batch shows.
            leading = np.cumsum(new[1:]) == 0 if first_key else np.zeros(max(n - 1, 0), bool)
            leading = np.r_[first_key, leading].astype(bool)
            first_key = bool(leading[-1])
            left = np.flatnonzero((side == 1) & (np.arange(n) > 0 if last is not None else np.ones(n, bool)))
            right = cols[keys + 2].take(pa.array(np.where(known, seen, 0)[left], mask=~known[left]))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(left)) for c in cols[:keys]), pa.array(np.zeros(len(left), np.int8)),
                 pa.array(leading[left] & ~known[left]), cols[keys + 1].take(pa.array(left)), right],
                [*names[:keys], "_kind", "_open", "_left", "_right"])
            # The last key goes on with its newest right row, or with a row that has none.
            keep = int(seen[-1]) if known[-1] else n - 1
            last = table.slice(keep, 1)
            if not known[-1]:
                last = last.set_column(keys, table.schema.field(keys), pa.array([2], table.schema.field(keys).type))
        if last is not None:
            cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in last.columns]
            cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
            missing = cols[keys].to_numpy()[0] != 0
            value = pa.nulls(1, cols[keys + 2].type) if missing else cols[keys + 2]
            yield pa.RecordBatch.from_arrays(
                [*cols[:keys], pa.array([1], pa.int8()), pa.array([first_key]), pa.nulls(1, cols[keys + 1].type), value],
                [*names[:keys], "_kind", "_open", "_left", "_right"])

    return run


def newest_between(right: DataFrame, keys: Sequence[str], time: str, cutoffs: Sequence[Column],
                   values: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The right rows that the ``cutoffs`` of their key can meet in `asof_join`, and a row for every key.

    Of the rows after one cutoff and up to the next only the newest is ever found, so an aggregate that combines
    on the map side keeps that one.  Rows after the last cutoff or without a time leave one row, whose time is
    null.  ``cutoffs`` are expressions of ``keys``; ties on time go to the greatest ``order``, then to the
    greatest of the other ``values``.  The result has no more rows than ``right``, and at most one more per
    key than there are cutoffs.
    """
    columns = list(dict.fromkeys([time, *order, *values]))
    upto = F.array_min(F.array(*[F.when(F.col(time) <= c, c) for c in cutoffs]))
    newest = right.groupBy(*keys, upto.alias("_upto")).agg(F.max(F.struct(*columns)).alias("_newest"))
    known = F.when(F.col("_upto").isNotNull(), F.col("_newest").getField(time))
    return newest.select(*keys, known.alias(time), *[F.col("_newest").getField(c).alias(c) for c in columns[1:]])


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], order: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Every left row with ``values`` of the right row of its key with the greatest time not after its own.

    Ties on time go to the greatest ``order``.  ``values`` are null where nothing was known.  A null key
    equals a null key; a left row without a time matches nothing, a right row without one is not known.
    Repeated left rows each give a row.  ``values`` must not be names of the left table.
    """
    spark = left.sparkSession
    names = [f"_k{i}" for i in range(len(keys))]
    own = [F.col(k).alias(n) for k, n in zip(keys, names)]
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    value = F.struct(*[F.col(v) for v in values])
    rank = F.struct(F.lit(0).alias("_none"), *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])
    a = left.select(*own, F.col(left_time).alias("_t"), F.lit(1).cast("tinyint").alias("_side"), row.alias("_left"))
    # A left row without a time stands before every right row of its key.
    b = right.where(F.col(right_time).isNotNull()).select(
        *own, F.col(right_time).alias("_t"), F.lit(0).cast("tinyint").alias("_side"), rank.alias("_rank"), value.alias("_right"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn(
        "_spread", F.when(F.col("_side") == 1, F.pmod(F.xxhash64("_left"), F.lit(SPREAD))).otherwise(0))
    place = [*names, "_t", "_side", "_rank", "_spread"]
    # A null time sorts first, so a null-time left row precedes the right rows of its key.
    dealt = both.repartitionByRange(partitions, *place) if partitions else both.repartitionByRange(*place)
    dealt = dealt.sortWithinPartitions(*place).select(*names, "_side", "_left", "_right")
    kinds = {f.name: f.dataType for f in dealt.schema}
    schema = T.StructType([*[T.StructField(n, kinds[n]) for n in names], T.StructField("_kind", T.ByteType()),
                           T.StructField("_open", T.BooleanType()), T.StructField("_left", kinds["_left"]), T.StructField("_right", kinds["_right"])])
    swept = materialised(dealt.mapInArrow(_sweep(len(keys)), schema)).withColumn("_part", F.spark_partition_id())

    # One row for a partition: its last key and the newest right row of that key in it.  Rows that are still
    # open take the newest one of their key from the partitions before theirs.
    ends = swept.where("_kind = 1")
    every = Window.orderBy("_part")
    upto = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    found = ends.select(*[F.col(n).alias(f"_end{n}") for n in names], F.lead("_part").over(every).alias("_for"),
                        F.last("_right", ignorenulls=True).over(upto).alias("_carried"))
    done = swept.where("_kind = 0 AND NOT _open").select("_left", "_right")
    same = [F.col(n).eqNullSafe(F.col(f"_end{n}")) for n in names]
    late = swept.where("_kind = 0 AND _open").join(F.broadcast(found), [F.col("_part") == F.col("_for"), *same], "left")
    joined = done.unionByName(late.select("_left", F.col("_carried").alias("_right")))
    timed = F.when(F.col(f"_left.`{left_time}`").isNotNull(), F.col("_right"))
    joined = joined.withColumn("_right", timed)
    return joined.select("_left.*", *[F.col(f"_right.`{v}`").alias(v) for v in values])
