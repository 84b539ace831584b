"""Rows of a sorted partition, handed to Python group by group across Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def map_groups(rows: DataFrame, key: str, function: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Bring the rows of each value of ``key`` together and apply ``function`` to them as one Arrow table.

    Only one group is held at a time. ``key`` must be a non-null string column and its groups bounded.
    """
    dealt = rows.repartition(key).sortWithinPartitions(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
            begin = 0
            for row in range(len(keys) + 1):
                ended = row == len(keys)
                if not ended and row == 0 and current is None:
                    current = keys[0]
                if not ended and keys[row] == current:
                    continue
                if row > begin:
                    held.append(batch.slice(begin, row - begin))
                if ended:
                    break
                if held:
                    out = function(pa.Table.from_batches(held))
                    if out is not None:
                        yield out
                held, current, begin = [], keys[row], row
        if held:
            out = function(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return dealt.mapInArrow(run, schema)
