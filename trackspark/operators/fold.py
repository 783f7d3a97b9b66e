"""Folds over ordered rows of groups of any size.

Rows are partitioned by group, sorted in each partition (the sort spills) and streamed through in
Arrow batches: a fold holds its own state, never a group. A group is one task, but its rows are
neither collected nor copied, and time is linear in them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class Fold(Protocol):
    """State of one group: rows it gives out as a row comes in, and when the group ends."""

    def row(self, *values: Any) -> Iterable[tuple]: ...

    def end(self) -> Iterable[tuple]: ...


def fold_sorted(df: DataFrame, group: list[str], order: list[str], values: list[str], make: Callable[[], Fold], out: str) -> DataFrame:
    """(group, out): what a new fold of each group gives, fed its rows' ``values`` in ``order``.

    ``out`` is a DDL of the columns beside the group. Null keys form a group of their own.
    """
    slim = df.select(*group, *dict.fromkeys([*order, *values]))
    schema = StructType([*slim.select(*group).schema.fields, *StructType.fromDDL(out).fields])
    wide, at = len(group), [slim.columns.index(v) for v in values]

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        names = arrow.names

        def pack(rows: list[tuple]):
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

        key, state, done = None, None, []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            picked = zip(*[cols[i] for i in at])
            for k, v in zip(zip(*cols[:wide]), picked):
                if state is None or k != key:
                    if state is not None:
                        done += [(*key, *r) for r in state.end()]
                    key, state = k, make()
                done += [(*key, *r) for r in state.row(*v)]
            if done:
                yield pack(done)
                done = []
        if state is not None:
            yield pack([(*key, *r) for r in state.end()])

    return slim.repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(run, schema)

