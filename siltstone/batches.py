"""Batch-wise Python stages over Arrow, for operators no built-in expression can state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from siltstone.session import ensure_importable


def map_rows(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[..., list]]) -> DataFrame:
    """Applies make()(*column lists) to each batch of the named columns.

    make runs once per task and returns the function of a batch; that function gets one
    Python list per column and returns a list of row tuples. Only the named columns leave
    the scan.
    """
    ensure_importable(df.sparkSession)
    spec = _parse_datatype_string(schema)
    assert isinstance(spec, StructType)
    target = to_arrow_schema(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            if not batch.num_rows:
                continue
            work = work or make()
            rows = work(*[batch.column(i).to_pylist() for i in range(batch.num_columns)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    return df.select(*columns).mapInArrow(run, spec)
