"""Column functions in Python of one row's values, run a few hundred rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows whose values and results a worker holds at once.
ROWS = 256


def by_rows(returns: T.DataType) -> Callable[[Callable], Callable]:
    """A column function from a function of one row's values (None for null; a struct's result is a tuple).

    Batches stay in Arrow; only a slice of ROWS rows at a time becomes Python values, and its results leave before the next one, so a
    worker's memory does not follow the rows of a batch or of a task.
    """
    kind, names = to_arrow_type(returns), returns.names if isinstance(returns, T.StructType) else None

    def column(f: Callable) -> Callable:
        @F.arrow_udf(returns)
        def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for batch in batches:
                columns = batch if isinstance(batch, tuple) else (batch,)
                for at in range(0, len(columns[0]), ROWS):
                    found = [f(*values) for values in zip(*(c.slice(at, ROWS).to_pylist() for c in columns), strict=True)]
                    yield pa.array([dict(zip(names, x, strict=True)) for x in found] if names else found, kind)

        return run

    return column
