"""Turn one wide aggregate into one row per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: figures that one aggregate takes: the code of a wider one is too long for the JVM to compile, and its rows cost a
#: hundred times as much
AT_ONCE = 16


def per_column(df: DataFrame, cols: Sequence[str], measures: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    """The aggregates of all columns, reshaped to (column, measures...). Some columns at a time, each aggregate reading only
    its own."""
    width = max(1, AT_ONCE // len(measures))

    def some(names: Sequence[str]) -> DataFrame:
        entries = [
            F.struct(F.lit(c).alias("column"), *[make(c).alias(name) for name, make in measures.items()]) for c in names
        ]
        return df.agg(F.array(*entries).alias("r")).select(F.inline("r"))

    return reduce(DataFrame.unionByName, [some(cols[i : i + width]) for i in range(0, max(1, len(cols)), width)])


def one_row(df: DataFrame, figures: Sequence[Column]) -> dict[str, object]:
    """Named aggregates over the whole table by name, ``AT_ONCE`` of them at a time."""
    found = [df.agg(*figures[i : i + AT_ONCE]).first().asDict() for i in range(0, len(figures), AT_ONCE)]
    return {name: value for part in found for name, value in part.items()}
