"""Filters, mappers and their composition.

A predicate is a boolean ``Column`` (or a function frame -> Column); a mapper
is a function frame -> frame.  Composition is a fold of ``DataFrame.transform``
so the whole chain is one logical plan: Catalyst pushes the filters into the
scan and fuses the projections into one codegen stage.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable, Optional, Sequence, Union

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Predicate = Union[Column, Callable[[DataFrame], Column]]
Mapper = Callable[[DataFrame], DataFrame]
StructMapper = Callable[[Column], Column]


def _resolve(df: DataFrame, pred: Predicate) -> Column:
    return pred if isinstance(pred, Column) else pred(df)


def filter_events(df: DataFrame, predicate: Predicate) -> DataFrame:
    """Keep rows where the predicate is true (null counts as false, as in
    ``WHERE``; the predicate is left bare so Catalyst can push it to the scan)."""
    return df.filter(_resolve(df, predicate))


def all_of(df: DataFrame, predicates: Sequence[Predicate]) -> Column:
    """Conjunction of predicates (true when the list is empty).

    Under a filter a null conjunct drops the row, exactly like a false one.
    """
    cols = [_resolve(df, p) for p in predicates]
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def filter_all(df: DataFrame, predicates: Sequence[Predicate]) -> DataFrame:
    """Keep rows passing every predicate, evaluated on the unmapped row."""
    return df.filter(all_of(df, predicates))


def map_events(df: DataFrame, mapper: Union[Mapper, dict]) -> DataFrame:
    """One-to-one map; a dict is a field replacement (``withColumns``)."""
    if isinstance(mapper, dict):
        return df.withColumns(mapper)
    return df.transform(mapper)


def map_chain(df: DataFrame, mappers: Sequence[Union[Mapper, dict]]) -> DataFrame:
    """Mappers applied left to right."""
    return reduce(map_events, mappers, df)


def map_struct_chain(df: DataFrame, mappers: Sequence[StructMapper], name: str = "_ev") -> DataFrame:
    """P5: mappers over the whole row as a struct; a null result after the
    *last* mapper drops the row, an intermediate null is passed on."""
    cols = df.columns
    ev = F.struct(*[F.col(c) for c in cols])
    for m in mappers:
        ev = m(ev)
    return (df.select(ev.alias(name))
              .filter(F.col(name).isNotNull())
              .select(*[F.col(f"{name}.{c}").alias(c) for c in cols]))


def replace_field(df: DataFrame, field: str, value: Column) -> DataFrame:
    """Immutable replacement of one field (nested with ``a.b``)."""
    if "." in field:
        top, rest = field.split(".", 1)
        return df.withColumn(top, F.col(top).withField(rest, value))
    return df.withColumn(field, value)


def run_ops(df: DataFrame, operators: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Compose frame-to-frame operators left to right (lazy)."""
    return reduce(lambda acc, op: acc.transform(op), operators, df)


def process(df: DataFrame, predicates: Sequence[Predicate] = (),
            mappers: Sequence[Union[Mapper, dict]] = ()) -> DataFrame:
    """The processor's per-event pipeline: predicates on the unmapped row,
    then the mapper chain; windows are assigned by the caller afterwards."""
    return map_chain(filter_all(df, predicates), mappers)


# --------------------------------------------------------------------------
# Python fallbacks (X1, X2): vectorised through Arrow, never row at a time
# --------------------------------------------------------------------------

def python_predicate(fn: Callable[[pd.DataFrame], pd.Series], *cols: str) -> Column:
    """X1 fallback: a vectorised predicate over the named columns."""
    @F.pandas_udf(T.BooleanType())
    def _pred(*series: pd.Series) -> pd.Series:
        frame = pd.concat(series, axis=1, keys=list(cols))
        return fn(frame).astype("boolean")
    return _pred(*[F.col(c) for c in cols])


def python_mapper(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                  schema: Optional[Union[str, T.StructType]] = None) -> DataFrame:
    """X2 fallback: a batch-wise pandas mapper via ``mapInPandas`` (Arrow batches)."""
    out_schema = schema if schema is not None else df.schema

    def _run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(_run, out_schema)


def table_function(handler: type, returns: str, arrow: bool = True):
    """A user table function (a class with ``eval``, and optionally ``terminate``) as a
    Spark UDTF; rows cross in Arrow batches."""
    return F.udtf(handler, returnType=returns, useArrow=arrow)


def expand_rows(df: DataFrame, function, *columns) -> DataFrame:
    """Every row of ``df`` beside each row the table function gives for its columns
    (a lateral join); rows it gives nothing for are left out."""
    args = [(F.col(c) if isinstance(c, str) else c).outer() for c in columns]
    return df.lateralJoin(function(*args))


def over_partitions(df: DataFrame, function, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """A table function over the whole table, one call sequence per key with its rows
    in order; it sees a row at a time, so its own state is all it holds."""
    table = df.asTable().partitionBy(*keys)
    return function(table.orderBy(*order) if order else table)
