"""Bring sources with different names, types and columns into one layout."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SourceSpec:
    """How one source maps onto the shared layout.

    ``types`` are the declared types by the source's own column names, ``constants``
    the columns the source lacks, as ``name -> (value, type)``.
    """

    name: str
    types: Mapping[str, str] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: Sequence[str] = ()
    constants: Mapping[str, tuple[Any, str]] = field(default_factory=dict)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Give the named columns their declared type; values that do not fit turn null.

    Names match in any case. Columns the frame lacks are passed over, since a
    declared layout covers several vintages of a feed.
    """
    wanted = {name.lower(): kind for name, kind in types.items()}
    return df.select(
        *(
            F.col(name).try_cast(wanted[name.lower()]).alias(name)
            if name.lower() in wanted
            else F.col(name)
            for name in df.columns
        )
    )


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def add_constants(df: DataFrame, constants: Mapping[str, tuple[Any, str]]) -> DataFrame:
    return df.withColumns({n: F.lit(v).cast(kind) for n, (v, kind) in constants.items()})


def conform(df: DataFrame, spec: SourceSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast, drop, rename and complete a source; Catalyst makes one projection of it.

    ``columns`` fixes order and spelling of the result, whatever the input's order.
    """
    df = cast_columns(df, spec.types)
    df = drop_columns(df, spec.drop)
    df = rename_columns(df, spec.rename)
    if spec.constants:
        df = add_constants(df, spec.constants)
    return df.select(*columns) if columns else df


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL, matching columns by name and not by position."""
    return reduce(DataFrame.unionByName, frames)
