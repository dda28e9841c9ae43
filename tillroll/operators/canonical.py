"""Logical column names over physical ones (dynamic-column tables)."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_frame(value, what: str) -> DataFrame:
    if isinstance(value, DataFrame):
        return value
    raise ValueError(f"{what}: expected a DataFrame, got {type(value).__name__}")


def check_mapping(value, what: str) -> Mapping[str, str]:
    if isinstance(value, Mapping):
        return value
    raise RuntimeError(f"no logical-to-physical names given for {what}")


def canonicalize(df: DataFrame, mapping: Mapping[str, str] | None,
                 required: Iterable[str], what: str) -> DataFrame:
    """Select the mapped physical columns under their logical names, once.

    * mapping missing / not a mapping -> RuntimeError
    * a required logical name without a mapping -> KeyError
    * the mapped physical column absent from the frame -> KeyError
    Logical names that are mapped but not required are carried when present.
    """
    check_frame(df, what)
    check_mapping(mapping, what)
    required = list(required)
    unmapped = [name for name in required if name not in mapping]
    if unmapped:
        raise KeyError(f"{what}: logical columns without a physical name: {unmapped}")
    absent = [mapping[name] for name in required if mapping[name] not in df.columns]
    if absent:
        raise KeyError(f"{what}: physical columns not in the frame: {absent}")
    also = [name for name, physical in mapping.items() if name not in required and physical in df.columns]
    return df.select(*[F.col(mapping[name]).alias(name) for name in required + also])
