"""Explicit schemas and the strict schema check (names, order, types;
nullability ignored)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark import config as C


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType, what: str = "table") -> DataFrame:
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if got != want:
        raise SchemaMismatch(f"{what} has {df.schema.simpleString()}, "
                             f"not {expected.simpleString()}")
    return df


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


SYMBOLS = _s(("id", T.StringType()), ("sector", T.StringType()))
RAW_STOCK = _s(("localDate", T.DateType()), ("id", T.StringType()), ("close", T.DoubleType()),
               ("high", T.DoubleType()), ("low", T.DoubleType()), ("open", T.DoubleType()),
               ("volume", T.LongType()))
RAW_NEWS = _s(("localDate", T.DateType()), ("id", T.StringType()), ("title", T.StringType()),
              ("body", T.StringType()))
SENTIMENT = _s(("localDate", T.DateType()), ("id", T.StringType()),
               ("sentiment_score", T.FloatType()), ("text_length", T.IntegerType()),
               ("token_count", T.IntegerType()))
AGGREGATED = _s(("localDate", T.DateType()), ("count_articles", T.IntegerType()),
                *[(m, T.FloatType()) for m in C.AGGREGATED_METRICS[1:]])
INFERENCE = _s(("localDate", T.DateType()), ("symbol", T.StringType()),
               *[(m, T.FloatType()) for m in C.INFERENCE_METRICS])
