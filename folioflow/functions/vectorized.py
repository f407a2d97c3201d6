"""Vectorised Python functions that are made when first used, so that modules can
be imported before there is a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import functions as F


def vectorized(ddl: str) -> Callable:
    """Like ``pandas_udf`` with a type given as DDL."""

    def wrap(f: Callable) -> Callable:
        @wraps(f)
        def call(*columns):
            return F.pandas_udf(f, ddl)(*columns)

        del call.__wrapped__
        return call

    return wrap
