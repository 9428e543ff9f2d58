"""functions of corpusloom."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def vectorised(returns: str):
    """A pandas UDF that is made when it is first used, so that workers can import its module without a session."""

    def wrap(f: Callable) -> Callable[..., Column]:
        @functools.wraps(f)
        def call(*columns: Column) -> Column:
            return F.pandas_udf(f, returns)(*columns)

        return call

    return wrap
