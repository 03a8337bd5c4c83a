"""How a registered query and its SQL check are written down together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayspark.plans.oracle_views import with_views
from stayspark.session import pin_utc
from stayspark.sources.views import Views

Build = Callable[[Views], DataFrame]


#: Says of a column that its doubles are rounded already, where its values are few and its rows many.
ROUNDED = {"places": 6}


def portable(df: DataFrame) -> DataFrame:
    """Types two engines print alike: dates and instants as text, decimals as doubles, arrays joined,
    doubles rounded to six places."""
    columns = []
    for field in df.schema.fields:
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = c if field.metadata == ROUNDED else F.round(c, 6)
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        columns.append(c.alias(field.name))
    return df.select(*columns)


class Registry:
    """Queries of one family, each with the DuckDB statement that must give the same rows."""

    def __init__(self, extra_views: dict[str, str] | None = None):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}
        self.views = extra_views or {}

    def query(self, name: str, sql: str | None = None):
        def register(build: Build) -> Build:
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return portable(build(Views(pin_utc(spark), folder)))

            run.__name__ = name
            run.__doc__ = build.__doc__
            self.queries[name] = run
            if sql is not None:
                self.oracles[name] = with_views(sql, self.views)
            return build

        return register


# DuckDB spellings of the portable forms.
def sql_date(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def sql_ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"
