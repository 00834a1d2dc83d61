"""Where queries and their SQL counterparts are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function (table reader) -> DataFrame under its name, with the SQL of the same rows."""

    def register(fn: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = fn.__name__
        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


class Tables:
    """Tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        from feedmill.runtime import read_table

        return read_table(self._spark, self._dir, name)

    def sql(self, text: str, *names: str) -> DataFrame:
        """Rows of a SQL text over some of the tables, for inputs that both engines make alike."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
        return self._spark.sql(text)

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def inline(self, rows: list[tuple], schema: str) -> DataFrame:
        return self._spark.createDataFrame(rows, schema)


def values(rows: list[tuple], names: str) -> str:
    """The same rows as a SQL table expression."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") t({names})"
