"""JDBC sources. Needs the driver's jar on the cluster; statements are standard SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sql_literal(value: object) -> str:
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def predicate(values: Mapping[str, object]) -> str:
    """Conjunction of equalities on a partition-value mapping; None is IS NULL."""
    tests = [
        f"{quote(k)} IS NULL" if v is None else f"{quote(k)} = {sql_literal(v)}"
        for k, v in values.items()
    ]
    return " AND ".join(tests) if tests else "1 = 1"


def select_statement(
    owner: str,
    table: str,
    columns: Sequence[str] = (),
    where: str = "",
    casts: Mapping[str, str] | None = None,
    distinct: bool = False,
) -> str:
    """Ordered projection with quoted names, optional casts and filter."""
    casts = casts or {}
    items = [
        f"CAST({quote(c)} AS {casts[c]}) AS {quote(c)}" if c in casts else quote(c) for c in columns
    ]
    name = f"{quote(owner)}.{quote(table)}" if owner else quote(table)
    text = f"SELECT {'DISTINCT ' if distinct else ''}{', '.join(items) or '*'} FROM {name}"
    return f"{text} WHERE {where}" if where else text


def count_statement(owner: str, table: str, where: str = "") -> str:
    name = f"{quote(owner)}.{quote(table)}" if owner else quote(table)
    text = f"SELECT COUNT(*) AS {quote('row_count')} FROM {name}"
    return f"{text} WHERE {where}" if where else text


@dataclass(frozen=True)
class JdbcSource:
    """One database. `properties` holds user, password, driver, fetchsize and the like."""

    url: str
    owner: str = ""
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)

    def _name(self, table: str) -> str:
        return f"{quote(self.owner)}.{quote(table)}" if self.owner else quote(table)

    def query(self, spark: SparkSession, statement: str) -> DataFrame:
        """A statement the database runs itself, such as a DISTINCT or a COUNT."""
        return (
            spark.read.format("jdbc").options(**self.properties)
            .option("url", self.url).option("query", statement).load()
        )

    def table(self, spark: SparkSession, table: str) -> DataFrame:
        """The whole table over one connection; filters and pruned columns reach the database."""
        return spark.read.jdbc(self.url, self._name(table), properties=dict(self.properties))

    def table_by_range(
        self, spark: SparkSession, table: str, column: str, low: int, high: int, tasks: int
    ) -> DataFrame:
        """Parallel read by ranges of a numeric column; rows outside the bounds are read too."""
        return spark.read.jdbc(
            self.url, self._name(table), column=quote(column),
            lowerBound=low, upperBound=high, numPartitions=tasks, properties=dict(self.properties),
        )

    def table_by_values(
        self, spark: SparkSession, table: str, scopes: Sequence[Mapping[str, object]]
    ) -> DataFrame:
        """Parallel read with one task per partition value."""
        return spark.read.jdbc(
            self.url, self._name(table),
            predicates=[predicate(s) for s in scopes], properties=dict(self.properties),
        )

    def distinct_values(self, spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
        return self.query(spark, select_statement(self.owner, table, columns, distinct=True))

    def count(self, spark: SparkSession, table: str, where: str = "") -> DataFrame:
        return self.query(spark, count_statement(self.owner, table, where))

    def append(self, df: DataFrame, table: str) -> None:
        df.write.jdbc(self.url, self._name(table), mode="append", properties=dict(self.properties))
