"""Serving database over Spark's JDBC source.

Rows are written and read by the executors; the driver sends a few statements. Both ways into the
database can be replaced, which is how the tests see the statements and their order. A real
database needs its JDBC driver on the class path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

# SQL types of the column types that serving tables have.
SQL_TYPES = {"string": "TEXT", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE PRECISION",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


class Connection(Protocol):
    def execute(self, statement: str) -> None: ...
    def table_exists(self, table: str) -> bool: ...
    def commit(self) -> None: ...
    def rollback(self) -> None: ...
    def close(self) -> None: ...


class DriverManagerConnection:
    """A connection of the driver's JVM, with statements grouped into transactions."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str]):
        jvm = spark._jvm
        login = jvm.java.util.Properties()
        for name, value in properties.items():
            login.setProperty(name, value)
        self._connection = jvm.java.sql.DriverManager.getConnection(url, login)
        self._connection.setAutoCommit(False)

    def execute(self, statement: str) -> None:
        prepared = self._connection.createStatement()
        try:
            prepared.execute(statement)
        finally:
            prepared.close()

    def table_exists(self, table: str) -> bool:
        found = self._connection.getMetaData().getTables(None, None, table, None)
        return bool(found.next())

    def commit(self) -> None:
        self._connection.commit()

    def rollback(self) -> None:
        self._connection.rollback()

    def close(self) -> None:
        self._connection.close()


def upsert_statement(table: str, staging: str, columns: Sequence[str],
                     keys: Sequence[str]) -> str:
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    return (f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
            f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}")


def create_statement(table: str, schema: StructType, keys: Sequence[str]) -> str:
    def sql_type(kind: DataType) -> str:
        return SQL_TYPES[kind.simpleString()]
    columns = [f"{f.name} {sql_type(f.dataType)}" for f in schema.fields]
    return (f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}, "
            f"PRIMARY KEY ({', '.join(keys)}))")


@dataclass(frozen=True)
class Database:
    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connect: Callable[[], Connection] | None = None
    write: Callable[[DataFrame, str], None] | None = None

    def _connection(self) -> Connection:
        return self.connect() if self.connect else \
            DriverManagerConnection(self.spark, self.url, self.properties)

    def run(self, *statements: str) -> None:
        """All statements in one transaction."""
        connection = self._connection()
        try:
            for statement in statements:
                connection.execute(statement)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def exists(self, table: str) -> bool:
        connection = self._connection()
        try:
            return connection.table_exists(table)
        finally:
            connection.close()

    def publish(self, mart: DataFrame, table: str) -> None:
        """Drop and recreate one serving table, written by the executors in parallel."""
        if self.write:
            self.write(mart, table)
        else:
            mart.write.jdbc(self.url, table, mode="overwrite", properties=dict(self.properties))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, table, properties=dict(self.properties))

    def ensure_table(self, table: str, schema: StructType, keys: Sequence[str]) -> None:
        self.run(create_statement(table, schema, keys))

    def upserter(self, table: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
        """Micro-batch writer: executors fill a staging table, one transaction merges it.

        Every written row gets the time of its batch as ``updated_at``. The staging table is
        dropped whether the merge went well or not.
        """
        def write(batch: DataFrame, _batch_id: int) -> None:
            rows = batch.withColumn("updated_at", F.current_timestamp())
            rows.persist()
            staging = f"{table}_stage_{uuid.uuid4().hex[:8]}"
            try:
                if rows.isEmpty():
                    return
                try:
                    self.publish(rows, staging)
                    self.run(upsert_statement(table, staging, rows.columns, keys))
                finally:
                    self.run(f"DROP TABLE IF EXISTS {staging}")
            finally:
                rows.unpersist()
        return write
