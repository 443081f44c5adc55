"""Transactional upsert into a database table, one statement per micro-batch.

The reference behaviour is a select and an insert or update (or a ``replace
into``) per row over one connection.  Here Spark reduces the micro-batch to one
row per key and writes it to a staging table in parallel; then one transaction on
the driver merges the staging table into the target and notes the batch id beside
it.  No value ever becomes part of a statement's text.  A replayed batch finds its
id noted and changes nothing, because the note and the merge commit together; a
batch that failed half-way left at most a staging table, which the next attempt
overwrites.

Only names, the batch id and row counts pass through the driver; rows travel from
the executors to the database.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewatch.sinks.owner import OtherQueryError, query_id
from tidewatch.sinks.upsert import newest_per_key

#: Applied batches: one row per target table.
NOTES = "applied_batches"
#: Connections that write a staging table at a time.
CONNECTIONS = 8

_SQL_TYPES = {T.StringType: "VARCHAR({n})", T.DoubleType: "DOUBLE PRECISION", T.FloatType: "REAL", T.LongType: "BIGINT",
              T.IntegerType: "INTEGER", T.ShortType: "SMALLINT", T.BooleanType: "BOOLEAN", T.TimestampType: "TIMESTAMP",
              T.DateType: "DATE"}


@dataclass(frozen=True)
class Target:
    """A database table to keep: ``keys`` identify a row; where ``order`` is given,
    a row replaces another only if its value there is larger (or equal)."""

    url: str
    table: str
    keys: tuple
    order: str | None = None
    dialect: str = "merge"                  # merge | on_conflict | on_duplicate_key
    options: dict = field(default_factory=dict)     # driver, user, password, ...: the caller's

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"


def apply_sql(t: Target, columns: Sequence[str]) -> str:
    """The one statement that merges the staging table into the target."""
    rest = [c for c in columns if c not in t.keys]
    names = ", ".join(columns)
    if t.dialect == "merge":
        on = " AND ".join(f"t.{k} = s.{k}" for k in t.keys)
        newer = f" AND s.{t.order} >= t.{t.order}" if t.order else ""
        update = f" WHEN MATCHED{newer} THEN UPDATE SET " + ", ".join(f"{c} = s.{c}" for c in rest) if rest else ""
        values = ", ".join(f"s.{c}" for c in columns)
        return f"MERGE INTO {t.table} t USING {t.staging} s ON {on}{update} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    insert = f"INSERT INTO {t.table} ({names}) SELECT {names} FROM {t.staging}"
    if t.dialect == "on_conflict":
        newer = f" WHERE excluded.{t.order} >= {t.table}.{t.order}" if t.order else ""
        change = "UPDATE SET " + ", ".join(f"{c} = excluded.{c}" for c in rest) + newer if rest else "NOTHING"
        return f"{insert} WHERE true ON CONFLICT ({', '.join(t.keys)}) DO {change}"
    if t.dialect == "on_duplicate_key":
        # the order column is set last: the others compare with its old value
        ordered = [c for c in rest if c != t.order] + ([t.order] if t.order in rest else [])
        def pick(c: str) -> str:
            return f"IF(VALUES({t.order}) >= {t.order}, VALUES({c}), {c})" if t.order else f"VALUES({c})"
        return f"{insert} ON DUPLICATE KEY UPDATE " + ", ".join(f"{c} = {pick(c)}" for c in ordered or t.keys[:1])
    raise ValueError(f"unknown dialect {t.dialect!r}")


def create_sql(table: str, schema: T.StructType, keys: Sequence[str], text_length: int = 255) -> str:
    """DDL of a result table with its primary key."""
    def sql_type(f: T.StructField) -> str:
        try:
            return _SQL_TYPES[type(f.dataType)].format(n=text_length)
        except KeyError:
            raise ValueError(f"column {f.name}: no database type for {f.dataType.simpleString()}") from None

    columns = [f"{f.name} {sql_type(f)}{' NOT NULL' if f.name in keys else ''}" for f in schema.fields]
    return f"CREATE TABLE {table} ({', '.join(columns)}, PRIMARY KEY ({', '.join(keys)}))"


@contextmanager
def transaction(spark: SparkSession, t: Target):
    """A connection of the driver's JVM; commits at the end, else rolls back."""
    jvm = spark.sparkContext._jvm
    if t.options.get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(t.options["driver"])
    properties = jvm.java.util.Properties()
    for name, value in t.options.items():
        if name != "driver":
            properties.setProperty(name, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(t.url, properties)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _execute(connection, sql: str, *values) -> int:
    statement = connection.prepareStatement(sql)
    try:
        for k, v in enumerate(values, 1):
            statement.setLong(k, v) if isinstance(v, int) else statement.setString(k, v)
        return statement.executeUpdate()
    finally:
        statement.close()


def _exists(connection, table: str) -> bool:
    """Whether there is a table of that name, as given or in the case that the
    database keeps unquoted names in."""
    name = table.split(".")[-1]
    for pattern in {name, name.upper(), name.lower()}:
        found = connection.getMetaData().getTables(None, None, pattern, None)
        try:
            while found.next():
                if found.getString("TABLE_NAME") == pattern:            # "_" stands for any character in a pattern
                    return True
        finally:
            found.close()
    return False


def _noted(connection, t: Target) -> tuple[str, int] | None:
    """(query, batch id) of the last batch applied to the target."""
    statement = connection.prepareStatement(f"SELECT query_id, batch_id FROM {NOTES} WHERE target = ?")
    try:
        statement.setString(1, t.table)
        rows = statement.executeQuery()
        return (rows.getString(1), rows.getLong(2)) if rows.next() else None
    finally:
        statement.close()


def _prepare(connection, t: Target, schema: T.StructType) -> tuple[str, int] | None:
    """Create what is missing; returns the last applied batch."""
    if not _exists(connection, NOTES):
        _execute(connection, f"CREATE TABLE {NOTES} (target VARCHAR(255) NOT NULL, query_id VARCHAR(255) NOT NULL, "
                             "batch_id BIGINT NOT NULL, PRIMARY KEY (target))")
    if not _exists(connection, t.table):
        _execute(connection, create_sql(t.table, schema, t.keys))
    return _noted(connection, t)


def jdbc_upsert(batch: DataFrame, batch_id: int, t: Target, owner: str | None = None) -> bool:
    """Apply ``batch`` as batch ``batch_id``; False if it was applied before.

    ``owner`` is the streaming query whose ids these are: the batches of another
    query are refused, since its ids are no continuation.  A null key is an error:
    a primary key holds none.
    """
    spark, owner = batch.sparkSession, owner or ""
    with transaction(spark, t) as connection:
        noted = _prepare(connection, t, batch.schema)
    if noted is not None:
        if noted[0] != owner:
            raise OtherQueryError(f"{t.table} is filled by streaming query {noted[0]!r}, not {owner!r}: use that query's checkpoint, or a new table")
        if batch_id <= noted[1]:
            return False
    rows = newest_per_key(batch, t.keys, t.order)
    with transaction(spark, t) as connection:
        if not _exists(connection, t.staging):
            _execute(connection, create_sql(t.staging, batch.schema, t.keys))
    writer = rows.repartition(CONNECTIONS).write.format("jdbc").mode("overwrite").option("truncate", "true")
    writer.options(url=t.url, dbtable=t.staging, **t.options).save()
    with transaction(spark, t) as connection:
        _execute(connection, apply_sql(t, batch.columns))
        if noted is None:
            _execute(connection, f"INSERT INTO {NOTES} (target, query_id, batch_id) VALUES (?, ?, ?)", t.table, owner, batch_id)
        else:
            _execute(connection, f"UPDATE {NOTES} SET batch_id = ? WHERE target = ?", batch_id, t.table)
        _execute(connection, f"DELETE FROM {t.staging}")
    return True


def jdbc_upsert_writer(t: Target):
    """``foreachBatch`` function applying each micro-batch with :func:`jdbc_upsert`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        jdbc_upsert(batch, batch_id, t, query_id(batch))
    return write
