"""Reading result tables from a database in parallel, with what can be pushed down.

A plain JDBC read is one task.  Here the table's own smallest and largest key (one
aggregate query) are cut into ranges, one task each; Spark adds its filters to every
range's query.  A dashboard's top-n is computed by the database, so n rows travel.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sources.tables import result_table

#: Rows a task should read, and tasks at most.
ROWS_PER_TASK, MOST_TASKS = 1_000_000, 200
#: Pattern of the result tables' window starts (as Python reads it).
TIME_TEXT = "%Y-%m-%d:%H:%M:%S"


def _reader(spark: SparkSession, url: str, options: dict):
    return spark.read.format("jdbc").options(url=url, **options)


def _quoted(spark: SparkSession, url: str, table: str, names: list[str], options: dict) -> list[str]:
    """Column names as the table has them (found in any case), quoted as its
    database quotes them."""
    held = {c.lower(): c for c in _reader(spark, url, options).option("dbtable", table).load().columns}
    dialect = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    missing = [n for n in names if n.lower() not in held]
    if missing:
        raise ValueError(f"{table} has no column {', '.join(missing)}")
    return [dialect.quoteIdentifier(held[n.lower()]) for n in names]


def key_range(spark: SparkSession, url: str, table: str, key: str, **options) -> tuple:
    """(smallest, largest, rows) of the key (a quoted name), asked of the database."""
    query = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {table}"
    row = _reader(spark, url, options).option("dbtable", f"({query}) r").load().first()
    return row[0], row[1], int(row[2])


def _cuts(lo, hi, n: int) -> list:
    """Up to ``n - 1`` points that cut ``lo`` to ``hi`` into even ranges; text is cut
    as times in the result tables' format."""
    if isinstance(lo, str):
        try:
            a, b = datetime.strptime(lo, TIME_TEXT), datetime.strptime(hi, TIME_TEXT)
        except ValueError:
            return []
        points = [(a + timedelta(seconds=int((b - a).total_seconds() * k / n))).strftime(TIME_TEXT) for k in range(1, n)]
    elif isinstance(lo, int):
        points = [lo + (hi - lo) * k // n for k in range(1, n)]
    else:
        points = [lo + (hi - lo) * k / n for k in range(1, n)]
    return sorted({p for p in points if lo < p <= hi})


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime):
        return f"TIMESTAMP('{value:%Y-%m-%d %H:%M:%S.%f}')"
    return repr(value)


def range_predicates(lo, hi, key: str, tasks: int) -> list[str]:
    """Conditions that cover every row once: even ranges of the key; rows without a
    key belong to the first."""
    cuts = _cuts(lo, hi, tasks) if lo is not None and tasks > 1 else []
    if not cuts:
        return []
    out = [f"{key} < {_literal(cuts[0])} OR {key} IS NULL"]
    out += [f"{key} >= {_literal(a)} AND {key} < {_literal(b)}" for a, b in zip(cuts, cuts[1:])]
    return out + [f"{key} >= {_literal(cuts[-1])}"]


def partitioned_table(spark: SparkSession, url: str, table: str, key: str, rows_per_task: int = ROWS_PER_TASK,
                      tasks: int | None = None, **options) -> DataFrame:
    """A database table read by ranges of ``key`` (a number, a time, or text in the
    result tables' time format; other text is read by one task).

    Without ``tasks``, their number follows the table's row count.  Filters on the
    result reach every range's query.
    """
    column = _quoted(spark, url, table, [key], options)[0]
    lo, hi, n = key_range(spark, url, table, column, **options)
    wanted = tasks or min(MOST_TASKS, -(-n // rows_per_task))
    predicates = range_predicates(lo, hi, column, wanted)
    if not predicates:
        return result_table(spark, fmt="jdbc", url=url, dbtable=table, **options)
    return spark.read.jdbc(url, table, predicates=predicates, properties={k: str(v) for k, v in options.items()})


def top_rows(spark: SparkSession, url: str, table: str, order: list[tuple[str, str]], n: int,
             equal: dict | None = None, **options) -> DataFrame:
    """The first ``n`` rows of a table, chosen by the database: in ``order`` (pairs
    such as ``("winstart", "desc")``), of the rows whose columns ``equal`` the values
    given."""
    equal = equal or {}
    for _, way in order:
        if way.lower() not in ("asc", "desc"):
            raise ValueError(f"order is asc or desc, not {way!r}")
    names = _quoted(spark, url, table, [c for c, _ in order] + list(equal), options)
    ranks = ", ".join(f"{c} {way.upper()}" for c, (_, way) in zip(names, order))
    conditions = " AND ".join(f"{c} = {_literal(v)}" for c, v in zip(names[len(order):], equal.values()))
    query = f"SELECT * FROM {table}{' WHERE ' + conditions if conditions else ''} ORDER BY {ranks} FETCH FIRST {int(n)} ROWS ONLY"
    return _reader(spark, url, options).option("dbtable", f"({query}) t").load()
