"""K2 and report files: idempotent report writes.

``replace`` (the default) makes a rerun replace the rows of its report days,
also where a day has no rows any more.  Over JDBC the executors write a staging
table of their own, then the driver swaps the days in one database transaction
(DELETE the days, INSERT the staged rows); a failed job leaves the target
untouched.  Keep ``spark.speculation`` off for JDBC writes: a speculative task
commits its rows too.

Report files are snapshots::

    <path>/_runs/run=<run>/<date>=<key>/    what a write has computed, once
    <path>/_report/days.<version>.json      what counts: the run of every day
    <path>/<date>=<key>/                    copies of the days that count

A write computes the report once into a run folder, takes its days from the
folders written, and commits all of them by one new version of the day list, so
``read_report_files`` sees all of a write or nothing.  The plain folders are copied
from it afterwards, day by day, for readers that know no list; a crash in between
is made good by the next write or by ``export_days``.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from logcube.sources import store


def day_keys(days: Iterable | None) -> list[int] | None:
    """Report days as the ``date`` key of the reports (yyyymmdd)."""
    if days is None:
        return None
    return sorted(int((d.isoformat() if isinstance(d, _dt.date) else str(d)).replace("-", "")) for d in days)


def write_report_files(df: DataFrame, path: str, date_col: str = "date", fmt: str = "parquet", days: Iterable | None = None, plain: bool = True) -> None:
    """Write a report partitioned by day, replacing the days present and, of
    ``days``, those that have no rows now.  The report is executed once.
    ``plain`` brings the plain folders up to date, too."""
    spark, root, run = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    where = f"{root}/_runs/run={run}"
    df.write.partitionBy(date_col).format(fmt).save(where)
    written = {n.split("=", 1)[1] for n in store.names(spark, where) if n.startswith(f"{date_col}=")}
    changed = written | _names_of(df.schema[date_col].dataType, days)
    commit_report(spark, root, run, written, changed, df.schema.json())
    if plain:
        export_days(spark, root, date_col, fmt, sorted(changed))


def _names_of(kind: T.DataType, days: Iterable | None) -> set[str]:
    """Folder names of days: keys (yyyymmdd) in a column of numbers, else as they are."""
    if isinstance(kind, T.StringType | T.DateType):
        return {str(d) for d in days or []}
    return {str(k) for k in day_keys(days) or []}


def commit_report(spark: SparkSession, root: str, run: str, written: set[str], changed: set[str], schema: str) -> None:
    """Put the days ``written`` of a run in force, and of ``changed`` no others."""

    def change(content: dict | None) -> dict:
        kept = {day: r for day, r in (content["days"] if content else {}).items() if day not in changed}
        return {"schema": schema, "days": kept | dict.fromkeys(sorted(written), run)}

    store.update(spark, f"{root}/_report", "days", change)


def _folders(content: dict, root: str, date_col: str, days: Iterable[str]) -> list[str]:
    return [f"{root}/_runs/run={content['days'][day]}/{date_col}={day}" for day in days if day in content["days"]]


def _read(spark: SparkSession, content: dict, root: str, fmt: str, folders: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(content["schema"]))
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])).format(fmt)
    return found.option("basePath", f"{root}/_runs").load(folders).select(*schema.names)


def read_report_files(spark: SparkSession, path: str, date_col: str = "date", fmt: str = "parquet", days: Iterable | None = None) -> DataFrame:
    """The report's days, or those of ``days``, as of one commit."""
    root = path.rstrip("/")
    _, content = store.current(spark, f"{root}/_report", "days")
    if content is None:
        raise FileNotFoundError(f"no report at {path}")
    kind = T.StructType.fromJson(json.loads(content["schema"]))[date_col].dataType
    wanted = content["days"] if days is None else _names_of(kind, days)
    return _read(spark, content, root, fmt, _folders(content, root, date_col, sorted(wanted)))


def export_days(spark: SparkSession, path: str, date_col: str = "date", fmt: str = "parquet", days: Iterable[str] | None = None) -> None:
    """Bring the plain folders of ``days`` (keys; default: all) to what counts."""
    root = path.rstrip("/")
    _, content = store.current(spark, f"{root}/_report", "days")
    content = content or {"days": {}}
    present = {n.split("=", 1)[1] for n in store.names(spark, root) if n.startswith(f"{date_col}=")}
    wanted = sorted(present | content["days"].keys()) if days is None else list(days)
    folders = _folders(content, root, date_col, wanted)
    if folders:
        rows = _read(spark, content, root, fmt, folders)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).format(fmt).save(root)
    for day in wanted:
        if day not in content["days"] and day in present:
            store.delete(spark, f"{root}/{date_col}={day}")


def _jdbc_writer(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None):
    w = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w


# Options that configure Spark's JDBC reader/writer rather than the connection.
_SPARK_JDBC_KEYS = {
    "url", "dbtable", "query", "driver", "partitioncolumn", "lowerbound", "upperbound", "numpartitions",
    "querytimeout", "fetchsize", "truncate", "cascadetruncate", "createtableoptions", "createtablecolumntypes",
    "customschema", "batchsize", "isolationlevel", "sessioninitstatement", "pushdownpredicate",
    "pushdownaggregate", "pushdownlimit", "pushdownoffset", "pushdowntablesample", "keytab", "principal",
    "refreshkrb5config", "connectionprovider", "preparequery", "infertimestampntztype",
}


def _connect(df: DataFrame, url: str, options: Mapping[str, str] | None):
    jvm = df.sparkSession.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (options or {}).items():
        if k.lower() not in _SPARK_JDBC_KEYS:  # user, password, ssl, ... as Spark passes them
            props.setProperty(k, str(v))
    driver = (options or {}).get("driver")
    if driver:
        jvm.java.lang.Class.forName(driver)
    return jvm.java.sql.DriverManager.getConnection(url, props)


def write_report_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    mode: str = "replace",
    date_col: str = "date",
    days: Iterable | None = None,
) -> None:
    """K2: write a report over JDBC.

    ``mode="append"`` is the reference's behaviour (reruns duplicate rows);
    ``mode="replace"`` stages and swaps the days present and those of ``days``;
    ``"overwrite"`` replaces the whole table.  Table names are used as Spark's
    writer uses them, unquoted.
    """
    if mode in ("append", "overwrite"):
        _jdbc_writer(df, url, table, options).mode(mode).save()
        return
    if mode != "replace":
        raise ValueError(f"mode must be 'replace', 'append' or 'overwrite', not {mode!r}")
    staging = f"{table}_staging_{uuid.uuid4().hex[:8]}"  # of this write alone
    _jdbc_writer(df, url, staging, options).mode("overwrite").save()
    # Creates the target with the report's schema if it does not exist yet.
    _jdbc_writer(df.limit(0), url, table, options).mode("append").save()
    dialect = df.sparkSession.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    statements = swap_statements(table, staging, df.columns, date_col, day_keys(days), dialect.quoteIdentifier)
    conn = _connect(df, url, options)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        for sql in statements:
            stmt.executeUpdate(sql)
        conn.commit()
        stmt.executeUpdate(f"DROP TABLE {staging}")
        conn.commit()
        stmt.close()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def swap_statements(table: str, staging: str, columns: list[str], date_col: str, keys: list[int] | None, quote) -> list[str]:
    """The statements of the swap: the staged days and ``keys`` go, the staged
    rows come."""
    day, cols = quote(date_col), ", ".join(quote(c) for c in columns)
    statements = [f"DELETE FROM {table} WHERE {day} IN (SELECT {day} FROM {staging})"]
    if keys:
        statements.append(f"DELETE FROM {table} WHERE {day} IN ({', '.join(map(str, keys))})")
    return [*statements, f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}"]
