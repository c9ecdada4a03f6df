"""Relational tables over JDBC."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import CharType, IntegralType, NumericType, StringType, VarcharType

from ferry.fixed_values import LEDGER_CONTAINER
from ferry.operators.quality import drop_surrogate_key
from ferry.sources.endpoint import Endpoint
from ferry.sources.scratch import discard, stage

# Used where the endpoint does not say otherwise. Each write partition is one
# connection, so their number is bounded; rows travel in batches both ways.
JDBC_DEFAULTS = {"fetchsize": "10000", "batchsize": "10000"}
WRITE_CONNECTIONS = 64


class VerificationError(RuntimeError):
    """The target does not hold the rows it should after a write."""


def quoted(table: str) -> str:
    """Lower-case and quoted, so that names such as ``user`` can be used."""
    bare = table[1:-1] if table.startswith('"') and table.endswith('"') else table
    return '"' + bare.lower().replace('"', '""') + '"'


def _load(spark: SparkSession, endpoint: Endpoint, source: str, **more: str) -> DataFrame:
    return (
        spark.read.format(endpoint.format)
        .options(**{**JDBC_DEFAULTS, **endpoint.options, **more})
        .option("dbtable", source)
        .load()
    )


def count_rows(spark: SparkSession, endpoint: Endpoint, table: str) -> int:
    """Counted by the database; one row comes back."""
    query = f"(SELECT count(*) AS n FROM {quoted(table)}) counted"
    return int(_load(spark, endpoint, query).first()[0])


def depth_cuts(counts: Sequence[tuple[object, int]], parts: int) -> list[object]:
    """Values at which a range of values is cut into ``parts`` of nearly equal counts.

    ``counts`` has the first value of each stretch and its rows, in order. A stretch
    is never cut, so a part is too large by one stretch at most; there are fewer
    parts where single stretches hold more than a part's share.
    """
    total = sum(n for _, n in counts)
    cuts, seen, share = [], 0, 1
    for value, n in counts:
        if seen * parts >= share * total and share < parts:
            cuts.append(value)
            share = seen * parts // total + 1
        seen += n
    return cuts


def _literal(value: object) -> str:
    if isinstance(value, (bool, int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def depth_predicates(
    spark: SparkSession, endpoint: Endpoint, table: str, column: str, parts: int, prefix: int = 4, steps: int = 50
) -> list[str]:
    """Conditions, one for each part of a read, that cut a table into parts of like size.

    The database counts rows by the first ``prefix`` characters of a text column, or
    by ``parts`` x ``steps`` ranges of equal width of a number, date or time; only
    these counts come back. Every row fits exactly one condition, also one that is
    NULL or was added since, whatever the order that the database gives texts.
    """
    name, rows = '"' + column.replace('"', '""') + '"', quoted(table)
    kind = _load(spark, endpoint, rows).schema[column].dataType
    if isinstance(kind, (StringType, VarcharType, CharType)):
        asked = f"SELECT v, count(*) AS n FROM (SELECT SUBSTR({name}, 1, {prefix}) AS v FROM {rows}) p WHERE v IS NOT NULL GROUP BY v"
        counts = _load(spark, endpoint, f"({asked}) counted").orderBy("v").collect()
        cuts = depth_cuts([tuple(r) for r in counts], parts)
    elif isinstance(kind, NumericType):
        low, high = _load(spark, endpoint, f"(SELECT min({name}) AS lo, max({name}) AS hi FROM {rows}) bounds").first()
        if low is None or low == high:
            return ["1 = 1"]
        width = (float(high) - float(low)) / (parts * steps)
        place = f"FLOOR((CAST({name} AS DOUBLE PRECISION) - {float(low)!r}) / {width!r})"
        asked = f"SELECT v, count(*) AS n FROM (SELECT {place} AS v FROM {rows}) p WHERE v IS NOT NULL GROUP BY v"
        counts = _load(spark, endpoint, f"({asked}) counted").orderBy("v").collect()
        whole = isinstance(kind, IntegralType)
        starts = [float(low) + float(v) * width for v, _ in counts]
        cuts = depth_cuts(list(zip([math.ceil(s) if whole else s for s in starts], [n for _, n in counts], strict=True)), parts)
    else:
        raise ValueError(f"{column} is neither text nor a number")
    if not cuts:
        return ["1 = 1"]
    edges = [_literal(c) for c in cuts]
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{name} < {edges[0]} OR {name} IS NULL", *between, f"{name} >= {edges[-1]}"]


def read_table(
    spark: SparkSession,
    endpoint: Endpoint,
    table: str = LEDGER_CONTAINER,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    bounds: tuple[object, object] | None = None,
    predicates: Sequence[str] | None = None,
    by_depth: bool = False,
) -> DataFrame:
    """Read a table.

    Without more it is one partition over one connection. A numeric, date or
    timestamp ``partition_column`` splits it into ``num_partitions`` ranges;
    bounds not given are asked of the database. ``predicates`` gives one
    partition per condition instead, for keys without an order. With ``by_depth``
    the column may be text as well, and the parts hold nearly equal numbers of rows
    however its values are spread (``depth_predicates``).
    """
    name = quoted(table)
    if by_depth:
        parts = num_partitions or spark.sparkContext.defaultParallelism
        predicates = depth_predicates(spark, endpoint, table, partition_column, parts)
    if predicates:
        properties = {
            k: str(v) for k, v in {**JDBC_DEFAULTS, **endpoint.options}.items() if k != "url"
        }
        return spark.read.jdbc(
            endpoint.options["url"], name, predicates=list(predicates), properties=properties
        )
    if partition_column is None:
        return _load(spark, endpoint, name)
    column = '"' + partition_column.replace('"', '""') + '"'
    if bounds is None:
        query = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {name}) bounds"
        bounds = tuple(_load(spark, endpoint, query).first())
    if bounds[0] is None:
        return _load(spark, endpoint, name)
    return _load(
        spark,
        endpoint,
        name,
        partitionColumn=partition_column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=str(num_partitions or spark.sparkContext.defaultParallelism),
    )


def _connection(spark: SparkSession, endpoint: Endpoint):
    """A connection of the driver process, for statements that Spark does not send."""
    jvm, options = spark._jvm, endpoint.options
    if "driver" in options:
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        jvm.java.lang.Class.forName(options["driver"], True, loader)
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        if key not in ("url", "driver"):
            properties.setProperty(key, str(value))
    return jvm.java.sql.DriverManager.getConnection(options["url"], properties)


def execute(spark: SparkSession, endpoint: Endpoint, *statements: str, none_left: str | None = None) -> None:
    """Carry out statements in the database, together in one transaction.

    They take effect only if the count that ``none_left`` asks for is 0 after them.
    """
    connection = _connection(spark, endpoint)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        if none_left:
            found = statement.executeQuery(none_left)
            found.next()
            if found.getLong(1):
                raise VerificationError(f"not 0: {none_left}")
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def replace_rows(
    rows: DataFrame,
    endpoint: Endpoint,
    table: str,
    key: str,
    told_by: Sequence[str],
    surrogate_key: str = "id",
) -> int:
    """Put ``rows``, one for each of some keys, in place of all rows of these keys.

    The rows are appended; then one statement deletes the keys' other rows, those
    that differ in a column of ``told_by``. So readers always find the key, rows of
    other keys keep their ids, and what others append meanwhile stays unless it is
    about these keys. The new rows also go to a table of their own, of the same
    types, that the statement joins with; it is dropped in the end. The statement
    takes effect only if every key still has a row. ``rows`` must be staged. If the
    step breaks off after the append, a key has its old rows besides the new one,
    of which the new one is the latest; calling again puts that right.
    """
    spark = rows.sparkSession
    rows = drop_surrogate_key(rows, surrogate_key)
    side = f"{table.strip('\"').lower()}_{uuid.uuid4().hex[:12]}"
    folded = {c.lower(): c for c in _load(spark, endpoint, quoted(table)).columns}
    names = ['"' + folded.get(c.lower(), c).replace('"', '""') + '"' for c in rows.columns]
    of = dict(zip(rows.columns, names, strict=True))
    execute(spark, endpoint, f"CREATE TABLE {quoted(side)} AS SELECT {', '.join(names)} FROM {quoted(table)} WITH NO DATA")
    try:
        write_table(rows, endpoint, side, "append", surrogate_key=surrogate_key, staged=True)
        written = write_table(rows, endpoint, table, "append", surrogate_key=surrogate_key, staged=True)
        old = " OR ".join(f"t.{of[c]} IS NULL OR t.{of[c]} <> s.{of[c]}" for c in told_by)
        same = f"s.{of[key]} = t.{of[key]}"
        execute(
            spark,
            endpoint,
            f"DELETE FROM {quoted(table)} t WHERE EXISTS (SELECT 1 FROM {quoted(side)} s WHERE {same} AND ({old}))",
            none_left=f"SELECT count(*) FROM {quoted(side)} s WHERE NOT EXISTS (SELECT 1 FROM {quoted(table)} t WHERE {same})",
        )
    finally:
        execute(spark, endpoint, f"DROP TABLE {quoted(side)}")
    return written


def reach(spark: SparkSession, endpoint: Endpoint) -> None:
    """Fail unless the database answers."""
    _connection(spark, endpoint).close()


def table_exists(spark: SparkSession, endpoint: Endpoint, table: str) -> bool:
    """Whether there is such a table; a database that does not answer is an error."""
    connection = _connection(spark, endpoint)
    try:
        found = connection.getMetaData().getTables(None, None, quoted(table)[1:-1].replace('""', '"'), None)
        return found.next()
    finally:
        connection.close()


def write_table(
    df: DataFrame,
    endpoint: Endpoint,
    table: str = LEDGER_CONTAINER,
    mode: str = "append",
    recreate: bool = False,
    column_types: Mapping[str, str] | None = None,
    surrogate_key: str = "id",
    staged: bool = False,
    attempts: int = 2,
) -> int:
    """Write a table, check the row count there, and return the rows written.

    Rows are staged first (unless ``staged`` says they are): the source is
    computed once, its size is known, and a table may be overwritten with what
    was read from it. Overwriting empties the table and keeps its definition;
    ``recreate`` drops it instead. A connection lost after its commit can leave
    rows twice; an overwrite that counts wrong is therefore run again, while
    an append that counts wrong is an error.
    """
    spark = df.sparkSession
    rows = drop_surrogate_key(df, surrogate_key)
    copy = None if staged else stage(rows, "table")
    rows = copy.rows if copy else rows
    expected = rows.count()
    there = mode == "append" and table_exists(spark, endpoint, table)
    before = count_rows(spark, endpoint, table) if there else 0
    options = {**JDBC_DEFAULTS, "numPartitions": str(WRITE_CONNECTIONS), **endpoint.options}
    if column_types:
        options["createTableColumnTypes"] = ", ".join(
            f"{c} {t}" for c, t in column_types.items() if c in rows.columns
        )
    if mode == "overwrite" and not recreate:
        options["truncate"] = "true"
    for attempt in range(attempts if mode == "overwrite" else 1):
        (
            rows.write.format(endpoint.format)
            .options(**options)
            .option("dbtable", quoted(table))
            .mode(mode)
            .save()
        )
        found = count_rows(spark, endpoint, table) - before
        if found == expected:
            break
    else:
        raise VerificationError(
            f"{quoted(table)}: expected {expected} more rows, found {found}"
        )
    if copy:
        discard(copy)
    return expected
