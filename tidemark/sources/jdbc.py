"""Tables of a database server, over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def encrypted_url(host: str, port: int, database: str, *, trust_server: bool = False) -> str:
    """Connection URL of a server reached with encryption."""
    trust = str(trust_server).lower()
    return (
        f"jdbc:sqlserver://{host}:{port};database={database};"
        f"encrypt=true;trustServerCertificate={trust};loginTimeout=30;"
    )


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options of a table, or of a query that the server runs.

    With ``partition_column`` and bounds the read runs as ``partitions`` range
    queries at a time. Bounds only spread the load: rows outside them are read by
    the first and the last task. A query becomes a derived table then, since the
    ``query`` option does not go with partitioned reads.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("a partitioned read needs column, lower, upper and partitions")
        options |= {
            "partitionColumn": str(partition_column),
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
            "dbtable": table if table is not None else f"({query}) q",
        }
    elif table is not None:
        options["dbtable"] = table
    else:
        options["query"] = query
    return options


def read_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    """Read a table or query; options as in ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()


def id_predicates(column: str, bounds: Sequence[int]) -> list[str]:
    """One predicate per range between ``bounds``; ends and NULL are covered too.

    For ``spark.read.jdbc(predicates=...)`` where ids are spread unevenly.
    """
    cuts = sorted(set(bounds))
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]
