"""Database reads through Spark's JDBC source.

Parallel reads need ``partition_column`` with bounds: each of
``num_partitions`` tasks reads one range.  A free-form ``query`` is wrapped as
a derived table so it can be partitioned too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, query: str | None = None, table: str | None = None,
                 driver: str | None = None, user: str | None = None,
                 password: str | None = None, partition_column: str | None = None,
                 lower_bound: int | str | None = None, upper_bound: int | str | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned reads need bounds and num_partitions")
        src = table if table is not None else f"({query}) tp_src"
        opts.update(dbtable=src, partitionColumn=partition_column,
                    lowerBound=str(lower_bound), upperBound=str(upper_bound),
                    numPartitions=str(num_partitions))
    elif query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table
    for k, v in (("driver", driver), ("user", user), ("password", password)):
        if v is not None:
            opts[k] = v
    return opts


def read_jdbc(spark: SparkSession, url: str, **kw) -> DataFrame:
    """A database table or query as a DataFrame; the schema comes from the query."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kw)).load()
