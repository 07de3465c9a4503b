"""Relational source / sink (S7, S8) through Spark's JDBC data source.

The reference streams a cursor in fetch-size batches from one process; here the
read is split into ``num_partitions`` parallel range queries over a numeric column
and each executor fetches ``fetchsize`` rows per round trip. No database runs in
this repository, so tests cover the option building only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The reference's default fetch sizes (general / people / reviews) and
# insert batch size.
DEFAULT_FETCH = 1000
PEOPLE_FETCH = 1000
REVIEWS_FETCH = 200
INSERT_BATCH = 1000


def read_options(url: str, table: str | None = None, query: str | None = None,
                 fetch_size: int = DEFAULT_FETCH, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, user: str | None = None,
                 password: str | None = None, driver: str | None = None) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table / query")
    if partition_column and query:
        table, query = f"({query}) AS src", None
    opts = {"url": url, "fetchsize": str(int(fetch_size))}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column:
        if None in (lower, upper, num_partitions):
            raise ValueError("partition_column needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(int(lower)),
                    upperBound=str(int(upper)), numPartitions=str(int(num_partitions)))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            opts[k] = v
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    """Bulk read of a table or query."""
    return spark.read.format("jdbc").options(**read_options(**kw)).load()


def write_options(url: str, table: str, batch_size: int = INSERT_BATCH, truncate: bool = True,
                  user: str | None = None, password: str | None = None,
                  driver: str | None = None) -> dict[str, str]:
    if not 0 < int(batch_size) <= INSERT_BATCH:
        raise ValueError(f"batch_size must be 1..{INSERT_BATCH}")
    opts = {"url": url, "dbtable": table, "batchsize": str(int(batch_size)),
            "truncate": "true" if truncate else "false"}
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            opts[k] = v
    return opts


def load_table(df: DataFrame, url: str, table: str, replace: bool = True, **kw) -> None:
    """Bulk load into a table: replace (first chunk in the reference) or append,
    inserts in batches of at most 1000 rows, written in parallel by partition."""
    (df.write.format("jdbc").options(**write_options(url, table, **kw))
       .mode("overwrite" if replace else "append").save())
