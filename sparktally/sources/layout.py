"""Tables stored by key, so that joins and sums over that key move no rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

#: Buckets of a cluster's table; tables that are joined have the same number.
BUCKETS = 1024


def store_by_key(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """`df` written to `path` in buckets of the key, sorted inside, and read back as such.

    All rows of a key share a bucket, and a bucket is one task when it is joined: for keys of which
    none holds a large share of the rows.  A hot key is better left to a shuffle,
    which Spark can split.
    """
    spark = df.sparkSession
    name = f"by_{key}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    try:
        return spark.table(name)
    finally:
        # The frame knows its files and buckets; the name has done its work, the files stay.
        spark.sql(f"DROP TABLE {name}")
