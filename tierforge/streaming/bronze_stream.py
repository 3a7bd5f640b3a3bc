"""The bronze load, fed only with CSV files it has not seen yet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierforge.contract import Contract
from tierforge.plans.bronze import bronze_rows
from tierforge.sinks.tables import write_by_contract


def bronze_stream(
    spark: SparkSession,
    contract: Contract,
    path: str,
    root: str,
    checkpoint: str,
    *,
    at: dt.datetime | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Upsert all files that arrived since the last run, then stop.

    The checkpoint remembers which files were loaded. A batch that is repeated after a
    failure upserts the same rows again, which leaves the table as it was. Rejected rows are
    kept by query and batch below ``<root>/<table>__rejected``.
    """
    if contract.write_mode != "merge":
        raise ValueError(f"{contract.table}: only a merge can be loaded bit by bit")
    files = (
        spark.readStream.schema(
            T.StructType([T.StructField(h, T.StringType()) for h in contract.headers])
        )
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", contract.glob)
        .options(**contract.reader_options)
        .csv(path)
    )

    def load(batch: DataFrame, number: int) -> None:
        valid, rejected = bronze_rows(batch, contract, at=at)
        # The query's own id lasts as long as its checkpoint.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        kept = f"{root.rstrip('/')}/{contract.table}__rejected/query={query}/batch={number}"
        rejected.write.mode("overwrite").parquet(kept)
        write_by_contract(valid, contract, root, keys_present=True, buckets=buckets)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
