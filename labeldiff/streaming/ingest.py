"""Continuous ingestion: new raw files are parsed and inserted as they appear. Batch semantics stay: each micro-batch is an idempotent ingest."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from labeldiff.plans.flows import Flows

RAW = "path string, modificationTime timestamp, length long, content binary"


def watch(spark: SparkSession, root: str, store: str, checkpoint: str, pattern: str = "*.xml") -> StreamingQuery:
    """A query that ingests files under root until stopped. A batch that is run again after a failure inserts nothing twice, since ids are those of the content; the runs it had started are closed first."""
    flows = Flows(spark, store)
    flows.recover()
    rows = spark.readStream.format("binaryFile").schema(RAW).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)

    def insert(batch, _):
        if not batch.isEmpty():
            flows.ingest(batch.select("path", "content"))

    return rows.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
