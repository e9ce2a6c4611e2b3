"""Landing folder -> bronze table, incrementally.

The batch ingestion (``sources.files.ingest_csv``) re-reads every landed file
on each run.  Here the same read (columns by the header's names, malformed lines
kept in ``_corrupt_record``, lineage columns) is a file-source stream:

* ``trigger(availableNow=True)`` processes whatever has landed since the last
  run and then stops, so a daily scheduler can run it like a batch job;
* the checkpoint records which files were committed, so each file is
  ingested exactly once, and a run that dies (or loses executors) resumes
  from the last committed batch;
* the parquet sink writes through the file-sink commit log, so readers
  never see a half-written batch.

The checkpoint belongs in shared storage; by default it goes under the
session's ``spark.checkpoint.dir``, by landing folder and target.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import scratch_dir
from tidemark.sources import schemas
from tidemark.sources.files import by_name, csv_columns, csv_reader


def ingest_landing(spark: SparkSession, table: str, landing_dir: str, bronze_dir: str,
                   checkpoint_dir: str | None = None, max_files_per_trigger: int | None = None,
                   ) -> StreamingQuery:
    """Start an available-now stream from ``landing_dir`` (CSV) into ``bronze_dir`` (parquet)."""
    reader = csv_reader(spark.readStream, csv_columns(spark, landing_dir))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = by_name(reader.csv(landing_dir), schemas.BRONZE[table])
    # one checkpoint per source and target: a second target starts from the beginning
    key = hashlib.sha256(f"{landing_dir}\n{bronze_dir}".encode()).hexdigest()[:16]
    ckpt = checkpoint_dir or f"{scratch_dir(spark)}/streams/{table}-{key}"
    return (stream.writeStream.format("parquet")
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start(bronze_dir))


def run_landing_once(spark: SparkSession, table: str, landing_dir: str, bronze_dir: str,
                     checkpoint_dir: str | None = None) -> int:
    """Ingest what has landed, wait for completion, return the rows ingested in this run.

    The rows are those that the stream itself reports for its batches, so neither
    the bronze table's history nor another writer has a part in them.
    """
    q = ingest_landing(spark, table, landing_dir, bronze_dir, checkpoint_dir)
    rows: dict[int, int] = {}
    done = False
    while not done:  # a query keeps the reports of its last batches only
        done = q.awaitTermination(1)
        for p in q.recentProgress:
            rows[p["batchId"]] = max(rows.get(p["batchId"], 0), p["numInputRows"])
    if q.exception() is not None:
        raise q.exception()
    return sum(rows.values())
