"""Pick up new files of a folder, each one once, and land them with the batch plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from landfall.contract import Contract
from landfall.plans.intake import IntakeJob, run_intake

#: What is asked of each file: where it is. Its content is read by the run, in any format.
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def land_new_files(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    location: str,
    run_prefix: str,
    checkpoint: str,
    base64_key: str | None = None,
    files_per_batch: int | None = None,
    audit_dir: str | None = None,
    control_of: Callable[[list[str]], str | None] | None = None,
) -> StreamingQuery:
    """Land what is there now and stop.

    The stream is one of file names; every micro-batch is a whole run over its files, named after its batch id: claimed,
    logged (under ``audit_dir``, or in the landing table's folder), counted, reconciled with the control file that
    ``control_of`` names for the files, and committed. A batch that is tried again is another attempt of its run.
    """
    reader = spark.readStream.schema(_LISTING).format("binaryFile")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    names = reader.load(folder).select("path")
    log = audit_dir or f"{location.rstrip('/')}/_runs"

    def land(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.collect())  # one name a file, at most files_per_batch
        if paths:
            control = (lambda: control_of(paths)) if control_of else None  # asked within the run, whose log says if it fails
            run_intake(batch.sparkSession, IntakeJob(paths, contract, location, log, control, base64_key, f"{run_prefix}-{batch_id}"))

    return (
        names.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
