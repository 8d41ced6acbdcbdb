"""Session settings the jobs rely on."""

import tempfile
import uuid

# Set per session, so they also reach a session somebody else created.
SETTINGS = {
    # Naive feed timestamps are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: measured broadcast, coalescing, skewed-join splits.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A few open files per task instead of a sort where rows go to few folders.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark):
    """Apply the settings to ``spark`` and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark):
    """The folder for data that outlives a job, from ``spark.checkpoint.dir``.

    Only a local master falls back to a temporary folder, because there all
    tasks share the disk.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="ledgerloom-")


def use_checkpoints(spark):
    """Make ``DataFrame.checkpoint`` usable."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return spark


def scratch_folder(spark):
    """A new folder name below the shared folder."""
    use_checkpoints(spark)
    return f"{shared_folder(spark).rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"
