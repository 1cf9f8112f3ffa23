"""SparkSession construction and cluster-facing settings.

All timestamps in this package are UTC; the session time zone is pinned so
that ``to_date``/``hour`` and epoch conversions agree with the warehouse.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # of a repeated key in a message the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    # streaming state lives off the heap and is checkpointed as changes
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of materialised frames are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "railyard",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return a session with the package defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset *and* the master is local
    (tests, the bench) a scratch folder is created and registered.  On a
    cluster an unset folder is an error, never a machine-local fallback.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local "
                               "folder does not survive the loss of an executor")
        d = fallback or tempfile.mkdtemp(prefix="railyard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df):
    """Cut the lineage of ``df`` with a reliable checkpoint written to the
    shared ``spark.checkpoint.dir`` (never a local checkpoint): a lost
    executor then re-reads the files instead of recomputing the chain, and
    frames used twice (a bounded list for the driver plus the main job) are
    computed once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
