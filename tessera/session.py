"""Session helpers.

The library itself never creates a session: every operator takes DataFrames.
These helpers exist for tests, the benchmark and scripts.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every analysis relies on: ANSI stays on (typed ingestion and
# ``try_*`` functions handle bad input), UTC session time zone (calendar parts
# must not depend on the machine), AQE for runtime re-planning and skew joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks."""
    # local workers import the package from the repository
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root] + paths)
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "6g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared, fault-tolerant folder and is used
    as is. Only when it is unset in a local session (tests) do we create a
    scratch folder; on a cluster the executors would not see it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable on the executors (Python UDFs refer to its functions).

    Zips the package once per application and adds it with ``addPyFile``, the
    same as ``--py-files`` on a cluster.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out_dir = tempfile.mkdtemp(prefix="tessera-pkg-")
    archive = shutil.make_archive(os.path.join(out_dir, "tessera"), "zip", root_dir=root, base_dir="tessera")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def cut_lineage(df):
    """Reliable checkpoint of ``df`` in the shared checkpoint folder.

    ``Dataset.checkpoint(eager=True)`` evaluates the plan once, writing the
    files as it goes (checked: each row is computed once), and readers then
    use the files, which survive the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df):
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    As ``cut_lineage``, for tables that several passes read: they read the
    columns they need, compressed.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tessera-stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
