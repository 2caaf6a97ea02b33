"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tarmac",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs, tests and the bench.

    On a cluster, pass ``master=None`` and let spark-submit supply it;
    ``spark.checkpoint.dir`` then comes from the cluster configuration.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (as ``--py-files`` would), once per application."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Connect: the server's installation applies
        return
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="tarmac-code-"), "tarmac_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
        return master.startswith("local") and not master.startswith("local-cluster")
    except Exception:  # noqa: BLE001 — a Connect session has no local context
        return False


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    ``spark.checkpoint.dir`` wins. Only a local-mode session (tests) with no
    setting gets a private temporary folder; a cluster session without one
    is an error, because a machine-local folder does not survive the loss of
    an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Connect: the server's setting applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{os.getpid()}-{next(_seq)}"


def _counter():
    i = 0
    while True:
        i += 1
        yield i


_seq = _counter()
