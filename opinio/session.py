"""Session settings and the shared scratch folder.

The engine relies on three session properties:

* ``spark.sql.session.timeZone = UTC`` — day partitions and epoch
  conversions are defined in UTC.
* AQE on, with skew-join splitting — hot reviewers / days are split at
  runtime instead of landing in one task.
* ``spark.checkpoint.dir`` — the cluster's shared folder. Lineage cuts and
  derived files go there; a local temp folder is used only in local mode
  when the session has none (tests, laptops).
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "opinio",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the engine's defaults."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set: a machine's own temp folder is not seen by
    the other executors, so there is no fallback. In local mode (tests,
    laptops) a private temp folder is made and registered where none is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="opinio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    path = f"{checkpoint_root(spark).rstrip('/')}/opinio/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope():
    """Delete the scratch folders that were made inside, on leaving.

    For jobs that write their result elsewhere (the daily job): DataFrames
    built inside must not be used afterwards.
    """
    _scopes.append([])
    try:
        yield
    finally:
        from pyarrow import fs
        for path in _scopes.pop():
            system, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
            if system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)
