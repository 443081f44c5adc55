"""Session helpers.

Library code never builds its own session; it takes the caller's.  The
helpers here are for scripts and tests, plus the one place that decides
where durable intermediate state lives (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewatch",
                  scratch: str | None = None) -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.stateSchemaCheck", "true")
    )
    if scratch:
        builder = builder.config("spark.local.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, scratch)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback_root: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    used as is.  Only when it is unset (local tests) do we create one.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    root = fallback_root or tempfile.mkdtemp(prefix="tidewatch-")
    path = os.path.join(root, "checkpoints")
    spark.conf.set(CHECKPOINT_KEY, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def state_path(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared checkpoint dir (streaming state, versions)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts])


_SHIPPED: set[str] = set()


def _package_zip() -> bytes:
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    return buf.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewatch`` importable in the executors' Python workers.

    Operators that run Python on executors (``mapInArrow``,
    ``applyInPandasWithState``) reference this package's functions, so the
    workers must import it.  This does what ``--py-files`` does: zip the
    package once per application and hand it to ``SparkContext.addPyFile``.
    On a cluster the zip is written under the shared ``spark.checkpoint.dir``
    (through the Hadoop FileSystem API), never to a machine-local folder; a
    Spark Connect client uploads it as a session artifact instead.
    Nothing happens when the package was already shipped with ``--py-files``.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect sessions have no SparkContext)
        sc = None
    if sc is None:
        key = f"connect:{id(spark)}"
        if key not in _SHIPPED:
            out = os.path.join(tempfile.mkdtemp(prefix="tidewatch-pkg-"), "tidewatch.zip")
            with open(out, "wb") as fh:
                fh.write(_package_zip())
            spark.addArtifacts(out, pyfile=True)      # uploaded through the Connect channel
            _SHIPPED.add(key)
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    if "tidewatch" in (spark.conf.get("spark.submit.pyFiles", "") or ""):
        _SHIPPED.add(app)
        return
    data = _package_zip()
    if sc.master.startswith("local"):
        out = os.path.join(tempfile.mkdtemp(prefix="tidewatch-pkg-"), "tidewatch.zip")
        with open(out, "wb") as fh:
            fh.write(data)
    else:
        out = state_path(spark, "_pkg", app, "tidewatch.zip")
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(out)
        stream = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
    sc.addPyFile(out)
    _SHIPPED.add(app)
