"""Session helpers: one place for the SQL settings every job relies on."""

from __future__ import annotations

import re
import tempfile
import threading
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

# Settings the library's semantics depend on (UTC, NTZ timestamps, ANSI on).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}

# Settings that matter for scale; a cluster config may override them.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "parcelyze", extra: dict | None = None) -> SparkSession:
    """Local session for tests / bench. On a cluster, use the cluster's session
    and call :func:`configure` on it instead."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {**REQUIRED_CONF, **SCALE_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true"}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def merged(df):
    """A join side with a row per key of the input, to be met by sorting and merging
    whatever its size. The planner would go by the bytes of its files, and a million
    encoded keys are few of them: broadcast, they pass through the driver's memory as a
    hash table of a hundred MB, one a join, and independent writes plan several at once.
    Sides that the input does not lengthen (nations, a calendar, totals) need no hint."""
    return df.hint("merge")


_LOCAL_DIRS: dict = {}


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` when set; only when it is unset
    (local tests) a fresh scratch folder is created and registered."""
    if id(spark) in _LOCAL_DIRS:
        return _LOCAL_DIRS[id(spark)]
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:                                   # classic sessions; Spark Connect has no SparkContext
        sc = spark.sparkContext
        d = d or sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001
        pass
    if not d:
        master = spark.conf.get("spark.master", None)
        if master is None or not re.match(r"local($|\[)", master):    # unknown counts as a cluster
            raise RuntimeError("spark.checkpoint.dir is not set: unless the master is known to be local, "
                               "intermediate tables must go to shared storage (set spark.checkpoint.dir)")
        d = tempfile.mkdtemp(prefix="parcelyze-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
        _LOCAL_DIRS[id(spark)] = d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_dir(spark), *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder exist? Asked of the store that Spark's readers
    would open, with or without a scheme (a bare path is on the default file
    system, which need not be the driver's disk). No job runs."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """SRC6: a catalog table name or a written table folder."""
    if "/" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def materialize(df, label: str = "t", written: list | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and read
    it back: one job, lineage cut, survives executor loss (unlike a local
    checkpoint or a cache). Used for small intermediate results that several
    later passes read. It runs a job; functions that call it say so.
    :func:`drop_materialized` removes the tables once their readers are done.
    ``written``: for larger tables, a list that gets the folder, so that the caller can
    :func:`drop_folders` before that; these are written with zstd."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, "materialized", app_id(spark), f"{label}-{uuid.uuid4().hex}")
    w = df.write.mode("overwrite")
    if written is not None:
        written.append(path)
        w = w.option("compression", "zstd")
    w.parquet(path)
    return spark.read.parquet(path)


def drop_folders(spark: SparkSession, paths) -> None:
    """Delete folders in the store that Spark's writers would open."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def drop_materialized(spark: SparkSession) -> None:
    """Delete what this application has materialized so far. For callers that
    have consumed (written or collected) every result built from it."""
    drop_folders(spark, [scratch_path(spark, "materialized", app_id(spark))])


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROPPING: dict = {}                       # application -> (how many are inside, the setting before)
_DROPPING_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """The shuffle files of a query that runs inside go when it has ended. Spark else keeps
    them until the driver happens to collect its garbage, so that a chain of writes holds
    the shuffles of all of them. Only for queries that are executed once; what is planned
    inside and executed again has its stages run again."""
    key = app_id(spark)
    with _DROPPING_LOCK:
        inside, before = _DROPPING.get(key) or (0, spark.conf.get(_DROP_SHUFFLES, None))
        _DROPPING[key] = inside + 1, before
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            inside, before = _DROPPING.pop(key)
            if inside > 1:
                _DROPPING[key] = inside - 1, before
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def dropping_shuffles(fn):
    """A function of a session and more that runs in :func:`shuffles_dropped`."""
    @wraps(fn)
    def run(spark, *args, **kwargs):
        with shuffles_dropped(spark):
            return fn(spark, *args, **kwargs)
    return run


def write_tables(jobs, max_concurrent: int = 4) -> dict:
    """Run independent table writes concurrently: ``jobs`` maps a name to a
    no-argument function that runs one write and returns a value. Each write is
    its own Spark job; submitting a few at once keeps the cluster busy while
    small tables finish, and the scheduler still shares resources between them.
    Returns {name: value}; the first failure is re-raised."""
    from concurrent.futures import ThreadPoolExecutor
    jobs = dict(jobs)
    if max_concurrent <= 1 or len(jobs) <= 1:
        return {n: fn() for n, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_concurrent, len(jobs))) as pool:
        futures = {n: pool.submit(fn) for n, fn in jobs.items()}
        return {n: f.result() for n, f in futures.items()}
