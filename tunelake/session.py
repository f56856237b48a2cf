"""Session settings and the shared folder the layers are written to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "UCT")

_local_folders: dict[str, str] = {}


def local_session(app_name: str = "tunelake", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-machine session may go without the setting; it then gets a fresh folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("create the session with spark.checkpoint.dir set to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tunelake-")
    return _local_folders[context.applicationId]


def require_utc(spark: SparkSession) -> None:
    """Days and hours of the layers are those of UTC; a session of another zone would read them differently."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}")
