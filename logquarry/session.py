"""Session set-up, object-store settings and scratch folders."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession


def build_session(
    app_name: str,
    master: str | None = None,
    hive: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; ``hive`` turns on the persistent catalog."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    session_token: str | None = None,
    provider: str | None = None,
) -> dict[str, str]:
    """Settings for ``s3a://`` paths, to be passed to :func:`build_session`.

    Only what is given is set. Without keys or a ``provider`` (a class name, or several with
    commas) the connector's own chain decides, which is how a cluster should run.
    """
    if bool(access_key) != bool(secret_key):
        raise ValueError("an access key and a secret key go together")
    if session_token and not access_key:
        raise ValueError("a session token needs its keys")
    given = {
        "endpoint": endpoint,
        "access.key": access_key,
        "secret.key": secret_key,
        "session.token": session_token,
        "aws.credentials.provider": provider,
    }
    return {f"spark.hadoop.fs.s3a.{k}": v for k, v in given.items() if v}


@cache
def _local_folder() -> str:
    """One folder for all scratch data of this process, removed when it ends."""
    base = tempfile.mkdtemp(prefix="logquarry-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master, where driver and executors share one disk, may do without it. What
    is below the shared folder belongs to whoever names it, who also clears it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"
