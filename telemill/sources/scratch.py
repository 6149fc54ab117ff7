"""Where jobs may put intermediate tables, and how they get rid of them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_made: ContextVar[list[str] | None] = ContextVar("telemill_scratch", default=None)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only where that is unset and the session is local. Within a
    ``scratch_scope`` the folder is removed at its end, otherwise it stays.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        path = f"{shared.rstrip('/')}/telemill/{name}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix=f"telemill-{name}-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the folders that operators made inside when it ends, also after a failure.

    Operators return frames that read such folders, so the result has to be written or collected
    inside. Gives the list of folders made so far; a scope within a scope removes its own only.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in made:
            place = hadoop.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
