"""Folders for intermediate tables, shared by driver and executors."""

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

SHARED = "spark.checkpoint.dir"


def work_folder(spark: SparkSession) -> str:
    """A new folder under the one that the cluster names in ``spark.checkpoint.dir``.

    A session in one process may take a temporary folder where the setting is missing; any other
    stops, as its executors would write to their own disks.
    """
    shared = spark.conf.get(SHARED, None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {SHARED} to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="barloom-")
    return f"{shared.rstrip('/')}/barloom/{uuid4().hex}"
