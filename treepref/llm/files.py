"""Binary files in a folder that the driver and all executors share.

Paths are URIs as Spark gives them.  A task writes under a name of its own and
moves the finished file into place, so a task that runs again after a lost
executor replaces the file by an equal one and readers never see half a file.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def make_folder(spark: SparkSession, folder: str) -> None:
    """Make the folder, so that it can be read even if nothing is written to it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def write_file(folder: str, name: str, data: bytes) -> None:
    """Write one file of the folder, whole or not at all."""
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    elif folder.startswith("file:/") and not folder.startswith("file://"):
        folder = f"file://{folder[5:]}"
    store, root = fs.FileSystem.from_uri(folder)
    # Readers of the folder skip names that begin with a dot.
    part = f"{root}/.{name}.{uuid.uuid4().hex}"
    store.create_dir(root, recursive=True)
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{root}/{name}")
