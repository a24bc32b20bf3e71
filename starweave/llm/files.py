"""Files that tasks write into the shared checkpoint folder and read back."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder (as a URI or path) under spark.checkpoint.dir."""
    folder = os.path.join(ensure_checkpoint_dir(spark), f"{kind}-{uuid.uuid4().hex}")
    system, path = located(folder)
    system.create_dir(path)
    return folder


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it."""
    if "://" not in uri and uri.startswith("file:"):
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)
