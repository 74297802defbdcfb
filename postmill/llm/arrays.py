"""Arrays as files in the shared folder, which Python workers write once and then map into memory."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import SparkSession

from postmill.sources.checkpoints import checkpoint_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the session's shared folder; it is made when the first array is written."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else None


def put(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array. A task that runs again replaces the file by an equal one, in one step."""
    local = _local(folder)
    if local:
        os.makedirs(local, exist_ok=True)
        temporary = f"{local}/.{name}-{uuid.uuid4().hex}"
        values.tofile(temporary)
        os.replace(temporary, f"{local}/{name}")
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    temporary = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        out.write(values.tobytes())
    store.move(temporary, f"{path}/{name}")


def get(folder: str, name: str, dtype: str) -> np.ndarray:
    """The array: mapped where the shared folder is mounted, else read from its store."""
    local = _local(folder)
    if local:
        path = f"{local}/{name}"
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=dtype)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}") as data:
        return np.frombuffer(data.read(), dtype=dtype)
