"""Files in shared storage, read and written from inside tasks."""

from __future__ import annotations

import re
import uuid


def filesystem(address: str):
    """The file system of an address such as ``file:/…`` or ``hdfs://…``, and the path in it."""
    from pyarrow import fs

    address = re.sub(r"^file:/+", "file:///", address)
    if "://" not in address:
        return fs.LocalFileSystem(), address
    return fs.FileSystem.from_uri(address)


def attempt_name(prefix: str, part: int, suffix: str) -> str:
    """A name of its own for each attempt of a task, so that an attempt that is given up never mixes with another."""
    return f"{prefix}-{part:06d}-{uuid.uuid4().hex}{suffix}"
