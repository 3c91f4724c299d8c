"""Storage locations."""

from __future__ import annotations


def storage_path(relative: str, base: str) -> str:
    """Join a relative data path to a base URI or folder.

    The scheme of ``base`` (``hdfs://``, ``s3a://``, a plain path) decides the
    file system; Spark resolves it, so no other switch is needed.
    """
    tail = relative.strip("/")
    if "://" not in base and tail.startswith("data/"):
        tail = tail[len("data/"):]
    return f"{base.rstrip('/')}/{tail}"
