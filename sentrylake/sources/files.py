"""Single files on the driver."""

from __future__ import annotations

import os
import tempfile


def write_atomically(payload: bytes, path: str) -> None:
    """A driver-side file that is there whole or not at all; links are refused."""
    if os.path.islink(path):
        raise ValueError(f"{path} is a link")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    with os.fdopen(handle, "wb") as out:
        out.write(payload)
        out.flush()
        os.fsync(out.fileno())
    os.replace(temporary, path)
