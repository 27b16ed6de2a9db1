"""Where a service's token comes from: an environment variable, else a file that only its owner can read.

Tokens are read where they are used: they never enter a DataFrame, a plan, an option or a message.
"""

from __future__ import annotations

import os
import stat
from pathlib import Path


def token_source(variable: str, file: str | Path | None = None) -> str | None:
    """"environment", "file" or None; nothing is read but the file's presence."""
    if os.environ.get(variable):
        return "environment"
    return "file" if file and Path(file).is_file() else None


def get_token(variable: str, file: str | Path | None = None) -> str:
    source = token_source(variable, file)
    if source is None:
        raise RuntimeError(f"no token: set {variable} or name a token file")
    if source == "environment":
        token = os.environ[variable].strip()
    else:
        mode = stat.S_IMODE(Path(file).stat().st_mode)
        if os.name == "posix" and mode & 0o077:
            raise PermissionError("the token file must be readable by its owner alone")
        token = Path(file).read_text().strip()
    if not token:
        raise RuntimeError("the token is empty")
    return token
