"""A message-queue engine on Spark."""

from __future__ import annotations

from datetime import UTC, datetime
from pathlib import Path

__version__ = "0.2.0"
UNKNOWN = "unknown"


def commit_of(root: Path) -> str:
    """The commit a source tree is at, short, if it is one."""
    git = root / ".git"
    try:
        head = (git / "HEAD").read_text().strip()
        if not head.startswith("ref: "):
            return head[:12] or UNKNOWN
        name = head.removeprefix("ref: ")
        if (git / name).exists():
            return (git / name).read_text().strip()[:12]
        packed = dict(reversed(line.split(" ", 1)) for line in (git / "packed-refs").read_text().splitlines() if line[:1] not in "#^")
        return packed[name][:12]
    except (OSError, KeyError, ValueError):
        return UNKNOWN


def build_info() -> dict[str, str]:
    """Version, commit, time, Spark and Python of this build; "unknown" where it cannot be told."""
    import platform

    here = Path(__file__).resolve().parent
    try:
        built = datetime.fromtimestamp(max(f.stat().st_mtime for f in here.rglob("*.py")), UTC).isoformat(timespec="seconds")
    except (OSError, ValueError):
        built = UNKNOWN
    try:
        from pyspark import __version__ as spark
    except ImportError:
        spark = UNKNOWN
    return {"version": __version__, "git": commit_of(here.parent), "built": built, "spark": spark, "python": platform.python_version()}
