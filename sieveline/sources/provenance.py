"""What a run ran on: the driver's machine, tools and repository. Nothing here may fail a run."""

from __future__ import annotations

import platform
import shutil
import socket
import subprocess
from contextlib import suppress
from importlib import metadata
from pathlib import Path

TOOLS = ("pyspark", "pyarrow", "PyYAML", "PyMuPDF")


def git(folder: str | Path) -> tuple[str, bool]:
    """The commit and whether there are changes beside it; ("unknown", True) if that can't be told."""
    call = lambda *a: subprocess.run(["git", *a], cwd=folder, check=True, capture_output=True, text=True, timeout=30).stdout.strip()
    try:
        return call("rev-parse", "HEAD"), bool(call("status", "--porcelain"))
    except (OSError, subprocess.SubprocessError):
        return "unknown", True


def tools() -> dict[str, str]:
    out = {}
    for name in TOOLS:
        try:
            out[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            out[name] = "not_installed"
    return out


def memory(text: str) -> dict:
    """Available memory and swap, in bytes, from the text of /proc/meminfo; None for what it doesn't say."""
    values = {}
    for line in text.splitlines():
        key, _, rest = line.partition(":")
        parts = rest.split()
        if parts and parts[0].isdigit():
            values[key] = int(parts[0]) * (1024 if parts[1:] == ["kB"] else 1)
    swap = values.get("SwapTotal")
    return {"available_memory_bytes": values.get("MemAvailable"), "swap_status": "unavailable" if swap is None else "enabled" if swap else "disabled", "swap_total_bytes": swap, "swap_free_bytes": values.get("SwapFree")}


def machine(folder: str | Path) -> dict:
    """Host, versions, disk around the folder, uptime, memory and swap."""
    at = next((p for p in (Path(folder), *Path(folder).parents) if p.exists()), Path("/"))
    out = {"hostname": socket.gethostname(), "python_version": platform.python_version(), "tool_versions": tools(), "disk_path": str(at), "disk_total_bytes": None, "disk_available_bytes": None, "uptime_seconds": None}
    with suppress(OSError):
        disk = shutil.disk_usage(at)
        out |= {"disk_total_bytes": disk.total, "disk_available_bytes": disk.free}
    text = ""
    with suppress(OSError):
        text = Path("/proc/meminfo").read_text(encoding="utf-8")
    with suppress(OSError, ValueError, IndexError):
        out["uptime_seconds"] = float(Path("/proc/uptime").read_text(encoding="utf-8").split()[0])
    return out | memory(text)
