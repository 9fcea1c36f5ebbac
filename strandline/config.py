"""Settings from the environment and `.env` files, and the directory layout below one home folder."""

from __future__ import annotations

import os
from dataclasses import dataclass
from pathlib import Path


def load_dotenv(path: Path) -> None:
    """`KEY=value` lines into the environment; what is set already stays."""
    if not path.is_file():
        return
    for line in path.read_text(encoding="utf-8").splitlines():
        k, eq, v = line.strip().partition("=")
        if eq and k and not k.startswith("#"):
            os.environ.setdefault(k.strip(), v.strip().strip("'\""))


@dataclass(frozen=True)
class Settings:
    home: Path
    email: str = ""
    api_key: str = ""

    @classmethod
    def load(cls, home: str | None = None) -> Settings:
        load_dotenv(Path.cwd() / ".env")
        base = Path(home or os.environ.get("STRANDLINE_HOME") or Path.cwd() / "data")
        load_dotenv(base / ".env")
        return cls(base, os.environ.get("STRANDLINE_EMAIL", ""), os.environ.get("STRANDLINE_API_KEY", ""))

    def folder(self, name: str) -> Path:
        """One of the layout's folders: catalogue, raw, work, records, export, ontologies, scope, review."""
        return self.home / name
