"""Schema registry in a folder: <subject>/<version>.avsc; ids count all schemas in order of registration."""

from __future__ import annotations

import json
import threading
from pathlib import Path
from typing import Protocol


class SchemaRegistry(Protocol):
    def by_id(self, schema_id: int) -> str: ...

    def latest(self, subject: str) -> tuple[int, str]: ...


class FolderRegistry:
    """Ids and versions are fixed once given; by_id answers are kept, under a lock."""

    def __init__(self, root: str):
        self.root, self._kept, self._lock = Path(root), {}, threading.Lock()

    def _ids(self) -> list[str]:
        index = self.root / "ids.json"
        return json.loads(index.read_text()) if index.exists() else []

    def register(self, subject: str, schema: str) -> int:
        with self._lock:
            known = self._ids()
            for i, name in enumerate(known):
                if name.startswith(f"{subject}/") and json.loads((self.root / name).read_text()) == json.loads(schema):
                    return i + 1
            version = 1 + sum(n.startswith(f"{subject}/") for n in known)
            (self.root / subject).mkdir(parents=True, exist_ok=True)
            name = f"{subject}/{version}.avsc"
            (self.root / name).write_text(schema)
            (self.root / "ids.json").write_text(json.dumps([*known, name]))
            return len(known) + 1

    def by_id(self, schema_id: int) -> str:
        with self._lock:
            if schema_id not in self._kept:
                known = self._ids()
                if not 1 <= schema_id <= len(known):
                    raise KeyError(f"no schema with id {schema_id}")
                self._kept[schema_id] = (self.root / known[schema_id - 1]).read_text()
            return self._kept[schema_id]

    def latest(self, subject: str) -> tuple[int, str]:
        found = [(i + 1, n) for i, n in enumerate(self._ids()) if n.startswith(f"{subject}/")]
        if not found:
            raise KeyError(f"no schema for {subject}")
        return found[-1][0], (self.root / found[-1][1]).read_text()
