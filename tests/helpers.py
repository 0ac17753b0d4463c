"""Small hand-made inputs."""

from __future__ import annotations

import gzip
import itertools
import json
import uuid
from contextlib import contextmanager
from pathlib import Path

from tidemark.sinks.tables import LakeTable, ServingTable

_ids = itertools.count(1)


def event(created_at: str, kind: str = "WatchEvent", payload: dict | None = None, **fields) -> dict:
    """One archive line as a dict."""
    row = {
        "id": str(next(_ids)),
        "type": kind,
        "created_at": created_at,
        "public": True,
        "actor": {"id": 1, "login": "ann", "url": "u"},
        "repo": {"id": 7, "name": "ann/tool", "url": "r"},
        "payload": payload or {},
    }
    row.update(fields)
    return row


def write_archive(folder: Path, stem: str, rows: list[dict | str]) -> None:
    """Land one hourly archive; text rows are written as they are."""
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / f"{stem}.json.gz", "wt") as out:
        for row in rows:
            out.write((row if isinstance(row, str) else json.dumps(row)) + "\n")


def lake(spark, tmp_path: Path) -> LakeTable:
    name = f"lake_{uuid.uuid4().hex}"
    return LakeTable(spark, name, str(tmp_path / name)).create()


def serving(spark, tmp_path: Path) -> ServingTable:
    name = f"serving_{uuid.uuid4().hex}"
    return ServingTable(spark, name, str(tmp_path / name)).create()


def content(frame, *columns) -> list[tuple]:
    """Rows in a comparable order."""
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)

@contextmanager
def session_conf(spark, **settings: str):
    """Apply SQL settings for a block. Keys use ``__`` for ``.``."""
    keys = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
