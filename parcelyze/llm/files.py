"""Files in the shared folder: written under temporary names, then committed.

Tasks open paths through ``pyarrow.fs``, so ``file:``, ``hdfs:`` and object-store
URIs all work. A task writes a file under a name no other attempt uses and
reports it as a row of its result; Spark keeps the rows of one successful
attempt per task. Only the driver then gives those files their final names and
writes the manifest, one line per file. Readers open what the manifest lists,
so files of lost or repeated attempts are never seen.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs as pafs

from ..session import app_id, scratch_path

MANIFEST = "manifest.jsonl"


def resolve(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:/", "file:///", 1))


def new_folder(spark, label: str) -> str:
    """A folder of its own under the shared checkpoint folder."""
    path = scratch_path(spark, label, app_id(spark), uuid.uuid4().hex)
    fs, p = resolve(path)
    fs.create_dir(f"{p}/_temporary", recursive=True)
    return path


def temporary_name(suffix: str) -> str:
    return f"_temporary/{uuid.uuid4().hex}{suffix}"


def commit(folder: str, entries: list) -> list:
    """``entries``: dicts with ``temporary`` and ``name``. Give every file its final
    name and write the manifest last; a folder without it was not committed."""
    fs, p = resolve(folder)
    for e in entries:
        fs.move(f"{p}/{e['temporary']}", f"{p}/{e['name']}")
    rows = [{k: v for k, v in e.items() if k != "temporary"} for e in entries]
    draft = f"{p}/_temporary/{uuid.uuid4().hex}.manifest"
    with fs.open_output_stream(draft) as out:
        out.write("".join(json.dumps(r, sort_keys=True) + "\n" for r in rows).encode())
    fs.move(draft, f"{p}/{MANIFEST}")
    return rows


def manifest(folder: str) -> list:
    fs, p = resolve(folder)
    with fs.open_input_stream(f"{p}/{MANIFEST}") as f:
        return [json.loads(x) for x in f.read().decode().splitlines()]
