"""Partitioned tables that change in one step.

A write goes to a folder of its own and is not seen before the next manifest, one small file that names the
folders of all live partitions, is moved into its place. A write that fails half-way, or whose driver is
lost, leaves the rows of before. What no manifest names any more is deleted after the swap. One writer
at a time; rows may be read from the table that they are written to.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Names of manifests, which Spark does not list, and of the folder of one write.
MANIFEST, FOLDER = "_manifest-", "table_version="


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and its name there. Spark names local files file:/..., with blanks as they are, which is no URI to Arrow."""
    plain = path.removeprefix("file:")
    return (fs.LocalFileSystem(), "/" + plain.lstrip("/")) if plain.startswith("/") else fs.FileSystem.from_uri(path)


def _children(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    return store.get_file_info(fs.FileSelector(folder, allow_not_found=True))


def _manifests(store: fs.FileSystem, root: str) -> list[str]:
    """Names of the manifests, oldest first."""
    return sorted(f.base_name for f in _children(store, root) if f.base_name.startswith(MANIFEST))


def _newest(store: fs.FileSystem, root: str) -> dict:
    found = _manifests(store, root)
    if not found:
        return {"folders": [], "schema": None}
    with store.open_input_stream(f"{root}/{found[-1]}") as stream:
        return json.loads(stream.read())


def exists(path: str) -> bool:
    return bool(_manifests(*locate(path)))


def live(path: str) -> list[str]:
    """Folders of the partitions that the newest manifest names."""
    return _newest(*locate(path))["folders"]


def write(df: DataFrame, path: str, keys: list[str], whole: bool = False) -> None:
    """Replace the partitions that df has rows for, or with `whole` (and without keys) all of them.

    An empty df replaces nothing, or everything by nothing. Columns that only older partitions have stay.
    """
    store, root = locate(path)
    before = _newest(store, root)
    if before["schema"] is None and any(not f.base_name.startswith(("_", ".", FOLDER)) for f in _children(store, root)):
        raise FileExistsError(f"{path} already exists and has no manifest")
    version = f"{FOLDER}v{uuid.uuid4().hex}"
    df.write.partitionBy(*keys).parquet(f"{path}/{version}")
    new = [version]
    for _ in keys:
        new = [f"{p}/{f.base_name}" for p in new for f in _children(store, f"{root}/{p}") if f.type == fs.FileType.Directory and "=" in f.base_name]
    within = lambda p: p.partition("/")[2]
    replaced = {within(p) for p in new}
    kept = [] if whole or not keys else [p for p in before["folders"] if within(p) not in replaced]
    fields = [*(f for f in df.schema if f.name not in keys), *(df.schema[k] for k in keys)]
    if kept:
        named = {f.name for f in fields}
        fields = [*(f for f in StructType.fromJson(before["schema"]) if f.name not in named), *fields]
    _swap(store, root, {"folders": kept + new, "schema": StructType(fields).jsonValue()})
    _clean(store, root, set(kept + new), len(keys))


def _swap(store: fs.FileSystem, root: str, manifest: dict) -> None:
    """Write the next manifest beside the table, then move it to a name that nothing has."""
    found = _manifests(store, root)
    number = int(found[-1].removeprefix(MANIFEST)) + 1 if found else 0
    draft = f"{root}/_draft-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as stream:
        stream.write(json.dumps(manifest).encode())
    store.move(draft, f"{root}/{MANIFEST}{number:012d}")


def _clean(store: fs.FileSystem, root: str, folders: set[str], depth: int) -> None:
    """Delete older manifests, drafts, and the folders that lead to no live partition."""
    # Every live folder and those above it.
    needed = {"/".join(p.split("/")[: k + 1]) for p in folders for k in range(depth + 1)}
    for name in _manifests(store, root)[:-1]:
        store.delete_file(f"{root}/{name}")
    for f in _children(store, root):
        if f.base_name.startswith("_draft-"):
            store.delete_file(f.path)
    level = [f.base_name for f in _children(store, root) if f.base_name.startswith(FOLDER)]
    for k in range(depth + 1):
        for p in level:
            if p not in needed:
                store.delete_dir(f"{root}/{p}")
        if k < depth:
            level = [f"{p}/{f.base_name}" for p in level if p in needed for f in _children(store, f"{root}/{p}") if f.type == fs.FileType.Directory and "=" in f.base_name]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest manifest, with the columns and types they were written with, keys last."""
    store, root = locate(path)
    found = _newest(store, root)
    if found["schema"] is None:
        raise FileNotFoundError(f"{path} has no manifest")
    schema = StructType.fromJson(found["schema"])
    if not found["folders"]:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/{p}" for p in found["folders"]))
    return rows.select(*(f"`{name}`" for name in schema.names))
