"""Merging of the many small folders that a history or a changelog grows by.

A folder holds units, one subfolder per job. ``FAN`` finished units become a merged folder of tier 1, ``FAN`` of those one of tier 2, and
so on; so after n jobs there are some ``FAN * log(n)`` folders to list and footers to read. A merged folder has a subfolder per
schema, so that no type is changed, and counts once its ``_covers`` file names what it holds, which comes last. From then
on the covered folders are not read, whether they are removed yet or not.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sinks.files import write_parquet
from ..sources.storage import folders, read_text, remove_folder, stored_size, write_text

FAN = 16
FILE_BYTES = 256 << 20  # of a merged file, about
_MERGED = "_merged-"


def _state(spark: SparkSession, base: str) -> tuple[list[str], dict[str, dict]]:
    """All folders, and of the merged ones that count what they cover."""
    names = folders(spark, base)
    covers = {}
    for name in names:
        if name.startswith(_MERGED):
            text = read_text(spark, f"{base.rstrip('/')}/{name}/_covers")
            if text:
                covers[name] = json.loads(text)
    return names, covers


def readable(spark: SparkSession, base: str, counts: Callable[[str], bool] = lambda name: True) -> list[str]:
    """The paths to read: units that count, and the schemas of merged folders, every row once."""
    base = base.rstrip("/")
    names, covers = _state(spark, base)
    covered = {c for told in covers.values() for c in told["covers"]}
    paths = []
    for name in names:
        if name in covered:
            continue
        if name in covers:
            paths += [f"{base}/{name}/schema={k}" for k in range(covers[name]["schemas"])]
        elif not name.startswith(_MERGED) and counts(name):
            paths.append(f"{base}/{name}")
    return paths


def by_schema(spark: SparkSession, paths: list[str]) -> dict[T.StructType, list[str]]:
    """Paths by the schema of their files: one footer each."""
    found: dict[T.StructType, list[str]] = {}
    for path in paths:
        found.setdefault(spark.read.parquet(path).schema, []).append(path)
    return found


def compact(spark: SparkSession, base: str, final: Callable[[str], bool], codec: str, fan: int = FAN) -> int:
    """Merge what is ready; returns how many merged folders that made.

    ``final`` says of a unit that no job will write it again. A try that died is taken up by the next one: folders without
    ``_covers`` are dropped, covered ones removed before anything else.
    """
    base, made = base.rstrip("/"), 0
    names, covers = _state(spark, base)
    for name in names:
        if (name.startswith(_MERGED) and name not in covers) or any(name in told["covers"] for told in covers.values()):
            remove_folder(spark, f"{base}/{name}")
    gone = {c for told in covers.values() for c in told["covers"]}
    tiers: dict[int, list[str]] = {}
    for name in names:
        if name in gone or (name.startswith(_MERGED) and name not in covers):
            continue
        tiers.setdefault(covers[name]["tier"] if name in covers else 0, []).append(name)
    tier = 0
    while tier <= max(tiers, default=-1):
        ready = sorted(tiers.get(tier, []))
        if len(ready) >= fan and tier == 0:
            ready = [n for n in ready if final(n)]
        while len(ready) >= fan:
            name = _merge(spark, base, ready[:fan], tier + 1, covers, codec)
            covers[name] = {"schemas": json.loads(read_text(spark, f"{base}/{name}/_covers"))["schemas"]}
            tiers.setdefault(tier + 1, []).append(name)
            ready, made = ready[fan:], made + 1
        tier += 1
    return made


def _merge(spark: SparkSession, base: str, units: list[str], tier: int, covers: dict[str, dict], codec: str) -> str:
    paths = []
    for unit in units:
        paths += [f"{base}/{unit}/schema={k}" for k in range(covers[unit]["schemas"])] if unit in covers else [f"{base}/{unit}"]
    name = f"{_MERGED}{tier:02d}-{uuid.uuid4().hex}"
    groups = by_schema(spark, paths)
    for k, (schema, group) in enumerate(groups.items()):
        files = max(1, -(-sum(stored_size(spark, p) for p in group) // FILE_BYTES))
        rows = spark.read.schema(schema).parquet(*group)
        write_parquet(rows.coalesce(int(files)), f"{base}/{name}/schema={k}", codec=codec)
    write_text(spark, f"{base}/{name}/_covers", json.dumps({"tier": tier, "covers": units, "schemas": len(groups)}))
    for unit in units:
        remove_folder(spark, f"{base}/{unit}")
    return name
