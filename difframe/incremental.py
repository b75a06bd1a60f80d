"""Incremental catalogue loads: changed dump files into new table versions, with a log of loaded revisions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from difframe.operators.relational import best_row, upsert
from difframe.sources.changes import last_revision, revision_row
from difframe.sources.dump import read_dump
from difframe.streaming.upsert import latest, versions

_LOG = T.StructType([T.StructField("svn_revision", T.IntegerType()), T.StructField("tables_done", T.ArrayType(T.StringType())), T.StructField("notes", T.StringType()), T.StructField("synced_at", T.TimestampType())])


@dataclass
class Outcome:
    """What a run did: loaded tables, errors by table, whether the revision was recorded."""

    loaded: list[str] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)
    refused_rows: dict[str, int] = field(default_factory=dict)
    recorded: bool = False


def loaded_revision(spark: SparkSession, base: str) -> int | None:
    """The last revision recorded below ``base``."""
    try:
        return last_revision(spark.read.schema(_LOG).parquet(f"{base}/_revisions"))
    except Exception as e:  # noqa: BLE001 - no log yet
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def update(spark: SparkSession, dumps: dict[str, str], schemas: dict[str, T.StructType], keys: dict[str, list[str]], base: str, revision: int, dry_run: bool = False) -> Outcome:
    """Loads the dump files of changed tables (``dumps``: table to path) into new versions below ``base``.

    Each table's new version is the old one with the file's rows put in by key; rows the file refuses are counted.
    Errors of one table do not keep others from loading, but the revision is recorded only if all loaded, so the next
    run tries again.  A revision already recorded, or an older one, changes nothing; a dry run writes nothing at all.
    """
    out = Outcome()
    done = loaded_revision(spark, base)
    if done is not None and revision <= done:
        return out
    for name, path in sorted(dumps.items()):
        try:
            schema = schemas[name]
            rows, refused = read_dump(spark, path, schema)
            rest = [c for c in schema.names if c not in keys[name]]
            delta = best_row(rows, keys[name], rest, rest).select(*schema.names) if rest else rows.distinct()
            old, v = latest(spark, f"{base}/{name}", schema), versions(spark, f"{base}/{name}")
            new = upsert(old, delta, keys[name])
            out.refused_rows[name] = refused.count()
            if dry_run:
                new.isEmpty()
            else:
                new.write.mode("overwrite").parquet(f"{base}/{name}/v{(v[-1] if v else 0) + 1}")
            out.loaded.append(name)
        except Exception as e:  # noqa: BLE001 - reported, the other tables go on
            out.errors[name] = f"{type(e).__name__}: {e}"[:500]
    if not out.errors and not dry_run:
        revision_row(spark, revision, out.loaded).select(*_LOG.names).write.mode("append").parquet(f"{base}/_revisions")
        out.recorded = True
    return out
