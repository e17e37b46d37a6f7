"""Parquet tables: counted writes, full rebuilds, and keyed merges into partitioned tables.

All three publish what they wrote as a whole (`published`): readers see the table before or after.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmark.config import SILVER_PARTITIONS
from tillmark.operators.incremental import append_new_columns
from tillmark.session import shuffles_freed
from tillmark.sources import published
from tillmark.sources.paths import path_exists, remove_path, size_of
from tillmark.sources.published import Change, Version

MOST_FOLDERS = 32  # in which one partition may lie
PART_BYTES = 1 << 30  # of files that one job shuffles the rows of; what is larger goes in parts


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Runs a write and returns its row count, observed on the way instead of by a second scan.

    `write` must not shuffle: rows are then counted by the tasks that write them, each of which
    counts once, however often earlier stages are run again after a lost executor.
    """
    seen = Observation()
    with shuffles_freed(df.sparkSession):
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get.get("rows") or 0)


# ---- parts: what is too large for the disks to hold all of its shuffles at once ----------------


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files that a DataFrame reads; what is no file counts nothing."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)  # Spark's word for unknown is beyond


def parts_for(size: int) -> int:
    return max(1, -(-size // PART_BYTES))


def in_parts(df: DataFrame, key: str, size: int) -> list[DataFrame]:
    """The rows by a hash of a key, in as many parts as `size` bytes of input take. Each reads the
    input again and takes its own rows before anything is shuffled."""
    n = parts_for(size)
    own = F.pmod(F.xxhash64(key), F.lit(n))
    return [df.filter(own == F.lit(i)) for i in range(n)] if n > 1 else [df]


def grouped(sizes: dict) -> list[list]:
    """Names by their sizes, in groups of `PART_BYTES` and at least one name."""
    groups, room = [], 0
    for name, size in sizes.items():
        if not groups or size > room:
            groups.append([])
            room = PART_BYTES
        groups[-1].append(name)
        room -= size
    return groups


def partition_groups(
    spark: SparkSession, path: str, version: Version, folders: Iterable[str]
) -> list[list[tuple]]:
    """The partitions that some folders of a table lie in, in groups for one job each."""
    folders, sizes = sorted(set(folders), key=lambda f: f.split("/")[1:]), Counter()
    if sum(size_of(spark, f"{path}/{top}") for top in {f.split("/")[0] for f in folders}) <= PART_BYTES:
        together = dict.fromkeys(published.values_of(f, version.schema) for f in folders)
        return [[*together]] if together else []
    for folder in folders:
        sizes[published.values_of(folder, version.schema)] += size_of(spark, f"{path}/{folder}")
    return grouped(sizes)


def replace_table(df: DataFrame, path: str) -> int:
    """Full rebuild; returns the number of rows. Readers have the previous rows until it is done."""
    spark = df.sparkSession
    now = published.current(spark, path)
    folder = published.new_folder(now)
    rows = counted(df, lambda out: out.write.mode("overwrite").parquet(f"{path}/{folder}"))
    published.publish(spark, path, now, df.schema, [folder])
    return rows


def table_exists(spark: SparkSession, path: str) -> bool:
    return published.exists(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as last published, with all its columns; older files give null for newer ones."""
    return published.read(spark, path, _current(spark, path))


def table_schema(spark: SparkSession, path: str) -> StructType:
    return _current(spark, path).schema


def _current(spark: SparkSession, path: str) -> Version:
    version = published.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return version


# ---- columns of folders that are only ever added to --------------------------------------------


def _schema_path(path: str) -> str:
    return f"{path}/_schema"  # Spark skips names with an underscore when it lists a table


def union_schema(spark: SparkSession, path: str) -> StructType:
    """All columns that any schema on record has."""
    columns = {}
    for row in spark.read.text(_schema_path(path)).collect():  # one row per change of columns
        for column in StructType.fromJson(json.loads(row.value)):
            columns.setdefault(column.name, column)
    return StructType(list(columns.values()))


def record_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Notes columns that are not on record yet."""
    known = union_schema(spark, path).names if path_exists(spark, _schema_path(path)) else []
    if not set(schema.names) <= set(known):
        _record_schema(spark, path, schema)


def _record_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Appends, never replaces: a lost job cannot leave the table without a schema."""
    (
        spark.range(1)
        .select(F.lit(schema.json()).alias("value"))
        .write.mode("append")
        .text(_schema_path(path))
    )


# ---- partitioned tables whose columns may grow -----------------------------------------------


def _partition_key(partitions: tuple[str, ...]) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(p).cast("string"), F.lit("-")) for p in partitions])


def within(partitions: tuple[str, ...], rows: Iterable[tuple]) -> Column:
    """Rows of the given partitions; refers to partition columns only, so it prunes the scan."""
    names = ["/".join("-" if v is None else str(v) for v in row) for row in rows]
    return _partition_key(partitions).isin(*names) if names else F.lit(False)


def _partitions_of(df: DataFrame, partitions: tuple[str, ...]) -> list[Row]:
    return df.select(*partitions).distinct().collect()  # at most the number of stored partitions


def _write_partitions(
    df: DataFrame | Sequence[DataFrame], path: str, partitions: tuple[str, ...],
    mode: str, derived: dict[str, Column] | None = None,
) -> int:
    """One set of files per partition, and per part of the rows: parts are written one after the other,
    so that only one's shuffles lie on the disks. Rebalancing gathers a partition's rows in few tasks
    and splits the tasks of a partition that is too large for one. Columns that are `derived` from others
    are left out of this shuffle and computed after it."""
    derived, rows = derived or {}, 0
    for part in [df] if isinstance(df, DataFrame) else df:
        dealt = part.drop(*derived).hint("rebalance", *partitions)
        rows += counted(
            dealt.withColumns(derived).select(*part.columns) if derived else dealt,
            lambda out: out.write.mode(mode).partitionBy(*partitions).parquet(path),
        )
        mode = "append"
    return rows


def around(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows between the lowest and the highest of the keys: no match lies outside.

    The bounds reach the Parquet scan as literals. Ids that grow over time then skip nearly all
    of a table's files; for other ids it reads what it would have read anyway.
    """
    with shuffles_freed(df.sparkSession):
        low, high = keys.agg(F.min(key), F.max(key)).first()
    return df.filter(F.col(key).between(F.lit(low), F.lit(high)))


@dataclass(frozen=True)
class Merged:
    """What a merge did: rows of the batch, and the partitions that differ since."""

    rows: int
    partitions: tuple[tuple, ...]


def merge_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame | Sequence[DataFrame],
    key: str = "surrogate_key",
    partitions: tuple[str, ...] = SILVER_PARTITIONS,
    keys: DataFrame | None = None,
    before: Callable[[tuple[tuple, ...]], None] = lambda partitions: None,
    derived: dict[str, Column] | None = None,
) -> Merged:
    """Upserts a batch into a partitioned table.

    All rows with a key of the batch are replaced, and those with one of `keys`: a key that the
    batch brings no rows for loses the rows it had. The batch is written once, into partitions of a new
    folder. Partitions that hold a key to remove, wherever the new row of that key belongs (a corrected
    order may have changed month), are written again without it; on a normal night there are none.
    Then the new folders are published in place of the old ones: a run that breaks off before has
    changed nothing, and whoever ran it runs it again. The rows removed are kept beside, for whoever
    follows the table by its changes. `before` is told the partitions of an existing
    table that are about to change. Columns of the batch that follow from its others, by the expressions
    in `derived`, are computed as its rows are written and are not shuffled.

    A batch may come in parts with the same columns, of which each is computed by itself; months that are
    written again go in groups. So the shuffles on the disks are those of a part, not of the whole.

    A partition that has come to lie in `MOST_FOLDERS` folders is written again as well.
    """
    now = published.current(spark, path)
    folder = published.new_folder(now)
    # The batch is read for its keys and for its rows; written first, it is computed once.
    batch = [batch] if isinstance(batch, DataFrame) else batch
    rows = _write_partitions(batch, f"{path}/{folder}", partitions, "append", derived)
    schema = batch[0].schema
    added = published.partitions_in(spark, path, folder, len(partitions))
    fresh = {published.values_of(f, schema) for f in added}
    if now is None:
        published.publish(spark, path, None, schema, added, change=Change(tuple(added)))
        return Merged(rows, tuple(fresh))

    stage = f"{path}/_stage-{folder.partition('=')[2]}"  # hidden from readers of the table
    written = published.read(spark, path, Version(now.number + 1, schema, tuple(added)))
    gone = written.select(key) if keys is None else written.select(key).union(keys.select(key))
    counted(gone.distinct(), lambda out: out.write.parquet(f"{stage}/keys"))
    removed = spark.read.schema(gone.schema).parquet(f"{stage}/keys")
    target = published.read(spark, path, now)
    with shuffles_freed(spark):
        found = around(target, removed, key).join(removed, key, "left_semi")
        hit = {*map(tuple, _partitions_of(found, partitions))}
    changed = tuple(hit | fresh)
    if changed:
        before(changed)
        again, gone_rows, kept = hit | _crowded(now), [], []

        def parts(of: set[tuple], how: str) -> list[DataFrame]:
            return [
                rows.join(removed, key, how).select(*target.columns)
                for rows in _groups(spark, path, now, partitions, of)
            ]

        if hit:
            gone_rows = _written_again(
                parts(hit, "left_semi"), path, now, partitions, published.REMOVED
            )
        if again:
            kept = _written_again(parts(again, "left_anti"), path, now, partitions)
        folders = [f for f in now.folders if published.values_of(f, now.schema) not in again]
        schema = append_new_columns(target, written).schema
        change = Change(tuple(added), tuple(gone_rows))
        published.publish(spark, path, now, schema, [*folders, *kept, *added], change=change)
    remove_path(spark, stage)
    return Merged(rows, changed)


def _crowded(version: Version) -> set[tuple]:
    """Partitions that lie in many folders, and so in many small files."""
    folders = Counter(published.values_of(f, version.schema) for f in version.folders)
    return {values for values, n in folders.items() if n >= MOST_FOLDERS}


def _groups(
    spark: SparkSession, path: str, now: Version, partitions: tuple[str, ...], of: set[tuple]
) -> list[DataFrame]:
    """The rows of some partitions, as few at once as `PART_BYTES` says."""
    target = published.read(spark, path, now)
    folders = [f for f in now.folders if published.values_of(f, now.schema) in of]
    groups = partition_groups(spark, path, now, folders)
    return [target.filter(within(partitions, group)) for group in groups]


def _written_again(
    parts: Sequence[DataFrame], path: str, now: Version, partitions: tuple[str, ...],
    kind: str = published.WRITTEN,
) -> list[str]:
    """Writes what some partitions keep of their rows, or lose; returns the new folders."""
    folder = published.new_folder(now, kind)
    _write_partitions(parts, f"{path}/{folder}", partitions, "overwrite")
    return published.partitions_in(parts[0].sparkSession, path, folder, len(partitions))


def append_partitions(
    df: DataFrame | Sequence[DataFrame], path: str, partitions: tuple[str, ...], source: str, number: int
) -> int:
    """Adds a numbered delivery, once: one that is in already, or an earlier one, is left out.

    Returns the rows added. The delivery is in as a whole or not at all, so a run that broke off can
    deliver it again.
    """
    parts = [df] if isinstance(df, DataFrame) else df
    df, spark = parts[0], parts[0].sparkSession
    now = published.current(spark, path)
    if now is not None and number <= now.taken.get(source, -1):
        return 0
    folder = published.new_folder(now)
    rows = _write_partitions(parts, f"{path}/{folder}", partitions, "append")
    added = published.partitions_in(spark, path, folder, len(partitions))
    others, kept, schema = [], [], df.schema
    if now is not None:
        target, again = published.read(spark, path, now), _crowded(now)
        schema = append_new_columns(target, df).schema
        others = [f for f in now.folders if published.values_of(f, now.schema) not in again]
        if again:
            kept = _written_again(_groups(spark, path, now, partitions, again), path, now, partitions)
    published.publish(
        spark, path, now, schema, [*others, *kept, *added], {source: number}, Change(tuple(added))
    )
    return rows


def replace_partitions(
    df: DataFrame | Sequence[DataFrame], path: str, partitions: tuple[str, ...],
    replaced: Iterable[tuple], taken: dict[str, int] | None = None,
) -> None:
    """Publishes rows of the `replaced` partitions, perhaps in parts, in place of what these hold."""
    parts = [df] if isinstance(df, DataFrame) else df
    df, spark = parts[0], parts[0].sparkSession
    now = published.current(spark, path)
    folder = published.new_folder(now)
    _write_partitions(parts, f"{path}/{folder}", partitions, "overwrite")
    added = published.partitions_in(spark, path, folder, len(partitions))
    gone = {*map(tuple, replaced)} | {published.values_of(f, df.schema) for f in added}
    others, schema = [], df.schema
    if now is not None:
        others = [f for f in now.folders if published.values_of(f, now.schema) not in gone]
        schema = append_new_columns(published.read(spark, path, now), df).schema
    published.publish(spark, path, now, schema, [*others, *added], taken)
