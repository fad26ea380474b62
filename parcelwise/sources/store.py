"""Layer tables as Parquet generations of parts, and upserts that write only the parts they touch.

A table is cut into parts: one part for the whole of it, one for each batch, one for each value of a column, or hash
buckets of its keys. A commit writes new files for some parts and then a small pointer that says for every part which
write holds it. So a table may be overwritten from a plan that reads it, a failed write leaves the old state, earlier
generations can be read, and what a batch does not touch is neither read nor written. One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.utils import AnalysisException


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of rows given in the program. Spark knows its size (it does not for rows of a Python list), so
    joins with it are planned as broadcasts."""
    kinds = T.StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    arrow = to_arrow_schema(kinds)
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], names=kinds.names), kinds)


def sized(dim: DataFrame, most: int = 100_000) -> DataFrame:
    """A dimension of at most ``most`` rows as a table whose size Spark knows; a larger one as it is, to be shuffled.
    This runs the dimension once, and never brings more than ``most`` + 1 rows to the driver."""
    rows = dim.limit(most + 1).toArrow()
    return dim if rows.num_rows > most else dim.sparkSession.createDataFrame(rows, dim.schema)


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """A table whose files give fewer splits than the session has cores, dealt over all cores by ``keys``: a small file is
    often one row group, which one task would read and carry through all joins with small tables up to the next
    shuffle. Tables of more splits stay as they are, so only small ones are shuffled for it."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, *keys) if table.rdd.getNumPartitions() < cores else table


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``). Where the session names
    none, a local temporary folder serves a local master; a cluster has to name one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


@contextmanager
def no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """Writes and actions within plan their rows anew, so nothing reads their shuffle files once they have ended: those go then, and
    not when the driver happens to collect what refers to them."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def save(df: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists", parts: str | None = None, **options: object) -> None:
    """The rows written, compressed, with no shuffle files left."""
    writer = df.write.format(form).mode(mode).options(compression="zstd" if form == "parquet" else "gzip", **options)
    with no_shuffle_left(df.sparkSession):
        (writer if parts is None else writer.partitionBy(parts)).save(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder on any file system that Spark writes to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`written` makes within are deleted at the end, also where it breaks off: for work that leaves all its
    results in other tables."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            remove(spark, path)


def written(df: DataFrame, lasting: bool = False) -> DataFrame:
    """The rows as a table in the scratch folder, for a result that several plans branch from. A ``lasting`` one stays where others go
    (:func:`passing`)."""
    path, paths = scratch(df.sparkSession), _passing.get()
    if paths is not None and not lasting:
        paths.append(path)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool, prefix: str = "") -> list[Column]:
    return [left[k].eqNullSafe(right[f"{prefix}{k}"]) if null_safe else left[k] == right[f"{prefix}{k}"] for k in keys]


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], keep: list[str] = (), null_safe: bool = False, sequence: str | None = None) -> DataFrame:
    """Rows of the target that the source does not match, and all rows of the source; matched rows keep the target's
    values of the columns ``keep`` (a surrogate key, a creation time). Columns may be missing on either side. Null
    keys match only with ``null_safe``. With ``sequence`` the newer row of a key wins, on whichever side it is, and the
    source's among equals; a null sequence is the oldest."""
    if sequence:
        later = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(sequence).alias("_later"))
        stale = F.coalesce(F.col("_later") > F.col(sequence), F.col("_later").isNotNull() & F.col(sequence).isNull())
        source = source.join(later, [*_same(source, later, keys, null_safe, "_t_"), stale], "left_anti")
    if keep:  # one join in place of one for what is kept and one for what is not matched, so that each side is read once
        old = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_old"))
        new = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_new"))
        pairs = [(F.col(f"_t_{k}"), F.col(f"_s_{k}")) for k in keys]
        both = old.join(new, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs], "full")
        of = lambda c, side, df: F.col(f"_{side}_{c}") if c in df.columns else F.lit(None)
        value = lambda c: F.when(F.col("_old") if c in keep else F.col("_new").isNull(), of(c, "t", target)).otherwise(of(c, "s", source))
        return both.select(*[value(c).alias(c) for c in dict.fromkeys([*target.columns, *source.columns])])
    return target.join(source, _same(target, source, keys, null_safe), "left_anti").unionByName(source, allowMissingColumns=True)


def repeated_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one source row has: an upsert of such a source has no defined result."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@dataclass
class Generation:
    """What a pointer says: the table's schema, how it is cut, and for each part the write that holds it."""

    number: int = -1
    layout: str = ""
    schema: T.StructType | None = None
    versions: dict[str, int] = field(default_factory=dict)


@dataclass
class TableStore:
    """Tables under one folder. ``buckets`` is how many parts a new keyed table gets; an old one keeps its own."""

    spark: SparkSession
    root: str
    buckets: int = 64

    # --- generations

    def _pointer_files(self, name: str) -> list[int]:
        try:
            files = self.spark.read.schema("layout string").json(f"{self.root}/{name}/_pointer").inputFiles()
        except AnalysisException:
            return []
        return [int(x[1]) for f in files if (x := re.search(r"/generation=(\d+)/", f))]

    def generation(self, name: str) -> int:
        return max(self._pointer_files(name), default=-1)

    def state(self, name: str, generation: int | None = None) -> Generation:
        g = self.generation(name) if generation is None else generation
        if g < 0:
            return Generation()
        row = self.spark.read.schema("layout string, columns string, versions map<string,int>").json(f"{self.root}/{name}/_pointer/generation={g}").first()
        return Generation(g, row["layout"] or "", T.StructType.fromJson(json.loads(row["columns"])), row["versions"] or {})

    def exists(self, name: str) -> bool:
        return self.generation(name) >= 0

    def _read(self, name: str, schema: T.StructType, versions: dict[str, int]) -> DataFrame:
        paths = [f"{self.root}/{name}/g={v}/_part={p}" for p, v in sorted(versions.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, name: str, generation: int | None = None) -> DataFrame:
        found = self.state(name, generation)
        if found.number < 0:
            raise ValueError(f"there is no table {name}")
        return self._read(name, found.schema, found.versions)

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def read_or_empty(self, name: str, schema: str) -> DataFrame:
        return self.read(name) if self.exists(name) else self.spark.createDataFrame([], schema)

    def read_batch(self, name: str, batch: dict[str, str]) -> DataFrame | None:
        """The rows of one batch, without a look at those of others; None if it was never written."""
        found, part = self.state(name), _batch_part(batch)
        return self._read(name, found.schema, {part: found.versions[part]}) if part in found.versions else None

    def register(self, name: str) -> None:
        """The table's current generation under its name in Spark SQL."""
        self.read(name).createOrReplaceTempView(name)

    def _commit(self, name: str, g: int, layout: str, schema: T.StructType, versions: dict[str, int]) -> int:
        pointer = literal_table(self.spark, [(layout, schema.json(), list(versions.items()))], "layout string, columns string, versions map<string,int>")
        pointer.coalesce(1).write.mode("overwrite").json(f"{self.root}/{name}/_pointer/generation={g}")
        return g

    def _write(self, name: str, g: int, df: DataFrame, part: str) -> dict[str, int]:
        save(df, f"{self.root}/{name}/g={g}/_part={part}", mode="overwrite")
        return {part: g}

    def _write_parts(self, name: str, g: int, df: DataFrame, part: Column) -> dict[str, int]:
        """Rows with the part that each belongs to, in files of even size; which parts there are is read off the paths."""
        path = f"{self.root}/{name}/g={g}"
        save(df.withColumn("_part", part).hint("rebalance", "_part"), path, mode="overwrite", parts="_part", partitionOverwriteMode="static")
        files = self.spark.read.schema(df.schema).parquet(path).inputFiles()
        return {x[1]: g for f in files if (x := re.search(r"/_part=([^/]+)/", f))}

    # --- writes

    def overwrite(self, name: str, df: DataFrame) -> int:
        """The whole table anew, as one part."""
        g = self.generation(name) + 1
        return self._commit(name, g, "", df.schema, self._write(name, g, df, "all"))

    def _with_part(self, name: str, df: DataFrame, part: str, layout: str) -> int:
        old = self.state(name)
        g = old.number + 1
        schema = df.schema if old.schema is None else self.spark.createDataFrame([], old.schema).unionByName(self.spark.createDataFrame([], df.schema), allowMissingColumns=True).schema
        return self._commit(name, g, layout, schema, old.versions | self._write(name, g, df, part))

    def append(self, name: str, df: DataFrame) -> int:
        """Rows added, as a part of their own."""
        return self._with_part(name, df, f"a{self.generation(name) + 1}", "append")

    def replace_batch(self, name: str, df: DataFrame, batch: dict[str, str]) -> int:
        """Rows of one batch, which the columns ``batch`` name; writing the batch again replaces it, and no other batch is
        touched."""
        return self._with_part(name, df.withColumns({c: F.lit(v) for c, v in batch.items()}), _batch_part(batch), "batch")

    def keep_up(self, name: str, source: str, make: Callable[[DataFrame, str], DataFrame]) -> int:
        """A table that follows another one part by part. ``make`` gets rows and the name of a column that says which part they
        are of, and has to keep that column. Parts of the source that were written since the last call are made anew, those
        that are gone go, and of all others nothing is read. A part is known by the write that made it, so a call that broke
        off, here or before, can be repeated."""
        old, base = self.state(name), self.state(source)
        parts = {f"{p}-{v}": (p, v) for p, v in base.versions.items()}
        kept = {k: v for k, v in old.versions.items() if k in parts}
        if len(kept) == len(old.versions) == len(parts) and old.number >= 0:
            return old.number
        written_since = self._read(source, base.schema, dict(x for k, x in parts.items() if k not in kept))
        if len(kept) < len(parts):
            path = F.col("_metadata.file_path")
            of = F.concat_ws("-", F.regexp_extract(path, "/_part=([^/]+)/", 1), F.regexp_extract(path, "/g=([0-9]+)/_part=", 1))
        else:
            of = F.lit("")  # no rows
        rows, g = make(written_since.withColumn("_of", of), "_of"), old.number + 1
        return self._commit(name, g, f"parts of {source}", rows.schema, kept | self._write_parts(name, g, rows, F.col("_of")))

    def vacuum(self, *names: str, keep: int = 1) -> None:
        """Of these tables the latest ``keep`` generations stay; earlier ones can't be read any more, and the files that only they
        refer to are deleted. Pointers go first, so none is left that names a deleted file."""
        for name in names:
            numbers = sorted(self._pointer_files(name))
            if len(numbers) > keep > 0:
                at = {g: {f"g={v}/_part={p}" for p, v in self.state(name, g).versions.items()} for g in numbers}
                for g in numbers[:-keep]:
                    remove(self.spark, f"{self.root}/{name}/_pointer/generation={g}")
                for path in set().union(*[at[g] for g in numbers[:-keep]]) - set().union(*[at[g] for g in numbers[-keep:]]):
                    remove(self.spark, f"{self.root}/{name}/{path}")

    def append_bronze(self, name: str, df: DataFrame, ingest_date: str, batch_id: str) -> int:
        """All columns as text, with the day and the batch, so that a replay adds nothing."""
        return self.replace_batch(name, as_strings(df), {"ingest_date": ingest_date, "batch_id": batch_id})

    def _keyed(self, name: str, old: Generation, keys: list[str], partition: str | None) -> tuple[str, Column]:
        """How a table with these keys is cut, and the part of a row."""
        if partition is not None:
            return f"by {partition}", F.lower(F.hex(F.xxhash64(F.col(partition).cast("string"))))
        wanted = f"hash of {', '.join(keys)} in "
        n = int(old.layout.removeprefix(wanted)) if old.layout.startswith(wanted) else self.buckets
        return f"{wanted}{n}", F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n)).cast("string")

    def touched(self, name: str, source: DataFrame, keys: list[str], partition: str | None = None) -> tuple[Generation, DataFrame, dict[str, int]]:
        """(state, rows, other parts) of the table: the rows of the parts that hold the source's keys, all rows if the table is cut
        otherwise. Nothing else of the table is read."""
        old = self.state(name)
        layout, part = self._keyed(name, old, keys, partition)
        if old.layout != layout:
            return old, self._read(name, old.schema, old.versions), {}
        hit = {r[0] for r in source.select(part).distinct().collect()}  # a row for each part of the table at most
        return old, self._read(name, old.schema, {p: v for p, v in old.versions.items() if p in hit}), {p: v for p, v in old.versions.items() if p not in hit}

    def _distinct(self, source: DataFrame, keys: list[str]) -> None:
        with no_shuffle_left(source.sparkSession):
            if repeated_keys(source, keys).limit(1).count():
                raise ValueError(f"several source rows have the same {keys}")

    def upsert(self, name: str, source: DataFrame, keys: list[str], keep: list[str] = (), null_safe: bool = False, sequence: str | None = None, partition: str | None = None, where: str | None = None) -> int:
        """The source's rows merged in on their keys (:func:`merge_upsert`); only parts that hold keys of the source are read and
        written. The source is evaluated once. Of the merged rows only those that meet ``where`` stay, so a source row that does
        not takes its key out of the table."""
        exists = self.exists(name)
        if not exists and where is None:  # what is written is looked through before it is committed, and nothing is written twice
            layout, part = self._keyed(name, Generation(), keys, partition)
            versions = self._write_parts(name, 0, source, part)
            self._distinct(self._read(name, source.schema, versions), keys)
            return self._commit(name, 0, layout, source.schema, versions)
        source = written(source)
        self._distinct(source, keys)
        if exists:
            old, target, others = self.touched(name, source, keys, partition)
            rows, g = merge_upsert(target, source, keys, keep, null_safe, sequence), old.number + 1
        else:
            old, rows, others, g = Generation(), source, {}, 0
        rows = rows if where is None else rows.filter(where)
        layout, part = self._keyed(name, old, keys, partition)
        return self._commit(name, g, layout, rows.schema, others | self._write_parts(name, g, rows, part))

    def upsert_partitions(self, name: str, source: DataFrame, keys: list[str], partition: str, where: str | None = None) -> int:
        """An upsert within the values of a column: a snapshot of the same day replaces its places, a new day is added. Days
        that the source has no rows of keep their files."""
        return self.upsert(name, source, [*keys, partition], partition=partition, where=where)

    def upsert_fact(self, name: str, fact: DataFrame, key: str) -> int:
        """Facts merged on their stable key; a fact that is there already keeps when it was created."""
        return self.upsert(name, fact, [key], keep=["created_at"] if "created_at" in fact.columns else [])


def _batch_part(batch: dict[str, str]) -> str:
    return "b" + hashlib.md5("|".join(f"{len(v)}:{v}" for v in batch.values()).encode()).hexdigest()


def as_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """A report for readers outside Spark."""
    df.write.mode("overwrite").json(path)


def write_snapshot(df: DataFrame, root: str, stamp: str) -> str:
    """A raw snapshot in a folder named by its time."""
    path = f"{root}/snapshot_ts={stamp}"
    df.write.mode("errorifexists").json(path)
    return path
