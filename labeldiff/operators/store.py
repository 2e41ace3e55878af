"""Append-only store on Parquet: idempotent inserts, conflicts, state logs, constraints, commit markers.

Parquet has no MERGE, so an update is an event and the current state is the latest event. A write goes to a staging
folder and counts only when its commit marker is there: readers list markers, not folders. A single writer is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labeldiff.operators.relational import latest
from labeldiff.scratch import held


def compared(existing: DataFrame, incoming: DataFrame, key: Sequence[str], content: str) -> DataFrame:
    """Keys of either side with what an insert would do: NEW, SAME, CONFLICT, or KEPT (only in the store)."""
    old, new = existing.select(*key, F.col(content).alias("_old")), incoming.select(*key, F.col(content).alias("_new"))
    both = old.join(new, list(key), "full_outer")
    outcome = F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "KEPT").when(F.col("_old") == F.col("_new"), "SAME").otherwise("CONFLICT")
    return both.select(*key, outcome.alias("outcome"))


class Refused(Exception):
    """A commit that would change what is stored or refer to nothing; ``rows`` are the first of what is wrong."""

    def __init__(self, why: str, rows: list):
        super().__init__(f"{why}: " + "; ".join(f"{r['table']} {r['key']}" for r in rows))
        self.rows = rows


def text_of(columns: Sequence[str]) -> Column:
    """One text of a key; null if any of its columns is."""
    return F.concat(*[F.col(c).cast("string") if k == 0 else F.concat(F.lit("|"), F.col(c).cast("string")) for k, c in enumerate(columns)])


def contents(rows: DataFrame, name: str, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(table, key, digest) of each row."""
    whole = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.select(F.lit(name).alias("table"), text_of(key).alias("key"), F.sha2(whole, 256).alias("digest"))


def conflicting(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """(table, key) of incoming contents that differ from what is stored under their key, or from each other. Only keys that come in are looked up."""
    new = incoming.groupBy("table", "key").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    changed = existing.withColumnRenamed("digest", "old").join(new, ["table", "key"]).where(F.col("old") != F.col("low"))
    return changed.select("table", "key").union(new.where(F.col("low") != F.col("high")).select("table", "key")).distinct()


def dangling(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """Rows of wanted (table, other, key) whose (other, key) is not in there. The keys that are wanted are few beside those that are there, so those are narrowed first."""
    asked = wanted.where("key IS NOT NULL").distinct()
    found = there.join(asked.select("other", "key").distinct(), ["other", "key"], "left_semi").distinct()
    return asked.join(found, ["other", "key"], "left_anti").select("table", "other", "key")


def fresh_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """INSERT OR IGNORE: incoming rows whose key is new; of rows that share a key, the first by all columns."""
    first = incoming.groupBy(*key).agg(F.min(F.struct(*[c for c in incoming.columns if c not in key])).alias("_row"))
    return first.join(existing.select(*key), list(key), "left_anti").select(*key, "_row.*").select(*incoming.columns)


def violations(rows: DataFrame, name: str, unique: Sequence[Sequence[str]] = (), checks: Mapping[str, Column] | None = None, references: Mapping[str, tuple[Sequence[str], DataFrame, Sequence[str]]] | None = None) -> DataFrame:
    """(table, rule, key, n): every broken UNIQUE, CHECK and FOREIGN KEY rule of a table."""
    text = lambda cols: F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    found = [rows.groupBy(*u).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(f"unique({','.join(u)})").alias("rule"), text(u).alias("key"), "n") for u in unique]
    found += [rows.where(~F.coalesce(ok, F.lit(True))).groupBy().agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit(rule).alias("rule"), F.lit(None).cast("string").alias("key"), "n") for rule, ok in (checks or {}).items()]
    for rule, (cols, other, theirs) in (references or {}).items():
        there = other.select(*[F.col(t).alias(c) for c, t in zip(cols, theirs, strict=True)]).distinct()
        missing = rows.where(F.lit(True) if not cols else F.col(cols[0]).isNotNull()).join(there, list(cols), "left_anti")
        found.append(missing.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), text(cols).alias("key"), "n"))
    whole = found[0]
    for x in found[1:]:
        whole = whole.unionByName(x)
    return whole.select(F.lit(name).alias("table"), "rule", "key", F.col("n").cast("long").alias("n"))


#: A commit's marker: its name, its place, and the tables that it wrote.
MARKER = "commit string, at long, tables array<string>"


class Store:
    """Named tables under one folder. Every commit is a folder of part tables plus a marker row; a table is the union of its committed parts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.seen = spark, path.rstrip("/"), None

    def mark(self, name: str, order: int, tables: Sequence[str], folder: str) -> None:
        self.spark.createDataFrame([(name, order, list(tables))], MARKER).coalesce(1).write.mode("append").json(f"{self.path}/{folder}")

    def file_system(self, path: str):
        context = self.spark.sparkContext
        p = context._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(context._jsc.hadoopConfiguration()), p

    def markers(self) -> list:
        """Rows (commit, tables) of the commits in order, read again when the folder of markers has changed. Only a store without any is empty; markers that cannot be read are an error."""
        fs, p = self.file_system(f"{self.path}/_commits")
        if not fs.exists(p):
            return []
        state = (fs.getFileStatus(p).getModificationTime(), fs.getContentSummary(p).getFileCount())
        if self.seen is None or self.seen[0] != state:
            rows = self.spark.read.schema(MARKER).option("mode", "FAILFAST").json(f"{self.path}/_commits").orderBy("at", "commit").collect()
            self.seen = (state, rows)
        return self.seen[1]

    def commits(self) -> list[str]:
        return [r["commit"] for r in self.markers()]

    def table(self, name: str, schema: str) -> DataFrame:
        """Committed rows. Markers tell which commits wrote the table, so nothing is listed."""
        paths = [f"{self.path}/{name}/{r['commit']}" for r in self.markers() if name in r["tables"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def exists(self, path: str) -> bool:
        fs, p = self.file_system(path)
        return fs.exists(p)

    def compact(self, schemas: Mapping[str, str]) -> None:
        """Replaces the commits of all tables by one. For the single writer; what readers have planned before must be planned anew."""
        old = self.commits()
        name = uuid.uuid4().hex
        for table, schema in schemas.items():
            self.table(table, schema).write.parquet(f"{self.path}/{table}/{name}")
        self.mark(name, 0, list(schemas), "_compacted")
        fs, p = self.file_system(f"{self.path}/_commits")
        fs.delete(p, True)
        fs.rename(self.file_system(f"{self.path}/_compacted")[1], p)
        self.seen = None
        for table in schemas:
            for c in old:
                fs.delete(self.file_system(f"{self.path}/{table}/{c}")[1], True)

    def commit(self, parts: Mapping[str, DataFrame], check: Callable[[Mapping[str, DataFrame]], None] | None = None) -> str:
        """Writes all parts, then the marker: all of them count or none does. ``check`` sees the written parts before they count; what it raises leaves the store as it was."""
        name = uuid.uuid4().hex
        try:
            for table, rows in parts.items():
                rows.write.parquet(f"{self.path}/{table}/{name}")
            if check:
                check({table: self.spark.read.schema(rows.schema).parquet(f"{self.path}/{table}/{name}") for table, rows in parts.items()})
        except Exception:
            for table in parts:
                fs, p = self.file_system(f"{self.path}/{table}/{name}")
                fs.delete(p, True)
            raise
        self.mark(name, len(self.markers()), list(parts), "_commits")
        return name

    def insert(self, name: str, rows: DataFrame, schema: str, key: Sequence[str], content: str | None = None) -> DataFrame:
        """Idempotent insert. Returns the outcome per key; with ``content``, keys whose content differs are conflicts and nothing is written."""
        existing = self.table(name, schema)
        outcome = compared(existing, rows, key, content or key[0]).where("outcome <> 'KEPT'")
        if content and not outcome.where("outcome = 'CONFLICT'").isEmpty():
            return outcome
        # Held, since the insert below changes what a later evaluation would see.
        outcome = held(outcome, "outcomes", f"{self.path}/_scratch")
        self.commit({name: fresh_rows(existing, rows, key)})
        return outcome


def current(log: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The latest state of each key of an event log."""
    return latest(log, keys, order, values)
