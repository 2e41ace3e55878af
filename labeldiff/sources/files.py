"""Raw files, archives, lookups, histories and ranked lists as DataFrames; an offline data source for recorded responses."""

from __future__ import annotations

import hashlib
import io
import json
import os
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from labeldiff.functions import identity, text
from labeldiff.values import ALIASES, MAX_BYTES

CANDIDATE = "struct<setid:string,spl_version:string,title:string,published_date:string>"


def raw_files(spark: SparkSession, root: str, pattern: str = "*.xml") -> DataFrame:
    """Files under root with path, bytes, length and hash, and the two folder names above each (set id, version)."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return rows.select("path", "content", "length", identity.sha256(F.col("content")).alias("raw_sha256"), F.regexp_extract("path", r"([^/]+)/([^/]+)/[^/]+$", 1).alias("set_id"), F.regexp_extract("path", r"([^/]+)/([^/]+)/[^/]+$", 2).alias("version"))


def sole_xml(content: bytes | None) -> tuple[str | None, bytes | None, str | None]:
    """(name, bytes, error) of the only XML member of a ZIP archive: no absolute path, no way up, bounded, of the length it states."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as archive:
            members = [m for m in archive.infolist() if m.filename.lower().endswith(".xml") and not m.is_dir()]
            if len(members) != 1:
                return None, None, f"{len(members)} XML members"
            m = members[0]
            if m.filename.startswith(("/", "\\")) or ".." in m.filename.replace("\\", "/").split("/"):
                return None, None, "unsafe member path"
            if m.file_size > MAX_BYTES:
                return None, None, "member exceeds the size limit"
            body = archive.read(m)
            return (m.filename, body, None) if len(body) == m.file_size else (None, None, "member length differs")
    except (zipfile.BadZipFile, RuntimeError, OSError, ValueError) as e:
        return None, None, f"not a readable archive: {type(e).__name__}"


def sole_members(rows: DataFrame, column: str) -> DataFrame:
    """rows with ``member``, ``content`` and ``member_error`` of the archive in a column; a null archive gives nulls. Archives pass one at a time."""
    names = [*rows.columns, "member", "content", "member_error"]
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    kinds = (pa.string(), pa.binary(), pa.string())

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                body = batch[column][k].as_py()
                got = (None, None, None) if body is None else sole_xml(body)
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, *(pa.array([v], t) for v, t in zip(got, kinds, strict=True))], names=names)

    return rows.mapInArrow(run, f"{own}, member string, content binary, member_error string")


def candidates(responses: DataFrame) -> DataFrame:
    """responses (lookup_id, body: JSON text) to one row per record, with its index, metadata as a variant, and what is wrong with it (null if nothing)."""
    data = F.try_variant_get(F.try_parse_json("body"), "$.data", "array<variant>")
    rows = responses.withColumn("raw_sha256", identity.sha256(F.col("body"))).select("lookup_id", "raw_sha256", "body", F.posexplode_outer(data).alias("index", "meta"))
    kind = lambda f: F.schema_of_variant(F.try_variant_get("meta", f"$.{f}", "variant"))
    get = lambda f: F.nullif(F.trim(F.try_variant_get("meta", f"$.{f}", "string")), F.lit(""))
    string = lambda f: F.when(kind(f) == "STRING", get(f))
    version = F.when(kind("spl_version").isin("STRING", "BIGINT"), get("spl_version"))
    rows = rows.where("meta IS NOT NULL").select("lookup_id", "raw_sha256", "index", "meta", string("setid").alias("set_id"), version.alias("version"), string("title").alias("title"), string("published_date").alias("published"))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("set_id", "version", "title", "published")]))
    fields = {name: text.first_text(F.col("meta"), names) for name, names in ALIASES.items()}
    return rows.withColumns(fields).withColumn("active", names_of("meta", "active_ingredients", "active_ingredient")).withColumn("repackaged", (kind("repackaged") == "BOOLEAN") & F.try_variant_get("meta", "$.repackaged", "boolean")).withColumn("metadata_sha256", identity.sha256(F.to_json("meta"))).withColumn("invalid", F.when(F.size(missing) > 0, F.array_join(missing, ",")))


def lookup_problems(responses: DataFrame) -> DataFrame:
    """(lookup_id, problem) of every response: no JSON object, no list of records, or a record that lacks a field, any of which fails the whole lookup; else null."""
    body = F.try_parse_json("body")
    listed = F.try_variant_get(body, "$.data", "array<variant>")
    whole = F.when(F.coalesce(~F.startswith(F.schema_of_variant(body), F.lit("OBJECT")), F.lit(True)), "the response is not a JSON object").when(listed.isNull(), "the response has no list of records")
    bad = candidates(responses).where("invalid IS NOT NULL").groupBy("lookup_id").agg(F.min(F.struct("index", "invalid")).alias("b"))
    record = F.concat(F.lit("record "), F.col("b.index").cast("string"), F.lit(" lacks "), F.col("b.invalid"))
    return responses.select("lookup_id", whole.alias("_w")).join(bad, "lookup_id", "left").select("lookup_id", F.coalesce("_w", record).alias("problem"))


def names_of(meta: str, field: str, other: str):
    """Names in a field that is a string, or a list of strings and objects with a name; ``other`` is read only where the field is absent."""

    def one(f):
        value = F.try_variant_get(meta, f"$.{f}", "variant")
        single = F.when(F.schema_of_variant(value) == "STRING", F.array(F.try_variant_get(meta, f"$.{f}", "string")))
        many = F.transform(F.try_variant_get(meta, f"$.{f}", "array<variant>"), lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.try_variant_get(v, "$.name", "string")))
        found = F.transform(F.coalesce(single, many, F.array().cast("array<string>")), lambda s: F.trim(s))
        return value, F.filter(found, lambda s: s.isNotNull() & (s != ""))

    (first, a), (_, b) = one(field), one(other)
    return F.when(first.isNotNull(), a).otherwise(b)


def truncated(responses: DataFrame) -> DataFrame:
    """(lookup_id, truncated): whether a response states more elements than it has."""
    body = F.try_parse_json("body")
    stated = F.when(F.schema_of_variant(F.try_variant_get(body, "$.metadata.total_elements", "variant")) != "BOOLEAN", F.try_variant_get(body, "$.metadata.total_elements", "string").try_cast("long"))
    return responses.select("lookup_id", F.coalesce(stated > F.size(F.try_variant_get(body, "$.data", "array<variant>")), F.lit(False)).alias("truncated"))


def history(responses: DataFrame) -> DataFrame:
    """responses (lookup_id, set_id, body) to history entries, newest first (position 0), with date and what is wrong with the response."""
    body = F.try_parse_json("body")
    items = F.try_variant_get(body, "$.data.history", "array<struct<spl_version:string,published_date:string>>")
    stated = F.try_variant_get(body, "$.data.spl.setid", "string")
    rows = responses.withColumn("raw_sha256", identity.sha256(F.col("body"))).withColumn("_i", items).withColumn("wrong", F.when(F.col("_i").isNull() | (F.size("_i") == 0), "no history").when(F.exists("_i", lambda x: F.coalesce(F.trim(x["spl_version"]), F.lit("")) == ""), "entry without version").when(F.exists("_i", lambda x: text.strict_date(x["published_date"]).isNull()), "entry without date").when(~(F.lower(stated) == F.lower("set_id")), "other set id").when(F.size(F.array_distinct(F.transform("_i", lambda x: x["spl_version"]))) < F.size("_i"), "repeated version"))
    return rows.select("lookup_id", "set_id", "raw_sha256", "wrong", F.posexplode_outer("_i").alias("position", "_e")).select("lookup_id", "set_id", "raw_sha256", "wrong", "position", F.col("_e.spl_version").alias("version"), text.strict_date(F.col("_e.published_date")).alias("published"), F.col("_e.published_date").alias("published_text"))


RANKED = "utilization_list_id string, schema_version string, jurisdiction string, measurement_year string, dataset_name string, dataset_version string, metric string, retrieved_at string, source_reference string, source_status string, license_or_terms_status string, notes string, entries array<struct<rank:string,ingredient_name:string,metric_value:string,metric_unit:string,source_row_identifier:string>>"


def ranked_lists(spark: SparkSession, path: str) -> DataFrame:
    """Ranked lists, one JSON object per file, with their entries as rows and the normalized name."""
    lists = spark.read.schema(RANKED).option("multiLine", "true").json(path)
    rows = lists.select("*", F.inline("entries")).drop("entries")
    return rows.withColumn("rank_text", F.col("rank")).withColumn("rank", F.col("rank").try_cast("int")).withColumn("normalized", text.normalized_name(F.col("ingredient_name")))


def list_problems(entries: DataFrame) -> DataFrame:
    """(utilization_list_id, problem, n): what is wrong with ranked lists; no rows if nothing."""
    key = "utilization_list_id"
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    checks = {
        **{f"{c} is missing": blank(c) for c in ("utilization_list_id", "schema_version", "jurisdiction", "dataset_name", "dataset_version", "metric", "source_reference", "source_status")},
        "a boolean stands for a number": F.col("rank_text").isin("true", "false") | F.col("measurement_year").isin("true", "false"),
        "rank is not a positive number": F.col("rank").isNull() | (F.col("rank") < 1),
        "name is missing": F.col("normalized").isNull() | (F.col("normalized") == ""),
        "metric is not a number": F.col("metric_value").isNotNull() & F.col("metric_value").try_cast("double").isNull(),
        "year is not a number": F.col("measurement_year").try_cast("int").isNull(),
    }
    single = entries.select(key, F.explode(F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]))).alias("problem")).groupBy(key, "problem").agg(F.count(F.lit(1)).alias("n"))
    whole = entries.groupBy(key).agg(F.count(F.lit(1)).alias("c"), F.count_distinct("rank").alias("r"), F.count_distinct("normalized").alias("d"), F.min("rank").alias("low"), F.max("rank").alias("high"))
    rules = {"repeated rank": F.col("r") < F.col("c"), "repeated name": F.col("d") < F.col("c"), "ranks are not contiguous from 1": ~((F.col("low") == 1) & (F.col("high") == F.col("c")))}
    grouped = whole.select(key, F.explode(F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))).alias("problem"), F.lit(1).cast("long").alias("n"))
    return single.unionByName(grouped)


def write_once(path: str, content: bytes) -> bool:
    """Creates a file whole or not at all. False if it is there with the same bytes; an error if it has others. For the driver's local store."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "xb") as f:
        f.write(content)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(part, path)
        return True
    except FileExistsError:
        with open(path, "rb") as f:
            if f.read() != content:
                raise ValueError(f"raw_hash_conflict: {path} holds other bytes") from None
        return False
    finally:
        os.unlink(part)


#: What the identity in a manifest must have, and the form of its hash.
IDENTITY = ("authority", "provider", "jurisdiction", "source_document_id", "source_version", "retrieved_at", "raw_sha256")


def manifest(identity_of: dict[str, Column], lookup: dict[str, Column], selection: dict[str, Column], history: dict[str, Column], retrieval: dict[str, Column]) -> Column:
    """Provenance of a raw document as canonical JSON: identity, the evidence for its choice with exact bodies (base64), retrieval."""
    return identity.canonical(
        manifest_version=F.lit("raw-manifest/1.0.0"), source_identity=identity.fields(**identity_of), lookup=identity.fields(**lookup),
        selection=identity.fields(**selection), history=identity.fields(**history), retrieval=identity.fields(**retrieval),
    )


def manifests(rows: DataFrame, column: str = "manifest") -> DataFrame:
    """rows with ``identity`` (the identity a manifest states) and ``manifest_error``: no JSON object, a missing field, a hash that is none."""
    kind = F.schema_of_variant(F.try_parse_json(column))
    got = F.from_json(F.get_json_object(column, "$.source_identity"), ", ".join(f"{f} string" for f in IDENTITY))
    rows = rows.withColumn("identity", got)
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(F.col(f"identity.{f}"), F.lit("")) == "", F.lit(f)) for f in IDENTITY])), ",")
    error = F.when(F.coalesce(~F.startswith(kind, F.lit("OBJECT")), F.lit(True)), "not a JSON object").when(F.col("identity").isNull() | (missing != ""), F.concat(F.lit("missing: "), F.coalesce(missing, F.lit("source_identity")))).when(~F.rlike("identity.raw_sha256", F.lit("^[0-9a-f]{64}$")), "malformed hash")
    return rows.withColumn("manifest_error", error)


def resolved(raw: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (set_id, and version or null for the only one there is) to its raw row (set_id, version, raw_sha256, content, manifest) and ``error``: not found, several versions, unsafe names, a manifest or hash that does not agree."""
    have = raw.withColumn("_s", F.lower("set_id"))
    want = asked.select(F.lower("set_id").alias("_s"), F.col("set_id").alias("asked_set"), F.col("version").alias("asked_version"))
    n = have.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"), F.min("version").alias("_only"))
    want = want.join(n, "_s", "left").withColumn("_v", F.coalesce("asked_version", F.when(F.col("_n") == 1, F.col("_only"))))
    rows = manifests(want.join(have.withColumnRenamed("version", "_v"), ["_s", "_v"], "left"))
    safe = text.safe_segment(F.col("asked_set")) & F.coalesce(text.safe_segment(F.col("asked_version")), F.lit(True))
    digest = identity.sha256(F.col("content"))
    error = (
        F.when(~safe, "unsafe name")
        .when(F.col("_n").isNull(), "source_not_found")
        .when(F.col("_v").isNull(), "several versions")
        .when(F.col("raw_sha256").isNull(), "source_not_found")
        .when(F.col("manifest_error").isNotNull(), F.col("manifest_error"))
        .when((F.lower("identity.source_document_id") != F.col("_s")) | (F.col("identity.source_version") != F.col("_v")) | (F.col("identity.raw_sha256") != F.col("raw_sha256")), "the manifest is another document's")
        .when(digest != F.col("raw_sha256"), "the bytes do not have the recorded hash")
    )
    return rows.select("asked_set", "asked_version", "set_id", F.col("_v").alias("version"), "raw_sha256", "content", "manifest", error.alias("error"))


class RecordedLookups(DataSource):
    """``spark.read.format("recorded_lookups").option("path", folder)``: recorded responses, one JSON file per lookup, as (lookup_id, body).

    Stands where a network client would: a deployment registers a source with the same columns that asks the service.
    """

    @classmethod
    def name(cls) -> str:
        return "recorded_lookups"

    def schema(self) -> str:
        return "lookup_id string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _RecordedReader(self.options["path"])


class _RecordedReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [InputPartition(n) for n in sorted(os.listdir(self.path)) if n.endswith(".json")]

    def read(self, partition):
        with open(os.path.join(self.path, partition.value), encoding="utf-8") as f:
            yield partition.value.removesuffix(".json"), f.read()
