"""Requests to a label service by an injected transport: lookups, histories, current documents and archived versions.

A transport is a picklable function of (url, accept) that returns a ``Response``; it runs on the executors, one request
per row, and a failed request is a row with an error. Nothing here goes to a network unless a deployment passes
``http_get``.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.functions import identity
from labeldiff.sources.files import sole_members
from labeldiff.values import PAGE_SIZE, TIMEOUT

FETCHED = "status int, final_url string, headers map<string,string>, body binary, error string"


class Response(NamedTuple):
    status: int
    url: str
    headers: dict[str, str]
    body: bytes


Transport = Callable[[str, str], Response]


def http_get(url: str, accept: str) -> Response:
    """Over HTTP; a status other than 2xx is an error."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"Accept": accept, "User-Agent": "labeldiff"}), timeout=TIMEOUT) as r:
        return Response(r.status, r.url, dict(r.headers.items()), r.read())


class Recorded:
    """A transport that answers from recorded responses by URL; anything else is not found."""

    def __init__(self, responses: dict[str, bytes]):
        self.responses = responses

    def __call__(self, url: str, accept: str) -> Response:
        if url not in self.responses:
            raise LookupError(f"404 {url}")
        return Response(200, url, {"content-type": accept}, self.responses[url])


def sent(requests: DataFrame, transport: Transport) -> DataFrame:
    """requests (url, accept and any other columns) with the response to each, its hash, and the error of those that failed or were empty."""
    names = [*requests.columns, "status", "final_url", "headers", "body", "error"]
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    kinds = [pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string()]

    def one(url: str, accept: str) -> tuple:
        try:
            r = transport(url, accept)
        except Exception as e:  # whatever a transport raises is the row's error
            return None, url, None, None, f"{type(e).__name__}: {e}"
        if not 200 <= r.status < 300:
            return r.status, r.url, list(r.headers.items()), None, f"status {r.status}"
        return r.status, r.url, list(r.headers.items()), r.body, None if r.body else "empty response"

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                got = one(batch["url"][k].as_py(), batch["accept"][k].as_py())
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, *(pa.array([v], t) for v, t in zip(got, kinds, strict=True))], names=names)

    return requests.mapInArrow(run, f"{own}, {FETCHED}").withColumn("raw_sha256", identity.sha256(F.col("body")))


def lookup_url(base: str, name: Column) -> Column:
    return F.concat(F.lit(f"{base}/spls.json?drug_name="), F.url_encode(F.trim(name)), F.lit(f"&page=1&pagesize={PAGE_SIZE}"))


def history_url(base: str, set_id: Column) -> Column:
    return F.concat(F.lit(f"{base}/spls/"), F.url_encode(F.trim(set_id)), F.lit("/history.json"))


def document_url(base: str, set_id: Column) -> Column:
    return F.concat(F.lit(f"{base}/spls/"), F.url_encode(set_id), F.lit(".xml"))


def archive_url(base: str, set_id: Column, version: Column) -> Column:
    return F.concat(F.lit(f"{base}/getFile.cfm?type=zip&setid="), F.url_encode(set_id), F.lit("&version="), F.url_encode(version))


def lookups(names: DataFrame, base: str, transport: Transport) -> DataFrame:
    """names (lookup_id) to (lookup_id, source_url, body as text, raw_sha256, error). A blank name is an error without a request."""
    asked = names.select("lookup_id").distinct().withColumns({"url": lookup_url(base, F.col("lookup_id")), "accept": F.lit("application/json")})
    blank = F.trim("lookup_id") == ""
    got = sent(asked.where(~blank), transport)
    whole = got.select("lookup_id", F.col("final_url").alias("source_url"), F.col("body").cast("string").alias("body"), "raw_sha256", "error")
    none = asked.where(blank).select("lookup_id", F.lit(None).cast("string").alias("source_url"), F.lit(None).cast("string").alias("body"), F.lit(None).cast("string").alias("raw_sha256"), F.lit("blank name").alias("error"))
    return whole.unionByName(none)


def histories(sets: DataFrame, base: str, transport: Transport) -> DataFrame:
    """sets (set_id) to (lookup_id, set_id, source_url, body, error); ``files.history`` reads them."""
    asked = sets.select("set_id").distinct().withColumns({"url": history_url(base, F.col("set_id")), "accept": F.lit("application/json")})
    return sent(asked, transport).select(F.col("set_id").alias("lookup_id"), "set_id", F.col("final_url").alias("source_url"), F.col("body").cast("string").alias("body"), "error")


def documents(chosen: DataFrame, base: str, transport: Transport) -> DataFrame:
    """chosen (set_id, version and any other columns) with the current document of each: content, raw_sha256, status, headers, source_url, error."""
    asked = chosen.withColumns({"url": document_url(base, F.col("set_id")), "accept": F.lit("application/xml")})
    return sent(asked, transport).drop("url", "accept").withColumnsRenamed({"body": "content", "final_url": "source_url"}).withColumns({"container": F.lit(None).cast("binary"), "member": F.lit(None).cast("string")})


def archived(chosen: DataFrame, known: DataFrame, base: str, transport: Transport) -> DataFrame:
    """chosen (set_id, version) with the archived document of each. Versions that the history (known: set_id, version) lacks are errors without a request; the archive is kept beside its sole XML member."""
    there = known.select("set_id", "version").distinct()
    asked = chosen.join(there, ["set_id", "version"], "left_semi").withColumns({"url": archive_url(base, F.col("set_id"), F.col("version")), "accept": F.lit("application/zip")})
    got = sent(asked, transport).drop("url", "accept").withColumnRenamed("body", "container")
    got = sole_members(got, "container").withColumn("error", F.coalesce("error", "member_error")).drop("member_error", "raw_sha256").withColumnRenamed("final_url", "source_url")
    got = got.withColumn("raw_sha256", identity.sha256(F.col("content")))
    absent = chosen.join(there, ["set_id", "version"], "left_anti").withColumn("error", F.lit("the history has no such version"))
    return got.unionByName(absent, allowMissingColumns=True)
