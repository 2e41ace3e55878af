"""Document flows over the store: fetch, ingest, search, show, history, diff, verification. Each is one plan over all its documents; what several steps read is held as a table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labeldiff import scratch
from labeldiff.functions import identity, rules, text
from labeldiff.operators import batch, diff, lineage, matching, relational, structure, textdiff
from labeldiff.operators.store import Refused, Store, compared, conflicting, contents, dangling, fresh_rows, text_of, violations
from labeldiff.plans.tables import CONTENTS, REFERENCES, SCHEMA_VERSION, TABLES
from labeldiff.sources import fetch, files, xml_documents
from labeldiff.values import VERSIONS

NOT_YET = "1970-01-01T00:00:00Z"
ORIGIN = {"authority": "FDA", "provider": "DailyMed", "jurisdiction": "US"}
#: What must be known of a stored document's source.
PROVENANCE = ("authority", "provider", "jurisdiction", "set_id", "version", "retrieved_at", "raw_sha256", "path", "metadata_path")


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


class Flows:
    """The service: a session, a store, and the versions and origin that take part in ids."""

    def __init__(self, spark: SparkSession, path: str, versions: dict[str, str] = VERSIONS, origin: dict[str, str] = ORIGIN):
        self.spark, self.store, self.versions, self.origin = spark, Store(spark, path), versions, origin

    def table(self, name: str) -> DataFrame:
        return self.store.table(name, TABLES[name][0])

    def count(self, name: str) -> int:
        """Rows of a table of the store; other names are refused."""
        if name not in TABLES:
            raise ValueError(f"no table {name}")
        return self.table(name).count()

    def hold(self, rows: DataFrame) -> DataFrame:
        return scratch.held(rows, "flow", f"{self.store.path}/_scratch")

    def fitted(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.select(*self.spark.createDataFrame([], TABLES[name][0]).columns)

    def commit(self, **parts: DataFrame) -> None:
        """Inserts the rows whose key is new, all tables in one commit. Refused, with nothing written, if a key is stored with other content or a row would refer to nothing."""
        rows = {n: self.fitted(n, r) for n, r in parts.items()}
        fixed = [n for n in rows if n in CONTENTS]
        if fixed:
            side = lambda t: reduce(DataFrame.unionByName, (contents(t(n), n, TABLES[n][1], CONTENTS[n]) for n in fixed))
            self.refuse("another content is stored", conflicting(side(self.table), side(rows.get)))
        self.store.commit({n: fresh_rows(self.table(n), r, TABLES[n][1]) for n, r in rows.items()}, self.refer)

    def refer(self, staged: Mapping[str, DataFrame]) -> None:
        """Refuses parts whose rows refer to what is neither stored nor staged beside them: one anti join for all rules."""
        rules_ = [(n, *rule) for n in staged for rule in REFERENCES.get(n, [])]
        if not rules_:
            return
        wanted = reduce(DataFrame.unionByName, (staged[n].select(F.lit(n).alias("table"), F.lit(other).alias("other"), text_of(cols).alias("key")) for n, cols, other, _ in rules_))
        keys = {other: theirs for _, _, other, theirs in rules_}
        there = [t.select(F.lit(other).alias("other"), text_of(theirs).alias("key")) for other, theirs in keys.items() for t in (self.table(other), *([staged[other]] if other in staged else []))]
        self.refuse("nothing is stored", dangling(wanted, reduce(DataFrame.unionByName, there)))

    def refuse(self, why: str, found: DataFrame) -> None:
        first = found.orderBy("table", "key").limit(5).collect()
        if first:
            raise Refused(why, first)

    def migrate(self, moment: str = NOT_YET) -> int:
        """The store's schema version, after putting it to the newest: steps are commits, and one that is there is not repeated."""
        have = self.table("schema").agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
        if have > SCHEMA_VERSION:
            raise ValueError(f"the store has schema {have}, newer than {SCHEMA_VERSION}")
        for v in range(have + 1, SCHEMA_VERSION + 1):
            self.commit(schema=self.spark.range(1).select(F.lit(v).cast("int").alias("version"), at(moment).alias("at")))
        return SCHEMA_VERSION

    # Raw documents

    def lineage_of(self, set_id: Column) -> Column:
        return identity.lineage_id(*[F.lit(self.origin[k]) for k in ("authority", "provider", "jurisdiction")], set_id)

    def store_raw(self, got: DataFrame, moment: str = NOT_YET, lookups: DataFrame | None = None) -> DataFrame:
        """got (set_id, version, content, raw_sha256, status, headers, source_url, container, member, error): keeps new documents with their manifests, quarantines those whose identity is stored with other bytes. Returns (set_id, version, raw_sha256, state, error, quarantine_id)."""
        c = F.col
        got = self.hold(got.where(~(c("error").isNull() & c("content").isNull())).dropDuplicates(["set_id", "version"]))
        known = self.table("raw").select("set_id", "version", c("raw_sha256").alias("_old"))
        rows = got.join(known, ["set_id", "version"], "left")
        wrong = ~(text.safe_segment(c("set_id")) & text.safe_segment(c("version")))
        state = F.when(c("error").isNotNull() | wrong, "RAW_FETCH_FAILED").when(c("_old").isNull(), "FETCHED").when(c("_old") == c("raw_sha256"), "ALREADY_FETCHED").otherwise("RAW_HASH_CONFLICT")
        rows = rows.withColumn("state", state)
        if lookups is not None:
            seen = lookups.select(c("set_id").alias("_ls"), c("version").alias("_lv"), c("body").alias("_body"), c("source_url").alias("_url"), c("classes").alias("_classes"), c("status").alias("_status")).dropDuplicates(["_ls", "_lv"])
            rows = rows.join(seen, (c("set_id") == c("_ls")) & (c("version") == c("_lv")), "left")
        else:
            rows = rows.withColumns({"_body": F.lit(None).cast("string"), "_url": F.lit(None).cast("string"), "_classes": F.lit(None).cast("array<string>"), "_status": F.lit(None).cast("string")})
        latest = self.latest_history().groupBy("lineage_id").agg(F.any_value("body").alias("_history"), F.any_value("raw_sha256").alias("_history_sha"))
        rows = rows.withColumn("lineage_id", self.lineage_of(c("set_id"))).join(latest, "lineage_id", "left")
        own = {k: F.lit(v) for k, v in self.origin.items()} | {"source_document_id": c("set_id"), "source_version": c("version"), "retrieved_at": text.utc_text(at(moment)), "raw_sha256": c("raw_sha256"), "source_url": c("source_url")}
        encoded = lambda x: F.base64(x.cast("binary"))
        made = files.manifest(
            own, {"raw_body_base64": encoded(c("_body")), "raw_sha256": identity.sha256(c("_body")), "source_url": c("_url")}, {"classes": c("_classes"), "status": c("_status")},
            {"raw_body_base64": encoded(c("_history")), "raw_sha256": c("_history_sha")}, {"http_status": c("status"), "headers": F.to_json("headers"), "response_byte_length": F.octet_length(F.coalesce("container", "content")), "source_xml_sha256": c("raw_sha256"), "container_member": c("member"), "container_sha256": identity.sha256(c("container"))},
        )
        folder = F.concat_ws("/", F.lit(self.store.path), F.lit("raw"), "set_id", "version")
        kept = rows.where("state = 'FETCHED'").withColumns({"manifest": made, "path": F.concat(folder, F.lit("/label.xml")), "metadata_path": F.concat(folder, F.lit("/metadata.json")), "retrieved_at": at(moment), **{k: F.lit(v) for k, v in self.origin.items()}})
        clash = rows.where("state = 'RAW_HASH_CONFLICT'").withColumns({"path": F.concat(folder, F.lit("/label.xml")), "n_bytes": F.octet_length("content").cast("long"), "stage": F.lit("raw_storage"), "category": F.lit("raw_hash_conflict"), "message": F.lit("other bytes are stored for this version"), "quarantine_id": identity.quarantine_id(F.lit(""), c("set_id"), F.lit("raw_storage"), c("raw_sha256"))})
        report = self.hold(rows.select("set_id", "version", "raw_sha256", "state", F.when(wrong, "unsafe name").when(c("state") == "RAW_HASH_CONFLICT", "raw_hash_conflict").otherwise(c("error")).alias("error"), F.when(c("state") == "RAW_HASH_CONFLICT", identity.quarantine_id(F.lit(""), c("set_id"), F.lit("raw_storage"), c("raw_sha256"))).alias("quarantine_id")))
        self.commit(raw=kept, quarantine=clash)
        return report

    def fetch(self, chosen: DataFrame, base: str, transport: fetch.Transport, moment: str = NOT_YET, versions: bool = False) -> DataFrame:
        """Requests the documents chosen (set_id, version) and stores them; with ``versions``, as archived versions that the stored histories must list."""
        if versions:
            known = self.latest_history().withColumn("_l", F.col("lineage_id")).join(chosen.select("set_id").distinct().withColumn("_l", self.lineage_of(F.col("set_id"))), "_l").select("set_id", "version")
            return self.store_raw(fetch.archived(chosen, known, base, transport), moment)
        return self.store_raw(fetch.documents(chosen, base, transport), moment)

    def fetch_histories(self, sets: DataFrame, base: str, transport: fetch.Transport, moment: str = NOT_YET) -> DataFrame:
        """Requests and stores histories; returns (set_id, error) of those that failed."""
        got = self.hold(fetch.histories(sets, base, transport))
        wrong = self.add_history(got.where("error IS NULL"), moment)
        return got.where("error IS NOT NULL").select("set_id", "error").union(wrong)

    def export(self, root: str) -> int:
        """Writes the store's raw documents as files, each once, below a folder of this machine; returns how many are new."""
        new = 0
        for r in self.table("raw").select("set_id", "version", "content", "container", "manifest").toLocalIterator():
            parts = {"label.xml": r.content, "source.zip": r.container, "metadata.json": r.manifest.encode()}
            new += sum(files.write_once(f"{root}/{r.set_id}/{r.version}/{name}", bytes(body)) for name, body in parts.items() if body is not None)
        return new

    def resolved(self, asked: DataFrame) -> DataFrame:
        """asked (set_id, version or null) to raw documents or errors."""
        return files.resolved(self.table("raw"), asked)

    # Ingestion

    def ingest(self, raw: DataFrame, moment: str = NOT_YET) -> DataFrame:
        """raw: path, content; raw_sha256 if it was recorded, set_id and version if they were asked for. Commits new documents with their children, quarantines the rest, logs a run for each; returns counts by outcome."""
        outcome = self.ingested(raw, moment)
        return self.spark.createDataFrame(outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).orderBy("outcome").collect(), "outcome string, n long")

    def ingested(self, raw: DataFrame, moment: str = NOT_YET) -> DataFrame:
        """What ``ingest`` does, with one row per file: (path, raw_sha256, document_id, outcome, message)."""
        c = F.col
        # Before any work: a run that is killed leaves a start without an end, which ``recover`` closes.
        run = identity.named("ingestion-run", F.lit(uuid.uuid4().hex), c("path"))
        begun = raw.select("path", *[c(n) if n in raw.columns else F.lit(None).cast("string").alias(n) for n in ("raw_sha256",)]).dropDuplicates(["path"])
        begun = begun.withColumns({"run_id": run, "seq": F.lit(0).cast("long"), "state": F.lit("started"), "category": F.lit(None).cast("string"), "message": F.lit(None).cast("string"), "at": at(moment)})
        self.store.commit({"ingestion_events": self.fitted("ingestion_events", begun)})
        asked = ("set_id", "version") if {"set_id", "version"} <= set(raw.columns) else None
        parsed = self.hold(xml_documents.parsed(raw, "raw_sha256" if "raw_sha256" in raw.columns else None, asked))
        parts = xml_documents.children(parsed, versions=self.versions, **self.origin)
        known = self.table("documents")
        documents = self.hold(self.fitted("documents", parts["documents"].withColumns({"retrieved_at": at(moment), "parser_version": F.lit(self.versions["parser"]), "schema_version": F.lit(self.versions["schema"]), "mapping_version": F.lit(self.versions["mapping"])})))
        identities = known.select("set_id", "version", c("raw_sha256").alias("_known"))
        first = documents.groupBy("set_id", "version").agg(F.min("raw_sha256").alias("_known"))
        clash = documents.join(identities.union(first), ["set_id", "version"]).where("raw_sha256 <> _known").select("document_id").distinct()
        # Of files in one batch that claim one version with other bytes, all but the one with the smallest hash are conflicts.
        accepted = fresh_rows(known, documents.join(clash, "document_id", "left_anti"), ["document_id"])
        accepted = self.hold(accepted)
        commit = {"documents": accepted}
        for name in ("sections", "products", "ingredients", "mappings", "statuses"):
            commit[name] = self.fitted(name, parts[name]).join(accepted.select("document_id"), "document_id", "left_semi").dropDuplicates(TABLES[name][1])
        report = documents.select("path", "raw_sha256", "document_id").join(known.select("document_id").withColumn("_k", F.lit(1)), "document_id", "left").join(clash.withColumn("_c", F.lit(1)), "document_id", "left")
        # Of files that are the same document, the first is the one that is ingested.
        report = relational.numbered(report, ["document_id"], [c("path")], "_copy")
        report = report.select("path", "raw_sha256", "document_id", F.when(c("_c") == 1, "CONFLICT").when((c("_k") == 1) | (c("_copy") > 0), "ALREADY_INGESTED").otherwise("INGESTED").alias("outcome"), F.when(c("_c") == 1, "other bytes are stored for this version").alias("message"))
        report = self.hold(report.unionByName(parts["errors"].select("path", "raw_sha256", F.lit(None).cast("string").alias("document_id"), c("category").alias("outcome"), "message")))
        bad = report.where("outcome NOT IN ('INGESTED', 'ALREADY_INGESTED')").select("path", "raw_sha256", c("outcome").alias("category"), "message").dropDuplicates(["path", "raw_sha256"])
        bad = bad.join(raw.select("path", "content").dropDuplicates(["path"]), "path").withColumns({"n_bytes": F.octet_length("content").cast("long"), "stage": F.lit("ingest"), "quarantine_id": identity.quarantine_id(F.lit(""), c("path"), F.lit("ingest"), c("raw_sha256"))})
        commit["quarantine"] = fresh_rows(self.table("quarantine"), self.fitted("quarantine", bad), ["quarantine_id"])
        failed = ~c("outcome").isin("INGESTED", "ALREADY_INGESTED")
        events = report.groupBy("path").agg(F.max(F.struct(failed.cast("int").alias("f"), "outcome", "message", "raw_sha256")).alias("e")).select("path", "e.*").withColumn("run_id", run)
        ended = c("f") == 1
        commit["ingestion_events"] = self.fitted("ingestion_events", events.withColumns({"state": F.when(ended, "failed").otherwise("succeeded"), "seq": F.lit(1).cast("long"), "category": F.when(ended, c("outcome")), "message": F.when(ended, c("message")), "at": at(moment)}))
        self.store.commit(commit, self.refer)
        return report

    def recover(self, moment: str = NOT_YET) -> DataFrame:
        """Closes the runs that a lost job left open: a start without an end becomes a failure. For the single writer, before it starts work. Returns (run_id, path)."""
        log = self.table("ingestion_events")
        lost = batch.orphaned(log, ["run_id"], "state", ["started"], ["failed", "succeeded"])
        rows = self.hold(log.where("state = 'started'").join(lost, "run_id", "left_semi").withColumns({"seq": F.lit(1).cast("long"), "state": F.lit("failed"), "category": F.lit("interrupted"), "message": F.lit("the job ended before the run did"), "at": at(moment)}))
        self.commit(ingestion_events=rows)
        return rows.select("run_id", "path")

    def add_history(self, responses: DataFrame, moment: str) -> DataFrame:
        """responses: lookup_id, set_id, body. Good histories are stored once per exact body; returns (set_id, error) of the others."""
        rows = self.hold(files.history(responses).join(responses.select("lookup_id", "body"), "lookup_id"))
        good = rows.where("wrong IS NULL").withColumn("lineage_id", self.lineage_of(F.col("set_id")))
        good = good.withColumns({"snapshot_id": identity.snapshot_id(F.col("lineage_id"), F.col("raw_sha256")), "retrieved_at": at(moment)})
        self.commit(history=good)
        return rows.where("wrong IS NOT NULL").select("set_id", F.col("wrong").alias("error")).distinct()

    def latest_history(self) -> DataFrame:
        """Entries of the newest snapshot of each lineage."""
        rows = self.table("history")
        last = rows.groupBy("lineage_id").agg(F.max(F.struct("retrieved_at", "snapshot_id"))["snapshot_id"].alias("snapshot_id"))
        return rows.join(last, ["lineage_id", "snapshot_id"], "left_semi")

    # Reads

    def search(self, needle: str) -> DataFrame:
        """Documents whose generic name, brand, ingredient or title holds the needle, in order of name, set id, newest version."""
        d = self.table("documents")
        rows = d.join(self.table("products").select("document_id", "brand"), "document_id", "left").join(self.table("ingredients").select("document_id", F.col("name").alias("ingredient")), "document_id", "left")
        found = relational.search(rows, needle, ["generic_name", "brand", "ingredient", "title"], ["document_id", "generic_name", "set_id", "version", "title"])
        return found.orderBy("generic_name", "set_id", text.leading_number(F.col("version")).desc(), "document_id")

    def lineage_search(self, needle: str) -> DataFrame:
        rows = self.table("documents").join(self.table("products").select("document_id", "brand"), "document_id", "left").join(self.table("ingredients").select("document_id", F.col("name").alias("ingredient")), "document_id", "left")
        hit = relational.any_mention([F.col(c) for c in ("generic_name", "brand", "ingredient", "title")], needle.strip()) | (F.lower("lineage_id") == needle.strip().lower()) | (F.lower("set_id") == needle.strip().lower())
        return rows.where(hit).select("lineage_id", "set_id").distinct()

    def document(self, document: str) -> DataFrame:
        """A document's header with its source."""
        return self.table("documents").where(F.col("document_id") == document).join(self.table("raw").select("set_id", "version", "metadata_path", "source_url", *self.origin), ["set_id", "version"], "left")

    def sections(self, document: str, concept: str | None = None) -> DataFrame:
        """Sections of a document, in order; with a concept, those that are mapped to it."""
        rows = self.table("sections").where(F.col("document_id") == document)
        if concept:
            rows = relational.having(rows, self.table("mappings").where(F.col("concept") == concept), ["section_id"])
        return rows.orderBy("seq")

    def resolve(self, set_id: str, version: str) -> DataFrame:
        """One row: FOUND with the document, AMBIGUOUS, or NOT_FOUND."""
        rows = self.table("documents").where((F.lower("set_id") == set_id.lower()) & (F.col("version") == version))
        n = F.count(F.lit(1))
        return rows.agg(F.when(n == 0, "NOT_FOUND").when(n == 1, "FOUND").otherwise("AMBIGUOUS").alias("status"), F.when(n == 1, F.min("document_id")).alias("document_id"))

    def section_counts(self) -> DataFrame:
        """Per document: sections, mapped and unmapped ones, empty ones, and how compatible the parser was."""
        mapped = self.table("mappings").select("section_id").distinct().withColumn("_m", F.lit(1))
        rows = self.table("sections").join(mapped, "section_id", "left").groupBy("document_id").agg(F.count(F.lit(1)).alias("n_sections"), F.count("_m").alias("n_mapped"), F.count_if(F.col("_m").isNull()).alias("n_unmapped"), F.count_if(F.col("status") == "PRESENT_EMPTY").alias("n_empty"))
        rows = self.table("documents").select("document_id").join(rows, "document_id", "left").na.fill(0)
        return rows.withColumn("compatibility", rules.compatibility(F.col("n_unmapped"), F.col("n_empty")))

    # Versions and diffs

    def versions_of(self, lineages: DataFrame | None = None) -> DataFrame:
        """Documents of lineages in version order, with publication dates (of the newest history, else of the candidate that was selected) and positions."""
        rows = self.table("documents") if lineages is None else relational.having(self.table("documents"), lineages, ["lineage_id"])
        chosen = self.table("decisions").where("status = 'SELECTED'").join(self.table("candidates"), "discovery_id").where("index = selected_index")
        dates = chosen.groupBy(F.lower("set_id").alias("_s"), F.col("version").alias("_v")).agg(F.max(text.lenient_date(F.col("published"))).alias("published"))
        picked = rows.join(dates, (F.lower("set_id") == F.col("_s")) & (F.col("version") == F.col("_v"))).select("document_id", "published")
        dated = self.with_metadata(lineage.publication(rows, self.table("history"), picked))
        return relational.numbered(dated, ["lineage_id"], [*text.version_key(F.col("version")), F.col("document_id")], "position")

    def with_metadata(self, rows: DataFrame) -> DataFrame:
        """Documents with ``metadata_sha256``: the digest of how they came in (where the raw document and its manifest are, from where and when it was fetched, and why it was chosen), apart from what they say."""
        c = F.col
        raw = self.table("raw").select("set_id", "version", "metadata_path", "source_url")
        why = self.table("decisions").where("status = 'SELECTED'").join(self.table("candidates"), "discovery_id").where("index = selected_index").groupBy("set_id", "version").agg(F.min("rule").alias("selection_reason"))
        whole = rows.join(raw, ["set_id", "version"], "left").join(why, ["set_id", "version"], "left")
        made = identity.canonical(metadata_path=c("metadata_path"), raw_path=c("path"), retrieved_at=text.utc_text(c("retrieved_at")), selection_reason=c("selection_reason"), source_url=c("source_url"))
        return whole.withColumn("metadata_sha256", identity.sha256(made)).drop("metadata_path", "source_url", "selection_reason")

    def pairs(self) -> DataFrame:
        """Consecutive versions of every lineage with the evidence for their order."""
        names = [n for n in self.table("documents").columns if n not in ("lineage_id", "source_id", "path", "n_bytes", "generics")] + ["published", "metadata_sha256"]
        rows = lineage.edges(self.versions_of().drop("position"), "lineage_id", [*text.version_key(F.col("version")), F.col("document_id")], names)
        return self.ordered_pairs(rows.select("lineage_id", *[F.col(f"old_{n}") for n in names], *[F.col(n).alias(f"new_{n}") for n in names]))

    def pair_of(self, old: str, new: str) -> DataFrame:
        """The pair of two documents, which must belong to one lineage."""
        d = self.versions_of().drop("position", "source_id", "path", "n_bytes", "generics", "published_source", "disagrees")
        side = lambda s, k: d.where(F.col("document_id") == k).select("lineage_id", *[F.col(c).alias(f"{s}_{c}") for c in d.columns if c != "lineage_id"])
        return self.ordered_pairs(side("old", old).join(side("new", new), "lineage_id"))

    def ordered_pairs(self, rows: DataFrame) -> DataFrame:
        rows = self.hold(rows.withColumnsRenamed({"old_retrieved_at": "old_retrieved", "new_retrieved_at": "new_retrieved"}))
        entries = self.latest_history().select("lineage_id", "version", F.col("position").cast("int").alias("position"))
        gaps = lineage.history_gaps(rows.select("lineage_id", "old_version", "new_version").distinct(), entries)
        rows = rows.join(gaps.select("lineage_id", "old_version", "new_version", "history", "adjacent", "missing"), ["lineage_id", "old_version", "new_version"], "left")
        ids = rows.withColumn("diff_id", identity.diff_id(F.col("old_document_id"), F.col("new_document_id"), F.lit(self.versions["diff"]))).withColumn("edge_id", identity.edge_id(F.col("lineage_id"), F.col("old_document_id"), F.col("new_document_id")))
        return self.hold(lineage.ordered(ids))

    def section_diffs(self, pairs: DataFrame) -> DataFrame:
        """Matched, added and removed sections of every pair (diff_id, old_document_id, new_document_id; one side may be null) with their operations. Held, so it may be read often."""
        sides = pairs.select(F.col("diff_id").alias("pair_id"), F.inline(F.array(F.struct(F.lit("old").alias("side"), F.col("old_document_id").alias("document_id")), F.struct(F.lit("new").alias("side"), F.col("new_document_id").alias("document_id")))))
        concepts = self.table("mappings").groupBy("section_id").agg(F.array_sort(F.collect_set("concept")).alias("concepts"))
        rows = sides.join(self.table("sections"), "document_id").join(concepts, "section_id", "left").withColumn("concepts", F.coalesce("concepts", F.array().cast("array<string>")))
        rows = self.hold(rows.select("pair_id", "side", "section_id", "parent_id", "seq", "depth", "code", "heading", "text", "status", "locator", "xml_id", "comparison", "concepts"))
        found = self.hold(matching.match_sections(rows, self.hold))
        kept = ["section_id", "parent_id", "seq", "code", "heading", "text", "status", "comparison", "concepts", "partner", "method"]
        old = found.where("side = 'old'").select("pair_id", *[F.col(c).alias(f"old_{c}") for c in kept])
        new = found.where("side = 'new'").select("pair_id", *[F.col(c).alias(f"new_{c}") for c in kept])
        both = old.join(new.withColumnRenamed("pair_id", "_p"), (F.col("pair_id") == F.col("_p")) & (F.col("old_partner") == F.col("new_section_id")), "full_outer")
        both = self.hold(both.withColumn("pair_id", F.coalesce("pair_id", "_p")).withColumnsRenamed({"old_section_id": "old_id", "new_section_id": "new_id", "old_parent_id": "old_parent", "new_parent_id": "new_parent"}))
        one = both.where("old_id IS NULL OR new_id IS NULL").withColumn("moved", F.lit(False))
        both = diff.with_movement(both.where("old_id IS NOT NULL AND new_id IS NOT NULL")).unionByName(one)
        c = F.col
        modified = ~c("old_text").eqNullSafe(c("new_text")) | ~c("old_code").eqNullSafe(c("new_code")) | ~c("old_status").eqNullSafe(c("new_status")) | ~c("old_comparison").eqNullSafe(c("new_comparison"))
        ops = diff.operations(c("old_id").isNotNull(), c("new_id").isNotNull(), modified, c("moved"), ~c("old_heading").eqNullSafe(c("new_heading")), ~c("old_concepts").eqNullSafe(c("new_concepts")))
        method = F.coalesce("old_method", F.lit("UNMATCHED"))
        status = F.when(c("old_id").isNull() | c("new_id").isNull(), "UNMATCHED").when(method == "CONTENT_ASSISTED", "HEURISTIC").otherwise("EXACT")
        rows = both.withColumn("method", F.when(status == "UNMATCHED", "UNMATCHED").otherwise(method)).withColumn("status", status).withColumn("operations", ops)
        order = [F.coalesce("new_seq", "old_seq"), F.when(c("new_id").isNull(), 1).otherwise(0), F.coalesce("old_seq", F.lit(-1))]
        rows = relational.numbered(rows, ["pair_id"], order, "index").withColumn("section_diff_id", identity.section_diff_id(c("pair_id"), c("index")))
        made = identity.canonical(index=c("index"), old_id=c("old_id"), new_id=c("new_id"), method=c("method"), status=c("status"), operations=c("operations"), old_heading=c("old_heading"), new_heading=c("new_heading"), old_code=c("old_code"), new_code=c("new_code"), old_text_sha256=identity.sha256(c("old_text")), new_text_sha256=identity.sha256(c("new_text")), old_concepts=c("old_concepts"), new_concepts=c("new_concepts"))
        rows = rows.withColumn("canonical", made).withColumn("sha256", identity.sha256(c("canonical")))
        return self.hold(rows.select("pair_id", "index", "section_diff_id", "old_id", "new_id", "method", "status", "operations", "old_seq", "new_seq", "old_text", "new_text", "old_heading", "new_heading", "canonical", "sha256"))

    def diff(self, pairs: DataFrame, rows: DataFrame | None = None, moment: str = NOT_YET) -> DataFrame:
        """One row per pair: summary, operations, changed fields of the header, cause, and the canonical artifact with its hash. rows: what ``section_diffs`` gave for these pairs."""
        rows = self.section_diffs(pairs) if rows is None else rows
        c = F.col
        changes = diff.metadata_changes(pairs, "diff_id")
        ops = diff.document_operations(rows, ["pair_id"]).withColumnsRenamed({"pair_id": "diff_id", "operations": "_sections"})
        parts = rows.groupBy(c("pair_id").alias("diff_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("index", c("sha256").alias("s")))), lambda x: x["s"]).alias("section_sha256"))
        whole = pairs.join(diff.summary(rows, ["pair_id"]).withColumnRenamed("pair_id", "diff_id"), "diff_id", "left").join(ops, "diff_id", "left").join(parts, "diff_id", "left").join(changes, "diff_id", "left").join(self.change_causes(pairs), "diff_id")
        counts = ["sections", "matched", "unmatched", "added", "removed", "modified", "moved", "renamed", "mapping_changed", "unchanged"]
        whole = whole.na.fill(0, counts).withColumns({"changes": F.coalesce("changes", F.array().cast(diff.CHANGES)), "section_sha256": F.coalesce("section_sha256", F.array().cast("array<string>"))})
        whole = whole.withColumns({"metadata_changes": F.size("changes").cast("long"), "operations": diff.whole_operations(c("old_document_id").isNotNull(), c("new_document_id").isNotNull(), F.size("changes") > 0, F.coalesce("_sections", F.array().cast("array<string>")))})
        source = lambda s: identity.fields(**{n: c(f"{s}_{n}") for n in ("document_id", "set_id", "version", "raw_sha256", "normalized_sha256", "parser_version", "schema_version", "mapping_version")}, retrieved_at=text.utc_text(c(f"{s}_retrieved")))
        payload = identity.fields(
            diff_id=c("diff_id"), engine=F.lit(self.versions["diff"]), generated_at=F.lit(moment), old_provenance=source("old"), new_provenance=source("new"), cause=c("cause"), components=c("components"),
            ordering=identity.fields(status=c("ordering.status"), source=c("ordering.source"), confidence=c("ordering.confidence"), known=c("ordering.known"), missing=c("missing")), operations=c("operations"), metadata_changes=c("changes"), sections=c("section_sha256"), summary=identity.fields(**{n: c(n) for n in [*counts, "metadata_changes"]}),
        )
        whole = whole.withColumn("canonical", identity.rendered(identity.steady(payload, "diff"))).withColumn("sha256", identity.sha256(c("canonical")))
        return self.hold(whole.select(c("diff_id").alias("pair_id"), "lineage_id", "old_document_id", "new_document_id", *counts, "metadata_changes", "changes", "operations", "cause", "components", "canonical", "sha256"))

    def store_diffs(self, pairs: DataFrame, moment: str = NOT_YET) -> DataFrame:
        """Diffs, their section rows and the version edges, stored once. Returns (diff_id, outcome): NEW, SAME or CONFLICT; if any is a conflict, nothing is written."""
        rows = self.section_diffs(pairs)
        made = self.diff(pairs, rows, moment).withColumnRenamed("pair_id", "diff_id").withColumns({"engine": F.lit(self.versions["diff"]), "generated_at": at(moment)})
        outcome = self.hold(compared(self.table("diffs"), made, ["diff_id"], "sha256").where("outcome <> 'KEPT'"))
        if outcome.where("outcome = 'CONFLICT'").isEmpty():
            edges = pairs.withColumn("canonical", identity.rendered(identity.fields(edge_id=F.col("edge_id"), ordering=F.col("ordering"), missing=F.col("missing"))))
            edges = edges.withColumns({"status": F.col("ordering.status"), "sha256": identity.sha256(F.col("canonical"))})
            self.commit(diffs=made, section_diffs=rows.withColumnRenamed("pair_id", "diff_id"), edges=edges)
        return outcome

    def text_diffs(self, pairs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """Word chunks of the sections that were added, removed or modified."""
        rows = self.section_diffs(pairs) if rows is None else rows
        rows = rows.where(F.arrays_overlap("operations", F.array(*map(F.lit, ("SECTION_ADDED", "SECTION_REMOVED", "SECTION_MODIFIED")))))
        return textdiff.text_chunks(rows, ["pair_id", "index"])

    def structure_changes(self, pairs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """(pair_id, index, path, change): where the structures of matched sections differ, apart from their locators."""
        rows = self.section_diffs(pairs) if rows is None else rows
        side = lambda s: self.table("sections").select(F.col("section_id").alias(f"{s}_id"), F.col("comparison").alias(s))
        both = rows.where("old_id IS NOT NULL AND new_id IS NOT NULL").select("pair_id", "index", "old_id", "new_id").join(side("old"), "old_id").join(side("new"), "new_id")
        return structure.changed_paths(both, ["pair_id", "index"])

    def change_causes(self, pairs: DataFrame) -> DataFrame:
        """Why the two versions of each pair differ."""
        c = F.col
        sides = [("SOURCE_CHANGED", "raw_sha256"), ("PARSER_CHANGED", "parser_version"), ("SCHEMA_CHANGED", "schema_version"), ("MAPPING_CHANGED", "mapping_version")]
        found = rules.change_components([(name, c(f"old_{f}"), c(f"new_{f}")) for name, f in sides])
        complete = F.size(rules.required({f"{s}_{f}": c(f"{s}_{f}") for s in ("old", "new") for _, f in sides})) == 0
        rows = pairs.withColumn("_found", F.when(complete, found).otherwise(F.array().cast("array<string>")))
        has = {x: c(f"{x}_metadata_sha256") if f"{x}_metadata_sha256" in pairs.columns else F.lit(None).cast("string") for x in ("old", "new")}
        cause = rules.change_cause(c("old_document_id").isNotNull(), c("new_document_id").isNotNull(), complete, c("_found"), c("old_version") != c("new_version"), c("old_normalized_sha256") != c("new_normalized_sha256"), ~has["old"].eqNullSafe(has["new"]))
        return rows.withColumn("cause", cause).select("diff_id", rules.causes(c("cause"), c("_found")).alias("components"), "cause")

    # Verification

    def verify(self, raw: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
        """Per stored document (of ``only``: document_id), seven checks. raw: path, content; default: the store's own raw documents."""
        c = F.col
        kept = self.table("raw")
        raw = kept.select("path", "content") if raw is None else raw
        again = self.hold(xml_documents.parsed(raw))
        parts = xml_documents.children(again, versions=self.versions, **self.origin)
        now = parts["documents"].select("document_id", c("raw_sha256").alias("_raw"), c("normalized_sha256").alias("_norm")).distinct()
        chosen = (lambda t: t) if only is None else (lambda t: t.join(only.select("document_id"), "document_id", "left_semi"))
        d = chosen(self.table("documents"))
        sections = chosen(self.table("sections")).withColumn("_again", xml_documents.section_hash(c("heading"), c("text"), c("code"), c("structure")))
        broken = sections.where("_again <> sha256").select("document_id").distinct().withColumn("_broken", F.lit(True))
        orphan = relational.orphans(self.table("mappings"), self.table("sections"), ["section_id"]).select("document_id").union(relational.foreign_parents(self.table("sections"), "section_id", "parent_id", "document_id").select("document_id")).distinct().withColumn("_orphan", F.lit(True))
        double = [self.table(n).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("document_id").alias("_d")).where("n > 1").select(c("_d").alias("document_id")) for n, (_, key) in TABLES.items() if n in ("documents", "sections", "products", "ingredients", "mappings", "statuses")]
        unsound = double[0]
        for x in double[1:]:
            unsound = unsound.union(x)
        source = files.manifests(kept.select("set_id", "version", "metadata_path", "manifest", *self.origin)).withColumn("_meta", F.when(c("manifest_error").isNull(), c("identity")))
        rows = d.join(now, "document_id", "left").join(broken, "document_id", "left").join(orphan, "document_id", "left").join(unsound.distinct().withColumn("_double", F.lit(True)), "document_id", "left").join(source, ["set_id", "version"], "left")
        # Documents that were ingested from files have no manifest: their origin is the store's.
        stored = c("manifest").isNotNull()
        agrees = (c("_meta.raw_sha256") == c("raw_sha256")) & (c("_meta.source_document_id") == c("set_id")) & (c("_meta.source_version") == c("version")) & (c("_meta.authority") == c("authority")) & (c("_meta.provider") == c("provider")) & (c("_meta.jurisdiction") == c("jurisdiction"))
        needed = {n: F.when(stored, c(n).cast("string")).otherwise(F.lit("file")) if n in (*self.origin, "metadata_path") else c(n).cast("string") for n in PROVENANCE}
        same = (c("parser_version") == F.lit(self.versions["parser"])) & (c("schema_version") == F.lit(self.versions["schema"])) & (c("mapping_version") == F.lit(self.versions["mapping"]))
        checks = {
            "required_provenance": F.size(rules.required(needed)) == 0,
            "raw_sha256": c("raw_sha256") == c("_raw"),
            "raw_metadata": ~stored | agrees,
            "section_sha256": c("_broken").isNull(),
            "referential_integrity": c("_orphan").isNull(),
            "database_consistency": c("_double").isNull(),
            "deterministic_normalization": same & (c("normalized_sha256") == c("_norm")),
        }
        return batch.verified(batch.unrolled(rows, ["document_id"], checks), ["document_id"])

    def verify_diffs(self, pairs: DataFrame | None = None, raw: DataFrame | None = None) -> DataFrame:
        """Per stored diff of the pairs (default: all consecutive versions), eight checks. raw: as for ``verify``."""
        c = F.col
        pairs = self.pairs() if pairs is None else pairs
        stored = self.table("diffs").join(pairs.select("diff_id").distinct(), "diff_id", "left_semi")
        rows = self.section_diffs(pairs)
        again = self.diff(pairs, rows, "2000-01-01T00:00:00Z").select(c("pair_id").alias("diff_id"), c("canonical").alias("_again"))
        mine, now = self.table("section_diffs"), rows.select(c("pair_id").alias("diff_id"), "index", c("section_diff_id").alias("_id"), c("canonical").alias("_canonical"))
        both = mine.join(stored.select("diff_id"), "diff_id", "left_semi").join(now, ["diff_id", "index"], "full_outer")
        right = (c("section_diff_id") == c("_id")) & (c("canonical") == c("_canonical")) & (c("sha256") == identity.sha256(c("_canonical")))
        sections = both.groupBy("diff_id").agg(F.bool_and(F.coalesce(right, F.lit(False))).alias("_sections"))
        n = self.table("diffs").groupBy("diff_id").agg(F.count(F.lit(1)).alias("_n"))
        missing = relational.orphans(stored.select("diff_id", F.explode(F.array("old_document_id", "new_document_id")).alias("document_id")).where("document_id IS NOT NULL"), self.table("documents"), ["document_id"]).select("diff_id").distinct().withColumn("_missing", F.lit(True))
        sound = self.hold(self.verify(raw)).select("document_id", "verified")
        ends = stored.select("diff_id", F.explode(F.array("old_document_id", "new_document_id")).alias("document_id")).where("document_id IS NOT NULL").join(sound, "document_id", "left").groupBy("diff_id").agg(F.bool_and(F.coalesce("verified", F.lit(False))).alias("_ends"))
        whole = stored.join(again, "diff_id", "left").join(sections, "diff_id", "left").join(n, "diff_id").join(missing, "diff_id", "left").join(ends, "diff_id", "left")
        parsed = F.try_parse_json("canonical")
        checks = {
            "canonical_artifact_sha256": identity.sha256(c("canonical")) == c("sha256"),
            "canonical_artifact_json": F.try_variant_get(parsed, "$.diff_id", "string") == c("diff_id"),
            "diff_engine_version": c("engine") == F.lit(self.versions["diff"]),
            "deterministic_diff_reproduction": c("canonical") == c("_again"),
            "generation_timestamp_excluded": F.is_variant_null(F.try_variant_get(parsed, "$.generated_at", "variant")),
            "section_diff_artifacts": c("_sections"),
            "database_consistency": (c("_n") == 1) & c("_missing").isNull(),
            "compared_source_documents": c("_ends"),
        }
        return batch.verified(batch.unrolled(whole, ["diff_id"], checks), ["diff_id"])

    def integrity(self) -> DataFrame:
        """Every broken key, reference and check of the store; no rows if it is sound."""
        t = {n: self.table(n) for n in TABLES}
        out = [violations(t[n], n, unique=[key]) for n, (_, key) in TABLES.items()]
        out += [violations(t[n], n, references={other: (cols, t[other], theirs)}) for n, found in REFERENCES.items() for cols, other, theirs in found]
        # Statuses again from stored sections, of documents whose sections have intervals.
        known = t["sections"].where("leave_seq IS NOT NULL").select("document_id").distinct()
        again = xml_documents.stored_statuses(known, t["sections"], t["mappings"]).withColumnRenamed("status", "_again")
        differ = t["statuses"].join(again, ["document_id", "concept"]).where("status <> _again")
        out.append(differ.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("statuses").alias("table"), F.lit("status of stored sections").alias("rule"), F.col("document_id").alias("key"), "n"))
        foreign = relational.foreign_parents(t["sections"], "section_id", "parent_id", "document_id")
        out.append(foreign.groupBy("section_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("sections").alias("table"), F.lit("parent in other document").alias("rule"), F.col("section_id").alias("key"), "n"))
        whole = out[0]
        for x in out[1:]:
            whole = whole.unionByName(x)
        return whole

    def close(self) -> None:
        """Removes what this session held. Results that were not read yet cannot be read afterwards."""
        scratch.release()
