"""Ranked batches: plan, fetch, ingest, verify, report. A run's items are events in the store, the newest of each rank is its state, so every stage can be run again and takes up only what it has to.

A stage takes its items in groups of consecutive ranks. A group is one plan and one commit, so a job that is killed keeps
the groups it has finished, and the next one takes up the rest. An item that fails gets a state and a message; the others
go on. If a group's job itself fails, the group is halved until the item that breaks it stands alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeldiff.functions import identity, rules, text
from labeldiff.operators import batch, relational, selection
from labeldiff.operators.store import Refused, compared
from labeldiff.plans.flows import NOT_YET, Flows, at
from labeldiff.plans.tables import TABLES
from labeldiff.sources import fetch, files

ITEM = [f.split()[0] for f in TABLES["batch_items"][0].split(", ")]


class Batches:
    """Runs over the store of ``flows``; ``transport`` answers lookups and downloads below ``base``."""

    def __init__(self, flows: Flows, transport: fetch.Transport, base: str = "https://service", moment: str = NOT_YET, group: int = 500):
        self.flows, self.transport, self.base, self.moment, self.group = flows, transport, base, moment, group
        self.spark, self.versions = flows.spark, flows.versions

    # Lists

    def add_list(self, entries: DataFrame) -> DataFrame:
        """entries: what ``files.ranked_lists`` gives. Stores sound lists once; returns (utilization_list_id, problem, n): what is wrong, or another content under a stored id."""
        c = F.col
        entries = self.flows.hold(entries)
        wrong = self.flows.hold(files.list_problems(entries))
        good = entries.join(wrong.select("utilization_list_id").distinct(), "utilization_list_id", "left_anti")
        one = identity.canonical(**{n: c(n) for n in ("rank", "ingredient_name", "metric_value", "metric_unit", "source_row_identifier")})
        head = ["schema_version", "jurisdiction", "measurement_year", "dataset_name", "dataset_version", "metric", "retrieved_at", "source_reference", "source_status", "license_or_terms_status", "notes"]
        whole = good.groupBy("utilization_list_id").agg(F.concat(identity.rendered(identity.fields(**{h: F.min(h) for h in head})), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", one.alias("j")))), lambda x: x["j"]), ",")).alias("canonical")).withColumn("sha256", identity.sha256(c("canonical")))
        outcome = self.flows.hold(compared(self.flows.table("lists"), whole, ["utilization_list_id"], "sha256").where("outcome <> 'KEPT'"))
        new = outcome.where("outcome = 'NEW'").select("utilization_list_id")
        self.flows.commit(lists=whole.join(new, "utilization_list_id", "left_semi"), entries=good.join(new, "utilization_list_id", "left_semi"))
        clash = outcome.where("outcome = 'CONFLICT'").select("utilization_list_id", F.lit("another content under this id").alias("problem"), F.lit(1).cast("long").alias("n"))
        return wrong.unionByName(clash)

    def lists(self) -> DataFrame:
        """Stored lists with the number of their entries."""
        n = self.flows.table("entries").groupBy("utilization_list_id").agg(F.count(F.lit(1)).alias("n_entries"))
        return self.flows.table("lists").select("utilization_list_id", "sha256").join(n, "utilization_list_id", "left").na.fill(0)

    # Runs

    def run_id(self, list_id: str) -> str:
        v = self.versions
        made = identity.batch_run_id(F.lit(list_id), *[F.lit(v[k]) for k in ("rule", "connector", "parser", "schema", "mapping")])
        return self.spark.range(1).select(made.alias("r")).first().r

    def items(self, run_id: str) -> DataFrame:
        """The current state of a run's items."""
        rows = self.flows.table("batch_items").where(F.col("run_id") == run_id)
        return relational.latest(rows, ["run_id", "rank"], ["seq"], [c for c in ITEM if c not in ("run_id", "rank")])

    def runs(self, run_id: str) -> DataFrame:
        rows = self.flows.table("batch_runs").where(F.col("run_id") == run_id)
        return relational.latest(rows, ["run_id"], ["seq"], [c for c in rows.columns if c != "run_id"])

    def save(self, items: DataFrame, **more: DataFrame) -> None:
        """New events of the items that changed, with whatever belongs to them, in one commit."""
        self.flows.commit(batch_items=items.withColumn("seq", F.col("seq") + 1), **more)

    def each(self, todo: DataFrame, run_id: str, work: Callable[[DataFrame], None], broken: dict[str, Column]) -> None:
        """Runs work on the items group by group. A group whose job fails is halved; an item that fails alone gets the states in ``broken``, the failure as its message, and may be tried again."""
        spans = batch.spans(todo, self.group)
        while spans:
            low, high = spans.pop(0)
            part = todo.where(F.col("rank").between(low, high))
            try:
                work(part)
            except (Py4JJavaError, PySparkException, Refused) as e:
                if self.spark.sparkContext._jsc is None or self.spark.sparkContext._jsc.sc().isStopped():
                    raise
                low, high = part.agg(F.min("rank"), F.max("rank")).first()
                if low < high:
                    middle = (low + high) // 2
                    spans[:0] = [s for s in ((low, middle), (middle + 1, high)) if not todo.where(F.col("rank").between(*s)).isEmpty()]
                else:
                    self.save(self.filled(part.withColumns({"retry": F.lit(True), "message": F.lit(f"{type(e).__name__}: {e}"[:500]), **broken})))
        self.refresh(run_id, False)

    def refresh(self, run_id: str, terminal: bool, artifact: str | None = None) -> DataFrame:
        """A new event of the run, counted anew from its items; a status other than RUNNING only where ``terminal``."""
        whole = batch.rollup(self.items(run_id), ["run_id"], terminal).drop("open")
        last = self.flows.table("batch_runs").where(F.col("run_id") == run_id).groupBy("run_id").agg(F.max("seq").alias("_s"), F.any_value("utilization_list_id").alias("utilization_list_id"))
        rows = whole.join(last, "run_id").withColumns({"seq": F.col("_s") + 1, "at": at(self.moment), "artifact_sha256": F.lit(artifact).cast("string")})
        self.flows.commit(batch_runs=rows)
        return self.runs(run_id)

    def ensured(self, list_id: str) -> str:
        """The run of a stored list; created with its items, all pending, in one commit if it is not there."""
        run = self.run_id(list_id)
        if self.flows.table("batch_runs").where(F.col("run_id") == run).isEmpty():
            entries = self.flows.table("entries").where(F.col("utilization_list_id") == list_id)
            if entries.isEmpty():
                raise LookupError(f"no list {list_id}")
            zero = {c: F.lit(0).cast("long") for c in ("seq", "n_candidates")}
            states = {"selection": "PENDING", "discovery": "PENDING", "ingestion": "PENDING", "verification": "NOT_VERIFIED"}
            fresh = entries.select("rank", "ingredient_name", "normalized").withColumns({"run_id": F.lit(run), **zero, **{c: F.lit(v) for c, v in states.items()}, "manual_review": F.lit(False), "retry": F.lit(False)})
            fresh = self.filled(fresh)
            counts = {c: F.lit(0).cast("long") for c in ("seq", "selected", "fetched", "ingested", "verified", "quarantined", "unresolved", "failed")}
            made = entries.groupBy("utilization_list_id").agg(F.count(F.lit(1)).alias("total")).withColumns({"run_id": F.lit(run), "status": F.lit("RUNNING"), "artifact_sha256": F.lit(None).cast("string"), "at": at(self.moment), **counts})
            self.flows.commit(batch_items=fresh, batch_runs=made)
        return run

    def filled(self, rows: DataFrame) -> DataFrame:
        """rows with all columns of an item; those that are not there are null."""
        kinds = {f.name: f.dataType for f in self.spark.createDataFrame([], TABLES["batch_items"][0]).schema}
        return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in ITEM])

    # Stages

    def plan(self, list_id: str) -> str:
        """Looks up and decides every item that has no decision yet; stores evidence, decisions and failures. Returns the run's id."""
        run, c = self.ensured(list_id), F.col
        todo = self.flows.hold(self.items(run).where("decision_id IS NULL"))
        if not todo.isEmpty():
            self.each(todo, run, lambda part: self.plan_group(list_id, part), {"selection": F.lit("FETCH_FAILED"), "discovery": F.lit("LOOKUP_FAILED"), "ingestion": F.lit("NOT_SELECTED"), "error": F.lit("candidate_lookup_failed")})
        return run

    def plan_group(self, list_id: str, todo: DataFrame) -> None:
        c = F.col
        got = self.flows.hold(fetch.lookups(todo.select(c("normalized").alias("lookup_id")), self.base, self.transport))
        entries = todo.select(F.lit(list_id).alias("utilization_list_id"), "rank", "ingredient_name", "normalized")
        items, evidence, found = self.decided(entries, got)
        items, evidence = self.flows.hold(items), self.flows.hold(evidence)
        failed = items.where("discovery = 'LOOKUP_FAILED'")
        made = evidence.withColumn("candidate_id", identity.candidate_id(c("discovery_id"), text.folded(c("set_id")), c("version"), c("metadata_sha256"), c("index")))
        chosen = evidence.where("status = 'SELECTED' AND index = selected_index").select("discovery_id", "set_id", "version")
        decision = items.where("decision_id IS NOT NULL").withColumns({"rule": F.lit(self.versions["rule"]), "status": c("selection")})
        classes = evidence.groupBy("discovery_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("index", "classes", "accepted", "reasons"))), lambda x: identity.fields(index=x["index"], classes=x["classes"], accepted=x["accepted"], reasons=x["reasons"])).alias("evidence"))
        decision = decision.join(classes, "discovery_id", "left").withColumn("canonical", identity.canonical(rule=c("rule"), status=c("status"), selected_index=c("selected_index"), manual_review=c("manual_review"), evidence=c("evidence"))).withColumn("sha256", identity.sha256(c("canonical")))
        discoveries = items.where("decision_id IS NOT NULL").select("discovery_id", "utilization_list_id", "rank", "normalized").join(found, "discovery_id").withColumn("connector", F.lit(self.versions["connector"]))
        failures = failed.select("discovery_id", "utilization_list_id", "rank", c("error").alias("category"), "message").join(todo.select("rank", "seq"), "rank")
        states = items.select("rank", "discovery_id", "decision_id", "selection", "discovery", "ingestion", "error", "message", "manual_review", "n_candidates").join(chosen, "discovery_id", "left")
        rows = todo.select("run_id", "rank", "seq", "ingredient_name", "normalized").join(states, "rank").withColumns({"verification": F.lit("NOT_VERIFIED"), "retry": c("discovery") == "LOOKUP_FAILED"})
        self.save(self.filled(rows), discoveries=discoveries, candidates=made, decisions=decision, lookup_failures=failures)

    def decided(self, entries: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """entries: utilization_list_id, rank, ingredient_name, normalized. responses: lookup_id (the normalized name), body, and error and source_url if there are. Returns items, classified evidence, and lookups (discovery_id, source_url, raw_sha256, body, truncated)."""
        c = F.col
        responses = responses.select("lookup_id", "body", *[c(x) if x in responses.columns else F.lit(None).cast("string").alias(x) for x in ("error", "source_url")])
        problems = files.lookup_problems(responses)
        lookups = responses.join(problems, "lookup_id").join(files.truncated(responses), "lookup_id").withColumn("raw_sha256", identity.sha256(c("body")))
        listed = entries.join(lookups.withColumnRenamed("error", "_error"), c("normalized") == c("lookup_id"), "left")
        bad = c("lookup_id").isNull() | c("_error").isNotNull() | c("problem").isNotNull()
        digest = F.when(bad, identity.sha256(F.lit("lookup-failed"))).otherwise(c("raw_sha256"))
        listed = listed.withColumn("discovery_id", identity.discovery_id(c("utilization_list_id"), identity.ingredient_id(c("normalized")), F.lit(self.versions["connector"]), digest)).withColumn("_bad", bad)
        good = listed.where("NOT _bad")
        seen = files.candidates(responses).drop("raw_sha256", "invalid").join(good.select("lookup_id", "discovery_id", "normalized", c("ingredient_name").alias("original")), "lookup_id")
        evidence = self.flows.hold(selection.classified(seen.withColumn("metadata", F.to_json("meta")).drop("index", "meta")))
        decided = selection.decisions(evidence, good.select("discovery_id", "truncated"))
        items = batch.initial_items(listed.select("utilization_list_id", "rank", "ingredient_name", "normalized", "discovery_id", "_bad", "_error", "problem"), decided)
        malformed = c("problem").isNotNull() & c("_error").isNull()
        items = items.withColumns({
            "selection": F.when(c("_bad"), F.when(malformed, "METADATA_INVALID").otherwise("FETCH_FAILED")).otherwise(c("selection")),
            "discovery": F.when(c("_bad"), "LOOKUP_FAILED").otherwise(c("discovery")),
            "error": F.when(c("_bad"), "candidate_lookup_failed").otherwise(c("error")),
            "message": F.when(c("_bad"), F.coalesce("_error", "problem", F.lit("no response"))),
            "ingestion": F.when(c("_bad"), "NOT_SELECTED").otherwise(c("ingestion")),
            "manual_review": F.coalesce("manual_review", F.lit(True)),
            "n_candidates": F.coalesce("n_candidates", F.lit(0)).cast("long"),
            "decision_id": F.when(~c("_bad"), identity.decision_id(c("discovery_id"), F.lit(self.versions["rule"]))),
        }).drop("_bad", "_error", "problem")
        return items, selection.explained(evidence, decided), good.select("discovery_id", "source_url", "raw_sha256", "body", "truncated")

    def fetch(self, list_id: str, ranks: Sequence[int] | None = None) -> str:
        run = self.plan(list_id)
        todo = self.flows.hold(batch.eligible(self.items(run), "fetch", ranks).where("selection = 'SELECTED'"))
        if not todo.isEmpty():
            self.each(todo, run, self.fetch_group, {"ingestion": F.lit("RAW_FETCH_FAILED"), "error": F.lit("raw_fetch_failed")})
        return run

    def fetch_group(self, todo: DataFrame) -> None:
        c = F.col
        # The choice is read back from the stored evidence, not from the item.
        picked = self.flows.table("decisions").where("status = 'SELECTED'").join(self.flows.table("candidates"), "discovery_id").where("index = selected_index").select("decision_id", "classes", "status", c("set_id").alias("_s"), c("version").alias("_v"), "discovery_id")
        ready = todo.join(picked.drop("discovery_id"), "decision_id", "left")
        lost = ready.where("_s IS NULL")
        evidence = ready.where("_s IS NOT NULL").join(self.flows.table("discoveries").select("discovery_id", "body", "source_url"), "discovery_id").select(c("_s").alias("set_id"), c("_v").alias("version"), "body", "source_url", "classes", "status")
        got = self.flows.hold(fetch.documents(ready.where("_s IS NOT NULL").select(c("_s").alias("set_id"), c("_v").alias("version")).distinct(), self.base, self.transport))
        stored = self.flows.store_raw(got, self.moment, evidence).select(c("set_id").alias("_s"), c("version").alias("_v"), c("raw_sha256").alias("_sha"), "state", c("error").alias("_error"), c("quarantine_id").alias("_q"))
        rows = ready.where("_s IS NOT NULL").join(stored, ["_s", "_v"], "left").withColumns({
            "ingestion": F.coalesce("state", F.lit("RAW_FETCH_FAILED")), "raw_sha256": F.when(c("state").isin("FETCHED", "ALREADY_FETCHED"), c("_sha")).otherwise(c("raw_sha256")), "quarantine_id": F.coalesce("_q", "quarantine_id"),
            "error": F.when(c("state").isin("FETCHED", "ALREADY_FETCHED"), None).when(c("state") == "RAW_HASH_CONFLICT", "raw_hash_conflict").otherwise("raw_fetch_failed"), "message": c("_error"), "retry": F.coalesce(c("state") == "RAW_FETCH_FAILED", F.lit(True)),
        })
        lost = lost.withColumns({"ingestion": F.lit("RAW_FETCH_FAILED"), "error": F.lit("candidate_metadata_invalid"), "message": F.lit("the item's evidence is not stored"), "retry": F.lit(False)})
        self.save(self.filled(rows).unionByName(self.filled(lost)))

    def ingest(self, list_id: str, ranks: Sequence[int] | None = None) -> str:
        run = self.fetch(list_id, ranks)
        todo = self.flows.hold(batch.eligible(self.items(run), "ingest", ranks).where("set_id IS NOT NULL AND version IS NOT NULL"))
        if not todo.isEmpty():
            self.each(todo, run, self.ingest_group, {"ingestion": F.lit("DATABASE_FAILED"), "error": F.lit("database_failure")})
        return run

    def ingest_group(self, todo: DataFrame) -> None:
        c = F.col
        raw = self.flows.table("raw").join(todo.select("set_id", "version").distinct(), ["set_id", "version"], "left_semi")
        done = self.flows.ingested(raw.select("path", "content", "raw_sha256", "set_id", "version"), self.moment)
        done = done.join(raw.select("path", "set_id", "version"), "path").select("set_id", "version", c("document_id").alias("_d"), "outcome", c("message").alias("_m"), c("raw_sha256").alias("_sha"), "path")
        counts = self.flows.section_counts().select(c("document_id").alias("_d"), *[c(n).alias(f"_{n}") for n in ("n_sections", "n_mapped", "n_unmapped", "n_empty", "compatibility")])
        rows = todo.join(done, ["set_id", "version"], "left").join(counts, "_d", "left")
        good = c("outcome").isin("INGESTED", "ALREADY_INGESTED")
        broken = rules.parser_failure(F.coalesce("outcome", F.lit("database_failure")))
        category = F.when(c("outcome") == "CONFLICT", "database_failure").otherwise(F.coalesce("outcome", F.lit("database_failure")))
        rows = self.flows.hold(rows.withColumns({
            "document_id": F.when(good, c("_d")), "ingestion": F.when(good, c("outcome")).when(c("outcome").isNull() | (c("outcome") == "CONFLICT"), "DATABASE_FAILED").otherwise(broken["ingestion"]),
            "compatibility": F.when(good, c("_compatibility")).otherwise(broken["compatibility"]), "n_sections": c("_n_sections"), "n_mapped": c("_n_mapped"), "n_unmapped": c("_n_unmapped"), "n_empty": c("_n_empty"),
            "error": F.when(~F.coalesce(good, F.lit(False)), category), "message": F.when(~F.coalesce(good, F.lit(False)), F.coalesce("_m", F.lit("not stored"))), "retry": ~F.coalesce(good | (c("outcome") == "unsupported_document_structure"), F.lit(False)),
            "quarantine_id": F.when(~F.coalesce(good, F.lit(False)), identity.quarantine_id(F.lit(""), c("path"), F.lit("ingest"), c("_sha"))).otherwise(c("quarantine_id")),
        }))
        log = rows.select("document_id", F.coalesce("raw_sha256", "_sha").alias("raw_sha256"), "seq", c("compatibility").alias("status"), "message").where("raw_sha256 IS NOT NULL")
        self.save(self.filled(rows), compatibility=log)

    def verify(self, list_id: str, ranks: Sequence[int] | None = None, terminal: bool = True) -> str:
        run = self.ingest(list_id, ranks)
        todo = self.flows.hold(batch.eligible(self.items(run), "verify", ranks).where("document_id IS NOT NULL"))
        if not todo.isEmpty():
            self.each(todo, run, self.verify_group, {"verification": F.lit("FAILED"), "error": F.lit("verification_failed")})
        if terminal:
            self.refresh(run, True)
        return run

    def verify_group(self, todo: DataFrame) -> None:
        c = F.col
        raw = self.flows.table("raw").join(todo.select("set_id", "version").distinct(), ["set_id", "version"], "left_semi")
        sound = self.flows.hold(self.flows.verify(raw.select("path", "content"), todo).select("document_id", "verified", c("failed").alias("_failed")))
        rows = todo.join(sound, "document_id", "left").withColumn("_ok", F.coalesce("verified", F.lit(False)))
        rows = rows.withColumns({"verification": F.when(c("_ok"), "VERIFIED").otherwise("FAILED"), "error": F.when(~c("_ok"), "verification_failed"), "message": F.when(~c("_ok"), F.coalesce(F.array_join("_failed", "; "), F.lit("not stored"))), "retry": ~c("_ok")})
        self.save(self.filled(rows))

    def run(self, list_id: str) -> DataFrame:
        return self.report(self.verify(list_id))

    def report(self, run_id: str) -> DataFrame:
        """The canonical report of a run, stored once per content: (artifact_id, run_id, canonical, sha256). It leaves out when things were done."""
        c = F.col
        names = [n for n in ITEM if n not in ("run_id", "seq")]
        items = self.items(run_id).groupBy("run_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", *[n for n in names if n != "rank"]))), lambda x: identity.fields(**{n: x[n] for n in names})).alias("items"))
        whole = self.runs(run_id).join(self.flows.table("lists").withColumnsRenamed({"canonical": "_list", "sha256": "_list_sha"}), "utilization_list_id").join(items, "run_id")
        counts = ("total", "selected", "fetched", "ingested", "verified", "quarantined", "unresolved", "failed")
        own = identity.fields(run_id=c("run_id"), utilization_list_id=c("utilization_list_id"), status=c("status"), started_at=text.utc_text(c("at")), completed_at=text.utc_text(c("at")), canonical_report_sha256=c("artifact_sha256"), **{n: c(n) for n in counts}, **{f"{k}_version": F.lit(self.versions[k]) for k in ("rule", "connector", "parser", "schema", "mapping")})
        payload = identity.fields(report_version=F.lit(self.versions["report"]), generated_at=F.lit(self.moment), batch_run=own, list_sha256=c("_list_sha"), items=c("items"))
        made = whole.select("run_id", identity.rendered(identity.steady(payload, "report")).alias("canonical")).withColumn("sha256", identity.sha256(c("canonical")))
        made = self.flows.hold(made.withColumn("artifact_id", identity.batch_artifact_id(c("run_id"), F.lit(self.versions["report"]), c("sha256"))))
        self.flows.commit(batch_artifacts=made)
        one = made.first()
        if one is not None and self.runs(run_id).first().artifact_sha256 != one.sha256:
            last = self.runs(run_id).withColumns({"seq": c("seq") + 1, "artifact_sha256": F.lit(one.sha256)})
            self.flows.commit(batch_runs=last)
        return made

    def status(self, run_id: str) -> tuple[DataFrame, DataFrame]:
        return self.runs(run_id), self.items(run_id)

    def candidates(self, name: str) -> DataFrame:
        """The audit of all candidates seen for an ingredient: evidence, classes, decision."""
        wanted = text.normalized_name(F.lit(name))
        seen = self.flows.table("discoveries").where(F.col("normalized") == wanted).select("discovery_id", "utilization_list_id", "rank", "normalized", "truncated")
        return seen.join(self.flows.table("decisions").select("discovery_id", "decision_id", "status", "selected_index", "manual_review"), "discovery_id").join(self.flows.table("candidates"), "discovery_id", "left").withColumn("selected", F.col("index").eqNullSafe(F.col("selected_index"))).orderBy("utilization_list_id", "rank", "index")
