"""Queries of the parser, the sources and the stored flows over the driver's tables, with their DuckDB SQL.

Stand-ins: every document becomes a structured product document whose sections are its lines (odd lines lie within the
line before), every customer a lookup or a ranked entry, every user a history. Every query reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labeldiff.functions import identity, rules, text
from labeldiff.operators import batch, diff, lineage, matching, relational, selection, structure, textdiff
from labeldiff.queries import META, document_pairs, joined, query, read, spread
from labeldiff.scratch import held
from labeldiff.sources import fetch, files, xml_documents
from labeldiff.values import CODE_CONCEPTS, CONCEPTS, REJECTIONS, SELECTION_ERRORS

# Documents as XML

CODES = [*CODE_CONCEPTS, "00000-0", ""]


def xml_text(value: Column) -> Column:
    for mark, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        value = F.replace(value, F.lit(mark), F.lit(f"&{name};"))
    return value


def xml_files(spark: SparkSession, d: str) -> DataFrame:
    """(path, content): a document of each row; of 13 in a row one each has a declaration, no title, a bad date, no end."""
    c, lit = F.col, F.lit
    i = c("doc_id")
    # Split and escaped once a document: within a lambda an expression is evaluated for each element, the whole text for each line.
    # No name of a character has a space or a line's end in it, so lines and first words are the same after escaping.
    docs = spread(read(spark, d, "documents")).withColumn("lines", F.split(xml_text(F.coalesce("text", lit(""))), "\n"))
    lines = c("lines")

    def section(k: Column, inner: Column) -> Column:
        line = F.get(lines, k)
        code = F.array(*map(lit, CODES))[((i + k) % 20).cast("int")]
        body = F.when(k % 10 == 9, "").otherwise(F.concat(lit("<text>"), line, lit("</text>")))
        return F.concat(lit('<component><section><id root="x'), k.cast("string"), lit('"/><code code="'), code, lit('"/><title>'), F.regexp_extract(line, "^[^ ]* ?[^ ]*", 0), lit("</title>"), body, inner, lit("</section></component>"))

    even = F.sequence(lit(0), (F.size(lines) - 1) - (F.size(lines) - 1) % 2, lit(2))
    parts = F.array_join(F.transform(even, lambda k: section(k, F.when(k + 1 < F.size(lines), section(k + 1, lit(""))).otherwise(""))), "")
    product = F.concat(lit("<subject><manufacturedProduct><manufacturedProduct><name>Brand "), (i % 7).cast("string"), lit('</name><formCode displayName="TABLET"/><genericMedicine><name>Gen '), (i % 5).cast("string"), lit('</name></genericMedicine><ingredient classCode="ACTIB"><ingredientSubstance><name>Straße '), (i % 3).cast("string"), lit('</name></ingredientSubstance></ingredient><ingredient classCode="ACTIM"><ingredientSubstance><name>STRASSE '), (i % 3).cast("string"), lit('</name></ingredientSubstance></ingredient><ingredient classCode="IACT"><ingredientSubstance><name>Starch</name></ingredientSubstance></ingredient></manufacturedProduct><consumedIn><routeCode displayName="ORAL"/><routeCode displayName="oral"/>'), F.when(i % 2 == 0, '<routeCode displayName="TOPICAL"/>').otherwise(""), lit("</consumedIn></manufacturedProduct></subject>"))
    day = F.when(i % 13 == 7, "20201301").otherwise(F.date_format(F.date_add(lit("2020-01-01").cast("date"), (i % 365).cast("int")), "yyyyMMdd"))
    title = F.when(i % 13 == 6, "").otherwise(F.concat(lit("<title>Label "), i.cast("string"), lit("  of "), xml_text(F.coalesce("source", lit(""))), lit("</title>")))
    whole = F.concat(
        F.when(i % 13 == 5, "<!DOCTYPE x>").otherwise(""), lit('<document xmlns="urn:hl7-org:v3"><id root="doc-'), i.cast("string"), lit('"/><code displayName="'), xml_text(F.coalesce("source", lit(""))), lit('"/>'), title, lit('<effectiveTime value="'), day, lit('"/><setId root="set-'),
        (i % 50).cast("string"), lit('"/><versionNumber value="'), i.cast("string"), lit('"/><languageCode code="'), xml_text(F.coalesce("lang", lit(""))), lit('"/>'), product, lit("<component><structuredBody>"), parts, lit("</structuredBody></component>"), F.when(i % 13 == 8, "").otherwise("</document>"),
    )
    return docs.select(i.cast("string").alias("path"), whole.cast("binary").alias("content"))


def xml_tables(spark: SparkSession, d: str, keep: bool = False) -> dict[str, DataFrame]:
    """The normalized tables; ``keep`` where more than one of them is read, so that every document is parsed once. What is held is without texts and structures: no such query reads them."""
    rows = xml_documents.parsed(xml_files(spark, d))
    if keep:
        rows = held(rows.withColumn("sections", F.transform("sections", lambda x: x.dropFields("text", "structure", "comparison"))), "parsed")
    return xml_documents.children(rows)


SECTIONS = """s AS (
  SELECT doc_id, k AS seq, string_split(coalesce(text, ''), chr(10))[k + 1] AS line, len(string_split(coalesce(text, ''), chr(10))) AS n
  FROM (SELECT doc_id, text, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS k FROM documents WHERE doc_id % 13 NOT IN (5, 6, 7, 8))),
x AS (
  SELECT doc_id, seq, seq % 2 AS depth, CASE WHEN seq % 2 = 1 THEN seq - 1 END AS parent_seq, nullif([{codes}][(doc_id + seq) % 20 + 1], '') AS code,
         nullif(trim(regexp_replace(regexp_extract(line, '^[^ ]* ?[^ ]*', 0), '\\s+', ' ', 'g')), '') AS heading,
         CASE WHEN seq % 10 = 9 THEN '' ELSE trim(regexp_replace(line, '\\s+', ' ', 'g')) END AS body,
         '/document[1]/component[1]/structuredBody[1]/component[' || (seq // 2 + 1) || ']/section[1]' || CASE WHEN seq % 2 = 1 THEN '/component[1]/section[1]' ELSE '' END AS locator
  FROM s),
y AS (SELECT *, CASE WHEN seq % 10 = 9 THEN 'TEXT_ELEMENT_ABSENT' WHEN body = '' THEN 'PRESENT_EMPTY' ELSE 'PRESENT' END AS status FROM x)""".replace("{codes}", ", ".join(f"'{c}'" for c in CODES))


#: The sections of documents whose header is refused.
SECTIONS_OF_ODD = """SELECT doc_id, seq, '/document[1]/component[1]/structuredBody[1]/component[' || (seq // 2 + 1) || ']/section[1]' || CASE WHEN seq % 2 = 1 THEN '/component[1]/section[1]' ELSE '' END AS locator
FROM (SELECT doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS seq FROM documents WHERE doc_id % 13 IN (6, 7))"""


@query("""SELECT doc_id::VARCHAR AS path, CASE WHEN doc_id % 13 IN (5, 8) THEN 'malformed_xml' ELSE 'unsupported_document_structure' END AS category FROM documents WHERE doc_id % 13 IN (5, 6, 7, 8)""")
def q_xml_errors(spark, d):
    """Guards, well-formedness, required values and dates: documents that cannot be read are rows with a category."""
    return xml_tables(spark, d)["errors"].select("path", "category")


@query("""SELECT doc_id::VARCHAR AS path, 'set-' || (doc_id % 50) AS set_id, doc_id::VARCHAR AS version, 'doc-' || doc_id AS document_root, trim('Label ' || doc_id || ' of ' || coalesce(source, '')) AS title, nullif(source, '') AS doc_type, nullif(lang, '') AS language,
strftime(DATE '2020-01-01' + (doc_id % 365)::INT, '%Y-%m-%d') AS effective, 'Gen ' || (doc_id % 5) AS generic_name, 'Straße ' || (doc_id % 3) AS ingredients, 'Brand ' || (doc_id % 7) AS brands, 'TABLET' AS forms, CASE WHEN doc_id % 2 = 0 THEN 'ORAL|TOPICAL' ELSE 'ORAL' END AS routes FROM documents WHERE doc_id % 13 NOT IN (5, 6, 7, 8)""")
def q_xml_documents(spark, d):
    """Headers: identity, title, type, language, date, names with first spellings kept."""
    rows = xml_tables(spark, d)["documents"]
    return rows.select("path", "set_id", "version", "document_root", "title", "doc_type", "language", F.col("effective").cast("string").alias("effective"), "generic_name", *[joined(c).alias(c) for c in ("ingredients", "brands", "forms", "routes")])


@query(f"""WITH {SECTIONS} SELECT doc_id::VARCHAR AS path, seq::INT AS seq, parent_seq::INT AS parent_seq, depth::INT AS depth, code, heading, body AS text, status, locator, 'x' || seq AS xml_id FROM y""")
def q_xml_sections(spark, d):
    """The section walk: order, depth, parent, code, heading, text, status, locator, source id."""
    rows = xml_documents.parsed(xml_files(spark, d)).where("error IS NULL")
    return rows.select("path", F.inline("sections")).select("path", "seq", "parent_seq", "depth", "code", "heading", "text", "status", "locator", "xml_id")


@query(f"""WITH {SECTIONS}, t AS (SELECT *, CASE WHEN status <> 'TEXT_ELEMENT_ABSENT' THEN '{{"attributes":[],"children":[],"locator":"' || locator || '/text[1]","tag":"text","tail":null,"text":' || CASE WHEN body = '' THEN 'null' ELSE to_json(body)::VARCHAR END || '}}' ELSE 'null' END AS structure FROM y)
SELECT doc_id::VARCHAR AS path, seq::INT AS seq, sha256('{{"original_heading":' || coalesce(to_json(heading)::VARCHAR, 'null') || ',"original_text":' || to_json(body)::VARCHAR || ',"source_section_code":' || coalesce(to_json(code)::VARCHAR, 'null') || ',"structured_content":' || structure || '}}') AS sha256, true AS again FROM t""")
def q_xml_section_hash(spark, d):
    """Structured nodes and canonical hashes by the parser, and the same hash once more from the stored fields."""
    rows = xml_documents.parsed(xml_files(spark, d)).where("error IS NULL").select("path", F.inline("sections"))
    c = F.col
    return rows.select("path", "seq", "sha256", (xml_documents.section_hash(c("heading"), c("text"), c("code"), c("structure")) == c("sha256")).alias("again"))


@query(f"""WITH {SECTIONS} SELECT doc_id::VARCHAR AS path, seq::INT AS seq, locator, 'x' || seq AS xml_id, NULL::VARCHAR AS error FROM y
UNION ALL SELECT doc_id::VARCHAR, seq::INT, locator, 'x' || seq, NULL FROM ({SECTIONS_OF_ODD})
UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, NULL, 'malformed_xml' FROM documents WHERE doc_id % 13 IN (5, 8)""")
def q_xml_section_ids(spark, d):
    """Sections' ids by the scan that builds no tree: also of documents whose header the parser refuses."""
    return xml_documents.section_ids(xml_files(spark, d))


@query("""SELECT doc_id::VARCHAR AS path, k::INT AS seq, 'Brand ' || (doc_id % 7) AS brand, 'TABLET' AS form, ['ORAL', 'TOPICAL'][k + 1] AS route FROM (SELECT doc_id, unnest(range(CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END)) AS k FROM documents WHERE doc_id % 13 NOT IN (5, 6, 7, 8))""")
def q_xml_products(spark, d):
    return xml_tables(spark, d)["products"].select("path", "seq", "brand", "form", "route")


_CONCEPT = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CODE_CONCEPTS.items()) + " END"


_STATUSES = f"""WITH {SECTIONS}, f AS (SELECT a.doc_id, {_CONCEPT.replace('code', 'a.code', 1)} AS concept, a.status = 'PRESENT' OR coalesce(b.status = 'PRESENT', false) AS filled FROM y a LEFT JOIN y b ON b.doc_id = a.doc_id AND b.parent_seq = a.seq),
g AS (SELECT doc_id, concept, bool_or(filled) AS filled FROM f WHERE concept IS NOT NULL GROUP BY ALL), e AS (SELECT doc_id, unnest([{', '.join(f"'{c}'" for c in CONCEPTS)}]) AS concept FROM documents WHERE doc_id % 13 NOT IN (5, 6, 7, 8))
SELECT e.doc_id::VARCHAR AS path, e.concept, CASE WHEN filled IS NULL THEN 'ABSENT' WHEN filled THEN 'PRESENT' ELSE 'PRESENT_EMPTY' END AS status FROM e LEFT JOIN g USING (doc_id, concept)"""


@query(_STATUSES)
def q_xml_statuses(spark, d):
    """Concept statuses: present if a mapped section or one below it has text."""
    return xml_tables(spark, d)["statuses"].select("path", "concept", "status")


@query(_STATUSES)
def q_xml_stored_statuses(spark, d):
    """The same statuses from the tables of sections and mappings, by intervals of the section tree."""
    parts = xml_tables(spark, d, keep=True)
    rows = xml_documents.stored_statuses(parts["documents"], parts["sections"], parts["mappings"])
    return rows.join(parts["documents"].select("document_id", "path"), "document_id").select("path", "concept", "status")


@query(f"""WITH {SECTIONS} SELECT doc_id::VARCHAR AS path, count(*) AS n_sections, count({_CONCEPT}) AS n_mapped, count(*) - count({_CONCEPT}) AS n_unmapped, count(*) FILTER (status = 'PRESENT_EMPTY') AS n_empty,
CASE WHEN count(*) = count({_CONCEPT}) AND count(*) FILTER (status = 'PRESENT_EMPTY') = 0 THEN 'FULLY_PARSED' ELSE 'PARSED_WITH_UNMAPPED_SECTIONS' END AS compatibility FROM y GROUP BY doc_id""")
def q_xml_compatibility(spark, d):
    """Mapped, unmapped and empty sections of each document, and what they say about the parser."""
    parts = xml_tables(spark, d, keep=True)
    mapped = parts["mappings"].select("section_id").distinct().withColumn("_m", F.lit(1))
    rows = parts["sections"].join(mapped, "section_id", "left").groupBy("path").agg(F.count(F.lit(1)).alias("n_sections"), F.count("_m").alias("n_mapped"), F.count_if(F.col("_m").isNull()).alias("n_unmapped"), F.count_if(F.col("status") == "PRESENT_EMPTY").alias("n_empty"))
    return rows.select("path", "n_sections", "n_mapped", "n_unmapped", "n_empty", rules.compatibility(F.col("n_unmapped"), F.col("n_empty")).alias("compatibility"))


@query(f"""WITH {SECTIONS} SELECT a.doc_id::VARCHAR AS path, a.seq::INT AS seq, b.locator AS parent_locator FROM y a JOIN y b ON b.doc_id = a.doc_id AND b.seq = a.parent_seq""")
def q_xml_parents(spark, d):
    """Parents by their stored ids."""
    parts = xml_tables(spark, d, keep=True)
    above = parts["sections"].select(F.col("section_id").alias("parent_id"), F.col("locator").alias("parent_locator"))
    return parts["sections"].join(above, "parent_id").select("path", "seq", "parent_locator")


# Lookups, histories, lists, raw documents


def lookup_bodies(spark: SparkSession, d: str) -> DataFrame:
    """(lookup_id, body) of every customer: their orders as records; of 11 in a row one each is no JSON, has no list, or has a record without title or with a boolean version."""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    meta = F.struct(F.concat(F.lit("S"), (o % 97).cast("string")).alias("setid"), o.cast("string").alias("spl_version"), F.when((k % 11 == 2) & (o % 3 == 0), None).otherwise(F.concat(F.lit("T "), "o_orderpriority")).alias("title"), F.date_format("o_orderdate", "MMM dd, yyyy").alias("published_date"), F.lower("o_orderpriority").alias("genericname"), F.when(o % 2 == 0, "x").alias("labeler"))
    rows = read(spark, d, "customer").join(read(spark, d, "orders"), k == F.col("o_custkey")).withColumn("m", meta)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(o.alias("o"), "m"))), lambda x: x["m"])
    whole = rows.groupBy("c_custkey").agg(listed.alias("data"), F.count(F.lit(1)).alias("n"))
    body = F.to_json(F.struct(F.struct((F.col("n") + k % 2).alias("total_elements")).alias("metadata"), "data"))
    body = F.when(k % 11 == 0, "no json").when(k % 11 == 1, '{"metadata":{}}').when(k % 11 == 3, F.replace(body, F.concat(F.lit('"spl_version":"'), F.col("data")[0]["spl_version"], F.lit('"')), F.lit('"spl_version":true'))).otherwise(body)
    return whole.select(k.cast("string").alias("lookup_id"), body.alias("body"))


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders), b AS (SELECT o_custkey, min(i) AS i FROM o WHERE o_custkey % 11 = 3 AND i = 0 OR o_custkey % 11 = 2 AND o_orderkey % 3 = 0 GROUP BY o_custkey)
SELECT c.o_custkey::VARCHAR AS lookup_id, CASE WHEN c.o_custkey % 11 = 0 THEN 'the response is not a JSON object' WHEN c.o_custkey % 11 = 1 THEN 'the response has no list of records' WHEN b.i IS NOT NULL THEN 'record ' || b.i || ' lacks ' || CASE c.o_custkey % 11 WHEN 3 THEN 'version' ELSE 'title' END END AS problem
FROM (SELECT DISTINCT o_custkey FROM orders) c LEFT JOIN b USING (o_custkey)""")
def q_lookup_problems(spark, d):
    """Validation of whole lookups: one malformed record fails all of it."""
    return files.lookup_problems(lookup_bodies(spark, d))


@query("""SELECT o_custkey::VARCHAR AS lookup_id, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INT AS "index", 'S' || (o_orderkey % 97) AS set_id, o_orderkey::VARCHAR AS version, 'T ' || o_orderpriority AS title, strftime(o_orderdate, '%b %d, %Y') AS published,
lower(o_orderpriority) AS generic_name, CASE WHEN o_orderkey % 2 = 0 THEN 'x' END AS labeler FROM orders WHERE o_custkey % 11 NOT IN (0, 1, 2, 3)""")
def q_candidate_rows(spark, d):
    """Records of good lookups with their typed fields."""
    rows = files.candidates(lookup_bodies(spark, d).where(F.col("lookup_id").cast("long") % 11 > 3))
    return rows.where("invalid IS NULL").select("lookup_id", "index", "set_id", "version", "title", "published", "generic_name", "labeler")


@query("SELECT o_custkey::VARCHAR AS lookup_id, o_custkey % 2 = 1 AND o_custkey % 11 NOT IN (0, 1) AS truncated FROM orders GROUP BY o_custkey")
def q_truncated(spark, d):
    """Lookups that state more elements than they have."""
    return files.truncated(lookup_bodies(spark, d))


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id::VARCHAR AS set_id, p::INT AS position, CASE WHEN user_id % 7 = 3 AND p = 0 AND n > 1 THEN lead(event_id) OVER (PARTITION BY user_id ORDER BY p) ELSE event_id END::VARCHAR AS version, CASE WHEN NOT (user_id % 7 = 1 AND p = 0) THEN strftime(ts, '%Y-%m-%d') END AS published,
CASE WHEN user_id % 7 = 1 THEN 'entry without date' WHEN user_id % 7 = 2 THEN 'other set id' WHEN user_id % 7 = 3 AND n > 1 THEN 'repeated version' END AS wrong FROM e""")
def q_history_rows(spark, d):
    """Histories: newest first, dates by one strict form, and what is wrong with a response."""
    u, c = F.col("user_id"), F.col
    events = relational.numbered(read(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")], "p")
    entry = F.struct(c("event_id").cast("string").alias("spl_version"), F.when((u % 7 == 1) & (c("p") == 0), F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "MMM dd, yyyy")).alias("published_date"))
    rows = events.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", entry.alias("e")))), lambda x: x["e"]).alias("h"))
    again = F.transform("h", lambda x, i: F.when((i == 0) & (u % 7 == 3) & (F.size("h") > 1), x.withField("spl_version", c("h")[1]["spl_version"])).otherwise(x))
    body = F.to_json(F.struct(F.struct(F.struct(F.when(u % 7 == 2, "other").otherwise(u.cast("string")).alias("setid")).alias("spl"), again.alias("history")).alias("data")))
    got = files.history(rows.select(u.cast("string").alias("lookup_id"), u.cast("string").alias("set_id"), body.alias("body")))
    return got.select("set_id", "position", "version", c("published").cast("string").alias("published"), "wrong")


def ranked_entries(spark: SparkSession, d: str) -> DataFrame:
    """Ranked lists of suppliers by nation: some ranks, names and metrics are wrong."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    rows = relational.numbered(read(spark, d, "supplier"), ["s_nationkey"], [k], "i").withColumn("i", F.col("i") + 1)
    rank = F.when((n == 3) & (F.col("i") == 2), F.lit("0")).when((n == 4) & (F.col("i") == 2), F.lit("1")).when((n == 5) & (F.col("i") == 1), F.lit("true")).otherwise(F.col("i").cast("string"))
    name = F.when((n == 6) & (F.col("i") == 2), " ").when((n == 7) & (F.col("i") <= 2), "Same Name").otherwise(F.col("s_name"))
    head = {x: F.lit("v") for x in ("schema_version", "jurisdiction", "dataset_name", "dataset_version", "metric", "source_reference", "source_status")}
    rows = rows.select(n.cast("string").alias("utilization_list_id"), rank.alias("rank_text"), rank.try_cast("int").alias("rank"), name.alias("ingredient_name"), F.when((n == 8) & (F.col("i") == 1), "many").otherwise(F.col("s_acctbal").cast("string")).alias("metric_value"), F.when(n == 9, "last").otherwise("2023").alias("measurement_year"))
    return rows.withColumns({**head, "normalized": text.normalized_name(F.col("ingredient_name"))})


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS i FROM supplier),
e AS (SELECT s_nationkey AS l, CASE WHEN s_nationkey = 3 AND i = 2 THEN 0 WHEN s_nationkey = 4 AND i = 2 THEN 1 WHEN s_nationkey = 5 AND i = 1 THEN NULL ELSE i END AS r, s_nationkey = 5 AND i = 1 AS flag, CASE WHEN s_nationkey = 6 AND i = 2 THEN '' WHEN s_nationkey = 7 AND i <= 2 THEN 'same name' ELSE lower(s_name) END AS n, s_nationkey = 8 AND i = 1 AS bad, s_nationkey = 9 AS y FROM s),
a AS (SELECT l, 'rank is not a positive number' AS problem, count(*) FILTER (r IS NULL OR r < 1) AS n FROM e GROUP BY l UNION ALL SELECT l, 'a boolean stands for a number', count(*) FILTER (flag) FROM e GROUP BY l UNION ALL SELECT l, 'name is missing', count(*) FILTER (n = '') FROM e GROUP BY l
UNION ALL SELECT l, 'metric is not a number', count(*) FILTER (bad) FROM e GROUP BY l UNION ALL SELECT l, 'year is not a number', count(*) FILTER (y) FROM e GROUP BY l UNION ALL SELECT l, 'repeated rank', (count(DISTINCT r) < count(*))::BIGINT FROM e GROUP BY l UNION ALL SELECT l, 'repeated name', (count(DISTINCT n) < count(*))::BIGINT FROM e GROUP BY l
UNION ALL SELECT l, 'ranks are not contiguous from 1', (NOT coalesce(min(r) = 1 AND max(r) = count(*), false))::BIGINT FROM e GROUP BY l)
SELECT l::VARCHAR AS utilization_list_id, problem, n FROM a WHERE n > 0""")
def q_list_problems(spark, d):
    """Validation of ranked lists: every rule and how many entries break it."""
    return files.list_problems(ranked_entries(spark, d))


@query("SELECT s_nationkey::VARCHAR AS utilization_list_id, count(*) AS n_entries FROM supplier GROUP BY s_nationkey")
def q_list_counts(spark, d):
    """Lists with the number of their entries, by a join as the store reads them."""
    rows = ranked_entries(spark, d)
    n = rows.groupBy("utilization_list_id").agg(F.count(F.lit(1)).alias("n_entries"))
    return rows.select("utilization_list_id").distinct().join(n, "utilization_list_id", "left")


def raw_rows(spark: SparkSession, d: str) -> DataFrame:
    """Raw documents with manifests; some are of another document, lack a field, or state another hash."""
    i = F.col("doc_id")
    body = F.coalesce("text", F.lit(""))
    digest = identity.sha256(body)
    own = {"authority": F.lit("A"), "provider": F.lit("P"), "jurisdiction": F.when(i % 9 == 1, None).otherwise("J"), "source_document_id": F.concat(F.lit("SET-"), F.when(i % 9 == 2, i + 1).otherwise(i).cast("string")), "source_version": F.lit("1"), "retrieved_at": F.lit("t"), "raw_sha256": F.when(i % 9 == 3, "xyz").otherwise(digest)}
    none = {"x": F.lit(None).cast("string")}
    made = F.when(i % 9 == 4, "[]").otherwise(files.manifest(own, none, none, none, none))
    content = F.when(i % 9 == 5, F.concat(body, F.lit("!"))).otherwise(body)
    return read(spark, d, "documents").select(F.concat(F.lit("SET-"), i.cast("string")).alias("set_id"), F.lit("1").alias("version"), digest.alias("raw_sha256"), content.cast("binary").alias("content"), made.alias("manifest"))


@query("""SELECT 'set-' || doc_id AS asked_set, CASE doc_id % 9 WHEN 1 THEN 'missing: jurisdiction' WHEN 2 THEN 'the manifest is another document''s' WHEN 3 THEN 'malformed hash' WHEN 4 THEN 'not a JSON object' WHEN 5 THEN 'the bytes do not have the recorded hash' WHEN 6 THEN 'source_not_found' END AS error FROM documents""")
def q_raw_resolve(spark, d):
    """Raw documents by set id, whatever its case, and the only version there is, with manifest and hash checked."""
    i = F.col("doc_id")
    asked = read(spark, d, "documents").select(F.concat(F.lit("set-"), i.cast("string")).alias("set_id"), F.when(i % 9 == 6, "2").cast("string").alias("version"))
    return files.resolved(raw_rows(spark, d), asked).select("asked_set", "error")


@query("""SELECT c_custkey, 'https://b/spls.json?drug_name=' || replace(url_encode(trim(c_name || ' & co')), '%20', '+') || '&page=1&pagesize=100' AS lookup, 'https://b/getFile.cfm?type=zip&setid=' || replace(url_encode(c_name), '%20', '+') || '&version=' || c_custkey AS archive FROM customer""")
def q_request_urls(spark, d):
    rows = read(spark, d, "customer")
    return rows.select("c_custkey", fetch.lookup_url("https://b", F.concat("c_name", F.lit(" & co "))).alias("lookup"), fetch.archive_url("https://b", F.col("c_name"), F.col("c_custkey").cast("string")).alias("archive"))


@query("SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey AND event_id = o_orderkey) THEN 'FOUND' ELSE 'NOT_IN_HISTORY' END AS state FROM orders")
def q_historical_version(spark, d):
    """Versions that are asked for must be in the history: semi and anti join."""
    asked = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("set_id"), F.col("o_orderkey").alias("version"))
    known = read(spark, d, "events").select(F.col("user_id").alias("set_id"), F.col("event_id").alias("version"))
    there = relational.having(asked, known, ["set_id", "version"]).select("o_orderkey", F.lit("FOUND").alias("state"))
    return there.union(relational.orphans(asked, known, ["set_id", "version"]).select("o_orderkey", F.lit("NOT_IN_HISTORY")))


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")))
def q_table_counts(spark, d):
    out = None
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        one = read(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n")
        out = one if out is None else out.union(one)
    return out


# Names


@query("SELECT doc_id, replace(lower(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))), 'ß', 'ss') AS folded, replace(lower(trim(regexp_replace(split_part(coalesce(text, ''), chr(10), 1), '\\s+', ' ', 'g'))), 'ß', 'ss') AS name FROM documents")
def q_folded_names(spark, d):
    """Headings by case folding, names by NFKC and case folding."""
    return spread(read(spark, d, "documents").select("doc_id", "text")).select("doc_id", text.heading(F.col("text")).alias("folded"), text.normalized_name(F.coalesce(F.substring_index("text", "\n", 1), F.lit(""))).alias("name"))


@query("""SELECT doc_id, len(w)::INT AS n, array_to_string(list_slice(w, 1, 5), '|') AS leading, sha256(array_to_string(w, '|')) AS words_sha256 FROM (SELECT doc_id, regexp_extract_all(replace(lower(coalesce(text, '')), 'ß', 'ss'), '[\\p{L}\\p{N}]+(?:[-''][\\p{L}\\p{N}]+)*|[<>]=?|=') AS w FROM documents)""")
def q_content_words(spark, d):
    """The tokens that content scores compare."""
    rows = spread(read(spark, d, "documents").select("doc_id", "text")).select("doc_id", text.words(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").alias("n"), joined(F.slice("w", 1, 5)).alias("leading"), identity.sha256(joined("w")).alias("words_sha256"))


@query(f"""SELECT p_partkey, concat_ws('; ', {', '.join(f"CASE WHEN p_partkey % {k + 2} = 0 THEN '{REJECTIONS[c]}' END" for k, c in enumerate(REJECTIONS))}) AS reasons FROM part""")
def q_rejection_reasons(spark, d):
    found = F.array_compact(F.array(*[F.when(F.col("p_partkey") % (k + 2) == 0, F.lit(c)) for k, c in enumerate(REJECTIONS)], F.lit("PRESCRIPTION_PRODUCT")))
    return read(spark, d, "part").select("p_partkey", F.array_join(rules.reasons(found), "; ").alias("reasons"))


@query("""SELECT n_nationkey, CASE WHEN count(s_suppkey) = 0 THEN 'NOT_FOUND' WHEN count(s_suppkey) > 1 THEN 'AMBIGUOUS' ELSE 'SELECTED' END AS status FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey""")
def q_lineage_status(spark, d):
    """Per key how many identities there are: none, one or several."""
    rows = read(spark, d, "nation").join(read(spark, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    n = F.count_distinct("s_suppkey")
    return rows.groupBy("n_nationkey").agg(F.when(n == 0, "NOT_FOUND").when(n > 1, "AMBIGUOUS").otherwise("SELECTED").alias("status"))


@query("""WITH t AS (SELECT *, 'Item ' || p_partkey || ' brand' || (p_partkey % 4) AS title FROM part WHERE p_partkey % 5 <> 0), h AS (SELECT * FROM t WHERE p_partkey % 4 = 3 AND p_size = 7),
w AS (SELECT 'S' || p_size AS s, p_partkey AS v FROM h ORDER BY p_partkey DESC LIMIT 1) SELECT CASE WHEN (SELECT count(*) FROM h) = 0 THEN 'NOT_FOUND' ELSE 'SELECTED' END AS status, (SELECT s FROM w) AS set_id, (SELECT v::VARCHAR FROM w) AS version""")
def q_single_label(spark, d):
    """Of the candidates whose title mentions a name, those with the brand; the newest version of the only set id."""
    k = F.col("p_partkey")
    rows = read(spark, d, "part").where((k % 5 != 0) & (F.col("p_size") == 7)).select(F.concat(F.lit("S"), "p_size").alias("set_id"), k.cast("string").alias("version"), F.concat(F.lit("Item "), k.cast("string"), F.lit(" brand"), (k % 4).cast("string")).alias("title"), F.lit("2020-01-01").alias("published"))
    return selection.single_label(rows, "item", "brand3").select("status", F.col("selected.set_id").alias("set_id"), F.col("selected.version").alias("version"))


# Batches


def states(spark: SparkSession, d: str) -> DataFrame:
    """Batch items: one per order, ranked within the customer."""
    k = F.col("o_orderkey")
    pick = lambda values, n: F.array(*map(F.lit, values))[(k % n).cast("int")]
    rows = relational.numbered(read(spark, d, "orders"), ["o_custkey"], [k], "i")
    return rows.select(k.alias("item"), F.col("o_custkey").alias("run"), (F.col("i") + 1).alias("rank"), pick(INGESTION, len(INGESTION)).alias("ingestion"))


INGESTION = ("PENDING", "FETCHED", "RAW_FETCH_FAILED", "INGESTED", "ALREADY_FETCHED", "PARSER_FAILED", "NOT_SELECTED", "ALREADY_INGESTED", "UNSUPPORTED_STRUCTURE", "DATABASE_FAILED", "RAW_HASH_CONFLICT")
_ITEMS = f"""i AS (SELECT o_orderkey AS item, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rank, [{', '.join(f"'{x}'" for x in INGESTION)}][o_orderkey % {len(INGESTION)} + 1] AS s FROM orders)"""


@query(f"""WITH {_ITEMS} SELECT item, 'fetch' AS stage FROM i WHERE s IN ('PENDING', 'RAW_FETCH_FAILED', 'RAW_HASH_CONFLICT') AND rank IN (1, 3, 5) UNION ALL SELECT item, 'ingest' FROM i WHERE s IN ('FETCHED', 'ALREADY_FETCHED', 'PARSER_FAILED', 'UNSUPPORTED_STRUCTURE', 'DATABASE_FAILED') UNION ALL SELECT item, 'verify' FROM i WHERE s IN ('INGESTED', 'ALREADY_INGESTED')""")
def q_stage_items(spark, d):
    """Items that each stage takes up, the first of given ranks only."""
    rows, out = states(spark, d), None
    for stage, ranks in (("fetch", (1, 3, 5)), ("ingest", None), ("verify", None)):
        one = batch.eligible(rows, stage, ranks).select("item", F.lit(stage).alias("stage"))
        out = one if out is None else out.union(one)
    return out


_SELECTIONS = ("SELECTED", *SELECTION_ERRORS)


@query(f"""WITH e AS (SELECT c_custkey, CASE WHEN c_custkey % 9 < 8 THEN [{', '.join(f"'{x}'" for x in _SELECTIONS)}][c_custkey % {len(_SELECTIONS)} + 1] ELSE 'PENDING' END AS selection FROM customer)
SELECT c_custkey, selection, CASE selection WHEN 'FETCH_FAILED' THEN 'LOOKUP_FAILED' WHEN 'METADATA_INVALID' THEN 'METADATA_INVALID' WHEN 'NO_CANDIDATE' THEN 'NO_CANDIDATE' WHEN 'PENDING' THEN 'PENDING' ELSE 'DISCOVERED' END AS discovery, CASE selection WHEN 'SELECTED' THEN 'PENDING' ELSE 'NOT_SELECTED' END AS ingestion,
CASE selection {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SELECTION_ERRORS.items())} END AS error FROM e""")
def q_initial_items(spark, d):
    """First states of batch items from what was decided; without a decision they are pending."""
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select("c_custkey", k.alias("discovery_id"))
    decided = rows.where(k % 9 < 8).select("discovery_id", F.array(*map(F.lit, _SELECTIONS))[(k % len(_SELECTIONS)).cast("int")].alias("status"))
    return batch.initial_items(rows, decided).select("c_custkey", "selection", "discovery", "ingestion", "error")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'PARSED_WITH_UNSUPPORTED_STRUCTURES' WHEN 1 THEN 'PARTIAL_PARSE' ELSE 'PARSER_FAILED' END AS compatibility, CASE o_orderkey % 4 WHEN 0 THEN 'UNSUPPORTED_STRUCTURE' WHEN 1 THEN 'DATABASE_FAILED' ELSE 'PARSER_FAILED' END AS ingestion FROM orders""")
def q_parser_failures(spark, d):
    category = F.array(*map(F.lit, ("unsupported_document_structure", "database_failure", "malformed_xml", "other")))[(F.col("o_orderkey") % 4).cast("int")]
    return read(spark, d, "orders").select("o_orderkey", rules.parser_failure(category).alias("f")).select("o_orderkey", "f.*")


@query("""SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, count(*) AS tries FROM events WHERE event_type IN ('error', 'click', 'view') GROUP BY user_id""")
def q_lookup_failures(spark, d):
    """Replaced rows: of a log of failures the last one of each key, and how many there were."""
    rows = read(spark, d, "events").where(F.col("event_type").isin("error", "click", "view"))
    last = relational.latest(rows, ["user_id"], ["ts", "event_id"], ["event_id"])
    return last.join(rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("tries")), "user_id")


@query("""WITH r AS (SELECT o_custkey AS run, sum(o_totalprice > 1000) AS n, list({'k': o_orderkey, 'p': o_orderpriority} ORDER BY o_orderkey) AS items FROM orders GROUP BY o_custkey),
j AS (SELECT run, '{"batch_run":{"canonical_report_sha256":null,"completed_at":null,"run_id":' || run || ',"started_at":null,"total":' || len(items) || '},"generated_at":null,"items":[' || array_to_string(list_transform(items, lambda x: '{"priority":' || to_json(x.p)::VARCHAR || ',"rank":' || x.k || '}'), ',') || ']}' AS canonical FROM r)
SELECT run, canonical, sha256(canonical) AS sha256 FROM j""")
def q_report_artifact(spark, d):
    """Canonical reports: nested, keys sorted, items by rank, without what says when they were made."""
    c = F.col
    items = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda x: identity.fields(rank=x["o_orderkey"], priority=x["o_orderpriority"]))
    rows = read(spark, d, "orders").groupBy(c("o_custkey").alias("run")).agg(items.alias("items"), F.min("o_orderdate").cast("string").alias("at"))
    own = identity.fields(run_id=c("run"), started_at=c("at"), completed_at=c("at"), canonical_report_sha256=F.lit("old"), total=F.size("items"))
    payload = identity.fields(generated_at=c("at"), batch_run=own, items=c("items"))
    return rows.select("run", identity.rendered(identity.steady(payload, "report")).alias("canonical")).withColumn("sha256", identity.sha256(c("canonical")))


# Diffs


def header_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Documents and their successors by id as two sides with the ten compared fields; every 17th lacks a side."""
    i = F.col("doc_id")
    docs = read(spark, d, "documents")
    side = lambda s, k: docs.select(k.alias("pair"), F.when(i % 17 != (3 if s == "old" else 4), i.cast("string")).alias(f"{s}_document_id"), F.floor(i / 2).cast("string").alias(f"{s}_document_root"), F.date_add(F.lit("2020-01-01").cast("date"), (F.floor(i / 3) % 9).cast("int")).alias(f"{s}_effective"), F.col("source").alias(f"{s}_doc_type"), F.col("lang").alias(f"{s}_language"), F.concat(F.lit("T"), (i % 2).cast("string")).alias(f"{s}_title"), F.when(i % 4 < 2, "g").alias(f"{s}_generic_name"), F.array(F.lit("b"), F.floor(i / 5).cast("string")).alias(f"{s}_brands"), F.array(F.lit("f")).alias(f"{s}_forms"), F.array().cast("array<string>").alias(f"{s}_routes"), F.array("lang").alias(f"{s}_ingredients"))
    return side("old", i + 1).join(side("new", i), "pair")


_FIELDS = {"source_instance_id": "(i // 2)::VARCHAR", "effective_date": "strftime(DATE '2020-01-01' + (i // 3 % 9)::INT, '%Y-%m-%d')", "document_type": "source", "language": "lang", "title": "'T' || (i % 2)", "generic_name": "CASE WHEN i % 4 < 2 THEN 'g' END", "brand_names": "'[\"b\",\"' || (i // 5) || '\"]'", "active_ingredients": "'[' || to_json(lang)::VARCHAR || ']'"}
_HEADS = "h AS (SELECT doc_id AS i, " + ", ".join(f"{sql} AS {name}" for name, sql in _FIELDS.items()) + " FROM documents)"


@query(f"""WITH {_HEADS} {' UNION ALL '.join(f"SELECT b.i AS pair, '{name}' AS field, a.{name} AS old_value, b.{name} AS new_value FROM h a JOIN h b ON b.i = a.i + 1 WHERE a.{name} IS DISTINCT FROM b.{name} AND a.i % 17 <> 3 AND b.i % 17 <> 4" for name in _FIELDS)}""")
def q_header_changes(spark, d):
    """Ten fields of the header compared; none where a side is missing."""
    pairs = header_pairs(spark, d)
    return diff.metadata_changes(pairs, "pair").select("pair", F.inline("changes"))


@query(f"""WITH {_HEADS}, p AS (SELECT b.i AS pair, a.i % 17 <> 3 AS o, b.i % 17 <> 4 AS n, {' OR '.join(f'a.{name} IS DISTINCT FROM b.{name}' for name in _FIELDS)} AS differ FROM h a JOIN h b ON b.i = a.i + 1),
q AS (SELECT pair, concat_ws('|', CASE WHEN NOT o AND n THEN 'DOCUMENT_ADDED' END, CASE WHEN o AND NOT n THEN 'DOCUMENT_REMOVED' END, CASE WHEN pair % 3 = 0 THEN 'SECTION_MODIFIED' END, CASE WHEN o AND n AND differ THEN 'DOCUMENT_METADATA_CHANGED' END) AS operations FROM p)
SELECT pair, CASE WHEN operations = '' THEN 'NO_CHANGE' ELSE operations END AS operations FROM q""")
def q_whole_operations(spark, d):
    """Operations of whole diffs: the document's own and its sections', in report order."""
    pairs = header_pairs(spark, d)
    rows = pairs.select("pair", F.col("old_document_id").isNotNull().alias("o"), F.col("new_document_id").isNotNull().alias("n")).join(diff.metadata_changes(pairs, "pair"), "pair")
    sections = F.when(F.col("pair") % 3 == 0, F.array(F.lit("SECTION_MODIFIED"), F.lit("NO_CHANGE"))).otherwise(F.array(F.lit("NO_CHANGE")))
    return rows.select("pair", joined(diff.whole_operations(F.col("o"), F.col("n"), F.size("changes") > 0, sections)).alias("operations"))


@query(r"""WITH p AS (SELECT lag(text) OVER w AS a, text AS b, doc_id AS new_doc FROM documents WINDOW w AS (PARTITION BY split_part(text, chr(10), 1) ORDER BY doc_id) QUALIFY a IS NOT NULL)
SELECT new_doc, sha256(trim(regexp_replace(a, '\s+', ' ', 'g'))) AS old_sha256, sha256(trim(regexp_replace(b, '\s+', ' ', 'g'))) AS new_sha256 FROM p WHERE a <> b AND (trim(a) <> '' OR trim(b) <> '')""")
def q_text_round_trip(spark, d):
    """Both texts come back from the word chunks of their diff: context and deletions, context and additions."""
    pairs = document_pairs(spark, d, "text").where("old_text <> new_text").repartition("new_doc")
    chunks = textdiff.text_chunks(pairs, ["new_doc"])
    side = lambda gone: identity.sha256(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("operation") != gone, F.struct("position", "text")))), lambda x: x["text"]), " "))
    return chunks.groupBy("new_doc").agg(side("ADDITION").alias("old_sha256"), side("DELETION").alias("new_sha256"))


@query(f"""WITH {META}, l AS (SELECT new_doc, old_source, new_source, string_split(old_text, chr(10)) AS a, string_split(new_text, chr(10)) AS b FROM p WHERE old_text IS NOT NULL AND new_text IS NOT NULL),
k AS (SELECT new_doc, a, b, unnest(range(greatest(len(a), len(b)))) AS k FROM l)
SELECT new_doc, '' AS path, 'CHANGED' AS change FROM l WHERE old_source IS DISTINCT FROM new_source
UNION ALL SELECT new_doc, '/' || k, CASE WHEN k >= len(a) THEN 'ADDED' ELSE 'REMOVED' END FROM k WHERE k >= least(len(a), len(b))
UNION ALL SELECT new_doc, '/' || k || '/0', 'CHANGED' FROM k WHERE k < least(len(a), len(b)) AND a[k + 1] <> b[k + 1]""")
def q_changed_paths(spark, d):
    """Where the structures of consecutive versions differ: a tree of each, its lines two levels below the root."""
    node = lambda tag, said, children, name: F.struct(F.array(F.array(F.lit("name"), name)).alias("attributes"), children.alias("children"), F.lit(tag).alias("tag"), F.lit(None).cast("string").alias("tail"), said.alias("text"))
    none, nobody = F.lit(None).cast("string"), F.array().cast("array<string>")
    tree = lambda s: F.to_json(node("document", none, F.transform(F.split(f"{s}_text", "\n"), lambda x: node("p", none, F.array(node("line", x, nobody, none)), none)), F.col(f"{s}_source")), {"ignoreNullFields": "false"})
    pairs = document_pairs(spark, d, "text", "source").where("old_text IS NOT NULL AND new_text IS NOT NULL")
    return structure.changed_paths(pairs.select("new_doc", tree("old").alias("old"), tree("new").alias("new")), ["new_doc"])


@query("""WITH e AS (SELECT user_id, event_id, event_type, ts FROM events), s AS (SELECT user_id, event_type, max_by(event_id, (ts, event_id)) AS h FROM e WHERE event_id % 4 <> 0 GROUP BY ALL),
j AS (SELECT e.event_id, s.h, CASE WHEN e.event_id % 3 = 0 THEN e.event_id * 2 END AS sel FROM e LEFT JOIN s USING (user_id, event_type))
SELECT event_id, coalesce(h, sel) AS published, CASE WHEN h IS NOT NULL THEN 'DAILYMED_HISTORY' WHEN sel IS NOT NULL THEN 'SELECTION_METADATA' END AS published_source, coalesce(h <> sel, false) AS disagrees FROM j""")
def q_publication(spark, d):
    """Publication of a version: of the newest history that has it, else of the selection; and whether they disagree."""
    e = read(spark, d, "events")
    documents = e.select(F.col("event_id").alias("document_id"), F.col("user_id").alias("lineage_id"), F.col("event_type").alias("version"))
    snapshots = e.where("event_id % 4 <> 0").select(F.col("user_id").alias("lineage_id"), F.col("event_type").alias("version"), F.col("event_id").alias("published"), F.col("ts").alias("retrieved_at"), F.col("event_id").alias("snapshot_id"))
    selected = e.where("event_id % 3 = 0").select(F.col("event_id").alias("document_id"), (F.col("event_id") * 2).alias("published"))
    return lineage.publication(documents, snapshots, selected).select(F.col("document_id").alias("event_id"), "published", "published_source", "disagrees")


@query("""WITH l AS (SELECT l_orderkey AS pair, CASE WHEN l_linenumber % 3 <> 1 THEN l_partkey END AS o, CASE WHEN l_linenumber % 3 <> 2 THEN l_suppkey END AS n, l_linenumber FROM lineitem)
SELECT pair, l_linenumber, row_number() OVER (PARTITION BY pair ORDER BY coalesce(n, o), CASE WHEN n IS NULL THEN 1 ELSE 0 END, coalesce(o, -1), l_linenumber) - 1 AS "index" FROM l""")
def q_match_order(spark, d):
    """Output order of matched, added and removed sections."""
    n = F.col("l_linenumber")
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("pair"), F.when(n % 3 != 1, F.col("l_partkey")).alias("o"), F.when(n % 3 != 2, F.col("l_suppkey")).alias("n"), "l_linenumber")
    order = [F.coalesce("n", "o"), F.when(F.col("n").isNull(), 1).otherwise(0), F.coalesce("o", F.lit(-1)), F.col("l_linenumber")]
    return relational.numbered(rows, ["pair"], order, "index").select("pair", "l_linenumber", F.col("index").cast("long").alias("index"))


def line_sides(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each conversation's user (old) and assistant (new) turns as sections to compare."""
    rows = read(spark, d, "conversations").where(F.col("role").isin("user", "assistant")).select(F.col("conv_id").alias("pair_id"), F.when(F.col("role") == "user", "old").otherwise("new").alias("side"), "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("k", "line"))
    rows = rows.select("pair_id", "side", (F.col("turn") * 100_000 + F.col("k")).alias("section_id"), text.words(F.col("line")).alias("_t"), F.lit(0).alias("depth"))
    return rows.withColumn("_n", F.size("_t")).where("_n > 0")


@query("""WITH w AS (SELECT conv_id AS pair_id, role, turn * 100000 + k - 1 AS section_id, regexp_extract_all(replace(lower(line), 'ß', 'ss'), '[\\p{L}\\p{N}]+(?:[-''][\\p{L}\\p{N}]+)*|[<>]=?|=') AS t
  FROM (SELECT conv_id, role, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM conversations WHERE role IN ('user', 'assistant'))),
c AS (SELECT pair_id, role, section_id, len(t) AS n, tok, count(*) AS k FROM (SELECT *, unnest(t) AS tok FROM w) GROUP BY ALL)
SELECT o.pair_id, o.section_id AS old_id, n.section_id AS new_id, sum(least(o.k, n.k))::BIGINT AS common FROM c o JOIN c n ON o.pair_id = n.pair_id AND o.tok = n.tok AND o.role = 'user' AND n.role = 'assistant'
GROUP BY o.pair_id, o.section_id, n.section_id, o.n, n.n HAVING 2 * sum(least(o.k, n.k)) >= 0.25 * (o.n + n.n)""")
def q_content_candidates(spark, d):
    """Sections whose common tokens reach a quarter of both: found by the prefix filter, then counted."""
    rows = line_sides(spark, d)
    found = matching.content_candidates(rows, 0.25)
    counts = rows.select("pair_id", "side", "section_id", "_n", F.explode("_t").alias("tok")).groupBy("pair_id", "side", "section_id", "_n", "tok").agg(F.count(F.lit(1)).alias("k"))
    side = lambda s: counts.where(F.col("side") == s).select("pair_id", F.col("section_id").alias(f"{s}_id"), "tok", F.col("k").alias(f"{s}_k"), F.col("_n").alias(f"{s}_n"))
    both = found.join(side("old"), ["pair_id", "old_id"]).join(side("new"), ["pair_id", "new_id", "tok"])
    whole = both.groupBy("pair_id", "old_id", "new_id", "old_n", "new_n").agg(F.sum(F.least("old_k", "new_k")).alias("common"))
    return whole.where("2 * common >= 0.25 * (old_n + new_n)").select("pair_id", "old_id", "new_id", "common")
