"""One query per operator over the driver's tables, with its DuckDB SQL.

Stand-ins: documents are label versions (a lineage is the documents that share a first line, in order of doc_id), their
lines are sections; orders are candidates of customers; events are histories of users; conversations are documents with
coded sections. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labeldiff.functions import identity, rules, text
from labeldiff.operators import batch, diff, lineage, matching, relational, selection, store, textdiff
from labeldiff.scratch import held
from labeldiff.values import CODE_CONCEPTS, HEADING_CONCEPTS, OPERATIONS

FLAGSHIP = "q_diff_summary"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from labeldiff import document_queries  # noqa: F401  registers its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """A scan's rows for work that costs far more than moving them: dealt anew where the scan has fewer tasks than there are cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() > cores else rows.repartition(cores)


def joined(column: Column | str) -> Column:
    return F.array_join(column, "|")


# Searches and joins


@query("""SELECT DISTINCT s_suppkey AS id, s_name AS name, n_name AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE contains(lower(s_name), 'r#00000001') OR contains(lower(n_name), 'r#00000001') OR contains(lower(s_name), '7')""")
def q_search(spark, d):
    rows = read(spark, d, "supplier").join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("nation"))
    found = relational.search(rows, "R#00000001", ["name", "nation"], rows.columns)
    return found.union(relational.search(rows, "7", ["name"], rows.columns)).distinct()


@query("""SELECT DISTINCT c_custkey AS lineage FROM customer LEFT JOIN orders ON c_custkey = o_custkey
WHERE contains(lower(c_mktsegment), 'uto') OR contains(lower(o_orderpriority), '1-u') OR lower(c_name) = 'customer#000000007'""")
def q_lineage_search(spark, d):
    rows = read(spark, d, "customer").join(read(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    hit = relational.any_mention([F.col("c_mktsegment")], "UTO") | relational.any_mention([F.col("o_orderpriority")], "1-U") | (F.lower("c_name") == "customer#000000007")
    return rows.where(hit).select(F.col("c_custkey").alias("lineage")).distinct()


@query("SELECT doc_id, lang FROM documents WHERE EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def q_section_filter_semi(spark, d):
    return relational.having(read(spark, d, "documents").select("doc_id", "lang"), read(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL AND toxic IS NULL AND labels.doc_id IS NULL")
def q_orphan_anti(spark, d):
    return relational.orphans(read(spark, d, "documents").select("doc_id", "lang"), read(spark, d, "labels"), ["doc_id"])


@query("""WITH s AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS doc, l_partkey AS part FROM lineitem),
k AS (SELECT id, doc, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 101 = 0 THEN (part % 100 + 1) * 10 + 1 ELSE doc * 10 + 1 END AS parent FROM s)
SELECT c.id, c.doc, c.parent FROM k c JOIN k p ON c.parent = p.id WHERE c.doc <> p.doc""")
def q_cross_parent(spark, d):
    rows = read(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("part"))
    parent = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 101 == 0, (F.col("part") % 100 + 1) * 10 + 1).otherwise(F.col("doc") * 10 + 1)
    return relational.foreign_parents(rows.select("id", "doc", parent.alias("parent")), "id", "parent", "doc")


@query("""SELECT n_name AS list, c_custkey AS ingredient, o_orderkey AS discovery, l_linenumber AS candidate, l_partkey AS set_id
FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey""")
def q_candidate_audit(spark, d):
    rows = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("n_name").alias("list"), F.col("c_custkey").alias("ingredient"), F.col("o_orderkey").alias("discovery"), F.col("l_linenumber").alias("candidate"), F.col("l_partkey").alias("set_id"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def q_latest_snapshot(spark, d):
    return relational.latest(read(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "ts", "event_type"])


@query("""SELECT o_custkey, o_orderpriority, count(*) AS n, CASE WHEN count(*) = 1 THEN min(o_orderkey) END AS o_orderkey,
CASE WHEN count(*) = 1 THEN 'FOUND' ELSE 'AMBIGUOUS' END AS status FROM orders GROUP BY ALL""")
def q_version_resolution(spark, d):
    return relational.resolved(read(spark, d, "orders"), ["o_custkey", "o_orderpriority"], "o_orderkey")


# Version pairs of documents


def lineages(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a predecessor in their lineage. Only ids and the first line's hash go through the window; texts follow by id."""
    docs = read(spark, d, "documents")
    narrow = docs.select("doc_id", F.sha2(F.substring_index("text", "\n", 1).cast("binary"), 256).alias("lineage_id"))
    return lineage.edges(narrow, "lineage_id", [F.col("doc_id")], ["doc_id"]).select("lineage_id", F.col("old_doc_id").alias("old_doc"), F.col("doc_id").alias("new_doc"))


PAIRS = """pairs AS (
  SELECT sha256(split_part(text, chr(10), 1)) AS lineage_id, lag(doc_id) OVER (PARTITION BY split_part(text, chr(10), 1) ORDER BY doc_id) AS old_doc, doc_id AS new_doc
  FROM documents QUALIFY old_doc IS NOT NULL),
sides AS (
  SELECT new_doc AS pair_id, 'old' AS side, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS seq FROM pairs JOIN documents ON doc_id = old_doc
  UNION ALL
  SELECT new_doc, 'new', unnest(string_split(text, chr(10))), unnest(range(len(string_split(text, chr(10))))) FROM pairs JOIN documents ON doc_id = new_doc)"""


def sides(spark: SparkSession, d: str) -> DataFrame:
    """Lines of both documents of every pair: pair_id (the new document), side, seq, line."""
    pairs, docs = lineages(spark, d), read(spark, d, "documents").select("doc_id", "text")
    both = pairs.select(F.col("new_doc").alias("pair_id"), F.inline(F.array(F.struct(F.lit("old").alias("side"), F.col("old_doc").alias("doc_id")), F.struct(F.lit("new").alias("side"), F.col("new_doc").alias("doc_id")))))
    return both.join(docs, "doc_id").select("pair_id", "side", F.posexplode(F.split("text", "\n")).alias("seq", "line"))


@query(f"""WITH {PAIRS}, u AS (SELECT pair_id, line, count(*) FILTER (side = 'old') AS o, count(*) FILTER (side = 'new') AS n, min(seq) FILTER (side = 'old') AS old_seq, min(seq) FILTER (side = 'new') AS new_seq FROM sides GROUP BY ALL)
SELECT pair_id, old_seq::INT AS old_seq, new_seq::INT AS new_seq FROM u WHERE o = 1 AND n = 1""")
def q_unique_key_match(spark, d):
    """One exact phase as a single aggregate: a line that both sides hold once."""
    old, new = F.col("side") == "old", F.col("side") == "new"
    keyed = sides(spark, d).groupBy("pair_id", "line").agg(F.count_if(old).alias("o"), F.count_if(new).alias("n"), F.min(F.when(old, F.col("seq"))).alias("old_seq"), F.min(F.when(new, F.col("seq"))).alias("new_seq"))
    return keyed.where("o = 1 AND n = 1").select("pair_id", "old_seq", "new_seq")


HEAD = "regexp_extract({0}, '^[^ ]* ?[^ ]*', 0)"


def phased(spark: SparkSession, d: str) -> DataFrame:
    rows = sides(spark, d).withColumn("section_id", F.col("seq")).withColumn("head", F.regexp_extract("line", "^[^ ]* ?[^ ]*", 0))
    return matching.exact_phases(rows, {"XML_IDENTIFIER": F.col("line"), "SECTION_CODE": F.nullif("head", F.lit("")), "SOURCE_LOCATOR": F.col("seq").cast("string")})


PHASES = f"""{PAIRS}, base AS (SELECT *, {HEAD.format('line')} AS head FROM sides),
u1 AS (SELECT pair_id, line AS k, min(seq) FILTER (side = 'old') AS o, min(seq) FILTER (side = 'new') AS n FROM base GROUP BY ALL HAVING count(*) FILTER (side = 'old') = 1 AND count(*) FILTER (side = 'new') = 1),
r1 AS (SELECT b.* FROM base b WHERE NOT EXISTS (SELECT 1 FROM u1 WHERE u1.pair_id = b.pair_id AND b.seq = CASE b.side WHEN 'old' THEN u1.o ELSE u1.n END)),
u2 AS (SELECT pair_id, head AS k, min(seq) FILTER (side = 'old') AS o, min(seq) FILTER (side = 'new') AS n FROM r1 WHERE head <> '' GROUP BY ALL HAVING count(*) FILTER (side = 'old') = 1 AND count(*) FILTER (side = 'new') = 1),
r2 AS (SELECT b.* FROM r1 b WHERE NOT EXISTS (SELECT 1 FROM u2 WHERE u2.pair_id = b.pair_id AND b.seq = CASE b.side WHEN 'old' THEN u2.o ELSE u2.n END)),
u3 AS (SELECT pair_id, seq AS k, min(seq) FILTER (side = 'old') AS o, min(seq) FILTER (side = 'new') AS n FROM r2 GROUP BY ALL HAVING count(*) FILTER (side = 'old') = 1 AND count(*) FILTER (side = 'new') = 1),
r3 AS (SELECT b.* FROM r2 b WHERE NOT EXISTS (SELECT 1 FROM u3 WHERE u3.pair_id = b.pair_id AND u3.k = b.seq)),
outcome AS (
  SELECT pair_id, o AS old_id, n AS new_id, 'XML_IDENTIFIER' AS method, 'EXACT' AS status FROM u1 UNION ALL
  SELECT pair_id, o, n, 'SECTION_CODE', 'EXACT' FROM u2 UNION ALL SELECT pair_id, o, n, 'SOURCE_LOCATOR', 'EXACT' FROM u3 UNION ALL
  SELECT pair_id, CASE side WHEN 'old' THEN seq END, CASE side WHEN 'new' THEN seq END, 'UNMATCHED', 'UNMATCHED' FROM r3)"""


@query(f"WITH {PHASES} SELECT pair_id, old_id::INT AS old_id, new_id::INT AS new_id, method, status FROM outcome")
def q_match_phases(spark, d):
    return matching.outcomes(phased(spark, d))


def line_sections(spark: SparkSession, d: str) -> DataFrame:
    """Lines as sections for the whole matcher: ids that name the document, so the first phase does not fire within other documents."""
    rows = sides(spark, d)
    return rows.select(
        "pair_id", "side", F.concat("side", F.lit(":"), "seq").alias("section_id"), F.lit(None).cast("string").alias("parent_id"), "seq",
        F.sha2(F.col("line").cast("binary"), 256).alias("xml_id"), F.lit(None).cast("string").alias("code"), F.concat(F.lit("/line["), "seq", F.lit("]")).alias("locator"),
        F.regexp_extract("line", "^[^ ]* ?[^ ]*", 0).alias("heading"), F.lit(0).alias("depth"), F.col("line").alias("text"),
    )


@query()
def q_match_content(spark, d):
    """All six phases, the content phase included (its ratio has no SQL); the methods of all sections."""
    return matching.outcomes(matching.match_sections(line_sections(spark, d), held, ["pair_id", "side", "section_id"]))


@query(f"""WITH {PHASES}, toks AS (SELECT pair_id, side, seq, list_distinct(list_filter(string_split(lower(line), ' '), lambda x: x <> '')) AS t FROM r2),
scores AS (
  SELECT o.pair_id, o.seq AS old_id, n.seq AS new_id, round(len(list_intersect(o.t, n.t)) / len(list_distinct(list_concat(o.t, n.t))), 6) AS score
  FROM toks o JOIN toks n ON o.pair_id = n.pair_id AND o.side = 'old' AND n.side = 'new' AND len(list_intersect(o.t, n.t)) > 0),
ranked AS (
  SELECT *, row_number() OVER a AS ro, row_number() OVER b AS rn, lead(score) OVER a AS so, lead(score) OVER b AS sn FROM scores WHERE score >= 0.2
  WINDOW a AS (PARTITION BY pair_id, old_id ORDER BY score DESC, new_id), b AS (PARTITION BY pair_id, new_id ORDER BY score DESC, old_id))
SELECT pair_id, old_id::INT AS old_id, new_id::INT AS new_id, score FROM ranked WHERE ro = 1 AND rn = 1 AND (so IS NULL OR score - so >= 0.03) AND (sn IS NULL OR score - sn >= 0.03)""")
def q_mutual_best(spark, d):
    """Mutual best with margin among lines that the first two phases leave over; the score is the share of common words."""
    rows = phased(spark, d).where(F.col("partner").isNull() | (F.col("method") == "SOURCE_LOCATOR"))
    toks = rows.select("pair_id", "side", "seq", F.array_distinct(F.filter(F.split(F.lower("line"), " "), lambda x: x != "")).alias("t"))
    old, new = (toks.where(F.col("side") == s).select("pair_id", F.col("seq").alias(f"{s}_id"), F.col("t").alias(s)) for s in ("old", "new"))
    score = F.round(F.size(F.array_intersect("old", "new")) / F.size(F.array_union("old", "new")), 6)
    scores = old.join(new, "pair_id").where(F.arrays_overlap("old", "new")).select("pair_id", "old_id", "new_id", score.alias("score")).where("score >= 0.2")
    return matching.mutual_best(scores)


@query(f"""WITH {PHASES}, m AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY old_id) AS a, row_number() OVER (PARTITION BY pair_id ORDER BY new_id) AS b FROM outcome WHERE status = 'EXACT')
SELECT pair_id, old_id::INT AS old_id, new_id::INT AS new_id, a <> b AS moved FROM m""")
def q_moved_rank(spark, d):
    rows = matching.outcomes(phased(spark, d)).where("status = 'EXACT'")
    return diff.rank_moves(rows, ["pair_id"], "old_id", "new_id").select("pair_id", "old_id", "new_id", F.col("reordered").alias("moved"))


OPS = f"""{PHASES}, m AS (
  SELECT o.*, a.line AS old_line, b.line AS new_line, a.head AS old_head, b.head AS new_head FROM outcome o
  LEFT JOIN base a ON a.pair_id = o.pair_id AND a.side = 'old' AND a.seq = o.old_id LEFT JOIN base b ON b.pair_id = o.pair_id AND b.side = 'new' AND b.seq = o.new_id),
k AS (SELECT *, CASE WHEN status = 'EXACT' THEN row_number() OVER (PARTITION BY pair_id, status ORDER BY old_id) <> row_number() OVER (PARTITION BY pair_id, status ORDER BY new_id) END AS moved FROM m),
ops AS (
  SELECT pair_id, old_id, new_id, method, status, concat_ws('|', CASE WHEN old_id IS NULL THEN 'SECTION_ADDED' END, CASE WHEN new_id IS NULL THEN 'SECTION_REMOVED' END,
    CASE WHEN status = 'EXACT' AND old_line <> new_line THEN 'SECTION_MODIFIED' END, CASE WHEN moved THEN 'SECTION_MOVED' END, CASE WHEN status = 'EXACT' AND old_head <> new_head THEN 'SECTION_RENAMED' END,
    CASE WHEN status = 'EXACT' AND contains(old_line, '!') <> contains(new_line, '!') THEN 'SECTION_MAPPING_CHANGED' END,
    CASE WHEN status = 'EXACT' AND old_line = new_line AND NOT moved THEN 'NO_CHANGE' END) AS operations FROM k)"""


def digested(spark: SparkSession, d: str) -> DataFrame:
    """``phased`` without texts: line and head are SHA-256 digests, ``bang`` tells whether the line has a "!". What is compared leaves the scan as digests, so no text is shuffled or sorted."""
    pairs, docs = lineages(spark, d), read(spark, d, "documents")
    digest = lambda x: F.unhex(F.sha2(x.cast("binary"), 256))
    head = lambda x: F.nullif(F.regexp_extract(x, "^[^ ]* ?[^ ]*", 0), F.lit(""))
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(digest(x).alias("line"), digest(head(x)).alias("head"), F.contains(x, F.lit("!")).alias("bang")))
    both = pairs.select(F.col("new_doc").alias("pair_id"), F.inline(F.array(F.struct(F.lit("old").alias("side"), F.col("old_doc").alias("doc_id")), F.struct(F.lit("new").alias("side"), F.col("new_doc").alias("doc_id")))))
    rows = both.join(docs.select("doc_id", lines.alias("lines")), "doc_id").select("pair_id", "side", F.posexplode("lines").alias("seq", "x")).select("pair_id", "side", "seq", "x.*", F.col("seq").alias("section_id"))
    return matching.exact_phases(rows, {"XML_IDENTIFIER": F.col("line"), "SECTION_CODE": F.col("head"), "SOURCE_LOCATOR": F.col("seq").cast("string")})


def section_rows(spark: SparkSession, d: str) -> DataFrame:
    """Outcome of every section with its operations; the stand-in for mapped concepts is whether the line has a "!"."""
    rows = digested(spark, d)
    # Matched rows carry the other side's values through a window in the partitioning they are in.
    own = Window.partitionBy("pair_id", "_key")
    key = F.when(F.col("partner").isNotNull(), F.struct(F.lit(0).alias("z"), F.when(F.col("side") == "old", F.col("seq")).otherwise(F.col("partner")).alias("o"))).otherwise(F.struct(F.when(F.col("side") == "old", 1).otherwise(2).alias("z"), F.col("seq").alias("o")))
    rows = rows.withColumn("_key", key)
    side = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c))).over(own)
    both = rows.select("pair_id", "side", "partner", F.coalesce("method", F.lit("UNMATCHED")).alias("method"), *[side(s, c).alias(f"{s}_{c}") for s in ("old", "new") for c in ("seq", "line", "head", "bang")])
    one = both.where((F.col("side") == "old") | F.col("partner").isNull())
    exact = F.col("partner").isNotNull()
    matched = diff.rank_moves(one.withColumn("_m", exact), ["pair_id", "_m"], "old_seq", "new_seq")
    # A blank head has no digest.
    renamed = ~F.col("old_head").eqNullSafe(F.col("new_head"))
    ops = diff.operations(F.col("old_seq").isNotNull(), F.col("new_seq").isNotNull(), F.col("old_line") != F.col("new_line"), F.col("reordered"), renamed, F.col("old_bang") != F.col("new_bang"))
    return matched.select("pair_id", F.col("old_seq").alias("old_id"), F.col("new_seq").alias("new_id"), "method", F.when(exact, "EXACT").otherwise("UNMATCHED").alias("status"), ops.alias("operations"))


@query(f"WITH {OPS} SELECT pair_id, old_id::INT AS old_id, new_id::INT AS new_id, method, status, operations FROM ops")
def q_section_ops(spark, d):
    return section_rows(spark, d).withColumn("operations", joined("operations"))


@query(f"""WITH {OPS} SELECT pair_id, count(*) AS sections, count(*) FILTER (status = 'EXACT') AS matched, count(*) FILTER (status <> 'EXACT') AS unmatched,
{', '.join(f"count(*) FILTER (contains(operations, '{op}')) AS {name}" for op, name in (('SECTION_ADDED', 'added'), ('SECTION_REMOVED', 'removed'), ('SECTION_MODIFIED', 'modified'), ('SECTION_MOVED', 'moved'), ('SECTION_RENAMED', 'renamed'), ('SECTION_MAPPING_CHANGED', 'mapping_changed'), ('NO_CHANGE', 'unchanged')))}
FROM ops GROUP BY pair_id""")
def q_diff_summary(spark, d):
    return diff.summary(section_rows(spark, d), ["pair_id"])


@query(f"""WITH {OPS} SELECT pair_id, concat_ws('|', {', '.join(f"CASE WHEN bool_or(contains(operations, '{op}')) THEN '{op}' END" for op in OPERATIONS)}) AS operations FROM ops GROUP BY pair_id""")
def q_document_ops(spark, d):
    return diff.document_operations(section_rows(spark, d), ["pair_id"]).withColumn("operations", joined("operations"))


def document_pairs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    docs = read(spark, d, "documents")
    out = lineages(spark, d)
    for side in ("old", "new"):
        out = out.join(docs.select(F.col("doc_id").alias(f"{side}_doc"), *[F.col(c).alias(f"{side}_{c}") for c in columns]), f"{side}_doc")
    return out


META = """p AS (SELECT sha256(split_part(text, chr(10), 1)) AS lineage_id, lag(doc_id) OVER w AS old_doc, doc_id AS new_doc, lag(lang) OVER w AS old_lang, lang AS new_lang, lag(source) OVER w AS old_source, source AS new_source,
  lag(n_chars) OVER w AS old_n_chars, n_chars AS new_n_chars, lag(text) OVER w AS old_text, text AS new_text FROM documents WINDOW w AS (PARTITION BY split_part(text, chr(10), 1) ORDER BY doc_id) QUALIFY old_doc IS NOT NULL)"""


@query(f"""WITH {META} SELECT new_doc, 0 AS position, 'lang' AS field, old_lang AS old, new_lang AS new FROM p WHERE old_lang IS DISTINCT FROM new_lang UNION ALL
SELECT new_doc, 1, 'source', old_source, new_source FROM p WHERE old_source IS DISTINCT FROM new_source UNION ALL
SELECT new_doc, 2, 'n_chars', old_n_chars::VARCHAR, new_n_chars::VARCHAR FROM p WHERE old_n_chars IS DISTINCT FROM new_n_chars""")
def q_metadata_unpivot(spark, d):
    rows = document_pairs(spark, d, "lang", "source", "n_chars")
    return relational.unpivoted(rows, ["new_doc"], {c: (F.col(f"old_{c}"), F.col(f"new_{c}")) for c in ("lang", "source", "n_chars")})


@query(f"""WITH {META}, c AS (SELECT *, list_filter([CASE WHEN old_text <> new_text THEN 'SOURCE_CHANGED' END, CASE WHEN old_lang <> new_lang THEN 'PARSER_CHANGED' END, CASE WHEN old_source <> new_source THEN 'MAPPING_CHANGED' END], lambda x: x IS NOT NULL) AS components FROM p)
SELECT new_doc, CASE WHEN cause = 'MULTIPLE_CAUSES' THEN array_to_string(components, '|') ELSE cause END AS components, cause FROM (
SELECT new_doc, components, CASE WHEN old_source IS NULL OR old_source = '' OR new_source IS NULL OR new_source = '' THEN 'UNDETERMINED' WHEN len(components) > 1 THEN 'MULTIPLE_CAUSES' WHEN len(components) = 1 THEN components[1] WHEN old_n_chars <> new_n_chars THEN 'METADATA_ONLY_CHANGED' ELSE 'NO_CHANGE' END AS cause FROM c)""")
def q_change_cause(spark, d):
    c = F.col
    rows = document_pairs(spark, d, "lang", "source", "n_chars", "text")
    found = rules.change_components([("SOURCE_CHANGED", c("old_text"), c("new_text")), ("PARSER_CHANGED", c("old_lang"), c("new_lang")), ("MAPPING_CHANGED", c("old_source"), c("new_source"))])
    complete = F.size(rules.required({k: c(k) for k in ("old_source", "new_source")})) == 0
    rows = rows.withColumn("components", found)
    cause = rules.change_cause(c("old_doc").isNotNull(), c("new_doc").isNotNull(), complete, c("components"), F.lit(False), F.lit(False), c("old_n_chars") != c("new_n_chars"))
    return rows.withColumn("cause", cause).select("new_doc", joined(rules.causes(c("cause"), c("components"))).alias("components"), "cause")


@query()
def q_text_chunks(spark, d):
    """Word-level chunks of every pair of consecutive versions (opcodes of the matcher have no SQL)."""
    return textdiff.text_chunks(document_pairs(spark, d, "text").where("old_text <> new_text").repartition("new_doc"), ["new_doc"])


# Lineage


@query("""SELECT user_id, event_id, lag(event_id) OVER w AS old_event_id, row_number() OVER w AS position FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY position > 1""")
def q_version_edges(spark, d):
    rows = lineage.edges(read(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", [F.col("ts"), F.col("event_id")], ["event_id"])
    return rows.select("user_id", "event_id", "old_event_id", F.col("position").cast("long").alias("position"))


@query("""WITH p AS (SELECT o_orderkey AS k, o_orderkey % 7 AS v, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS e, CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE o_totalprice END AS q, o_orderkey AS r, o_custkey FROM orders),
s AS (SELECT k, lag(k) OVER w AS ok, sign(v - lag(v) OVER w) AS dv, CASE WHEN e IS NULL OR lag(e) OVER w IS NULL THEN NULL WHEN lag(e) OVER w < e THEN 1 WHEN lag(e) OVER w > e THEN -1 ELSE 0 END AS de,
  CASE WHEN q IS NULL OR lag(q) OVER w IS NULL THEN NULL WHEN lag(q) OVER w < q THEN 1 WHEN lag(q) OVER w > q THEN -1 ELSE 0 END AS dq FROM p WINDOW w AS (PARTITION BY o_custkey ORDER BY k) QUALIFY ok IS NOT NULL)
SELECT k AS o_orderkey, CASE WHEN dv = -1 OR de = -1 OR dq = -1 THEN 'ORDER_CONFLICT' WHEN dv = 1 THEN 'SOURCE_VERSION_ORDERED' WHEN de = 1 THEN 'EFFECTIVE_DATE_ORDERED' WHEN dq = 1 THEN 'PUBLICATION_DATE_ORDERED' ELSE 'INGESTION_ORDER_ONLY' END AS status,
CASE WHEN dv = -1 OR de = -1 OR dq = -1 THEN 'CONFLICT' WHEN dv = 1 THEN CASE WHEN coalesce(de, 0) = 1 OR coalesce(dq, 0) = 1 THEN 'MULTIPLE_SOURCE_FIELDS_AGREE' ELSE 'SOURCE_VERSION_ONLY' END WHEN de = 1 THEN CASE WHEN coalesce(dq, 0) = 0 THEN 'DATE_ONLY' ELSE 'DATES_AGREE' END WHEN dq = 1 THEN 'DATE_ONLY' ELSE 'INGESTION_METADATA_ONLY' END AS confidence FROM s""")
def q_version_ordering(spark, d):
    c = F.col
    rows = read(spark, d, "orders").select("o_custkey", "o_orderkey", (c("o_orderkey") % 7).cast("string").alias("version"), F.when(c("o_orderkey") % 3 != 0, c("o_orderdate")).alias("effective"), F.when(c("o_orderkey") % 5 >= 2, c("o_totalprice")).alias("published"), c("o_orderkey").alias("retrieved"))
    names = ["version", "effective", "published", "retrieved"]
    pairs = lineage.edges(rows, "o_custkey", [c("o_orderkey")], names).withColumnsRenamed({n: f"new_{n}" for n in names})
    return lineage.ordered(pairs).select("o_orderkey", c("ordering.status").alias("status"), c("ordering.confidence").alias("confidence"))


@query("""WITH h AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS pos FROM events),
w AS (SELECT user_id, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY user_id HAVING count(*) > 1)
SELECT w.user_id, x.pos::INT AS old_position, y.pos::INT AS new_position, sign(y.pos - x.pos)::INT * -1 AS dir, abs(x.pos - y.pos) = 1 AND x.pos > y.pos AS adjacent,
coalesce((SELECT string_agg(h.event_id::VARCHAR, '|' ORDER BY h.pos DESC) FROM h WHERE h.user_id = w.user_id AND h.pos > least(x.pos, y.pos) AND h.pos < greatest(x.pos, y.pos)), '') AS missing
FROM w JOIN h x ON x.user_id = w.user_id AND x.event_id = w.a JOIN h y ON y.user_id = w.user_id AND y.event_id = w.b""")
def q_missing_versions(spark, d):
    events = read(spark, d, "events")
    entries = relational.numbered(events.select("user_id", "ts", F.col("event_id").alias("version")), ["user_id"], [F.desc("ts"), F.desc("version")], "position").select("user_id", "version", "position")
    ends = events.groupBy("user_id").agg(F.min("event_id").alias("old_version"), F.max("event_id").alias("new_version"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    got = lineage.history_gaps(ends, entries, "user_id")
    return got.select("user_id", "old_position", "new_position", (-F.col("history")).alias("dir"), "adjacent", F.array_join(F.transform("missing", lambda x: x.cast("string")), "|").alias("missing"))


@query("""WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'v' || o_orderkey WHEN o_orderkey % 9 = 0 THEN '' ELSE (o_orderkey % 1000)::VARCHAR END AS version FROM orders)
SELECT o_orderkey, version, row_number() OVER (ORDER BY CASE WHEN regexp_matches(version, '[^0-9]') THEN 1 ELSE 0 END, coalesce(try_cast(regexp_extract(version, '^[0-9]+') AS BIGINT), 0), version, o_orderkey) - 1 AS position FROM v""")
def q_version_sort(spark, d):
    """A global order without one task that holds all rows: dealt by range, numbered within a range, shifted by the ranges before."""
    c = F.col("o_orderkey")
    rows = read(spark, d, "orders").select("o_orderkey", F.when(c % 4 == 0, F.concat(F.lit("v"), c)).when(c % 9 == 0, "").otherwise((c % 1000).cast("string")).alias("version"))
    keys = dict(zip(("_a", "_b", "_c"), text.version_key(F.col("version")), strict=True))
    # Held, so that both readers see the same ranges.
    dealt = held(rows.withColumns(keys).repartitionByRange(*keys, "o_orderkey").withColumn("_part", F.spark_partition_id()), "ranges")
    inner = Window.partitionBy("_part").orderBy(*keys, "o_orderkey")
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_shift"))
    return dealt.withColumn("_i", F.row_number().over(inner)).join(F.broadcast(shift), "_part").select("o_orderkey", "version", (F.col("_shift") + F.col("_i") - 1).alias("position"))


# Selection


@query("""SELECT p_partkey, concat_ws('|', CASE WHEN n = 1 AND m = 0 THEN 'EXACT_SINGLE_INGREDIENT_MATCH' END, CASE WHEN n > 1 THEN 'COMBINATION_PRODUCT' END, CASE WHEN n = 1 AND m <> 0 THEN 'WRONG_INGREDIENT' END,
CASE WHEN kind = 'veterinary' THEN 'NON_HUMAN_PRODUCT' END, CASE WHEN kind = 'human otc drug' THEN 'OTC_PRODUCT' END, CASE WHEN kind = 'human prescription drug' THEN 'PRESCRIPTION_PRODUCT' END, CASE WHEN p_size % 11 = 0 THEN 'REPACKAGED_PRODUCT' END,
CASE WHEN status = 'discontinued' THEN 'ARCHIVED_OR_INACTIVE' END, CASE WHEN n = 0 OR kind = '' OR status = '' THEN 'MISSING_REQUIRED_METADATA' END, CASE WHEN kind = 'device' THEN 'UNSUPPORTED_PRODUCT_TYPE' END, CASE WHEN status = 'pending' THEN 'AMBIGUOUS' END) AS classes
FROM (SELECT p_partkey, p_size, p_partkey % 3 AS n, p_partkey % 2 AS m, ['human prescription drug', 'human otc drug', 'veterinary', 'device', ''][p_size % 5 + 1] AS kind, ['current', 'discontinued', 'pending', ''][p_size % 4 + 1] AS status FROM part)""")
def q_classify(spark, d):
    p, s = F.col("p_partkey"), F.col("p_size")
    pick = lambda values, i: F.array(*map(F.lit, values))[i]
    active = F.slice(F.array(F.when(p % 2 == 0, "Name").otherwise("Other"), F.lit("second")), 1, (p % 3).cast("int"))
    one = F.lit("x")
    found = rules.classes(active, F.lit("name"), F.lit("name"), F.lower(F.get(active, F.lit(0))), pick(("human prescription drug", "human otc drug", "veterinary", "device", ""), (s % 5).cast("int")), F.when(s % 11 == 0, "Repackers").otherwise("Maker"), one, pick(("current", "discontinued", "pending", ""), (s % 4).cast("int")), one, one, F.lit(None).cast("boolean"), F.lit(False))
    return read(spark, d, "part").select("p_partkey", joined(found).alias("classes"))


@query("SELECT doc_id, CASE WHEN min(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) <> doc_id THEN min(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) END AS duplicate_of FROM documents")
def q_duplicate_first(spark, d):
    rows = read(spark, d, "documents").select("doc_id", identity.sha256(F.coalesce("text", F.lit(""))).alias("h"))
    return relational.first_occurrence(rows, ["h"], ["doc_id"], "doc_id").select("doc_id", "duplicate_of")


@query("""WITH t AS (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders), w AS (SELECT o_custkey, count(*) AS n_top, count(DISTINCT o_orderkey) AS n_identities, min(o_orderkey) AS k FROM t WHERE o_orderdate = m GROUP BY o_custkey)
SELECT o_custkey, n_top, n_identities, CASE WHEN n_top = 1 THEN k END AS selected, CASE WHEN n_top = 1 THEN 'SELECTED' WHEN n_identities > 1 THEN 'MULTIPLE_EQUIVALENT_CANDIDATES' ELSE 'AMBIGUOUS_REQUIRES_REVIEW' END AS status FROM w""")
def q_select_tie(spark, d):
    return selection.top_or_tied(read(spark, d, "orders"), ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey"))


@query("""SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE o_orderkey % 50 END DESC, o_orderdate::DATE DESC, o_orderkey::VARCHAR, o_orderpriority) - 1 AS position FROM orders""")
def q_candidate_order(spark, d):
    k = F.col("o_orderkey")
    version = F.when(k % 5 == 0, "draft").otherwise((k % 50).cast("string"))
    order = selection.candidate_order(version, F.col("o_orderdate").cast("date"), k.cast("string"), F.col("o_orderpriority"))
    return relational.numbered(read(spark, d, "orders"), ["o_custkey"], order, "position").select("o_custkey", "o_orderkey", F.col("position").cast("long").alias("position"))


# Scalars


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN -1 ELSE date_diff('day', DATE '0001-01-01', o_orderdate::DATE) + 1 END::INT AS ordinal FROM orders""")
def q_date_coalesce(spark, d):
    k, day = F.col("o_orderkey") % 5, F.col("o_orderdate")
    written = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.upper(F.date_format(day, "MMM d, yyyy"))).when(k == 2, F.date_format(day, "MMMM dd, yyyy")).when(k == 3, F.concat(F.lit(" "), F.date_format(day, "yyyyMMdd"))).otherwise("2020-02-31")
    return read(spark, d, "orders").select("o_orderkey", text.ordinal(text.lenient_date(written)).alias("ordinal"))


@query("SELECT doc_id, regexp_matches(text, '(?i)(^|[^A-Za-z0-9])the($|[^A-Za-z0-9])') AS mentioned FROM documents")
def q_term_match(spark, d):
    return read(spark, d, "documents").select("doc_id", text.mentions(F.col("text"), "the").alias("mentioned"))


def _map_sql() -> str:
    case = lambda col, table: f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"
    code = "[" + ", ".join(f"'{c}'" for c in [*CODE_CONCEPTS, "00000-0", ""]) + "][(conv_id * 7 + turn) % 20 + 1]"
    head = "['2.1 How  Supplied', 'RENAL impairment', '14 other', ''][(conv_id + turn) % 4 + 1]"
    norm = "trim(regexp_replace(regexp_replace(lower(h), '^[0-9]+(\\.[0-9]+)*\\s*', ''), '\\s+', ' ', 'g'))"
    return f"""WITH s AS (SELECT conv_id, turn, {code} AS c, {head} AS h FROM conversations), m AS (SELECT *, {case('c', CODE_CONCEPTS)} AS a, {case(norm, HEADING_CONCEPTS)} AS b FROM s)
SELECT conv_id, turn, coalesce(a, b) AS concept, CASE WHEN a IS NOT NULL THEN 'loinc_code_exact' ELSE 'normalized_heading_exact' END AS method FROM m WHERE coalesce(a, b) IS NOT NULL"""


@query(_map_sql())
def q_concept_map(spark, d):
    c, t = F.col("conv_id"), F.col("turn")
    code = F.array(*[F.lit(x) for x in [*CODE_CONCEPTS, "00000-0", ""]])[((c * 7 + t) % 20).cast("int")]
    head = F.array(*map(F.lit, ("2.1 How  Supplied", "RENAL impairment", "14 other", "")))[((c + t) % 4).cast("int")]
    return read(spark, d, "conversations").select("conv_id", "turn", rules.concept(code, head).alias("m")).where("m IS NOT NULL").select("conv_id", "turn", "m.concept", "m.method")


@query("SELECT item_id, trim(regexp_replace(regexp_replace(trim(regexp_replace(replace(lower('4.2  ' || text), 'ß', 'ss'), '\\s+', ' ', 'g')), '^[0-9]+(\\.[0-9]+)*\\s*', ''), '\\s+', ' ', 'g')) AS heading FROM benchmark")
def q_heading_norm(spark, d):
    return read(spark, d, "benchmark").select("item_id", text.mapped_heading(F.concat(F.lit("4.2  "), "text")).alias("heading"))


@query("SELECT doc_id, len(regexp_extract_all(text, '\\S+'))::INT AS n_tokens FROM documents")
def q_tokenize(spark, d):
    return read(spark, d, "documents").select("doc_id", F.size(text.tokens(F.col("text"))).alias("n_tokens"))


@query("""WITH t AS (SELECT item_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS i FROM benchmark),
f AS (SELECT item_id, lower(w) AS k, min(i) AS i, arg_min(w, i) AS w FROM t WHERE trim(w) <> '' GROUP BY ALL) SELECT item_id, string_agg(w, '|' ORDER BY i) AS names FROM f GROUP BY item_id""")
def q_dedup_first(spark, d):
    return read(spark, d, "benchmark").select("item_id", joined(text.first_spellings(F.split("text", " "))).alias("names"))


@query("""WITH RECURSIVE n AS (SELECT 'r' || r_regionkey AS node, NULL AS parent, false AS flag, 0 AS depth FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, false, 1 FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_acctbal > 9800, 2 FROM customer),
up AS (SELECT node, parent, flag FROM n WHERE flag UNION SELECT p.node, p.parent, true FROM up JOIN n p ON up.parent = p.node)
SELECT node, node IN (SELECT node FROM up) AS flag FROM n""")
def q_subtree_any(spark, d):
    node = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    tree = read(spark, d, "region").select(node("r", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(False).alias("flag"), F.lit(0).alias("depth"))
    tree = tree.union(read(spark, d, "nation").select(node("n", "n_nationkey"), node("r", "n_regionkey"), F.lit(False), F.lit(1)))
    tree = tree.union(read(spark, d, "customer").select(node("c", "c_custkey"), node("n", "c_nationkey"), F.col("c_acctbal") > 9800, F.lit(2)))
    return relational.subtree_any(tree, "node", "parent", "flag", "depth")


@query("SELECT conv_id, count(*) AS n, count(DISTINCT turn) AS n_distinct, min(turn) + 1 AS low, max(turn) + 1 AS high, min(turn) = 0 AND max(turn) + 1 = count(*) AND count(*) = count(DISTINCT turn) AS contiguous FROM conversations GROUP BY conv_id")
def q_rank_contiguity(spark, d):
    return relational.contiguous(read(spark, d, "conversations").select("conv_id", (F.col("turn") + 1).alias("rank")), ["conv_id"], "rank")


@query("""SELECT doc_id, concat_ws('|', CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END, CASE WHEN source = 'src0' THEN 'source' END) AS missing FROM documents LEFT JOIN labels USING (doc_id)""")
def q_required_fields(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.when(F.col("source") == "src0", "").otherwise(F.col("source")).alias("source")).join(read(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", joined(rules.required({"quality": F.col("quality"), "toxic": F.col("toxic"), "source": F.col("source")})).alias("missing"))


@query("SELECT event_id, json_keys(props)[1] AS first_key, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value FROM events")
def q_json_variant(spark, d):
    parsed = F.try_parse_json("props")
    key = F.json_object_keys("props")[0]
    return read(spark, d, "events").select("event_id", key.alias("first_key"), F.element_at(F.try_variant_get(parsed, "$", "map<string,string>"), key).alias("first_value"))


# Identity and store


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents")
def q_sha256(spark, d):
    return read(spark, d, "documents").select("doc_id", identity.sha256(F.coalesce("text", F.lit(""))).alias("sha256"))


@query("""WITH h AS (SELECT c_custkey, sha1(unhex('3f1738a851575e38b4afa356faf0638e') || encode('ingredient|' || lower(c_name))) AS s FROM customer)
SELECT c_custkey, substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-5' || substr(s, 14, 3) || '-' || substr('89ab', (('0x' || substr(s, 17, 1))::INT % 4) + 1, 1) || substr(s, 18, 3) || '-' || substr(s, 21, 12) AS id FROM h""")
def q_uuid5(spark, d):
    return read(spark, d, "customer").select("c_custkey", identity.ingredient_id(F.lower("c_name")).alias("id"))


@query("""SELECT c_custkey, sha256('{"key":' || c_custkey || ',"name":' || to_json(c_name) || ',"nothing":null,"segment":' || to_json(c_mktsegment) || '}') AS sha256 FROM customer""")
def q_canonical_hash(spark, d):
    c = F.col
    return read(spark, d, "customer").select("c_custkey", identity.sha256(identity.canonical_json(segment=c("c_mktsegment"), name=c("c_name"), key=c("c_custkey"), nothing=F.lit(None).cast("string"))).alias("sha256"))


@query("""WITH o AS (SELECT doc_id AS id, sha256(text) AS h FROM documents WHERE doc_id % 10 <> 1), n AS (SELECT doc_id AS id, CASE WHEN doc_id % 10 = 2 THEN 'other' ELSE sha256(text) END AS h FROM documents WHERE doc_id % 10 <> 3)
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.h IS NULL THEN 'NEW' WHEN n.h IS NULL THEN 'KEPT' WHEN o.h = n.h THEN 'SAME' ELSE 'CONFLICT' END AS outcome FROM o FULL JOIN n ON o.id = n.id""")
def q_idempotent_upsert(spark, d):
    """The residues say what the store holds and what comes in; every row takes part on one side at least."""
    rows = read(spark, d, "documents").select(F.col("doc_id").alias("id"), identity.sha256(F.col("text")).alias("h"))
    incoming = rows.where(F.col("id") % 10 != 3).withColumn("h", F.when(F.col("id") % 10 == 2, "other").otherwise(F.col("h")))
    return store.compared(rows.where(F.col("id") % 10 != 1), incoming, ["id"], "h")


@query("""WITH a AS (SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS canonical, list(turn ORDER BY turn) AS ranks FROM conversations GROUP BY conv_id)
SELECT conv_id, conv_id % 7 <> 0 AND conv_id % 11 <> 0 OR conv_id % 7 <> 0 AND len(ranks) < 2 AS intact FROM a""")
def q_artifact_integrity(spark, d):
    rows = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("t")))).alias("x"))
    rows = rows.select("conv_id", F.array_join(F.transform("x", lambda x: x["t"]), "\n").alias("canonical"), F.transform("x", lambda x: x["turn"]).alias("ranks"))
    broken = rows.withColumn("sha256", F.when(F.col("conv_id") % 7 == 0, "0").otherwise(identity.sha256(F.col("canonical")))).withColumn("ranks", F.when(F.col("conv_id") % 11 == 0, F.reverse("ranks")).otherwise(F.col("ranks")))
    return broken.select("conv_id", batch.intact(broken).alias("intact"))


@query("""SELECT l_orderkey, bool_and(o_orderkey IS NOT NULL AND l_quantity > 0 AND l_discount < 0.1) AS verified,
coalesce(string_agg(DISTINCT CASE WHEN NOT l_discount < 0.1 THEN 'discount' END, '|'), '') AS failed, count(*) * 3 AS n_checks FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey""")
def q_verify_rollup(spark, d):
    rows = read(spark, d, "lineitem").join(read(spark, d, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    checks = batch.unrolled(rows, ["l_orderkey"], {"order": F.col("o_orderkey").isNotNull(), "quantity": F.col("l_quantity") > 0, "discount": F.col("l_discount") < 0.1})
    return batch.verified(checks, ["l_orderkey"]).withColumn("failed", joined("failed"))


@query("""WITH i AS (SELECT user_id, CASE event_id % 4 WHEN 0 THEN 'SELECTED' WHEN 1 THEN 'NO_CANDIDATE' ELSE 'SELECTED' END AS s, CASE WHEN event_id % 4 = 1 THEN 'NOT_SELECTED' WHEN event_id % 13 = 0 THEN 'PARSER_FAILED' ELSE 'INGESTED' END AS g, CASE WHEN event_id % 4 <> 1 AND event_id % 13 <> 0 THEN CASE WHEN event_id % 17 = 0 THEN 'NOT_VERIFIED' ELSE 'VERIFIED' END ELSE 'NOT_VERIFIED' END AS v FROM events),
c AS (SELECT user_id, count(*) AS total, count(*) FILTER (s = 'SELECTED') AS selected, count(*) FILTER (g = 'INGESTED') AS fetched, count(*) FILTER (g = 'INGESTED') AS ingested, count(*) FILTER (v = 'VERIFIED') AS verified, 0::BIGINT AS quarantined, count(*) FILTER (s = 'NO_CANDIDATE') AS unresolved, count(*) FILTER (g = 'PARSER_FAILED') AS failed, count(*) FILTER (g = 'INGESTED' AND v = 'NOT_VERIFIED') AS open FROM i GROUP BY user_id)
SELECT *, CASE WHEN open > 0 THEN 'RUNNING' WHEN verified = total THEN 'COMPLETED' WHEN failed = total THEN 'FAILED' WHEN failed > 0 THEN 'PARTIAL_FAILURE' ELSE 'COMPLETED_WITH_UNRESOLVED_ITEMS' END AS status FROM c""")
def q_batch_rollup(spark, d):
    e = F.col("event_id")
    out, bad = e % 4 == 1, e % 13 == 0
    items = read(spark, d, "events").select("user_id", F.lit("DISCOVERED").alias("discovery"), F.when(out, "NO_CANDIDATE").otherwise("SELECTED").alias("selection"), F.when(out, "NOT_SELECTED").when(bad, "PARSER_FAILED").otherwise("INGESTED").alias("ingestion"), F.when(out | bad | (e % 17 == 0), "NOT_VERIFIED").otherwise("VERIFIED").alias("verification"))
    return batch.rollup(items, ["user_id"])


@query("""SELECT page_id, regexp_matches(html, '(?i)<!\\s*(DOCTYPE|ENTITY)\\b') AS declared, strlen(html) AS n_bytes, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title FROM pages""")
def q_guard_markup(spark, d):
    h = F.col("html")
    return read(spark, d, "pages").select("page_id", F.rlike(h, F.lit(r"(?i)<!\s*(DOCTYPE|ENTITY)\b")).alias("declared"), F.octet_length(h).cast("long").alias("n_bytes"), F.regexp_extract(h, "<h1>([^<]*)</h1>", 1).alias("title"))


@query("""WITH r AS (SELECT user_id, date_trunc('hour', ts) AS hour, event_type FROM events)
SELECT DISTINCT user_id, strftime(hour, '%Y-%m-%d %H') AS hour FROM r a WHERE event_type = 'signup' AND NOT EXISTS (SELECT 1 FROM r b WHERE b.user_id = a.user_id AND b.hour = a.hour AND b.event_type IN ('purchase', 'error'))""")
def q_open_runs(spark, d):
    """Runs (a user's hour) that were started and never ended, as a crash leaves them."""
    log = read(spark, d, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "event_type")
    return batch.orphaned(log, ["user_id", "hour"], "event_type", ["signup"], ["purchase", "error"])


@query("""WITH e AS (SELECT *, user_id // 10 AS g, date_trunc('day', ts) AS day FROM events), last AS (SELECT g, max(day) AS lost FROM e GROUP BY g),
kept AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, count(*) AS n FROM e JOIN last USING (g) WHERE day < lost OR g % 3 = 0 GROUP BY user_id)
SELECT user_id, state, n, state IN ('signup', 'error') AS taken_up FROM kept""")
def q_resumed_items(spark, d):
    """Items after a crash: groups of ten users commit day by day, two in three groups lose their last commit; the newest state that counted says what a stage takes up again."""
    c = F.col
    log = read(spark, d, "events").withColumns({"g": F.floor(c("user_id") / 10), "day": F.date_trunc("day", "ts")})
    lost = log.groupBy("g").agg(F.max("day").alias("day")).where("g % 3 <> 0")
    counted = relational.orphans(log, lost, ["g", "day"])
    state = relational.latest(counted, ["user_id"], ["ts", "event_id"], ["event_type"]).withColumnRenamed("event_type", "state")
    n = counted.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return state.join(n, "user_id").select("user_id", "state", "n", c("state").isin("signup", "error").alias("taken_up"))


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY user_id, event_type")
def q_batch_state_latest(spark, d):
    return store.current(read(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "ts"])


@query("""SELECT 'lineitem' AS "table", 'order' AS rule, l_orderkey::VARCHAR AS key, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT') GROUP BY l_orderkey UNION ALL
SELECT 'lineitem', 'unique(l_orderkey,l_suppkey)', l_orderkey || '|' || l_suppkey, count(*) FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1 UNION ALL
SELECT 'lineitem', 'quantity below 50', NULL, count(*) FROM lineitem WHERE NOT l_quantity < 50""")
def q_constraints(spark, d):
    orders = read(spark, d, "orders").where("o_orderpriority <> '1-URGENT'")
    return store.violations(read(spark, d, "lineitem"), "lineitem", unique=[["l_orderkey", "l_suppkey"]], checks={"quantity below 50": F.col("l_quantity") < 50}, references={"order": (["l_orderkey"], orders, ["o_orderkey"])})


@query("SELECT conv_id, count(*) AS n, sha256(string_agg('{\"role\":' || to_json(role) || ',\"turn\":' || turn || '}', ',' ORDER BY turn)) AS sha256 FROM conversations GROUP BY conv_id")
def q_canonical_report(spark, d):
    got = batch.artifact(read(spark, d, "conversations"), ["conv_id"], "turn", ["role", "turn"])
    inner = F.expr("substring(canonical, 2, length(canonical) - 2)")
    return got.select("conv_id", "n", identity.sha256(inner).alias("sha256"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE CASE WHEN o_totalprice > 100000 THEN 2 ELSE 0 END END AS code FROM orders""")
def q_exit_code(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "PARTIAL_FAILURE").when(F.col("o_orderstatus") == "P", "FAILED").otherwise("RUNNING")
    return read(spark, d, "orders").select("o_orderkey", rules.exit_code(status, F.col("o_totalprice") > 100000).alias("code"))


@query("""SELECT event_id, regexp_full_match(event_type || '-' || event_id, '[A-Za-z0-9][A-Za-z0-9._-]{0,127}') AS safe, substr(regexp_replace('../' || event_type || ' ' || event_id || '?', '[^A-Za-z0-9._-]', '_', 'g'), 3) AS cleaned FROM events""")
def q_path_segments(spark, d):
    e = F.col("event_id").cast("string")
    return read(spark, d, "events").select("event_id", text.safe_segment(F.concat("event_type", F.lit("-"), e)).alias("safe"), text.cleaned_segment(F.concat(F.lit("../"), "event_type", F.lit(" "), e, F.lit("?"))).alias("cleaned"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN 'Z' ELSE strftime(ts, '.%fZ') END AS at, base64(encode(props)) AS body FROM events")
def q_utc_base64(spark, d):
    return read(spark, d, "events").select("event_id", text.utc_text(F.col("ts")).alias("at"), F.base64(F.col("props").cast("binary")).alias("body"))
