"""The queries opN_<name> over the driver's tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeldiff.llm.common import table


def op1_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from labeldiff.llm import bitplane

    blocks = bitplane.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return bitplane.read_documents(blocks)


def op2_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import toxicity

    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 0.7)


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import sharding

    return sharding.shard_report(table(spark, sf_dir, "documents"), 24)


def op4_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import mixing

    return mixing.report(table(spark, sf_dir, "documents"), budget=None)


def op5_page_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import html_crf

    return html_crf.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import simhash

    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, keep=["doc_id"])
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_prefix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import decontaminate

    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import chat

    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.report(chat.format_conversations(turns.unionByName(extra)))


def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import licenses

    return licenses.scan_report(table(spark, sf_dir, "documents"))


def op10_va_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import va_file

    return va_file.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op11_annulus_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import annulus

    return annulus.report(table(spark, sf_dir, "embeddings"), k=8, rounds=10, width=64, seed="3")


def op12_merkle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labeldiff.llm import merkle

    return merkle.report(table(spark, sf_dir, "documents"))


def op13_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from labeldiff.llm import byte_bpe

    vocabulary = byte_bpe.Vocabulary(byte_bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    return byte_bpe.report(table(spark, sf_dir, "documents"), vocabulary)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n.startswith("op") and n[2].isdigit()}


#: CRC-32 in DuckDB: ``t`` of the table steps is its table of bytes.
CRC_STEPS = """steps AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(b)))"""
CRC = "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])))"


def clustering_sql(k: int, rounds: int, width: int, seed: str) -> str:
    """Lloyd's rounds, one after the other; every distance is computed."""
    far = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS MATERIALIZED (SELECT vec_id, unnest(q) AS x, unnest(range({width})) AS d FROM v),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), q) - 1 AS c, q FROM v QUALIFY c < {k})"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, c, {far} AS far FROM v, c{r} c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY far, c) = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.q, o.q) AS q FROM c{r} o LEFT JOIN (
    SELECT c, list(((s - ((s % m) + m) % m) // m)::BIGINT ORDER BY d) AS q FROM (SELECT c, d, sum(x) AS s, count(*) AS m FROM a{r} JOIN e USING (vec_id) GROUP BY c, d) GROUP BY c) n USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.c::INT AS "cluster", far::BIGINT AS distance, (sum(far) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(far) OVER ())::BIGINT AS inertia,
       sha256(list_aggregate(list_transform(q, lambda x: x::VARCHAR), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} USING (c)"""


def manifest_sql() -> str:
    """The trees level by level, then every leaf's siblings."""
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"
    head = " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars"))
    tree = """{t}({g}, pos, h, lvl) AS (
  SELECT {g}, pos, h, 0 FROM {of}
  UNION ALL SELECT {g}, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), lvl + 1 FROM (SELECT *, count(*) OVER (PARTITION BY {g}) AS n FROM {t}) WHERE n > 1 GROUP BY {g}, pos // 3, lvl)"""
    beside = """SELECT l.rid, {k} AS k, t.lvl, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < l.{p} // 3 ** t.lvl), '') AS a, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > l.{p} // 3 ** t.lvl), '') AS b
  FROM {l} l JOIN {t} t ON {on} AND t.pos // 3 = (l.{p} // (3 ** t.lvl)::BIGINT) // 3 AND t.lvl < {top} GROUP BY ALL"""
    beside = beside.replace("// 3 ** t.lvl)", "// (3 ** t.lvl)::BIGINT)")
    return f"""
WITH RECURSIVE {CRC_STEPS},
given AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, sha256({head} || {field("text")}) AS h,
         CASE WHEN {CRC.format("doc_id::VARCHAR")} % 2 = 0 THEN sha256({head} || {field("replace(text, chr(10), '')")}) END AS changed
  FROM documents, steps),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM given),
{tree.format(t="tree", g="source", of="leaves")},
whole AS MATERIALIZED (SELECT *, max(lvl) OVER (PARTITION BY source) AS top FROM tree),
subroots AS MATERIALIZED (SELECT '' AS g, source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM whole WHERE lvl = top),
{tree.format(t="higher", g="g", of="subroots")},
upper AS MATERIALIZED (SELECT *, max(lvl) OVER () AS top FROM higher),
placed AS MATERIALIZED (SELECT l.*, s.h AS subroot, s.pos AS spos FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
siblings AS (
  {beside.format(k=0, p="pos", l="placed", t="whole", on="t.source IS NOT DISTINCT FROM l.source", top="t.top")}
  UNION ALL {beside.format(k=1, p="spos", l="placed", t="upper", on="true", top="t.top")}),
proofs AS (SELECT rid, list(a || '|' || b ORDER BY k, lvl) AS steps, string_agg(a || b, '' ORDER BY k, lvl) AS proof FROM siblings GROUP BY rid),
done AS (
  SELECT doc_id, l.h AS leaf, subroot, (SELECT h FROM upper WHERE lvl = top) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(changed, l.h), coalesce(steps, [])), lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) AS folded_root
  FROM placed l LEFT JOIN proofs USING (rid))
SELECT *, folded_root = root AS verified FROM done"""


def oracle_sql() -> dict[str, str]:
    hashes = ", ".join(f"('0x' || substr(md5(doc_id || ':{k}'), 1, 13))::BIGINT" for k in range(24))
    from labeldiff.llm import chat

    marks = " + ".join(f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in chat.CONTROL)
    escaped = f"length({{0}}) + length({{0}}) - length(replace({{0}}, chr(92), '')) + {marks}"
    frame = len(chat.TURN) + len(chat.SAYS) + len(chat.END)
    return {
        "op11_annulus_clusters": clustering_sql(8, 10, 64, "3"),
        "op12_merkle_blocks": manifest_sql(),
        "op8_chat_parts": f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (SELECT *, md5(text) AS tie, {frame} + {escaped.format('role')} + {escaped.format('text')} AS size FROM given)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, tie)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, tie) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars, 0::BIGINT AS n_attachments, 0::BIGINT AS n_expanded, sha256('') AS attachments_sha256
FROM turns GROUP BY conv_id""",
        "op3_rendezvous_shards": f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, [{hashes}] AS h,
         ('0x' || substr(md5(doc_id || ':24'), 1, 13))::BIGINT AS next,
         ('0x' || substr(md5(doc_id || ':slot'), 1, 13))::BIGINT AS o FROM documents),
steps AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(b))),
summed AS (
  SELECT doc_id, text, h, next, o, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
         lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS crc FROM hashed, steps)
SELECT doc_id, (strlen(text) + 8)::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law,
       (list_position(h, list_max(h)) - 1)::INT AS shard,
       row_number() OVER (PARTITION BY list_position(h, list_max(h)) ORDER BY o, doc_id, crc) - 1 AS slot,
       CASE WHEN next > list_max(h) THEN 24 ELSE list_position(h, list_max(h)) - 1 END::INT AS grown_shard
FROM summed""",
        "op10_va_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10""",
        "op7_prefix_windows": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, list_aggregate(w[k:k + 9], 'string_agg', ' ') AS s, least(10, len(w)) AS m
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM windows),
places AS (
  SELECT doc_id, k, m, list_aggregate(w[k:k + m - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, item, k, p.m FROM places p JOIN windows USING (s, m)),
per AS (SELECT doc_id, list_sort(list_distinct(list(item))) AS items FROM hits GROUP BY doc_id),
covered AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(k, k + m)) AS x FROM (SELECT DISTINCT doc_id, k, m FROM hits)) GROUP BY doc_id),
ranges AS (
  SELECT doc_id, list([a, b] ORDER BY a) AS spans FROM (
    SELECT doc_id, g, min(k) - 1 AS a, max(k + m) - 1 AS b FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k, m) AS g FROM (
        SELECT *, CASE WHEN k <= max(k + m) OVER (PARTITION BY doc_id ORDER BY k, m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
        FROM (SELECT DISTINCT doc_id, k, m FROM hits)))
    GROUP BY doc_id, g) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(list_aggregate(items, 'string_agg', ','), '')) AS items_sha256, n IS NOT NULL AS contaminated,
       coalesce(items, []::VARCHAR[]) AS items, coalesce(spans, []::BIGINT[][]) AS spans
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN ranges USING (doc_id)""",
    }
