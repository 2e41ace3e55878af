"""What the fourth round's findings found in the core."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from labeldiff import queries
from labeldiff.operators import matching, textdiff


def test_text_diffs_hold_a_slice_of_a_batch():
    """words of a whole batch filled a task."""
    texts = ["a" * 10] * 7 + ["b" * 500, None, "c"]
    batch = pa.RecordBatch.from_pylist([{"k": k, "a": t, "b": t} for k, t in enumerate(texts)])
    parts = list(textdiff.slices(batch, (1, 2), 50))
    assert [p.num_rows for p in parts] == [2, 2, 2, 1, 1, 2]
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()


def sections(spark):
    rows = [(1, side, f"{side}{k}", None, k, f"{side}{k}", code, f"/s[{k}]", heading, 0, body) for side, k, code, heading, body in [
        ("old", 0, "A", "One", "alpha beta"), ("old", 1, "B", "Two", "gamma delta"), ("old", 2, None, "Three", "epsilon"), ("old", 3, None, "Five", "some words that stay the same here and there"), ("old", 4, None, "", "x"),
        ("new", 0, "A", "One", "alpha beta"), ("new", 1, "C", "Three", "gamma delta"), ("new", 2, "E", "Two", "epsilon"), ("new", 5, "F", "Six", "some words that stay the same here and now"), ("new", 4, None, "", "y"),
    ]]
    return spark.createDataFrame(rows, "pair_id int, side string, section_id string, parent_id string, seq int, xml_id string, code string, locator string, heading string, depth int, text string")


def test_phases_are_held_once(spark):
    """each phase was shuffled, joined for the locator's check, and written, texts of matched sections included."""
    seen = []

    def hold(rows):
        seen.append(rows)
        return rows

    names = ["pair_id", "side", "section_id"]
    got = matching.match_sections(sections(spark), hold, names)
    assert got.columns == [*names, "partner", "method"] and len(seen) == 4
    whole = matching.match_sections(sections(spark)).select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    rows = {r.section_id: r for r in got.where("side = 'old'").collect()}
    # old1 and new1 share a locator, but neither code nor heading: their headings match others later.
    assert {k: (r.partner, r.method) for k, r in rows.items() if r.method != "CONTENT_ASSISTED"} == {
        "old0": ("new0", "SECTION_CODE"), "old1": ("new2", "HEADING_AND_PARENT"), "old2": ("new1", "HEADING_AND_PARENT"), "old3": (None, None), "old4": ("new4", "SOURCE_LOCATOR"),
    }
    assert {r.section_id for r in seen[0].where(F.col("text").isNotNull()).collect()} == {"old3", "new5"}


def test_section_operations_move_no_texts(spark, tmp_path):
    """whole lines went through the shuffle and every sort. Blank heads, repeated lines and null texts as in the SQL."""
    import duckdb

    texts = ["t\n\nx y 1\n x\nsame", "t\n a\nx y 2!\n\nsame", "t\nx z\nq\nq\n", None, "t\nq\nx z\n!", "u\n!", "u", "u\n \nlong" + "g" * 500, "u\nlong" + "g" * 499 + "\n "]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.digested(spark, str(tmp_path))
    assert {f.name: f.dataType.typeName() for f in rows.schema if f.name in ("line", "head", "bang")} == {"line": "binary", "head": "binary", "bang": "boolean"}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    for name in ("q_section_ops", "q_diff_summary", "q_document_ops"):
        want = db.execute(queries.SQL[name]).fetchall()
        assert sorted(map(tuple, queries.QUERIES[name](spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


def test_stand_in_documents_split_each_text_once(spark, tmp_path):
    """within the lambda over lines the whole text was split for each line. Escapes come from whole texts, as they did from lines."""
    from labeldiff import document_queries

    spark.createDataFrame([(1, 'a<b c&d "e"\n\n x > y z', "en", "s"), (2, None, None, None), (3, "\n".join(map(str, range(12))), "en", "s")], "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    files = document_queries.xml_files(spark, str(tmp_path))
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    got = {r.path: bytes(r.content).decode() for r in files.collect()}
    assert "<title>a&lt;b c&amp;d</title><text>a&lt;b c&amp;d &quot;e&quot;</text>" in got["1"] and "<title> x</title><text> x &gt; y z</text>" in got["1"]
    assert got["2"].count("<section>") == 1 and got["3"].count("<section>") == 12
    held = document_queries.xml_tables(spark, str(tmp_path), keep=True)["sections"]
    assert not {"text", "structure", "comparison"} & set(held.columns)
    assert held.count() == 3 + 1 + 12
