import ast
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
from tillhouse.llm import quality, queries, similar

ROOT = Path(__file__).resolve().parents[2]


def test_stage_by_stage(spark, messy):
    docs = spark.read.parquet(f"{messy}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    columns, sizes = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, messy)
        if k < 4:
            assert docs.columns == columns and docs.dtypes == before.dtypes
        sizes.append(docs.count())
        if k == 0:
            assert docs.count() == quality.quality_report(before).filter("kept").count()
        if k == 1:
            assert docs.count() == similar.near_copy_classes(before).select("class_id").distinct().count()
        if k == 2:
            assert docs.count() == before.count()
            assert docs.filter("text rlike 'AKIA[A-Z0-9]{12}' or text rlike '[0-9a-f]{32}'").isEmpty()
    assert sizes[0] > sizes[1] >= sizes[2] == sizes[3] and sizes[5] >= sizes[4] > 0
    assert {"sequence_id", "offset", "length"} <= set(docs.columns)


def test_run(spark, messy):
    a = corpus_pipeline.run(spark, messy)
    assert a.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()
    assert not a.isEmpty()


def test_empty_table(spark, empty):
    docs = spark.read.parquet(f"{empty}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, empty)
    assert docs.count() == 0


def test_registered():
    names = set(entry.queries())
    assert {q.split("_")[0] for q in queries.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= names
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tillhouse").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names)
