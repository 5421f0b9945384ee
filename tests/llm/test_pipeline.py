"""The pipeline's stages against plain Python, and the registered queries."""

import sys

from llm_data import *  # noqa: F403

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import corpus_pipeline  # noqa: E402
from test_groups import plain_groups  # noqa: E402
from test_scans import plain_report  # noqa: E402
from test_tokens import check_pieces  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from opstide.llm import op05_toxicity as tox  # noqa: E402
from opstide.llm import op10_decontaminate as decon  # noqa: E402


def plain_redaction(text):
    marks = [tuple(map(int, s.split(":")[1:])) for s in plain_report(text)[-1].split(",") if s]
    out, at = "", 0
    for a, b in sorted(marks):
        if a >= at or not at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_stages(spark, docs):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], DATA))  # noqa: F405
    for before, after in zip(tables, tables[1:-1]):
        assert after.schema.names == docs.schema.names
    ids = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in tables[:-1]]
    model = tox.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))  # noqa: F405
    bad = {r["doc_id"] for r in tox.toxicity(docs, model).where("predicted = 1").collect()}
    assert ids[1] == ids[0] - bad and bad
    assert ids[2] == {low for _, _, low in plain_groups([(i, rows[i]) for i in ids[1]])}
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")  # noqa: F405
    leaks = {r["doc_id"] for r in decon.contaminated_spans(tables[2], bench).collect()}
    assert ids[3] == ids[2] - leaks
    items = [r["text"] for r in bench.collect()]
    assert not any(item in rows[i] for i in ids[3] for item in items)
    clean = {r["doc_id"]: r["text"] for r in tables[4].collect()}
    assert clean == {i: plain_redaction(rows[i]) for i in ids[3]}
    check_pieces(list(clean.items()), tables[5].collect(), 1024)
    whole = corpus_pipeline.run(spark, DATA)  # noqa: F405
    assert whole.count() == tables[5].count()


def test_registered_queries(spark):
    found = entry.queries()
    assert "pipeline" in found
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in found) == 1
    assert set(entry.oracle_sql()) <= set(found)
