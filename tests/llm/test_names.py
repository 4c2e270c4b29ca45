"""Columns of any name pass through the operators and the stages; code travels with the job."""

import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, pii, secrets

NAMES = ["id", "digest", "_digest", "_row", "own", "row", "blob", "findings", "content", "_content", "_pii_spans", "spans", "body",
         "fp", "score", "evidence", "hits", "items", "component_id", "_own", "_text", "_source", "terms", "toxic", "key", "text2"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("names"))
    docs = [(i, f"mail a{i}@example.com of w{i} w{i + 1} w{i * 7} token: abcdefgh1", "en", "s", 9, *range(len(NAMES))) for i in range(30)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in NAMES)
    spark.createDataFrame(docs, columns).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    items = [(i, " ".join(f"v{i * 40 + k}" for k in range(30))) for i in range(20)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def same(df, rows=30):
    found = df.collect()
    assert len(found) == rows
    for r in found:
        assert [r[n] for n in NAMES] == list(range(len(NAMES)))


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        same(out, out.count())
        assert out.count() > 0, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert len(last) == 30 and all(r[n] == i for r in last for i, n in enumerate(NAMES))


def test_operators(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    same(pii.redact(docs))
    found = secrets.scan(docs, "text", f"file://{tmp_path}/ledger")
    assert found.columns == [c for c in docs.columns if c not in ("text", "blob", "findings")] + ["blob", "findings"]
    assert all(len(r.findings) == 1 and r["_content"] == NAMES.index("_content") for r in found.collect())
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    for shard_bytes in (100, 1 << 20):
        out = decontaminate.find(docs, items, shard_bytes=shard_bytes)
        assert set(docs.columns) | {"n_words", "hits", "items", "n_hit", "contaminated"} == set(out.columns)
        assert all(r["_row"] == NAMES.index("_row") and r.n_hit == 0 for r in out.collect())


def test_code_travels_with_the_job(tmp_path):
    """The subpackage alone registers its code for pickling by value."""
    code = ("import sys; sys.path.insert(0, sys.argv[1]); from tidemark.llm import lm, words; from pyspark import cloudpickle; "
            "data = cloudpickle.dumps(words.hashes); open(sys.argv[2], 'wb').write(data)")
    root = str(Path(__file__).resolve().parents[2])
    subprocess.run([sys.executable, "-c", code, root, str(tmp_path / "f")], check=True)
    back = "import sys, pickle; f = pickle.loads(open(sys.argv[1], 'rb').read()); assert 'tidemark' not in sys.modules; print(f.__name__)"
    out = subprocess.run([sys.executable, "-c", back, str(tmp_path / "f")], capture_output=True, text=True, cwd=tmp_path)
    assert out.stdout.strip() == "hashes", out.stderr
