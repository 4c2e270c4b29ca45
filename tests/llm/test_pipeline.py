"""The pipeline against plain versions of its stages, on a small corpus with planted cases."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_copies import plain as copies
from tests.llm.test_search import contaminated


def corpus():
    rng = random.Random(21)
    pool = [f"wort{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    passage = text(30)
    docs = [[i, text(rng.randint(40, 200)), "en", f"src{i % 3}"] for i in range(260)]
    labels = []
    for i in range(0, 200):
        bad = i % 6 == 0
        if bad:
            docs[i][1] += " grobian grobian vilain"
        labels.append((i, 1, int(bad)))
    docs[201][1] = docs[205][1] = docs[200][1]                          # exact copies
    docs[202][1] = docs[200][1].replace(" ", "\n").replace("w", "W")   # near copy
    docs[210][1] = text(20) + " " + passage + " " + text(20)            # contaminated
    docs[211][1] = text(900) + " " + passage                            # too little of it
    docs[220][1] = "mail a.b@example.com now " + text(30)
    docs[221][1], docs[222][1] = None, ""
    docs[230][1] += " grobian vilain vilain"                            # toxic without a label
    docs.append([None, text(30), "en", None])
    docs.append([204, docs[204][1], "en", "src0"])
    return docs, labels, [(1, passage), (2, text(14))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    docs, labels, items = corpus()
    spark.createDataFrame([(*d, len(d[1] or ""), "x") for d in docs],
                          "doc_id long, text string, lang string, source string, n_chars long, score string"
                          ).repartition(3).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def test_pipeline(spark, folder):
    docs, _, items = corpus()
    kept = [d for d in docs if "grobian" not in (d[1] or "")]
    rows = {(d[0], d[1]) for d in kept} - set(copies([(d[0], d[1]) for d in kept]))
    kept = [d for d in kept if (d[0], d[1]) not in rows]
    dirty = {(i, n) for i, n, *_, bad in contaminated([(d[0], d[1]) for d in kept], items) if bad}
    kept = [d for d in kept if (d[0], len((d[1] or "").split())) not in dirty]
    ids = [d[0] for d in kept]
    assert not {201, 202, 205, 210, 222, 230} & set(ids) and {200, 211, 220, 221, None} <= set(ids)
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = []
    for i, t, lang, source in kept:
        t = (t or "").replace("a.b@example.com", "<EMAIL>")
        want.append((i, lang, source, "x", library.encode(t, add_special_tokens=False).ids))
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "lang", "source", "score", "ids", "n_tokens"]
    assert sorted(repr(tuple(r)[:5]) for r in got.collect()) == sorted(map(repr, want))


def test_stages_keep_columns_and_take_no_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
    masked = corpus_pipeline.mask_personal(spark, docs, folder).filter("doc_id in (220, 221)").orderBy("doc_id").collect()
    assert masked[0].n_chars == len(masked[0].text) and masked[1].text is None
