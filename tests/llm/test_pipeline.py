"""Every stage of the pipeline against a plain version, on its own input."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as p

from . import test_lines
from .brute import jaccard_rows
from .test_single_pass import contamination


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_in_order(spark, sf_small):
    from chainsift.llm.common import table, written

    docs = table(spark, sf_small, "documents")
    columns, before = docs.columns, texts(docs)
    labels = {r.doc_id: r.quality == 1 and not r.toxic for r in table(spark, sf_small, "labels").collect()}
    for (name, stage), op in zip(p.STAGES, (4, 2, 10, 6, 9), strict=True):
        docs = written(stage(spark, docs, sf_small), "test")
        if op == 9:
            break
        assert docs.columns == columns, name
        now = texts(docs)
        if op == 4:
            assert now.items() <= before.items()
            known = [(i in now) == good for i, good in labels.items()]
            assert sum(known) / len(known) > 0.7  # 87 labels; accuracy is tested on the larger table
        elif op == 2:
            plain = {i: t for i, t in test_lines.brute(list(before.items())) if t == before[i] or any(x.strip() for x in t.split("\n"))}
            assert now == plain
        elif op == 10:
            assert now == {i: before[i] for i, n, c in jaccard_rows(list(before.items())) if i == c}
        else:
            items = [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()]
            hit = {i: h for i, _, h, _ in contamination(list(before.items()), items) if h}
            assert set(now) == set(before) and {i for i in now if now[i] != before[i]} == set(hit)
            words = lambda t: len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()))
            assert all(words(before[i]) - words(now[i]) == n for i, n in hit.items())
        before = now
    t = Tokenizer.from_file(public_tokenizers.path(p.TOKENIZER))
    ids = {r.doc_id: (list(r.ids), r.decoded) for r in docs.collect()}
    assert ids == {i: (e, t.decode(e, skip_special_tokens=False)) for i, x in before.items() for e in [t.encode(x, add_special_tokens=False).ids]}


def test_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(1, long, "en", None, 5), (1, long, "en", None, 5), (1, "another text altogether", None, None, None), (None, long + " x", "en", "s", 1),
            (2, None, None, None, None), (3, "", None, None, None), (4, long + " y", "en", "s", 1), (None, None, None, None, None)]
    for name, df in (("documents", spark.createDataFrame(rows, schema)), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")),
                     ("benchmark", spark.createDataFrame([(1, "another text altogether")], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = p.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in got) == [(0, False), (1, False), (1, True), (2, False), (3, False)]
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= names
