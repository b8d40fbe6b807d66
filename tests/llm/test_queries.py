"""Numbered queries against their DuckDB SQL, and the pipeline stage by stage, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["op2_mixing", "op3_ngram_join", "op7_warc", "op9_chat", "op11_prefix_trie"])
def test_query_matches_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF_SMALL).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    same = [x.sort_values(cols[:4]).reset_index(drop=True)[cols].astype(object).where(lambda t: t.notna(), None) for x in (got, want)]
    assert same[0].equals(same[1]) or (same[0] == same[1]).where(same[0].notna(), True).all().all()


def test_pipeline_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "pii", "mixing", "packing"]
    predicted = {r["doc_id"]: r["predicted"] for r in entry.queries()["op1_toxicity"](spark, SF_SMALL).collect()}
    clean = stages["toxicity"](spark, docs, SF_SMALL).cache()
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, p in predicted.items() if not p}
    kept = stages["ngram_jaccard_join"](spark, clean, SF_SMALL).cache()
    assert kept.columns == docs.columns and 0 < kept.count() < clean.count()
    safe = stages["pii"](spark, kept, SF_SMALL).cache()
    assert safe.columns == docs.columns and safe.count() == kept.count()
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    for r in safe.collect():
        had = bool(re.search(r"[\w.]+@[\w-]+\.[\w.]+", texts[r["doc_id"]], re.A))
        assert ("[EMAIL]" in r["text"]) == had and len(r["text"]) == (r["n_chars"] if r["text"] != texts[r["doc_id"]] else len(r["text"]))
    mixed = stages["mixing"](spark, safe, SF_SMALL).cache()
    assert mixed.columns == docs.columns and mixed.count() > 0
    packed = stages["packing"](spark, mixed, SF_SMALL)
    ends = packed.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in ends) <= 2048 and packed.where("start = 0").count() == mixed.count()
