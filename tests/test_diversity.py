"""Distinct words and pairs, on odd texts, and what their grouping sends."""

import re

from millrace.plans import corpus


def test_lexical_diversity_sends_no_text(spark, tmp_path):
    texts = [None, "", " - ", "one", "One ONE two", "one two", "a b a b a", "été_1 日本 été_1", "b\na"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus.lexical_diversity(spark, str(tmp_path))
    words = [re.findall(r"\w+", (t or "").lower()) for t in texts]
    pairs = {p for w in words for p in zip(w, w[1:])}
    every = [x for w in words for x in w]
    assert out.collect() == [(len(every), len(set(every)), len(pairs), round(len(set(every)) / len(every), 3), round(len(pairs) / len(every), 3))]
    keys = re.findall(r"hashpartitioning\(([^()]*), \d+\)", out._jdf.queryExecution().executedPlan().toString())
    assert keys and all(re.fullmatch(r"\w+#\d+L", k) for ks in keys for k in ks.split(", "))  # L: a long
