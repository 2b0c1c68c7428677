"""The pipeline against brute force, stage by stage."""

import re

import corpus_pipeline
from millrace.llm import quality_rules, secrets
from millrace.llm.queries import vocabulary

from . import brute


def kept_by_quality(spark, sf, rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = quality_rules.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rejected = {r.doc_id for r in quality_rules.judge(docs, rules).where("not base_failed and not kept").collect()}
    return [(i, t) for i, t in rows if not brute.quality(t)[5] and i not in rejected]


def without_copies(rows):
    best = {}
    for i, t in rows:
        key = brute.low(t or "")
        best[key] = min(i, best.get(key, i))
    return [(i, t) for i, t in rows if best[brute.low(t or "")] == i]


def without_near(rows):
    keep = {i for i, _, _, kept in brute.near(rows, 5, 80) if kept}
    return [(i, t) for i, t in rows if i in keep]


def redacted(text):
    spans = []
    for r in secrets.BASE + secrets.MORE:
        spans += [m.span() for m in re.finditer(r.pattern, text, r.flags) if r.test(m)]
    out, last = "", 0
    for a, b in sorted(spans):
        if a >= last:
            out += text[last:a] + "[SECRET]"
        last = max(last, b)
    return out + text[last:]


def test_pipeline(spark, sf, rows):
    from tokenizers import Tokenizer

    left = without_near(without_copies(kept_by_quality(spark, sf, rows)))
    assert 0 < len(left) < len(rows)
    want = brute.token_pieces([(i, redacted(t)) for i, t in left], Tokenizer.from_file(vocabulary()))
    out = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want


def test_stages_keep_columns_and_bear_empty_tables(spark, sf, empty):
    for folder in (sf, empty):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_redaction_counts_code_points(spark):
    frame = spark.createDataFrame([(1, "🙂 token=abcdef12 é", "x", 9), (2, None, None, None), (3, "clean", "y", 7)], "doc_id long, text string, token string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(frame, length_col="n_chars").collect()}
    assert out == {1: ("🙂 [SECRET] é", 12), 2: (None, None), 3: ("clean", 7)}
