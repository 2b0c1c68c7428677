"""Reports of a corpus: statistics as one row, and its cards and tables as Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import relational


def statistics(records: DataFrame) -> dict:
    """Figures of records (id, split, archetype, persona, user_query, ground_truth_answer): counts, token distributions, math, dimensions, diversity.

    One pass gives all counts; the distributions and the vocabulary each add a grouping.
    """
    q, a = F.coalesce("user_query", F.lit("")), F.coalesce("ground_truth_answer", F.lit(""))
    rows = records.withColumns({"prompt": text.approx_tokens(q), "response": text.approx_tokens(a)}).withColumn("total", F.col("prompt") + F.col("response"))
    has = lambda c, marks: F.greatest(F.lit(False), *[F.contains(c, F.lit(m)) for m in marks])
    counts = {
        "records": F.count(F.lit(1)), "personas": F.count_distinct("persona"), "archetypes": F.count_distinct("archetype"),
        "inline_math": F.count_if(F.contains(q, F.lit("$")) | F.contains(a, F.lit("$"))), "display_math": F.count_if(F.contains(a, F.lit("$$"))), "dimensionless": F.count_if(has(a, text.DIMENSIONLESS_MARKS)),
    }
    counts |= {f"split_{s}": F.count_if(F.col("split") == s) for s in ("train", "val", "test")}
    counts |= {f"macro {m}": F.count_if(F.contains(q, F.lit(m)) | F.contains(a, F.lit(m))) for m in text.MACROS}
    counts |= {f"base {d}": F.count_if(has(a, marks)) for d, marks in text.BASE_MARKS.items()}
    one = rows.agg(*[c.alias(n) for n, c in counts.items()]).first().asDict()
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("tokens")) for k in ("prompt", "response", "total")])).alias("t")).select("t.*")
    shape = {r["kind"]: r.asDict() for r in relational.distribution(long, "tokens", ["kind"]).collect()}
    d = relational.diversity(rows.select(text.words(q).alias("w"))).select(F.coalesce("total_words", F.lit(0)).alias("words"), "vocabulary", "pairs").first()
    p99 = shape["total"]["p99"] if shape else 0
    per = lambda x: round(x / max(1, d["words"]), 3)
    macros = sorted(((m, one[f"macro {m}"]) for m in text.MACROS if one[f"macro {m}"]), key=lambda x: -x[1])[:10]
    top = relational_top(rows, "persona", 15)
    return {
        "summary": {k: one[k] for k in ("records", "personas", "archetypes", "split_train", "split_val", "split_test")} | {"recommended_context": 512 if p99 <= 512 else 1024 if p99 <= 1024 else 2048},
        "tokens": shape, "inline_math_pct": round(100 * one["inline_math"] / max(1, one["records"]), 1), "display_math_pct": round(100 * one["display_math"] / max(1, one["records"]), 1),
        "macros": dict(macros), "base_dimensions": {b: one[f"base {b}"] for b in text.BASE_MARKS}, "dimensionless": one["dimensionless"],
        "lexical": {"words": d["words"], "vocabulary": d["vocabulary"], "distinct_1": per(d["vocabulary"]), "distinct_2": per(d["pairs"])}, "top_personas": top,
    }


def relational_top(rows: DataFrame, key: str, n: int) -> dict[str, int]:
    """The ``n`` most frequent values; among equals the one whose record comes first."""
    top = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).orderBy(F.desc("n"), "first").limit(n)
    return {r[key]: r["n"] for r in top.collect()}


def group_report(records: DataFrame, key: str, other: str, titles: DataFrame | None = None) -> DataFrame:
    """Per value of ``key``: records, share, counts by ``other``, generators, title, most frequent first."""
    known = records.withColumns({c: F.coalesce(c, F.lit("")) for c in (other, "llm_generator")})  # keys of maps are not null
    counts = known.groupBy(key, other, "llm_generator").agg(F.count(F.lit(1)).alias("n"))
    by_other = counts.groupBy(key, other).agg(F.sum("n").alias("n")).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(other, "n")))).alias(f"by_{other}"), F.sum("n").alias("records"))
    by_generator = counts.groupBy(key, "llm_generator").agg(F.sum("n").alias("n")).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("llm_generator", "n")))).alias("generators"))
    out = by_other.join(by_generator.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    total = records.count()
    out = out.withColumn("share_pct", F.round(100.0 * F.col("records") / F.lit(max(1, total)), 2))
    if titles is not None:
        out = relational.lookup(out, titles.select(key, "title"), [key])
    return out.withColumn("title", F.coalesce(F.col("title") if titles is not None else F.lit(None).cast("string"), text.title(F.col(key)))).orderBy(F.desc("records"), key)


def previews(records: DataFrame, key: str, length: int = 120) -> DataFrame:
    """The first two records of each group, with a short query."""
    return relational.first_n(records, [key], ["id"], 2).select(key, "id", text.preview(F.col("user_query"), length).alias("preview"))


def markdown(rows: list[dict], columns: list[str]) -> str:
    """A Markdown table."""
    cell = lambda v: str("" if v is None else v).replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *("| " + " | ".join(cell(r.get(c)) for c in columns) + " |" for r in rows)])


def card(stats: dict, name: str) -> str:
    """A dataset card."""
    n = stats["summary"]["records"]
    bucket = "n<1K" if n < 1000 else "1K<n<10K" if n < 10_000 else "10K<n<100K" if n < 100_000 else "100K<n<1M" if n < 1_000_000 else "1M<n<10M"
    shape = [{"tokens": k, **v} for k, v in sorted(stats["tokens"].items())]
    head = f"---\npretty_name: {name}\nsize_categories:\n- {bucket}\n---\n\n# {name}\n\n{n} records; recommended context length {stats['summary']['recommended_context']}.\n"
    return head + "\n## Tokens\n\n" + markdown(shape, ["tokens", "min", "mean", "median", "p95", "p99", "max", "std"]) + "\n\n## Most frequent personas\n\n" + markdown([{"persona": k, "records": v} for k, v in stats["top_personas"].items()], ["persona", "records"]) + "\n"
