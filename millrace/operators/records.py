"""Records in the shapes that tools exchange: chat records, viewer rows, prompts and tracks; and names of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

#: The instructions behind a question, for a choice and for a value, with what they show as an example.
CHOICE = 'Instructions: Analyze the options carefully and select the single correct letter (A, B, C, or D).\nRespond in valid JSON format with keys "answer" (the single uppercase letter) and "explanation" (brief justification).'
VALUE = 'Instructions: Provide the exact numerical value and unit for the answer.\nRespond in valid JSON format with keys "answer" (the exact value and unit) and "explanation" (brief justification).'
CHOICE_EXAMPLE = ("A", "Brief explanation of the metrological rationale.")
VALUE_EXAMPLE = ("1.054571817e-34 J s", "Exact by the 2019 SI definition.")
#: Roles of either chat format, and tabs of a published site's files by folder.
ROLES = {"system": "system", "user": "user", "human": "user", "assistant": "assistant", "gpt": "assistant"}
TABS = (("by_persona/", "Persona"), ("by_archetype/", "Archetype"), ("by_category/", "Category"), ("benchmark/", "Benchmark"))
#: Prefix of a model's name by provider, and where local providers listen.
NAME_PREFIX = {"google": "gemini/", "gemini": "gemini/", "ollama": "ollama/", "openai": "openai/", "vllm": "openai/", "hosted_vllm": "openai/"}
LOCAL_BASE = {"ollama": "http://localhost:11434", "lm_studio": "http://localhost:1234/v1"}


def prompt(question: Column, options: Column | None = None) -> Column:
    """A question with its options (array of structs key, text), if it has any, and instructions to answer in JSON."""

    def told(instructions: str, example: tuple[str, str]) -> Column:
        shown = f'{{\n  "answer": "{example[0]}",\n  "explanation": "{example[1]}"\n}}'
        return F.lit(f"{instructions}\n\nExample response format:\n```json\n{shown}\n```")

    asked = F.concat(F.lit("Question: "), text.strip(F.coalesce(question, F.lit(""))), F.lit("\n\n"))
    free = F.concat(asked, told(VALUE, VALUE_EXAMPLE))
    if options is None:
        return free
    listed = F.array_join(F.transform(options, lambda o: F.concat(o["key"], F.lit(". "), text.strip(o["text"]))), "\n")
    return F.when(F.coalesce(F.size(options), F.lit(0)) > 0, F.concat(asked, F.lit("Options:\n"), listed, F.lit("\n\n"), told(CHOICE, CHOICE_EXAMPLE))).otherwise(free)


def metadata(base: Column, own: Column) -> Column:
    """Two maps as one; a key of ``own`` goes before the same key of ``base``."""
    own = F.coalesce(own, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(own, k)), own)


def said(turns: Column, role: str, who: str = "role", what: str = "content") -> Column:
    """The last text of a role in an array of turns, under either format's name for the role; null if it has none."""
    names = [k for k, v in ROLES.items() if v == role]
    return F.get(F.reverse(F.filter(turns, lambda t: t[who].isin(*names))), F.lit(0))[what]


def viewer_rows(records: DataFrame, system: str, split: str = "train") -> DataFrame:
    """Any record as id, split, system_prompt, user_query, ground_truth_answer, rejected, rejection_reason, is_dpo, approx_tokens.

    A preference pair goes before ``messages`` (role, content), these before ``conversations`` (from, value), and these before flat members.
    Columns that ``records`` lacks count as null.
    """
    has = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    full = lambda c: F.coalesce(has(c), F.lit("")) != ""
    first = lambda *cols: F.coalesce(*[F.nullif(has(c), F.lit("")) for c in cols], F.lit(""))
    given = F.coalesce(has("split"), F.lit(split))
    pair = (full("prompt") & full("chosen") & full("rejected")) | (given == "dpo")
    shapes = [(c, *names) for c, *names in (("messages", "role", "content"), ("conversations", "from", "value")) if c in records.columns]

    def of(role: str, pair_col: str | None, otherwise: Column, missing: str) -> Column:
        out = F.when(pair, first(pair_col)) if pair_col else F.when(pair, F.lit(missing))
        for c, who, what in shapes:
            out = out.when(F.col(c).isNotNull(), F.coalesce(said(F.col(c), role, who, what), F.lit(missing)))
        return out.otherwise(otherwise)

    rows = records.withColumns({
        "_system": of("system", None, F.lit(system), system),
        "_user": of("user", "prompt", first("user_query", "canonical_query", "prompt"), ""),
        "_truth": of("assistant", "chosen", first("ground_truth_answer", "chosen", "answer"), ""),
        "_rejected": first("rejected"), "_reason": first("rejection_reason"), "_split": F.when(pair, "dpo").otherwise(given), "_dpo": pair,
    })
    tokens = text.char_tokens(F.concat("_system", "_user", "_truth", "_rejected"))
    return rows.select("id", F.col("_split").alias("split"), F.col("_system").alias("system_prompt"), F.col("_user").alias("user_query"), F.col("_truth").alias("ground_truth_answer"), F.col("_rejected").alias("rejected"), F.col("_reason").alias("rejection_reason"), F.col("_dpo").alias("is_dpo"), tokens.alias("approx_tokens"))


def chat_text(turns: Column, start: str = "<|im_start|>", end: str = "<|im_end|>") -> Column:
    """Turns (role, content) as one text of a chat template."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(start), t["role"], F.lit("\n"), t["content"], F.lit(end + "\n"))), "")


def read_records(spark: SparkSession, flat: str | None, chat: str | None, schema: str) -> DataFrame:
    """Augmented records of a JSON file and records read back from chat JSON lines, as one table of ``schema``."""
    parts = []
    if flat:
        parts.append(spark.read.json(flat, schema=schema, multiLine=True))
    if chat:
        lines = spark.read.json(chat, schema="id string, archetype string, entity_uri string, messages array<struct<role:string,content:string>>, metadata map<string,string>")
        told = lines.select("id", "archetype", "entity_uri", F.col("metadata")["persona"].alias("persona"), said(F.col("messages"), "user").alias("user_query"), said(F.col("messages"), "assistant").alias("ground_truth_answer"))
        kept = [c for c in told.columns if c in spark.createDataFrame([], schema).columns]
        parts.append(told.select(kept))
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def tracks(items: DataFrame) -> DataFrame:
    """Each item once for the track ``all`` and once for its own format's, in one pass."""
    return items.withColumn("track", F.explode(F.array(F.lit("all"), F.when(F.col("format") == "mcq", "mcq").otherwise("open"))))


def write_tracks(items: DataFrame, path: str) -> None:
    """The benchmark as JSON lines, a folder per track."""
    tracks(items).write.mode("overwrite").partitionBy("track").json(path)


def tab_category(path: Column) -> Column:
    """The tab of a site under which a file is listed."""
    out = F.lit("Master Split")
    for folder, name in reversed(TABS):
        out = F.when(path.startswith(folder), name).otherwise(out)
    return out


def model_name(provider: Column, model: Column) -> Column:
    """A model's name with its provider's prefix, once."""
    out = model
    for who, prefix in NAME_PREFIX.items():
        out = F.when((F.lower(provider) == who) & ~model.startswith(prefix), F.concat(F.lit(prefix), model)).otherwise(out)
    return out


def api_base(provider: Column, base: Column) -> Column:
    """Where a provider is asked: as given, else where local providers listen. Ollama's has no version and no slash at its end."""
    known = F.lit(None).cast("string")
    for who, where in LOCAL_BASE.items():
        known = F.when(F.lower(provider) == who, where).otherwise(known)
    asked = F.coalesce(F.nullif(base, F.lit("")), known)
    return F.when(F.lower(provider) == "ollama", F.regexp_replace(F.rtrim(asked, F.lit("/")), "/v1$", "")).otherwise(asked)


#: Words by which a generator talks about its task, and how long a question is at least.
ABOUT_TASK, SHORTEST = ("We need to", "JSON"), 10


def question_for(mapping: Column, persona: Column, canonical: Column, general: str = "general_user") -> Column:
    """A persona's question from a response's mapping, else the canonical one, behind the persona's title unless it is the general one.

    The mapping is asked under the persona's key and then under its words; an empty answer under the key does not count.
    """
    names = F.array(F.lower(persona), F.replace(persona, F.lit("_"), F.lit(" ")))
    answers = F.filter(F.transform(names, lambda n, k: F.when(k == 0, F.nullif(F.try_element_at(mapping, n), F.lit(""))).otherwise(F.try_element_at(mapping, n))), lambda q: q.isNotNull())
    sound = lambda q: (F.length(text.strip(q)) >= SHORTEST) & ~F.exists(F.array(*map(F.lit, ABOUT_TASK)), lambda w: F.contains(q, w))
    own = F.get(F.filter(F.slice(answers, 1, 1), sound), F.lit(0))
    titled = F.concat(F.lit("["), text.title(persona), F.lit("] "), canonical)
    return F.coalesce(own, F.when(persona != general, titled), canonical)


def present(spark: SparkSession, patterns: list[str]) -> dict[str, int]:
    """How many files each path pattern finds, in any store that Spark reads; a source without files is to be fetched."""
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    found = {p: path(p).getFileSystem(conf).globStatus(path(p)) for p in patterns}
    return {p: len(x) if x is not None else 0 for p, x in found.items()}
