"""String, regex, JSON and hash functions, each from columns to a column. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Macros and base-unit marks that corpus statistics look for.
MACROS = ("\\text", "\\cdot", "\\frac", "\\Theta", "\\Omega", "\\mu", "\\circ", "\\Delta", "\\pi")
BASE_MARKS = {
    "L": ("\\text{m}", "\\text{L}"),
    "M": ("\\text{kg}", "\\text{M}"),
    "T": ("\\text{s}", "\\text{T}"),
    "I": ("\\text{A}", "\\text{I}"),
    "Theta": ("\\text{K}", "\\Theta", "°C"),
    "N": ("\\text{mol}", "\\text{N}"),
    "J": ("\\text{cd}", "\\text{J}"),
}
DIMENSIONLESS_MARKS = ("\\text{1}", "\\text{dimensionless}")


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def approx_tokens(text: Column) -> Column:
    """Words and punctuation marks, times 1.1, rounded down; at least 1 unless the text is null or empty."""
    found = F.regexp_count(text, F.lit(r"(?U)[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.floor(found.cast("double") * F.lit(1.1)).cast("int"))).cast("long")


def char_tokens(text: Column, per_token: float = 3.8) -> Column:
    """Tokens by length alone."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / F.lit(per_token)).cast("int")).cast("long")


def words(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs, as strings parted by one space."""
    return F.zip_with(F.slice(tokens, 1, F.greatest(F.size(tokens) - F.lit(1), F.lit(0))), F.slice(tokens, 2, F.greatest(F.size(tokens) - F.lit(1), F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def unescaped(text: Column, mark: str) -> Column:
    """How often ``mark`` (a regex) stands without a backslash before it."""
    return F.regexp_count(text, F.lit(rf"(?<!\\){mark}"))


def math_problems(text: Column) -> Column:
    """Messages about unbalanced dollar signs and curly braces; an empty array if the text is well-formed."""
    dollars, left, right = unescaped(text, r"\$"), unescaped(text, r"\{"), unescaped(text, r"\}")
    return F.array_compact(
        F.array(
            F.when(dollars % 2 != 0, F.concat(F.lit("Unbalanced inline/block math '$' delimiters (found "), dollars.cast("string"), F.lit(")."))),
            F.when(left != right, F.concat(F.lit("Unbalanced curly braces '{}' (open: "), left.cast("string"), F.lit(", close: "), right.cast("string"), F.lit(")."))),
        )
    )


def well_formed(text: Column) -> Column:
    return F.size(math_problems(text)) == 0


def uri_tail(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)


def preview(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def title(key: Column) -> Column:
    """``some_key`` as ``Some Key``."""
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def text_key(text: Column) -> Column:
    """SHA-256 of the text without white space around it, in lower case."""
    return F.sha2(F.lower(strip(text)), 256)


def cache_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("_", *parts), 256)


def persona_of(explicit: Column, metadata: Column, record_id: Column, personas: list[str], default: str = "general_user") -> Column:
    """Explicit value, else metadata's, else the first persona of the list that is a part of the id between underscores, else the default."""
    found = F.lit(None).cast("string")
    for p in reversed(personas):
        part = record_id.contains(f"_{p}_") | record_id.endswith(f"_{p}") | record_id.startswith(f"{p}_")
        found = F.when(part, F.lit(p)).otherwise(found)
    return F.coalesce(F.nullif(explicit, F.lit("")), F.nullif(metadata, F.lit("")), found, F.lit(default))


def persona_third(record_id: Column, default: str = "general_user") -> Column:
    """The id's third part between underscores: the cruder rule that corpus statistics use."""
    return F.coalesce(F.get(F.split(record_id, "_"), F.lit(2)), F.lit(default))


def category_of(explicit: Column, uri: Column) -> Column:
    by_uri = (
        F.when(uri.contains("/constant/") | uri.contains("constants"), "constants")
        .when(uri.contains("/quantitykind/") | uri.contains("quantity_kind"), "quantity_kinds")
        .otherwise("units")
    )
    return F.coalesce(F.nullif(explicit, F.lit("")), by_uri)


def size_bucket(count: Column) -> Column:
    """Size class of a dataset, as dataset cards name it."""
    return F.when(count < 1000, "n<1K").when(count < 10_000, "1K<n<10K").when(count < 100_000, "10K<n<100K").when(count < 1_000_000, "100K<n<1M").otherwise("1M<n<10M")


def context_length(p99: Column) -> Column:
    return F.when(p99 <= 512, 512).when(p99 <= 1024, 1024).otherwise(2048)


def human_bytes(count: Column) -> Column:
    """Bytes with a unit: as they are below 1024, else with one digit behind the point."""
    scaled = lambda power, unit: F.format_string(f"%.1f {unit}", count / float(1024**power))
    return F.when(count < 1024, F.concat(count.cast("string"), F.lit(" B"))).when(count < 1024**2, scaled(1, "KB")).when(count < 1024**3, scaled(2, "MB")).otherwise(scaled(3, "GB"))


#: What a file of a published site is, by patterns of its path; the first that fits counts.
FILE_LABELS = (
    (r"^index\.html$", "Web Portal Landing"), (r"^dataset_viewer\.html$", "Dataset Explorer App"), (r"^benchmark/leaderboard\.html$", "Model Leaderboard App"), (r"^benchmark/benchmark_viewer\.html$", "Benchmark Reviewer App"),
    (r"^benchmark/.*_scorecard\.json$", "Model Evaluation Scorecard"), (r"^benchmark/.*\.jsonl$", "Benchmark Gold Testbed"), (r"^benchmark/", "Benchmark Report & Metadata"),
    (r"^(manifest|dataset_stats)\.json$", "Dataset Manifest & Telemetry"), (r"(?i)report", "Scientific Report & Card"), (r"^dataset_card\.md$", "Scientific Report & Card"), (r"\.jsonl$", "Dataset Split / Samples"),
    (r"^by_persona/", "Persona Partition"), (r"^by_archetype/", "Archetype Partition"), (r"^by_category/", "Category Partition"), (r"^formats/", "Export Format Partition"),
)


def _first_of(subject: Column, table: tuple, otherwise: Column, flags: str = "(?i)") -> Column:
    """The name behind the first pattern of a table that the subject has."""
    out = otherwise
    for pattern, name in reversed(table):
        out = F.when(subject.rlike(flags + pattern), name).otherwise(out)
    return out


def file_label(path: Column) -> Column:
    return _first_of(F.replace(path, F.lit("\\"), F.lit("/")), FILE_LABELS, F.lit("Website Asset"), "")


#: Names of model servers by what an endpoint holds, local ones by port or word, remote ones by domain.
LOCAL_SERVERS = (("11434", "Ollama (Local Host)"), ("1234", "LM Studio (Local Host)"), ("8000|vllm", "vLLM (Local Host)"), ("8080|llama", "llama.cpp (Local Host)"))
LOCAL_PROXIES = (("11434", "Ollama Cloud (Proxy via Local Host)"), ("1234", "LM Studio Cloud Proxy"))
REMOTE = (
    ("openai\\.com", "OpenAI API (Cloud)"), ("anthropic\\.com", "Anthropic API (Cloud)"), ("groq\\.com", "Groq API (Cloud)"), ("together\\.(xyz|ai)", "Together AI (Cloud)"), ("deepseek\\.com", "DeepSeek API (Cloud)"),
    ("openrouter\\.ai", "OpenRouter (Cloud)"), ("mistral\\.ai", "Mistral AI (Cloud)"), ("cohere\\.(com|ai)", "Cohere (Cloud)"), ("azure\\.com", "Azure OpenAI (Cloud)"), ("bedrock|amazonaws\\.com", "AWS Bedrock (Cloud)"),
)


def endpoint_class(url: Column, model: Column | None = None, override: Column | None = None) -> Column:
    """struct<exec_type, provider, url, is_local> of a model's endpoint.

    Baselines come first, then a missing endpoint, an explicit type, a local host (a model with a cloud tag is a proxy there), and the rest by
    domain. The URL is left with scheme, host and path.
    """
    model = F.lower(F.coalesce(model, F.lit(""))) if model is not None else F.lit("")
    asked = F.lower(F.coalesce(override, F.lit(""))) if override is not None else F.lit("")
    ep = F.trim(F.coalesce(url, F.lit("")))
    host = F.lower(F.regexp_extract(ep, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))
    clean = F.regexp_replace(ep, r"[?#].*$", "")
    local = host.isin("localhost", "127.0.0.1", "0.0.0.0", "[::1]", "[0:0:0:0:0:0:0:1]") | ep.contains("127.0.0.1") | ep.contains("localhost")
    tagged = model.rlike("[-:/_]cloud|cloud/|cloud$")
    remote_name = F.concat(F.lit("Cloud API ("), F.when(host != "", host).otherwise(model), F.lit(")"))
    unknown = F.concat(F.lit("Remote Cloud Endpoint ("), F.when(host != "", host).otherwise("unknown"), F.lit(")"))
    row = lambda kind, name, where, here: F.struct(F.lit(kind).alias("exec_type"), name.alias("provider"), where.alias("url"), F.lit(here).alias("is_local"))
    none = F.lit(None).cast("string")
    return (
        F.when(model.isin("ground_truth_baseline", "baseline", "gold"), row("baseline", F.lit("In-Memory Deterministic Baseline"), none, True))
        .when(ep == "", row("local", F.lit("Local Inference"), none, True))
        .when(asked.isin("cloud", "remote"), row("cloud", F.when(local & ep.contains("11434"), LOCAL_PROXIES[0][1]).otherwise(remote_name), clean, False))
        .when(asked == "local", row("local", F.when(ep.contains("11434"), LOCAL_SERVERS[0][1]).otherwise("Local Server"), clean, True))
        .when(local & tagged, row("cloud", _first_of(ep, LOCAL_PROXIES, F.lit("Local Proxy (Cloud-Hosted Model)")), clean, False))
        .when(local, row("local", _first_of(ep, LOCAL_SERVERS, F.lit("Local OpenAI-Compatible Server")), clean, True))
        .otherwise(row("cloud", _first_of(host, REMOTE, unknown), clean, False))
    )


#: Why a call is fatal, by its status and by words of its message, in order.
FATAL = (("authentication", "401", ("unauthorized", "invalid_api_key", "authentication")), ("forbidden", "403", ("forbidden", "permission_denied")), ("not_found", "404", ("not found",)), ("unreachable", None, ("connection refused", "failed to connect")))
#: Fixed value: how the message of a failed call begins.
FAILED_CALL = "ERROR_CALLING_MODEL:"


def error_class(message: Column) -> Column:
    """Why a failed call is fatal, or null for what may be tried again and for what is no failed call. A status goes before words of the same kind; kinds go in their order."""
    said = F.lower(message)
    kinds = []
    for kind, status, words in FATAL:
        by_status = F.lit(False) if status is None else F.contains(said, F.lit(status))
        by_words = F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(said, w))
        kinds.append(F.when(by_status | by_words, kind))
    return F.when(F.startswith(message, F.lit(FAILED_CALL)), F.coalesce(*kinds))


def glob_regex(pattern: str) -> str:
    """An anchored Java regex for a shell pattern."""
    import re

    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern) + "$"


def included(path: Column, include: list[str], exclude: list[str]) -> Column:
    """Whether a path or its file name fits a pattern of ``include`` and none of ``exclude``."""

    def fits(patterns: list[str]) -> Column:
        out = F.lit(False)
        for p in patterns:
            out = out | path.rlike(glob_regex(p)) | uri_tail(path).rlike(glob_regex(p))
        return out

    return fits(include) & ~fits(exclude)


def escaped_html(text: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def slug(sample_id: Column) -> Column:
    """An id in lower case, with runs of other symbols as one dash and none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(sample_id), "[^a-z0-9]+", "-"), "^-|-$", "")


#: What stands for a math command where math is not set.
PLAIN_MATH = {"\\cdot": "·", "\\Theta": "Θ", "\\Delta": "Δ", "\\nu": "ν", "\\pm": "±", "\\circ": "°"}


def plain_math(text: Column) -> Column:
    """Math without its commonest commands, for places that do not set math; a null text is empty."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\text\{([^}]+)\}", "$1")
    for command, sign in PLAIN_MATH.items():
        out = F.replace(out, F.lit(command), F.lit(sign))
    return out
