"""Personal data: patterns, and terms that give it away.

Method: information-theoretic sanitisation. Patterns find protected entities (email, ip, card, phone). The words within
``REACH`` words of an entity, on its line, are its context. Over the whole corpus, with N words, c(t) occurrences of a term
and c(t, e) of them in contexts of entities of kind e,

    PMI(t; e) = log2((c(t, e) / c(t)) / p(e)),   IC(e) = -log2 p(e),   p(e) = 2 * REACH * c(e) / N,

and PMI(t; e) <= IC(e), with equality if the term never stands elsewhere. A term with PMI(t; e) >= ALPHA * IC(e) in
``SUPPORT`` or more distinct contexts discloses the entity; wherever it stands in any text it is a span too, and is removed when
a text is sanitised, while entities are generalised to their kind. Every count is of all occurrences, copies too; only for ``SUPPORT``
do copies of a context count once. Native DataFrame operations throughout.

One pass over the texts finds entities and contexts, one counts terms, one looks up the disclosing terms among all words of all texts.

Cases: a null text is empty; null and repeated ids are rows of their own; an empty table gives an empty result;
extra columns are ignored. Offsets count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, WS, checked_join, let, stash

KINDS = ("email", "ip", "card", "phone")
REACH = 8
ALPHA = 0.85
SUPPORT = 12
#: What a part of a line begins with, up to REACH words.
FEW_WORDS = rf"^[{WS}]*+(?:[^{WS}]++[{WS}]*+){{0,{REACH}}}+"
SPANS = "array<struct<start:int,end:int>>"

#: The contract's patterns, each written so that a search is linear: a run that fails at its start is not tried again inside
#: (lookbehind), except right behind a match (\\G), and loops don't give back what they took (++). A card run of
#: under 16 digits can only fail, so 16 are asked for at once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""

    def of(back: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            d = F.substring(back, i + F.lit(1), F.lit(1)).cast("int")
            twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return total + F.when(i % 2 == 1, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(0), F.length(back) - F.lit(1)), F.lit(0), add) % 10 == 0

    return let(F.reverse(digits), of)


def passes(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return let(digits, lambda d: F.length(d).between(16, 19) & luhn(d))
    return F.length(digits).between(8, 15)


def spans(kind: str, text: Column) -> Column:
    """Leftmost, non-overlapping matches that pass, as array<struct<start, end>>.

    The regex gives the matches and, as a separator, what lies between; their lengths add up to the places.
    """
    pattern = PATTERNS[kind]
    none = F.array().cast(SPANS)

    def placed(x: Column) -> Column:
        found, gaps = x["found"], x["gaps"]

        def step(acc: Column, i: Column) -> Column:
            m = F.get(found, i)
            start = acc["at"] + F.length(F.get(gaps, i))
            end = start + F.length(m)
            more = F.when(passes(kind, m), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["out"])
            return F.struct(end.alias("at"), more.alias("out"))

        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - F.lit(1)), start, step)["out"]

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    sign = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
    worth = text.rlike(pattern) if sign is None else text.contains(sign) & text.rlike(pattern)
    return F.when(worth, let(both, placed)).otherwise(none)


def term(word: Column) -> Column:
    """The form in which words are counted: lower case, without the punctuation behind."""
    return F.lower(F.rtrim(word, F.lit(".,;:!?")))


def context(text: Column, span: Column) -> Column:
    """Words within reach of a span on its line: struct<mark, words: array<struct<term, start, end>>>; mark is the context's hash."""
    left = F.substring_index(F.substring(text, F.lit(1), span["start"]), "\n", -1)
    right = F.substring_index(F.substring(text, span["end"] + F.lit(1), F.length(text)), "\n", 1)
    # as much of the line as REACH words take, however long they are; to the left it is read backwards
    near_left = F.reverse(F.regexp_extract(F.reverse(left), FEW_WORDS, 0))
    near_right = F.regexp_extract(right, FEW_WORDS, 0)

    def words(part: Column, before: Column, first: bool) -> Column:
        """Pieces between single white space, so lengths give places; empty pieces are no words."""
        pieces = F.split(part, f"[{WS}]")

        def step(acc: Column, w: Column) -> Column:
            one = F.array(F.struct(term(w).alias("term"), acc["at"].alias("start"), (acc["at"] + F.length(F.rtrim(w, F.lit(".,;:!?")))).alias("end")))
            return F.struct((acc["at"] + F.length(w) + F.lit(1)).alias("at"), F.when(w == "", acc["out"]).otherwise(F.concat(acc["out"], one)).alias("out"))

        start = F.struct(before.alias("at"), F.array().cast("array<struct<term:string,start:int,end:int>>").alias("out"))
        out = F.aggregate(pieces, start, step)["out"]
        return let(out, lambda o: F.slice(o, 1, REACH) if first else F.slice(o, F.greatest(F.size(o) - F.lit(REACH - 1), F.lit(1)), F.lit(REACH)))

    def both(x: Column) -> Column:
        near = F.concat(words(x["left"], span["start"] - F.length(x["left"]), False), words(x["right"], span["end"], True))
        return let(near, lambda n: F.struct(F.xxhash64(F.transform(n, lambda w: w["term"])).alias("mark"), F.filter(n, lambda w: w["term"] != "").alias("words")))

    return let(F.struct(near_left.alias("left"), near_right.alias("right")), both)


def taken(w: Column, found: Column) -> Column:
    """Whether a word overlaps an entity."""
    hit = F.lit(False)
    for k in KINDS:
        hit = hit | F.exists(found[k], lambda s: (s["start"] < w["end"]) & (s["end"] > w["start"]))
    return hit


def places(text: Column, terms: Column, found: Column) -> Column:
    """Spans of the words of a whole text that are among ``terms``, in order, as array<struct<start, end>>."""

    def step(acc: Column, w: Column) -> Column:
        one = F.struct(acc["at"].alias("start"), (acc["at"] + F.length(F.rtrim(w, F.lit(".,;:!?")))).alias("end"))
        more = F.when(F.array_contains(terms, term(w)) & ~taken(one, found), F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct((acc["at"] + F.length(w) + F.lit(1)).alias("at"), more.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))
    return F.aggregate(F.split(text, f"[{WS}]"), start, step)["out"]


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row, doc_id, text, n_words, found (struct of the kinds' spans), contexts (array of kind, mark, words)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = F.struct(*[spans(k, F.col("text")).alias(k) for k in KINDS])
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(f"[^{WS}]+")).alias("n_words"), found.alias("found"))
    any_found = sum((F.size(F.col("found")[k]) for k in KINDS), F.lit(0)) > 0

    def of(k: str) -> Column:
        def one(s: Column) -> Column:
            return let(context(F.col("text"), s), lambda c: F.struct(F.lit(k).alias("kind"), c["mark"].alias("mark"), F.filter(c["words"], lambda w: ~taken(w, F.col("found"))).alias("words")))

        return F.transform(F.col("found")[k], one)

    contexts = F.when(any_found, F.concat(*[of(k) for k in KINDS]))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "n_words", "found", contexts.alias("contexts"))


def disclosing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text", alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """(term, kind, score) of the terms that disclose a kind; score is PMI / IC."""
    near = found.where("contexts is not null")
    seen = near.select(F.explode("contexts").alias("c")).select("c.kind", "c.mark", F.explode("c.words").alias("w")).select("kind", "mark", F.col("w.term").alias("term")).distinct()
    held = seen.groupBy("term", "kind").agg(F.count(F.lit(1)).alias("n_contexts")).where(F.col("n_contexts") >= support)

    def near_kind(k: str) -> Column:
        """A row's words near entities of a kind, each once however many of them it is near."""
        words = F.flatten(F.transform(F.filter("contexts", lambda c: c["kind"] == k), lambda c: c["words"]))
        return F.struct(F.lit(k).alias("kind"), F.array_distinct(words).alias("words"))

    stood = near.select(F.explode(F.array(*[near_kind(k) for k in KINDS])).alias("c")).select("c.kind", F.explode("c.words").alias("w"))
    stood = stood.groupBy(F.col("w.term").alias("term"), "kind").agg(F.count(F.lit(1)).alias("c_te"))
    with_kind = stash(stood.join(held.select("term", "kind"), ["term", "kind"]), "near-terms")
    asked = with_kind.select("term").distinct()
    few = asked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    words = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), f"[{WS}]+")).alias("w")).select(term(F.col("w")).alias("term"))
    counts = words.join(F.broadcast(asked), "term", "left_semi") if few else words.join(asked, "term", "left_semi")
    counts = counts.groupBy("term").agg(F.count(F.lit(1)).alias("c_t"))
    total = found.agg(F.sum("n_words").alias("n"), *[F.sum(F.size(F.col("found")[k])).alias(k) for k in KINDS])
    share = total.select("n", F.explode(F.create_map(*[x for k in KINDS for x in (F.lit(k), F.col(k))])).alias("kind", "c_e")).select("kind", F.least(F.col("c_e") * 2 * REACH / F.greatest("n", F.lit(1)), F.lit(0.5)).alias("p"))
    scored = with_kind.join(counts, "term").join(F.broadcast(share), "kind")  # one row per kind
    score = F.log2(F.col("c_te") / F.col("c_t") / F.col("p")) / -F.log2("p")
    return scored.select("term", "kind", score.alias("score")).where(F.col("score") >= alpha)


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """Per row: doc_id, and found: spans ``array<struct<kind, start, end>>``, base kinds as listed and then terms, each by start."""
    found = stash(entities(docs, id_col, text_col), "entities")
    terms = stash(disclosing_terms(docs, found, text_col, alpha, support), "terms")
    words = found.select("row", F.explode(F.split("text", f"[{WS}]+")).alias("w")).select("row", term(F.col("w")).alias("term"))
    told = checked_join(words, terms.select("term").distinct(), ["term"], "left_semi").groupBy("row").agg(F.collect_set("term").alias("terms"))

    def named(k: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    parts = [named(k, F.col("found")[k]) for k in KINDS]
    more = named("term", F.when(F.col("terms").isNotNull(), places(F.col("text"), F.col("terms"), F.col("found"))).otherwise(F.array().cast(SPANS)))
    return checked_join(found, stash(told, "told"), ["row"], "left").select("doc_id", F.concat(*parts, more).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with entities generalised to their kind, as <kind>, and disclosing terms removed."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        mark = F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        more = F.concat(acc["out"], F.substring(text, acc["at"] + F.lit(1), s["start"] - acc["at"]), mark)
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(s["end"].alias("at"), more.alias("out")))

    done = F.aggregate(by_start, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return let(done, lambda d: F.concat(d["out"], F.substring(text, d["at"] + F.lit(1), F.length(text))))
