"""Quality rules learned as a decision list.

Method: sequential covering. Labelled documents are reduced to a few statistics; a rule is a conjunction of
thresholds that rejects. A rule grows by the threshold that gains most (FOIL gain), is pruned on the rows held
out, and is kept if it is precise there; rows that it covers leave, and the next rule is sought. The list becomes
one ordered Spark conditional expression. Statistics and verdicts are built-in column expressions; the documents are not shuffled.

The rules are fitted on at most ``TRAIN_ROWS`` labelled rows, those with the smallest hashes of their ids; everything else
covers all rows.

Cases: a null or empty text has zero for every statistic; labels with a null id or a null label are ignored;
without labels, or without rejected ones, no rule is learned; rows repeated are judged alike; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import WS, let, stash, words_of

TRAIN_ROWS = 20_000
#: Shares of statistics on which rules are built, and the steps to which a share is rounded while learning.
FEATURES = ("symbol_share", "repeat_share", "dup_line_share", "upper_share", "word_length", "word_count")
STEPS = 200


def repeated_words(words: Column, k: int = 3) -> Column:
    """How many words stand in a ``k``-word window that occurs twice or more in the text.

    Windows are hashed; a long holds the hash's upper bits and the window's place in its lower ones, so one sort of
    longs brings equal windows together. Neighbours of one hash are compared word by word; where they differ (a clash of hashes,
    behind which an equal window may stand), the text's windows are sorted by their words instead.
    """

    def covered(keys: Column, compare, place) -> Column:
        """From sorted keys: 0 for neighbours that differ, 1 for equal windows, 2 for a clash; then the words of what has an equal neighbour."""
        beside = F.transform(F.sequence(F.lit(1), F.size(keys) - F.lit(1)), lambda i: compare(F.get(keys, i - F.lit(1)), F.get(keys, i)))

        def counted(x: Column) -> Column:
            equal = lambda i: F.coalesce(F.get(x, i) == 1, F.lit(False))
            held = F.filter(F.sequence(F.lit(0), F.size(keys) - F.lit(1)), lambda i: F.when(i > 0, equal(i - F.lit(1))).otherwise(F.lit(False)) | equal(i))
            spread = F.flatten(F.transform(held, lambda i: let(place(F.get(keys, i)), lambda p: F.array(*[p + F.lit(j) for j in range(k)]))))
            return F.when(F.array_contains(x, 2), F.lit(None).cast("int")).otherwise(F.size(F.array_distinct(spread)))

        return let(beside, counted)

    def by_hash(w: Column) -> Column:
        shift = F.ceil(F.log2(F.size(w) + F.lit(1))).cast("int")

        def marked(both: Column) -> Column:
            b, keys = both["b"], both["keys"]
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), b) - F.lit(1).cast("long")
            place = lambda x: x.bitwiseAND(mask).cast("int")
            upper = lambda x: F.call_function("shiftrightunsigned", x, b)
            same = lambda x, y: F.slice(w, place(x) + F.lit(1), k).eqNullSafe(F.slice(w, place(y) + F.lit(1), k))
            return covered(keys, lambda x, y: F.when(upper(x) != upper(y), 0).when(same(x, y), 1).otherwise(2), place)

        def keyed(i: Column) -> Column:
            h = F.xxhash64(*[F.get(w, i + F.lit(j)) for j in range(k)])
            return F.call_function("shiftleft", h, shift).bitwiseOR(i.cast("long"))

        keys = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - F.lit(k)), keyed))
        return let(F.struct(shift.alias("b"), keys.alias("keys")), marked)

    return let(words, lambda w: F.when(F.size(w) < k + 1, F.lit(0)).otherwise(F.coalesce(by_hash(w), by_words(w, k, covered))))


def by_words(w: Column, k: int, covered) -> Column:
    """The same from windows sorted by their words: no hash, no clash."""
    keyed = lambda i: F.struct(F.slice(w, i + F.lit(1), k).alias("window"), i.alias("at"))
    keys = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - F.lit(k)), keyed))
    return let(keys, lambda x: covered(x, lambda p, q: F.when(p["window"] == q["window"], 1).otherwise(0), lambda p: p["at"]))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_upper (letters A-Z), per row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).cast("long").alias("n_repeat_words"))

    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{WS}]"))
    dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("long")
    rows = rows.select("doc_id", let(words_of(F.col("text")), of_words).alias("s"), count("[#*$%&|<>]").alias("n_symbols"), dup.cast("long").alias("n_dup_lines"), count("[A-Z]").alias("n_upper"), F.size(F.split("text", "\n")).alias("n_lines"))
    return rows.select("doc_id", "s.n_words", "s.word_chars", "n_symbols", "n_dup_lines", "s.n_repeat_words", "n_upper", "n_lines")


def features() -> dict[str, Column]:
    """Statistics as integers: shares in 1/STEPS, rounded down; mean word length in tenths; words up to 2,000."""
    share = lambda a, b: F.floor(F.col(a) * STEPS / F.greatest(F.col(b), F.lit(1))).cast("int")
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "upper_share": share("n_upper", "word_chars"),
        "word_length": F.least(F.floor(F.col("word_chars") * 10 / F.greatest(F.col("n_words"), F.lit(1))), F.lit(1000)).cast("int"),
        "word_count": F.least(F.floor(F.col("n_words") / 10), F.lit(200)).cast("int"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, at_least, threshold): at least it if true, else at most it. It rejects."""

    tests: tuple[tuple[str, bool, int], ...]

    def covers(self, x: dict[str, int]) -> bool:
        return all(x[f] >= t if up else x[f] <= t for f, up, t in self.tests)

    def column(self) -> Column:
        parts = [features()[f] >= t if up else features()[f] <= t for f, up, t in self.tests]
        out = F.lit(True)
        for p in parts:
            out = out & p
        return out

    def __str__(self) -> str:
        return " and ".join(f"{f} {'>=' if up else '<='} {t}" for f, up, t in self.tests)


Cell = tuple[dict[str, int], int, int]  # features, rejected rows, accepted rows


def _counts(cells: list[Cell], rule: Rule) -> tuple[int, int]:
    hit = [(p, n) for x, p, n in cells if rule.covers(x)]
    return sum(p for p, _ in hit), sum(n for _, n in hit)


def _grow(cells: list[Cell], most_tests: int) -> Rule:
    rule, left = Rule(()), cells
    while len(rule.tests) < most_tests:
        p0, n0 = sum(p for _, p, _ in left), sum(n for _, _, n in left)
        if not n0 or not p0:
            break
        best = (0.0, None)
        for f in FEATURES:
            by: dict[int, list[int]] = {}
            for x, p, n in left:
                c = by.setdefault(x[f], [0, 0])
                c[0] += p
                c[1] += n
            for up in (True, False):
                p = n = 0
                for t in sorted(by, reverse=up):
                    p, n = p + by[t][0], n + by[t][1]
                    if p and (p, n) != (p0, n0):
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, up, t))
        if best[1] is None:
            break
        rule = Rule((*rule.tests, best[1]))
        left = [c for c in left if rule.covers(c[0])]
    return rule


def learn_cells(grow: list[Cell], prune: list[Cell], most_rules: int = 12, most_tests: int = 4, precision: float = 0.98, support: int = 8) -> list[Rule]:
    """Sequential covering over counted cells; a rule stays if it is precise and supported on both parts."""
    rules: list[Rule] = []
    while len(rules) < most_rules:
        rule = _grow(grow, most_tests)
        if not rule.tests:
            break
        worth = lambda r: (lambda p, n: (p - n) / (p + n) if p + n else -1.0)(*_counts(prune, r))
        while len(rule.tests) > 1:
            shorter = max((Rule(rule.tests[:i] + rule.tests[i + 1 :]) for i in range(len(rule.tests))), key=worth)
            if worth(shorter) < worth(rule):
                break
            rule = shorter
        (p, n), (q, m) = _counts(grow, rule), _counts(prune, rule)
        if p + q < support or p < precision * (p + n) or q < precision * (q + m):
            break
        rules.append(rule)
        grow, prune = ([c for c in part if not rule.covers(c[0])] for part in (grow, prune))
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learns rejecting rules from ``labels`` (1 accepted, 0 rejected) of at most ``train_rows`` documents."""
    sample = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    sample = sample.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    sample = stash(sample, "labelled")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    # written first, so that statistics are made of the sample's texts alone: a filter on them would else go below the join
    texts = stash(texts.select(F.struct("id", "y").alias("row"), "text"), "sample-texts")
    stats = statistics(texts, "row").select("doc_id.*", "*").drop("doc_id")
    held_out = (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).alias("held_out")
    stats = stats.where(~base_failed())  # the base checks come first in the list, so rules are learned on what they leave
    cells = stats.select(*[c.alias(f) for f, c in features().items()], held_out, "y").groupBy(*FEATURES, "held_out").agg(F.sum(1 - F.col("y")).alias("p"), F.sum("y").alias("n"))
    parts: dict[bool, list[Cell]] = {False: [], True: []}
    for r in cells.orderBy(*FEATURES).collect():  # as many rows as the sample has, at most
        parts[r["held_out"]].append(({f: r[f] for f in FEATURES}, r["p"], r["n"]))
    return learn_cells(parts[False], parts[True])


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional: number of the first rule that rejects, else null."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        out = F.when(rule.column(), F.lit(k)).otherwise(out)
    return out


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics with base_failed, rule (number or null) and kept, per row."""
    stats = statistics(docs, id_col, text_col)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``judge`` rejects; columns as they were, and nothing shuffled."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    held = docs.select(row, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    stats = statistics(held, "_row").withColumnRenamed("doc_id", "_row")
    out = stats.withColumn("_kept", ~base_failed() & verdict(rules).isNull()).where("_kept")
    return out.select("_row.*")
