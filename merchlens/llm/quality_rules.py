"""Quality rules learned from labels: an ordered list of threshold conjunctions.

Sequential covering: a rule for bad documents grows condition by condition, each the best
of all features, thresholds and directions by information gain; then its last conditions
are pruned against labelled rows that it has not seen; what it covers is set aside and
the next rule is grown. The list becomes one Spark conditional expression. Statistics,
counting and verdicts are column expressions and grouped sums throughout.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.tables import quoted, set_aside, stored, without

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
#: Features that rules may test, from the statistics and a few counts of their own.
FEATURES = (
    "f_words",
    "f_word_length",
    "f_symbols",
    "f_dup_lines",
    "f_repeats",
    "f_distinct",
    "f_digits",
    "f_capitals",
    "f_line_words",
    "f_longest",
)


def _removed(text: Column, characters: str) -> Column:
    """How many of the characters the text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0).cast("double")


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics and features of each whole text.

    Words are divided by ASCII white space. ``n_repeat_words`` counts the words inside
    five-word windows that occur twice or more in the text, ``n_dup_lines`` the lines
    with a word that equal an earlier line. Null is a text without words. Columns of the
    same names are replaced.
    """
    names = [*STATISTICS, *FEATURES]
    docs = without(docs, *names)
    keep = [F.col(quoted(c)) for c in docs.columns]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(*keep, text.alias("__text"))
    found = found.select(
        *keep,
        "__text",
        F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)).alias("__words"),
        F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(WORD)).alias("__lines"),
    )
    # One number per window; windows are compared as numbers.
    n = F.size("__words")
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), n - WINDOW + 1),
            lambda i: F.xxhash64(*[F.element_at("__words", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    words, lines = F.col("__words"), F.col("__lines")
    found = found.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        _removed(F.col("__text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).alias("__n_lines"),
        F.size(F.array_distinct(words)).alias("__n_distinct"),
        F.aggregate(words, F.lit(0), lambda a, w: F.greatest(a, F.length(w))).alias("__longest"),
        _removed(F.col("__text"), "0123456789").alias("__digits"),
        (F.length("__text") - F.length(F.regexp_replace("__text", "[A-Z]", ""))).alias("__capitals"),
        windows.alias("__windows"),
    )
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    numbered = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    found = found.withColumn("__sorted", F.when(repeats, F.sort_array(numbered))).drop("__windows")
    # Places of windows whose neighbour in the sorted list is equal; the list is named
    # more than once, so it stays a column of its own.
    listed = F.col("__sorted")

    def twin(s: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(listed, k - 1)["h"] == s["h"]).otherwise(False)
        after = F.when(k < F.size(listed) - 1, F.get(listed, k + 1)["h"] == s["h"]).otherwise(False)
        return before | after

    found = found.withColumn(
        "__places", F.array_sort(F.transform(F.filter(listed, twin), lambda s: s["i"]))
    )
    covered = F.aggregate(
        "__places",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(p - a["last"], F.lit(WINDOW))).alias("n")),
        lambda a: a["n"],
    )
    found = found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    n_words, chars = F.col("n_words"), F.col("word_chars")
    values = [
        *[F.col(c) for c in STATISTICS[:-1]],
        ((n_words < 10) | (100 * F.col("n_repeat_words") > 20 * n_words)).alias("base_failed"),
        n_words.cast("double").alias("f_words"),
        _share(chars, n_words).alias("f_word_length"),
        _share(F.col("n_symbols"), chars).alias("f_symbols"),
        _share(F.col("n_dup_lines"), F.col("__n_lines")).alias("f_dup_lines"),
        _share(F.col("n_repeat_words"), n_words).alias("f_repeats"),
        _share(F.col("__n_distinct"), n_words).alias("f_distinct"),
        _share(F.col("__digits"), chars).alias("f_digits"),
        _share(F.col("__capitals"), chars).alias("f_capitals"),
        _share(n_words, F.col("__n_lines")).alias("f_line_words"),
        F.col("__longest").cast("double").alias("f_longest"),
    ]
    # Out of a generator, so that no later filter is evaluated below, text work and all.
    return found.select(*keep, F.inline(F.array(F.struct(*values))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Limits:
    """Bounds of the learning.

    ``sample`` labelled documents are looked at, those of the least id hashes; the rules
    are then applied to every document.
    """

    sample: int = 20_000
    thresholds: int = 40
    conditions: int = 4
    rules: int = 12
    support: int = 15
    precision: float = 0.9


def labelled_statistics(docs: DataFrame, labels: DataFrame, limits: Limits) -> DataFrame:
    """Stored features, ``bad`` and ``fold`` of a bounded number of labelled documents.

    Labels other than 0 and 1 are left out; of a document labelled more than once, the
    worst label counts. Documents that fail the base rule are judged by it already.
    """
    clean = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    clean = clean.groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    chosen = clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limits.sample)
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = statistics(some).where("NOT base_failed")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3))
    return stored(found.select(*FEATURES, "bad", fold.alias("fold")).coalesce(8), "labelled")


def _binned(rows: DataFrame, limits: Limits) -> tuple[DataFrame, dict[str, list[float]]]:
    """Quantiles of each feature, of good and of bad rows, and how many are below a value."""
    cuts = [k / limits.thresholds for k in range(1, limits.thresholds)]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(f, cuts, 10_000).alias(f) for f in FEATURES])
    found = found.collect()
    edges = {f: sorted({e for r in found for e in r[f]}) for f in FEATURES}
    def number(feature: str) -> Column:
        below = F.filter(F.array(*[F.lit(e) for e in edges[feature]]), lambda e: e < F.col(feature))
        return F.size(below) if edges[feature] else F.lit(0)

    return stored(rows.select("*", *[number(f).alias(f"b{f}") for f in FEATURES]), "binned"), edges


def _best(rows: DataFrame, edges: dict[str, list[float]], support: int) -> tuple[Condition | None, float]:
    """The condition of the highest gain on the rows, from one grouped sum."""
    stacked = ", ".join(f"'{f}', b{f}" for f in FEATURES)
    sums = (
        rows.selectExpr("bad", f"stack({len(FEATURES)}, {stacked}) AS (feature, bin)")
        .groupBy("feature", "bin")
        .agg(F.sum("bad").alias("p"), F.count("*").alias("n"))
        .collect()
    )
    total_p = sum(r["p"] for r in sums if r["feature"] == FEATURES[0])
    total = sum(r["n"] for r in sums if r["feature"] == FEATURES[0])
    if not total_p:
        return None, 0.0
    start = math.log2(total_p / total)
    best, gain = None, 1e-9
    for feature in FEATURES:
        own = {r["bin"]: (r["p"], r["n"]) for r in sums if r["feature"] == feature}
        low_p = low_n = 0
        for k, edge in enumerate(edges[feature]):  # values up to an edge have bins up to k
            low_p, low_n = low_p + own.get(k, (0, 0))[0], low_n + own.get(k, (0, 0))[1]
            for above, p, n in ((False, low_p, low_n), (True, total_p - low_p, total - low_n)):
                if n < support or not p or n == total:
                    continue
                worth = p * (math.log2(p / n) - start)
                if worth > gain:
                    best, gain = Condition(feature, above, edge), worth
    return best, gain


def _all(conditions: list[Condition]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def learn_rules(rows: DataFrame, limits: Limits = Limits()) -> list[list[Condition]]:
    """Ordered rules for bad documents, from features, ``bad`` and ``fold``.

    Two thirds of the rows grow the rules, the rest prunes them. A rule is kept if it is
    right often enough on the rows that pruned it and on those that grew it. No labels,
    or labels of one kind only, give no rules.
    """
    rows, edges = _binned(rows, limits)
    rules: list[list[Condition]] = []
    left = F.lit(True)
    while len(rules) < limits.rules:
        grown: list[Condition] = []
        part = rows.where((F.col("fold") > 0) & left)
        while len(grown) < limits.conditions:
            condition, _ = _best(part.where(_all(grown)), edges, limits.support)
            if condition is None:
                break
            grown.append(condition)
        if not grown:
            break
        rule = _pruned(rows.where(left), grown, limits)
        if rule is None:
            break
        rules.append(rule)
        left = left & ~_all(rule)
    return rules


def _pruned(rows: DataFrame, grown: list[Condition], limits: Limits) -> list[Condition] | None:
    """The beginning of the rule that does best on unseen rows, if it is good enough."""
    heads = [grown[: k + 1] for k in range(len(grown))]
    unseen = F.col("fold") == 0
    columns = []
    for k, head in enumerate(heads):
        hit = _all(head)
        columns += [
            F.count(F.when(hit & unseen, 1)).alias(f"n{k}"),
            F.count(F.when(hit & unseen & (F.col("bad") == 1), 1)).alias(f"p{k}"),
            F.count(F.when(hit, 1)).alias(f"m{k}"),
            F.count(F.when(hit & (F.col("bad") == 1), 1)).alias(f"q{k}"),
        ]
    s = rows.agg(*columns).first()
    good = [
        ((2 * s[f"p{k}"] - s[f"n{k}"]) / s[f"n{k}"], -k)
        for k in range(len(heads))
        if s[f"m{k}"] >= limits.support
        and s[f"n{k}"] > 0
        and s[f"p{k}"] >= limits.precision * s[f"n{k}"]
        and s[f"q{k}"] >= limits.precision * s[f"m{k}"]
    ]
    return heads[-max(good)[1]] if good else None


def decision(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that holds, from 1; null where none does."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        out = F.when(_all(rules[k - 1]), F.lit(k)).otherwise(out)
    return out


def judged(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with statistics, ``rule`` and ``kept``, for every row.

    A document is kept if it passes the base rule (ten words or more, at most a fifth of
    them in repeated windows) and no learned rule rejects it.
    """
    rules = learn_rules(labelled_statistics(docs, labels, limits), limits)
    found = statistics(without(docs, "rule", "kept")).withColumn("rule", decision(rules))
    return found.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def accepted(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    own, back = set_aside(docs, "doc_id", "text")
    return judged(own, labels, limits).where("kept").select(*back.values())
