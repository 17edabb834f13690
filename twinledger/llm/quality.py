"""Quality rules: a decision list learned from labels, run as SQL expressions.

Sequential covering: a rule grows condition by condition (feature at most or at
least a threshold, by information gain) until it covers no good document, is cut
back on documents it has not seen, and is kept if it is precise there; what it
covers is set aside and the next rule is grown. Growing needs only counts per
feature, bin and label, one aggregation a step over all labelled rows, so the
driver sees a few hundred numbers however many rows there are. The list becomes
nested WHEN expressions; no Python runs on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.textblocks import set_aside
from twinledger.session import materialize

# Blanks of the word pattern [^\x20\x09-\x0D]+ and the symbols counted (fixed values).
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50

#: Thresholds tried per feature: quantiles of the labelled rows.
BINS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
LEAST_PRECISION = 0.9
LEAST_COVERED = 5
#: Every third labelled document, by a hash of its id, is kept for pruning.
PRUNE_FOLD = 3

FEATURES = (
    "word_length",
    "symbol_share",
    "repeat_share",
    "distinct_share",
    "same_neighbour_share",
    "upper_share",
    "mark_share",
    "dup_line_share",
    "words_per_line",
    "n_words",
)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _count(values: Column, test) -> Column:
    return F.size(F.filter(values, test)).cast("bigint")


def _repeated_words(words: Column) -> Column:
    """Words inside a three-word window that occurs twice or more.

    Windows are sorted with their places; equal neighbours are repeats. A place
    is counted for the windows that start there or at the two places before.
    """

    def places(windows: Column) -> Column:
        last = F.size(windows) - 1
        repeated = F.filter(
            F.sequence(F.lit(0), last),
            lambda j: ((j > 0) & (windows[F.greatest(j - 1, F.lit(0))]["w"] == windows[j]["w"]))
            | ((j < last) & (windows[F.least(j + 1, last)]["w"] == windows[j]["w"])),
        )
        return F.transform(repeated, lambda j: windows[j]["i"])

    def covered(starts: Column) -> Column:
        # Sorted starts: each adds the places not reached by the one before.
        return _let(
            F.sort_array(starts),
            lambda s: F.aggregate(
                s,
                F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
                lambda a, i: F.struct(
                    (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")
                ),
                lambda a: a["n"],
            ),
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("w"), i.alias("i")),
    )
    return F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(
        _let(F.sort_array(windows), lambda w: covered(places(w)))
    )


def with_features(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with `__f`, a struct of counts and features of `text` (null: none)."""
    text = F.coalesce("text", F.lit(""))
    cut = {
        "__w": F.filter(F.split(text, BLANKS), lambda w: w != ""),
        "__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "__dense": F.regexp_replace(text, BLANKS, ""),
    }
    dense, w = F.col("__dense"), F.col("__w")
    chars = F.length(dense).cast("bigint")
    # Plain columns, not fields of a struct: each is computed once and used twice.
    counts = {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": chars,
        "n_symbols": chars - F.length(F.translate(dense, SYMBOLS, "")),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
        "n_lines": F.size("__lines").cast("bigint"),
        "n_repeat_words": _repeated_words(w),
        "n_distinct": F.size(F.array_distinct(w)).cast("bigint"),
        "n_same_neighbour": _let(
            w,
            lambda x: _count(
                F.sequence(F.lit(1), F.greatest(F.size(x) - 1, F.lit(1))),
                lambda i: (i < F.size(x)) & (F.get(x, i) == F.get(x, i - 1)),
            ),
        ),
        "n_upper": chars - F.length(F.regexp_replace(dense, r"\p{Lu}+", "")),
        "n_marks": F.length(F.regexp_replace(dense, r"\p{L}+", "")).cast("bigint"),
    }
    plain = set_aside(docs)
    counted = plain.withColumns(cut).withColumns({f"__{name}": value for name, value in counts.items()})
    c = {name: F.col(f"__{name}") for name in counts}

    def share(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    features = F.struct(
        *(c[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        share(c["word_chars"], c["n_words"]).alias("word_length"),
        share(c["n_symbols"], c["word_chars"]).alias("symbol_share"),
        share(c["n_repeat_words"], c["n_words"]).alias("repeat_share"),
        share(c["n_distinct"], c["n_words"]).alias("distinct_share"),
        share(c["n_same_neighbour"], c["n_words"]).alias("same_neighbour_share"),
        share(c["n_upper"], c["word_chars"] - c["n_marks"]).alias("upper_share"),
        share(c["n_marks"], c["word_chars"]).alias("mark_share"),
        share(c["n_dup_lines"], c["n_lines"]).alias("dup_line_share"),
        share(c["n_words"], c["n_lines"]).alias("words_per_line"),
    )
    return counted.select(*plain.columns, features.alias("__f")).toDF(*docs.columns, "__f")


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, features: Column) -> Column:
        value = features[self.feature].cast("double")
        return value >= self.threshold if self.at_least else value <= self.threshold


@dataclass(frozen=True)
class DecisionList:
    """Rules in order, each a conjunction; a document that meets one is rejected."""

    rules: tuple[tuple[Condition, ...], ...]

    def rejects(self, features: Column) -> Column:
        verdict = F.lit(False)
        for rule in reversed(self.rules):
            met = F.lit(True)
            for condition in rule:
                met = met & condition.column(features)
            verdict = F.when(met, True).otherwise(verdict)
        return verdict


def _gain(p: int, n: int, p_before: int, n_before: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p_before / (p_before + n_before))) if p else 0.0


def learn(labelled: DataFrame) -> DecisionList:
    """A decision list from rows with `__f`, `bad` (boolean) and `doc_id`.

    Rows with a null label are left out. Without bad rows, or without good ones,
    the list is empty and rejects nothing.
    """
    known = labelled.where("bad is not null").select(
        "bad",
        (F.pmod(F.xxhash64("doc_id"), F.lit(PRUNE_FOLD)) == 0).alias("prune"),
        *(F.col("__f")[name].cast("double").alias(name) for name in FEATURES),
    )
    rows = materialize(known, "labelled")
    cuts = rows.agg(
        *(F.percentile_approx(name, [i / BINS for i in range(1, BINS)], 2000).alias(name) for name in FEATURES)
    ).first()
    thresholds = {name: sorted(set(cuts[name] or [])) for name in FEATURES}
    # A bin number per feature: how many thresholds the value exceeds, and whether it is one.
    def below(name: str) -> Column:
        return sum((F.when(F.col(name) > t, 1).otherwise(0) for t in thresholds[name]), F.lit(0))

    binned = materialize(rows.select("bad", "prune", *FEATURES, F.array(*(below(f) for f in FEATURES)).alias("bins")), "binned")
    rules: list[tuple[Condition, ...]] = []
    left = binned
    f = F.struct(*(F.col(name) for name in FEATURES))
    while len(rules) < MAX_RULES:
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            here = left.where("not prune")
            for condition in rule:
                here = here.where(condition.column(f))
            table = (
                here.select("bad", F.posexplode("bins").alias("f", "b"))
                .groupBy("f", "b")
                .agg(F.count(F.when(F.col("bad"), 1)).alias("p"), F.count(F.when(~F.col("bad"), 1)).alias("n"))
                .collect()
            )
            total_p = sum(r["p"] for r in table if r["f"] == 0)
            total_n = sum(r["n"] for r in table if r["f"] == 0)
            if not total_p or not total_n:
                break
            best, best_gain = None, 0.0
            for i, name in enumerate(FEATURES):
                by_bin = {r["b"]: (r["p"], r["n"]) for r in table if r["f"] == i}
                p = n = 0
                for b, threshold in enumerate(thresholds[name]):
                    p, n = p + by_bin.get(b, (0, 0))[0], n + by_bin.get(b, (0, 0))[1]
                    # Bins 0..b hold the values up to this threshold.
                    for at_least, pp, nn in ((False, p, n), (True, total_p - p, total_n - n)):
                        gain = _gain(pp, nn, total_p, total_n)
                        if gain > best_gain:
                            best, best_gain = (name, at_least, threshold), gain
            if best is None:
                break
            name, at_least, threshold = best
            # "At least" means above the threshold: the next larger double.
            rule.append(Condition(name, at_least, math.nextafter(threshold, math.inf) if at_least else threshold))
        if not rule:
            break
        held = left.where("prune")
        sums, met = [], F.lit(True)
        for i, condition in enumerate(rule):
            met = met & condition.column(f)
            sums += [F.count(F.when(met & F.col("bad"), 1)).alias(f"p{i}"), F.count(F.when(met & ~F.col("bad"), 1)).alias(f"n{i}")]
        found = held.agg(*sums).first()
        scores = [(found[f"p{i}"], found[f"n{i}"]) for i in range(len(rule))]
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in scores]
        keep = max(range(len(rule)), key=lambda i: (worth[i], -i))
        p, n = scores[keep]
        if p < LEAST_COVERED or p < LEAST_PRECISION * (p + n):
            break
        rule = rule[: keep + 1]
        rules.append(tuple(rule))
        met = F.lit(True)
        for condition in rule:
            met = met & condition.column(f)
        left = left.where(~met)
    return DecisionList(tuple(rules))


def base_failed(features: Column) -> Column:
    return (features["n_words"] < LEAST_WORDS) | (100 * features["n_repeat_words"] > 50 * features["n_words"])


def learn_from(featured: DataFrame, labels: DataFrame) -> DecisionList:
    """Learn from rows (doc_id, __f) that have a label (quality 0: bad). Documents
    with two different labels are left out."""
    each = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("__low"), F.max("quality").alias("__high")
    )
    each = each.where("__low = __high").select(F.col("doc_id").alias("__id"), (F.col("__low") == 0).alias("bad"))
    return learn(featured.select("doc_id", "__f").join(each, F.col("doc_id") == F.col("__id")))


def judged(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """`columns` of `docs` (all if not given) with `__f`, `__failed` (the base rules)
    and `__kept` (neither they nor the learned list reject).

    Features are computed once and stored beside the columns; learning reads the
    features alone. Columns that `docs` has by one of these names are replaced.
    """
    docs = docs.drop("__f", "__failed", "__kept")
    featured = with_features(docs).select(*(columns or docs.columns), "__f")
    featured = materialize(featured, "featured")
    found = learn_from(featured, labels)
    f = F.col("__f")
    marked = featured.withColumn("__failed", base_failed(f))
    return marked.withColumn("__kept", ~F.col("__failed") & ~found.rejects(f))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the base rules and the learned list keep, with the columns of `docs`."""
    plain = set_aside(docs)
    return judged(plain, labels).where("__kept").select(*plain.columns).toDF(*docs.columns)
