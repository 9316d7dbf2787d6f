"""Quality rules: fixed limits, and a decision list learned from labels.

Sequential covering: a rule is a conjunction of thresholds on document statistics,
grown condition by condition by gain over the rows it still covers, pruned on rows
kept aside, and kept while it is precise there; the rows it covers go, and the next
rule is grown. The list becomes one Spark conditional. Growing looks at counts by
feature and bin only, which Spark sums; a few hundred numbers reach the driver.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolane.llm.text import SEPARATORS, WORD, free_name, text_of
from tempolane.sources.shared import new_path, settled

SAMPLE = 20_000  # labelled rows, those of the smallest hashes: the bound of what is fitted on
BINS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
LEAST_COVER = 12
PRECISE = 0.95

FEATURES = ("mean_word", "symbol_share", "line_share", "repeat_share", "mark_share")


@dataclasses.dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def column(self, of) -> Column:
        return of(self.feature) > self.bound if self.above else of(self.feature) <= self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:.6g}"


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks")


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """`docs` with a column for each of `STATISTICS`, and how those are named.

    All are of the whole text; null counts as empty. `n_repeat_words` are the words
    in windows of three that stand twice or more: windows are hashed, (hash, place)
    sorted where a hash repeats, and places of repeated ones spread over three words.
    Each step is a column of its own, as a lambda computes what it holds for every
    element anew, and plain columns are not inlined where they are used twice.
    """
    w, split, hashes, paired = (free_name(docs.columns, n) for n in ("q_words", "q_lines", "q_hashes", "q_pairs"))
    names = {x: free_name(docs.columns, f"q_{x}") for x in STATISTICS}
    body = text_of(text)
    words, h, p = F.col(w), F.col(hashes), F.col(paired)
    rows = docs.withColumn(w, F.array_remove(F.split(body, SEPARATORS + "+", -1), ""))
    n = F.size(words)
    window = F.transform(F.slice(words, 1, n - 2), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    rows = rows.withColumn(hashes, F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn(split, F.filter(F.split(body, "\n", -1), lambda x: F.rlike(x, F.lit(WORD))))
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn(paired, F.when(F.size(F.array_distinct(h)) < F.size(h), pairs).otherwise(none))
    again = F.filter(p, lambda x, j: (x["h"] == F.get(p, j + 1)["h"]) | (x["h"] == F.get(p, j - 1)["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    # Counting by matches would copy the text for each; what is left of it is as long.
    count = lambda chars: F.char_length(F.regexp_replace(body, f"[^{chars}]+", "")).cast("long")
    # A row number, times nothing: a filter on the result would else be pushed below all
    # steps, with their expressions in place of the columns, and computed for each use.
    found = {
        "n_words": n.cast("long") + F.monotonically_increasing_id() * 0, "word_chars": F.char_length(F.array_join(words, "")).cast("long"), "n_symbols": count("#*$%&|<>"),
        "n_dup_lines": (F.size(split) - F.size(F.array_distinct(split))).cast("long"),
        "n_repeat_words": F.when(F.size(p) > 0, covered).otherwise(F.lit(0)).cast("long"),
        "n_lines": F.size(split).cast("long"),
        "n_marks": count("!?"),
    }
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], *[found[x].alias(names[x]) for x in STATISTICS]), names


def feature(names: dict[str, str]):
    s = {x: F.col(f"`{c}`") for x, c in names.items()}
    words, lines = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["n_lines"], F.lit(1))
    found = {
        "mean_word": s["word_chars"] / words,
        "symbol_share": s["n_symbols"] / words,
        "line_share": s["n_dup_lines"] / lines,
        "repeat_share": s["n_repeat_words"] / words,
        "mark_share": s["n_marks"] / words,
    }
    return found.__getitem__


def base_failed(names: dict[str, str]) -> Column:
    words, repeated = F.col(f"`{names['n_words']}`"), F.col(f"`{names['n_repeat_words']}`")
    return (words < 50) | (100 * repeated > 50 * words)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text") -> list[list[Condition]]:
    """Rules that mark documents of label quality 0, in order.

    Labels are taken of a sample of at most `sample` rows, those whose ids have the
    smallest hashes; null ids and qualities are left out, and of repeated ids the
    lowest quality counts. Without labelled documents of both kinds there is no rule.
    """
    own = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("label_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(F.broadcast(own), F.col("doc_id") == F.col("label_id"))
    rows, names = with_statistics(rows.select("doc_id", "text", "bad"))
    of = feature(names)
    rows = rows.select(
        "bad", base_failed(names).alias("failed"), (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)) == 0).alias("aside"), *[of(f).alias(f) for f in FEATURES]
    )
    rows = settled(rows, new_path(docs.sparkSession, "labelled")).filter("NOT failed")
    total = rows.agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).first()
    if not total["p"] or total["p"] == total["n"]:
        return []
    # Bounds of the bins from rows of either kind, so that a rare kind has its own.
    cuts = {}
    at = [i / BINS for i in range(1, BINS)]
    exact = rows.groupBy("bad").agg(*[F.percentile(f, F.array(*map(F.lit, at))).alias(f) for f in FEATURES]).collect()
    for f in FEATURES:
        cuts[f] = sorted({round(x, 6) for r in exact for x in r[f]})
    rules: list[list[Condition]] = []
    rest = F.lit(True)
    here = lambda f: F.col(f)
    while len(rules) < MAX_RULES:
        rule = _grow(rows.filter(rest & ~F.col("aside")), cuts)
        rule = _prune(rows.filter(rest & F.col("aside")), rule) if rule else None
        if not rule:
            break
        rules.append(rule)
        rest = rest & ~_all(rule, here)
    return rules


def _all(rule: list[Condition], of) -> Column:
    result = F.lit(True)
    for c in rule:
        result = result & c.column(of)
    return result


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
    """Add the condition of the largest gain until no good row is covered."""
    rule: list[Condition] = []
    here = lambda f: F.col(f)
    while len(rule) < MAX_CONDITIONS:
        bins = F.array(*[
            F.struct(F.lit(i).alias("f"), _bin(F.col(f), cuts[f]).alias("b")) for i, f in enumerate(FEATURES)
        ])
        counts = rows.filter(_all(rule, here)).select("bad", F.explode(bins).alias("x")).groupBy("x.f", "x.b").agg(
            F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).collect()
        by: dict[int, dict[int, tuple[int, int]]] = {}
        for r in counts:
            by.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"] - r["p"])
        if not by:
            return []
        p0, n0 = (sum(x[k] for x in by[0].values()) for k in (0, 1))
        if not p0 or not n0:
            return rule
        best, gain, equal = None, 1e-9, []
        for i, f in enumerate(FEATURES):
            for above in (True, False):
                for j, bound in enumerate(cuts[f]):
                    side = [x for b, x in by[i].items() if (b > j) == above]
                    p, n = sum(x[0] for x in side), sum(x[1] for x in side)
                    if p < LEAST_COVER:
                        continue
                    g = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if g > gain:
                        best, gain, equal = (f, above), g, []
                    if g == gain and best == (f, above):
                        equal.append(bound)
        if best is None:
            return rule
        # Bounds of equal gain: the middle leaves room to either side.
        rule.append(Condition(*best, (equal[0] + equal[-1]) / 2))
    return rule


def _bin(value: Column, cuts: list[float]) -> Column:
    """Number of cuts below the value: cut j is passed when the bin is above j."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value))


def _prune(rows: DataFrame, rule: list[Condition]) -> list[Condition] | None:
    """The start of the rule that is best on rows kept aside, if it is precise there."""
    here = lambda f: F.col(f)
    sums = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k], here)
        sums += [F.sum(F.when(hit, F.col("bad"))).alias(f"p{k}"), F.sum(hit.cast("int")).alias(f"n{k}")]
    found = rows.agg(*sums).first()
    best = None
    for k in range(1, len(rule) + 1):
        p, n = found[f"p{k}"] or 0, found[f"n{k}"] or 0
        if n and p / n >= PRECISE and p >= LEAST_COVER / 3:
            value = (2 * p - n) / n
            if best is None or value > best[0]:
                best = (value, rule[:k])
    return best and best[1]


def verdict(rules: list[list[Condition]], of) -> Column:
    """Number of the first rule that fits (from 1), null where none does."""
    result = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        result = F.when(_all(rules[i - 1], of), F.lit(i)).otherwise(result)
    return result


def judge(docs: DataFrame, rules: list[list[Condition]], text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, rule (number, or null) and kept; columns of these names are replaced.

    Null and empty texts have no words and fail the base rule. Repeated rows are
    judged each, an empty table stays empty, other columns are kept.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kept = [c for c in docs.columns if c.lower() not in {*new, "base_failed", "rule", "kept"} or c == text]
    rows, names = with_statistics(docs.select(*[F.col(f"`{c}`") for c in kept]), text)
    fails = base_failed(names)
    number = verdict(rules, feature(names))
    return rows.select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"`{names[x]}`").alias(x) for x in new],
        fails.alias("base_failed"), number.alias("rule"), (~fails & number.isNull()).alias("kept"),
    )
