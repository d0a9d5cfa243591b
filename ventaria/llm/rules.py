"""Quality rules: text statistics and learned decision lists, in DataFrame expressions only.

Statistics of a text (words are runs of ``[^\\x20\\x09-\\x0D]``) come from array
and string functions inside one row: no explode, no shuffle, so a source, line
or word of any frequency costs nothing extra. The list of rules is learned by
sequential covering: a rule grows by the condition (statistic, direction,
threshold) of best information gain on two thirds of the labelled rows, is cut
back to its best prefix on the other third, and covers rows before the next one
is sought. Each step is one grouped count over at most ``max_rows`` labelled
rows; only counts by (statistic, bin) reach the driver. The result is an ordered
``CASE WHEN`` expression.

Defined results: null, empty and blank texts have no words and fail the base
rule; repeated rows give repeated results; without usable labels no rule is
learned and the base rule alone decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.session import settle

BLANKS = r"[\x20\x09-\x0D]+"
MEASURES = ("mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "mark_share", "digit_share")


@dataclass(frozen=True)
class Settings:
    max_rows: int = 20_000
    bins: int = 24
    max_rules: int = 10
    max_conditions: int = 3
    min_cover: int = 12  # rows of a class that a rule must catch
    min_precision: float = 0.9


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.measure) > self.threshold if self.above else F.col(self.measure) <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.4g}"


def share(part: Column, whole: Column) -> Column:
    return part / F.when(whole > 0, whole)


def held(df: DataFrame) -> DataFrame:
    """The same rows behind a generator: a later filter is not rewritten into the expressions below.

    Without it the optimiser would substitute every array expression into its
    many uses, and evaluate whole arrays once for each element.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def base_statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, text, words and the counts of the base rule; with ``carry`` also the whole input row as ``row``."""
    also = ["row"] if carry else []
    docs = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("row")) if carry else docs
    t = F.coalesce(docs["text"].cast("string"), F.lit(""))
    cut = held(docs.select(*also, docs["doc_id"].cast("long").alias("doc_id"), t.alias("text"),
                      F.array_remove(F.split(t, BLANKS), "").alias("words"),
                      F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines")))
    triples = F.when(F.size("words") >= 3, F.transform(
        F.slice("words", 1, F.size("words") - 2),
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)).alias("key"), i.alias("at"))))
    ordered = held(cut.select("*", F.sort_array(triples).alias("triples")))
    repeated = held(ordered.select(*also, "doc_id", "text", "words", "lines", F.sort_array(F.transform(F.filter("triples", lambda x, i: (
        x["key"].eqNullSafe(F.get("triples", i - 1)["key"]) | x["key"].eqNullSafe(F.get("triples", i + 1)["key"]))),
        lambda x: x["at"])).alias("places")))
    covered = F.aggregate(F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3)))),
                          F.lit(0), lambda total, n: total + n)
    return held(repeated.select(
        *also, "doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines")))


def measures(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Base counts, base verdict and the shares that rules may test."""
    left = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    return held(base_statistics(docs, carry).select(
        *(["row"] if carry else []), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        share(F.col("word_chars"), F.col("n_words")).alias("mean_word"),
        share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"),
        share(F.size(F.array_distinct("words")), F.col("n_words")).alias("distinct_share"),
        share(left(r"[^A-ZÀ-Þ]+"), F.col("word_chars")).alias("upper_share"),
        share(left(r"[^!|?;:_=~^\\/{}\[\]]+"), F.col("word_chars")).alias("mark_share"),
        share(left(r"[^0-9]+"), F.col("word_chars")).alias("digit_share")))


def bin_of(measure: str, cuts: list[float]) -> Column:
    """How many borders lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda cut: F.col(measure) > cut))


def labelled_bins(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[str, list[float]]]:
    """At most ``max_rows`` labelled rows with the bin of each measure, and the bins' borders."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") == 0).cast("int").alias("bad"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_rows))
    known = docs.join(F.broadcast(marks.select(F.col("doc_id").alias("_marked"))), docs["doc_id"].cast("long") == F.col("_marked"), "left_semi")
    told = measures(known).where(~F.col("base_failed")).groupBy("doc_id").agg(F.min(F.struct(*MEASURES)).alias("m")).select("doc_id", "m.*")
    rows = settle(told.join(F.broadcast(marks), "doc_id"))  # one row for each of at most max_rows ids
    parts = [k / settings.bins for k in range(1, settings.bins)]
    borders = rows.agg(*[F.percentile_approx(F.when(F.col("bad") == b, F.col(m)), parts, 10_000).alias(f"{m}_{b}")
                         for m in MEASURES for b in (0, 1)]).first()
    cuts = {m: sorted(set((borders[f"{m}_0"] or []) + (borders[f"{m}_1"] or []))) for m in MEASURES}
    binned = rows.select("bad", (F.xxhash64("doc_id") % 3 == 0).alias("held"), *MEASURES, *[
        bin_of(m, cuts[m]).alias(f"bin_{m}") for m in MEASURES if cuts[m]])
    return settle(binned), {m: c for m, c in cuts.items() if c}


def best_condition(rows: DataFrame, cuts: dict[str, list[float]], min_cover: int) -> tuple[Condition | None, float]:
    """Condition of largest information gain, and the precision it reaches; one grouped count."""
    melted = rows.select("bad", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"bin_{m}").alias("bin")) for m in cuts])).alias("b"))
    counts: dict[str, list[list[int]]] = {m: [[0, 0] for _ in range(len(c) + 1)] for m, c in cuts.items()}
    for r in melted.groupBy("b.measure", "b.bin").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect():
        counts[r["measure"]][r["bin"]] = [r["bad"], r["good"]]
    best, best_gain, precision = None, 1e-9, 0.0
    for m, bins in counts.items():
        bad, good = (sum(b[k] for b in bins) for k in (0, 1))
        if bad == 0:
            return None, 0.0
        before, low = math.log2(bad / (bad + good)), [0, 0]
        for border, (b, g) in zip(cuts[m], bins):
            low = [low[0] + b, low[1] + g]
            for above, p, n in ((False, *low), (True, bad - low[0], good - low[1])):
                gain = p * (math.log2(p / (p + n)) - before) if p >= min_cover else 0
                if gain > best_gain:
                    best, best_gain, precision = Condition(m, above, border), gain, p / (p + n)
    return best, precision


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[list[Condition]]:
    """Ordered rules that reject a text."""
    rows, cuts = labelled_bins(docs, labels, settings)
    rules: list[list[Condition]] = []
    grow, prune = rows.where(~F.col("held")), rows.where("held")
    if not cuts:
        return rules
    for _ in range(settings.max_rules):
        rule: list[Condition] = []
        inside = grow
        for _ in range(settings.max_conditions):
            condition, precision = best_condition(inside, cuts, settings.min_cover)
            if condition is None:
                break
            rule.append(condition)
            inside = inside.where(condition.column())
            if precision >= 0.99:
                break
        if not rule:
            break
        prefixes = [F.lit(True)]
        for condition in rule:
            prefixes.append(prefixes[-1] & condition.column())
        tallies = prune.agg(*[F.coalesce(F.sum(F.when(p, side)), F.lit(0)).alias(f"{name}{k}") for k, p in enumerate(prefixes[1:], 1)
                              for name, side in (("bad", F.col("bad")), ("good", 1 - F.col("bad")))]).first()
        worth = {k: (tallies[f"bad{k}"] - tallies[f"good{k}"]) / max(1, tallies[f"bad{k}"] + tallies[f"good{k}"]) for k in range(1, len(rule) + 1)}
        k = max(worth, key=lambda n: (worth[n], -n))
        bad, good = tallies[f"bad{k}"], tallies[f"good{k}"]
        if bad < settings.min_cover / 2 or bad < settings.min_precision * (bad + good):
            break
        rules.append(rule[:k])
        grow, prune = (part.where(~prefixes[k]) for part in (grow, prune))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The first rule that a row meets, as text; null if none."""
    chain = None
    for rule in rules:
        test = F.lit(True)
        for condition in rule:
            test = test & condition.column()
        said = F.lit(" and ".join(map(str, rule)))
        chain = F.when(test, said) if chain is None else chain.when(test, said)
    return F.lit(None).cast("string") if chain is None else chain


def judge(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """doc_id, base counts, base_failed, kept and the rule that rejected the text."""
    return measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & verdict(rules).isNull()).alias("kept"), verdict(rules).alias("rule"))


def keep_good(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """The documents that pass, with all their columns, in one scan without a shuffle."""
    return measures(docs, carry=True).where(~F.col("base_failed") & verdict(rules).isNull()).select("row.*")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.documents(spark, sf_dir)
    return judge(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
