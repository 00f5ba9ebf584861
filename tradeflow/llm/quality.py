"""Quality rules whose cutoffs come with a bound on rejected good documents.

Each rule compares one measure of a text with a cutoff. Cutoffs are tried from
loose to tight on labelled documents, per stratum. A cutoff is safe when the
exact binomial test refutes that good documents exceed it more often than
``risk``; trying stops at the first cutoff that isn't safe (fixed-sequence
testing), and the level is divided by the number of strata times rules
(Bonferroni). So with probability 1 - ``alpha`` no rule rejects more than
``risk`` of any stratum's good documents. Where labels are too few to show it,
the rule rejects nothing.

Everything is expressions over whole texts, no Python. The measures are written
once and read twice. What the labels contribute is counts per stratum, rule and
cutoff. The strata's cutoffs are few rows; adaptive execution broadcasts them if
they are small, so no hint is given.

Null texts are empty. A null stratum is a stratum. Documents of a stratum
without labels meet the fixed rules alone. A document labelled twice is good
only if all its labels say so; null labels say nothing. Repeated rows are judged
alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.text import free_names
from tradeflow.workspace import new_folder, settled

SPACE = r"[\x20\x09-\x0D]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Reject where ``measure`` (SQL over the base columns) is above a cutoff; cutoffs from loose to tight."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / n_words", (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("duplicate_lines", "n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    Rule("repeats", "n_repeat_words / n_words", (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
    Rule("long_words", "word_chars / n_words", (20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
)
RISK = 0.005
ALPHA = 0.05


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(places: Column, width: int) -> Column:
    """How many numbers lie in [p, p + width) for some p of a sorted array."""
    state = lambda n, end: F.struct(n.cast("int").alias("n"), end.cast("int").alias("end"))
    return F.aggregate(
        places, state(F.lit(0), F.lit(0)),
        lambda s, p: state(s["n"] + width - F.greatest(F.lit(0), s["end"] - p), p + width),
        lambda s: s["n"],
    )


def _repeated_places(grams: Column) -> Column:
    """Places, in order, of values that an array holds twice or more."""
    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    twice = _bound(pairs, lambda s: F.filter(s, lambda x, k: (
        (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"])) & F.lit(True)))
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def repeat_words(words: Column) -> Column:
    """Words in a run of three that the array holds twice or more."""
    gram = lambda w, i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    grams = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: gram(w, i))
    count = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
        _covered(_repeated_places(g), 3))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_bound(grams(words), count))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Base columns of each row of ``docs``, with its stratum."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = _bound(words, lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeat_words(w).alias("n_repeat_words")))
    of_lines = _bound(lines, lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(stratum_col).cast("string").alias("stratum"),
                       of_words.alias("w"), of_lines.alias("l"), symbols.cast("bigint").alias("n_symbols"))
    long = lambda c: F.col(c).cast("bigint").alias(c.partition(".")[2])
    return rows.select("doc_id", "text_hash", "stratum", long("w.n_words"), long("w.word_chars"), "n_symbols",
                       long("l.n_dup_lines"), long("l.n_lines"), long("w.n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n), for k up to n * p; 1 beyond, where it is no use as a level."""
    first = n * F.log(F.lit(1 - p))
    state = lambda term, total: F.struct(term.alias("term"), total.alias("total"))
    step = lambda s, i: (s["term"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p))))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(steps, state(first, F.exp(first)),
                       lambda s, i: state(step(s, i), s["total"] + F.exp(step(s, i))), lambda s: s["total"])
    return F.when(k > n * p, F.lit(1.0)).otherwise(tail)


def safe_cutoffs(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", *,
                 rules: tuple[Rule, ...] = RULES, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """The tightest safe cutoff of each stratum and rule that has one.

    ``stratum, rule, cutoff, good, rejected, p_value``, over good documents that
    the fixed rules pass.
    """
    good = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("label is not null")
    good = good.groupBy("doc_id").agg(F.min("label").alias("label")).where("label = 1").select("doc_id")
    held = measured.where(~base_failed()).join(good, "doc_id")
    # A value above a cutoff is above all tighter ones, so how many it exceeds says which.
    over = [F.struct(F.lit(r.name).alias("rule"), sum(
        [(F.expr(r.measure) > c).cast("int") for c in r.cutoffs], F.lit(0)).alias("over")) for r in rules]
    counts = held.select("stratum", F.inline(F.array(*over))).groupBy("stratum", "rule", "over").agg(F.count(F.lit(1)).alias("n"))
    counts = settled(counts, new_folder(measured.sparkSession, "rule-counts"))
    tests = counts.select("stratum").distinct().count() * len(rules)
    grid = [F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("place"), F.lit(c).alias("cutoff"))
            for r in rules for i, c in enumerate(r.cutoffs)]
    sums = counts.groupBy("stratum", "rule").agg(F.sum("n").alias("good"), F.map_from_entries(
        F.collect_list(F.struct("over", "n"))).alias("by_over"))
    tried = sums.select("*", F.inline(F.filter(F.array(*grid), lambda g: g["rule"] == F.col("rule"))).alias("_rule", "place", "cutoff"))
    # Above cutoff i of n: above it and the n - 1 - i tighter ones.
    sizes = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(len(r.cutoffs)))])
    rejected = F.aggregate(F.map_entries("by_over"), F.lit(0).cast("bigint"), lambda s, e: s + F.when(
        e["key"] >= sizes[F.col("rule")] - F.col("place"), e["value"]).otherwise(0))
    tested = tried.select("stratum", "rule", "place", "cutoff", "good", rejected.alias("rejected")).withColumn(
        "p_value", binomial_tail(F.col("rejected"), F.col("good"), risk))
    in_order = Window.partitionBy("stratum", "rule").orderBy("place")
    passed = tested.withColumn("safe", F.max("p_value").over(in_order) <= alpha / max(tests, 1)).where("safe")
    return passed.groupBy("stratum", "rule").agg(F.max_by(
        F.struct("cutoff", "good", "rejected", "p_value"), "place").alias("best")).select("stratum", "rule", "best.*")


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", *,
           rules: tuple[Rule, ...] = RULES, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """Measures and verdicts of each row: ``base_failed``, ``kept`` and the names of ``failed`` rules."""
    measured = settled(measures(docs, id_col, text_col, stratum_col), new_folder(docs.sparkSession, "measures"))
    found = safe_cutoffs(measured, labels, rules=rules, risk=risk, alpha=alpha)
    limits = found.groupBy(F.coalesce("stratum", F.lit("")).alias("_name"), F.col("stratum").isNull().alias("_none")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    failed = F.array_compact(F.array(*[
        F.when(F.expr(r.measure) > F.col("limits")[r.name], F.lit(r.name)) for r in rules]))
    named = measured.withColumn("_name", F.coalesce("stratum", F.lit(""))).withColumn("_none", F.col("stratum").isNull())
    return named.join(limits, ["_name", "_none"], "left").withColumn(
        "base_failed", base_failed()).withColumn("failed", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(failed)).select(
        "doc_id", "text_hash", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   stratum_col: str = "lang", **settings) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    kept_id, kept_hash = free_names(docs.columns, "_kept_id", "_kept_hash")
    verdict = judged(docs, labels, id_col, text_col, stratum_col, **settings).where("kept").select(
        F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash))
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.xxhash64(text_col) == F.col(kept_hash))
    return docs.join(verdict, same, "left_semi")
