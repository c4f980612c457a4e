"""Quality rules whose cutoffs are chosen by risk control on labelled holdouts.

Every rule rejects documents whose score reaches a cutoff. Which rules a stratum (language) uses is decided by its labelled
bad documents alone: each of them is credited to the rule that, of those that reject it at their strictest cutoff, rejects the
most of them (of several, the first), and the rules with any credit are in use. So no risk is spent on a rule that adds nothing to
another. The cutoffs are decided by the labelled good documents alone, which that choice has not looked at. For each stratum and rule in use, the cutoffs of
a fixed grid are tried from the mildest to the strictest. With ``n`` good documents of which ``k`` would be rejected, a
cutoff is certified when the exact binomial tail P(Binomial(n, risk) <= k) is at most the test's level, that is when the
Clopper-Pearson upper bound on the false rejection rate is below ``risk``. The strictest certified cutoff with only
certified milder ones is taken (fixed-sequence testing, which needs no correction along the grid); a stratum's risk is
divided by the number of its rules in use, the level by the number of all tests, strata times rules in use
(Bonferroni). So with probability ``1 - delta`` no stratum loses more than ``risk`` of its good documents.

How many labels that takes: with m rules in use and T tests, log(delta / T) / log(1 - risk / m) good documents, for example 108
for one rule in each of four strata at the default risk. Strata with fewer (taking T = m times all strata) are judged together as
one pool; for these the guarantee holds for the pool, not for each of its strata. Where not even the pool has enough, nothing is
certified and nothing is rejected, nor in strata without labelled good documents.

DataFrame functions only; the text is read once, its scores are written, and the chosen cutoffs are a written table of
at most one row per stratum that could certify something. All counts cover every labelled document.

Defined results: a null text has no words; a null stratum is a stratum of its own; documents with labels that disagree
count as bad; labels without document and documents without label are ignored when choosing; a document that has
no score for a rule (no words) is never rejected by it; extra columns pass through ``keep_rows``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.common import SPACES, let, words, written

SYMBOLS = "#*$%&|<>"

# Score in [0, 1], higher is worse, and its cutoffs from the mildest to the strictest. Fixed before any label is seen.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / nullif(word_chars, 0)", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01]),
    "repeats": ("n_repeat_words / nullif(n_words, 0)", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "lines": ("n_dup_lines / nullif(n_lines, 0)", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "long_words": ("least(word_chars / nullif(n_words, 0) / 20, 1)", [0.9, 0.75, 0.65, 0.55, 0.5, 0.45, 0.4, 0.375, 0.35]),
}


def repeat_words(ws: Column) -> Column:
    """How many words stand in a three-word window that the text has at least twice. O(n log n)."""
    n = F.size(ws)

    def covered(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.struct(
            F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("t"), i.alias("i")))
        return let(F.sort_array(windows), repeated)

    def repeated(s: Column) -> Column:
        size = F.size(s)
        twice = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["t"] == x["t"]))
                         | ((k + 1 < size) & (F.get(s, k + 1)["t"] == x["t"])))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), union_length)

    def union_length(at: Column) -> Column:
        # each window covers three words, less what the next window covers as well
        return F.aggregate(F.transform(at, lambda x, k: F.least(F.coalesce(F.get(at, k + 1) - x, F.lit(3)), F.lit(3))),
                           F.lit(0).cast("long"), lambda a, x: a + x)

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(ws, covered))


def measures(text: Column) -> Column:
    """Struct of the counts that the rules use."""
    full = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    bare = F.length(F.translate(full, SPACES, "")).cast("long")
    symbols = (F.length(full) - F.length(F.translate(full, SYMBOLS, ""))).cast("long")
    counted = lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), repeat_words(ws).alias("n_repeat_words"))
    lined = lambda ls: F.struct(F.size(ls).cast("long").alias("n_lines"),
                                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"))
    return F.struct(let(words(full), counted).alias("w"), let(lines, lined).alias("l"),
                    bare.alias("word_chars"), symbols.alias("n_symbols"))


def measured(docs: DataFrame, stratum: str) -> DataFrame:
    """(row, doc_id, stratum, counts, base_failed) of every document; ``row`` holds all its columns."""
    return (docs.select(F.struct("*").alias("row"), measures(F.col("text")).alias("m"))
            .select("row", "row.doc_id", F.col(f"row.{stratum}").alias("stratum"), "m.w.n_words", "m.word_chars",
                    "m.n_symbols", "m.l.n_dup_lines", "m.w.n_repeat_words", "m.l.n_lines")
            .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")))


def binomial_tail(n: Column, k: Column, p: Column) -> Column:
    """P(Binomial(n, p) <= k) for k <= n * p (1.0 above, where no level is reached), by the ratio of successive terms.

    Below the mode the terms fall at least geometrically, so the sum from k downwards has converged to double
    precision long before ``10 * sqrt(n)`` terms.
    """
    def log_factorial(x: Column) -> Column:
        y = x + F.lit(11.0)  # Stirling's series for gamma(x + 11), divided by (x + 1) ... (x + 10)
        series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
        shift = F.log(x + 1.0)
        for j in range(2, 11):
            shift = shift + F.log(x + float(j))
        return series - shift

    nd, kd = n.cast("double"), k.cast("double")
    top = log_factorial(nd) - log_factorial(kd) - log_factorial(nd - kd) + kd * F.log(p) + (nd - kd) * F.log(1 - p)
    steps = F.sequence(F.lit(0).cast("long"), F.least(k, (F.lit(40.0) + 10 * F.sqrt(nd)).cast("long")))
    total = F.aggregate(steps, F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")), lambda a, j: F.struct(
        (a["sum"] + a["term"]).alias("sum"),
        (a["term"] * (kd - j) / (nd - kd + j + 1.0) * ((1 - p) / p)).alias("term")))["sum"]
    return F.when(kd <= nd * p, F.exp(top) * total).otherwise(F.lit(1.0))


def choose_cutoffs(scored: DataFrame, labels: DataFrame, rules: Mapping = RULES, risk: float = 0.04,
                   delta: float = 0.05) -> DataFrame:
    """One row per stratum with a certified cutoff; a column per rule, null where none is certified.

    ``scored`` has (doc_id, stratum, base_failed, the counts). Documents that the base checks reject are not part of
    the holdout: no cutoff can change their fate.
    """
    label = labels.where("quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    names = list(rules)
    grid = {r: F.array(*[F.lit(float(c)) for c in rules[r][1]]) for r in names}
    # reach: how many cutoffs of the grid, from the strictest on, the document's score reaches
    reach = lambda r: F.coalesce(F.size(F.filter(grid[r], lambda c: F.expr(rules[r][0]) >= c)), F.lit(0))
    held = (scored.where("not base_failed").join(label, "doc_id")
            .select("stratum", "good", F.array(*[F.struct(F.lit(i).alias("place"), F.lit(r).alias("rule"), reach(r).alias("reach"))
                                                 for i, r in enumerate(names)]).alias("x")))
    # at most one row per stratum, rule and step of its grid; at most one per stratum and set of rules
    counts = written(held.where("good").select("stratum", F.explode("x").alias("x")).groupBy("stratum", "x.rule", "x.reach")
                     .agg(F.count("*").alias("docs")), "holdout-counts")
    caught = F.transform(F.filter("x", lambda x: x["reach"] > 0), lambda x: F.struct(x["place"], x["rule"]))
    broken = written(held.where("NOT good").select("stratum", caught.alias("broken")).where(F.size("broken") > 0)
                     .groupBy("stratum", "broken").agg(F.count("*").alias("docs")), "rejected-bad")
    group = _groups(counts, broken, risk, delta, names[0])
    of_group = lambda df: df.join(group, df["stratum"].eqNullSafe(group["member"]))
    grouped = of_group(counts).groupBy("pool", "name", "rule").agg(
        F.sum("docs").alias("n"), F.collect_list(F.struct("reach", "docs")).alias("h"))
    used = written(grouped.join(_in_use(of_group(broken), "pool", "name").withColumnRenamed("name", "its_name"),
                                ["pool", "rule"]).where(F.col("name").eqNullSafe(F.col("its_name"))).drop("its_name"), "rules-in-use")
    in_group = F.count("*").over(Window.partitionBy("pool", "name"))  # one row per rule
    tests = used.count()
    # a document with reach r is rejected by every cutoff from position size - r on (0: the mildest)
    sizes = F.create_map(*[x for r in names for x in (F.lit(r), F.lit(len(rules[r][1])))])
    every = (used.withColumn("m", in_group)
             .withColumn("at", F.explode(F.sequence(F.lit(0), F.element_at(sizes, F.col("rule")) - 1)))
             .withColumn("k", F.aggregate("h", F.lit(0).cast("long"), lambda a, x: a + F.when(
                 x["reach"] >= F.element_at(sizes, F.col("rule")) - F.col("at"), x["docs"]).otherwise(0))))
    tested = every.withColumn("certified", binomial_tail(F.col("n"), F.col("k"), F.lit(risk) / F.col("m")) <= delta / max(1, tests))
    first_failed = F.min(F.when(~F.col("certified"), F.col("at")))
    chosen = (tested.groupBy("pool", "name", "rule")
              .agg(F.coalesce(first_failed, F.max("at") + 1).alias("passed")).where("passed > 0"))
    cutoff = lambda r: F.max(F.when(F.col("rule") == r, F.element_at(grid[r], F.col("passed").cast("int"))))
    cuts = chosen.groupBy("pool", "name").agg(*[cutoff(r).alias(f"cut_{r}") for r in names])
    mine = cuts["pool"].eqNullSafe(group["pool"]) & cuts["name"].eqNullSafe(group["name"])
    return written(cuts.join(group, mine).select(F.col("member").alias("stratum"), *[f"cut_{r}" for r in names]), "cutoffs")


def _in_use(broken: DataFrame, *keys: str) -> DataFrame:
    """The rules with credit for a labelled bad document: (keys, rule). ``broken`` counts documents by the rules that reject them."""
    each = broken.select(*keys, "broken", "docs", F.explode("broken").alias("r"))
    own = Window.partitionBy(*keys, "r")  # one row per set of rules
    best = F.max(F.struct("caught", (-F.col("r.place")).alias("first"), F.col("r.rule").alias("rule")))
    return (each.withColumn("caught", F.sum("docs").over(own)).groupBy(*keys, "broken").agg(best.alias("best"))
            .select(*keys, F.col("best.rule").alias("rule")).distinct())


def _groups(counts: DataFrame, broken: DataFrame, risk: float, delta: float, any_rule: str) -> DataFrame:
    """(member, pool, name): the group that each stratum with labelled good documents is judged in, itself or the pool."""
    sizes = counts.where(F.col("rule") == any_rule).groupBy("stratum").agg(F.sum("docs").alias("n"))
    rules = _in_use(broken, "stratum").groupBy("stratum").agg(F.count("*").alias("m")).withColumnRenamed("stratum", "of")
    strata = written(sizes.join(rules, F.col("stratum").eqNullSafe(F.col("of")), "left")
                     .select("stratum", "n", F.coalesce("m", F.lit(1)).alias("m")), "holdout-strata")
    of_all = strata.count()
    small = F.pow(1 - F.lit(risk) / F.col("m"), F.col("n")) > F.lit(delta) / (F.col("m") * max(1, of_all))
    return strata.select(F.col("stratum").alias("member"), small.alias("pool"), F.when(~small, F.col("stratum")).alias("name"))


def judged(scored: DataFrame, cutoffs: DataFrame, rules: Mapping = RULES) -> DataFrame:
    """``scored`` with ``rejected_by`` (the rules that the document breaks) and ``kept``."""
    cut = cutoffs.withColumnRenamed("stratum", "cut_stratum")
    breaks = [F.when(F.coalesce(F.expr(score) >= F.col(f"cut_{r}"), F.lit(False)), F.lit(r)) for r, (score, _) in rules.items()]
    return (scored.join(cut, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
            .withColumn("rejected_by", F.array_compact(F.array(*breaks)))
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
            .drop("cut_stratum", *[f"cut_{r}" for r in rules]))


def quality_report(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk) -> DataFrame:
    """The counts and the verdict of every document."""
    scored = written(measured(docs, stratum).drop("row"), "quality")
    return judged(scored, choose_cutoffs(scored, labels, **risk))


def keep_rows(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    scored = written(measured(docs, stratum), "quality-rows")
    return judged(scored, choose_cutoffs(scored.drop("row"), labels, **risk)).where("kept").select("row.*")
