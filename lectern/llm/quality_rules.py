"""Quality rules whose cutoffs are certified on labelled documents.

Each rule compares a measure of a text (symbols, repeats, capitals, ...) with LEVELS cutoffs from mild to extreme, fixed
before any label is seen. The severity of a text is the highest level that any rule gives it; rejecting from a level on
rejects by all rules' cutoffs of that level at once, so levels are one nested family of joint cutoffs.

A level is used in a stratum (a language) only if an exact binomial test on all labelled good documents of that stratum
shows that it rejects at most RISK of them. Levels are tested in a fixed sequence from the extreme down, each at the whole
level of its stratum: what is rejected only grows, so the first failing test ends the sequence and the number of levels
costs nothing. DELTA is divided by the number of strata (Bonferroni): all certificates hold at once with probability
1 - DELTA. Of the certified levels the one that rejects most bad documents is taken (ties: the one that rejects fewest).
With no good document rejected, a stratum needs log(DELTA / strata) / log(1 - RISK) labelled good ones: 436 for 4 strata.

The whole path is DataFrame functions: no Python runs on the executors.

Edge cases: a null or empty text has no words and fails the base rule (n_words < 20). A null language is a stratum of
its own. Labels without a document, with null quality or a null id are ignored; repeated labels of one id count once, as
good only if all say so. A stratum without enough good labels certifies nothing, so only the base rule rejects there.
Repeated rows get equal results. Input columns pass through unchanged: what is computed lies in one struct column, and on
the way in columns that begin with its name, so no input column may begin with it; kept() chooses a free name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, unused, words, written

QUALITY = "__quality"
#: All rules together may reject this part of a stratum's good documents; the certificates fail with DELTA at most.
RISK, DELTA = 0.01, 0.05
WINDOW, LEVELS = 8, 24

#: Rule: a measure and its cutoffs, level by level. A text has the levels whose cutoffs its measure exceeds.
RULES = {
    "symbols": [0.01 * 1.2**k for k in range(LEVELS)],
    "repeats": [0.15 + 0.0125 * k for k in range(LEVELS)],
    "dup_lines": [0.15 + 0.03 * k for k in range(LEVELS)],
    "capitals": [0.05 + 0.03 * k for k in range(LEVELS)],
    "exclaims": [0.01 * 1.2**k for k in range(LEVELS)],
    "long_words": [8 + 0.5 * k for k in range(LEVELS)],
    "short_words": [-3.5 + 0.1 * k for k in range(LEVELS)],
}


def measured(df: DataFrame, text: str = "text", keep_text: bool = True, name: str = QUALITY) -> DataFrame:
    """df, without its text on request, with the struct of this name: the counts of the contract and the measures of RULES.

    Each step is a projection over plain columns and uses a computed array at least twice: so Catalyst keeps the steps
    apart and moves the making of no array into a lambda. The rows are written to the shared folder: texts are read and
    measured once, and filters on measures are not pushed into their making.
    """
    left = [f"`{x}`" for x in df.columns if keep_text or x != text]
    kept = [f"`{x}`" for x in df.columns]
    t = F.coalesce(F.col(text), F.lit(""))
    c = lambda x: F.col(f"{name}_{x}")

    def step(frame: DataFrame, *carried: str, **columns: Column) -> DataFrame:
        return frame.select(*kept, *[c(k) for k in carried], *[v.alias(f"{name}_{k}") for k, v in columns.items()])

    df = step(
        df,
        words=words(F.col(text)),
        lines=F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)),
        n_symbols=F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        n_upper=F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        n_exclaims=F.regexp_count(t, F.lit("[!?]")).cast("long"),
    )
    df = step(
        df,
        "n_symbols",
        "n_upper",
        "n_exclaims",
        n_words=F.size(c("words")).cast("long"),
        word_chars=F.length(F.array_join(c("words"), "")).cast("long"),
        n_lines=F.size(c("lines")).cast("long"),
        n_dup_lines=(F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        hashes=F.transform(c("words"), lambda w: F.xxhash64(w)),
    )
    counts = ("n_words", "word_chars", "n_lines", "n_dup_lines", "n_symbols", "n_upper", "n_exclaims")
    starts = F.sequence(F.lit(1), F.greatest(F.size(c("hashes")) - (WINDOW - 1), F.lit(1)))
    df = step(df, *counts, windows=F.when(F.size(c("hashes")) >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(c("hashes"), i, WINDOW)))))
    repeated = F.size(F.array_distinct(c("windows"))) < F.size(c("windows"))
    df = step(df, *counts, ordered=F.when(repeated, F.sort_array(F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    beside = lambda x, k: (x["h"] == F.get(c("ordered"), k - 1)["h"]) | (x["h"] == F.get(c("ordered"), k + 1)["h"])
    twice = F.filter(c("ordered"), lambda x, k: F.coalesce(beside(x, k), F.lit(False)))
    df = step(df, *counts, starts=F.when(c("ordered").isNotNull(), F.sort_array(F.transform(twice, lambda x: x["i"]))))
    covered = F.aggregate(
        c("starts"),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    kept = left
    df = step(df, *counts, n_repeat_words=F.coalesce(covered, F.lit(0).cast("long")))
    per = lambda n, d: F.coalesce(c(n) / F.nullif(c(d), F.lit(0)), F.lit(0.0))
    scores = F.struct(
        per("n_symbols", "word_chars").alias("symbols"),
        per("n_repeat_words", "n_words").alias("repeats"),
        per("n_dup_lines", "n_lines").alias("dup_lines"),
        per("n_upper", "word_chars").alias("capitals"),
        per("n_exclaims", "word_chars").alias("exclaims"),
        per("word_chars", "n_words").alias("long_words"),
        (-per("word_chars", "n_words")).alias("short_words"),
    )
    df = df.select(*left, *[c(k) for k in (*counts, "n_repeat_words")], scores.alias(f"{name}_scores"))
    level = lambda rule, grid: F.size(F.filter(F.array(*map(F.lit, grid)), lambda x: c("scores")[rule] > x))
    severity = F.greatest(*[level(rule, grid) for rule, grid in RULES.items()])
    base_failed = (c("n_words") < 20) | (100 * c("n_repeat_words") > 30 * c("n_words"))
    fields = [c(k).alias(k) for k in (*counts, "n_repeat_words")]
    return written(df.select(*left, F.struct(*fields, base_failed.alias("base_failed"), c("scores").alias("scores"), severity.alias("severity")).alias(name)), "measured")


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly term by term from the first."""
    step = math.log(p / (1 - p))
    return F.aggregate(
        F.sequence(F.lit(0), k.cast("int")),
        F.struct((n * math.log1p(-p)).alias("log"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct((a["log"] + F.log(F.greatest(n - j, F.lit(1e-300)) / (j + 1)) + step).alias("log"), (a["sum"] + F.exp(a["log"])).alias("sum")),
        lambda a: F.least(a["sum"], F.lit(1.0)),
    )


def certified(measures: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA, name: str = QUALITY) -> DataFrame:
    """(stratum, level, cutoffs): the level from which a stratum rejects, and the cutoff of each rule there; no row where none is certified.

    measures: what measured() gives, with doc_id. A row for each stratum and level is all that is shuffled after the join
    with the labels.
    """
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("good"))
    counts = (
        measures.where(~F.col(f"{name}.base_failed"))
        .select("doc_id", F.col(stratum).cast("string").alias("stratum"), F.col(f"{name}.severity").alias("level"))
        .join(good, "doc_id")
        .groupBy("stratum", "level")
        .agg(F.sum((F.col("good") > 0).cast("long")).alias("n_good"), F.sum((F.col("good") <= 0).cast("long")).alias("n_bad"))
    )
    counts = written(counts, "level-counts")
    share = delta / max(1, counts.select("stratum").distinct().count())
    # LEVELS + 1 rows at most in each window. Levels that no document has change nothing.
    above = Window.partitionBy("stratum").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy("stratum")
    tests = counts.select("stratum", "level", F.sum("n_good").over(above).alias("k"), F.sum("n_bad").over(above).alias("bad"), F.sum("n_good").over(everything).alias("n"))
    # k never falls from one level to the next, so neither do the tails: those up to the first failing one are those that pass.
    sure = tests.where((F.col("level") > 0) & (F.col("k") <= F.col("n") * risk) & (F.col("bad") > 0)).where(binomial_tail(F.col("k"), F.col("n"), risk) <= share)
    best = sure.groupBy("stratum").agg(F.max(F.struct("bad", "level")).alias("b")).select("stratum", F.col("b.level").alias("level"))
    cutoffs = F.struct(*[F.get(F.array(*map(F.lit, grid)), F.col("level") - 1).alias(rule) for rule, grid in RULES.items()])
    return written(best.select("stratum", "level", cutoffs.alias("cutoffs")), "cutoffs")


def judged(measures: DataFrame, cutoffs: DataFrame, stratum: str = "lang", name: str = QUALITY) -> DataFrame:
    """measures with kept in its struct: not base_failed and below the certified level of its stratum, if there is one.

    cutoffs has one short row for each stratum and was written before, so Spark knows its size: it is broadcast below
    Spark's own limit and joined by shuffle, with skewed strata split, above it.
    """
    names = [f"`{x}`" for x in measures.columns if x != name]
    limits = cutoffs.select(F.col("stratum").alias(f"{name}_stratum"), F.col("level").alias(f"{name}_level"))
    joined = measures.join(limits, F.col(stratum).cast("string").eqNullSafe(F.col(f"{name}_stratum")), "left")
    rejected = F.col(f"{name}.base_failed") | F.coalesce(F.col(f"{name}.severity") >= F.col(f"{name}_level"), F.lit(False))
    return joined.select(*names, F.col(name).withField("kept", ~rejected).alias(name))


def kept(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their columns unchanged."""
    (name,) = unused(docs, QUALITY)
    rows = measured(docs, name=name)
    return judged(rows, certified(rows, labels, stratum, name=name), stratum, name).where(F.col(name).kept).drop(name)
