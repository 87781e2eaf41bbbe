"""Quality rules whose cutoffs are chosen under a proven limit on false rejections.

Labelled documents are the holdout, in two folds. The tuning fold proposes a cutoff for
each rule in each length stratum. Between rejecting nothing and the proposal lie nested
settings of all rules together; on the other fold an exact binomial test asks, from the
loosest setting on, whether the rules jointly reject at most a given share of the good
documents. The setting before the first failure is used. Testing in a fixed order needs
no correction within a stratum; a Bonferroni correction covers the strata. Where a
stratum has too few good documents for any proof, nothing is rejected but by the base.

Everything is a DataFrame expression; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendlens.llm.common import SPACE_RUN, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Each rule's value by document; a document is rejected above the cutoff. All values
#: are scaled so that cutoffs lie from 0 to 1.
RULES = {
    "symbols": "n_symbols / n_words / 2",
    "repeats": "n_repeat_words / n_words",
    "dup_lines": "n_dup_lines / n_words * 10",
    "long_words": "word_chars / n_words / 40",
}


@dataclass(frozen=True)
class Risk:
    """At most ``share`` of a stratum's good documents rejected by the rules together, with
    ``confidence`` for all strata at once.

    ``edges`` are the word counts at which a new stratum begins; cutoffs are multiples of
    ``1 / steps``, and as many settings lie between none and the proposed one. One in
    ``tuning`` labelled ids is for the proposal, which lets each rule reject the part
    ``spared`` of an even portion of the share.
    """

    share: float = 0.02
    confidence: float = 0.95
    steps: int = 50
    edges: tuple[int, ...] = (100, 400)
    least_words: int = 20
    most_repeats: int = 30
    tuning: int = 3
    spared: float = 0.5


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the MEASURES of each whole text; NULL is empty.

    Words are parted by space and \\t to \\r. A repeated word lies in a window of
    WINDOW words that occurs at least twice in its text.
    """
    text = F.coalesce("text", F.lit(""))
    bare = text
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.filter(F.split(text, SPACE_RUN), lambda w: w != "").alias("words"),
        (F.length(text) - F.length(bare)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    hashed = split.select(
        "doc_id",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    starts = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int"))).otherwise(F.array().cast("array<int>"))
    windows = hashed.withColumn("w", F.transform(starts, lambda i: F.xxhash64(*[F.col("h")[i + k] for k in range(WINDOW)]))).drop("h")
    # only a text with an equal pair of windows needs its windows in order
    ranked = F.when(F.size(F.array_distinct("w")) < F.size("w"), F.array_sort(F.transform("w", lambda w, i: F.struct(w.alias("w"), i.alias("at")))))
    ranked = windows.withColumn("r", F.coalesce(ranked, F.array().cast("array<struct<w:bigint,at:int>>"))).drop("w")
    last = F.size("r") - 1

    def twin(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.col("r")[F.greatest(i - 1, F.lit(0))]["w"] == x["w"]).otherwise(False)
        after = F.when(i < last, F.col("r")[F.least(i + 1, last)]["w"] == x["w"]).otherwise(False)
        return before | after

    places = ranked.withColumn("p", F.array_sort(F.transform(F.filter("r", twin), lambda x: x["at"]))).drop("r")
    gaps = F.transform("p", lambda x, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), x - F.col("p")[F.greatest(i - 1, F.lit(0))])))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return places.withColumn("n_repeat_words", covered).select("doc_id", *MEASURES)


def with_values(measured: DataFrame, risk: Risk) -> DataFrame:
    """Adds base_failed, the stratum and, where there are words, the value of each rule."""
    failed = (F.col("n_words") < risk.least_words) | (100 * F.col("n_repeat_words") > risk.most_repeats * F.col("n_words"))
    stratum = sum(((F.col("n_words") >= edge).cast("int") for edge in risk.edges), F.lit(0))
    values = {name: F.when(F.col("n_words") > 0, F.expr(value.replace("/ n_words", "/ nullif(n_words, 0)"))) for name, value in RULES.items()}
    return measured.withColumns({"base_failed": failed, "stratum": stratum, **values})


def tail(n: Column, k: Column, p: float) -> Column:
    """P(at most k of n), each with probability p; 1 where k is above its mean."""
    odds = F.log(F.lit(p)) - F.log(F.lit(1 - p))
    first = n * F.log(F.lit(1 - p))

    def term(acc: Column, i: Column) -> Column:
        grown = acc["log"] + F.log((n - i + 1) / i) + odds
        return F.struct(grown.alias("log"), (acc["sum"] + F.exp(grown)).alias("sum"))

    ones = F.filter(F.sequence(F.lit(0), k.cast("int")), lambda i: i > 0)
    total = F.aggregate(ones, F.struct(first.alias("log"), F.exp(first).alias("sum")), term, lambda acc: acc["sum"])
    return F.when(k > n * p, F.lit(1.0)).otherwise(total)


def _bin(name: str, risk: Risk) -> Column:
    """Of a rule's value; a document is rejected where it is above the cutoff's step."""
    return F.least(F.ceil(F.col(name) * risk.steps), F.lit(risk.steps)).cast("int")


def proposed(good: DataFrame, risk: Risk) -> DataFrame:
    """A row for each stratum with the step that each rule could go down to, ``to_<rule>``: the
    lowest at which it rejects few enough of these good documents."""
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), _bin(name, risk).alias("bin")) for name in RULES]))
    counts = good.select("stratum", cells.alias("c")).groupBy("stratum", "c.rule", "c.bin").agg(F.count("*").alias("n"))
    # at most strata x rules x steps rows from here on
    steps = F.explode(F.sequence(F.lit(0), F.lit(risk.steps))).alias("step")
    over = F.sum(F.when(F.col("bin") > F.col("step"), F.col("n")).otherwise(0))
    per_step = counts.select("*", steps).groupBy("stratum", "rule", "step").agg(F.sum("n").alias("n"), over.alias("k"))
    fits = F.col("k") <= F.floor(F.col("n") * (risk.share * risk.spared / len(RULES)))
    return per_step.filter(fits).groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == name, F.col("step"))).alias(f"to_{name}") for name in RULES])


def _step(name: str, setting: Column, risk: Risk) -> Column:
    """A rule's step in a setting: none rejected at 0, the proposal at ``steps``."""
    return risk.steps - F.floor((risk.steps - F.col(f"to_{name}")) * setting / risk.steps).cast("int")


def cutoffs(valued: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    """(stratum, rule, cutoff, n, k): the certified cutoffs, with the good documents they were
    certified on and those of them they reject. A stratum without proof has no row.

    ``valued`` comes from :func:`with_values`; only documents that the base rules keep
    and that are labelled good count. Repeated labels of an id count once.
    """
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long")).distinct()
    rows = valued.filter("NOT base_failed").join(good, "doc_id", "left_semi").select("doc_id", "stratum", *RULES)
    tuning = F.pmod(F.xxhash64("doc_id"), F.lit(risk.tuning)) == 0
    targets = proposed(rows.filter(tuning), risk)
    # settings are nested, so a document is rejected from one on
    settings = F.sequence(F.lit(1), F.lit(risk.steps))

    def rejects(setting: Column) -> Column:
        found = F.lit(False)
        for name in RULES:
            found = found | F.coalesce(_bin(name, risk) > _step(name, setting, risk), F.lit(False))
        return found

    held = rows.filter(~tuning).join(F.broadcast(targets), "stratum")
    firsts = held.withColumn("first", F.coalesce(F.array_min(F.filter(settings, rejects)), F.lit(risk.steps + 1)))
    counts = firsts.groupBy("stratum", "first").agg(F.count("*").alias("n"))
    k = F.sum(F.when(F.col("first") <= F.col("setting"), F.col("n")).otherwise(0))
    per_setting = counts.select("*", F.explode(settings).alias("setting")).groupBy("stratum", "setting").agg(F.sum("n").alias("n"), k.alias("k"))
    proven = tail(F.col("n"), F.col("k"), risk.share) <= (1 - risk.confidence) / (len(risk.edges) + 1)
    failed = F.coalesce(F.min(F.when(~proven, F.col("setting"))).over(Window.partitionBy("stratum")), F.lit(risk.steps + 1))
    last = per_setting.withColumn("failed", failed).filter(F.col("setting") == F.col("failed") - 1)
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), (_step(name, F.col("setting"), risk) / risk.steps).alias("cutoff")) for name in RULES]))
    return last.join(F.broadcast(targets), "stratum").select("stratum", cells.alias("c"), "n", "k").select("stratum", "c.rule", "c.cutoff", "n", "k")


def judged(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Per document: doc_id, the MEASURES, base_failed, kept, rejected_by (the rules that reject
    it, "base" first, by commas; empty if it is kept).

    A NULL or empty text has no words and fails. Rows of one id are judged one by one;
    rows without id too, but they carry no label. Other columns are ignored.
    """
    valued = stored(with_values(measures(docs), risk), "measures")
    chosen = cutoffs(valued, labels, risk).groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"cut_{name}") for name in RULES])
    # one row for each stratum: at most len(edges) + 1
    rows = valued.join(F.broadcast(chosen), "stratum", "left")
    over = {name: F.coalesce(_bin(name, risk) > F.round(F.col(f"cut_{name}") * risk.steps), F.lit(False)) for name in RULES}
    by = F.concat_ws(",", F.when(F.col("base_failed"), "base"), *[F.when(found, name) for name, found in over.items()])
    return rows.select("doc_id", *MEASURES, "base_failed", (by == "").alias("kept"), by.alias("rejected_by"))
