"""Quality rules whose cutoffs are certified on labelled documents. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.common import WORD_PATTERN
from clickloom.session import materialize

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 3
LEAST_WORDS = 50
# A rule rejects values at its cutoff or above. Candidate cutoffs of each signal, smallest first.
SHARES = [0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5]
CUTOFFS = {
    "symbol_share": SHARES,
    "dup_line_share": SHARES,
    "repeat_share": SHARES,
    "capital_share": SHARES,
    "mean_word_chars": [8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0, 100.0],
}
FALSE_REJECTIONS = 0.05
DOUBT = 0.05
BROADCAST_STRATA = 10_000


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def counts(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts that the rules read, for every whole text.

    Repeated windows are found by sorting window hashes inside the row: neighbours that are equal repeat.
    Arrays that a lambda looks into are columns of an own projection, so they are computed once per row.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD_PATTERN))
    base = docs.select(
        "doc_id",
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.length(F.regexp_replace(text, SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        lines.alias("lines"),
        F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), 1).alias("words"),
    )
    counted = base.select(
        *[c for c in base.columns if c not in ("lines", "words")],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW),
                lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
            ),
        ).alias("windows"),
    )
    plain = [c for c in counted.columns if c != "windows"]
    ordered = counted.select(*plain, "windows", F.sort_array("windows").alias("sorted"))
    repeats = F.exists(
        F.sequence(F.lit(1), F.size("sorted") - 1), lambda i: F.get("sorted", i) == F.get("sorted", i - 1)
    )
    flagged = ordered.select(*plain, "windows", F.when(F.size("sorted") > 1, repeats).alias("repeats"))
    # Only texts with a repeated window are sorted again with the windows' places.
    placed = flagged.select(
        *plain,
        F.when(
            F.col("repeats"),
            F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("window"), i.alias("place")))),
        ).alias("placed"),
    )
    same = lambda i, j: F.get("placed", i)["window"].eqNullSafe(F.get("placed", j)["window"])
    again = F.filter(
        F.sequence(F.lit(0), F.size("placed") - 1), lambda i: same(i, i - 1) | same(i, i + 1)
    )
    places = placed.select(
        *plain,
        F.when(
            F.col("placed").isNotNull(), F.sort_array(F.transform(again, lambda i: F.get("placed", i)["place"]))
        ).alias("places"),
    )
    # A window covers its words up to the next repeated window, at most its own.
    gaps = F.transform("places", lambda p, k: F.coalesce(F.least(F.lit(WINDOW), F.get("places", k + 1) - p), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda total, n: total + n)
    return places.select(*plain, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def signals(counted: DataFrame) -> DataFrame:
    """``counted`` with base_failed and the signals of CUTOFFS."""
    return counted.withColumns(
        {
            "base_failed": (F.col("n_words") < LEAST_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
            "symbol_share": _share(F.col("n_symbols"), F.col("word_chars")),
            "dup_line_share": _share(F.col("n_dup_lines"), F.col("n_lines")),
            "repeat_share": _share(F.col("n_repeat_words"), F.col("n_words")),
            "capital_share": _share(F.col("n_capitals"), F.col("word_chars")),
            "mean_word_chars": _share(F.col("word_chars"), F.col("n_words")),
        }
    )


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """The exact probability of at most ``k`` successes in ``n`` trials of probability ``p``.

    Terms follow from their predecessor, in logarithms; those too small for a double add nothing.
    """
    first = n * F.log1p(F.lit(-p))
    ratio = F.log(F.lit(p)) - F.log1p(F.lit(-p))
    start = F.struct(first.alias("log_term"), F.exp(first).alias("total"))

    def add(state: Column, i: Column) -> Column:
        term = state["log_term"] + F.log((n - i + 1) / i) + ratio
        return F.struct(term.alias("log_term"), (state["total"] + F.exp(term)).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, add, lambda state: state["total"])


def _reached(signal: str, cutoffs: list[float]) -> Column:
    """How many of the rising cutoffs a signal reaches."""
    return F.size(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: F.col(signal) >= c))


def certified_cutoffs(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """stratum, signal, cutoff: for each signal the smallest cutoff that is certified in the stratum.

    Holdout: documents labelled good (by all their labels) that pass the base rules. A cutoff that rejects k of
    n of them is certified if at most k rejections would have a probability of at most the corrected level
    were the true rate its allowance. The allowance is an equal share of FALSE_REJECTIONS for each signal, the
    level is DOUBT divided by the number of strata and candidates tested (Bonferroni); so with probability
    0.95, in no stratum do all rules together reject more than 5 % of good documents.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    holdout = judged.where(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    levels = F.explode(
        F.array(*[F.struct(F.lit(s).alias("signal"), _reached(s, cuts).alias("level")) for s, cuts in CUTOFFS.items()])
    )
    tally = (
        holdout.select("stratum", levels.alias("at"))
        .groupBy("stratum", "at.signal", "at.level")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    # From here on: one row per stratum, signal and candidate.
    cuts = F.create_map(*[x for s, c in CUTOFFS.items() for x in (F.lit(s), F.array(*map(F.lit, c)))])
    tests = (
        tally.groupBy("stratum", "signal")
        .agg(F.sum("docs").alias("n"), F.map_from_entries(F.collect_list(F.struct("level", "docs"))).alias("by_level"))
        .select("stratum", "signal", "n", "by_level", F.posexplode(F.element_at(cuts, F.col("signal"))).alias("i", "cutoff"))
        .withColumn(
            "rejected",
            F.aggregate(
                F.map_entries(F.map_filter("by_level", lambda level, _: level > F.col("i"))),
                F.lit(0).cast("long"),
                lambda total, entry: total + entry["value"],
            ),
        )
    )
    strata = judged.agg(F.count_distinct("stratum")).first()[0]
    level = DOUBT / max(1, strata * sum(map(len, CUTOFFS.values())))
    allowed = FALSE_REJECTIONS / len(CUTOFFS)
    certified = tests.where(F.col("rejected") < F.col("n") * allowed).where(
        binomial_tail(F.col("n"), F.col("rejected"), allowed) <= level
    )
    return certified.groupBy("stratum", "signal").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts, base_failed and kept for every document.

    A document fails the base rules with fewer than 50 words, or if more than half of its words lie in 3-word
    windows that its text repeats. Of the others those are kept that no certified rule of their stratum
    rejects; a stratum with too few labels to certify anything rejects nothing.

    NULL and empty texts have no words and fail; NULL strata are one stratum; rows may repeat; a label
    without a document and a document without a label are fine; an empty table gives no rows.
    """
    judged = materialize(signals(counts(docs, stratum)), "quality-signals")
    rules = materialize(
        certified_cutoffs(judged, labels)
        .groupBy(F.col("stratum").alias("ruled"))
        .agg(F.map_from_entries(F.collect_list(F.struct("signal", "cutoff"))).alias("cutoffs")),
        "quality-rules",
    )
    few = rules.count() <= BROADCAST_STRATA
    joined = judged.join(F.broadcast(rules) if few else rules, F.col("stratum") == F.col("ruled"), "left")
    fired = F.lit(False)
    for signal in CUTOFFS:
        fired = fired | F.coalesce(F.col(signal) >= F.try_element_at("cutoffs", F.lit(signal)), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~fired).drop("ruled", "cutoffs")
