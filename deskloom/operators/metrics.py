"""Evaluation metrics. Every metric first reduces to counts per label (or label pair) with
map-side combine; the formulas then run on a table as small as the label set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.functions import lexicon as lex
from deskloom.functions import text as tx
from deskloom.operators.skew import median_of, running_levels


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def share(flag: Column) -> Column:
    """Mean of a boolean; null on no rows."""
    return F.avg(flag.cast("double"))


def accuracy(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(gold) == F.col(predicted)).alias("correct"),
        F.coalesce(share(F.col(gold) == F.col(predicted)), F.lit(0.0)).alias("accuracy"),
    )


def pair_counts(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(gold).alias("gold"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, gold: str, predicted: str, labels: Sequence[str] | None = None) -> DataFrame:
    """label, precision, recall, f1, support. Without ``labels``: every label that occurs as
    gold or predicted. A ratio over nothing is 0."""
    pairs = pair_counts(df, gold, predicted)
    # each pair counts towards its gold label and its predicted label
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("gold").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("claimed"),
                    F.when(F.col("gold") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)).alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("claimed"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    if labels is not None:
        spine = df.sparkSession.createDataFrame([(x,) for x in labels], "label string").select(
            "label",
            F.lit(0).cast("long").alias("support"),
            F.lit(0).cast("long").alias("claimed"),
            F.lit(0).cast("long").alias("hits"),
        )
        sides = sides.filter(F.col("label").isin(*labels)).unionByName(spine)
    totals = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits")
    )
    return totals.select(
        "label",
        ratio(F.col("hits"), F.col("claimed")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("claimed") + F.col("support")).alias("f1"),
        "support",
    )


def f1_scores(df: DataFrame, gold: str, predicted: str, labels: Sequence[str] | None = None) -> DataFrame:
    report = class_report(df, gold, predicted, labels)
    return report.agg(
        F.avg("f1").alias("macro_f1"),
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.count(F.lit(1)).alias("labels"),
    )


def confusion_long(df: DataFrame, gold: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """One row per (gold, predicted) cell of the given labels, zeros included."""
    cells = [(g, p) for g in labels for p in labels]
    grid = df.sparkSession.createDataFrame(cells, "gold string, predicted string")
    return grid.join(pair_counts(df, gold, predicted), ["gold", "predicted"], "left").na.fill(0, ["n"])


def confusion_matrix(df: DataFrame, gold: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """One row per gold label and a column ``PRED_<label>`` per predicted label."""
    cells = pair_counts(df, gold, predicted)
    spine = df.sparkSession.createDataFrame([(x,) for x in labels], "gold string")
    sums = [
        F.coalesce(F.sum(F.when(F.col("predicted") == x, F.col("n"))), F.lit(0)).alias(f"PRED_{x}")
        for x in labels
    ]
    return spine.join(cells, "gold", "left").groupBy("gold").agg(*sums)


# --- decisions -------------------------------------------------------------------------------------


def decision_crosstab(predictions: DataFrame) -> DataFrame:
    correct, escalated = F.col("intent_correct"), F.col("should_escalate")
    return predictions.agg(
        F.count_if(correct & ~escalated).alias("correct_auto"),
        F.count_if(~correct & ~escalated).alias("wrong_auto"),
        F.count_if(correct & escalated).alias("correct_escalated"),
        F.count_if(~correct & escalated).alias("wrong_escalated"),
        F.count_if(~escalated & (F.col("reply") == lex.GROUNDED_WEAK_TYPE)).alias("auto_with_fallback"),
    )


def safety(predictions: DataFrame) -> DataFrame:
    auto = ~F.col("should_escalate")
    counts = predictions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(auto).alias("auto_handled"),
        F.count_if(~auto).alias("escalated"),
        F.count_if(auto & F.col("intent_correct")).alias("correct_auto"),
        F.count_if(F.col("evidence_available")).alias("evidence_available"),
        F.count_if(F.col("evidence_selected")).alias("evidence_selected"),
    )
    return counts.select(
        "*",
        ratio(F.col("auto_handled"), F.col("total")).alias("auto_rate"),
        ratio(F.col("escalated"), F.col("total")).alias("escalation_rate"),
        ratio(F.col("correct_auto"), F.col("auto_handled")).alias("safety_proxy"),
    )


def similarity_coverage(
    predictions: DataFrame,
    thresholds: Sequence[float] = (0.20, 0.30, 0.40, 0.50),
    similarity: str = "selected_similarity",
    selected_only: bool = False,
) -> DataFrame:
    """Rows at or above each threshold, mean and median; over all rows or only those with
    selected evidence."""
    rows = predictions.filter("evidence_selected") if selected_only else predictions
    # thresholds and mean on the values as they are; only the median goes by levels of six decimals
    counts = [f"at_least_{round(t * 100):02d}" for t in thresholds]
    levels = rows.groupBy(F.round(similarity, 6).alias("s")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(similarity).alias("total_similarity"),
        *[F.count_if(F.col(similarity) >= t).alias(c) for t, c in zip(thresholds, counts)],
    )
    return running_levels(levels, "s").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        (F.sum("total_similarity") / F.sum(F.when(F.col("s").isNotNull(), F.col("n")))).alias("mean_similarity"),
        median_of("s").alias("median_similarity"),
    )


def reply_quality(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Replies present, texts with internal wording or artefacts, mean and median length."""
    marked = df.select(
        F.coalesce(F.col(reply), F.lit("")).alias("r"),
    ).select(
        F.length("r").alias("chars"),
        (tx.strip(F.col("r")) != "").alias("present"),
        tx.matches_any(F.col("r"), lex.INTERNAL_PATTERNS).alias("internal"),
        tx.matches_any(F.col("r"), lex.ARTIFACT_PATTERNS).alias("artifact"),
    )
    levels = marked.groupBy("chars").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("present").alias("present"),
        F.count_if("internal").alias("internal"),
        F.count_if("artifact").alias("artifact"),
    )
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return running_levels(levels, "chars").agg(
        rows.alias("rows"),
        F.coalesce(F.sum("present"), F.lit(0)).alias("replies"),
        F.coalesce(F.sum("internal"), F.lit(0)).alias("internal_leakage"),
        F.coalesce(F.sum("artifact"), F.lit(0)).alias("artifact_leakage"),
        ratio(F.sum("internal"), rows).alias("internal_rate"),
        ratio(F.sum("artifact"), rows).alias("artifact_rate"),
        (F.sum(F.col("chars") * F.col("n")) / F.sum("n")).alias("mean_length"),
        median_of("chars").alias("median_length"),
    )


def risky_auto(predictions: DataFrame) -> DataFrame:
    return predictions.filter(~F.col("should_escalate") & ~F.col("intent_correct"))


# --- evidence benchmark --------------------------------------------------------------------------------

JUDGEMENTS = ["relevant", "actionable", "safe_to_ground"]


def normalise_judgements(df: DataFrame, columns: Sequence[str] = JUDGEMENTS) -> DataFrame:
    return df.withColumns({c: F.upper(tx.strip(F.col(c).cast("string"))) for c in columns})


def annotation_check(
    df: DataFrame, columns: Sequence[str] = JUDGEMENTS, allowed: Sequence[str] = ("YES", "NO")
) -> DataFrame:
    """One row per judged column: valid and invalid rows. The caller decides whether to stop."""
    clean = normalise_judgements(df, columns)
    good = [F.count_if(F.coalesce(F.col(c).isin(*allowed), F.lit(False))).alias(c) for c in columns]
    counts = clean.agg(F.count(F.lit(1)).alias("rows"), *good)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("valid")) for c in columns]))
    return counts.select("rows", rows.alias("x")).select(
        F.col("x.column").alias("column"),
        F.col("x.valid").alias("valid"),
        (F.col("rows") - F.col("x.valid")).alias("invalid"),
    )


def case_summary(evidence: DataFrame) -> DataFrame:
    """Per case the rank-1 values and whether any rank was judged YES, in one aggregate."""
    clean = normalise_judgements(evidence)
    first = ["gold_intent", "customer_text"]
    return clean.groupBy("case_id").agg(
        *[F.min_by(c, "rank").alias(c) for c in first],
        F.min_by("similarity", "rank").alias("top1_similarity"),
        *[F.min_by(c, "rank").alias(f"top1_{c}") for c in JUDGEMENTS],
        *[F.bool_or(F.coalesce(F.col(c) == "YES", F.lit(False))).alias(f"any_{c}") for c in JUDGEMENTS],
    )


def evidence_rates(evidence: DataFrame) -> DataFrame:
    """judgement, top1, top3 (any of the ranks) and the gain between them."""
    clean = normalise_judgements(evidence)
    per_case = clean.groupBy("case_id").agg(
        *[
            F.max(F.when((F.col("rank") == 1), (F.col(c) == "YES").cast("int"))).alias(f"one_{c}")
            for c in JUDGEMENTS
        ],
        *[F.max((F.col(c) == "YES").cast("int")).alias(f"any_{c}") for c in JUDGEMENTS],
    )
    rates = per_case.agg(
        *[F.avg(F.coalesce(F.col(f"one_{c}"), F.lit(0)).cast("double")).alias(f"one_{c}") for c in JUDGEMENTS],
        *[F.avg(F.coalesce(F.col(f"any_{c}"), F.lit(0)).cast("double")).alias(f"any_{c}") for c in JUDGEMENTS],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("judgement"),
                    F.col(f"one_{c}").alias("top1"),
                    F.col(f"any_{c}").alias("top3"),
                    (F.col(f"any_{c}") - F.col(f"one_{c}")).alias("gain"),
                )
                for c in JUDGEMENTS
            ]
        )
    )
    return rates.select(rows.alias("x")).select("x.*")


def weak_first_hits(evidence: DataFrame, below: float = 0.20) -> DataFrame:
    return evidence.filter((F.col("rank") == 1) & (F.col("similarity") < below))


def similar_but_irrelevant(evidence: DataFrame, at_least: float = 0.30, n: int = 20) -> DataFrame:
    """The n most similar evidence rows judged irrelevant: a report, hence the limit."""
    return (
        normalise_judgements(evidence)
        .filter((F.col("relevant") == "NO") & (F.col("similarity") >= at_least))
        .orderBy(F.col("similarity").desc(), "case_id", "rank")
        .limit(n)
    )


# --- agreement of two raters ----------------------------------------------------------------------------


def join_raters(
    judge: DataFrame, human: DataFrame, id_col: str, dimensions: Sequence[str]
) -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """Cases that both tables rate, with ``judge_x`` and ``human_x`` per dimension, and the pairs
    that ``agreement`` takes. Each table has one row per case."""
    sides = [
        df.select(id_col, *[F.col(d).alias(f"{name}_{d}") for d in dimensions])
        for name, df in (("judge", judge), ("human", human))
    ]
    return sides[0].join(sides[1], id_col), {d: (f"judge_{d}", f"human_{d}") for d in dimensions}


def agreement(df: DataFrame, pairs: Mapping[str, tuple[str, str]], weights: str | None = None) -> DataFrame:
    """dimension, n, exact_agreement, kappa for each named pair of rater columns.

    Rows where a rater is missing are left out per dimension. Text ratings are compared after
    trim and upper. ``weights="quadratic"`` weighs a disagreement by the squared distance of
    the two positions in the sorted list of ratings that occur (not by the rating itself).
    Kappa is null when chance agreement is complete.
    """
    types = dict(df.dtypes)

    def rating(name: str) -> Column:
        if types[name] == "string":
            return F.upper(tx.strip(F.col(name)))
        whole = F.col(name).cast("long")
        return F.when(whole.isNotNull(), F.format_string("%012d", whole))

    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(d).alias("dimension"), rating(a).alias("a"), rating(b).alias("b"))
                    for d, (a, b) in pairs.items()
                ]
            )
        ).alias("x")
    ).select("x.*")
    cells = (
        long.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("dimension", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # from here on: at most (number of ratings)^2 rows per dimension
    seen = cells.select("dimension", F.explode(F.array("a", "b")).alias("label")).distinct()
    places = seen.withColumn("place", F.row_number().over(Window.partitionBy("dimension").orderBy("label")))
    rows_a = cells.groupBy("dimension", F.col("a").alias("label")).agg(F.sum("n").alias("n_a"))
    rows_b = cells.groupBy("dimension", F.col("b").alias("label")).agg(F.sum("n").alias("n_b"))
    margins = (
        places.join(rows_a, ["dimension", "label"], "left")
        .join(rows_b, ["dimension", "label"], "left")
        .na.fill(0, ["n_a", "n_b"])
    )

    def distance(x: Column, y: Column) -> Column:
        if weights == "quadratic":
            return ((x - y) * (x - y)).cast("double")
        return (x != y).cast("double")

    pa = places.select("dimension", F.col("label").alias("a"), F.col("place").alias("pa"))
    pb = places.select("dimension", F.col("label").alias("b"), F.col("place").alias("pb"))
    observed = (
        cells.join(pa, ["dimension", "a"])
        .join(pb, ["dimension", "b"])
        .groupBy("dimension")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"),
            F.sum(F.col("n") * distance(F.col("pa"), F.col("pb"))).alias("seen_distance"),
        )
    )
    # sum over all label pairs of margin products, from moments of the two margins
    if weights == "quadratic":
        p = F.col("place").cast("double")
        expected = margins.groupBy("dimension").agg(
            F.sum("n_a").alias("ta"),
            F.sum("n_b").alias("tb"),
            F.sum(F.col("n_a") * p).alias("a1"),
            F.sum(F.col("n_b") * p).alias("b1"),
            F.sum(F.col("n_a") * p * p).alias("a2"),
            F.sum(F.col("n_b") * p * p).alias("b2"),
        ).select(
            "dimension",
            (F.col("a2") * F.col("tb") - 2 * F.col("a1") * F.col("b1") + F.col("b2") * F.col("ta")).alias("chance"),
        )
    else:
        expected = margins.groupBy("dimension").agg(
            (F.sum("n_a") * F.sum("n_b") - F.sum(F.col("n_a") * F.col("n_b"))).cast("double").alias("chance")
        )
    total = F.col("n").cast("double")
    return observed.join(expected, "dimension").select(
        "dimension",
        "n",
        (F.col("same") / total).alias("exact_agreement"),
        F.when(
            F.col("chance") > 0, 1 - F.col("seen_distance") * total / F.col("chance")
        ).alias("kappa"),
    )
