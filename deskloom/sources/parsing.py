"""Semi-structured text to columns: annotated case lines, judge answers, judge prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions import lexicon as lex
from deskloom.functions import text as tx

CASE_ID = r"^\s*([A-Z]+-\d+)\s+"
INTENT_CODE = r"\bI(?:0[1-9]|1[0-2])\b"


def parse_case_lines(
    lines: DataFrame, value: str = "value", case_id: str = CASE_ID, code: str = INTENT_CODE
) -> DataFrame:
    """``<case id> <message> <intent code> <reply>`` lines to columns.

    The first code after the id splits message and reply. Lines without both parts keep null
    fields and ``parsed`` false, so nothing is lost; filter on it for the rejects.
    """
    line = F.regexp_replace(F.col(value), tx.SPACE + "+$", "")
    shaped = lines.withColumn("case_id", F.nullif(F.regexp_extract(line, case_id, 1), F.lit(""))).withColumn(
        "__rest", F.regexp_replace(line, case_id, "")
    )
    label = F.nullif(F.regexp_extract(F.col("__rest"), f"({code})", 1), F.lit(""))
    shaped = shaped.withColumn("prelabel_intent", label)
    # RE "(?s)^(.*?)CODE(.*)$": shortest text before the first code
    before = tx.strip(F.regexp_extract(F.col("__rest"), f"(?s)^(.*?){code}", 1))
    after = tx.strip(F.regexp_extract(F.col("__rest"), f"(?s)^.*?{code}(.*)$", 1))
    parsed = F.col("case_id").isNotNull() & F.col("prelabel_intent").isNotNull()
    return (
        shaped.withColumn("customer_text", F.when(parsed, before))
        .withColumn("support_reply", F.when(parsed, after))
        .withColumn("parsed", parsed)
        .drop("__rest")
    )


JUDGE_ANSWER = (
    "relevance double, helpfulness double, grounding double, non_hallucination double, "
    "tone double, overall_acceptable string, escalation_appropriate string, reason string"
)
JUDGE_FIELDS = [part.split()[0] for part in JUDGE_ANSWER.split(", ")]


def parse_judge_answers(df: DataFrame, answer: str = "answer") -> DataFrame:
    """A judge's JSON answer to score columns. A row that does not parse keeps null scores and
    the raw answer as its reason."""
    parsed = F.from_json(F.trim(F.col(answer)), JUDGE_ANSWER, {"mode": "PERMISSIVE"})
    out = df.withColumn("__p", parsed)
    bad = F.lit(True)
    for name in JUDGE_FIELDS:
        bad = bad & F.col("__p")[name].isNull()
    cols = [c for c in df.columns if c != answer]
    fields = [F.col("__p")[n].alias(n) for n in JUDGE_FIELDS if n != "reason"]
    reason = F.when(bad, F.concat(F.lit("unparsed: "), F.coalesce(F.col(answer), F.lit("")))).otherwise(
        F.col("__p")["reason"]
    )
    return out.select(*cols, *fields, reason.alias("reason"))


# Own wording of the scoring instructions; pass another one for another rubric.
RUBRIC = "\n".join(
    [
        "Rate the reply from 1 (poor) to 5 (good) on each of: " + ", ".join(lex.SCORE_DIMENSIONS) + ".",
        "overall_acceptable: YES if the reply could be sent as it is, else NO.",
        "escalation_appropriate: YES, NO or UNCLEAR for the decision to involve a person.",
        "Use only what is shown below and answer with one JSON object holding these keys "
        "and a short reason.",
    ]
)
PROMPT_PARTS = [
    ("Customer message", "customer_text"),
    ("Predicted intent", "predicted_intent"),
    ("Escalated", "should_escalate"),
    ("Escalation reason", "escalation_reason"),
    ("Similar past message", "selected_customer"),
    ("Reply given then", "selected_reply"),
    ("Reply proposed now", "reply"),
]


def judge_prompt(rubric: str = RUBRIC) -> Column:
    """One prompt per prediction row; missing parts show as empty."""
    parts = [F.lit(rubric)]
    for title, name in PROMPT_PARTS:
        parts.append(F.concat(F.lit(title + ": "), F.coalesce(F.col(name).cast("string"), F.lit(""))))
    return F.concat_ws("\n", *parts)
