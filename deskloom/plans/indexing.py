"""From a message table to cases and their index."""

from __future__ import annotations

from pyspark.sql import DataFrame

from deskloom.functions.policy import Policy
from deskloom.functions.rules import with_signals
from deskloom.operators.leakage import without_contained
from deskloom.operators.threads import build_cases
from deskloom.operators.tfidf import TfidfIndex, TfidfSpec, build_index
from deskloom.session import cut_lineage


def case_index(
    messages: DataFrame,
    brand: str,
    policy: Policy,
    spec: TfidfSpec,
    held_out: DataFrame | None,
    held_out_text: str = "customer_text",
) -> tuple[DataFrame, TfidfIndex]:
    """(cases, index). ``held_out`` has the texts that are going to be used as evaluation queries:
    cases that are one of them, or hold one of five or more words, are kept out of the index. It has
    no default, so that an index without this guard is asked for in so many words, by None. The cases are written once, with their signals."""
    cases = build_cases(messages, brand, policy)
    if held_out is not None:
        cases = without_contained(cases, held_out, "customer_text", held_out_text)
    cases = cut_lineage(
        with_signals(cases, "customer_text", policy.signals, policy.synonyms, "historical_signals")
    )
    return cases, build_index(cases, spec)
