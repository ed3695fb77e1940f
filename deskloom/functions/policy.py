"""A policy bundles every vocabulary, threshold and text the triage needs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from deskloom.functions import lexicon as lex
from deskloom.functions.index_rules import INDEX_RULES
from deskloom.functions.rules import GateStep, ResponseRules, Rule, RuleSet

SUPPORT_RULES = RuleSet(
    name="support",
    rules=(
        Rule("I12", exact=lex.VAGUE),
        Rule("I10", any_of=lex.FRAUD),
        Rule("I06", any_of=lex.APP),
        Rule("I09", any_of=lex.VOICE),
        Rule("I08", any_of=lex.INSTALL),
        Rule("I07", any_of=lex.BILLING),
        Rule("I01", any_of=lex.OUTAGE),
        Rule("I01", all_of=(lex.INTERNET_WORDS, lex.TV, lex.FAILURE)),
        Rule("I02", any_of=lex.PERFORMANCE),
        Rule("I04", any_of=lex.TV),
        Rule("I03", any_of=lex.ROUTER),
        Rule("I05", any_of=lex.MOBILE),
        Rule("I11", any_of=lex.COMPLAINT),
    ),
    default="I12",
    profile="message",
)

# Which signals must recur in the historical message. Landline problems have a signal of
# their own but the gate for I09 asks for voicemail, so they are never grounded.
SUPPORT_GATE: dict[str, Sequence[GateStep]] = {
    "I01": [GateStep(["internet_outage"], ["internet_outage"])],
    "I02": [GateStep(["internet_slow", "internet_disconnect"], ["internet_slow", "internet_disconnect"])],
    "I03": [GateStep(["router"], ["router"])],
    "I04": [
        GateStep(current_all=["tv_general", "tv_content"], historical_all=["tv_general", "tv_content"]),
        GateStep(["tv_general"], ["tv_general"]),
    ],
    "I05": [GateStep(["mobile_service"], ["mobile_service"])],
    "I06": [
        GateStep(["app_outage"], ["app_outage"]),
        GateStep(["app_login"], ["app_login"]),
        GateStep(["app_general"], ["app_general", "app_login", "app_outage"]),
    ],
    "I07": [GateStep(["billing"], ["billing"])],
    "I08": [GateStep(["technician"], ["technician"])],
    "I09": [GateStep(["voicemail"], ["voicemail"])],
    "I10": [GateStep(["fraud"], ["fraud"])],
    "I11": [GateStep(["complaint"], ["complaint"])],
}


@dataclass(frozen=True)
class Policy:
    name: str = "support"
    rules: RuleSet = SUPPORT_RULES
    case_rules: RuleSet | None = None  # labels historical cases; None: the same rules
    responses: ResponseRules = field(default_factory=ResponseRules)
    intent_names: Mapping[str, str] = field(default_factory=lambda: lex.INTENT_NAMES)
    signals: Mapping[str, Sequence[str]] = field(default_factory=lambda: lex.SIGNALS)
    synonyms: Sequence[tuple[str, str]] = field(default_factory=lambda: lex.SYNONYMS)
    gate: Mapping[str, Sequence[GateStep]] = field(default_factory=lambda: SUPPORT_GATE)
    # grounding
    top_k: int = 3
    min_ground: float = lex.MIN_GROUND
    min_auto: float = lex.MIN_AUTO
    min_weak_type: float = lex.MIN_WEAK_TYPE
    bonus: Mapping[str, float] = field(default_factory=lambda: lex.BONUS)
    weak_types: Sequence[str] = ("unknown", "generic")
    # escalation
    always_escalate: Mapping[str, str] = field(default_factory=lambda: lex.REASON_BY_INTENT)
    require_actionable: bool = False
    actionable_types: Sequence[str] = ("troubleshooting", "account_action")
    # reuse of an evidence's reply text
    reusable_types: Sequence[str] = ("clarification", "troubleshooting", "account_action")

    def strict(self) -> Policy:
        """Only actionable evidence may be answered automatically."""
        return replace(self, name=self.name + "_strict", require_actionable=True)


SUPPORT = Policy(case_rules=INDEX_RULES)
