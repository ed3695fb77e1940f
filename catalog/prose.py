"""Parameters for the registered queries.

The given tables hold invented prose, so the support vocabulary hardly occurs in them. These
rule tables are made of letter groups that do occur, one policy of the same shape.
"""

from __future__ import annotations

from dataclasses import replace

from deskloom.functions.policy import Policy
from deskloom.functions.rules import ResponseRules, Rule, RuleSet, ScoredSet
from deskloom.operators.tfidf import TfidfSpec

BRAND = "assistant"

INTENT_PHRASES = {
    "I10": ["pfpf", "ciónci", "éleeux"],
    "I06": ["tionst", "stau", "ñoci"],
    "I09": ["reouer", "ungung", "aiai"],
    "I08": ["blewh", "lich ver", "losdo"],
    "I07": ["hanre", "ntwh", "schsch"],
    "I01": ["eash", "thanha", "ereau"],
    "I02": ["ingst", "ndha", "eiten"],
    "I04": ["lyre", "hethe", "raque"],
    "I03": ["shwh", "ererti", "keit"],
    "I05": ["ouhe", "atand", "ción"],
    "I11": ["estan", "ation", "eaux"],
}
COMPOUND = (["the ", "der "], ["wh", "zu"], ["hash", "ingan", "schver"])
VAGUE = ["of the", "and", "is a the", "in nicht ü einachie."]

RULES = RuleSet(
    name="prose",
    rules=(
        Rule("I12", exact=VAGUE, max_words=4),
        *[Rule(label, any_of=INTENT_PHRASES[label]) for label in ("I10", "I06", "I09", "I08", "I07", "I01")],
        Rule("I01", all_of=COMPOUND),
        *[Rule(label, any_of=INTENT_PHRASES[label]) for label in ("I02", "I04", "I03", "I05", "I11")],
    ),
    default="I12",
)
PLAIN_RULES = RULES.reordered("prose_plain", ["I10", "I06", "I09", "I08", "I07", "I04", "I01", "I03", "I02", "I05", "I11"])

SCORED = ScoredSet(
    name="prose_scored",
    weights={
        "I10": (INTENT_PHRASES["I10"], 5),
        "I09": (INTENT_PHRASES["I09"], 5),
        "I08": (INTENT_PHRASES["I08"], 4),
        "I07": (INTENT_PHRASES["I07"], 4),
        "I06": (INTENT_PHRASES["I06"], 4),
        "I05": (INTENT_PHRASES["I05"], 3),
        "I04": (INTENT_PHRASES["I04"], 3),
        "I03": (INTENT_PHRASES["I03"], 3),
        "I02": (INTENT_PHRASES["I02"], 3),
        "I01": (INTENT_PHRASES["I01"], 4),
        "I11": (INTENT_PHRASES["I11"], 2),
    },
    default="I12",
)
LABELS = sorted([*INTENT_PHRASES, "I12"])

LANGUAGE_RULES = RuleSet(
    name="language",
    rules=(
        Rule("de", any_of=["sch", "ung", "ß"]),
        Rule("es", any_of=["ción", "ñ", " los "]),
        Rule("fr", any_of=["eux", "ê", "ç"]),
        Rule("en", any_of=["wh", "ly ", "the "]),
    ),
    default="other",
)
LANGUAGES = ["de", "en", "es", "fr", "other"]

RESPONSES = ResponseRules(
    escalation=["schie", "ouhe", "blest"],
    question="ê",
    troubleshooting=["ingth", "tionth", "ungen"],
    account_action=["ered", "lich", "ento"],
)

SYNONYMS = [("the ", "th "), ("der ", "th "), ("tion", "cion"), ("wh", "th "), ("sch", "sh")]

SIGNALS = {
    "internet_outage": ["ea", "eau"],
    "internet_slow": ["ing", "heit"],
    "internet_disconnect": ["nd", "keit"],
    "router": ["sh", "er"],
    "tv_general": ["ly", "re"],
    "tv_content": ["he", "qu"],
    "app_outage": ["cionst", "stau"],
    "app_login": ["cionth", "ven"],
    "app_general": ["cion", "st"],
    "mobile_service": ["ou", "at"],
    "billing": ["an", "nt"],
    "technician": ["bl", "li"],
    "voicemail": ["ai", "un"],
    "landline": ["er", "re"],
    "fraud": ["pf", "ci"],
    "complaint": ["st", "au"],
}

INTENT_TEXT = {label: f"intent {label}" for label in LABELS}

POLICY = replace(
    Policy(),
    name="prose",
    rules=RULES,
    responses=RESPONSES,
    signals=SIGNALS,
    synonyms=SYNONYMS,
)

STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "as", "be", "with",
    "by", "this", "are", "de", "en", "la", "que", "le", "les", "des", "un", "et", "der", "die",
    "und", "das", "zu", "den", "von", "ein", "el", "los",
]
SPEC = TfidfSpec(stop_words=STOP_WORDS)
GLOBAL_SPEC = replace(SPEC, max_features=100_000)
KNN_SPEC = replace(GLOBAL_SPEC, profile="weak_label")
QUOTAS = {label: 5 + 3 * (place % 4) for place, label in enumerate(LABELS)}
