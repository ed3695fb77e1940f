"""Keyword rules as data, compiled to one CASE WHEN per classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions import lexicon as lex
from deskloom.functions import text as tx
from deskloom.functions.phrases import PhraseBits


@dataclass(frozen=True)
class Rule:
    """One branch. Either any phrase of ``any_of``, or a phrase out of every group of
    ``all_of``, or the whole text equal to one of ``exact`` while at most ``max_words`` long."""

    label: str
    any_of: Sequence[str] = ()
    all_of: Sequence[Sequence[str]] = ()
    exact: Sequence[str] = ()
    max_words: int = 2

    def condition(self, cleaned: Column, match: str = "substring", found: Found | None = None) -> Column:
        """``found`` has the bits of the cleaned text, if its phrases have been looked up already."""

        def any_of(phrases: Sequence[str]) -> Column:
            return found.any_of(phrases) if found else tx.contains_any(cleaned, phrases, match)

        if self.exact:
            return cleaned.isin(*self.exact) & (tx.word_count(cleaned) <= self.max_words)
        if self.all_of:
            hit = F.lit(True)
            for group in self.all_of:
                hit = hit & any_of(group)
            return hit
        return any_of(self.any_of)

    def phrases(self) -> list[str]:
        return [*self.any_of, *(p for group in self.all_of for p in group)]


@dataclass(frozen=True)
class Found:
    """A vocabulary and the column with the bits of a text."""

    vocabulary: PhraseBits
    bits: Column

    def any_of(self, phrases: Sequence[str]) -> Column:
        return self.vocabulary.any_of(self.bits, phrases)

    def count(self, phrases: Sequence[str]) -> Column:
        return self.vocabulary.count(self.bits, phrases)


@dataclass(frozen=True)
class RuleSet:
    """Ordered rules: the first that applies gives the label."""

    name: str
    rules: Sequence[Rule]
    default: str
    profile: str = "message"
    match: str = "substring"

    def label(self, cleaned: Column, found: Found | None = None) -> Column:
        branch = None
        for rule in self.rules:
            hit = rule.condition(cleaned, self.match, found)
            branch = F.when(hit, F.lit(rule.label)) if branch is None else branch.when(hit, F.lit(rule.label))
        return F.lit(self.default) if branch is None else branch.otherwise(F.lit(self.default))

    def labels(self) -> list[str]:
        return sorted({r.label for r in self.rules} | {self.default})

    def reordered(self, name: str, labels: Sequence[str]) -> RuleSet:
        """Same phrases, another order of precedence; compound rules are dropped if their
        label's phrases come later than the list says."""
        by_label: dict[str, list[Rule]] = {}
        for rule in self.rules:
            by_label.setdefault(rule.label, []).append(rule)
        ordered = [r for r in self.rules if r.exact]
        for label in labels:
            ordered += [r for r in by_label.get(label, []) if not r.exact and not r.all_of]
        return replace(self, name=name, rules=tuple(ordered))


@dataclass(frozen=True)
class ScoredSet:
    """Weighted hits per label; ties go to the earlier label, all zero to ``default``."""

    name: str
    weights: Mapping[str, tuple[Sequence[str], int]]  # in tie order
    default: str
    profile: str = "lower"

    def scores(self, cleaned: Column, found: Found | None = None) -> Column:
        def hits(phrases: Sequence[str]) -> Column:
            return found.count(phrases) if found else tx.phrase_hits(cleaned, phrases)

        return F.array(*[hits(p) * F.lit(w) for p, w in self.weights.values()])

    def label(self, scores: Column) -> Column:
        names = F.array(*[F.lit(n) for n in self.weights])
        best = F.array_max(scores)
        return F.when(best == 0, F.lit(self.default)).otherwise(
            F.element_at(names, F.array_position(scores, best).cast("int"))
        )


def classify(df: DataFrame, rules: RuleSet, text_col: str, out: str = "intent") -> DataFrame:
    """First-match classification. The cleaned text is its own projection, so the many
    phrase tests share one evaluation of the regular expressions."""
    tmp = "__cleaned"
    return (
        df.withColumn(tmp, tx.clean(F.col(text_col), rules.profile))
        .withColumn(out, rules.label(F.col(tmp)))
        .drop(tmp)
    )


def classify_by_score(
    df: DataFrame, scored: ScoredSet, text_col: str, out: str = "intent", score_out: str = "score"
) -> DataFrame:
    cleaned, scores = "__cleaned", "__scores"
    return (
        df.withColumn(cleaned, tx.clean(F.col(text_col), scored.profile))
        .withColumn(scores, scored.scores(F.col(cleaned)))
        .withColumn(out, scored.label(F.col(scores)))
        .withColumn(score_out, F.array_max(F.col(scores)))
        .drop(cleaned, scores)
    )


def classify_in_one_pass(
    df: DataFrame, text_col: str, rule_sets: Mapping[str, RuleSet], scored: Mapping[str, ScoredSet] = MappingProxyType({})
) -> DataFrame:
    """Any number of rule sets and scored sets over one column: ``rule_sets`` and ``scored`` name the
    labels they make; a scored set also makes ``<name>_score``. Every cleaning profile is applied
    once and every cleaned text is read once, however many sets and phrases there are."""
    by_profile: dict[str, list[str]] = {}
    for rules in rule_sets.values():
        if rules.match != "substring":
            raise ValueError(f"rule set {rules.name!r} asks for whole words; use classify")
        by_profile.setdefault(rules.profile, []).extend(p for r in rules.rules for p in r.phrases())
    for sets in scored.values():
        by_profile.setdefault(sets.profile, []).extend(p for phrases, _ in sets.weights.values() for p in phrases)
    out, found = df, {}
    for i, (profile, phrases) in enumerate(by_profile.items()):
        vocabulary = PhraseBits(phrases)
        out = out.withColumn(f"__cleaned{i}", tx.clean(F.col(text_col), profile))
        out = out.withColumn(f"__bits{i}", vocabulary.of(F.col(f"__cleaned{i}")))
        found[profile] = F.col(f"__cleaned{i}"), Found(vocabulary, F.col(f"__bits{i}"))
    for name, rules in rule_sets.items():
        out = out.withColumn(name, rules.label(*found[rules.profile]))
    for name, sets in scored.items():
        out = out.withColumn("__scores", sets.scores(*found[sets.profile]))
        out = out.withColumn(name, sets.label(F.col("__scores"))).withColumn(f"{name}_score", F.array_max("__scores"))
    return out.drop("__scores", *[f"__{c}{i}" for i in range(len(by_profile)) for c in ("cleaned", "bits")])


# --- replies ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class ResponseRules:
    escalation: Sequence[str] = field(default_factory=lambda: lex.REPLY_ESCALATION)
    question: str = lex.REPLY_QUESTION
    troubleshooting: Sequence[str] = field(default_factory=lambda: lex.REPLY_TROUBLESHOOTING)
    account_action: Sequence[str] = field(default_factory=lambda: lex.REPLY_ACCOUNT)
    min_words: int = 5

    def response_type(self, raw: Column, cleaned: Column) -> Column:
        """``cleaned`` is the "index" profile of ``raw``; the question mark is looked for in
        the raw reply because cleaning removes it."""
        return (
            F.when(tx.contains_any(cleaned, self.escalation), F.lit("escalation"))
            .when(F.coalesce(raw, F.lit("")).contains(self.question), F.lit("clarification"))
            .when(tx.contains_any(cleaned, self.troubleshooting), F.lit("troubleshooting"))
            .when(tx.contains_any(cleaned, self.account_action), F.lit("account_action"))
            .when(tx.word_count(cleaned) < self.min_words, F.lit("generic"))
            .otherwise(F.lit("unknown"))
        )


def with_response_type(
    df: DataFrame, rules: ResponseRules, reply_col: str, out: str = "response_type"
) -> DataFrame:
    tmp = "__cleaned"
    return (
        df.withColumn(tmp, tx.clean(F.col(reply_col), "index"))
        .withColumn(out, rules.response_type(F.col(reply_col), F.col(tmp)))
        .drop(tmp)
    )


# --- problem signals and the consistency gate ------------------------------------------------------


def with_signals(
    df: DataFrame,
    text_col: str,
    signals: Mapping[str, Sequence[str]],
    synonyms: Sequence[tuple[str, str]],
    out: str = "signals",
    one_pass: bool = False,
) -> DataFrame:
    """Sorted array of the signals whose phrases occur in the synonym-normalised text. ``one_pass``
    looks all phrases up at once, which pays for large vocabularies."""
    tmp, bits = "__normalised", "__bits"
    df = df.withColumn(tmp, tx.replace_in_order(F.col(text_col), synonyms))
    if one_pass:
        vocabulary = PhraseBits(*signals.values())
        df = df.withColumn(bits, vocabulary.of(F.col(tmp)))
        shows = Found(vocabulary, F.col(bits)).any_of
    else:
        shows = lambda phrases: tx.contains_any(F.col(tmp), phrases)
    found = [F.when(shows(phrases), F.lit(name)) for name, phrases in sorted(signals.items())]
    return df.withColumn(out, F.array_compact(F.array(*found))).drop(tmp, bits)


@dataclass(frozen=True)
class GateStep:
    """If the current message shows these signals, the historical one must show those."""

    current_any: Sequence[str] = ()
    historical_any: Sequence[str] = ()
    current_all: Sequence[str] = ()
    historical_all: Sequence[str] = ()


def _shows(signals: Column, any_of: Sequence[str], all_of: Sequence[str]) -> Column:
    hit = F.lit(True)
    if any_of:
        hit = F.arrays_overlap(signals, F.array(*[F.lit(s) for s in any_of]))
    for name in all_of:
        hit = hit & F.array_contains(signals, name)
    return hit


def consistent(
    gate: Mapping[str, Sequence[GateStep]], intent: Column, current: Column, historical: Column
) -> Column:
    """Per intent the first step whose current side applies decides; no step, no consistency."""
    verdict = None
    for label, steps in gate.items():
        decision = None
        for step in steps:
            applies = _shows(current, step.current_any, step.current_all)
            answer = _shows(historical, step.historical_any, step.historical_all)
            decision = F.when(applies, answer) if decision is None else decision.when(applies, answer)
        decision = F.lit(False) if decision is None else decision.otherwise(F.lit(False))
        verdict = F.when(intent == label, decision) if verdict is None else verdict.when(intent == label, decision)
    verdict = F.lit(False) if verdict is None else verdict.otherwise(F.lit(False))
    return (F.size(current) > 0) & (F.size(historical) > 0) & F.coalesce(verdict, F.lit(False))


# --- rule tables ---------------------------------------------------------------------------------------

MAX_RULE_ROWS = 20_000


def rule_set_from_table(
    rows: DataFrame, name: str, default: str, profile: str = "message", match: str = "substring"
) -> RuleSet:
    """Build a rule set from ``(rule_set, priority, label, group_no, phrase)`` rows.

    ``group_no`` null: any phrase of the priority decides; otherwise one phrase per group is
    needed. With a column ``max_words``, a phrase where it is set decides if it is the whole text
    and the text has at most so many words. The table is a parameter, not data: more than MAX_RULE_ROWS rows are refused.
    """
    most = F.col("max_words") if "max_words" in rows.columns else F.lit(None).cast("int")
    picked = rows.filter(F.col("rule_set") == name).select(
        "priority", "label", "group_no", "phrase", most.alias("max_words")
    )
    found = picked.limit(MAX_RULE_ROWS + 1).collect()
    if len(found) > MAX_RULE_ROWS:
        raise ValueError(f"rule set {name!r} has more than {MAX_RULE_ROWS} rows")
    if not found:
        raise ValueError(f"rule set {name!r} is empty")
    by_rule: dict[tuple[int, str], dict[int | None, list[str]]] = {}
    whole: dict[tuple[int, str], list[tuple[int, str]]] = {}
    for r in found:
        if r.max_words is not None:
            by_rule.setdefault((r.priority, r.label), {})
            whole.setdefault((r.priority, r.label), []).append((r.max_words, r.phrase))
            continue
        by_rule.setdefault((r.priority, r.label), {}).setdefault(r.group_no, []).append(r.phrase)
    rules = []
    for (priority, label), groups in sorted(by_rule.items()):
        exact = whole.get((priority, label), [])
        for words in sorted({w for w, _ in exact}):
            rules.append(Rule(label, exact=sorted(p for w, p in exact if w == words), max_words=words))
        plain = groups.pop(None, [])
        if plain:
            rules.append(Rule(label, any_of=sorted(plain)))
        if groups:
            rules.append(Rule(label, all_of=[sorted(p) for _, p in sorted(groups.items())]))
    return RuleSet(name, tuple(rules), default, profile, match)


def scored_set_from_table(rows: DataFrame, name: str, default: str, profile: str = "lower") -> ScoredSet:
    """Build a scored set from ``(rule_set, priority, label, phrase, weight)`` rows; ``priority``
    is the order in which ties are resolved and ``weight`` belongs to the label."""
    picked = rows.filter(F.col("rule_set") == name).select("priority", "label", "phrase", "weight")
    found = picked.limit(MAX_RULE_ROWS + 1).collect()
    if len(found) > MAX_RULE_ROWS:
        raise ValueError(f"rule set {name!r} has more than {MAX_RULE_ROWS} rows")
    if not found:
        raise ValueError(f"rule set {name!r} is empty")
    weights: dict[str, tuple[list[str], int]] = {}
    for r in sorted(found, key=lambda r: (r.priority, r.label, r.phrase)):
        weights.setdefault(r.label, ([], r.weight))[0].append(r.phrase)
    return ScoredSet(name, weights, default, profile)


def unreachable_phrases(rules: RuleSet) -> list[tuple[str, str]]:
    """Phrases that the cleaning profile can never leave in a text (for instance an
    apostrophe under the "index" profile). Returns (label, phrase) pairs."""
    dead = []
    for rule in rules.rules:
        for phrase in [*rule.any_of, *(p for g in rule.all_of for p in g), *rule.exact]:
            bare = phrase.replace(" ", "")
            if rules.profile == "index" and not (bare.isascii() and bare.isalnum()):
                dead.append((rule.label, phrase))
            elif phrase != phrase.lower():
                dead.append((rule.label, phrase))
    return dead
