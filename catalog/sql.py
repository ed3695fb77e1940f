"""SQL text for cross-checks: the same definitions written for an ANSI engine with RE2."""

from __future__ import annotations

from catalog import prose
from deskloom.functions import lexicon as lex

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NON_SPACE = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(items) -> str:
    return ", ".join(q(x) for x in items)


def sub(expr: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(to)}, 'g')"


def clean(expr: str, profile: str) -> str:
    e = f"coalesce({expr}, '')"
    url, loose, handle = f"https?://{NON_SPACE}+", f"http{NON_SPACE}+", f"@{WORD}+"
    if profile == "message":
        return f"lower(trim({sub(sub(sub(e, loose), handle), SPACE + '+')}))"
    if profile == "weak_label":
        return f"trim({sub(sub(sub(f'lower({e})', url), handle), SPACE + '+')})"
    if profile == "index":
        kept = sub(sub(sub(f"lower({e})", url), handle), r"[^a-z0-9\s\x0b\x1c-\x1f\x{85}\p{Z}]")
        return f"trim({sub(kept, SPACE + '+')})"
    if profile == "cluster":
        x = sub(sub(sub(e, url), handle), f"#({WORD}+)", r"\1")
        return f"lower(trim({sub(sub(x, f'&{WORD}+;'), SPACE + '+')}))"
    if profile == "squeeze":
        return f"trim({sub(e, SPACE + '+')})"
    if profile == "prelabel":
        return sub(sub(f"lower({e})", loose), handle)
    if profile == "lower":
        return f"lower({e})"
    raise ValueError(profile)


def strip(expr: str) -> str:
    return sub(expr, f"^{SPACE}+|{SPACE}+$", "")


def word_count(cleaned: str) -> str:
    return f"(case when {cleaned} = '' then 0 else len(string_split({cleaned}, ' ')) end)"


def any_of(expr: str, phrases) -> str:
    return "(" + " or ".join(f"contains({expr}, {q(p)})" for p in phrases) + ")"


def label_case(rules, expr: str) -> str:
    """CASE over a column that already holds the cleaned text."""
    out = "case"
    for rule in rules.rules:
        if rule.exact:
            hit = f"({word_count(expr)} <= {rule.max_words} and {expr} in ({words(rule.exact)}))"
        elif rule.all_of:
            hit = "(" + " and ".join(any_of(expr, g) for g in rule.all_of) + ")"
        else:
            hit = any_of(expr, rule.any_of)
        out += f" when {hit} then {q(rule.label)}"
    return out + f" else {q(rules.default)} end"


def hits(expr: str, phrases) -> str:
    return "(" + " + ".join(f"cast(contains({expr}, {q(p)}) as int)" for p in phrases) + ")"


def score_case(scored, expr: str) -> tuple[str, str]:
    scores = [f"{hits(expr, p)} * {w}" for p, w in scored.weights.values()]
    best = f"greatest({', '.join(scores)})"
    out = f"case when {best} = 0 then {q(scored.default)}"
    for (label, _), score in zip(scored.weights.items(), scores):
        out += f" when {score} = {best} then {q(label)}"
    return out + " end", best


def response_case(rules, raw: str, cleaned: str) -> str:
    return (
        f"case when {any_of(cleaned, rules.escalation)} then 'escalation'"
        f" when contains({raw}, {q(rules.question)}) then 'clarification'"
        f" when {any_of(cleaned, rules.troubleshooting)} then 'troubleshooting'"
        f" when {any_of(cleaned, rules.account_action)} then 'account_action'"
        f" when {word_count(cleaned)} < {rules.min_words} then 'generic' else 'unknown' end"
    )


def synonyms(expr: str, pairs) -> str:
    out = f"lower(coalesce({expr}, ''))"
    for old, new in pairs:
        if old != new:
            out = f"replace({out}, {q(old)}, {q(new)})"
    return out


def signal_list(expr: str, signals) -> str:
    """Over a column that already holds the synonym-normalised text."""
    parts = [f"case when {any_of(expr, p)} then {q(n)} end" for n, p in sorted(signals.items())]
    return f"list_filter([{', '.join(parts)}], lambda x: x is not null)"


def _shows(col: str, any_of_: list, all_of: list) -> str:
    parts = []
    if any_of_:
        parts.append(f"list_has_any({col}, [{words(any_of_)}])")
    if all_of:
        parts.append(f"list_has_all({col}, [{words(all_of)}])")
    return "(" + " and ".join(parts or ["true"]) + ")"


def gate_case(gate, intent: str, current: str, historical: str) -> str:
    out = f"case when len({current}) = 0 or len({historical}) = 0 then false"
    for label, steps in gate.items():
        for step in steps:
            applies = _shows(current, step.current_any, step.current_all)
            answer = _shows(historical, step.historical_any, step.historical_all)
            out += f" when {intent} = {q(label)} and {applies} then {answer}"
    return out + " else false end"


# --- tables -----------------------------------------------------------------------------------------

MESSAGES = """messages as (
  select conv_id || '-' || turn as message_id, role as author_id, role <> 'assistant' as inbound,
         turn as created, text,
         case when turn > 0 then conv_id || '-' || (turn - 1) end as parent_id
  from conversations)"""

PAIRS = MESSAGES + f""",
pairs as (
  select r.message_id as reply_id, p.message_id, p.author_id as customer_id,
         {strip('p.text')} as customer_text, {strip('r.text')} as support_reply
  from messages r join messages p on r.parent_id = p.message_id
  where r.author_id = 'assistant' and p.author_id <> 'assistant'
    and r.text is not null and p.text is not null)"""

USEFUL = PAIRS + f""",
cleaned_pairs as (
  select *, {clean('customer_text', 'index')} as c_customer, {clean('support_reply', 'index')} as c_reply from pairs),
useful as (
  select * from cleaned_pairs
  where length(c_customer) >= 20 and {word_count('c_customer')} >= 4 and length(c_reply) >= 5)"""


def cases(policy=prose.POLICY) -> str:
    return USEFUL + f""",
firsts as (
  select * from (select *, row_number() over (partition by customer_text order by reply_id) as rn from useful) where rn = 1),
cases as (
  select reply_id as case_id, message_id, customer_text, support_reply,
         {label_case(policy.rules, 'm')} as intent,
         {response_case(policy.responses, 'support_reply', 'c_reply')} as response_type
  from (select *, {clean('customer_text', policy.rules.profile)} as m from firsts))"""


# --- TF-IDF -------------------------------------------------------------------------------------------


def terms(name: str, source: str, spec) -> str:
    """{name}_terms(part, doc_id, term, tf) from a relation with part, doc_id, text."""
    stop = f"lambda x: x not in ({words(spec.stop_words)})" if spec.stop_words else "lambda x: true"
    grams = "w"
    if spec.n_max == 2:
        grams = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""{name}_words as (
  select part, doc_id, list_filter(regexp_extract_all(lower({clean('text', spec.profile)}), '{WORD}{{2,}}'), {stop}) as w
  from {source}),
{name}_terms as (
  select part, doc_id, term, count(*) as tf
  from (select part, doc_id, unnest({grams}) as term from {name}_words) group by all)"""


def index(name: str, source: str, spec) -> str:
    """{name}_vocab(part, term, df, idf) and {name}_vec(part, doc_id, term, weight)."""
    tf = "(1 + ln(tf))" if spec.sublinear else "tf"
    return terms(name, source, spec) + f""",
{name}_parts as (select part, count(*) as docs from {source} group by part),
{name}_vocab as (
  select part, term, df, ln((1.0 + docs) / (1.0 + df)) + 1 as idf
  from (select part, term, df, docs, row_number() over (partition by part order by total desc, term) as place
        from (select part, term, count(*) as df, sum(tf) as total from {name}_terms group by all) join {name}_parts using (part)
        where df >= {spec.min_df} and df <= floor({spec.max_df} * docs))
  where place <= {spec.max_features}),
{name}_raw as (select part, doc_id, term, {tf} * idf as raw from {name}_terms join {name}_vocab using (part, term)),
{name}_vec as (
  select part, doc_id, term, raw / sqrt(sum(raw * raw) over (partition by part, doc_id)) as weight from {name}_raw)"""


def query_vectors(name: str, source: str, against: str, spec) -> str:
    tf = "(1 + ln(tf))" if spec.sublinear else "tf"
    return terms(name, source, spec) + f""",
{name}_raw as (select part, doc_id, term, {tf} * idf as raw from {name}_terms join {against}_vocab using (part, term)),
{name}_vec as (
  select part, doc_id, term, raw / sqrt(sum(raw * raw) over (partition by part, doc_id)) as weight from {name}_raw)"""


def hits_cte(queries: str, against: str, k: int, out: str = "hits") -> str:
    """{out}(query_id, part, case_id, similarity, rank_no)"""
    return f"""{out}_all as (
  select q.doc_id as query_id, q.part, c.doc_id as case_id, round(sum(q.weight * c.weight), 9) as similarity
  from {queries}_vec q join {against}_vec c using (part, term) group by all),
{out} as (
  select * from (select *, row_number() over (partition by query_id order by similarity desc, case_id) as rank_no from {out}_all)
  where rank_no <= {k})"""


# --- triage ---------------------------------------------------------------------------------------------

QUERIES = f"""queries as (
  select query_id, customer_text, {label_case(prose.RULES, 'm')} as intent, m
  from (select doc_id as query_id, text as customer_text, {clean('text', 'message')} as m from documents))"""


def evidence(policy=prose.POLICY, spec=prose.SPEC) -> str:
    """evidence(query_id, intent, rank_no, similarity, ..., is_consistent, score)"""
    bonus = "case response_type " + " ".join(f"when {q(t)} then {b}" for t, b in policy.bonus.items()) + " else 0 end"
    return (
        cases(policy)
        + ",\n"
        + QUERIES
        + ",\nc_src as (select intent as part, case_id as doc_id, customer_text as text from cases),\n"
        + index("c", "c_src", spec)
        + ",\nq_src as (select intent as part, query_id as doc_id, customer_text as text from queries),\n"
        + query_vectors("q", "q_src", "c", spec)
        + ",\n"
        + hits_cte("q", "c", policy.top_k)
        + f""",
case_signals as (
  select *, {signal_list('n', policy.signals)} as historical_signals
  from (select *, {synonyms('customer_text', policy.synonyms)} as n from cases)),
query_signals as (
  select *, {signal_list('n', policy.signals)} as current_signals
  from (select *, {synonyms('customer_text', policy.synonyms)} as n from queries)),
evidence as (
  select h.query_id, s.intent, h.rank_no, h.similarity, h.case_id, c.customer_text as historical_customer,
         c.support_reply as historical_reply, c.response_type,
         {gate_case(policy.gate, 's.intent', 's.current_signals', 'c.historical_signals')} as is_consistent,
         round(h.similarity + {bonus}, 9) as score
  from hits h join case_signals c using (case_id) join query_signals s using (query_id)),
best as (
  select * from (
    select *, row_number() over (partition by query_id order by score desc, rank_no) as place
    from evidence where similarity >= {policy.min_ground} and is_consistent) where place = 1),
grounding as (
  select * from best where similarity >= {policy.min_auto}
    and (response_type not in ({words(policy.weak_types)}) or similarity >= {policy.min_weak_type})),
best_similarity as (select query_id, max(similarity) as best_similarity, count(*) as evidence_count from evidence group by query_id)"""
    )


def sanitize(expr: str) -> str:
    e = f"coalesce({expr}, '')"
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                         ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]:
        e = f"replace({e}, {q(entity)}, {q(char)})"
    e = f"trim({sub(sub(e, f'https?://{NON_SPACE}+', ''), SPACE + '+')})"
    e = sub(sub(e, f"@{WORD}+", ""), SPACE + r"+\^[A-Za-z]{2,5}" + SPACE + "*$", "")
    return f"trim({sub(e, SPACE + '+')})"


def by_intent(texts: dict, default: str) -> str:
    return "case intent " + " ".join(f"when {q(i)} then {q(t)}" for i, t in texts.items()) + f" else {default} end"


def decisions(policy=prose.POLICY, spec=prose.SPEC) -> str:
    """decided(query_id, customer_text, intent, should_escalate, escalation_reason, reply, draft, g_*...)"""
    always = "case intent " + " ".join(f"when {q(i)} then {q(t)}" for i, t in policy.always_escalate.items()) + " end"
    no_ground = (
        q(lex.REASON_NO_GROUNDING.split("%.3f")[0])
        + " || format('{:.3f}', coalesce(best_similarity, 0.0)) || "
        + q(lex.REASON_NO_GROUNDING.split("%.3f")[1])
    )
    strict = ""
    auto = lex.REASON_AUTO
    if policy.require_actionable:
        auto = lex.REASON_AUTO_STRICT
        strict = f" when g_type not in ({words(policy.actionable_types)}) then {q(lex.REASON_NOT_ACTIONABLE)}"
    return evidence(policy, spec) + f""",
joined as (
  select qq.query_id, qq.customer_text, qq.intent,
         qq.m <> '' and exists (select 1 from c_parts p where p.part = qq.intent) as evidence_available,
         coalesce(b.evidence_count, 0) as evidence_count, coalesce(b.best_similarity, 0.0) as best_similarity,
         g.similarity as g_similarity, g.response_type as g_type, g.historical_customer as g_customer,
         g.historical_reply as g_reply, g.query_id is not null as evidence_selected
  from queries qq left join best_similarity b using (query_id) left join grounding g using (query_id)),
reasoned as (
  select *, coalesce({always},
    case when not evidence_available then {q(lex.REASON_NO_EVIDENCE)}
         when not evidence_selected then {no_ground}{strict} end) as why from joined),
decided as (
  select * exclude (why), why is not null as should_escalate, coalesce(why, {q(auto)}) as escalation_reason,
    case when why is not null then {by_intent(lex.GROUNDED_ESCALATION, q(lex.GROUNDED_DEFAULT))}
         when not evidence_available then {q(lex.GROUNDED_NO_EVIDENCE)}
         when not evidence_selected then {q(lex.GROUNDED_NO_GROUNDING)}
         when {sanitize('g_reply')} = '' then {q(lex.GROUNDED_EMPTY)}
         when g_type in ({words(policy.reusable_types)}) then {sanitize('g_reply')}
         else {q(lex.GROUNDED_WEAK_TYPE)} end as reply,
    case when why is not null then {by_intent(lex.DRAFT_ESCALATION, q(lex.DRAFT_DEFAULT))}
         else coalesce(g_reply, {q(lex.DRAFT_DEFAULT)}) end as draft
  from reasoned)"""


def predictions() -> str:
    """predictions: decided next to the gold label of the scored classifier."""
    label, _ = score_case(prose.SCORED, "m")
    return decisions() + f""",
predictions as (
  select d.query_id as case_id, d.customer_text, g.gold_intent, d.intent as predicted_intent,
         d.intent = g.gold_intent as intent_correct, d.should_escalate, d.escalation_reason, d.reply,
         d.evidence_available, d.evidence_selected, coalesce(d.g_similarity, 0.0) as selected_similarity,
         coalesce(d.g_type, '') as selected_response_type, coalesce(d.g_customer, '') as selected_customer,
         coalesce(d.g_reply, '') as selected_reply
  from decided d join (select doc_id as query_id, {label} as gold_intent from (select doc_id, lower(text) as m from documents)) g
  using (query_id))"""
