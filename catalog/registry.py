"""Every registered query: the Spark callable and, where SQL can say it, its cross-check."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import prose, sql
from deskloom.functions import lexicon as lex
from deskloom.functions import text as tx
from deskloom.functions.index_rules import INDEX_RULES
from deskloom.functions.rules import (
    classify, classify_by_score, classify_in_one_pass, consistent, with_response_type, with_signals,
)
from deskloom.operators import evidence as ev
from deskloom.operators import leakage, learning, metrics, profile, retrieval, review, sampling, skew, threads, tfidf
from deskloom.plans import evaluation, indexing, triage as tri
from deskloom.session import checkpoint_dir, configure, cut_lineage
from deskloom.sources import index_store, parsing, sinks
from deskloom.sources.tables import messages_from_turns, read_messages, read_sheet, read_table, sheet, spread
from deskloom.streaming import ingest, streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark, sf_dir):
    return messages_from_turns(table(spark, sf_dir, "conversations"))


def documents(spark, sf_dir, *columns):
    return spread(table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text"))))


def pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages").select("page_id", "html"))


def scratch(spark) -> str:
    return f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"


def r6(col) -> F.Column:
    return F.round(col, 6)


# === profiles =====================================================================================


@query("author_profile", f"with {sql.MESSAGES} select count(*)::bigint as total, count(*) filter (inbound)::bigint as inbound, count(*) filter (not inbound)::bigint as outbound from messages")
def author_profile(spark, sf):
    return profile.message_profile(messages(spark, sf))


@query("top_authors", "select user_id, count(*)::bigint as messages from events group by user_id order by messages desc, user_id limit 30")
def top_authors(spark, sf):
    return profile.top_authors(table(spark, sf, "events"), 30, "user_id")


@query("brand_stats", f"""with {sql.MESSAGES},
answered as (select distinct parent_id as message_id from messages where parent_id is not null)
select m.author_id, count(*)::bigint as total, count(*) filter (m.inbound)::bigint as inbound,
  count(*) filter (not m.inbound)::bigint as outbound, count(m.parent_id)::bigint as with_parent,
  count(a.message_id)::bigint as with_response,
  count(distinct p.author_id) filter (p.author_id <> m.author_id)::bigint as customers
from messages m left join answered a using (message_id) left join messages p on p.message_id = m.parent_id
group by m.author_id""")
def brand_stats(spark, sf):
    return profile.brand_stats(messages(spark, sf))


@query("intent_distribution", f"""with {sql.MESSAGES}
select intent, count(*)::bigint as rows from (
  select {sql.label_case(prose.RULES, 'm')} as intent from (select {sql.clean('text', 'message')} as m from messages))
group by intent order by intent""")
def intent_distribution(spark, sf):
    return profile.label_counts(classify(messages(spark, sf), prose.RULES, "text"), "intent")


# === threads ======================================================================================


@query("pair_cases", f"with {sql.PAIRS} select * from pairs")
def pair_cases(spark, sf):
    return threads.pair_replies(messages(spark, sf), prose.BRAND)


@query("useful_messages", f"with {sql.USEFUL} select reply_id, customer_text, support_reply from useful")
def useful_messages(spark, sf):
    pairs = threads.pair_replies(messages(spark, sf), prose.BRAND)
    return threads.useful_pairs(pairs).select("reply_id", "customer_text", "support_reply")


@query("build_cases", f"with {sql.cases()} select case_id, message_id, customer_text, support_reply, intent, response_type from cases")
def build_cases(spark, sf):
    return threads.build_cases(messages(spark, sf), prose.BRAND, prose.POLICY).select(
        "case_id", "message_id", "customer_text", "support_reply", "intent", "response_type"
    )


@query("answered_messages", f"""with {sql.MESSAGES}
select message_id, author_id, text from messages p where author_id <> 'assistant' and exists (
  select 1 from messages r where r.parent_id = p.message_id and r.author_id = 'assistant')""")
def answered_messages(spark, sf):
    return threads.answered_messages(messages(spark, sf), prose.BRAND).select("message_id", "author_id", "text")


@query("first_reply", f"""with {sql.MESSAGES}
select p.message_id, {sql.clean('p.text', 'squeeze')} as customer_text, r.message_id as reply_id, {sql.clean('r.text', 'squeeze')} as support_reply
from messages p join (
  select *, row_number() over (partition by parent_id order by created, message_id) as rn from messages
  where author_id = 'assistant' and parent_id is not null) r on r.parent_id = p.message_id and r.rn = 1
where p.author_id <> 'assistant' and length({sql.clean('p.text', 'squeeze')}) >= 12""")
def first_reply(spark, sf):
    return threads.first_replies(messages(spark, sf), prose.BRAND).select(
        "message_id", "customer_text", "reply_id", "support_reply"
    )


CHAINS = f"""with recursive {sql.MESSAGES},
relevant as (
  select * from messages m where author_id = 'assistant' or exists (
    select 1 from messages r where r.author_id = 'assistant' and r.parent_id = m.message_id)),
walk as (
  select message_id, author_id, message_id as last_id, parent_id as next_id, 1 as length, (author_id <> 'assistant')::int as customers
  from relevant where author_id = 'assistant'
  union all
  select w.message_id, w.author_id, r.message_id, r.parent_id, w.length + 1, w.customers + (r.author_id <> 'assistant')::int
  from walk w join relevant r on r.message_id = w.next_id),
chains as (
  select message_id, author_id, last_id as root_id, length::bigint as length, customers::bigint as customer_messages
  from (select *, row_number() over (partition by message_id order by length desc) as rn from walk) where rn = 1 and customers > 0)"""


@query("reply_chains", CHAINS + " select * from chains")
def reply_chains(spark, sf):
    return threads.reply_chains(messages(spark, sf), [prose.BRAND])


@query("chain_stats", CHAINS + """ select author_id, count(*)::bigint as chains, round(avg(length), 6) as mean_length,
  list_sort(list(length))[(count(*) // 2) + 1]::bigint as median_length,
  round(avg((length >= 4)::int), 6) as multi_turn_share, round(avg((length >= 6)::int), 6) as long_share
from chains group by author_id""")
def chain_stats(spark, sf):
    stats = profile.chain_stats(threads.reply_chains(messages(spark, sf), [prose.BRAND]))
    return stats.select(
        "author_id",
        "chains",
        r6("mean_length").alias("mean_length"),
        F.col("median_length").cast("long").alias("median_length"),
        r6("multi_turn_share").alias("multi_turn_share"),
        r6("long_share").alias("long_share"),
    )


@query("dedup_keep_first", "select doc_id, text from (select *, row_number() over (partition by text order by doc_id) as rn from documents) where rn = 1")
def dedup_keep_first(spark, sf):
    return skew.keep_first(documents(spark, sf), ["text"], ["doc_id"])


# === text ===========================================================================================


@query("normalize_ids", "select event_id, regexp_replace(trim(' ' || user_id || '.0 '), '\\.0$', '') as author_id from events")
def normalize_ids(spark, sf):
    delivered = F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(".0 "))
    return table(spark, sf, "events").select("event_id", tx.normalize_id(delivered).alias("author_id"))


@query("clean_text", f"select page_id, {sql.clean('html', 'message')} as message, {sql.clean('html', 'weak_label')} as weak_label, {sql.clean('html', 'prelabel')} as prelabel, {sql.clean('html', 'squeeze')} as squeezed from pages")
def clean_text(spark, sf):
    return pages(spark, sf).select(
        "page_id",
        *[tx.clean(F.col("html"), p).alias(a) for p, a in
          [("message", "message"), ("weak_label", "weak_label"), ("prelabel", "prelabel"), ("squeeze", "squeezed")]],
    )


@query("clean_index", f"select doc_id, {sql.clean('text', 'index')} as cleaned from documents")
def clean_index(spark, sf):
    return documents(spark, sf).select("doc_id", tx.clean(F.col("text"), "index").alias("cleaned"))


@query("clean_cluster", f"select page_id, {sql.clean('html', 'cluster')} as cleaned from pages")
def clean_cluster(spark, sf):
    return pages(spark, sf).select("page_id", tx.clean(F.col("html"), "cluster").alias("cleaned"))


@query("sanitize_reply", f"select page_id, {sql.sanitize('html')} as reply from pages")
def sanitize_reply(spark, sf):
    return pages(spark, sf).select("page_id", tx.sanitize_reply(F.col("html")).alias("reply"))


@query("contains_any", f"select doc_id, {sql.any_of('m', prose.INTENT_PHRASES['I10'])} as fraud, {sql.any_of('m', lex.ROUTER)} as router from (select doc_id, {sql.clean('text', 'message')} as m from documents)")
def contains_any(spark, sf):
    cleaned = documents(spark, sf).select("doc_id", tx.clean(F.col("text"), "message").alias("m"))
    return cleaned.select(
        "doc_id",
        tx.contains_any(F.col("m"), prose.INTENT_PHRASES["I10"]).alias("fraud"),
        tx.contains_any(F.col("m"), lex.ROUTER).alias("router"),
    )


@query("keyword_scores", "select doc_id, " + ", ".join(f"({sql.hits('m', p)} * {w})::int as score_{label}" for label, (p, w) in prose.SCORED.weights.items()) + " from (select doc_id, lower(text) as m from documents)")
def keyword_scores(spark, sf):
    cleaned = documents(spark, sf).select("doc_id", tx.clean(F.col("text"), "lower").alias("m"))
    scored = cleaned.select("doc_id", prose.SCORED.scores(F.col("m")).alias("s"))
    return scored.select("doc_id", *[F.col("s")[i].alias(f"score_{label}") for i, label in enumerate(prose.SCORED.weights)])


@query("normalize_synonyms", f"select doc_id, {sql.synonyms('text', prose.SYNONYMS)} as normalised from documents")
def normalize_synonyms(spark, sf):
    return documents(spark, sf).select("doc_id", tx.replace_in_order(F.col("text"), prose.SYNONYMS).alias("normalised"))


TOKENS = f"regexp_extract_all(lower(text), '{sql.WORD}{{2,}}')"


@query("tokens", f"select doc_id, len({TOKENS})::int as n, array_to_string({TOKENS}, ' ') as tokens from documents")
def tokens(spark, sf):
    split = documents(spark, sf).select("doc_id", tx.tokens(F.col("text")).alias("w"))
    return split.select("doc_id", F.size("w").alias("n"), F.concat_ws(" ", "w").alias("tokens"))


@query("ngrams", f"""with {sql.terms('d', '(select lang as part, doc_id, text from documents)', prose.SPEC)}
select doc_id, term, tf::bigint as tf from d_terms""")
def ngrams(spark, sf):
    """All words and bigrams of every document with their counts."""
    counts = tfidf.term_counts(documents(spark, sf, "doc_id", "text", "lang"), prose.SPEC, "doc_id", "text", "lang")
    return counts.select("doc_id", "term", "tf")


# === classification ===================================================================================


@query("classify_first_match", f"select doc_id, {sql.label_case(prose.PLAIN_RULES, 'm')} as intent from (select doc_id, {sql.clean('text', 'message')} as m from documents)")
def classify_first_match(spark, sf):
    return classify(documents(spark, sf), prose.PLAIN_RULES, "text").select("doc_id", "intent")


@query("classify_compound", f"select doc_id, {sql.label_case(prose.RULES, 'm')} as intent from (select doc_id, {sql.clean('text', 'message')} as m from documents)")
def classify_compound(spark, sf):
    return classify(documents(spark, sf), prose.RULES, "text").select("doc_id", "intent")


@query("classify_support", None)
def classify_support(spark, sf):
    """The built-in support vocabulary over all documents and turns."""
    from deskloom.functions.policy import SUPPORT_RULES

    docs = documents(spark, sf).select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")
    turns = messages(spark, sf).select(F.col("message_id").alias("id"), "text")
    return classify(docs.unionByName(turns), SUPPORT_RULES, "text").select("id", "intent")


from deskloom.functions.policy import SUPPORT_RULES  # noqa: E402

ORACLES["classify_support"] = f"""select id, {sql.label_case(SUPPORT_RULES, 'm')} as intent from (
  select 'd' || doc_id as id, {sql.clean('text', 'message')} as m from documents
  union all select conv_id || '-' || turn, {sql.clean('text', 'message')} from conversations)"""


@query("classify_index_v3", f"""select id, {sql.label_case(INDEX_RULES, 'm')} as intent from (
  select 'd' || doc_id as id, {sql.clean('text', 'index')} as m from documents
  union all select conv_id || '-' || turn, {sql.clean('text', 'index')} from conversations)""")
def classify_index_v3(spark, sf):
    """The rules that label historical cases, over all documents and turns."""
    docs = documents(spark, sf).select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")
    turns = messages(spark, sf).select(F.col("message_id").alias("id"), "text")
    return classify(docs.unionByName(turns), INDEX_RULES, "text").select("id", "intent")


LABEL, SCORE = sql.score_case(prose.SCORED, "m")


@query("classify_max_score", f"select doc_id, {LABEL} as intent, ({SCORE})::int as score from (select doc_id, lower(text) as m from documents)")
def classify_max_score(spark, sf):
    return classify_by_score(documents(spark, sf), prose.SCORED, "text").select("doc_id", "intent", "score")


LOWER_LABEL, LOWER_SCORE = sql.score_case(prose.SCORED, "l")


@query("classify_one_pass", f"""select doc_id, {sql.label_case(SUPPORT_RULES, 'm')} as support, {sql.label_case(prose.RULES, 'm')} as compound,
  {sql.label_case(INDEX_RULES, 'i')} as indexed, {LOWER_LABEL} as scored, ({LOWER_SCORE})::int as scored_score
from (select doc_id, {sql.clean('text', 'message')} as m, {sql.clean('text', 'index')} as i, lower(text) as l from documents)""")
def classify_one_pass(spark, sf):
    """Three rule sets and a scored set, each text read once per cleaning profile."""
    sets = {"support": SUPPORT_RULES, "compound": prose.RULES, "indexed": INDEX_RULES}
    return classify_in_one_pass(documents(spark, sf), "text", sets, {"scored": prose.SCORED}).drop("text")


@query("response_type", f"""with {sql.MESSAGES} select message_id, {sql.response_case(prose.RESPONSES, 'text', 'c')} as response_type
from (select message_id, text, {sql.clean('text', 'index')} as c from messages)""")
def response_type(spark, sf):
    return with_response_type(messages(spark, sf), prose.RESPONSES, "text").select("message_id", "response_type")


@query("problem_signals", f"""select doc_id, array_to_string({sql.signal_list('n', prose.SIGNALS)}, ',') as signals
from (select doc_id, {sql.synonyms('text', prose.SYNONYMS)} as n from documents)""")
def problem_signals(spark, sf):
    marked = with_signals(documents(spark, sf), "text", prose.SIGNALS, prose.SYNONYMS)
    return marked.select("doc_id", F.array_join("signals", ",").alias("signals"))


@query("signals_one_pass", ORACLES["problem_signals"])
def signals_one_pass(spark, sf):
    marked = with_signals(documents(spark, sf), "text", prose.SIGNALS, prose.SYNONYMS, one_pass=True)
    return marked.select("doc_id", F.array_join("signals", ",").alias("signals"))


@query("consistency_gate", f"""with {sql.PAIRS}
select reply_id, intent, {sql.gate_case(prose.POLICY.gate, 'intent', 'cur', 'hist')} as is_consistent from (
  select reply_id, {sql.label_case(prose.RULES, 'm')} as intent, {sql.signal_list('a', prose.SIGNALS)} as cur, {sql.signal_list('b', prose.SIGNALS)} as hist
  from (select reply_id, {sql.clean('customer_text', 'message')} as m, {sql.synonyms('customer_text', prose.SYNONYMS)} as a,
          {sql.synonyms('support_reply', prose.SYNONYMS)} as b from pairs))""")
def consistency_gate(spark, sf):
    pairs = classify(threads.pair_replies(messages(spark, sf), prose.BRAND), prose.RULES, "customer_text")
    marked = with_signals(pairs, "customer_text", prose.SIGNALS, prose.SYNONYMS, "cur")
    marked = with_signals(marked, "support_reply", prose.SIGNALS, prose.SYNONYMS, "hist")
    gate = consistent(prose.POLICY.gate, F.col("intent"), F.col("cur"), F.col("hist"))
    return marked.select("reply_id", "intent", gate.alias("is_consistent"))


# === index and retrieval ===============================================================================


def case_index(spark, sf, spec=prose.SPEC):
    return indexing.case_index(messages(spark, sf), prose.BRAND, prose.POLICY, spec, held_out=None)


def asked(spark, sf):
    """All documents as incoming messages."""
    return documents(spark, sf).select(F.col("doc_id").alias("query_id"), F.col("text").alias("customer_text"))


def classified(spark, sf):
    return tri.classified_messages(asked(spark, sf), prose.POLICY)


C_SRC = "c_src as (select intent as part, case_id as doc_id, customer_text as text from cases)"
CASE_INDEX = f"with {sql.cases()},\n{C_SRC},\n{sql.index('c', 'c_src', prose.SPEC)}"


@query("term_df", f"""with {sql.terms('d', '(select lang as part, doc_id, text from documents)', prose.SPEC)},
parts as (select lang as part, count(*) as docs from documents group by lang)
select part, term, count(*)::bigint as df, docs::bigint as docs from d_terms join parts using (part) group by part, term, docs""")
def term_df(spark, sf):
    counted = tfidf.document_frequency(documents(spark, sf, "doc_id", "text", "lang"), prose.SPEC, "doc_id", "text", "lang")
    return counted.select("part", "term", "df", "docs")


@query("build_index", CASE_INDEX + " select part, doc_id as case_id, term, round(weight, 6) as weight from c_vec")
def build_index(spark, sf):
    _, index = case_index(spark, sf)
    return index.entries().select("part", "case_id", "term", r6("weight").alias("weight"))


@query("index_roundtrip", CASE_INDEX + """, sizes as (select part, count(*) as docs from c_src group by part)
select v.part, v.doc_id as case_id, c.customer_text, v.term, round(v.weight, 6) as weight, w.df::bigint as df, round(w.idf, 6) as idf, s.docs::bigint as docs
from c_vec v join c_vocab w using (part, term) join sizes s using (part) join cases c on c.case_id = v.doc_id""")
def index_roundtrip(spark, sf):
    cases, index = case_index(spark, sf)
    path = scratch(spark)
    index_store.save_index(index, cases, path)
    return index_entries(*index_store.load_index(spark, path))


def index_entries(index, cases):
    entries = index.postings().join(index.members, ["part", "vec_id"]).drop("salts")
    joined = entries.join(index.vocab, ["part", "term"]).join(F.broadcast(index.parts), "part")
    joined = joined.join(cases.select("case_id", "customer_text"), "case_id")
    return joined.select(
        "part", "case_id", "customer_text", "term", r6("weight").alias("weight"), "df", r6("idf").alias("idf"), "docs"
    )


@query("index_merge", ORACLES["index_roundtrip"])
def index_merge(spark, sf):
    """Half of the cases are indexed and kept; the other half is merged into what was kept."""
    cases = threads.build_cases(messages(spark, sf), prose.BRAND, prose.POLICY)
    half = F.crc32(F.col("case_id").cast("binary")) % 2 == 0
    cases = cut_lineage(cases.withColumn("half", half))
    path = scratch(spark)
    first = cases.filter("half").drop("half")
    index_store.save_index(tfidf.build_index(first, prose.SPEC), first, path)
    kept, _ = index_store.load_index(spark, path)
    return index_entries(tfidf.merge_cases(kept, cases.filter("NOT half")), cases)


RETRIEVAL = f"""with {sql.cases()},
{sql.QUERIES},
{C_SRC},
{sql.index('c', 'c_src', prose.SPEC)},
q_src as (select intent as part, query_id as doc_id, customer_text as text from queries),
{sql.query_vectors('q', 'q_src', 'c', prose.SPEC)}"""


@query("tfidf_topk", RETRIEVAL + f",\n{sql.hits_cte('q', 'c', 3)} select query_id, part, rank_no::int as rank_no, case_id, similarity from hits")
def tfidf_topk(spark, sf):
    _, index = case_index(spark, sf)
    hits = retrieval.retrieve(classified(spark, sf), index, 3)
    return hits


@query("tfidf_topk_pruned", ORACLES["tfidf_topk"])
def tfidf_topk_pruned(spark, sf):
    """The same result through the search that leaves frequent terms out of the join."""
    _, index = case_index(spark, sf)
    hits = retrieval.retrieve(classified(spark, sf), index, 3, pair_budget=0)
    return hits


PRIORITY = "case response_type " + " ".join(f"when '{t}' then {p}" for t, p in lex.TYPE_PRIORITY.items()) + " else 5 end"


@query("rerank_topk", RETRIEVAL + f""",\n{sql.hits_cte('q', 'c', 25)}
select query_id, new_rank::int as new_rank, case_id, response_type, similarity from (
  select *, row_number() over (partition by query_id order by {PRIORITY}, similarity desc, rank_no) as new_rank
  from hits join cases using (case_id)) where new_rank <= 5 and similarity >= 0.12""")
def rerank_topk(spark, sf):
    cases, index = case_index(spark, sf)
    hits = retrieval.with_cases(retrieval.retrieve(classified(spark, sf), index, 25), cases)
    return retrieval.rerank(hits, 5).select(
        "query_id", "new_rank", "case_id", "response_type", "similarity"
    )


@query("global_topk", f"""with c_src as (select 'all' as part, doc_id, text from documents),
{sql.index('c', 'c_src', prose.GLOBAL_SPEC)},
q_src as (select 'all' as part, item_id as doc_id, text from benchmark),
{sql.query_vectors('q', 'q_src', 'c', prose.GLOBAL_SPEC)},
{sql.hits_cte('q', 'c', 5)}
select query_id as item_id, case_id as doc_id, rank_no::int as rank_no, similarity, similarity >= 0.15 as usable_evidence from hits""")
def global_topk(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text", F.lit("all").alias("part"))
    index = tfidf.build_index(docs, prose.GLOBAL_SPEC, "doc_id", "text", "part")
    items = table(spark, sf, "benchmark").select("item_id", "text", F.lit("all").alias("part"))
    hits = retrieval.retrieve(items, index, 5, "item_id", "text", "part")
    return hits.select(
        F.col("query_id").alias("item_id"),
        F.col("case_id").alias("doc_id"),
        "rank_no",
        "similarity",
        (F.col("similarity") >= 0.15).alias("usable_evidence"),
    )


@query("knn_label", f"""with {sql.PAIRS},
c_src as (select 'all' as part, reply_id as doc_id, customer_text as text from pairs),
{sql.index('c', 'c_src', prose.KNN_SPEC)},
q_src as (select 'all' as part, doc_id, text from documents),
{sql.query_vectors('q', 'q_src', 'c', prose.KNN_SPEC)},
{sql.hits_cte('q', 'c', 7)},
labels_of as (select reply_id as case_id, {sql.label_case(prose.LANGUAGE_RULES, 'm')} as label from (select reply_id, {sql.clean('customer_text', 'message')} as m from pairs)),
tally as (
  select query_id, label, sum(case when similarity >= 1 - 2e-9 then 1.0 else 0.0 end) as e,
         sum(case when similarity >= 1 - 2e-9 then 0.0 else 1.0 / (1.0 - similarity) end) as n
  from hits join labels_of using (case_id) group by all),
voted as (select *, case when max(e) over (partition by query_id) > 0 then e else n end as votes from tally)
select query_id as doc_id, label as predicted, round(votes, 6) as votes from (
  select *, row_number() over (partition by query_id order by round(votes, 9) desc, label) as place from voted) where place = 1""")
def knn_label(spark, sf):
    pairs = threads.pair_replies(messages(spark, sf), prose.BRAND)
    cases = cut_lineage(
        classify(pairs, prose.LANGUAGE_RULES, "customer_text", "label").select(
            F.col("reply_id").alias("case_id"), "customer_text", "label", F.lit("all").alias("part")
        )
    )
    index = tfidf.build_index(cases, prose.KNN_SPEC, "case_id", "customer_text", "part")
    asked_docs = documents(spark, sf).withColumn("part", F.lit("all"))
    hits = retrieval.retrieve(asked_docs, index, 7, "doc_id", "text", "part")
    votes = retrieval.knn_vote(hits, cases, "label")
    return votes.select(F.col("query_id").alias("doc_id"), "predicted", r6("votes").alias("votes"))


@query("leakage_check", f"""with q as (select item_id, {sql.clean('line', 'index')} as t from (select item_id, unnest(string_split(text, chr(10))) as line from benchmark)),
d as (select doc_id, {sql.clean('line', 'index')} as t from (select doc_id, unnest(string_split(text, chr(10))) as line from documents))
select item_id, copies, first_case as first_doc from (
  select t, count(distinct doc_id)::bigint as copies, min(doc_id) as first_case from d where t <> '' group by t) join q using (t)""")
def leakage_check(spark, sf):
    """Benchmark lines that occur as lines of documents."""
    lines = F.explode(F.split("text", "\n")).alias("line")
    items = table(spark, sf, "benchmark").select("item_id", lines)
    corpus = documents(spark, sf).select("doc_id", lines)
    report = retrieval.leakage_report(items, corpus, "item_id", "line", "doc_id", "line")
    return report.select("item_id", "copies", F.col("first_case").alias("first_doc"))


@query("leakage_guard", f"""select doc_id, line from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)
where {sql.clean('line', 'index')} = '' or {sql.clean('line', 'index')} not in (
  select {sql.clean('line', 'index')} from (select unnest(string_split(text, chr(10))) as line from benchmark))""")
def leakage_guard(spark, sf):
    """Document lines that are not also benchmark lines."""
    lines = F.explode(F.split("text", "\n")).alias("line")
    items = table(spark, sf, "benchmark").select(lines)
    corpus = documents(spark, sf).select("doc_id", lines)
    return retrieval.without_leaks(corpus, items, "line", "line").select("doc_id", "line")


CONTAINED = f"""with q as (select item_id, {sql.clean('text', 'index')} as q from benchmark),
d as (select doc_id, text, {sql.clean('text', 'index')} as t from documents),
held as (select * from q join d on q <> '' and (t = q or len(string_split(q, ' ')) >= 5 and contains(' ' || t || ' ', ' ' || q || ' ')))"""


@query("leakage_contained", CONTAINED + " select item_id, count(*)::bigint as copies, min(doc_id) as first_doc from held group by item_id")
def leakage_contained(spark, sf):
    """Benchmark items whose words occur, one after another, inside documents."""
    report = leakage.containment_report(
        table(spark, sf, "benchmark"), documents(spark, sf), "item_id", "text", "doc_id", "text"
    )
    return report.select("item_id", "copies", F.col("first_case").alias("first_doc"))


@query("leakage_guard_contained", CONTAINED + " select doc_id, text from documents where doc_id not in (select doc_id from held)")
def leakage_guard_contained(spark, sf):
    """Documents that hold no benchmark item."""
    return leakage.without_contained(documents(spark, sf), table(spark, sf, "benchmark"), "text", "text")


# === evidence, decision, reply ==========================================================================


def evidence_rows(spark, sf):
    cases, index = case_index(spark, sf)
    return tri.evidence_rows(classified(spark, sf), index, cases, prose.POLICY)


def triaged(spark, sf, policy=prose.POLICY):
    cases, index = case_index(spark, sf)
    return tri.triage(asked(spark, sf), index, cases, policy)


@query("choose_evidence", f"with {sql.evidence()} select query_id, case_id, rank_no::int as rank_no, response_type, similarity, score as grounding_score from grounding")
def choose_evidence(spark, sf):
    chosen = ev.choose_grounding(evidence_rows(spark, sf), prose.POLICY)
    return chosen.select(
        "query_id", "case_id", "rank_no", "response_type", "similarity", "grounding_score"
    )


def fmt(template: str, value: str) -> str:
    head, tail = template.split("%.3f")
    return f"{sql.q(head)} || format('{{:.3f}}', {value}) || {sql.q(tail)}"


ALWAYS = "case intent " + " ".join(f"when {sql.q(i)} then {sql.q(t)}" for i, t in lex.REASON_BY_INTENT.items()) + " end"
V1 = f"""with {sql.evidence()},
v1 as (
  select qq.query_id, qq.intent, qq.m <> '' and exists (select 1 from c_parts p where p.part = qq.intent) as available,
         coalesce(e.similarity, 0.0) as similarity, e.historical_reply,
         coalesce(e.similarity >= 0.20 and e.response_type not in ('unknown', 'generic', 'escalation'), false) as is_safe
  from queries qq left join (select * from evidence where rank_no = 1) e using (query_id)),
v1d as (
select *, intent not in ({sql.words(lex.REASON_BY_INTENT)}) and available and similarity >= 0.30 and is_safe as auto,
  coalesce({ALWAYS}, case when not available then {sql.q(lex.REASON_NO_EVIDENCE)}
       when similarity < 0.20 then {fmt(lex.REASON_V1_WEAK, 'similarity')}
       when not is_safe then {sql.q(lex.REASON_V1_UNSAFE)}
       when similarity < 0.30 then {fmt(lex.REASON_V1_LOW, 'similarity')}
       else {fmt(lex.REASON_V1_AUTO, 'similarity')} end) as escalation_reason
from v1)
select query_id, intent, not auto as should_escalate, escalation_reason, is_safe,
  case when not auto then {sql.by_intent(lex.DRAFT_ESCALATION, sql.q(lex.DRAFT_DEFAULT))}
       when coalesce(historical_reply, '') = '' or lower(historical_reply) = 'nan' then {sql.q(lex.DRAFT_V1_INCOMPLETE)}
       else historical_reply end as draft
from v1d"""


@query("evidence_v1", V1)
def evidence_v1(spark, sf):
    """The first policy: the rank-1 case alone decides."""
    cases, index = case_index(spark, sf)
    messages_ = classified(spark, sf)
    hits = tri.evidence_rows(messages_, index, cases, prose.POLICY)
    first = ev.safe_first_hit(hits, prose.POLICY).select("query_id", "similarity", "historical_reply", "is_safe")
    known = index.parts.select(F.col("part").alias("intent"), F.lit(True).alias("indexed"))
    joined = (
        messages_.join(F.broadcast(known), "intent", "left")
        .join(first, "query_id", "left")
        .withColumn(
            "evidence_available",
            F.coalesce("indexed", F.lit(False)) & (tx.clean(F.col("customer_text"), "message") != ""),
        )
    )
    decided = ev.decide_first_hit(joined, prose.POLICY)
    return decided.select(
        "query_id", "intent", "should_escalate", "escalation_reason",
        F.coalesce("is_safe", F.lit(False)).alias("is_safe"),
        ev.draft_first_hit_reply(F.col("historical_reply")).alias("draft"),
    )


DECIDED = "select query_id, intent, should_escalate, escalation_reason, best_similarity from decided"


def decided_columns(results):
    return results.select(
        "query_id", "intent", "should_escalate", "escalation_reason", "best_similarity"
    )


@query("escalation", f"with {sql.decisions()} {DECIDED}")
def escalation(spark, sf):
    return decided_columns(triaged(spark, sf))


@query("escalation_strict", f"with {sql.decisions(prose.POLICY.strict())} {DECIDED}")
def escalation_strict(spark, sf):
    return decided_columns(triaged(spark, sf, prose.POLICY.strict()))


@query("draft_reply", f"with {sql.decisions()} select query_id, intent, should_escalate, draft from decided")
def draft_reply(spark, sf):
    return triaged(spark, sf).select("query_id", "intent", "should_escalate", "draft")


@query("grounded_reply", f"with {sql.decisions()} select query_id, intent, should_escalate, reply from decided")
def grounded_reply(spark, sf):
    return triaged(spark, sf).select("query_id", "intent", "should_escalate", "reply")


NAMES = "case intent " + " ".join(f"when '{i}' then '{n}'" for i, n in lex.INTENT_NAMES.items()) + " end"


@query("triage", f"""with {sql.decisions()}
select query_id, intent, {NAMES} as intent_name, should_escalate, escalation_reason, reply, evidence_available,
  evidence_count::int as evidence_count, best_similarity, evidence_selected,
  coalesce(g_type, '') as selected_type, coalesce(g_similarity, 0.0) as selected_similarity from decided""")
def triage_query(spark, sf):
    """Flagship: all documents triaged against the index of past conversations."""
    return triaged(spark, sf).select(
        "query_id",
        "intent",
        "intent_name",
        "should_escalate",
        "escalation_reason",
        "reply",
        "evidence_available",
        "evidence_count",
        "best_similarity",
        F.col("grounding").isNotNull().alias("evidence_selected"),
        F.coalesce("grounding.response_type", F.lit("")).alias("selected_type"),
        F.coalesce("grounding.similarity", F.lit(0.0)).alias("selected_similarity"),
    )


# === evaluation ============================================================================================


def language_predictions(spark, sf):
    return classify(documents(spark, sf, "doc_id", "text", "lang"), prose.LANGUAGE_RULES, "text", "predicted").select(
        "doc_id", F.col("lang").alias("gold"), "predicted"
    )


LANG = f"""with p as (select doc_id, lang as gold, {sql.label_case(prose.LANGUAGE_RULES, 'm')} as predicted
  from (select doc_id, lang, {sql.clean('text', 'message')} as m from documents))"""
REPORT = LANG + """,
labels_ as (select unnest(['de', 'en', 'es', 'fr', 'other']) as label),
counts as (
  select label, (select count(*) from p where gold = label) as support, (select count(*) from p where predicted = label) as claimed,
         (select count(*) from p where gold = label and predicted = label) as hits from labels_),
report as (
  select label, case when claimed > 0 then hits / claimed else 0.0 end as precision,
         case when support > 0 then hits / support else 0.0 end as recall,
         case when claimed + support > 0 then 2 * hits / (claimed + support) else 0.0 end as f1, support from counts)"""


@query("accuracy", LANG + " select count(*)::bigint as rows, count(*) filter (gold = predicted)::bigint as correct, round(avg((gold = predicted)::int), 6) as accuracy from p")
def accuracy(spark, sf):
    return metrics.accuracy(language_predictions(spark, sf), "gold", "predicted").withColumn("accuracy", r6("accuracy"))


@query("f1_scores", REPORT + " select round(avg(f1), 6) as macro_f1, round(sum(f1 * support) / sum(support), 6) as weighted_f1, count(*)::bigint as labels from report")
def f1_scores(spark, sf):
    scores = metrics.f1_scores(language_predictions(spark, sf), "gold", "predicted", prose.LANGUAGES)
    return scores.select(r6("macro_f1").alias("macro_f1"), r6("weighted_f1").alias("weighted_f1"), "labels")


@query("class_report", REPORT + " select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support::bigint as support from report")
def class_report(spark, sf):
    report = metrics.class_report(language_predictions(spark, sf), "gold", "predicted", prose.LANGUAGES)
    return report.select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("confusion", LANG + """,
l as (select unnest(['de', 'en', 'es', 'fr', 'other']) as x)
select a.x as gold, b.x as predicted, (select count(*) from p where gold = a.x and predicted = b.x)::bigint as n from l a, l b""")
def confusion(spark, sf):
    return metrics.confusion_long(language_predictions(spark, sf), "gold", "predicted", prose.LANGUAGES)


@query("confusion_matrix", LANG + ", l as (select unnest(['de', 'en', 'es', 'fr', 'other']) as x) select x as gold, " + ", ".join(
    f"(select count(*) from p where gold = x and predicted = '{c}')::bigint as \"PRED_{c}\"" for c in prose.LANGUAGES) + " from l")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(language_predictions(spark, sf), "gold", "predicted", prose.LANGUAGES)


def agent_predictions(spark, sf):
    gold = classify_by_score(documents(spark, sf), prose.SCORED, "text", "gold_intent").select(
        F.col("doc_id").alias("query_id"), "gold_intent"
    )
    return cut_lineage(tri.predictions(triaged(spark, sf), gold))


PRED = f"with {sql.predictions()}"


@query("agent_predictions", PRED + """ select case_id, gold_intent, predicted_intent, intent_correct, should_escalate, escalation_reason,
  evidence_available, evidence_selected, selected_similarity, selected_response_type from predictions""")
def agent_predictions_query(spark, sf):
    return agent_predictions(spark, sf).select(
        "case_id", "gold_intent", "predicted_intent", "intent_correct", "should_escalate", "escalation_reason",
        "evidence_available", "evidence_selected", "selected_similarity", "selected_response_type",
    )


@query("decision_crosstab", PRED + f""" select count(*) filter (intent_correct and not should_escalate)::bigint as correct_auto,
  count(*) filter (not intent_correct and not should_escalate)::bigint as wrong_auto,
  count(*) filter (intent_correct and should_escalate)::bigint as correct_escalated,
  count(*) filter (not intent_correct and should_escalate)::bigint as wrong_escalated,
  count(*) filter (not should_escalate and reply = {sql.q(lex.GROUNDED_WEAK_TYPE)})::bigint as auto_with_fallback from predictions""")
def decision_crosstab(spark, sf):
    return metrics.decision_crosstab(agent_predictions(spark, sf))


@query("safety_proxy", PRED + """, s as (select count(*) as total, count(*) filter (not should_escalate) as auto_handled, count(*) filter (should_escalate) as escalated,
  count(*) filter (not should_escalate and intent_correct) as correct_auto, count(*) filter (evidence_available) as evidence_available,
  count(*) filter (evidence_selected) as evidence_selected from predictions)
select total::bigint as total, auto_handled::bigint as auto_handled, escalated::bigint as escalated, correct_auto::bigint as correct_auto,
  evidence_available::bigint as evidence_available, evidence_selected::bigint as evidence_selected,
  round(auto_handled / total, 6) as auto_rate, round(escalated / total, 6) as escalation_rate,
  round(case when auto_handled > 0 then correct_auto / auto_handled else 0.0 end, 6) as safety_proxy from s""")
def safety_proxy(spark, sf):
    out = metrics.safety(agent_predictions(spark, sf))
    return out.withColumns({c: r6(c) for c in ("auto_rate", "escalation_rate", "safety_proxy")})


@query("similarity_coverage", PRED + """, s as (select selected_similarity as s from predictions where evidence_selected)
select count(*)::bigint as rows, count(*) filter (s >= 0.2)::bigint as at_least_20, count(*) filter (s >= 0.3)::bigint as at_least_30,
  count(*) filter (s >= 0.4)::bigint as at_least_40, count(*) filter (s >= 0.5)::bigint as at_least_50,
  round(avg(s), 6) as mean_similarity, round(median(s), 5) as median_similarity from s""")
def similarity_coverage(spark, sf):
    out = metrics.similarity_coverage(agent_predictions(spark, sf), selected_only=True)
    return out.withColumn("mean_similarity", r6("mean_similarity")).withColumn(
        "median_similarity", F.round("median_similarity", 5)
    )


@query("risky_auto", PRED + " select case_id, gold_intent, predicted_intent, escalation_reason, reply from predictions where not should_escalate and not intent_correct")
def risky_auto(spark, sf):
    return metrics.risky_auto(agent_predictions(spark, sf)).select(
        "case_id", "gold_intent", "predicted_intent", "escalation_reason", "reply"
    )


def flags(pattern_list) -> str:
    return "(?i)(?:" + "|".join(pattern_list) + ")"


@query("reply_quality", f"""with r as (select length(html) as chars, {sql.strip('html')} <> '' as present,
  regexp_matches(html, {sql.q(flags(lex.INTERNAL_PATTERNS))}) as internal, regexp_matches(html, {sql.q(flags(lex.ARTIFACT_PATTERNS))}) as artifact from pages)
select count(*)::bigint as rows, count(*) filter (present)::bigint as replies, count(*) filter (internal)::bigint as internal_leakage,
  count(*) filter (artifact)::bigint as artifact_leakage, round(avg(internal::int), 6) as internal_rate, round(avg(artifact::int), 6) as artifact_rate,
  round(avg(chars), 6) as mean_length, round(median(chars), 6) as median_length from r""")
def reply_quality(spark, sf):
    out = metrics.reply_quality(pages(spark, sf), "html")
    return out.withColumns({c: r6(c) for c in ("internal_rate", "artifact_rate", "mean_length", "median_length")})


# --- evidence benchmark: benchmark passages against documents, judged by the documents' labels -----------------


def judged_evidence(spark, sf):
    docs = documents(spark, sf).select(
        F.col("doc_id").alias("case_id"), F.col("text").alias("customer_text"), F.col("text").alias("support_reply"),
        F.lit("unknown").alias("response_type"), F.lit("all").alias("part"),
    )
    index = tfidf.build_index(docs, prose.GLOBAL_SPEC, "case_id", "customer_text", "part")
    gold = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("case_id"), F.col("text").alias("customer_text"), F.lit("all").alias("final_intent")
    )
    lookup = docs.select("case_id", "customer_text", "support_reply", "response_type")
    rows = evaluation.evidence_benchmark(gold, index, lookup, 3)
    judged = docs.select(F.col("case_id").alias("doc_id"), F.md5("customer_text").alias("key")).join(table(spark, sf, "labels"), "doc_id")
    # texts with copies: a text is judged YES if any labelled copy is
    verdict = judged.groupBy("key").agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    yes = lambda c: F.when(c, " yes").otherwise("No ")
    return rows.withColumn("key", F.md5("historical_customer")).join(verdict, "key", "left").select(
        "case_id", "gold_intent", "customer_text", "rank", "similarity",
        yes(F.col("quality") == 1).alias("relevant"),
        yes((F.col("quality") == 1) & (F.col("similarity") >= 0.2)).alias("actionable"),
        yes(F.col("toxic") == 0).alias("safe_to_ground"),
    )


JUDGED = f"""with c_src as (select 'all' as part, doc_id, text from documents),
{sql.index('c', 'c_src', prose.GLOBAL_SPEC)},
q_src as (select 'all' as part, item_id as doc_id, text from benchmark),
{sql.query_vectors('q', 'q_src', 'c', prose.GLOBAL_SPEC)},
{sql.hits_cte('q', 'c', 3)},
verdict as (select text, max(quality) as quality, max(toxic) as toxic from documents join labels using (doc_id) group by text),
judged as (
  select h.query_id as case_id, 'all' as gold_intent, b.text as customer_text, h.rank_no as rank, cast(round(cast(h.similarity as decimal(18, 9)), 4) as double) as similarity,
         case when v.quality = 1 then 'YES' else 'NO' end as relevant,
         case when v.quality = 1 and cast(round(cast(h.similarity as decimal(18, 9)), 4) as double) >= 0.2 then 'YES' else 'NO' end as actionable,
         case when v.toxic = 0 then 'YES' else 'NO' end as safe_to_ground
  from hits h join documents d on d.doc_id = h.case_id join benchmark b on b.item_id = h.query_id left join verdict v on v.text = d.text)"""


@query("evidence_benchmark", JUDGED + " select case_id, gold_intent, customer_text, rank::int as rank, similarity, relevant, actionable, safe_to_ground from judged")
def evidence_benchmark(spark, sf):
    return metrics.normalise_judgements(judged_evidence(spark, sf))


@query("evidence_rates", JUDGED + ", c as (select case_id, " + ", ".join(
    f"max((rank = 1 and {j} = 'YES')::int) as one_{j}, max(({j} = 'YES')::int) as any_{j}" for j in metrics.JUDGEMENTS) + " from judged group by case_id) " + " union all ".join(
    f"select '{j}' as judgement, round(avg(one_{j}), 6) as top1, round(avg(any_{j}), 6) as top3, round(avg(any_{j}) - avg(one_{j}), 6) as gain from c" for j in metrics.JUDGEMENTS))
def evidence_rates(spark, sf):
    out = metrics.evidence_rates(judged_evidence(spark, sf))
    return out.withColumns({c: r6(c) for c in ("top1", "top3", "gain")})


@query("case_summary", JUDGED + " select case_id, min_by(gold_intent, rank) as gold_intent, min_by(customer_text, rank) as customer_text, min_by(similarity, rank) as top1_similarity, " + ", ".join(
    f"min_by({j}, rank) as top1_{j}, bool_or({j} = 'YES') as any_{j}" for j in metrics.JUDGEMENTS) + " from judged group by case_id")
def case_summary(spark, sf):
    return metrics.case_summary(judged_evidence(spark, sf))


@query("risky_cases", JUDGED + " select case_id, rank::int as rank, similarity, relevant from judged where relevant = 'NO' and similarity >= 0.30 order by similarity desc, case_id, rank limit 20")
def risky_cases(spark, sf):
    return metrics.similar_but_irrelevant(judged_evidence(spark, sf)).select("case_id", "rank", "similarity", "relevant")


@query("weak_first_hits", JUDGED + " select case_id, similarity from judged where rank = 1 and similarity < 0.20")
def weak_first_hits(spark, sf):
    return metrics.weak_first_hits(judged_evidence(spark, sf)).select("case_id", "similarity")


@query("annotation_check", """with a as (select case when quality = 1 then 'YES' when quality = 0 then 'NO' end as relevant,
  case when toxic = 1 then 'MAYBE' when toxic = 0 then 'YES' end as actionable, case when toxic = 0 then 'NO' end as safe_to_ground
  from documents left join labels using (doc_id))
select 'relevant' as "column", count(*) filter (relevant in ('YES', 'NO'))::bigint as valid, (count(*) - count(*) filter (relevant in ('YES', 'NO')))::bigint as invalid from a
union all select 'actionable', count(*) filter (actionable in ('YES', 'NO'))::bigint, (count(*) - count(*) filter (actionable in ('YES', 'NO')))::bigint from a
union all select 'safe_to_ground', count(*) filter (safe_to_ground in ('YES', 'NO'))::bigint, (count(*) - count(*) filter (safe_to_ground in ('YES', 'NO')))::bigint from a""")
def annotation_check(spark, sf):
    joined = documents(spark, sf, "doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    sheet = joined.select(
        F.when(F.col("quality") == 1, " yes").when(F.col("quality") == 0, "No").alias("relevant"),
        F.when(F.col("toxic") == 1, "maybe").when(F.col("toxic") == 0, "yes ").alias("actionable"),
        F.when(F.col("toxic") == 0, "no").alias("safe_to_ground"),
    )
    return metrics.annotation_check(sheet)


def kappa_sql(pairs_cte: str, weights: bool) -> str:
    d = "(pa.place - pb.place) * (pa.place - pb.place)" if weights else "(pa.place <> pb.place)::int"
    return f"""{pairs_cte},
seen as (select dimension, a as label from r union select dimension, b from r),
places as (select dimension, label, row_number() over (partition by dimension order by label) as place from seen),
ma as (select dimension, a as label, count(*) as n from r group by all),
mb as (select dimension, b as label, count(*) as n from r group by all),
obs as (select r.dimension, count(*) as n, avg((r.a = r.b)::int) as same, sum({d}) as dist
  from r join places pa on pa.dimension = r.dimension and pa.label = r.a join places pb on pb.dimension = r.dimension and pb.label = r.b group by r.dimension),
chance as (select ma.dimension, sum(ma.n * mb.n * ({d})) as dist
  from ma join mb using (dimension) join places pa on pa.dimension = ma.dimension and pa.label = ma.label
  join places pb on pb.dimension = mb.dimension and pb.label = mb.label group by ma.dimension)
select obs.dimension, obs.n::bigint as n, round(same, 6) as exact_agreement,
  round(case when chance.dist > 0 then 1 - obs.dist * obs.n::double / chance.dist end, 6) as kappa
from obs join chance using (dimension)"""


@query("kappa", kappa_sql("""with r as (
  select 'quality_toxic' as dimension, case when quality = 1 then 'YES' else 'NO' end as a, case when toxic = 1 then 'YES' else 'NO' end as b from labels
  union all select 'same', case when quality = 1 then 'YES' else 'NO' end, case when quality = 1 then 'YES' else 'NO' end from labels)""", False))
def kappa(spark, sf):
    rated = table(spark, sf, "labels").select(
        F.when(F.col("quality") == 1, " yes").otherwise("No").alias("judge"),
        F.when(F.col("toxic") == 1, "Yes").otherwise("no ").alias("human"),
    )
    out = metrics.agreement(rated, {"quality_toxic": ("judge", "human"), "same": ("judge", "judge")})
    return out.select("dimension", "n", r6("exact_agreement").alias("exact_agreement"), r6("kappa").alias("kappa"))


@query("judge_human", kappa_sql("""with r as (
  select 'quality' as dimension, case when quality = 1 then 'YES' else 'NO' end as a, case when d.lang = 'en' then 'YES' else 'NO' end as b from labels join documents d using (doc_id)
  union all select 'toxic', case when toxic = 1 then 'YES' else 'NO' end, case when d.n_chars > 1000 then 'YES' else 'NO' end from labels join documents d using (doc_id))""", False))
def judge_human(spark, sf):
    """Two tables of ratings, joined by case."""
    marks = table(spark, sf, "labels")
    judge = marks.select("doc_id", *[F.when(F.col(c) == 1, "Yes").otherwise("no").alias(c) for c in ("quality", "toxic")])
    human = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", "YES").otherwise("NO").alias("quality"),
        F.when(F.col("n_chars") > 1000, "yes ").otherwise("No").alias("toxic"),
    )
    out = metrics.agreement(*metrics.join_raters(judge, human, "doc_id", ["quality", "toxic"]))
    return out.select("dimension", "n", r6("exact_agreement").alias("exact_agreement"), r6("kappa").alias("kappa"))


@query("kappa_quadratic", kappa_sql("""with e as (
  select 1 + (user_id % 5) as judge, case when event_type <> 'error' then 1 + (cast(json_extract(props, '$.k') as bigint) + user_id) % 4 end as human, event_type from events),
r as (select 'relevance' as dimension, judge as a, human as b from e where human is not null
  union all select 'tone', judge, case when human = 2 then 3 else human end from e where human is not null)""", True))
def kappa_quadratic(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    rated = table(spark, sf, "events").select(
        (1 + F.col("user_id") % 5).alias("judge"),
        F.when(F.col("event_type") != "error", 1 + (k + F.col("user_id")) % 4).alias("human"),
    ).withColumn("human_tone", F.when(F.col("human") == 2, 3).otherwise(F.col("human")))
    out = metrics.agreement(rated, {"relevance": ("judge", "human"), "tone": ("judge", "human_tone")}, "quadratic")
    return out.select("dimension", "n", r6("exact_agreement").alias("exact_agreement"), r6("kappa").alias("kappa"))


# === samples ==================================================================================================


@query("random_sample", "select doc_id, text from documents order by md5(doc_id || ':42') limit 100")
def random_sample(spark, sf):
    return sampling.random_sample(documents(spark, sf), ["doc_id"], 100)


QUOTA = "case intent " + " ".join(f"when '{i}' then {n}" for i, n in prose.QUOTAS.items()) + " else 0 end"
PICKED = f"""with labelled as (select doc_id, {sql.label_case(prose.RULES, 'm')} as intent from (select doc_id, {sql.clean('text', 'message')} as m from documents)),
picked as (select doc_id, intent from (select *, row_number() over (partition by intent order by md5(doc_id || ':42')) as place from labelled) where place <= {QUOTA})"""


def labelled_documents(spark, sf):
    return classify(documents(spark, sf), prose.RULES, "text").select("doc_id", "intent")


@query("stratified_sample", PICKED + " select 'CASE-' || lpad(cast(row_number() over (order by md5(doc_id || ':7')) as varchar), 3, '0') as case_id, doc_id, intent from picked")
def stratified_sample(spark, sf):
    picked = sampling.stratified_sample(labelled_documents(spark, sf), "intent", ["doc_id"], prose.QUOTAS)
    return sampling.numbered(picked, [skew.hash_rank_key(["doc_id"], 7)]).select("case_id", "doc_id", "intent")


TOPUP = 200


@query("sample_topup", PICKED + f""", rest as (select doc_id, intent from labelled where doc_id not in (select doc_id from picked)
  order by md5(doc_id || ':123') limit (select greatest({TOPUP} - count(*), 0) from picked))
select * from picked union all select * from rest""")
def sample_topup(spark, sf):
    pool = labelled_documents(spark, sf)
    picked = cut_lineage(sampling.stratified_sample(pool, "intent", ["doc_id"], prose.QUOTAS))
    return sampling.top_up(picked, pool, ["doc_id"], TOPUP, picked.count())


@query("stratum_report", PICKED + ", asked as (select unnest([" + ", ".join(f"'{i}'" for i in prose.QUOTAS) + "]) as intent, unnest([" + ", ".join(str(n) for n in prose.QUOTAS.values()) + """]) as requested)
select a.intent, (select count(*) from labelled l where l.intent = a.intent)::bigint as available, a.requested::bigint as requested,
  (select count(*) from picked p where p.intent = a.intent)::bigint as selected from asked a""")
def stratum_report(spark, sf):
    pool = cut_lineage(labelled_documents(spark, sf))
    picked = sampling.stratified_sample(pool, "intent", ["doc_id"], prose.QUOTAS)
    return sampling.stratum_report(pool, picked, "intent", prose.QUOTAS)


@query("stratified_split", """select doc_id, lang, row_number() over (partition by lang order by md5(doc_id || ':42')) <= floor(count(*) over (partition by lang) * 0.2 + 0.5) as is_test from documents""")
def stratified_split(spark, sf):
    return sampling.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["doc_id"])


@query("calibration_mix", PRED + """, s as (
  select * from (select case_id, 1 as slice_no, 'auto' as slice from predictions where not should_escalate order by case_id limit 10)
  union all select * from (select case_id, 2, 'escalated' from predictions where should_escalate order by case_id limit 10)
  union all select * from (select case_id, 3, 'wrong' from predictions where not intent_correct order by case_id limit 10)),
first as (select * from (select *, row_number() over (partition by case_id order by slice_no) as n from s) where n = 1),
rest as (select case_id, 'extra' as slice from predictions where case_id not in (select case_id from first)
  order by md5(case_id || ':42') limit (select 30 - count(*) from first))
select case_id, slice from first union all select case_id, slice from rest""")
def calibration_mix(spark, sf):
    return sampling.calibration_mix(agent_predictions(spark, sf)).select("case_id", "slice")


# === labels and review ============================================================================================

FINAL = f"""with f as (select d.doc_id, {sql.label_case(prose.RULES, 'd.m')} as prelabel_intent, l.toxic
  from (select doc_id, {sql.clean('text', 'message')} as m from documents) d left join labels l using (doc_id)),
g as (select doc_id, prelabel_intent, case when toxic = 1 then 'I10' else prelabel_intent end as final_intent,
  case when doc_id in (1, 3, 5) then 'medium' else 'high' end as intent_confidence, '{review.STATUS}' as annotation_status from f)"""


def final_labels(spark, sf):
    pre = labelled_documents(spark, sf).withColumnRenamed("intent", "prelabel_intent")
    overrides = table(spark, sf, "labels").filter("toxic = 1").select("doc_id", F.lit("I10").alias("label"))
    return review.apply_overrides(pre, overrides, [1, 3, 5], "doc_id")


@query("label_override", FINAL + " select * from g")
def label_override(spark, sf):
    return final_labels(spark, sf)


@query("label_changes", FINAL + " select doc_id, prelabel_intent, final_intent from g where prelabel_intent <> final_intent")
def label_changes(spark, sf):
    return review.label_changes(final_labels(spark, sf)).select("doc_id", "prelabel_intent", "final_intent")


@query("review_queue", f"with {sql.cases()} select case_id, customer_text, support_reply, intent as prelabel_intent, " + ", ".join(
    f"'' as {c}" for c in sinks.REVIEW_COLUMNS) + ", message_id from cases")
def review_queue(spark, sf):
    cases = threads.build_cases(messages(spark, sf), prose.BRAND, prose.POLICY).withColumnRenamed("intent", "prelabel_intent")
    return sinks.review_queue(cases, ["case_id", "customer_text", "support_reply", "prelabel_intent"], last=["message_id"])


@query("human_review", "select doc_id as case_id, text as customer_text, " + ", ".join(f"'' as {c}" for c in review.HUMAN_COLUMNS) + " from documents where doc_id in (select doc_id from labels where quality is not null)")
def human_review(spark, sf):
    cases = documents(spark, sf).select(F.col("doc_id").alias("case_id"), F.col("text").alias("customer_text"))
    judged = table(spark, sf, "labels").select(F.col("doc_id").alias("case_id"), F.col("quality").alias("relevance"))
    return review.human_review(cases, judged, ["case_id", "customer_text"])


ANSWER_K = "cast(json_extract(props, '$.k') as bigint)"


@query("judge_parse", f"""select event_id, case when event_type = 'error' then null else ({ANSWER_K} % 5 + 1)::double end as relevance,
  case when event_type = 'error' then null else (event_id % 5 + 1)::double end as tone,
  case when event_type = 'error' then null else 'YES' end as overall_acceptable,
  case when event_type = 'error' then 'unparsed: {{"relevance": ' || {ANSWER_K} else 'event ' || event_type end as reason from events""")
def judge_parse(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    good = F.format_string(
        ' {"relevance": %d, "tone": %d, "overall_acceptable": "YES", "reason": "event %s"}\n',
        k % 5 + 1, F.col("event_id") % 5 + 1, F.col("event_type"),
    )
    answers = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"relevance": '), k.cast("string"))).otherwise(good).alias("answer"),
    )
    return parsing.parse_judge_answers(answers).select("event_id", "relevance", "tone", "overall_acceptable", "reason")


@query("judge_prompts", PRED + f""" select case_id, {sql.q(parsing.RUBRIC)} || chr(10) || """ + " || chr(10) || ".join(
    f"'{title}: ' || " + (f"case when {name} then 'true' else 'false' end" if name == "should_escalate" else name) for title, name in parsing.PROMPT_PARTS) + " as prompt from predictions")
def judge_prompts(spark, sf):
    return agent_predictions(spark, sf).select("case_id", parsing.judge_prompt().alias("prompt"))


LINE = "'CASE-' || (conv_id * 100 + turn) || '  ' || c || case when intent = 'I12' then '' else ' ' || intent || ' ' || r end || ' '"


@query("parse_cases", f"""with {sql.PAIRS}
select 'CASE-' || replace(reply_id, '-', '0') as case_id, intent <> 'I12' as parsed,
  case when intent <> 'I12' then intent end as prelabel_intent,
  case when intent <> 'I12' then c end as customer_text, case when intent <> 'I12' then r end as support_reply
from (select reply_id, {sql.clean('customer_text', 'squeeze')} as c, {sql.clean('support_reply', 'squeeze')} as r,
        {sql.label_case(prose.RULES, 'm')} as intent from (select *, {sql.clean('customer_text', 'message')} as m from pairs))""")
def parse_cases(spark, sf):
    """Pairs written as annotated text lines and parsed back; lines without a code are rejects."""
    pairs = classify(threads.pair_replies(messages(spark, sf), prose.BRAND), prose.RULES, "customer_text")
    said, replied = (tx.clean(F.col(c), "squeeze") for c in ("customer_text", "support_reply"))
    body = F.when(F.col("intent") == "I12", said).otherwise(F.concat_ws(" ", said, F.col("intent"), replied))
    lines = pairs.select(F.concat(F.lit("CASE-"), F.regexp_replace("reply_id", "-", "0"), F.lit("  "), body, F.lit(" ")).alias("value"))
    path = scratch(spark)
    lines.write.text(path)
    return parsing.parse_case_lines(spark.read.text(path)).select(
        "case_id", "parsed", "prelabel_intent", "customer_text", "support_reply"
    )


@query("csv_roundtrip", f"with {sql.MESSAGES} select message_id, author_id, inbound, created::bigint as created, text, parent_id from messages")
def csv_roundtrip(spark, sf):
    path = scratch(spark)
    sinks.write_csv(messages(spark, sf), path)
    schema = "message_id string, author_id string, inbound boolean, created_at timestamp, text string, parent_id string"
    read = read_table(spark, path, schema)
    return read.withColumn("created", F.unix_seconds("created_at")).drop("created_at")


@query("scan_messages", f"with {sql.MESSAGES} select message_id, author_id, inbound, created::bigint as created, text, parent_id from messages")
def scan_messages(spark, sf):
    """Messages delivered as CSV with weekday-first times and ids that went through a float column."""
    path = scratch(spark)
    sent = messages(spark, sf).select(
        F.concat("message_id", F.lit(".0")).alias("tweet_id"),
        "author_id",
        F.initcap(F.col("inbound").cast("string")).alias("inbound"),
        F.concat(
            F.date_format("created_at", "E MMM dd HH:mm:ss"), F.lit(" "), F.date_format("created_at", "xx yyyy")
        ).alias("created_at"),
        "text",
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.col("parent_id").alias("in_response_to_tweet_id"),
    )
    sinks.write_csv(sent, path)
    read = read_messages(spark, path)
    return read.select(
        "message_id", "author_id", "inbound", F.unix_seconds("created_at").alias("created"), "text", "parent_id"
    )


def through_sheet(spark, df, kind):
    """Written as CSV in another order of columns, then read as a sheet of its kind."""
    path = scratch(spark)
    whole = sheet(df, kind)
    sinks.write_csv(whole.select(*reversed(whole.columns)), path)
    return read_sheet(spark, path, kind)


@query("golden_sheet", FINAL + " select doc_id, prelabel_intent, final_intent, intent_confidence, annotation_status from g")
def golden_sheet(spark, sf):
    golden = through_sheet(spark, final_labels(spark, sf).withColumnRenamed("doc_id", "case_id"), "golden")
    return golden.select(
        F.col("case_id").cast("long").alias("doc_id"), "prelabel_intent", "final_intent", "intent_confidence", "annotation_status"
    )


@query("evidence_sheet", ORACLES["evidence_rates"])
def evidence_sheet(spark, sf):
    """The rates of an annotated sheet that is read back."""
    out = metrics.evidence_rates(through_sheet(spark, judged_evidence(spark, sf), "evidence"))
    return out.select("judgement", *[r6(c).alias(c) for c in ("top1", "top3", "gain")])


@query("prediction_sheet", ORACLES["decision_crosstab"])
def prediction_sheet(spark, sf):
    return metrics.decision_crosstab(through_sheet(spark, agent_predictions(spark, sf), "predictions"))


@query("score_sheet", ORACLES["judge_parse"])
def score_sheet(spark, sf):
    """Parsed answers of a judge, kept as a sheet; a row without scores stays one."""
    scored = QUERIES["judge_parse"](spark, sf).withColumnRenamed("event_id", "case_id")
    read = through_sheet(spark, scored, "scores")
    return read.select(F.col("case_id").cast("long").alias("event_id"), "relevance", "tone", "overall_acceptable", "reason")


STREAM_FILES = 4


@query("stream_pairs", f"with {sql.PAIRS} select * from pairs")
def stream_pairs(spark, sf):
    """Messages delivered in files dealt by a hash, so that replies come before their parents, and
    paired as they arrive."""
    path = scratch(spark)
    sent = messages(spark, sf).select(
        F.col("message_id").alias("tweet_id"),
        "author_id",
        F.col("inbound").cast("string").alias("inbound"),
        F.lit(None).cast("string").alias("created_at"),
        "text",
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.col("parent_id").alias("in_response_to_tweet_id"),
    )
    sinks.write_csv(sent.repartition(STREAM_FILES, F.crc32(F.col("tweet_id").cast("binary")) % STREAM_FILES), f"{path}/in")
    arriving = ingest.arriving_messages(spark, f"{path}/in", 1)
    ingest.start_ingest(arriving, f"{path}/table", f"{path}/state", prose.BRAND).awaitTermination()
    return ingest.MessageTable(spark, f"{path}/table", prose.BRAND).pairs()


# === clusters and models ==========================================================================================


@query("cluster_examples", """with c as (select label, i, avg(x::double) as m from (select label, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by label, i),
d as (select v.label, vec_id, round(sum((x::double - m) * (x::double - m)), 9) as distance from (
  select label, vec_id, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as i from embeddings) v join c using (label, i) group by v.label, vec_id)
select label, place::int as place, vec_id, distance from (
  select *, row_number() over (partition by label order by distance, vec_id) as place from d) where place <= 8""")
def cluster_examples(spark, sf):
    out = learning.cluster_examples(table(spark, sf, "embeddings"), "vec_id", "label", "embedding")
    return out.select("label", "place", "vec_id", "distance")


CLUSTER_SPEC = prose.replace(prose.GLOBAL_SPEC, profile="cluster", min_df=5, max_df=0.9, max_features=10_000, sublinear=False)


@query("cluster_distance", """with c as (select label, i, avg(x::double) as m from (select label, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by label, i)
select v.label, vec_id, round(sum((x::double - m) * (x::double - m)), 6) as distance from (
  select label, vec_id, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as i from embeddings) v join c using (label, i) group by v.label, vec_id""")
def cluster_distance(spark, sf):
    """Squared distance of every vector to the mean of its group, from its own entries."""
    points = table(spark, sf, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("dim", "v"))
    points = points.select("label", "vec_id", "dim", F.col("v").cast("double").alias("x"))
    centres = points.groupBy("label", "dim").agg(F.avg("x").alias("centre"))
    return learning.sparse_distances(points, centres, "label", "vec_id").select(
        "label", "vec_id", r6("distance").alias("distance")
    )


@query("cluster_terms", f"""with c_src as (select 'all' as part, doc_id, text from documents),
{sql.index('c', 'c_src', CLUSTER_SPEC)},
n as (select lang, count(*) as docs from documents group by lang),
m as (select lang, term, round(sum(weight) / any_value(docs), 9) as mean_weight from c_vec join documents using (doc_id) join n using (lang) group by lang, term)
select lang, place::int as place, term, mean_weight from (
  select *, row_number() over (partition by lang order by mean_weight desc, term) as place from m) where place <= 12""")
def cluster_terms(spark, sf):
    docs = documents(spark, sf, "doc_id", "text", "lang").withColumn("part", F.lit("all"))
    index = tfidf.build_index(docs, CLUSTER_SPEC, "doc_id", "text", "part")
    weights = index.entries().select(F.col("case_id").alias("doc_id"), "term", "weight")
    out = learning.cluster_terms(weights, docs.select("doc_id", "lang"), "lang")
    return out.select("lang", "place", "term", "mean_weight")


CLUSTER_INDEX = f"""with c_src as (select 'all' as part, doc_id, text from documents),
{sql.index('c', 'c_src', CLUSTER_SPEC)}"""
CENTRES, RUNS = 4, 2


def assign_sql(name: str, centres: str) -> str:
    return f""",
{name}_norms as (select n.run, n.cluster, coalesce(sum(centre * centre), 0) as norm from numbers n left join {centres} using (run, cluster) group by all),
{name}_dots as (select run, cluster, doc_id, sum(weight * centre) as dot from c_vec join {centres} using (term) group by all),
{name} as (
  select run, doc_id, cluster, coalesce(own, 0) + raw as distance from (
    select n.run, n.cluster, o.doc_id, norm - 2 * coalesce(dot, 0) as raw from {name}_norms n cross join documents o left join {name}_dots using (run, cluster, doc_id))
  left join (select doc_id, sum(weight * weight) as own from c_vec group by doc_id) using (doc_id)
  qualify row_number() over (partition by run, doc_id order by round(raw, 9), cluster) = 1)"""


KMEANS = CLUSTER_INDEX + f""",
numbers as (select run, cluster from (select unnest(range({RUNS}))::int as run), (select unnest(range({CENTRES}))::int as cluster)),
drawn as (
  select run, doc_id, (row_number() over (partition by run order by md5(run || ':' || doc_id || ':42'), doc_id) - 1)::int as cluster
  from documents, (select distinct run from numbers) qualify row_number() over (partition by run order by md5(run || ':' || doc_id || ':42'), doc_id) <= {CENTRES}),
first as (select run, cluster, term, weight as centre from drawn join c_vec using (doc_id))""" + assign_sql("one", "first") + """,
sizes as (select run, cluster, count(*) as n from one group by all),
means as (select run, cluster, term, sum(weight) / any_value(n) as centre from one join c_vec using (doc_id) join sizes using (run, cluster) group by all)""" + assign_sql("two", "means")


def cluster_index(docs):
    return tfidf.build_index(docs.withColumn("part", F.lit("all")), CLUSTER_SPEC, "doc_id", "text", "part")


def cluster_entries(spark, sf):
    """(entries, ids): documents as unit-length TF-IDF vectors."""
    docs = documents(spark, sf)
    index = cluster_index(docs)
    return cut_lineage(index.entries().select(F.col("case_id").alias("id"), "term", "weight")), docs.select(F.col("doc_id").alias("id"))


@query("kmeans_step", KMEANS + " select run, doc_id, cluster, round(distance, 6) as distance from two")
def kmeans_step(spark, sf):
    """Two runs of k-means: drawn centres, one assignment, their means, the next assignment."""
    entries, ids = cluster_entries(spark, sf)
    first = learning.first_centres(entries, ids, CENTRES, RUNS)
    assigned = learning.assign_sparse(entries, ids, cut_lineage(first), CENTRES, RUNS)
    means = cut_lineage(learning.mean_centres(entries, cut_lineage(assigned)))
    out = learning.assign_sparse(entries, ids, means, CENTRES, RUNS)
    return out.select("run", F.col("id").alias("doc_id"), "cluster", r6("distance").alias("distance"))


@query("regression_loss", CLUSTER_INDEX + """,
classes as (select lang, (row_number() over (order by lang) - 1)::int as i from (select distinct lang from documents)),
coefficients as (select lang, term, ((length(term) * (i + 1)) % 5 - 2) / 10.0 as c from (select distinct term from c_vec), classes),
scored as (select doc_id, lang, sum(weight * c) as score from c_vec join coefficients using (term) group by all),
margins as (
  select d.doc_id, d.lang as gold, k.lang, 1 + (d.doc_id % 3) / 2.0 as importance, i / 10.0 + coalesce(score, 0) as margin
  from documents d cross join classes k left join scored s on s.doc_id = d.doc_id and s.lang = k.lang),
likely as (select *, exp(margin) / sum(exp(margin)) over (partition by doc_id) as p from margins),
size as (select sum(importance) as total, sum(-importance * ln(p)) as lost, count(*) as examples from likely where lang = gold),
residuals as (select doc_id, lang, importance * (p - (lang = gold)::int) / total as r from likely, size),
slopes as (select lang, term, sum(r * weight) as slope from residuals join c_vec using (doc_id) group by all),
gradient as (
  select coalesce(slope, 0) + 0.01 * coalesce(c, 0) as g, coalesce(c, 0) as c from slopes full join coefficients using (lang, term)
  union all select sum(r), 0 from residuals group by lang)
select round(any_value(lost / total) + 0.005 * sum(c * c), 6) as loss, round(sqrt(sum(g * g)), 6) as gradient_norm,
  round(max(abs(g)), 6) as gradient_max, any_value(examples)::bigint as examples from gradient, size""")
def regression_loss(spark, sf):
    """Loss and gradient at coefficients given by a rule, over all documents with their language."""
    index = cluster_index(documents(spark, sf))
    entries = cut_lineage(index.packed_cases().withColumnRenamed("case_id", "id"))
    docs = documents(spark, sf, "doc_id", "lang")
    names = sorted(r["lang"] for r in docs.select("lang").distinct().collect())
    classes = spark.createDataFrame([(name, i) for i, name in enumerate(names)], "label string, i int")
    listed = F.array(*[F.struct(F.lit(name).alias("label"), F.lit(i).alias("i")) for i, name in enumerate(names)])
    terms = index.vocab.select("term", F.inline(listed))
    given = terms.select("label", "term", ((F.length("term") * (F.col("i") + 1) % 5 - 2) / 10.0).alias("coefficient"))
    examples = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), (1 + F.col("doc_id") % 3 / 2.0).alias("importance"))
    found = learning.regression_certificate(
        entries, examples, given, classes.select("label", (F.col("i") / 10.0).alias("intercept")), 0.01, index.codebook
    )
    return found.select(*[r6(c).alias(c) for c in ("loss", "gradient_norm", "gradient_max")], "examples")


@query("cluster_messages")
def cluster_messages(spark, sf):
    """k-means over all documents; no SQL equivalent."""
    docs = documents(spark, sf).select("doc_id", "text")
    _, assigned, _ = learning.cluster_messages(docs, "doc_id", "text", stop_words=prose.STOP_WORDS)
    return assigned.select("doc_id", "cluster")


@query("intent_lr")
def intent_lr(spark, sf):
    """Regression on all documents with their language as label, 80/20; no SQL equivalent."""
    docs = documents(spark, sf, "doc_id", "text", "lang")
    split = cut_lineage(sampling.stratified_split(docs, "lang", ["doc_id"]))
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    return learning.train_intent_model(train, test, "doc_id", "text", "lang")[1]


# === streams =======================================================================================================


def arriving_table(spark, sf, name):
    """A table as a stream of its files, be it one file or a folder of them. A plain path would have
    to be a folder; a pattern may be either."""
    return streams.arriving_files(spark, f"{sf}/{name}.parque[t]", table(spark, sf, name).schema)


@query("stream_author_counts", "select user_id, count(*)::bigint as messages from events group by user_id")
def stream_author_counts(spark, sf):
    arriving = arriving_table(spark, sf, "events")
    path = scratch(spark)
    streams.start_counts(streams.running_counts(arriving, "user_id"), path, f"{path}_state").awaitTermination()
    return streams.latest_counts(spark, path, ["user_id"])


@query("stream_triage", f"with {sql.decisions()} {DECIDED}")
def stream_triage(spark, sf):
    cases, index = case_index(spark, sf)
    arriving = arriving_table(spark, sf, "documents").select(
        F.col("doc_id").alias("query_id"), F.col("text").alias("customer_text")
    )
    path = scratch(spark)
    streams.start_triage(arriving, index, cases, prose.POLICY, path, f"{path}_state").awaitTermination()
    return decided_columns(spark.read.parquet(path))
