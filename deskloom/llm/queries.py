"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.llm.common import table
from deskloom.llm.ctph import neighbour_fingerprints
from deskloom.llm.exact_dedup import exact_duplicates
from deskloom.llm.hard_negatives import hard_negatives
from deskloom.llm.mixing import DomainModel, document_rates, fit_domains
from deskloom.llm.mtree import top_k
from deskloom.llm.ngram_join import ngram_components
from deskloom.llm.packing import pack_documents
from deskloom.llm.pii import BASE, find_personal_data
from deskloom.llm.preference import CLOSE, conversations, preference_pairs
from deskloom.llm.sharding import shard_documents
from deskloom.llm.toxicity import REJECT, Scorer, fit, score_documents
from deskloom.llm.turn_repair import repair_conversations
from deskloom.llm.url_filter import judge_urls

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def held_out() -> F.Column:
    """Rows whose labels must not be learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def toxicity_scorer(spark: SparkSession, sf_dir: str) -> Scorer:
    return fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), toxicity_scorer(spark, sf_dir))
    predicted = (F.col("score") >= REJECT).cast("int").alias("predicted")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@query
def op3_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is chosen; rejected is the same conversation with the answer that the next
    conversation number ends on. So every conversation makes one pair and its own turns up to its
    last answer are common. Spans are joined to strings of start:end."""
    whole = conversations(table(spark, sf_dir, "conversations"))
    answers = F.filter("turns", lambda t: t["role"] == "assistant")
    other = whole.select(
        (F.col("conv_id") - 1).alias("conv_id"), F.try_element_at(answers, F.lit(-1)).alias("answer")
    )
    place = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i).otherwise(-1)))
    worse = F.when(
        (F.col("place") >= 0) & F.col("answer").isNotNull(),
        F.concat(F.slice("turns", F.lit(1), F.col("place")), F.array("answer")),
    ).otherwise(F.col("turns"))
    pairs = (
        whole.join(other, "conv_id", "left")
        .withColumn("place", place)
        .select("conv_id", F.col("turns").alias("chosen"), worse.alias("rejected"))
    )
    made = preference_pairs(pairs)
    for side in ("chosen_spans", "rejected_spans"):
        joined = F.transform(side, lambda s: F.concat_ws(":", s["start"], s["end"]))
        made = made.withColumn(side, F.array_join(joined, ","))
    return made.withColumn("n_common", F.col("n_common").cast("long"))


def _preference_sql() -> str:
    shown = "'<|' || coalesce(t.role, '') || '|>\n' || coalesce(t.text, '') || '<|end|>\n'".replace("\n", "' || chr(10) || '")

    def side(number: str, turns: str, out: str) -> str:
        return f"""
{out}_turns AS (
    SELECT p.conv_id, x.place, x.t, length({shown}) AS size, {shown} AS shown
    FROM pairs p, LATERAL (SELECT unnest({turns}) AS t, unnest(range(len({turns}))) AS place) x
    WHERE x.place >= p.{number}
), {out}_at AS (
    SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM {out}_turns
), {out} AS (
    SELECT a.conv_id, string_agg(a.shown, '' ORDER BY a.place) AS body,
        string_agg((m.prompt_size + a.upto - length(coalesce(a.t.text, '')) - {len(CLOSE)})::BIGINT || ':' || (m.prompt_size + a.upto)::BIGINT, ','
            ORDER BY a.place) FILTER (WHERE a.t.role = 'assistant') AS spans
    FROM {out}_at a JOIN prompts m USING (conv_id) GROUP BY a.conv_id
)"""

    return f"""
WITH whole AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), last AS (
    SELECT *, len(turns) - list_position(list_reverse(list_transform(turns, lambda t: t.role)), 'assistant') AS place FROM whole
), both_sides AS (
    SELECT l.conv_id, l.turns AS chosen, l.place,
        CASE WHEN l.place IS NOT NULL AND o.place IS NOT NULL
            THEN list_concat(l.turns[1:l.place], [o.turns[o.place + 1]]) ELSE l.turns END AS rejected
    FROM last l LEFT JOIN last o ON o.conv_id = l.conv_id + 1
), matched AS (
    SELECT *, coalesce(list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1),
        lambda i: chosen[i] IS DISTINCT FROM rejected[i])) - 1, least(len(chosen), len(rejected))) AS same
    FROM both_sides
), pairs AS (
    SELECT conv_id, chosen, rejected,
        CASE WHEN same = len(chosen) AND same = len(rejected) AND place IS NOT NULL THEN place ELSE same END AS n_common
    FROM matched
), prompts AS (
    SELECT p.conv_id, coalesce(string_agg({shown}, '' ORDER BY x.place), '') AS prompt,
        coalesce(sum(length({shown})), 0)::BIGINT AS prompt_size
    FROM pairs p LEFT JOIN LATERAL (SELECT unnest(chosen) AS t, unnest(range(len(chosen))) AS place) x ON x.place < p.n_common
    GROUP BY p.conv_id
), {side('n_common', 'chosen', 'c')}, {side('n_common', 'rejected', 'r')}
SELECT p.conv_id, p.n_common::BIGINT AS n_common, m.prompt, coalesce(c.body, '') AS chosen_text,
    coalesce(r.body, '') AS rejected_text, coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM pairs p JOIN prompts m USING (conv_id) LEFT JOIN c USING (conv_id) LEFT JOIN r USING (conv_id)"""


ORACLES["op3_preference"] = _preference_sql()


# fixed values: the rules that every page url is held against
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def _url_sql() -> str:
    fits = "\n".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v}:{h}{p}'"
        for h, p, v in sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    )
    return f"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), judged AS (SELECT *, CASE {fits} END AS fit FROM parts)
SELECT page_id, host, path, substr(fit, strpos(fit, ':') + 1) AS rule,
    CASE WHEN fit IS NULL THEN 'allow' ELSE substr(fit, 1, strpos(fit, ':') - 1) END AS verdict
FROM judged"""


ORACLES["op4_url_filter"] = _url_sql()


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


ORACLES["op5_ngram_jaccard"] = """
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), grams AS (
    SELECT doc_id, unnest(list_distinct(CASE
        WHEN len(words) = 0 THEN []::VARCHAR[]
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS gram
    FROM worded
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
    FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * same >= 75 * (x.n + y.n - same)
), edges AS (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT e.v, r.other FROM reached r JOIN edges e ON e.u = r.doc_id
)
SELECT r.doc_id, coalesce(max(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id"""


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    joined = F.zip_with(
        "kinds", F.arrays_zip("starts", "ends"), lambda k, s: F.concat_ws(":", k, s["starts"], s["ends"])
    )
    base = F.filter("named", lambda s: F.substring_index(s, ":", 1).isin(*BASE))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.withColumn("named", joined).select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", "named").alias("spans"),
    )


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


#: The share of the tokens that each domain, a language and a quality mark, is to have.
MIX = {
    "en/1": 0.42, "en/0": 0.06, "de/1": 0.14, "de/0": 0.03, "fr/1": 0.14, "fr/0": 0.03, "es/1": 0.15, "es/0": 0.03,
}


def domain_model(spark: SparkSession, sf_dir: str) -> DomainModel:
    documents = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = marks.join(documents.select("doc_id", "lang"), "doc_id")
    labelled = labelled.select("doc_id", F.concat_ws("/", "lang", "quality").alias("domain"))
    return fit_domains(documents, labelled, sorted(MIX))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_rates(table(spark, sf_dir, "documents"), domain_model(spark, sf_dir), MIX)


def asked() -> F.Column:
    """The rows that searches and minings start from."""
    return F.col("vec_id") % 100 == 0


@query
def op11_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), asked(), k=10, scale=1024)


# SQL for the rows of embeddings that take part, with integer components
WHOLE_VECTORS = """
whole AS (
    SELECT DISTINCT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""

ORACLES["op11_mtree_search"] = f"""
WITH {WHOLE_VECTORS.format(scale=1024).strip()}, scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
    FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
FROM scored WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 10"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), asked(), scale=256)


ORACLES["op12_hard_negatives"] = f"""
WITH {WHOLE_VECTORS.format(scale=256).strip()}, marked AS (
    SELECT vec_id, vec, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM whole WHERE label IS NOT NULL
), scored AS (
    SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_dot_product(q.vec, c.vec)::BIGINT AS score
    FROM marked q JOIN marked c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), fitting AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
FROM fitting WHERE place <= 10"""


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by a checksum of conversation and turn number: a
    dropped turn (``present`` is false), an empty text, a text without closing marks, a repeated
    turn (``again``), a turn given to the user. Nulls are read as one space."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    spoilt = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 0, F.lit("")).otherwise(spoilt).alias("text"),
        (fault != 0).alias("present"),
        F.explode(copies).alias("again"),
    )


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged(table(spark, sf_dir, "conversations"))
    repaired = repair_conversations(turns, again_col="again", present_col="present")
    said = F.array_join(F.transform("repaired", lambda t: F.concat_ws(":", t["role"], t["text"])), "\n")
    return repaired.withColumn("repaired_sha256", F.sha2(said, 256)).drop("repaired")
