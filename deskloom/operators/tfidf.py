"""TF-IDF as relations: a vocabulary, one weighted vector per distinct document, members.

All counting is by ``(part, term)``; ``part`` is the intent (or a constant for one global
index). Documents with the same vector share one entry, so a third of the corpus being
copies costs one vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskloom.functions import text as tx
from deskloom.operators import packed as pk
from deskloom.operators.blocks import deal, shards_of
from deskloom.operators.packed import Codebook, unpack
from deskloom.session import cut_lineage

# A vocabulary has at most max_features terms per part. Up to this many rows (some 100 MB) it is
# broadcast; beyond, the joins shuffle and AQE splits frequent terms.
BROADCAST_TERMS = 2_000_000
MAX_PARTS = 10_000
WORDS_AT_ONCE = 500_000  # with their bigrams and places some 100 MB
# Terms are added up in so many buckets that each is of some 8 MB of the texts' table
BUCKET_BYTES = 8 << 20
MOST_BUCKETS = 4_096


def english_stop_words(spark: SparkSession) -> list[str]:
    """Spark's English list. Another list can be passed wherever stop words are taken."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


@dataclass(frozen=True)
class TfidfSpec:
    profile: str = "index"
    n_max: int = 2
    min_df: int = 2
    max_df: float = 1.0
    max_features: int | None = 50_000  # terms per part; None keeps all
    sublinear: bool = True
    stop_words: Sequence[str] = ()
    postings_per_task: int = 200_000


@dataclass(frozen=True)
class TfidfIndex:
    """vocab(part, term, df, idf, salts) · vectors(part, vec_id, vec of (term, weight, df, salts), copies) ·
    members(part, vec_id, case_id) · parts(part, docs).

    ``vec_id`` is the smallest case id with that vector and ``copies`` the number of its cases;
    ``members`` holds every case that has a vector. All tables are written when the index is built;
    with a vocabulary that tasks hold, the vectors are written packed and unpacked where they are read.
    """

    spec: TfidfSpec
    vocab: DataFrame
    vectors: DataFrame
    members: DataFrame
    parts: DataFrame
    vocab_bound: int  # proven upper bound of the vocabulary's rows
    words: DataFrame | None = None  # (part, doc_id, words) of every case, to merge others in
    totals: DataFrame | None = None  # (part, term, df, total) before any limit, if they are kept
    shards: DataFrame | None = None  # as ``blocks.shards_of`` makes them, if they are kept
    salted: DataFrame | None = None  # ``salted_postings`` in buckets, if they are kept
    packed: DataFrame | None = None  # (part, vec_id, copies, n, entries) behind ``vectors``
    book: Codebook | None = None  # what unpacks them

    @property
    def small_vocab(self) -> bool:
        return self.vocab_bound <= BROADCAST_TERMS

    @cached_property
    def codebook(self) -> Codebook:
        return self.book or Codebook(self.vocab, self.spec)

    def sharded(self) -> DataFrame:
        """The shards that searches read: those kept with the index, else made and written now."""
        return self.shards if self.shards is not None else cut_lineage(shards_of(self.vectors))

    def dealt(self) -> DataFrame | None:
        """The packed vectors with their shards, for searches, unless shards are kept."""
        return deal(self.packed, "n") if self.packed is not None and self.shards is None else None

    def sizes(self) -> DataFrame:
        """(part, vec_id, copies)"""
        return (self.vectors if self.packed is None else self.packed).select("part", "vec_id", "copies")

    def salted_postings(self) -> DataFrame:
        """(part, term, salt, vec_id, weight): a term's postings are spread over ``salts`` pieces by
        vector id. Kept in buckets of these keys they are joined without being moved."""
        if self.salted is not None:
            return self.salted
        salt = F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int").alias("salt")
        return self.postings().select("part", "term", salt, "vec_id", "weight")

    def postings(self) -> DataFrame:
        """(part, vec_id, term, weight, salts), one row per entry of a vector."""
        return self.vectors.select(
            "part", "vec_id", F.inline("vec").alias("term", "weight", "df", "salts")
        ).drop("df")

    def packed_cases(self) -> DataFrame:
        """(part, case_id, entries): cases meet the vectors as they are packed."""
        return self.members.join(self.packed.select("part", "vec_id", "entries"), ["part", "vec_id"]).select("part", "case_id", "entries")

    def entries(self) -> DataFrame:
        """(part, case_id, term, weight), one row per entry of a case, made where cases met the vectors."""
        if self.packed is None:
            met = self.members.join(self.vectors.select("part", "vec_id", "vec"), ["part", "vec_id"])
        else:
            met = unpack(self.packed_cases(), self.codebook)
        return met.select("part", "case_id", F.inline("vec").alias("term", "weight", "df", "salts")).drop("df", "salts")


def words_table(docs: DataFrame, spec: TfidfSpec, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, doc_id, words), one row per document, the words in the order of the text."""
    narrowed = docs.select(F.col(part_col).alias("part"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    words = tx.drop_stop_words(tx.tokens(tx.clean(F.col("__text"), spec.profile)), list(spec.stop_words))
    return narrowed.select("part", "doc_id", words.alias("words"))


def term_table(docs: DataFrame, spec: TfidfSpec, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, doc_id, terms), one row per document, terms as an array of (term, tf) in term order."""
    return counted(words_table(docs, spec, id_col, text_col, part_col), spec)


def counted(words: DataFrame, spec: TfidfSpec) -> DataFrame:
    """A term table from the words.

    The counts are made inside the row in linear time from the sorted terms: a term starts where
    its value differs from the one before, and its count is the distance to the next start. So no
    text and no single occurrence is shuffled. The sorted terms are written first: the optimizer
    would inline the tokenising into the lambdas below and evaluate it once per element.
    """
    found = cut_lineage(
        words.select("part", "doc_id", F.array_sort(tx.ngrams(F.col("words"), spec.n_max)).alias("__all"))
    ).filter(F.size("__all") > 0)
    size = F.size("__all")
    places = F.filter(
        F.sequence(F.lit(0), F.greatest(size, F.lit(1))),
        lambda i: (i == 0) | (i >= size) | (F.get("__all", i) != F.get("__all", i - 1)),
    )
    found = found.select("part", "doc_id", "__all", places.alias("__starts"))
    terms = F.zip_with(
        F.slice("__starts", F.lit(1), F.size("__starts") - 1),
        F.slice("__starts", F.lit(2), F.size("__starts") - 1),
        lambda i, j: F.struct(F.get("__all", i).alias("term"), (j - i).cast("long").alias("tf")),
    )
    return found.select("part", "doc_id", terms.alias("terms"))


def term_counts(docs: DataFrame, spec: TfidfSpec, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, doc_id, term, tf)"""
    return exploded(term_table(docs, spec, id_col, text_col, part_col))


def exploded(found: DataFrame) -> DataFrame:
    return found.select("part", "doc_id", F.inline("terms").alias("term", "tf"))


def occurrences(words: pa.ListArray, n_max: int) -> tuple[np.ndarray, pa.Array]:
    """The document number and the term of every word and, for ``n_max`` 2, every bigram."""
    flat = words.flatten()
    doc = np.repeat(np.arange(len(words)), np.asarray(words.value_lengths().fill_null(0)))
    if n_max == 1 or len(flat) < 2:
        return doc, flat
    inside = doc[:-1] == doc[1:]
    mask = pa.array(inside)
    pairs = pc.binary_join_element_wise(flat[:-1].filter(mask), flat[1:].filter(mask), " ")
    return np.concatenate([doc, doc[:-1][inside]]), pa.concat_arrays([flat, pairs])


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut between documents after about WORDS_AT_ONCE words: what a task makes of a piece takes
    many times the space of its words."""
    lengths = np.asarray(batch.column("words").value_lengths().fill_null(0), dtype=np.int64)
    piece = (np.cumsum(lengths) - lengths) // WORDS_AT_ONCE
    starts = np.flatnonzero(np.diff(piece, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], len(lengths)]):
        yield batch.slice(start, end - start)


def _by_part(batch: pa.RecordBatch) -> Iterator[tuple[object, pa.RecordBatch]]:
    """The rows of each part, a piece of the batch at a time; rows without a part belong to none."""
    for piece in pieces(batch):
        codes = piece.column("part").dictionary_encode()
        for code, part in enumerate(codes.dictionary.to_pylist()):
            yield part, piece.filter(pc.equal(codes.indices, code))


def bucket_count(df: DataFrame) -> int:
    """Over how many tasks the terms of ``df`` are added up, by the size of the table it comes from."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >> 50:  # not known
        return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return min(MOST_BUCKETS, max(8, -(-size // BUCKET_BYTES)))


def count_terms(words: DataFrame, spec: TfidfSpec, with_rows: bool = False, least: int = 1) -> DataFrame:
    """(part, term, df, total): documents with the term and its occurrences, of terms in at least
    ``least`` documents. Words are counted where they were read; a task sends the terms of a bucket
    as one compressed text in order, with their counts. ``with_rows`` adds a row without a term that
    holds the number of documents."""
    kind, buckets = words.schema["part"].dataType.simpleString(), bucket_count(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows in _by_part(batch):
                doc, terms = occurrences(rows.column("words"), spec.n_max)
                coded = terms.dictionary_encode()
                code = np.asarray(coded.indices, dtype=np.int64)
                names, n = coded.dictionary, len(coded.dictionary)
                once = np.unique(doc * n + code) % max(n, 1)
                df, total = (np.bincount(x, minlength=n) for x in (once, code))
                sent = [(-1, 0, b"", b"", rows.num_rows)] if with_rows else []
                for bucket, at in pk.sorted_terms(names, pk.buckets_of(names, buckets)):
                    counts = pk.varints(np.concatenate([df[at], total[at]]))[0]
                    sent.append((bucket, len(at), pk.squeezed(pk.text_of(names.take(pa.array(at)))), pk.squeezed(counts), 0))
                columns = zip(*sent) if sent else [()] * 5
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(sent), batch.column("part").type), *arrays], ["part", "bucket", "n", "terms", "counts", "rows"]
                )

    def add(held: pa.Table) -> pa.Table:
        codes = held["part"].combine_chunks().dictionary_encode()
        out = []
        for code, part in enumerate(codes.dictionary.to_pylist()):
            own = held.filter(pc.equal(codes.indices, code))
            docs = pc.sum(own["rows"]).as_py()
            names, df, total = [pa.array([], pa.string())], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for n, terms, counts in zip(*(own[c].to_pylist() for c in ("n", "terms", "counts"))):
                if n:
                    names.append(pk.terms_of(pk.whole(terms), n))
                    found = pk.numbers(np.frombuffer(pk.whole(counts), np.uint8))[0]
                    df.append(found[:n])
                    total.append(found[n:])
            coded = pa.concat_arrays(names).dictionary_encode()
            at, size = np.asarray(coded.indices), len(coded.dictionary)
            df, total = (np.bincount(at, np.concatenate(x), size).astype(np.int64) for x in (df, total))
            kept = np.flatnonzero(df >= least)
            columns = [[part] * len(kept), coded.dictionary.take(pa.array(kept)), df[kept], total[kept]]
            if docs:
                columns = [[part], pa.array([None], pa.string()), [docs], [docs]]
            out.append(pa.table([pa.array(c, k) if not isinstance(c, pa.Array) else c for c, k in zip(columns, (held.schema.field("part").type, pa.string(), pa.int64(), pa.int64()))], ["part", "term", "df", "total"]))
        return pa.concat_tables(out)

    sent = words.select("part", "words").mapInArrow(count, f"part {kind}, bucket int, n int, terms binary, counts binary, rows bigint")
    return sent.groupBy("bucket").applyInArrow(add, f"part {kind}, term string, df bigint, total bigint")


def most_frequent(terms: DataFrame, cap: int, lead: int = 3) -> DataFrame:
    """The ``cap`` terms of each part with the highest ``total``, ties to the smaller term, without
    ranking a vocabulary.

    A histogram of the totals says where the cap falls. Terms above that level are in; of those on
    it, a histogram of their first ``lead`` characters says which are in, and only the terms of the
    one group that the cap cuts are put in order.
    """
    spark, kind = terms.sparkSession, terms.schema["part"].dataType.simpleString()

    def edge(df: DataFrame, level: str, order: Column, room: Column) -> DataFrame:
        """(part, level, room): the first level at which more than ``room`` rows have come, and what
        is left for it. At most one row per part that has more terms than the cap."""
        counts = df.groupBy("part", level).agg(F.count(F.lit(1)).alias("n"), F.first(room).alias("most"))
        upto = F.sum("n").over(Window.partitionBy("part").orderBy(order)).alias("upto")
        running = counts.select("part", level, "n", "most", upto)
        cut = running.filter((F.col("upto") > F.col("most")) & (F.col("upto") - F.col("n") <= F.col("most")))
        found = cut.select("part", level, F.col("most") - F.col("upto") + F.col("n")).collect()
        return spark.createDataFrame(found, f"part {kind}, {level}_edge {df.schema[level].dataType.simpleString()}, {level}_room long")

    edges = edge(terms, "total", F.col("total").desc(), F.lit(cap))
    if edges.isEmpty():
        return terms
    marked = terms.join(F.broadcast(edges), "part", "left").withColumn(
        "start", F.when(F.col("total") == F.col("total_edge"), F.substring("term", 1, lead))
    )
    starts = edge(marked.filter("start IS NOT NULL"), "start", F.col("start"), F.col("total_room"))
    placed = marked.join(F.broadcast(starts), "part", "left")
    above = F.col("total_edge").isNull() | (F.col("total") > F.col("total_edge"))
    before = F.col("start") < F.col("start_edge")
    sure = placed.filter(above | before)
    place = F.row_number().over(Window.partitionBy("part").orderBy("term"))
    group = placed.filter(F.col("start") == F.col("start_edge")).withColumn("place", place)
    last = group.filter(F.col("place") <= F.col("start_room")).drop("place")
    return sure.unionByName(last).select(*terms.columns)


def build_vocab(totals: DataFrame, parts: DataFrame, spec: TfidfSpec) -> DataFrame:
    """Terms that pass the frequency limits, at most ``max_features`` per part by total count, from
    (part, term, df, total)."""
    sized = totals.filter(F.col("df") >= spec.min_df).join(F.broadcast(parts), "part")  # at most MAX_PARTS rows
    if spec.max_df < 1.0:
        sized = sized.filter(F.col("df") <= F.floor(F.lit(spec.max_df) * F.col("docs")))
    kept = sized if spec.max_features is None else most_frequent(cut_lineage(sized), spec.max_features)
    return kept.select(
        "part",
        "term",
        "df",
        (F.log((F.lit(1.0) + F.col("docs")) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"),
        F.ceil(F.col("df") / F.lit(spec.postings_per_task)).cast("int").alias("salts"),
    )


def unit_vectors(words: pa.ListArray, terms: pa.Array, idf: np.ndarray, n_max: int) -> Iterator[pa.StructArray]:
    """The rows of ``words`` as unit-length vectors over ``terms`` in the layout of Spark's sparse vector,
    a piece at a time; a row without a known term is the zero vector."""
    size = len(terms)
    for piece in pieces(pa.RecordBatch.from_arrays([words], ["words"])):
        rows = piece.num_rows
        doc, found = occurrences(piece.column("words"), n_max)
        places = pc.index_in(found, value_set=terms)
        known = np.asarray(places.is_valid())
        pairs, tf = np.unique(doc[known] * size + np.asarray(places.drop_null(), dtype=np.int64), return_counts=True)
        doc, place = pairs // size, pairs % size
        raw = tf * idf[place]
        norms = np.sqrt(np.bincount(doc, weights=raw * raw, minlength=rows))
        ends = pa.array(np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32))
        yield pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(rows, np.int8)),
                pa.array(np.full(rows, size, np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(raw / norms[doc])),
            ],
            ["type", "size", "indices", "values"],
        )


def weigh(words: DataFrame, vocab: DataFrame, small_vocab: bool, spec: TfidfSpec) -> DataFrame:
    """(part, doc_id, key, vec): unit-length vectors as arrays of (term, weight, df, salts)
    sorted by term, from the words. Documents without any known term are absent.

    A vocabulary of proven size goes to every task, and a document is counted, weighed and scaled
    where its row is: nothing is exploded, shuffled or gathered. A larger vocabulary is joined by a
    shuffle of the terms.
    """
    if not small_vocab:
        return _weigh_by_join(counted(words, spec), vocab, spec)
    return unpack(pack(words, book := Codebook(vocab, spec)).drop("n", "postings"), book)


def pack(words: DataFrame, book: Codebook) -> DataFrame:
    """(part, doc_id, n, postings, entries, key): the vectors of the words, packed. ``n`` is the number of
    their terms and ``postings`` that of the documents that have one of them, once for each; the key is a
    128-bit identity of the vector within its part. Documents without any known term are absent."""
    spec = book.spec

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = book.spans()
        for batch in batches:
            for part, rows in _by_part(batch):
                if part in spans:
                    yield packed(part, rows, spans[part])

    def packed(part: object, rows: pa.RecordBatch, vocab: pa.Table) -> pa.RecordBatch:
        doc, terms = occurrences(rows.column("words"), spec.n_max)
        places = pc.index_in(terms, value_set=vocab["term"].chunk(0) if vocab.num_rows else pa.array([], pa.string()))
        there = np.asarray(places.is_valid())
        place = np.asarray(places.drop_null(), dtype=np.int64)
        size = max(vocab.num_rows, 1)
        pairs, tf = np.unique(doc[there] * size + place, return_counts=True)
        owners, doc = np.unique(pairs // size, return_inverse=True)
        entries = pk.pack_entries(doc, pairs % size, tf, len(owners))
        postings = np.bincount(doc, np.asarray(vocab["df"])[pairs % size], len(owners)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(owners), rows.column("part").type),
                rows.column("doc_id").take(pa.array(owners)),
                pa.array(np.bincount(doc, minlength=len(owners)).astype(np.int32)),
                pa.array(postings),
                entries,
                pa.array([hashlib.md5(x).hexdigest() for x in entries.to_pylist()], pa.string()),
            ],
            ["part", "doc_id", "n", "postings", "entries", "key"],
        )

    part_kind, id_kind = (words.schema[c].dataType.simpleString() for c in ("part", "doc_id"))
    return words.mapInArrow(run, f"part {part_kind}, doc_id {id_kind}, n int, postings bigint, entries binary, key string")


def _weigh_by_join(found: DataFrame, vocab: DataFrame, spec: TfidfSpec) -> DataFrame:
    counts = exploded(found).join(vocab, ["part", "term"])
    tf = (F.lit(1.0) + F.log(F.col("tf"))) if spec.sublinear else F.col("tf").cast("double")
    # the norm is an aggregate: computed inside the row it would be inlined into the lambda
    # below and evaluated once per term
    gathered = (
        counts.select("part", "doc_id", "term", "df", "salts", (tf * F.col("idf")).alias("raw"))
        .groupBy("doc_id", "part")
        .agg(
            F.array_sort(F.collect_list(F.struct("term", "raw", "df", "salts"))).alias("entries"),
            F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"),
        )
    )
    vec = F.transform(
        "entries",
        lambda x: F.struct(
            x["term"].alias("term"),
            (x["raw"] / F.col("norm")).alias("weight"),
            x["df"].alias("df"),
            x["salts"].alias("salts"),
        ),
    )
    return gathered.select("part", "doc_id", vec.alias("vec"), vector_key(F.col("entries")).alias("key"))


def vector_key(entries: F.Column) -> F.Column:
    """128-bit identity of a vector within its part, from terms and unscaled weights."""
    return F.md5(
        F.array_join(F.transform(entries, lambda x: F.concat(x["term"], F.lit("\t"), x["raw"].cast("string"))), "\n")
    )


def part_sizes(df: DataFrame, part_col: str) -> tuple[DataFrame, int]:
    """parts(part, docs) and their number, refused beyond MAX_PARTS: a table of proven size."""
    sizes = (
        df.groupBy(F.col(part_col).alias("part")).agg(F.count(F.lit(1)).alias("docs")).limit(MAX_PARTS + 1).collect()
    )
    if len(sizes) > MAX_PARTS:
        raise ValueError(f"more than {MAX_PARTS} values in {part_col}; route by a column with fewer")
    part_type = df.schema[part_col].dataType.simpleString()
    return df.sparkSession.createDataFrame(sizes, f"part {part_type}, docs long"), len(sizes)


def build_index(
    cases: DataFrame, spec: TfidfSpec, id_col: str = "case_id", text_col: str = "customer_text", part_col: str = "intent"
) -> TfidfIndex:
    """Index the cases: texts are tokenised in one pass, and every table of the index is written
    to the checkpoint folder; use ``deskloom.sources.index_store`` to keep it for other sessions."""
    words = cut_lineage(words_table(cases, spec, id_col, text_col, part_col))
    return index_words(words, count_terms(words, spec, least=spec.min_df), spec)


def index_words(words: DataFrame, totals: DataFrame, spec: TfidfSpec) -> TfidfIndex:
    """The index of (part, doc_id, words) with the given (part, term, df, total)."""
    parts, n_parts = part_sizes(words, "part")
    vocab = cut_lineage(build_vocab(totals, parts, spec))
    bound = vocab.count() if spec.max_features is None else spec.max_features * n_parts
    base = {"spec": spec, "vocab": vocab, "parts": parts, "vocab_bound": bound, "words": words}
    if bound > BROADCAST_TERMS:
        vectors, members = _distinct_vectors(cut_lineage(weigh(words, vocab, False, spec)), ["vec"])
        return TfidfIndex(vectors=vectors.select("part", "vec_id", "vec", "copies"), members=members, **base)
    book = Codebook(vocab, spec)
    vectors, members = _distinct_vectors(cut_lineage(pack(words, book).drop("postings")), ["n", "entries"])
    packed = vectors.select("part", "vec_id", "copies", "n", "entries")
    unpacked = unpack(packed.drop("n"), book).select("part", "vec_id", "vec", "copies")
    return TfidfIndex(vectors=unpacked, members=members, packed=packed, book=book, **base)


def _distinct_vectors(weighed: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(part, key, vec_id, columns, copies) of each vector, and its members; both are written."""
    vectors = cut_lineage(
        weighed.groupBy("part", "key").agg(
            F.min("doc_id").alias("vec_id"), *[F.first(c).alias(c) for c in columns], F.count(F.lit(1)).alias("copies")
        )
    )
    members = weighed.select("part", "key", F.col("doc_id").alias("case_id")).join(
        vectors.select("part", "key", "vec_id"), ["part", "key"]
    )
    return vectors, cut_lineage(members.select("part", "vec_id", "case_id"))


def all_totals(index: TfidfIndex) -> DataFrame:
    """(part, term, df, total) of every term that a case of the index has."""
    return index.totals if index.totals is not None else count_terms(index.words, index.spec)


def merge_cases(
    index: TfidfIndex, cases: DataFrame, id_col: str = "case_id", text_col: str = "customer_text", part_col: str = "intent"
) -> TfidfIndex:
    """The index of the old and the new cases: what ``build_index`` makes of both together. Only the
    new texts are tokenised and counted; their counts are added to those of the old ones, so every
    frequency is right, and all words are weighed anew. A case whose id the index has must not come
    again."""
    if index.words is None:
        raise ValueError("the index was kept without its words; build it anew")
    added = cut_lineage(words_table(cases, index.spec, id_col, text_col, part_col))
    both = all_totals(index).unionByName(count_terms(added, index.spec))
    totals = both.groupBy("part", "term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    return index_words(cut_lineage(index.words.unionByName(added)), totals, index.spec)


def _long_enough(queries: DataFrame, text_col: str, spec: TfidfSpec, min_chars: int) -> DataFrame:
    return queries.filter(F.length(tx.clean(F.col(text_col), spec.profile)) >= min_chars) if min_chars > 0 else queries


def pack_queries(
    queries: DataFrame, index: TfidfIndex, id_col: str, text_col: str, part_col: str, min_chars: int = 0
) -> tuple[DataFrame, DataFrame, int]:
    """As ``weigh_queries``, with the vectors packed: (part, doc_id, n, postings, entries, key), written."""
    words = words_table(_long_enough(queries, text_col, index.spec, min_chars), index.spec, id_col, text_col, part_col)
    packed = cut_lineage(pack(words, index.codebook))
    owners = packed.select(F.col("doc_id").alias("query_id"), "part", F.col("key").alias("q_key"))
    return packed, owners, packed.agg(F.sum("postings")).first()[0] or 0


def weigh_queries(
    queries: DataFrame, index: TfidfIndex, id_col: str, text_col: str, part_col: str, min_chars: int = 0
) -> tuple[DataFrame, DataFrame, int]:
    """Queries in the index's space; those with fewer than ``min_chars`` cleaned characters ask nothing.

    Returns ``(weighed, owners, postings)``: weighed(part, doc_id, vec, key) once per query,
    owners(query_id, part, q_key) to bring results back to queries, and an upper bound of
    the (query vector, case, term) rows a plain join would make.
    """
    if index.small_vocab:
        packed, owners, postings = pack_queries(queries, index, id_col, text_col, part_col, min_chars)
        return unpack(packed.drop("n", "postings"), index.codebook), owners, postings
    words = words_table(_long_enough(queries, text_col, index.spec, min_chars), index.spec, id_col, text_col, part_col)
    weighed = cut_lineage(weigh(words, index.vocab, False, index.spec))
    owners = weighed.select(F.col("doc_id").alias("query_id"), "part", F.col("key").alias("q_key"))
    per_query = F.aggregate("vec", F.lit(0).cast("long"), lambda acc, x: acc + x["df"])
    postings = weighed.agg(F.sum(per_query)).first()[0] or 0
    return weighed, owners, postings


def distinct_queries(weighed: DataFrame) -> DataFrame:
    """(part, q_key, vec), once per distinct query vector."""
    return weighed.groupBy("part", F.col("key").alias("q_key")).agg(F.first("vec").alias("vec"))


def vectorize_queries(
    queries: DataFrame, index: TfidfIndex, id_col: str, text_col: str, part_col: str, min_chars: int = 0
) -> tuple[DataFrame, DataFrame, int]:
    """``weigh_queries`` with distinct(part, q_key, vec) in place of the weighed queries."""
    weighed, owners, postings = weigh_queries(queries, index, id_col, text_col, part_col, min_chars)
    return distinct_queries(weighed), owners, postings


def document_frequency(docs: DataFrame, spec: TfidfSpec, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, docs, term, df) before any frequency limit."""
    parts, _ = part_sizes(docs, part_col)
    totals = count_terms(words_table(docs, spec, id_col, text_col, part_col), spec)
    return totals.select("part", "term", "df").join(F.broadcast(parts), "part")
