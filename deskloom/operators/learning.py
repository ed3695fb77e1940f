"""Learned models on TF-IDF features, through Spark's own distributed estimators."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.functions import text as tx
from deskloom.operators import packed as pk
from deskloom.operators.packed import Codebook, unpack
from deskloom.operators.skew import lookup_join, top_within
from deskloom.operators.tfidf import (
    TfidfSpec, bucket_count, build_vocab, count_terms, most_frequent, occurrences, part_sizes, pieces, unit_vectors, words_table,
)
from deskloom.operators.wide_regression import WideRegression, fit_wide
from deskloom.session import checkpoint_dir, cut_lineage

ONE = "all"
# Spark's estimator keeps some twenty vectors of all coefficients on the driver: 160 MB for these
DRIVER_COEFFICIENTS = 1_000_000
BROADCAST_COEFFICIENTS = 1_000_000  # some 50 MB


def sparse_features(
    docs: DataFrame, fitted_on: DataFrame, spec: TfidfSpec, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, int]:
    """(id, features), the vocabulary and the width."""
    plain, vocab, width, path = feature_table(docs, fitted_on, spec, id_col, text_col)
    return as_vectors(plain, path), vocab, width


def as_vectors(plain: DataFrame, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """The table that ``feature_table`` wrote to ``path``, with ML vectors as features."""
    schema = T.StructType([*[plain.schema[c] for c in ("doc_id", *extra)], T.StructField("features", VectorUDT())])
    return plain.sparkSession.read.schema(schema).parquet(path)


def feature_table(
    docs: DataFrame, fitted_on: DataFrame, spec: TfidfSpec, id_col: str, text_col: str, extra: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, int, str]:
    """(n, id, extra, features), the vocabulary, the width and the path; ``n`` numbers the rows.

    No vocabulary is held by a task. A piece of the documents sends its terms to the buckets of their
    hash, as one compressed text with the documents and counts of each; a bucket returns those it
    knows as positions and document frequencies, and the piece's documents are put together again. The
    vectors have the layout of Spark's sparse vector and are written once; reading the table back with
    that type gives ML features without a Python row.
    """
    spark = docs.sparkSession
    train = fitted_on.withColumn("__part", F.lit(ONE))
    parts = cut_lineage(train.groupBy(F.col("__part").alias("part")).agg(F.count(F.lit(1)).alias("docs")))
    counted = count_terms(words_table(train, spec, id_col, text_col, "__part"), spec, least=spec.min_df)
    words = tx.drop_stop_words(tx.tokens(tx.clean(F.col(text_col), spec.profile)), list(spec.stop_words)).alias("words")
    rows = docs.select(F.col(id_col).alias("doc_id"), *extra, words)
    buckets = bucket_count(rows)
    vocab = build_vocab(counted, parts, spec).select("part", "term", "df", "idf")

    def with_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("bucket", pa.array(pk.buckets_of(batch.column("term"), buckets), pa.int32()))

    vocab = cut_lineage(vocab.mapInArrow(with_bucket, "part string, term string, df bigint, idf double, bucket int"))
    sizes = {r["bucket"]: r["count"] for r in vocab.groupBy("bucket").count().collect()}  # at most MOST_BUCKETS rows
    before = dict(zip(sorted(sizes), np.cumsum([0, *[sizes[b] for b in sorted(sizes)]]).tolist()))
    width, n_docs = sum(sizes.values()), float((parts.first() or {"docs": 0})["docs"])
    held = [f.name for f in rows.schema if f.name != "words"]
    lists = ", ".join(f"{c} array<{rows.schema[c].dataType.simpleString()}>" for c in held)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 32
        for batch in batches:
            for own in pieces(batch):
                # the documents go along with one of the buckets
                heads = {c: pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), own.column(c)) for c in held}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([piece % buckets], pa.int32()), pa.array([piece]), pa.array([0], pa.int32()), pa.array([b""]), pa.array([b""]), *heads.values()],
                    ["bucket", "piece", "n", "terms", "counts", *held],
                )
                doc, terms = occurrences(own.column("words"), spec.n_max)
                coded = terms.dictionary_encode()
                names, code = coded.dictionary, np.asarray(coded.indices, dtype=np.int64)
                pairs, tf = np.unique(code * own.num_rows + doc, return_counts=True)
                doc, starts = pairs % own.num_rows, np.searchsorted(pairs // own.num_rows, np.arange(len(names) + 1))
                sent = []
                for bucket, at in pk.sorted_terms(names, pk.buckets_of(names, buckets)):
                    some = starts[at + 1] - starts[at]
                    ends = np.cumsum(some)
                    where = np.repeat(starts[at] - (ends - some), some) + np.arange(ends[-1])
                    counts = pk.varints(np.concatenate([some, doc[where], tf[where]]))[0]
                    sent.append((bucket, piece, len(at), pk.squeezed(pk.text_of(names.take(pa.array(at)))), pk.squeezed(counts)))
                columns = zip(*sent) if sent else [()] * 5
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, k) for c, k in zip(columns, kinds)], *[pa.nulls(len(sent), h.type) for h in heads.values()]],
                    ["bucket", "piece", "n", "terms", "counts", *held],
                )
                piece += 1

    def know(sent: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("term").combine_chunks()
        names = known["term"].chunk(0) if known.num_rows else pa.array([], pa.string())
        df, found = np.asarray(known["df"]), []
        for n, terms, counts in zip(*(sent[c].to_pylist() for c in ("n", "terms", "counts"))):
            places = pc.index_in(pk.terms_of(pk.whole(terms), n), value_set=names) if n else pa.array([], pa.int32())
            there = np.asarray(places.is_valid())
            if not there.any():
                found.append((0, b""))
                continue
            numbers = pk.numbers(np.frombuffer(pk.whole(counts), np.uint8))[0]
            some, entries = numbers[:n], numbers[n:].reshape(2, -1)[:, np.repeat(there, numbers[:n])]
            place = np.asarray(places.drop_null(), dtype=np.int64)  # rising, as both sides are in order
            data = pk.varints(np.concatenate([np.diff(place, prepend=0), some[there], df[place], *entries]))[0]
            found.append((len(place), pk.squeezed(data)))
        kept = np.array([bool(m) or head for (m, _), head in zip(found, np.asarray(sent[held[0]].is_valid()).tolist())], bool)
        out = sent.drop_columns(["terms", "counts"]).set_column(2, "n", pa.array([m for m, _ in found], pa.int32()))
        return out.append_column("entries", pa.array([x for _, x in found], pa.binary())).filter(pa.array(kept))

    def gather(piece: pa.Table) -> pa.Table:
        head = piece.filter(piece[held[0]].is_valid()).combine_chunks()
        columns = {c: head[c].chunk(0).flatten() for c in held}
        count = len(columns[held[0]])
        doc, position, raw = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for bucket, m, entries in zip(*(piece[c].to_pylist() for c in ("bucket", "n", "entries"))):
            if m:
                numbers = pk.numbers(np.frombuffer(pk.whole(entries), np.uint8))[0]
                some, (owners, tf) = numbers[m : 2 * m], numbers[3 * m :].reshape(2, -1)
                idf = np.log((1.0 + n_docs) / (1.0 + numbers[2 * m : 3 * m])) + 1.0
                doc.append(owners)
                position.append(np.repeat(before[bucket] + np.cumsum(numbers[:m]), some))
                raw.append((1.0 + np.log(tf) if spec.sublinear else tf.astype(float)) * np.repeat(idf, some))
        doc, position, raw = map(np.concatenate, (doc, position, raw))
        order = np.lexsort((position, doc))
        doc, position, raw = doc[order], position[order], raw[order]
        norms = np.sqrt(np.bincount(doc, weights=raw * raw, minlength=count))
        ends = pa.array(np.searchsorted(doc, np.arange(count + 1)).astype(np.int32))
        features = pa.StructArray.from_arrays(
            [
                pa.array(np.zeros(count, np.int8)),
                pa.array(np.full(count, width, np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(position.astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(raw / norms[doc])),
            ],
            ["type", "size", "indices", "values"],
        )
        return pa.table([*columns.values(), features], [*held, "features"])

    sent = rows.mapInArrow(send, f"bucket int, piece bigint, n int, terms binary, counts binary, {lists}")
    found = sent.groupBy("bucket").cogroup(vocab.select("bucket", "term", "df").groupBy("bucket"))
    found = found.applyInArrow(know, f"bucket int, piece bigint, n int, {lists}, entries binary")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in held)
    layout = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    gathered = found.groupBy("piece").applyInArrow(gather, f"{kinds}, features {layout}")
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    gathered.select(F.monotonically_increasing_id().alias("n"), "*").write.option("compression", "zstd").parquet(path)

    def number(own: pa.Table) -> pa.Table:
        own = own.sort_by("term")
        return own.append_column("position", pa.array(before[own["bucket"][0].as_py()] + np.arange(own.num_rows), pa.int32()))

    numbered = vocab.groupBy("bucket").applyInArrow(number, "part string, term string, df bigint, idf double, bucket int, position int")
    return spark.read.parquet(path), numbered.drop("bucket"), width, path


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = rows / (classes * rows of the class); one row per class is broadcast."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = sizes.agg(F.sum("__n").alias("t"), F.count(F.lit(1)).alias("c")).first()
    weights = sizes.select(label, (F.lit(total["t"]) / (F.lit(total["c"]) * F.col("__n"))).alias("weight"))
    return df.join(F.broadcast(weights), label)


def train_intent_model(
    train: DataFrame, test: DataFrame, id_col: str, text_col: str, label: str, spec: TfidfSpec | None = None, max_iter: int = 2000
) -> tuple[LogisticRegressionModel | WideRegression, DataFrame]:
    """Class-balanced multinomial regression on TF-IDF; returns the model and
    (id, gold, predicted) for ``test``. With more than DRIVER_COEFFICIENTS coefficients the same
    objective is fitted without a vector of them on the driver."""
    spec = spec or TfidfSpec(profile="lower", max_df=0.95, max_features=None)
    plain = lambda df, test: df.select(id_col, label, F.lit(test).alias("__test"), tx.strip_accents(F.col(text_col), "unicode").alias("__plain"))
    fitted_on = plain(train, False)
    table, _, width, path = feature_table(fitted_on.unionByName(plain(test, True)), fitted_on, spec, id_col, "__plain", (label, "__test"))
    table = table.withColumnRenamed("doc_id", id_col).filter(F.col(id_col).isNotNull())
    own = table.filter("NOT __test").select(id_col, label)
    indexer = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc").fit(balanced_weights(own, label))
    rows = own.filter(F.col(label).isNotNull()).count()
    if width * len(indexer.labels) > DRIVER_COEFFICIENTS:
        return _train_wide(table, own, id_col, label, list(indexer.labels), 1.0 / max(rows, 1), width, max_iter)
    features = as_vectors(table.withColumnRenamed(id_col, "doc_id"), path, (label, "__test")).withColumnRenamed("doc_id", id_col)
    features = cut_lineage(features.filter(F.col(id_col).isNotNull()))
    labelled = balanced_weights(features.filter("NOT __test"), label)
    model = LogisticRegression(
        featuresCol="features",
        labelCol="__y",
        weightCol="weight",
        maxIter=max_iter,
        regParam=1.0 / max(rows, 1),
        elasticNetParam=0.0,
        standardization=False,
        family="multinomial",
    ).fit(indexer.transform(labelled))
    names = F.array(*[F.lit(x) for x in indexer.labels])
    scored = model.transform(features.filter("__test"))
    return model, scored.select(
        id_col,
        F.col(label).alias("gold"),
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"),
    )


def _train_wide(
    table: DataFrame, own: DataFrame, id_col: str, label: str, labels: list[str], penalty: float, width: int, max_iter: int
) -> tuple[WideRegression, DataFrame]:
    places = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label).cast("string"))
    # a test row's label is no part of the fit: any place will do
    y = F.when(F.col("__test"), F.lit(0).cast("long")).otherwise(places - 1).alias("y")
    weights = balanced_weights(own, label).select(label, "weight").distinct()  # a row per class
    importance = F.when(F.col("__test"), F.lit(0.0)).otherwise(F.col("weight")).alias("importance")
    weighed = table.join(F.broadcast(weights), label, "left").filter(F.col("__test") | F.col("weight").isNotNull())
    # the numbers of the rows were written with them, so nothing is written again
    model, predicted = fit_wide(weighed.select("n", y, importance, "features"), labels, width, penalty, max_iter)
    names = F.array(*[F.lit(x) for x in labels])
    scored = table.filter("__test").select("n", id_col, label).join(predicted, "n")
    return model, scored.select(id_col, F.col(label).alias("gold"), F.get(names, F.col("predicted")).alias("predicted"))


def cluster_messages(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    k: int = 12,
    restarts: int = 10,
    seed: int = 42,
    min_chars: int = 10,
    stop_words: Sequence[str] = (),
) -> tuple[KMeansModel, DataFrame, list[str]]:
    """Best of several k-means runs on TF-IDF (min df 5, max df 0.9, 10,000 features).

    Returns the model, (id, text, clean_text, cluster, features) and the term of each
    feature, the most frequent first. The vocabulary and the centres are bounded by 10,000 features.
    Texts are read twice, to count and to weigh; both happen in Arrow batches where the text is.
    """
    spark = docs.sparkSession
    spec = TfidfSpec(profile="cluster", min_df=5, max_df=0.9, max_features=10_000, sublinear=False, stop_words=tuple(stop_words))
    cleaned = docs.withColumn("clean_text", tx.clean(F.col(text_col), "cluster"))
    words = tx.drop_stop_words(tx.tokens(F.col("clean_text")), list(spec.stop_words)).alias("words")
    long_enough = F.length("clean_text") >= min_chars
    # a null part instead of a filter, which would clean every text a second time
    counted = count_terms(cleaned.select(F.when(long_enough, F.lit(ONE)).alias("part"), words), spec, with_rows=True)
    counted = cut_lineage(counted.filter(F.col("term").isNull() | (F.col("df") >= spec.min_df)))
    whole = counted.filter(F.col("term").isNull()).first()
    rows = whole["df"] if whole else 0
    usual = counted.filter(F.col("term").isNotNull() & (F.col("df") <= spec.max_df * rows))
    # at most 10,000 rows
    kept = sorted(most_frequent(usual, spec.max_features).collect(), key=lambda r: (-r["total"], r["term"]))
    if not kept:
        raise ValueError("no term passes the frequency limits")
    vocabulary = [r["term"] for r in kept]
    idf = np.array([math.log((rows + 1.0) / (r["df"] + 1.0)) + 1.0 for r in kept])
    sent = spark.sparkContext.broadcast((vocabulary, idf))

    @F.arrow_udf("struct<type:tinyint,size:int,indices:array<int>,values:array<double>>")
    def vectors(words: pa.Array) -> pa.Array:
        terms, scale = sent.value
        return pa.concat_arrays(list(unit_vectors(words, pa.array(terms), scale, spec.n_max)))

    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    ready = cleaned.filter(long_enough).select(id_col, F.col(text_col).alias("text"), "clean_text", vectors(words).alias("features"))
    ready.write.parquet(path)
    schema = T.StructType([*ready.schema.fields[:3], T.StructField("features", VectorUDT())])
    ready = spark.read.schema(schema).parquet(path)
    best, cost = None, None
    for run in range(restarts):
        model = KMeans(k=k, seed=seed + run, featuresCol="features", predictionCol="cluster").fit(ready)
        if cost is None or model.summary.trainingCost < cost:
            best, cost = model, model.summary.trainingCost
    return best, best.transform(ready), vocabulary


def cluster_distance(clustered: DataFrame, model: KMeansModel, id_col: str = "id") -> DataFrame:
    """Add ``distance``: squared Euclidean distance to the own centre, over the entries that a row
    has. The centres are k rows of bounded width."""
    spark = clustered.sparkSession
    centres = spark.createDataFrame(
        [(i, j, float(v)) for i, c in enumerate(model.clusterCenters()) for j, v in enumerate(c) if v],
        "cluster int, dim int, centre double",
    )
    entries = clustered.select(
        "cluster", id_col, F.explode_outer(F.filter(_numbered("features"), lambda e: e["x"] != 0)).alias("e")
    ).select("cluster", id_col, F.col("e.dim").alias("dim"), F.col("e.x").alias("x"))
    near = sparse_distances(entries, centres, "cluster", id_col)
    return clustered.join(near.drop("cluster"), id_col)


def _numbered(vector: str) -> F.Column:
    return F.transform(vector_to_array(vector), lambda x, i: F.struct(i.alias("dim"), x.alias("x")))


def sparse_distances(entries: DataFrame, centres: DataFrame, cluster: str, id_col: str) -> DataFrame:
    """(cluster, id, distance) from rows (cluster, id, dim, x) and (cluster, dim, centre):
    |c|^2 + sum over the row's own entries of x^2 - 2 x c. A null dim is a row without entries."""
    norms = centres.groupBy(cluster).agg(F.sum(F.col("centre") * F.col("centre")).alias("__norm"))
    own = F.col("x") * F.col("x") - 2 * F.col("x") * F.coalesce("centre", F.lit(0.0))
    sums = (
        entries.join(centres, [cluster, "dim"], "left")
        .groupBy(cluster, id_col)
        .agg(F.coalesce(F.sum(own), F.lit(0.0)).alias("__own"))
    )
    joined = sums.join(F.broadcast(norms), cluster, "left")  # one row per cluster
    return joined.select(cluster, id_col, (F.col("__own") + F.coalesce("__norm", F.lit(0.0))).alias("distance"))


# --- k-means over sparse entries ---------------------------------------------------------------------------


def first_centres(entries: DataFrame, ids: DataFrame, k: int, runs: int, seed: int = 42) -> DataFrame:
    """(run, cluster, term, centre): for every run the vectors of ``k`` documents, by a hash of run,
    id and seed. Documents without entries may be drawn; such a centre has no row."""
    drawn = ids.select("id", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    drawn = drawn.withColumn("__hash", F.md5(F.concat_ws(":", F.col("run"), F.col("id"), F.lit(seed))))
    drawn = top_within(drawn, ["run"], [F.col("__hash"), F.col("id")], k, out="place")
    drawn = drawn.select("run", (F.col("place") - 1).cast("int").alias("cluster"), "id")
    return entries.join(drawn, "id").select("run", "cluster", "term", F.col("weight").alias("centre"))


def assign_sparse(entries: DataFrame, ids: DataFrame, centres: DataFrame, k: int, runs: int) -> DataFrame:
    """(run, id, cluster, distance): the nearest centre of every run, all runs in one pass.

    ``entries`` (id, term, weight) and ``centres`` (run, cluster, term, centre) hold no zero and
    nothing negative, as TF-IDF does. A term meets the list of its centres, at most ``k * runs`` of
    them. |x - c|^2 = |x|^2 + |c|^2 - 2 xc is never more than |x|^2 + |c|^2, so of the centres that
    share no term with x only the one with the least norm can be nearest: it is compared, and no
    document meets all centres. Distances are compared at nine decimals, ties to the smaller cluster.
    """
    square = F.col("centre") * F.col("centre")
    every = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster")
    numbers = centres.sparkSession.range(runs).select(F.col("id").cast("int").alias("run"), every)
    # k * runs rows
    norms = numbers.join(centres.groupBy("run", "cluster").agg(F.sum(square).alias("norm")), ["run", "cluster"], "left")
    norms = cut_lineage(norms.fillna(0.0, ["norm"]))
    least = norms.groupBy("run").agg(F.min(F.struct(F.round("norm", 9).alias("d"), "cluster", F.col("norm").alias("raw"))).alias("least"))
    # one entry per run, listed in every document's row
    listed = [
        F.struct(F.lit(r["run"]).alias("run"), *[F.lit(r["least"][c]).alias(c) for c in ("d", "cluster", "raw")]) for r in least.collect()
    ]
    apart = F.col("norm") - 2 * F.col("dot")
    lists = centres.groupBy("term").agg(F.collect_list(F.struct("run", "cluster", "centre")).alias("__at"))
    met = lookup_join(entries, lists, "term", spread_by=["id"])
    dots = (
        met.select("id", "weight", F.inline("__at"))
        .groupBy("id", "run", "cluster")
        .agg(F.sum(F.col("weight") * F.col("centre")).alias("dot"))
        .join(F.broadcast(norms), ["run", "cluster"])
        .groupBy("id", "run")
        .agg(F.min(F.struct(F.round(apart, 9).alias("d"), "cluster", apart.alias("raw"))).alias("near"))
    )
    own = entries.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("own"))
    spread = ids.select("id", F.inline(F.array(*listed))).select("id", "run", F.struct("d", "cluster", "raw").alias("least"))
    joined = spread.join(own, "id", "left").join(dots, ["id", "run"], "left")
    nearest = F.least("least", F.coalesce("near", "least"))
    return joined.select(
        "run", "id", nearest["cluster"].alias("cluster"), (F.coalesce("own", F.lit(0.0)) + nearest["raw"]).alias("distance")
    )


def mean_centres(entries: DataFrame, assigned: DataFrame) -> DataFrame:
    """(run, cluster, term, centre): the mean vectors of (run, id, cluster). Sums are made in every
    task first, so a cluster with a third of the documents is an ordinary one."""
    sizes = assigned.groupBy("run", "cluster").agg(F.count(F.lit(1)).alias("__n"))
    sums = entries.join(assigned.select("run", "id", "cluster"), "id").groupBy("run", "cluster", "term")
    sums = sums.agg(F.sum("weight").alias("__sum"))
    means = sums.join(F.broadcast(sizes), ["run", "cluster"])  # k * runs rows
    return means.select("run", "cluster", "term", (F.col("__sum") / F.col("__n")).alias("centre"))


def sparse_kmeans(
    entries: DataFrame, ids: DataFrame, k: int, runs: int = 10, seed: int = 42, rounds: int = 20
) -> tuple[DataFrame, DataFrame]:
    """(id, cluster, distance) and (cluster, term, centre) of the run with the least cost. All runs
    go on together until no document of any run moves, or for ``rounds`` rounds."""
    centres = cut_lineage(first_centres(entries, ids, k, runs, seed))
    assigned = cut_lineage(assign_sparse(entries, ids, centres, k, runs))
    for _ in range(rounds):
        centres = cut_lineage(mean_centres(entries, assigned))
        moved = cut_lineage(assign_sparse(entries, ids, centres, k, runs))
        was = assigned.select("run", "id", F.col("cluster").alias("__was"))
        settled = moved.join(was, ["run", "id"]).filter(F.col("cluster") != F.col("__was")).isEmpty()
        assigned = moved
        if settled:
            break
    best = assigned.groupBy("run").agg(F.round(F.sum("distance"), 9).alias("cost")).orderBy("cost", "run").first()
    if best is None:
        return assigned.drop("run"), centres.drop("run")
    own = F.col("run") == best["run"]
    return assigned.filter(own).drop("run"), centres.filter(own).drop("run")


# --- what a regression's coefficients are worth --------------------------------------------------------------


def regression_certificate(
    entries: DataFrame, examples: DataFrame, coefficients: DataFrame, intercepts: DataFrame, penalty: float, book: Codebook | None = None
) -> DataFrame:
    """One row (loss, gradient_norm, gradient_max, examples): the objective of a multinomial
    regression and its gradient, at any coefficients.

    ``entries`` (id, term, weight), ``examples`` (id, label, importance), ``coefficients`` (label,
    term, coefficient), ``intercepts`` (label, intercept), one row per class. The loss is the mean of
    the weighted negative log-likelihoods plus ``penalty / 2`` times the squared coefficients. The
    objective is convex, so a gradient of zero proves the coefficients best. All sums run over the
    entries that exist; no dense row is ever made. With ``book`` the entries come packed, (id, part,
    entries): they are moved like that and opened where they are needed.
    """

    def opened(rows: DataFrame, *columns: str) -> DataFrame:
        if book is None:
            return rows.select(*columns, "term", "weight")
        return unpack(rows, book).select(*columns, F.inline("vec").alias("term", "weight", "df", "salts")).drop("df", "salts")

    coefficients = cut_lineage(coefficients)
    few = coefficients.count() <= BROADCAST_COEFFICIENTS  # a footer count; then the entries stay where they are
    met = opened(entries, "id").join(F.broadcast(coefficients) if few else coefficients, "term").groupBy("id", "label")
    scored = met.agg(F.sum(F.col("weight") * F.col("coefficient")).alias("score"))
    # one entry per class, listed in every example's row
    classes = [F.struct(F.lit(r["label"]).alias("label"), F.lit(float(r["intercept"])).alias("intercept")) for r in intercepts.collect()]
    gold = examples.select("id", F.col("label").alias("gold"), "importance", F.inline(F.array(*classes)))
    margins = (
        gold.join(scored, ["id", "label"], "left")
        .withColumn("margin", F.col("intercept") + F.coalesce("score", F.lit(0.0)))
    )
    # the largest margin is taken out before the exponentials, as usual
    tops = margins.groupBy("id").agg(F.max("margin").alias("top"))
    raised = margins.join(tops, "id").withColumn("e", F.exp(F.col("margin") - F.col("top")))
    sums = raised.groupBy("id").agg(F.sum("e").alias("total"))
    likely = cut_lineage(
        raised.join(sums, "id").select(
            "id",
            "label",
            "importance",
            (F.col("label") == F.col("gold")).alias("own"),
            (F.col("e") / F.col("total")).alias("p"),
            (F.log("total") + F.col("top") - F.col("margin")).alias("surprise"),
        )
    )
    residual = F.col("importance") * (F.col("p") - F.col("own").cast("double"))
    data = likely.filter("own").agg(
        F.sum(F.col("importance") * F.col("surprise")).alias("lost"), F.sum("importance").alias("all"), F.count(F.lit(1)).alias("examples")
    )
    whole = data.first()
    total = float(whole["all"] or 1.0)
    # one row of residuals for an id, so that its entries meet them as they are
    lists = likely.groupBy("id").agg(F.collect_list(F.struct("label", residual.alias("r"))).alias("rs"))
    slopes = opened(entries.join(lists, "id"), "rs").select("term", "weight", F.inline("rs")).groupBy("label", "term")
    slopes = slopes.agg((F.sum(F.col("r") * F.col("weight")) / total).alias("slope"))
    both = slopes.join(coefficients, ["label", "term"], "full").select(
        (F.coalesce("slope", F.lit(0.0)) + penalty * F.coalesce("coefficient", F.lit(0.0))).alias("g"),
        F.coalesce("coefficient", F.lit(0.0)).alias("c"),
    )
    level = likely.groupBy("label").agg((F.sum(residual) / total).alias("g")).select("g", F.lit(0.0).alias("c"))
    summed = both.unionByName(level).agg(
        F.sqrt(F.sum(F.col("g") * F.col("g"))).alias("gradient_norm"),
        F.max(F.abs("g")).alias("gradient_max"),
        F.sum(F.col("c") * F.col("c")).alias("squares"),
    )
    loss = F.lit(float(whole["lost"] or 0.0) / total) + penalty / 2 * F.coalesce("squares", F.lit(0.0))
    return summed.select(loss.alias("loss"), "gradient_norm", "gradient_max", F.lit(whole["examples"]).cast("long").alias("examples"))


# --- the same reports for any assignment of rows to clusters ------------------------------------------------


def cluster_examples(
    points: DataFrame, id_col: str, cluster: str, vector: str, n: int = 8
) -> DataFrame:
    """The n rows closest to their cluster's mean: (cluster, place, id, distance).

    Means are built per dimension with partial sums, so a cluster with a third of the rows
    is averaged in every task. One row per cluster is joined back.
    """
    centre = (
        points.select(F.col(cluster), F.posexplode(vector).alias("dim", "x"))
        .groupBy(cluster, "dim")
        .agg(F.avg(F.col("x").cast("double")).alias("m"))
        .groupBy(cluster)
        .agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("__c"))
        .select(cluster, F.transform("__c", lambda s: s["m"]).alias("__centre"))
    )
    joined = lookup_join(points, centre, cluster, spread_by=[id_col])
    squares = F.zip_with(vector, "__centre", lambda x, c: (x.cast("double") - c) * (x.cast("double") - c))
    measured = joined.select(
        cluster, id_col, F.round(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x), 9).alias("distance")
    )
    return top_within(measured, [cluster], [F.col("distance"), F.col(id_col)], n, out="place")


def cluster_terms(weights: DataFrame, assigned: DataFrame, cluster: str, n: int = 12) -> DataFrame:
    """The n heaviest terms of each cluster's mean vector.

    ``weights``: (doc_id, term, weight); ``assigned``: (doc_id, cluster). Documents without
    any term count in the mean as zero vectors.
    """
    sizes = part_sizes(assigned, cluster)[0].select(F.col("part").alias(cluster), F.col("docs").alias("__docs"))
    sums = (
        weights.join(assigned, "doc_id")
        .groupBy(cluster, "term")
        .agg(F.sum("weight").alias("__sum"))
    )
    means = sums.join(F.broadcast(sizes), cluster).withColumn(
        "mean_weight", F.round(F.col("__sum") / F.col("__docs"), 9)
    )
    return top_within(means, [cluster], [F.col("mean_weight").desc(), F.col("term")], n, out="place").select(
        cluster, "place", "term", "mean_weight"
    )
