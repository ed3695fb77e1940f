"""Mixing documents to target weights of domains by soft membership.

A softmax classifier over hashed words is fitted on a bounded sample of a labelled table
(``ROWS_PER_DOMAIN`` rows of each domain at most, in the order of a hash of the id) and predicts
every document's posterior p over the domains. Rates r >= 0 then minimise

    sum over domains d of (sum over documents i of r_i * tokens_i * p_id - T_d)^2 / T_d,

where T_d is the domain's weight times the token budget. The gradient step of a document is
``r_i - step * sum_d p_id * (total_d - T_d) / T_d``, projected to r_i >= 0 and started at 1, with
momentum. One pass of a narrow table gives the totals that all documents' next step needs: one
number per domain. A document's rate follows from the past totals alone, so that no pass writes.

Defined results: null and empty texts have no tokens, an even posterior and a rate like others; a
null id is handed on and takes part; rows that repeat an id are rows of their own; labelled rows
with a null domain, with one that has no target, or without a document are not learned from; an
empty table gives an empty result; a target that no document can meet is left unmet; other
columns are ignored, and handed on by ``mix``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import fresh, pick
from deskloom.llm.shingles import slices, word_hashes
from deskloom.session import cut_lineage

BUCKETS = 1 << 16
ROWS_PER_DOMAIN = 400
EPOCHS = 60
SEED = 11
STEPS = 100
TOLERANCE = 1e-4


# --- the classifier ------------------------------------------------------------------------------


def hashed_words(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket per word, words before each row) for pieces of the texts."""
    for _, _, data, offsets in slices(texts):
        hashed, upto = word_hashes(data, offsets)
        yield (hashed & np.uint64(BUCKETS - 1)).astype(np.int64), upto


def _row_means(values: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Means of the rows' values; no values give zeros."""
    n = np.diff(upto)
    out = np.zeros((len(n), values.shape[1]))
    if len(values):
        some = n > 0
        out[some] = np.add.reduceat(values, upto[:-1][some], axis=0) / n[some][:, None]
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray  # buckets x domains
    bias: np.ndarray

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per row, rows x domains)."""
        counts, scores = [np.zeros(0, np.int64)], [np.zeros((0, len(self.domains)))]
        for buckets, upto in hashed_words(texts):
            counts.append(np.diff(upto))
            scores.append(_row_means(self.weights[buckets], upto))
        tokens, mean = np.concatenate(counts), np.concatenate(scores)
        even = np.where(tokens[:, None] > 0, self.bias, 0)
        return tokens, _softmax(mean * len(self.domains) + even)


def train_classifier(texts: list[str], domain: np.ndarray, domains: list[str], epochs: int = EPOCHS) -> DomainModel:
    """Full-batch Adam on the mean of the word weights; classes count alike."""
    k = len(domains)
    model = DomainModel(domains, np.zeros((BUCKETS, k), np.float32), np.zeros(k))
    if not len(texts):
        return model
    held, counts = [], []
    for start in range(0, len(texts), 100):
        for buckets, upto in hashed_words(pa.array(texts[start : start + 100], pa.string())):
            held.append(buckets.astype(np.uint16))
            counts.append(np.diff(upto))
    n = np.concatenate(counts)
    # one entry per document and word, with the word's share of the document
    cells, times = np.unique(np.repeat(np.arange(len(n)) * BUCKETS, n) + np.concatenate(held), return_counts=True)
    row = (cells // BUCKETS).astype(np.int32)
    used, place = np.unique((cells % BUCKETS).astype(np.int32), return_inverse=True)
    place = place.ravel().astype(np.int32)
    share = (times * k / np.maximum(n, 1)[row]).astype(np.float32)
    truth = np.eye(k)[domain]
    weight = (1 / np.maximum(np.bincount(domain, minlength=k), 1))[domain]
    weight /= weight.sum()
    w, bias = np.zeros((k, len(used)), np.float32), np.zeros(k)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    bias_mean, bias_square = np.zeros(k), np.zeros(k)
    for step in range(1, epochs + 1):
        scores = np.stack([np.bincount(row, w[c][place] * share, minlength=len(n)) for c in range(k)], axis=1)
        error = (_softmax(scores + bias) - truth) * weight[:, None]
        fix, fix_square = 1 - 0.9**step, 1 - 0.99**step
        for c in range(k):
            g = np.bincount(place, error[:, c].astype(np.float32)[row] * share, minlength=len(used)) + 1e-6 * w[c]
            mean[c] += 0.1 * (g - mean[c])
            square[c] += 0.01 * (g * g - square[c])
            w[c] -= 0.1 * (mean[c] / fix) / (np.sqrt(square[c] / fix_square) + 1e-8)
        g = error.sum(axis=0)
        bias_mean += 0.1 * (g - bias_mean)
        bias_square += 0.01 * (g * g - bias_square)
        bias -= 0.1 * (bias_mean / fix) / (np.sqrt(bias_square / fix_square) + 1e-8)
    model.weights[used] = w.T
    model.bias = bias
    return model


def fit_domains(
    docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text",
    domain_col: str = "domain", rows: int = ROWS_PER_DOMAIN,
) -> DomainModel:
    """``labelled`` has an id and its domain; at most ``rows`` rows of each domain are collected."""
    marks = pick(labelled, doc_id=id_col, domain=domain_col).filter(F.col("doc_id").isNotNull()).distinct()
    order = [F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), "doc_id"]
    chosen = None
    for domain in domains:
        part = marks.filter(F.col("domain") == domain).orderBy(*order).limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = pick(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id").toPandas()
    sample = sample.sort_values(["doc_id", "domain"]).drop_duplicates(["doc_id"])
    number = {d: i for i, d in enumerate(domains)}
    return train_classifier([t or "" for t in sample["text"]], sample["domain"].map(number).to_numpy(int), domains)


# --- the rates -----------------------------------------------------------------------------------


@dataclass
class Path:
    """The past steps, from which a document's rate follows."""

    step: float
    momentum: float
    pulls: list[np.ndarray]  # (total_d - T_d) / T_d at the point of each step

    def rates(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rate, point of the next step) for rows of posteriors."""
        rate = np.ones(len(p))
        point = rate
        for pull in self.pulls:
            moved = np.maximum(0, point - self.step * (p @ pull))
            point, rate = moved + self.momentum * (moved - rate), moved
        return rate, point


def _domain_totals(members: DataFrame, path: Path, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens per domain at the rates and at the point of the next step."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, k))
        for batch in batches:
            tokens, p = _members(batch, k)
            for i, values in enumerate(path.rates(p)):
                sums[i] += (values * tokens) @ p
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(2 * k, dtype=np.int32)), pa.array(sums.ravel())], ["place", "value"]
        )

    rows = members.select("n_tokens", "p").mapInArrow(add, "place int, value double")
    found = rows.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    values = np.array([r["value"] for r in found] or [0.0] * (2 * k)).reshape(2, k)
    return values[0], values[1]


def _members(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    p = batch.column("p").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
    return batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float), p


def _gram(members: DataFrame, k: int) -> np.ndarray:
    """Sum over documents of tokens * p * p^T: one small matrix per task, added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            tokens, p = _members(batch, k)
            total += (p * tokens[:, None]).T @ p
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k * k, dtype=np.int32)), pa.array(total.ravel())], ["place", "value"]
        )

    rows = members.select("n_tokens", "p").mapInArrow(add, "place int, value double")
    found = rows.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    return np.array([r["value"] for r in found] or [0.0] * (k * k)).reshape(k, k)


def fit_rates(members: DataFrame, weights: np.ndarray, steps: int = STEPS, tolerance: float = TOLERANCE) -> Path:
    """Projected gradient with momentum until every domain's total is within ``tolerance`` of its
    target. The step length comes from the curvature, a domains x domains matrix."""
    k = len(weights)
    gram = _gram(members, k)
    budget = gram.sum()
    if budget <= 0:
        return Path(0.0, 0.0, [])
    target = weights / weights.sum() * budget
    curvature = np.linalg.eigvalsh(gram / np.sqrt(target[:, None] * target))
    most, least = curvature[-1], max(curvature[0], curvature[-1] / 1000)
    root = np.sqrt(most / least)
    path = Path(1 / most, (root - 1) / (root + 1), [])
    for _ in range(steps):
        at_rates, at_point = _domain_totals(members, path, k)
        if np.abs(at_rates / target - 1).max() <= tolerance:
            break
        path = Path(path.step, path.momentum, [*path.pulls, at_point / target - 1])
    return path


def memberships(docs: DataFrame, model: DomainModel, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with n_tokens and p, the posteriors in the order of the domains."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, p = shared.value.posteriors(batch.column("__text"))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(tokens), rows], [*keep, "n_tokens", "p"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return source.mapInArrow(run, f"{kinds}n_tokens bigint, p array<double>")


def _with_rates(members: DataFrame, path: Path, domains: list[str], keep: list[str]) -> DataFrame:
    k = len(domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, p = _members(batch, k)
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in [*keep, "n_tokens"]],
                    pa.array([domains[i] for i in best], pa.string()),
                    pa.array(p.max(axis=1) if len(p) else []),
                    pa.array(path.rates(p)[0]),
                ],
                [*keep, "n_tokens", "domain", "posterior", "rate"],
            )

    kinds = "".join(f"`{c}` {members.schema[c].dataType.simpleString()}, " for c in keep)
    return members.mapInArrow(run, f"{kinds}n_tokens bigint, domain string, posterior double, rate double")


def whole_copies(rate: Column, *ids: Column) -> Column:
    """The rate as a whole number: its floor, and one more for a share of the rows that equals the
    remainder, picked by a hash."""
    lot = F.pmod(F.xxhash64(*ids, F.lit(SEED)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate) + (lot < rate - F.floor(rate)).cast("long")).cast("long")


def document_rates(
    docs: DataFrame, model: DomainModel, targets: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, domain (the likeliest), posterior, rate, copies per row."""
    source = pick(docs, doc_id=id_col, text=text_col)
    members = cut_lineage(memberships(source, model, "text", ["doc_id"]))
    path = fit_rates(members, np.array([targets[d] for d in model.domains], float))
    rated = _with_rates(members, path, model.domains, ["doc_id"])
    return rated.withColumn("copies", whole_copies(F.col("rate"), F.col("doc_id")))


def mix(docs: DataFrame, model: DomainModel, targets: Mapping[str, float], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with all their columns. Rows are
    numbered in a written table, so that a repeated row keeps its own rate."""
    row, copies = fresh(docs, "__row"), fresh(docs, "__copies")
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    members = cut_lineage(memberships(numbered, model, text_col, [row]))
    path = fit_rates(members, np.array([targets[d] for d in model.domains], float))
    rated = _with_rates(members, path, model.domains, [row])
    rated = rated.select(row, whole_copies(F.col("rate"), F.col(row)).alias(copies)).filter(F.col(copies) > 0)
    again = F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))
    return numbered.join(rated, row).withColumn(copies, again).select(*[F.col(f"`{c}`") for c in docs.columns])
