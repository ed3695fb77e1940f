"""Toxicity of whole documents by a small recurrent network over overlapping windows.

``fit`` learns from a bounded sample of labelled rows (``TOXIC_ROWS`` and ``CLEAN_ROWS`` at most,
in the order of a hash of the id): three quarters train the network of ``gru.py`` in numpy on the
driver, the others fit a logistic unit that turns a document's window scores into one score. The
weights are broadcast (the vocabulary is bounded by the sample's text). Scoring reads every window
of every text in Arrow batches. Neither labels nor ids, languages or sources enter a score.

Defined results: null and empty texts have one empty window, hence a score like others; a null id
is handed on; rows that repeat an id are scored one by one; labelled rows with a null label, or
without a document, are not learned from; without labelled rows of both kinds the score is a
constant; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import pick
from deskloom.llm.gru import Model, score_windows, tokenize, train, windows

WINDOW = 64
STRIDE = 48
STEPS = 240
BATCH = 256
SEED = 7
TOXIC_ROWS = 1000
CLEAN_ROWS = 1500
REJECT = 0.3
#: Texts that are scored together.
CHUNK_CHARS = 1 << 18
ROWS = 256


@dataclass
class Scorer:
    model: Model
    unit: np.ndarray  # weights of the document's features, the last one is the bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-(features(self.model, texts) @ self.unit)))

    def column_scores(self, texts: pa.Array) -> np.ndarray:
        """Scores of an Arrow column, of which few rows are Python strings at a time."""
        pieces = (texts.slice(i, ROWS).to_pylist() for i in range(0, len(texts), ROWS))
        return np.concatenate([np.zeros(0), *(self.scores([t or "" for t in piece]) for piece in pieces)])


def features(model: Model, texts: list[str]) -> np.ndarray:
    """Per text: highest and second highest window logit, mean window probability, the logarithm of
    the number of windows, one."""
    out = np.zeros((len(texts), 5))
    at = 0
    while at < len(texts):
        end, chars = at + 1, len(texts[at])
        while end < len(texts) and chars + len(texts[end]) <= CHUNK_CHARS:
            chars += len(texts[end])
            end += 1
        tokens = tokenize(texts[at:end])
        start, stop, text = windows(tokens.upto, WINDOW, STRIDE)
        logit = np.clip(score_windows(model, tokens, start, stop, WINDOW), -8, 8)
        order = np.lexsort((-logit, text))
        count = np.bincount(text, minlength=end - at)
        first = np.cumsum(count) - count
        out[at:end, 0] = logit[order[first]]
        out[at:end, 1] = logit[order[first + (count > 1)]]
        out[at:end, 2] = 8 * np.bincount(text, 1 / (1 + np.exp(-logit)), minlength=end - at) / count
        out[at:end, 3] = np.log(count)
        out[at:end, 4] = 1
        at = end
    return out


def logistic_unit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method for a ridge-regularised logistic regression; the bias is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(len(w), ridge)
    shrink[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x.T * (p * (1 - p))) @ x + np.diag(shrink)
        w -= np.linalg.solve(hessian, x.T @ (p - y) + shrink * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Scorer:
    """``usable`` is a condition on ``doc_id``: which labelled rows may be learned from."""
    marks = pick(labels, doc_id=id_col, toxic=label_col).filter(F.col("toxic").isin(0, 1) & usable).distinct()
    order = [F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), "doc_id"]
    chosen = [
        marks.filter(F.col("toxic") == k).orderBy(*order).limit(most) for k, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
    ]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = (
        pick(docs, doc_id=id_col, text=text_col).join(sample, "doc_id").select("doc_id", "text", "toxic").toPandas()
    )
    rows = rows.sort_values(["doc_id", "toxic"]).drop_duplicates(["doc_id"])
    texts = [t or "" for t in rows["text"]]
    label = rows["toxic"].to_numpy(int)
    spread = np.random.default_rng(SEED).permutation(len(texts))
    learn = np.ones(len(texts), bool)
    learn[spread[: len(texts) // 4]] = False
    model = train([t for t, k in zip(texts, learn) if k], label[learn], WINDOW, STRIDE, STEPS, BATCH, SEED)
    held = np.flatnonzero(~learn)
    if len(set(label[held])) < 2:
        held = np.arange(len(texts))
    if len(set(label)) < 2:
        base = 2.0 if len(label) and label[0] else -4.0
        return Scorer(model, np.array([0, 0, 0, 0, base]))
    return Scorer(model, logistic_unit(features(model, [texts[i] for i in held]), label[held]))


def score_documents(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score per row; rows stay where they are."""
    source = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.column_scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, scorer: Scorer, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows whose score is below ``reject``, with all their columns, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.column_scores(batch.column(text_col))
            yield batch.filter(pa.array(scores < reject))

    return docs.mapInArrow(run, docs.schema)

