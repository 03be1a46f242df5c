"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled text are all it learns from. The class prior is estimated from a first classifier that
tells positives from unlabelled text: where a score range holds nearly all positives, the share of unlabelled text in it
over the share of positives bounds the prior. The final additive model minimises the non-negative unbiased risk
prior * R_p+ + max(0, R_u- - prior * R_p-) with logistic loss; its offset then puts the prior's share of unlabelled
texts above one half.

Features are counts of the text's bytes and words; label, language, source and id are none of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.bytewise import ASCII_SPACE, chunks, prefix_hash, span_hash, table_of, word_spans
from loomtext.llm.staging import fresh

#: Most positives and most unlabelled texts that the model is fitted on; the sample is taken by hash of the id.
POSITIVES = 10_000
UNLABELLED = 20_000
THRESHOLD = 0.3
STEPS = 600
EDGES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995)
#: Added to a denominator, so that a handful of words or bytes proves little.
FEW_WORDS, FEW_BYTES = 10, 60

_CLASSES = [
    table_of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), table_of(b"0123456789"), table_of(b"#$%&*+<=>@\\^_`{|}~"), table_of(b".,;:!?'\"()-"),
    table_of(b"!"), table_of(b"|"), table_of(b"\n"), table_of(bytes(range(128, 256))), ASCII_SPACE,
]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1), np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def features(column: pa.Array) -> np.ndarray:
    """A row of features for each text; null and empty texts give the values of no bytes and no words."""
    out = []
    for lo, hi, raw, offsets in chunks(column):
        size = np.diff(offsets) + FEW_BYTES
        start, end, text = word_spans(raw, offsets, ASCII_SPACE)
        words = np.bincount(text, minlength=hi - lo)
        edges = np.concatenate(([0], np.cumsum(words)))
        hashes = span_hash(prefix_hash(raw), start, end)
        length = (end - start).astype(np.float64)
        repeated = np.zeros(len(text))
        repeated[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        order = np.lexsort((hashes, text))
        fresh = np.ones(len(text))
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
        n = words + FEW_WORDS
        odd = table_of(b"#$%&*+<=>@\\^_`{|}~!")[raw[end - 1]].astype(np.float64) if len(end) else np.zeros(0)
        columns = [_sums(c[raw], offsets) / size for c in _CLASSES]
        distinct = _sums(fresh, edges)
        columns += [_sums(repeated, edges) / n, (words - distinct) / n / np.log2(n), _sums(odd, edges) / n, _sums(length, edges) / n, _sums(length**2, edges) / n, np.log2(n), _sums(length > 20, edges) / n]
        out.append(np.stack(columns, axis=1))
    return np.concatenate(out) if out else np.zeros((0, len(_CLASSES) + 7))


class Additive:
    """A sum of step functions of the features, with steps at quantiles of the unlabelled sample."""

    def __init__(self, sample: np.ndarray):
        self.edges = [np.unique(np.quantile(x, EDGES)) for x in sample.T]
        self.first = np.concatenate(([0], np.cumsum([len(e) + 1 for e in self.edges])))
        self.weights = np.zeros(self.first[-1] + 1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, v, "left") + k for e, v, k in zip(self.edges, x.T, self.first, strict=False)], axis=1)

    def margin(self, cells: np.ndarray) -> np.ndarray:
        return self.weights[cells].sum(axis=1) + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.cells(x)), -30, 30)))

    def gradient(self, cells: np.ndarray, slope: np.ndarray) -> np.ndarray:
        out = np.bincount(cells.ravel(), np.repeat(slope, cells.shape[1]), len(self.weights))
        out[-1] = slope.sum()
        return out / max(len(cells), 1)

    def fit(self, step, samples: int) -> Additive:
        """``step()`` gives the risk's gradient; Adam, with a weight decay that falls with the count of positives."""
        decay = 2 / samples
        m, v = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for t in range(1, STEPS + 1):
            g = step() + decay * self.weights
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.weights -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return self


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled text, from classifiers that tell the two samples apart.

    Each half is scored by a model of the other half, so that texts it was fitted on don't flatter it.
    """
    bounds = []
    shuffle = np.random.default_rng(0).permutation
    positive, unlabelled = positive[shuffle(len(positive))], unlabelled[shuffle(len(unlabelled))]
    for k in (0, 1):
        p, u = positive[k::2], unlabelled[k::2]
        model = Additive(u)
        cells = model.cells(p), model.cells(u)
        model.fit(lambda: 0.5 * model.gradient(cells[0], _sigmoid(model.margin(cells[0])) - 1) + 0.5 * model.gradient(cells[1], _sigmoid(model.margin(cells[1]))), max(len(p), 1))
        a, b = np.sort(model.margin(model.cells(positive[1 - k :: 2]))), np.sort(model.margin(model.cells(unlabelled[1 - k :: 2])))
        if len(a) and len(b):
            cuts = np.quantile(a, np.linspace(0.01, 0.2, 20))
            bounds.append(((1 - np.searchsorted(b, cuts, "left") / len(b)) / (1 - np.searchsorted(a, cuts, "left") / len(a))).min())
    return float(np.clip(np.mean(bounds), 0.01, 0.99)) if bounds else 0.5


def fit_positive_unlabelled(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Additive:
    """The model of least non-negative risk. Without positives or unlabelled texts it scores everything the same."""
    model = Additive(unlabelled if len(unlabelled) else positive if len(positive) else np.zeros((1, len(_CLASSES) + 7)))
    if not len(positive) or not len(unlabelled):
        return model
    prior = class_prior(positive, unlabelled) if prior is None else prior
    p, u = model.cells(positive), model.cells(unlabelled)

    def step():
        at_p, at_u = _sigmoid(model.margin(p)), _sigmoid(model.margin(u))
        #: logistic loss: of a positive log(1 + exp(-g)), of a negative log(1 + exp(g))
        negative = np.logaddexp(0, model.margin(u)).mean() - prior * np.logaddexp(0, model.margin(p)).mean()
        below = model.gradient(u, at_u) - prior * model.gradient(p, at_p)
        if negative < 0:
            return -below
        return prior * model.gradient(p, at_p - 1) + below

    model.fit(step, len(p))
    #: the share of unlabelled texts above one half is the prior
    model.weights[-1] -= np.quantile(model.margin(u), 1 - prior)
    return model


def held_out(doc_id: str) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as an empty text, and so is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample_features(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> np.ndarray:
    """Features of the documents with one of ``ids``, whose number the caller bounds."""

    def extract(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["id", "x"])

    kind = docs.select(doc_id).dtypes[0][1]
    found = docs.join(F.broadcast(ids), doc_id, "left_semi").select(F.col(doc_id).alias("id"), text).mapInArrow(extract, f"id {kind}, x array<double>")
    #: an id that is repeated gives one row, so the ids bound the rows
    rows = found.groupBy("id").agg(F.min("x").alias("x")).orderBy("id").select("x").toArrow()
    flat = rows.column("x").combine_chunks().flatten() if rows.num_rows else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, len(_CLASSES) + 7)


def learn_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Additive:
    """The model, from at most POSITIVES rows labelled 1 that are not held out and UNLABELLED rows of any kind."""
    drawn = F.xxhash64(doc_id)
    trusted = labels.where(~held_out(doc_id)).groupBy(doc_id).agg(F.min(quality).alias("q")).where("q = 1").select(doc_id)
    trusted = trusted.orderBy(drawn, doc_id).limit(POSITIVES)
    any_ = docs.select(doc_id).where(F.col(doc_id).isNotNull()).distinct().orderBy(drawn, doc_id).limit(UNLABELLED)
    return fit_positive_unlabelled(sample_features(docs, trusted, doc_id, text), sample_features(docs, any_, doc_id, text))


def score_quality(docs: DataFrame, model: Additive, text: str = "text") -> DataFrame:
    """``docs`` with a column score from 0 to 1, higher where label 1 is likelier.

    Null and empty texts get the score of a text without words. Every row gets a score, equal texts the same one; an
    empty table stays empty. A column named score of ``docs`` is replaced.
    """
    names = [c for c in docs.columns if c != "score"]

    given = fresh(docs, "_text")

    def score(batches):
        for batch in batches:
            at = batch.schema.get_field_index(given)
            columns = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.record_batch([*columns, pa.array(model.score(features(batch.column(at))))], names=[*names, "score"])

    kept = docs.select(*names)
    schema = kept.withColumn("score", F.lit(0.0)).schema
    return kept.withColumn(given, F.col(text)).mapInArrow(score, schema)
