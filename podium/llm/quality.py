"""Quality classifier learned from trusted positives and unlabelled text (non-negative PU risk)."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import TEXTS_PER_BATCH, staged, unstage

# Kinds of bytes whose shares describe how a text is written.
_KINDS = np.full(256, 10, dtype=np.uint8)  # not ASCII
_KINDS[:128] = 9  # other signs
for _kind, _characters in enumerate(
    ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n\r\t\f\v", ".,;", "'\"()-:?", "!", "|"]
):
    _KINDS[list(_characters.encode())] = _kind
_SHARES = 11
# Shares of kinds of bytes, of pairs of kinds, word, line and repetition figures, their square roots.
_PLAIN = _SHARES + 4 + 8
FEATURES = 2 * _PLAIN + 1
PENALTY = 1e-3
ROUNDS = 12
# Bins of the scores from which the class prior is estimated.
BINS = 1000
_NEUTRAL = 0.5


def features(text: str | None) -> np.ndarray:
    """Figures of one text. Null and empty texts have zeros (and the constant)."""
    found = np.zeros(FEATURES, dtype=np.float32)
    found[-1] = 1
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return found
    kinds = _KINDS[np.frombuffer(data, dtype=np.uint8)]
    plain = np.zeros(_PLAIN)
    plain[:_SHARES] = np.bincount(kinds, minlength=_SHARES) / len(data)
    signs, upper, digits = kinds >= 6, kinds == 0, kinds == 2
    signs &= kinds != 10
    for k, flags in enumerate((signs, upper, digits, kinds == 4)):
        plain[_SHARES + k] = np.count_nonzero(flags[1:] & flags[:-1]) / len(data)
    words = data.split()
    lines = data.split(b"\n")
    count = max(1, len(words))
    lengths = np.array([len(word) for word in words] or [0])
    plain[_SHARES + 4 :] = (
        len(set(words)) / count,
        sum(map(eq, words, words[1:])) / count,
        sum(map(eq, words, words[2:])) / count,
        min(1.0, lengths.mean() / 20),
        min(1.0, lengths.std() / 20),
        1 - len(set(lines)) / len(lines),
        min(1.0, np.log1p(len(words)) / 12),
        min(1.0, len(lines) / count),
    )
    found[:_PLAIN], found[_PLAIN:-1] = plain, np.sqrt(plain)
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, FEATURES).astype(np.float64)


def described(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the features of every row, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(value.as_py()).astype("<f4").tobytes() for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], names=["doc_id", "x"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x binary")


def _summed(rows: DataFrame, function, length: int) -> np.ndarray:
    """Element-wise sum over all rows of what `function` makes of each batch; one vector reaches the
    driver. `function` gets the features and whether each row is a trusted positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            total += function(_matrix(batch.column(0)), np.asarray(batch.column(1)))
        at = pa.array(np.arange(length), pa.int64())
        yield pa.RecordBatch.from_arrays([at, pa.array(total)], names=["i", "v"])

    found = rows.select("x", "positive").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(length)
    out[np.asarray(found.column("i"), dtype=np.int64)] = np.asarray(found.column("v"))
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def fit(rows: DataFrame, prior: float, *, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the linear model with the least non-negative PU risk over all `rows`.

    `rows` (x, positive) are the unlabelled texts; the trusted positives among them are marked.
    With the logistic loss the unbiased risk is convex, so Newton steps over distributed sums reach
    its minimum in few passes. The estimated risk of negatives, E_u l(-z) - prior E_p l(-z), counts
    as 0 when it is negative; a step that makes the risk so counted larger is halved.
    """
    d = FEATURES

    def moments(x, positive):
        return np.concatenate([[len(x)], x.sum(0), (x**2).sum(0), [positive.sum()], x[positive].sum(0)])

    sums = _summed(rows, moments, 3 * d + 2)
    n, trusted = sums[0], sums[2 * d + 1]
    if not n or not trusted:
        return np.zeros(d)
    mean, square = sums[1 : d + 1] / n, sums[d + 1 : 2 * d + 1] / n
    spread = np.sqrt(np.maximum(square - mean**2, 0))
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0)
    mean[-1], scale[-1] = 0, 1
    of_positive = (sums[2 * d + 2 :] / trusted - mean) * scale
    ridge = np.full(d, penalty)
    ridge[-1] = 0

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def parts(x, positive):
            x = (x - mean) * scale
            z = x @ w
            p = _sigmoid(z)
            loss, bent = np.logaddexp(0, z), x * (p * (1 - p))[:, None]
            own = x[positive]
            return np.concatenate([
                [loss.sum(), loss[positive].sum()], x.T @ p, own.T @ p[positive], (bent.T @ x).ravel(), (bent[positive].T @ own).ravel()
            ])

        got = _summed(rows, parts, 2 + 2 * d + 2 * d * d)
        as_negative, own = got[0] / n, got[1] / trusted
        slopes = got[2 : d + 2] / n, got[d + 2 : 2 * d + 2] / trusted
        curves = got[2 * d + 2 :].reshape(2, d, d)
        # l(z) = l(-z) - z, so the risk of the positives needs no sum of its own.
        of_negatives = as_negative - prior * own
        risk = prior * (own - of_positive @ w) + max(0.0, of_negatives) + (ridge * w * w).sum() / 2
        if of_negatives > 0:
            slope, curve = slopes[0] - prior * of_positive, curves[0] / n
        else:  # counted as 0: only the positives' part is left
            slope, curve = prior * (slopes[1] - of_positive), prior * curves[1] / trusted
        return risk, slope + ridge * w, curve + np.diag(ridge + 1e-9)

    w = np.zeros(d)
    risk, slope, curve = at(w)
    step = 1.0
    for _ in range(rounds):
        move = np.linalg.solve(curve, slope)
        tried = w - step * move
        found = at(tried)
        if found[0] > risk + 1e-12:
            step /= 2
            continue
        settled = risk - found[0] < 1e-6
        w, (risk, slope, curve), step = tried, found, min(1.0, 2 * step)
        if settled:
            break
    weights = w * scale
    weights[-1] -= (w * scale) @ mean
    return weights


def estimated_prior(rows: DataFrame, weights: np.ndarray, *, bins: int = BINS) -> float:
    """The share of positives among the unlabelled texts, from these and the trusted positives alone.

    Above any score, the share of all texts is at least the prior times the share of the positives, as
    the positives among them are there. The prior is therefore at most the least ratio of the two, and
    is that where the highest scores belong to positives only. Each ratio is taken with the standard
    errors of its two shares on top, which keeps thresholds that few positives reach from deciding, and
    a filter from being too strict where little is known. Two histograms of scores are summed over all
    rows.
    """

    def counts(x, positive):
        place = np.minimum((score(x, weights) * bins).astype(np.int64), bins - 1)
        return np.concatenate([np.bincount(place, minlength=bins), np.bincount(place[positive], minlength=bins)])

    found = _summed(rows, counts, 2 * bins)
    above_all, above_own = np.cumsum(found[:bins][::-1]), np.cumsum(found[bins:][::-1])
    n, trusted = above_all[-1], above_own[-1]
    if not n or not trusted:
        return _NEUTRAL
    some = above_own > 0
    errors = sum(0.5 / np.sqrt(k) for k in (n, trusted))
    return float(min(1.0, ((above_all[some] / n + errors) * trusted / above_own[some]).min()))


def learn_quality(
    described_docs: DataFrame, labels: DataFrame, *, learn_from: Column | None = None, prior: float | None = None
) -> np.ndarray:
    """Weights from the features of the documents (doc_id, x) and labels (doc_id, quality 0 or 1).

    Documents where `learn_from` (of doc_id) holds are the unlabelled texts, all of them; those
    marked 1 are the trusted positives. Marks of 0 serve for nothing. Where no class prior is given, a
    model with an even prior ranks the texts, and the prior is estimated from its scores, see
    :func:`estimated_prior`. A document with several marks has the largest; null marks and ids are left
    out.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    own = described_docs if learn_from is None else described_docs.where(learn_from)
    marked = own.join(marks, "doc_id", "left").select("x", "quality", (F.coalesce("quality", F.lit(0)) == 1).alias("positive"))
    marked = staged(marked, "quality-rows")
    if prior is None:
        first = fit(marked, _NEUTRAL)
        prior = estimated_prior(marked, first) if first.any() else _NEUTRAL
    weights = fit(marked, min(max(prior, 0.01), 0.99))
    unstage(marked)
    return weights


def score(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Probability of good quality; one half for everything if nothing could be learned."""
    return _sigmoid(x @ weights)


def score_quality(
    docs: DataFrame, labels: DataFrame, *, learn_from: Column | None = None, prior: float | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    Only the text decides a score; null and empty texts have the score of zero features. Repeated
    rows are scored alike. Without any trusted positive every score is 0.5. Learning passes over the
    features of all documents, not over a sample. Other columns are ignored.
    """
    table = staged(described(docs, doc_id=doc_id, text=text), "quality-features", TEXTS_PER_BATCH)
    weights = learn_quality(table, labels, learn_from=learn_from, prior=prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = score(_matrix(batch.column(1)), weights)
            predicted = pa.array((values >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), predicted], names=["doc_id", "score", "predicted"])

    return table.mapInArrow(run, "doc_id long, score double, predicted int")


def keep_quality(
    docs: DataFrame, labels: DataFrame, *, learn_from: Column | None = None, prior: float | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """`docs` without the rows that score below one half, all columns as they are.

    The model is learned as in :func:`score_quality`; the rows are then scored where they are read,
    so no text is shuffled.
    """
    table = staged(described(docs, doc_id=doc_id, text=text), "quality-features", TEXTS_PER_BATCH)
    weights = learn_quality(table, labels, learn_from=learn_from, prior=prior)

    # Text by text out of the Arrow batch: a batch of them is never held as Python objects.
    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        x = np.stack([features(value.as_py()) for value in texts]) if len(texts) else np.zeros((0, FEATURES))
        return pa.array(score(x, weights) >= 0.5)

    return docs.where(good(F.col(text).cast("string")))
