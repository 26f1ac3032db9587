"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import ROW, numbered, staged

BUCKETS = 1 << 15
# Languages that are learned and broadcast together, 8 * BUCKETS bytes each (64 MB). More of them are
# taken in blocks by a hash of half as many on average; the results are the same.
LANGUAGES = 256
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNDETERMINED = "und"
# Code points that one step hashes; longer texts take several steps that overlap by an n-gram.
_STEP = 1 << 19
# Odd multipliers of the rolling hash; any will do, but they have to stay the same.
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-gram buckets of all texts, and the index of the text each comes from."""
    longest = max(ORDERS)
    waiting, owners, size = [], [], 0

    def hashed() -> tuple[np.ndarray, np.ndarray]:
        # Texts are parted by zeros, so that no n-gram spans two of them.
        gap = np.zeros(longest, dtype=np.uint32)
        codes = np.concatenate([x for piece, _ in waiting for x in (piece, gap)])
        owner = np.repeat(owners, [len(piece) + longest for piece, _ in waiting])
        skip = np.concatenate([np.full(len(piece) + longest, left) for piece, left in waiting])
        buckets, of = [], []
        for n in ORDERS:
            count = len(codes) - n + 1
            value = np.full(count, n, dtype=np.uint32)
            inside = np.ones(count, dtype=bool)
            for k in range(n):
                part = codes[k : k + count]
                value = (value ^ part) * _MULTIPLIERS[k]
                value ^= value >> np.uint32(15)
                inside &= part > 0
            # The overlap of a long text's pieces is counted once.
            inside &= skip[:count] < n
            buckets.append((value & np.uint32(BUCKETS - 1))[inside])
            of.append(owner[:count][inside])
        return np.concatenate(buckets), np.concatenate(of)

    for index, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint32)
        plain = codes < 128
        letters = (codes - 97) < 26
        codes = np.where(plain & ~letters, np.uint32(32), codes)
        codes = codes[~((codes == 32) & np.concatenate([[False], codes[:-1] == 32]))] if len(codes) else codes
        for start in range(0, len(codes), _STEP):
            # Marks n-grams that the piece before has counted: its last code points are repeated.
            first = max(0, start - longest + 1)
            piece = codes[first : start + _STEP]
            waiting.append((piece, np.zeros(len(piece) + longest, dtype=np.int8)))
            if first < start:
                for back in range(start - first):
                    waiting[-1][1][back] = start - first - back
            owners.append(index)
            size += len(piece)
            if size >= _STEP:
                yield hashed()
                waiting, owners, size = [], [], 0
    if waiting:
        yield hashed()


def learn(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", documents: int | None = None
) -> tuple[list[str], np.ndarray]:
    """Languages, and the matrix (languages x buckets + 1) of log-probabilities, log priors last.

    Every text with a language counts, the whole of it; priors are shares of `documents` (of them all,
    by default). Each task sends its sums, so what reaches
    the driver is bounded by languages times buckets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for name in set(langs):
                    if name not in sums:
                        sums[name] = np.zeros(BUCKETS + 1, dtype=np.int64)
                    own = [text for text, own in zip(texts, langs) if own == name]
                    sums[name][BUCKETS] += len(own)
                    for buckets, _ in _pieces(own):
                        sums[name][:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
        for name, values in sums.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(values[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    )
    found = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = found.toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    place = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(names), BUCKETS + 1))
    row = [place[name] for name in found.column("lang").to_pylist()]
    np.add.at(counts, (row, np.asarray(found.column("bucket"))), np.asarray(found.column("n")))
    weights = counts[:, :BUCKETS] + SMOOTHING
    matrix = np.log(weights / weights.sum(axis=1, keepdims=True))
    priors = np.log(counts[:, BUCKETS:] / max(1.0, documents or counts[:, BUCKETS:].sum()))
    return names, np.hstack([matrix, priors])


def log_joint(texts: list[str | None], names: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The texts, empty if they have no letter, and log P(text, language) by text and language."""
    known = [text if text is not None and names and any(map(str.isalpha, text)) else "" for text in texts]
    total = np.tile(matrix[:, -1], (len(texts), 1))
    for buckets, of in _pieces(known):
        for k in range(len(names)):
            total[:, k] += np.bincount(of, weights=matrix[k][buckets], minlength=len(texts))
    return known, total


def predict(texts: list[str | None], names: list[str], matrix: np.ndarray) -> tuple[list[str], list[float]]:
    """The likeliest language of each text and its posterior probability."""
    known, total = log_joint(texts, names, matrix)
    if not names:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    langs = [names[b] if text else UNDETERMINED for b, text in zip(best, known)]
    return langs, [float(s) if text else 0.0 for s, text in zip(share, known)]


def _by_blocks(docs: DataFrame, learned: DataFrame, blocks: int, doc_id: str, lang: str, text: str) -> DataFrame:
    """As :func:`identify_languages`, with the languages in blocks: each row's best language and total
    probability by block are kept, then the best and the sum over the blocks."""
    marked = learned.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    documents = marked.count()
    rows = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    found = None
    for k in range(blocks):
        own = F.pmod(F.xxhash64(F.col(lang).cast("string")), F.lit(blocks)) == k
        names, matrix = learn(marked.where(own), lang=lang, text=text, documents=documents)
        if not names and (found is not None or k < blocks - 1):
            continue
        model = docs.sparkSession.sparkContext.broadcast((names, matrix))

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterable[pa.RecordBatch]:
            names, matrix = model.value
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    known, total = log_joint(part.column(3).to_pylist(), names, matrix)
                    if names:
                        most = total.max(axis=1)
                        best = [names[at] if text else None for at, text in zip(total.argmax(axis=1), known)]
                        whole = most + np.log(np.exp(total - most[:, None]).sum(axis=1))
                    else:
                        most, best, whole = np.zeros(len(known)), [None] * len(known), np.zeros(len(known))
                    columns = [part.column(0), part.column(1), part.column(2), pa.array(best, pa.string())]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(most), pa.array(whole)], names=[*ROW, "doc_id", "lang_pred", "most", "whole"]
                    )

        schema = f"{ROW[0]} long, {ROW[1]} long, doc_id long, lang_pred string, most double, whole double"
        part = staged(rows.select(*ROW, "doc_id", "text").mapInArrow(run, schema), "languages")
        model.unpersist()
        found = part if found is None else found.unionByName(part)
    # Of equal totals the language that sorts first, as within a block.
    best = F.min(F.struct((-F.col("most")).alias("least"), "lang_pred")).alias("best")
    summed = found.groupBy(*ROW).agg(F.first("doc_id").alias("doc_id"), best, F.collect_list("whole").alias("wholes"))
    share = 1 / F.aggregate("wholes", F.lit(0.0), lambda total, whole: total + F.exp(whole + F.col("best.least")))
    return summed.select(
        "doc_id",
        F.coalesce("best.lang_pred", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(F.col("best.lang_pred").isNull(), 0.0).otherwise(share).alias("score"),
    )


def identify_languages(
    docs: DataFrame,
    *,
    learn_from: Column | None = None,
    doc_id: str = "doc_id",
    lang: str = "lang",
    text: str = "text",
    languages: int = LANGUAGES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score.

    Learns from the rows where `learn_from` holds (all, by default) that have text and language.
    The prediction looks at the text alone. A text that is null or has no letter, and any text if
    there was nothing to learn from, gets `und` with score 0; else the score is the posterior
    probability of lang_pred. Ties go to the language that sorts first. Texts of any
    length are read whole, a step at a time. The matrix of about `languages` languages at most is
    broadcast; if there are more, they are taken in blocks, and the texts are read once for each.
    Other columns are ignored.
    """
    learned = docs if learn_from is None else docs.where(learn_from)
    count = learned.agg(F.count_distinct(F.col(lang).cast("string"))).first()[0]
    if count > languages:
        return _by_blocks(docs, learned, -(-2 * count // languages), doc_id, lang, text)
    names, matrix = learn(learned, lang=lang, text=text)
    model = docs.sparkSession.sparkContext.broadcast((names, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        names, matrix = model.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                langs, scores = predict(part.column(1).to_pylist(), names, matrix)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
