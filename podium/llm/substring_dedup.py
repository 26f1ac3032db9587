"""Repeated passages: an FM-index per shard, matching statistics of the passages streamed past it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from podium.llm.common import staged, unstage
from podium.llm.fm_index import FmIndex

WINDOW = 20
# Words of the rarest-hash anchor by which windows are brought together.
ANCHOR = 6
# Words that one shard indexes, and streams, at most.
SHARD_WORDS = 1 << 17

# Odd numbers for rolling hashes; any will do, but they have to stay the same.
_ANCHOR_BASE, _RUN_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def _coded(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(word) for word in words], dtype=np.uint64)


def _decoded(words: bytes) -> np.ndarray:
    """Coded words from their bytes in a row."""
    return np.frombuffer(words, dtype="<u8").astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**n, modulo 2**64."""
    factors = np.full(n + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def runs(codes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows that have the same anchor: anchor hash, run hash, start, windows.

    The anchor of a window is its sub-sequence of `anchor` words with the least hash, the first on a
    tie. It depends on the window's words alone, so equal windows have equal anchors.
    """
    n = len(codes) - window + 1
    if n < 1:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    grams = np.zeros(len(codes) - anchor + 1, dtype=np.uint64)
    for k in range(anchor):
        grams = grams * np.uint64(_ANCHOR_BASE) + codes[k : k + len(grams)]
    grams = _mixed(grams)
    places = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1).argmin(axis=1) + np.arange(n)
    start = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    count = np.diff(np.concatenate([start, [n]]))
    power, back = _powers(_RUN_BASE, len(codes)), _powers(pow(_RUN_BASE, -1, 1 << 64), len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * power[:-1], out=sums[1:])
    run = _mixed((sums[start + count + window - 1] - sums[start]) * back[start])
    return grams[places[start]].view(np.int64), run.view(np.int64), start, count


_RUNS = "anchor long, run long, doc_id long, start int, count int"


def _as_batch(ids: np.ndarray, begins: np.ndarray, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The runs found in each of several word sequences, which start at `begins` of their documents."""
    anchors, keys, starts, counts = (np.concatenate(c) for c in zip(*found))
    sizes = [len(x[0]) for x in found]
    arrays = [pa.array(anchors), pa.array(keys), pa.array(np.repeat(ids, sizes))]
    arrays += [pa.array(x.astype(np.int32)) for x in (starts + np.repeat(begins, sizes), counts)]
    return pa.RecordBatch.from_arrays(arrays, names=["anchor", "run", "doc_id", "start", "count"])


def _runs_of(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                found = [runs(_coded(words_of(x.as_py())), window, anchor) for x in part.column(1)]
                ids = np.asarray(part.column(0), dtype=np.int64)
                yield _as_batch(ids, np.zeros(len(ids), dtype=np.int64), found)

    return docs.mapInArrow(run, _RUNS)


def _finer_runs(passages: DataFrame, window: int, anchor: int) -> DataFrame:
    """The windows of `passages` (with their words) as runs by longer anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [runs(_decoded(x.as_py()), window, anchor) for x in batch.column(2)]
                ids, begins = (np.asarray(batch.column(k), dtype=np.int64) for k in range(2))
                yield _as_batch(ids, begins, found)

    return passages.select("doc_id", "start", "words").mapInArrow(run, _RUNS)


def _dealt_anew(frame: DataFrame, *keys: str) -> DataFrame:
    """With a second key, Spark deals both sides of the next join anew, also one that has just been
    aggregated by its keys; adaptive execution can then split a hot key."""
    return frame.withColumn("_deal", F.hash(*keys))


def _with_words(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """`wanted` (anchor, run, doc_id, start, count), each with its coded words as bytes."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "run", "start", "count")).alias("runs"))
    # The lists are the hashed side, so the texts are dealt out but never sorted.
    joined = docs.join(lists.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                out: list[tuple] = []
                part = batch.slice(first, 256)
                for doc_id, text, own in zip(*(part.column(k).to_pylist() for k in range(3))):
                    codes = _coded(words_of(text)).astype("<u8")
                    for r in own:
                        a = r["start"]
                        words = codes[a : a + r["count"] + window - 1].tobytes()
                        out.append((r["anchor"], r["run"], doc_id, a, r["count"], words))
                columns = list(zip(*out)) or [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                    names=["anchor", "run", "doc_id", "start", "count", "words"],
                )

    return joined.mapInArrow(run, "anchor long, run long, doc_id long, start int, count int, words binary")


def _searched(group: pa.Table, window: int) -> pa.Table:
    """Windows of the group's passages that one of them has earlier."""
    doc = np.asarray(group.column("doc_id"), dtype=np.int64)
    start = np.asarray(group.column("start"), dtype=np.int64)
    words = [_decoded(x) for x in group.column("words").to_pylist()]
    # Places are numbered by document and position, so that the least number is the first place.
    ids, which = np.unique(doc, return_inverse=True)
    room = int((start + [len(x) for x in words]).max()) + 1
    numbers = [which[k] * room + start[k] + np.arange(len(words[k])) for k in range(len(words))]
    _, least = FmIndex(words, numbers, window).statistics(words)
    out_doc, out_start, out_count = [], [], []
    for k, first in enumerate(least):
        earlier = np.concatenate([[0], first < numbers[k], [0]]).astype(np.int8)
        change = np.diff(earlier)
        begins, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        out_doc.append(np.full(len(begins), doc[k]))
        out_start.append(start[k] + begins)
        out_count.append(ends - begins)
    return pa.table(
        {
            "doc_id": pa.array(np.concatenate(out_doc)),
            "start": pa.array(np.concatenate(out_start).astype(np.int32)),
            "count": pa.array(np.concatenate(out_count).astype(np.int32)),
        }
    )


def _earlier_elsewhere(docs: DataFrame, different: DataFrame, window: int, shards: int) -> DataFrame:
    """Windows (doc_id, start, count) of `different` passages that another of them has earlier.

    Passages with equal anchors meet in one shard, which is indexed, and which all of them are
    streamed past.
    """
    return (
        _with_words(docs, different, window)
        .select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "doc_id", "start", "words")
        .groupBy("shard")
        .applyInArrow(lambda group: _searched(group, window), "doc_id long, start int, count int")
    )


def repeated_passages(
    docs: DataFrame,
    *,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    shard_words: int = SHARD_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Word intervals (doc_id, start, end) that a window of repeated words covers, disjoint, not touching.

    A window is `window` consecutive words of one text; it is repeated if the same words also start
    earlier: in a document of a smaller id, or earlier in the same one. Windows are judged on the
    input as it is.

    Windows are brought together by an anchor inside them, so each passage is sent to one shard and
    not to all. Passages whose anchor occurs once are left out at once. Of equal passages the first
    stands for all, so a group of copies costs one row per task. Only what then shares an anchor
    with a different passage is indexed and searched.

    An anchor with more words than a shard takes, as a phrase that is common in different
    surroundings has, is parted by longer anchors: its windows are brought together anew, by an
    anchor half-way to the window's length and at last by all of their words, where passages are equal
    or have nothing to do with each other. So no shard grows, and nothing is compared all with all.

    Null texts have no words. Rows without an id take no part. Rows that repeat an id have to repeat
    its text; they count once. Other columns are ignored.
    """
    if not 0 < anchor < window:
        raise ValueError("an anchor has to be shorter than a window")
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    lengths = sorted({anchor, (anchor + window) // 2, window})
    size = F.col("count") + window - 1
    found, read = [], []
    everything = staged(_runs_of(rows, window, anchor), "runs")
    for length in lengths:
        common = everything.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
        shared = staged(
            _dealt_anew(everything, "anchor").join(_dealt_anew(common, "anchor"), ["_deal", "anchor"], "left_semi").drop("_deal"),
            "shared-runs",
        )
        unstage(everything)
        first = F.min(F.struct("doc_id", "start")).alias("first")
        passages = staged(
            shared.groupBy("anchor", "run").agg(first, F.min("count").alias("count")).select("anchor", "run", "first.*", "count"),
            "passages",
        )
        found.append(
            _dealt_anew(shared, "anchor", "run")
            .join(
                _dealt_anew(passages, "anchor", "run").select(
                    "_deal", "anchor", "run", F.col("doc_id").alias("_doc"), F.col("start").alias("_start")
                ),
                ["_deal", "anchor", "run"],
            )
            .where((F.col("doc_id") != F.col("_doc")) | (F.col("start") != F.col("_start")))
            .select("doc_id", "start", "count")
        )
        several = (
            passages.groupBy("anchor")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("words"))
            .where("n > 1")
            .select("anchor", ((F.col("words") > shard_words) & F.lit(length < window)).alias("hot"))
        )
        different = staged(
            _dealt_anew(passages, "anchor").join(_dealt_anew(several, "anchor"), ["_deal", "anchor"]).drop("_deal"),
            "different-passages",
        )
        read += [shared, passages, different]
        words, hot = different.agg(F.coalesce(F.sum(F.when(~F.col("hot"), size)), F.lit(0)), F.count_if("hot")).first()
        if words:
            found.append(_earlier_elsewhere(rows, different.where("not hot"), window, -(-words // shard_words)))
        if not hot:
            break
        finer = lengths[lengths.index(length) + 1]
        everything = staged(_finer_runs(_with_words(rows, different.where("hot"), window), window, finer), "finer-runs")
    covered = reduce(DataFrame.unionByName, found).select(
        "doc_id", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("count") + window - 1).cast("long").alias("end")
    )
    in_order = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    islands = covered.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn(
        "island", F.sum("new").over(in_order)
    )
    merged = islands.groupBy("doc_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    repeated = staged(merged.select("doc_id", "start", "end"), "repeated-passages")
    for frame in read:
        unstage(frame)
    return repeated


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept (the words that stay, joined by
    one space), kept_sha256.

    The words inside :func:`repeated_passages` are removed. A null text has no words; a row without
    an id keeps all of its words.
    """
    found = repeated_passages(docs, doc_id=doc_id, text=text, **options)
    lists = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("gone"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    joined = rows.join(lists.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                counts, removed, kept, digests = [], [], [], []
                for text, gone in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words, stay, at = words_of(text), [], 0
                    for span in gone or ():
                        stay += words[at : span["start"]]
                        at = span["end"]
                    stay += words[at:]
                    joined_words = b" ".join(stay)
                    counts.append(len(words))
                    removed.append(len(words) - len(stay))
                    kept.append(joined_words.decode("utf-8"))
                    digests.append(hashlib.sha256(joined_words).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(digests, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
                )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
