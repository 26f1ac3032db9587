"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import WORD, staged

LENGTHS = (512, 1024, 2048, 4096)
# Pieces that one task packs: enough for bins to be filled, few enough to sort in memory.
SHARD_PIECES = 20_000
# Characters of text that a task holds at a time, where it packs texts.
SHARD_BYTES = 32 << 20
# Characters of finished sequences that a task hands to Spark at a time.
BLOCK_BYTES = 2 << 20
_WORD = re.compile(WORD)


def sequence_cost(length: int) -> float:
    """What a sequence costs: its length, padding included, and a fixed part."""
    return 32.0 + length


def word_tokens(text: Column) -> Column:
    """Words of a text and one end."""
    return F.regexp_count(text, F.lit(WORD)) + 1


def best_fit(
    sizes: list[int], lengths: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = sequence_cost
) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the length of each bin.

    Pieces come in falling size, and each goes to the open bin that it leaves the least room in. If
    it fits nowhere, the bin is opened whose length promises the least cost per token: a bin of a
    length is expected to hold the piece and as much of the smaller pieces still to come as fits its
    room. In the end every bin gets the least costly length that holds its contents.
    """
    lengths = tuple(sorted(lengths))
    order = sorted(range(len(sizes)), key=lambda k: -sizes[k])
    falling = np.array([sizes[k] for k in order], dtype=np.int64)
    # Tokens from a place in the order on, and where pieces of at most a size begin.
    left = np.concatenate([np.cumsum(falling[::-1])[::-1], [0]]).tolist()
    begins = np.searchsorted(-falling, -np.arange(lengths[-1] + 1), side="left").tolist()
    rooms: dict[int, list[int]] = {}
    open_rooms = 0  # a bit for each room that some bin has
    bins, offsets, used, opened = [0] * len(sizes), [0] * len(sizes), [], []
    for place, k in enumerate(order):
        size = sizes[k]
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            best = None
            for length in lengths:
                if length >= size:
                    more = left[max(place + 1, begins[length - size])]
                    share = cost(length) / (size + min(length - size, more))
                    if best is None or share < best[0] - 1e-12:
                        best = share, length
            chosen = len(used)
            room = best[1]
            used.append(0)
            opened.append(room)
        bins[k], offsets[k] = chosen, used[chosen]
        used[chosen] += size
        room -= size
        if room:
            rooms.setdefault(room, []).append(chosen)
            open_rooms |= 1 << room
    return bins, offsets, [min((x for x in lengths if x >= u), key=lambda x: (cost(x), x)) for u in used]


def pieces(docs: DataFrame, *, longest: int, tokens: Callable[[Column], Column] = word_tokens, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, n_tokens: each document, cut where it is longer than a sequence."""
    count = tokens(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("long")
    cut = docs.select(F.col(doc_id).cast("long").alias("doc_id"), count.alias("n")).withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / longest) - 1))
    )
    start = F.col("piece") * longest
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(longest), F.col("n") - start).cast("long").alias("n_tokens"))


def packed(
    docs: DataFrame,
    *,
    lengths: tuple[int, ...] = LENGTHS,
    cost: Callable[[int], float] = sequence_cost,
    tokens: Callable[[Column], Column] = word_tokens,
    shard_pieces: int = SHARD_PIECES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, n_tokens, bin_id, capacity, offset.

    `tokens` counts a text's tokens, one at least. Documents longer than the largest permitted length
    are cut into pieces of that length and a rest. Pieces are dealt out by a hash and each shard is
    packed for itself, see :func:`best_fit`; a shard wastes a few bins at most.

    A null or empty text is an end alone and is packed like any other. Every row is packed, repeated
    ones and those without an id as well. Other columns are ignored.
    """
    lengths = tuple(sorted(set(lengths)))
    # The number tells equal pieces apart, so that any number of them is dealt over all shards.
    cut = pieces(docs, longest=lengths[-1], tokens=tokens, doc_id=doc_id, text=text)
    cut = staged(cut.withColumn("nth", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-cut.count() // shard_pieces))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets, capacities = best_fit(group.column("n_tokens").to_pylist(), lengths, cost)
        shard = group.column("shard")[0].as_py()
        columns = [group.column(name) for name in ("doc_id", "piece", "start", "n_tokens")]
        columns.append(pa.array([shard << 32 | b for b in bins], pa.int64()))
        columns.append(pa.array([capacities[b] for b in bins], pa.int64()))
        columns.append(pa.array(offsets, pa.int64()))
        return pa.table(columns, names=["doc_id", "piece", "start", "n_tokens", "bin_id", "capacity", "offset"])

    return (
        cut.withColumn("shard", F.pmod(F.xxhash64("nth"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(pack, "doc_id long, piece long, start long, n_tokens long, bin_id long, capacity long, offset long")
    )


def sequences(
    docs: DataFrame,
    *,
    lengths: tuple[int, ...] = LENGTHS,
    cost: Callable[[int], float] = sequence_cost,
    shard_pieces: int = SHARD_PIECES,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
    separator: str = "\n\n",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per sequence: bin_id, capacity, n_tokens, doc_ids, text.

    Documents are packed where they are read, a shard of up to `shard_pieces` pieces and `shard_bytes` of
    text at a time, so no text is shuffled or written before the result. The texts are counted and cut by
    words; the pieces of a sequence are joined by `separator` in the order of their offsets, and doc_ids
    has the document of each. White space inside a piece stays as it is.

    Every row is a document of its own, also one without an id or with an id that others have. A null or
    empty text is an end alone. A document longer than a shard is a shard. Other columns are ignored.
    An empty table gives no sequence.
    """
    lengths = tuple(sorted(set(lengths)))
    longest = lengths[-1]

    def cut(own_text: str) -> list[tuple[int, str]]:
        """Tokens and text of each piece; the end is a token of the last one."""
        starts = [m.start() for m in _WORD.finditer(own_text)]
        count = len(starts) + 1
        if count <= longest:
            return [(count, own_text)]
        ends = [starts[k] if k < len(starts) else len(own_text) for k in range(longest, count, longest)] + [len(own_text)]
        begins = [0, *ends[:-1]]
        sizes = [min(longest, count - k) for k in range(0, count, longest)]
        return [(n, own_text[a:b]) for n, a, b in zip(sizes, begins, ends)]

    def block(shard: list[tuple[int | None, int, str]], own: list[list[int]], capacities: list[int]) -> pa.RecordBatch:
        columns = [
            pa.array(capacities, pa.int64()),
            pa.array([sum(shard[k][1] for k in members) for members in own], pa.int64()),
            pa.array([[shard[k][0] for k in members] for members in own], pa.list_(pa.int64())),
            pa.array([separator.join(shard[k][2] for k in members) for members in own], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["capacity", "n_tokens", "doc_ids", "text"])

    def pack(shard: list[tuple[int | None, int, str]]) -> Iterator[pa.RecordBatch]:
        """All sequences of a shard, in blocks: the shard's texts are never there a second time."""
        bins, offsets, capacities = best_fit([n for _, n, _ in shard], lengths, cost)
        own: list[list[int]] = [[] for _ in capacities]
        for k in sorted(range(len(shard)), key=offsets.__getitem__):
            own[bins[k]].append(k)
        first, size = 0, 0
        for last, members in enumerate(own, 1):
            size += sum(len(shard[k][2]) for k in members)
            if size >= block_bytes or last == len(own):
                yield block(shard, own[first:last], capacities[first:last])
                first, size = last, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = [], 0
        for batch in batches:
            for own_id, own_text in zip(batch.column(0), batch.column(1)):
                for n, piece in cut(own_text.as_py() or ""):
                    shard.append((own_id.as_py(), n, piece))
                    size += len(piece)
                if len(shard) >= shard_pieces or size >= shard_bytes:
                    yield from pack(shard)
                    shard, size = [], 0
        if shard:
            yield from pack(shard)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    packed_rows = rows.mapInArrow(run, "capacity long, n_tokens long, doc_ids array<long>, text string")
    return packed_rows.select(F.monotonically_increasing_id().alias("bin_id"), "*")
