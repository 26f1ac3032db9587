"""SimHash near duplicates: anchor points of a covering code, compared anchor by anchor."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import ROW, TEXTS_PER_BATCH, map_texts, numbered, staged, unstage, without_rows
from podium.llm.components import components

SEED = 42
BITS = 64
# The perfect binary Golay code: words of 23 bits, every one within 3 bits of exactly one codeword.
# Its generator polynomial is a fixed value.
_LENGTH, _CHECKS, _RADIUS, _GENERATOR = 23, 11, 3, 0b101011100011
# The three parts of a fingerprint that are covered, each padded with zeros to the code's length.
_PARTS = ((0, 22), (22, 21), (43, 21))
# Fingerprints per side that one task compares at a time.
BLOCK = 16_384
# From so many different fingerprints on, anchors cover two parts at once (24 bits instead of 12).
PAIRS_FROM = 1 << 26


def shingles(text: str | None, size: int) -> list[bytes]:
    """The shingles of a text: A-Z lower-cased, words joined by one space; shorter texts whole."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        return [joined] if words else []
    starts = [0, *(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1).tolist(), len(joined) + 1]
    return [joined[start : end - 1] for start, end in zip(starts, starts[size:])]


def _majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of `counts` hashes, the bits that are set in over half of them.

    Bits are counted in byte lanes of at most 255 hashes, then by run.
    """
    lanes = -(-counts // 255)
    owner = np.repeat(np.arange(len(counts)), lanes)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    starts = (np.cumsum(counts) - counts)[owner] + 255 * nth
    sums = np.zeros((len(counts), BITS), dtype=np.int64)
    for first in range(0, len(starts), 256):
        at = starts[first : first + 256]
        stop = starts[first + 256] if first + 256 < len(starts) else len(hashes)
        bits = np.unpackbits(hashes[at[0] : stop].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        part = np.add.reduceat(bits.view(np.uint64), at - at[0], axis=0).view(np.uint8).reshape(len(at), BITS)
        np.add.at(sums, owner[first : first + 256], part)
    ones = (sums * 2 > counts[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


def simhashes(texts: list[str | None], size: int) -> np.ndarray:
    """The 64-bit SimHash of each text, 0 without words."""
    digest = xxhash.xxh64_intdigest
    hashes, counts = [], []
    for text in texts:
        found = [digest(piece, SEED) for piece in shingles(text, size)]
        hashes.append(np.array(found, dtype="<u8"))
        counts.append(len(found))
    together = np.concatenate(hashes) if hashes else np.empty(0, "<u8")
    return _majorities(together, np.array(counts, dtype=np.int64))


def fingerprint(text: str | None, size: int = 4) -> int:
    """The 64-bit SimHash of one text."""
    return int(simhashes([text], size)[0])


def fingerprints(
    docs: DataFrame, *, size: int = 4, doc_id: str = "doc_id", text: str = "text", also: Sequence[str] = ()
) -> DataFrame:
    """doc_id and fp (the SimHash as a signed long) of every row, and the columns `also` (long).

    A null text has fingerprint 0.
    """
    names = ["doc_id", "fp", *also]

    def run(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            fps = simhashes(part.column(1).to_pylist(), size).view(np.int64)
            columns = [part.column(0), pa.array(fps, pa.int64()), *part.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *also)
    return map_texts(rows, run, ", ".join(f"{name} long" for name in names))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """The remainder of each word modulo the generator: equal for words that differ by a codeword."""
    rest = words.copy()
    for bit in range(_LENGTH - 1, _CHECKS - 1, -1):
        high = (rest >> bit) & 1
        rest ^= high * (_GENERATOR << (bit - _CHECKS))
    return rest


def _steps(extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Differences of weight 3 + `extra` or less by syndrome: first index, differences, excess."""
    masks = [sum(1 << b for b in on) for w in range(_RADIUS + extra + 1) for on in combinations(range(_LENGTH), w)]
    masks = np.array(masks, dtype=np.int64)
    excess = np.maximum(np.bitwise_count(masks).astype(np.int64) - _RADIUS, 0)
    found = _syndromes(masks)
    order = np.lexsort((excess, found))
    first = np.searchsorted(found[order], np.arange((1 << _CHECKS) + 1))
    return first, masks[order], excess[order]


def _near(words: np.ndarray, steps: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All codewords that `steps` lead to from each word: index of the word, codeword, excess.

    The codeword is given by its 12 message bits. Excess 0 is the one codeword within 3 bits.
    """
    first, masks, excess = steps
    found = _syndromes(words)
    counts = first[found + 1] - first[found]
    which = np.repeat(np.arange(len(words)), counts)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    step = first[found][which] + offset
    return which, (words[which] ^ masks[step]) >> _CHECKS, excess[step]


def _anchors(fps: np.ndarray, extra: int, steps: tuple, pairs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, key of the anchor, whether the anchor is the nearest one.

    Two fingerprints within a threshold differ by at most a third of it in some part, or by at most
    two thirds in some pair of parts: `extra`, up to which `steps` go. One of them is within the code's radius of its nearest
    anchor there, so the other is within that radius plus the difference, and gets the anchor too.
    """
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in _PARTS]
    found = []
    if not pairs:
        for k, words in enumerate(parts):
            which, code, excess = _near(words, steps)
            found.append((which, (k << 24) | code, excess == 0))
    else:
        near = [_near(words, steps) for words in parts]
        for k, (a, b) in enumerate(combinations(range(3), 2)):
            (wa, ca, ea), (wb, cb, eb) = near[a], near[b]
            start = np.searchsorted(wb, np.arange(len(fps) + 1))
            counts = (start[1:] - start[:-1])[wa]
            left = np.repeat(np.arange(len(wa)), counts)
            offset = np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts)
            right = start[wa[left]] + offset
            excess = ea[left] + eb[right]
            fits = excess <= extra
            left, right = left[fits], right[fits]
            found.append((wa[left], (k << 24) | (ca[left] << 12) | cb[right], excess[fits] == 0))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _linked(homes: np.ndarray, others: np.ndarray, threshold: int):
    """Links between two blocks of rows (node, fp): all of them where they are few, else as many as
    connect the same nodes.
    """
    top = np.iinfo(np.int64).max
    ids, fps = others[0], others[1].view(np.uint64)
    left, right = [], []
    rows = max(1, 4_000_000 // max(1, len(ids)))
    for start in range(0, homes.shape[1], rows):
        part = homes[:, start : start + rows]
        near = np.bitwise_count(part[1].view(np.uint64)[:, None] ^ fps[None, :]) <= threshold
        near &= part[0][:, None] != ids[None, :]
        if near.sum() <= 2 * (part.shape[1] + len(ids)):
            a, b = near.nonzero()
            left.append(part[0][a])
            right.append(ids[b])
            continue
        # A dense block: the smallest id reachable inside it stands for each row.
        label = part[0].copy()
        while True:
            at_other = np.minimum(ids, np.where(near, label[:, None], top).min(axis=0))
            nearer = np.minimum(label, np.where(near, at_other[None, :], top).min(axis=1))
            if (nearer == label).all():
                break
            label = nearer
        left += [part[0], ids]
        right += [label, at_other]
    left = np.concatenate(left) if left else np.empty(0, np.int64)
    right = np.concatenate(right) if right else np.empty(0, np.int64)
    return left[left != right], right[left != right]


def _placed(nodes: DataFrame, threshold: int, pairs: bool) -> DataFrame:
    """key, home and the columns of `nodes` (node, fp, ...: long) for each anchor of each fingerprint."""
    if not 0 <= threshold <= 8:
        raise ValueError("threshold has to be from 0 to 8 bits")
    columns = nodes.columns
    extra = threshold * 2 // 3 if pairs else threshold // 3
    steps, at = _steps(extra), columns.index("fp")

    def replicate(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 2048):
            values = [np.asarray(x, dtype=np.int64) for x in batch.slice(start, 2048).columns]
            which, key, home = _anchors(values[at].view(np.uint64), extra, steps, pairs)
            rows = [key, home, *(x[which] for x in values)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["key", "home", *columns])

    return staged(map_texts(nodes, replicate, "key long, home boolean, " + ", ".join(f"{c} long" for c in columns)), "anchors")


def _tiles(placed: DataFrame, block: int):
    """The rows of each anchor, grouped: an anchor with more than `block` rows on a side is dealt out
    block against block.
    """
    columns = [c for c in placed.columns if c not in ("key", "home")]
    sizes = placed.groupBy("key").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all"))
    # At most one row per anchor, and only for the large ones.
    large = sizes.where(F.greatest("homes", "all") > block).select(
        "key", F.ceil(F.col("homes") / block).alias("down"), F.ceil(F.col("all") / block).alias("across")
    )
    by = F.xxhash64("fp")
    row = F.pmod(by, F.coalesce("down", F.lit(1)))
    column = F.pmod(by, F.coalesce("across", F.lit(1)))

    def each(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(n, F.lit(1)) - 1)).alias(n)

    dealt = placed.join(large, "key", "left")
    homes = dealt.where("home").select("key", row.alias("down"), each("across"), F.lit(True).alias("home"), *columns)
    everyone = dealt.select("key", each("down"), column.alias("across"), F.lit(False).alias("home"), *columns)
    return homes.unionByName(everyone).groupBy("key", "down", "across")


def _sides(group: pa.Table, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    home = np.asarray(group.column("home"))
    rows = np.stack([np.asarray(group.column(x), dtype=np.int64) for x in columns])
    return rows[:, home], rows[:, ~home]


def links(nodes: DataFrame, *, threshold: int = 4, block: int = BLOCK, pairs: bool = False) -> DataFrame:
    """Links (u, v) that connect all nodes (node, fp: long, no nulls) within `threshold` bits.

    Between each two such nodes there is a path of links, not always a direct one. Each fingerprint
    goes to all its anchors; at an anchor, those that have it as nearest are compared with all. An
    anchor with more than `block` rows on a side is compared block against block, in many tasks.
    """

    def compare(group: pa.Table) -> pa.Table:
        u, v = _linked(*_sides(group, ["node", "fp"]), threshold)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    placed = _placed(nodes.select("node", "fp"), threshold, pairs)
    found = staged(_tiles(placed, block).applyInArrow(compare, "u long, v long"), "anchor-links")
    unstage(placed)
    return found


def classes(hashed: DataFrame, *, threshold: int = 4, block: int = BLOCK, pairs_from: int = PAIRS_FROM) -> DataFrame:
    """fp, class of every different fingerprint of `hashed` (fp: long): the same class for those that links
    of `threshold` or fewer differing bits connect."""
    nodes = staged(hashed.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).select(F.col("fp").alias("node"), "fp"), "nodes")
    linked = links(nodes, threshold=threshold, block=block, pairs=nodes.count() >= pairs_from)
    found = components(linked)
    joined = nodes.join(found, nodes["node"] == found["u"], "left")
    return staged(joined.select("fp", F.coalesce("root", "fp").alias("class")), "classes")


def _joined(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """The second key makes Spark deal both sides anew, so that adaptive execution can split a key of very
    many rows; what is aggregated by the key alone would be joined where it is."""
    again = F.hash(key).alias("_again")
    return rows.select("*", again).join(others.select("*", again), ["_again", key]).drop("_again")


def near_duplicates(
    docs: DataFrame,
    *,
    size: int = 4,
    threshold: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    pairs_from: int = PAIRS_FROM,
) -> DataFrame:
    """One row per row of `docs`: doc_id, fp (signed long), component_id.

    Fingerprints of `size`-word shingles link at `threshold` or fewer differing bits; component_id is
    the smallest id reachable over links. Nodes are fingerprints and not ids, so a group of equal ones
    of any size is compared once, and rows that repeat an id with another text are not taken for linked.

    Null and empty texts have fingerprint 0 and are linked like any other. A row without an id links
    like any other; its component's id is that of the rows that have one, null if none has. Very long
    texts are hashed whole. Other columns are ignored. An empty table gives no row.
    """
    hashed = staged(fingerprints(docs, size=size, doc_id=doc_id, text=text), "fingerprints", TEXTS_PER_BATCH)
    known = classes(hashed, threshold=threshold, block=block, pairs_from=pairs_from)
    smallest = hashed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    own = staged(known.join(smallest, "fp"), "class-ids")
    best = own.groupBy("class").agg(F.min("least").alias("component_id"))
    by_print = _joined(own.select("fp", "class"), best, "class")
    return _joined(hashed, by_print.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, *, size: int = 4, threshold: int = 4, doc_id: str = "doc_id", text: str = "text",
    block: int = BLOCK, pairs_from: int = PAIRS_FROM,
) -> DataFrame:
    """`docs` with one document of each component, that of the smallest id, all columns as they are.

    Rows are told apart by their place: of every component exactly one row stays, whichever ids are null
    or repeated.
    """
    rows = numbered(docs)
    hashed = staged(fingerprints(rows, size=size, doc_id=doc_id, text=text, also=ROW), "fingerprints", TEXTS_PER_BATCH)
    known = classes(hashed, threshold=threshold, block=block, pairs_from=pairs_from)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW).alias("key")
    placed = staged(_joined(hashed, known, "fp").select("class", *ROW, key), "class-rows")
    kept = placed.groupBy("class").agg(F.min("key").alias("kept"))
    gone = _joined(placed, kept, "class").where("key <> kept")
    return without_rows(rows, gone.select(*ROW))
