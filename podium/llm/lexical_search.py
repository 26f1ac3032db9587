"""Exact ranked lexical search: ball trees of sparse document vectors, searched best first.

A document's vector has a whole-number coordinate for each term, an item's vector the terms' weights;
the score is their inner product. Documents are searched in trees of nested balls: no document of a
ball scores more than the item's product with the centre plus the item's length, in the columns that the
ball has, times the radius. A ball whose bound is below the item's worst result so far is never opened.
Bounds are floating point and rounded up; documents in the leaves are scored in whole numbers.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from podium.llm.common import staged, unstage

TOP = 20
# Documents of one tree and of one leaf.
TREE_DOCS, LEAF_DOCS = 8192, 64
# Numbers that the centres of one tree hold at most; a tree that would need more has larger leaves.
CENTRE_ENTRIES = 16 << 20
# Items are searched in blocks of so many bytes of text, all documents for each block.
BLOCK_BYTES = 8 << 20
# Shares that an item's candidates are ranked in before all of them are.
SHARES = 64
# Letters and digits of ASCII and everything beyond it, in UTF-8.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

VECTORS = "doc_id long, n long, terms array<int>, times array<int>"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: A-Z lower-cased, in UTF-8."""
    return _TERM.findall((text or "").encode("utf-8", "replace").lower())


@dataclass
class Items:
    """A block of items: the distinct terms of all, and each item's terms with their numbers."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    rows: list[dict[int, int]]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        counted = [Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms(text)) for _, text in rows]
        return cls([own for own, _ in rows], vocabulary, counted)


@dataclass
class Statistics:
    """Documents with a term, all their terms, and for each term of the block its weight."""

    documents: int
    terms: int
    weights: np.ndarray

    @classmethod
    def of(cls, documents: int, all_terms: int, df: np.ndarray) -> Statistics:
        share = [(2 * documents + 2) / (2 * int(n) + 1) for n in df]
        return cls(documents, all_terms, np.array([math.floor(1000 * math.log(x)) for x in share], dtype=np.int64))

    def coordinates(self, n: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The coordinate of a term that occurs so many `times` in a document of `n` terms."""
        m = 75 + (25 * n * self.documents) // max(1, self.terms)
        return (1_000_000_000 * times) // (1000 * times + 12 * m)


# --- ball trees


class BallTree:
    """Balls over sparse rows (`starts`, `columns`, `values`, none negative), the order is the caller's.

    A ball is parted by two rows far from each other: rows go to the nearer one. A leaf has at most
    `leaf` rows, or rows that are all equal, or as many as :data:`CENTRE_ENTRIES` makes necessary.
    """

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int, leaf: int = LEAF_DOCS) -> None:
        self.starts, self.columns, self.values = starts, columns, values
        self.counts = np.diff(starts)
        self._floats = values.astype(np.float64)
        self._squares = self._sums(self._floats * self._floats, np.arange(len(self.counts)))
        self.centres, self.radii, self.children, self.leaves = [], [], [], []
        self._grow(np.arange(len(self.counts)), width, leaf)
        self.centres = np.array(self.centres)
        self.radii = np.array(self.radii)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some rows, and the rows' own starts among them."""
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - (ends - counts), counts)
        return at, ends - counts

    def _sums(self, entries: np.ndarray, rows: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """Sums of entries by row; `first` where the rows are not all of them in order."""
        first = self.starts[:-1] if first is None else first
        out = np.zeros(len(rows), dtype=entries.dtype)
        some = self.counts[rows] > 0
        if some.any():
            out[some] = np.add.reduceat(entries, first[some])
        return out

    def _distances(self, rows: np.ndarray, at: np.ndarray, first: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """Upper bounds of the rows' squared distances to a dense vector."""
        dots = self._sums(self._floats[at] * centre[self.columns[at]], rows, first)
        length = centre @ centre
        exact = self._squares[rows] - 2 * dots + length
        return np.maximum(exact, 0) + 1e-9 * (self._squares[rows] + length)

    def _dense(self, row: int, width: int) -> np.ndarray:
        out, part = np.zeros(width), slice(self.starts[row], self.starts[row + 1])
        out[self.columns[part]] = self._floats[part]
        return out

    def _grow(self, all_rows: np.ndarray, width: int, leaf: int) -> None:
        todo, pushed = [(-len(all_rows), 0, all_rows, None)], 0
        while todo:
            _, _, rows, parent = heapq.heappop(todo)  # the largest first
            own = len(self.centres)
            if parent is not None:
                self.children[parent].append(own)
            at, first = self._entries(rows)
            centre = np.bincount(self.columns[at], weights=self._floats[at], minlength=width) / max(1, len(rows))
            away = self._distances(rows, at, first, centre)
            self.centres.append(centre)
            self.radii.append(math.sqrt(away.max(initial=0.0)))
            self.children.append([])
            self.leaves.append(rows)
            if len(rows) <= leaf or (own + len(todo) + 3) * width > CENTRE_ENTRIES:
                continue
            one = self._distances(rows, at, first, self._dense(rows[away.argmax()], width))
            other = self._distances(rows, at, first, self._dense(rows[one.argmax()], width))
            near = one < other
            if near.all() or not near.any():
                if (one <= 1e-6 * (1 + self._squares[rows])).all():
                    continue  # equal rows
                near = np.arange(len(rows)) < len(rows) // 2
            self.leaves[own] = None
            for half in (rows[near], rows[~near]):
                pushed += 1
                heapq.heappush(todo, (-len(half), pushed, half, own))

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Whole-number products of some rows with a dense query."""
        at, first = self._entries(rows)
        return self._sums(self.values[at] * query[self.columns[at]], rows, first)

    def search(self, own: np.ndarray, weights: np.ndarray, query: np.ndarray, ids: np.ndarray, best: list, top: int) -> int:
        """Add to `best`, a heap of (score, -id), the rows that belong to the `top` best; the number of
        rows scored. `own` and `weights` are the query's columns and values, `query` is dense.
        """
        values = weights.astype(np.float64)
        centres = self.centres[:, own]
        # Only columns that some row of the ball has can add to a product.
        lengths = np.sqrt((centres > 0) @ (values * values))
        bounds = centres @ values + lengths * self.radii
        # Far more than the rounding errors of products and sums of this size.
        bounds += 1e-9 * bounds + 1
        queue, scored = [(-bounds[0], 0)], 0
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < (best[0][0] if len(best) == top else 1):
                break
            rows = self.leaves[node]
            if rows is None:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            scored += len(rows)
            found = self.scores(rows, query)
            least = best[0][0] if len(best) == top else 1
            for k in np.flatnonzero(found >= least).tolist():
                entry = (int(found[k]), -int(ids[rows[k]]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


# --- Spark


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, terms, times of every row with a term: of the vocabulary, each different term's
    number and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids, ns, owns, times = [], [], [], []
                for own_id, text_column in zip(part.column(0).to_pylist(), part.column(1)):
                    found = _TERM.findall((text_column.as_py() or b"").lower())
                    if found:
                        counted = Counter(found)
                        own = {k: c for t, c in counted.items() if (k := known(t)) is not None}
                        ids.append(own_id)
                        ns.append(len(found))
                        owns.append(list(own))
                        times.append(list(own.values()))
                columns = [pa.array(ids, pa.int64()), pa.array(ns, pa.int64())]
                columns += [pa.array(x, pa.list_(pa.int32())) for x in (owns, times)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, VECTORS)


def statistics(found: DataFrame, width: int) -> Statistics:
    """Over all vectors; the driver gets one number for each term of the items' block."""
    total = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(width, dtype=np.int64)
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    return Statistics.of(total["docs"], total["terms"] or 0, df)


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """All different items, in lists of bounded size."""
    rows = staged(
        items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
        .distinct()
        .where("text is not null"),
        "items",
    )
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-2 * total // block_bytes))
    for k in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect() if blocks > 1 else rows.collect()
        if own:
            yield [tuple(row) for row in own]
    unstage(rows)


def _candidates(found: DataFrame, items: Items, known: Statistics, top: int, tree_docs: int, leaf_docs: int) -> DataFrame:
    """item (its number in the block), doc_id, score: the `top` best of each task and item."""
    queries = []
    for row in items.rows:
        own = np.fromiter(row.keys(), np.int64, len(row))
        weights = known.weights[own] * np.fromiter(row.values(), np.int64, len(row))
        queries.append((own, weights))
    width = len(items.vocabulary)

    def trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, count = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, tree_docs):
                part = batch.slice(start, tree_docs)
                held.append(part)
                count += part.num_rows
                if count >= tree_docs:
                    yield pa.Table.from_batches(held)
                    held, count = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in queries]
        dense = np.zeros(width, dtype=np.int64)
        for table in trees(batches):
            ids = np.asarray(table.column("doc_id"), dtype=np.int64)
            n = np.asarray(table.column("n"), dtype=np.int64)
            listed = table.column("terms").combine_chunks(), table.column("times").combine_chunks()
            columns, times = (np.asarray(x.flatten(), dtype=np.int64) for x in listed)
            counts = np.asarray(listed[0].value_lengths(), dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(counts)])
            # The tree is over the columns that its documents have.
            present, columns = np.unique(columns, return_inverse=True)
            place = np.full(width, -1, dtype=np.int64)
            place[present] = np.arange(len(present))
            tree = BallTree(starts, columns, known.coordinates(np.repeat(n, counts), times), len(present), leaf_docs)
            dense = np.zeros(len(present), dtype=np.int64)
            for (own, weights), heap in zip(queries, best):
                here = place[own]
                shared = here >= 0
                if shared.any():
                    at, values = here[shared], weights[shared]
                    dense[at] = values
                    tree.search(at, values, dense, ids, heap, top)
                    dense[at] = 0
        rows = [(k, -minus, score) for k, heap in enumerate(best) for score, minus in heap]
        if rows:
            item, doc, score = (np.array(x, dtype=np.int64) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (item, doc, score)], names=["item", "doc_id", "score"])

    return found.mapInArrow(run, "item long, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    top: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    tree_docs: int = TREE_DOCS,
    leaf_docs: int = LEAF_DOCS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The `top` documents of each item: item_id, rank (from 1), doc_id, score.

    Statistics are over all documents and search is exact; equal scores are ranked by id. Items are
    taken in blocks of `block_bytes` of text, and all documents are read for each block. A document is
    reduced to its terms that some item of the block has, which are all that a score needs. Trees have
    `tree_docs` documents; each task keeps the best rows of its trees, which are ranked in shares and
    then together, so an item's candidates never meet in one task before most are gone.

    A null or empty text has no term: such a document does not count in the statistics, such an item
    has no result. Equal items are one; items that repeat an id with another text are ranked each on
    its own. Documents that repeat an id are ranked each on its own, ones without an id are counted in
    the statistics and never ranked. Other columns are ignored.
    """
    spark = docs.sparkSession
    results = []
    for block in _blocks(items, item_id, item_text, block_bytes):
        own = Items.of(block)
        found = staged(vectors(docs, own.vocabulary, doc_id=doc_id, text=text), "vectors")
        known = statistics(found, len(own.vocabulary))
        usable = found.where("doc_id is not null and size(terms) > 0")
        best = staged(_candidates(usable, own, known, top, tree_docs, leaf_docs), "candidates")
        unstage(found)
        order = [F.col("score").desc(), F.col("doc_id").asc()]
        share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).alias("share")
        shared = best.select("*", share).withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order)))
        ranked = shared.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        ids = spark.createDataFrame(list(enumerate(own.ids)), "item long, item_id long")
        results.append(
            ranked.where(F.col("rank") <= top).join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        )
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for part in results[1:]:
        whole = whole.unionByName(part)
    return whole
