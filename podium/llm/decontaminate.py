"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Only built-in expressions run on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import ROW, numbered, staged, unstage, without_rows

SIZE = 5
SIMILARITY = 0.8
# Bits by which a window's and an item's fingerprints differ at most.
RADIUS = 16
BITS = 64
# Most keys (a shingle with its few sizes, or a document's two numbers) that are sent to all
# executors; above it they are joined by a shuffle. The results do not depend on it.
MOST_BROADCAST = 1_000_000


def _bound(value: Column, use) -> Column:
    """`use` of an expression that is evaluated once, however often `use` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingles(text: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, in order; lower case, anything but letters and digits parts
    words. None for a shorter text, or one without words."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "))

    def hashes(words: Column) -> Column:
        starts = F.when((F.size(words) >= size) & (F.get(words, F.lit(0)) != ""), F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))

    return _bound(F.split(plain, " "), hashes)


def simhash(hashes: Column) -> Column:
    """The bits that are set in over half of the hashes. Bits k and k + 32 are counted together, in
    the two halves of a long."""
    half = BITS // 2
    lanes = F.transform(
        F.sequence(F.lit(0), F.lit(half - 1)),
        lambda k: F.aggregate(
            hashes, F.lit(0).cast("long"), lambda a, x: a + F.call_function("shiftright", x, k).bitwiseAND(F.lit(0x100000001))
        ),
    )

    def bits(sums: Column) -> Column:
        def put(a: Column, k: Column) -> Column:
            count = F.get(sums, k % half)
            count = F.when(k < half, count.bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned(count, half))
            on = F.when(count * 2 > F.size(hashes), F.lit(1)).otherwise(F.lit(0)).cast("long")
            return a.bitwiseOR(F.call_function("shiftleft", on, k))

        return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), put)

    return _bound(lanes, bits)


def _numbered(hashes: Column) -> Column:
    """Shingles as a set: each with the number of its occurrence, so that equal ones count apart."""
    return _bound(
        F.array_sort(hashes),
        lambda s: F.transform(s, lambda x, i: F.xxhash64(x, i.cast("long") - F.array_position(s, x))),
    )


def _blocks(fp: Column, radius: int) -> Column:
    """The fingerprint in `radius` + 1 blocks: within the radius, at least one block is equal."""
    count = radius + 1
    ends = [BITS * k // count for k in range(count + 1)]
    return F.array(
        *(
            F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << (to - at)) - 1)).alias("bits"))
            for k, (at, to) in enumerate(zip(ends, ends[1:]))
        )
    )


def _hint(keys: DataFrame, most_broadcast: int) -> DataFrame:
    return keys.hint("broadcast" if keys.count() <= most_broadcast else "shuffle_hash")


def _short_items(docs: DataFrame, benchmark: DataFrame, size: int, item_id: str, item_text: str, most_broadcast: int) -> DataFrame | None:
    """doc_id, item_id, similarity, first_word, n_words where an item of fewer than `size` words is found
    whole; None if there is no such item. A window of its length has one shingle, and equals it or not."""
    plain = shingles(F.col(item_text), 1)
    short = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text"), F.size(plain).alias("k"))
    short = staged(short.where((F.col("k") > 0) & (F.col("k") < size)), "short-items")
    found = None
    for k in sorted(row["k"] for row in short.select("k").distinct().collect()):  # fewer than `size` lengths
        own = short.where(F.col("k") == k).select("item_id", shingles(F.col("item_text"), k).getItem(0).alias("shingle")).distinct()
        part = (
            docs.select("doc_id", F.posexplode(shingles(F.col("text"), k)).alias("at", "shingle"))
            .join(_hint(own, most_broadcast), "shingle")
            .groupBy("doc_id", "item_id")
            .agg(F.min("at").cast("long").alias("first_word"))
            .select("doc_id", "item_id", F.lit(1.0).alias("similarity"), "first_word", F.lit(k).cast("long").alias("n_words"))
        )
        found = part if found is None else found.unionByName(part)
    return found


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    size: int = SIZE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, similarity, first_word,
    n_words of the most similar window (the first of them, on a tie).

    A window has as many shingles as the item (fewer at the end of a text) and is compared with it
    if their fingerprints are within `radius` bits; the similarity is the weighted Jaccard
    similarity of their `size`-word shingles, weighted by occurrences. A window is opened at each
    shingle that some item has, in that item's size. That loses nothing: while a window's first
    shingle is not the item's, moving on by one word takes a foreign shingle out, and no similarity. Nor
    does leaving out windows in which fewer than `similarity` of the item's number of shingles are in
    any item of that size: so many have to be shared. Fingerprints meet by equal blocks, and only those
    of items that have the window's first shingle.

    Equal windows are compared once, however many texts hold them. An item of fewer than `size` words is
    found where all its words stand together. Null texts and items, and texts of fewer words than an item,
    match nothing. Very long texts are searched whole. Rows that repeat an id count as one document per
    id; a row without an id cannot be reported. Repeated items are each reported. Other columns are
    ignored. Empty tables give no row.
    """
    items = staged(
        benchmark.select(F.col(item_id).alias("item_id"), shingles(F.col(item_text), size).alias("item"))
        .where("size(item) > 0")
        .select("item_id", "item", F.size("item").alias("n"), simhash(F.col("item")).alias("item_fp"))
        .distinct(),
        "items",
    )
    sizes = staged(items.select(F.explode("item").alias("shingle"), "n").groupBy("shingle").agg(F.collect_set("n").alias("sizes")), "sizes")
    own = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shingled = own.select("doc_id", F.xxhash64("text").alias("text_hash"), shingles(F.col("text"), size).alias("own"))
    opened = staged(
        shingled.select("doc_id", "text_hash", F.posexplode("own").alias("at", "shingle"))
        .join(_hint(sizes, most_broadcast), "shingle")
        .select("doc_id", "text_hash", F.struct("at", "sizes").alias("start"))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("start")).alias("starts")),
        "opened",
    )
    # Only texts with a start are read again for their windows: two numbers a text find them.
    key = ["doc_id", "text_hash"]

    def enough(s: Column, i: Column, n: Column) -> Column:
        """Whether the window of n shingles from the start s, the i-th, has shingles enough of items."""
        near = F.filter(F.slice(F.col("starts"), i + 1, n), lambda x: (x["at"] < s["at"] + n) & F.array_contains(x["sizes"], n))
        return F.size(near) >= n * similarity - 1e-9

    def chosen(s: Column, i: Column) -> Column:
        return F.transform(F.filter(s["sizes"], lambda n: enough(s, i, n)), lambda n: F.struct(s["at"].alias("at"), n.alias("n")))

    places = staged(
        opened.select(*key, F.flatten(F.transform("starts", chosen)).alias("places")).where("size(places) > 0"), "places"
    )
    unstage(opened)
    texts = own.withColumn("text_hash", F.xxhash64("text"))
    texts = texts.join(_hint(places.select(*key), most_broadcast), key, "left_semi").join(places, key)

    def cut(own_shingles: Column) -> Column:
        return F.transform(
            "places",
            lambda p: F.struct(p["at"].alias("at"), p["n"].alias("n"), F.slice(own_shingles, p["at"] + 1, p["n"]).alias("window")),
        )

    windows = staged(
        texts.select("doc_id", F.explode(_bound(shingles(F.col("text"), size), cut)).alias("w"))
        .select("doc_id", "w.*")
        .withColumn("content", F.xxhash64("window", "n")),
        "windows",
    )
    unstage(places)
    # One row per different window; bytes of the window decide, not its hash.
    distinct = staged(
        windows.groupBy("content", "n", "window").agg(F.count(F.lit(1)).alias("_")).select(
            "content", "n", "window", simhash(F.col("window")).alias("fp")
        ),
        "distinct-windows",
    )
    block = F.explode(_blocks(F.col("fp"), radius)).alias("b")
    item_block = F.explode(_blocks(F.col("item_fp"), radius)).alias("b")
    has = items.select("*", F.explode(F.array_distinct("item")).alias("first"))
    near = (
        distinct.select("content", "n", F.get("window", F.lit(0)).alias("first"), "fp", block)
        .join(has.select("item_id", "item", "n", "item_fp", "first", item_block), ["n", "first", "b"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select("content", "n", "item_id", "item")
        .distinct()
    )
    shared = F.size(F.array_intersect(_numbered(F.col("window")), _numbered(F.col("item"))))
    verified = distinct.join(near, ["content", "n"]).select(
        "content", "n", "window", "item_id", (F.size("window") + F.size("item")).alias("total"), shared.alias("shared")
    )
    verified = verified.withColumn("similarity", F.col("shared") / (F.col("total") - F.col("shared"))).where(
        F.col("similarity") >= similarity
    )
    found = windows.join(verified, ["content", "n", "window"])
    best = F.max_by(F.struct("at", F.size("window").alias("count")), F.struct("similarity", -F.col("at"), -F.col("n")))
    whole = (
        found.groupBy("doc_id", "item_id")
        .agg(F.max("similarity").alias("similarity"), best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            "similarity",
            F.col("best.at").cast("long").alias("first_word"),
            (F.col("best.count") + size - 1).cast("long").alias("n_words"),
        )
    )
    short = _short_items(own, benchmark, size, item_id, item_text, most_broadcast)
    if short is None:
        return whole
    # An id that is repeated by items of both kinds is reported once.
    return whole.unionByName(short).groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"),
        F.max_by(F.struct("first_word", "n_words"), F.struct("similarity", -F.col("first_word"))).alias("best"),
    ).select("doc_id", "item_id", "similarity", "best.first_word", "best.n_words")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without the documents that hold a benchmark item, all columns as they are. Rows are told
    apart by their place, so neither a null nor a repeated id matters."""
    rows = numbered(docs)
    found = contaminated(rows.withColumn("_podium_key", F.struct(*ROW)), benchmark, doc_id="_podium_key", **options)
    return without_rows(rows, found.select("doc_id.*").distinct())
