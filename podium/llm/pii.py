"""Personal data: fixed patterns, and terms that give the protected values away.

Only built-in expressions run on the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from podium.llm.common import hinted, is_small, staged, unstage

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# The same matches as the plain patterns. Quantifiers that never have to give anything back are
# possessive, and a match starts only where a run of its first characters starts, or where the match
# before has ended: no run is tried from each of its characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text has to contain for the pattern to be tried.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_TERMS = r"\p{L}[\p{L}\p{M}'’-]+"
# A term is removed when it gives away so large a part of a value's information,
DISCLOSURE = 0.8
# ... by a smoothed estimate: as if so many more documents had the term, and the value as often as others.
SMOOTHING = 2.0
# How many terms may be taken for revealing by chance alone, in all of a corpus.
CHANCE = 0.05
# Keys of so many bytes at most are sent to all executors; more are joined by a shuffle.
MOST_BYTES = 32 << 20


def text_key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text.cast("binary")))


def _located(text: Column, kind: str) -> Column:
    """All matches of a kind, in order, each with the length of the text that parts it from the one before."""
    pattern = PATTERNS[kind]
    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("values"), F.split(text, pattern, -1).alias("gaps")
    )

    def described(found: Column) -> Column:
        def one(value: Column, i: Column) -> Column:
            before = F.get(found["gaps"], i)
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                i.alias("i"),
                F.length(before).alias("gap"),
                value.alias("value"),
            )

        return F.transform(found["values"], one)

    needed = text.contains(_NEEDS[kind]) if kind in _NEEDS else text.rlike("[0-9]")
    # A one-element array binds the matches once for all of the inner expressions.
    return F.when(needed, F.flatten(F.transform(F.array(both), described)))


def _valid() -> Column:
    digits = F.regexp_replace("value", "[^0-9]", "")
    count = F.length(digits)
    return (
        F.when(F.col("kind") == 1, F.col("value").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(F.col("kind") == 2, F.when(count.between(13, 19), F.call_function("luhn_check", digits)).otherwise(False))
        .when(F.col("kind") == 3, count.between(9, 15))
        .otherwise(True)
    )


def personal_values(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per value found: doc_id, text_hash, kind, start, end, value.

    kind is the index in ``KINDS``; start and end count code points, end exclusive. The
    positions are running sums over the matches of one text.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), content.alias("text"))
    found = F.concat(*(F.coalesce(_located(F.col("text"), kind), F.array()) for kind in KINDS))
    hits = rows.select("doc_id", text_key(F.col("text")).alias("text_hash"), F.explode(found).alias("hit")).select(
        "doc_id", "text_hash", "hit.*"
    )
    # Rows that repeat an id and a text have the same matches.
    hits = hits.dropDuplicates(["doc_id", "text_hash", "kind", "i"])
    so_far = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    width = F.length("value").cast("long")
    end = F.sum(F.col("gap") + width).over(so_far)
    return (
        hits.withColumn("end", end)
        .withColumn("start", F.col("end") - width)
        .where(_valid())
        .select("doc_id", "text_hash", "kind", "start", "end", "value")
    )


def _entity() -> Column:
    """A value as it is counted: without the ways of writing it."""
    plain = F.when(F.col("kind").isin(2, 3), F.regexp_replace("value", "[^0-9]", "")).otherwise(F.lower("value"))
    return F.concat_ws(":", F.col("kind"), plain)


def _prose(text: Column) -> Column:
    """The text with spaces in place of its e-mail addresses, whose parts are not terms."""
    pattern = PATTERNS["email"]
    blank = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda v: F.repeat(F.lit(" "), F.length(v)))
    parts = F.zip_with(F.split(text, pattern, -1), blank, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.contains("@"), F.array_join(parts, "")).otherwise(text)


def _terms_of(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_prose(text), F.lit(_TERMS), 0), F.lower))


def _places(texts: DataFrame) -> DataFrame:
    """text_hash, term, start and end of every term of every text."""
    prose = texts.select("text_hash", _prose(F.col("text")).alias("text"))
    gaps = F.transform(F.split("text", _TERMS, -1), F.length)
    found = F.arrays_zip(F.regexp_extract_all("text", F.lit(_TERMS), 0).alias("value"), gaps.alias("gap"))
    rows = prose.select("text_hash", F.posexplode(found).alias("i", "t")).select("text_hash", "i", "t.*")
    # Behind the last term there is one more gap.
    rows = rows.where("value is not null")
    so_far = Window.partitionBy("text_hash").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    width = F.length("value").cast("long")
    end = F.sum(F.col("gap") + width).over(so_far)
    return rows.select("text_hash", F.lower("value").alias("term"), (end - width).alias("start"), end.alias("end"))


def revealing_terms(
    docs: DataFrame,
    values: DataFrame,
    *,
    disclosure: float = DISCLOSURE,
    smoothing: float = SMOOTHING,
    chance: float = CHANCE,
    text: str = "text",
    most_bytes: int = MOST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """text_hash, term of the terms that give protected values of their text away; and the texts.

    Protected is a value, and the having of a value of some kind. Values that the same texts hold are
    one class, as no term tells them apart, and each kind is a class. Over all documents, the information
    that a term t gives about a class c is their pointwise mutual information, log N n(t, c) / (n(t) n(c)),
    and c's own information is log N / n(c), where n counts documents, whatever the distance of t and c in
    them. A term reveals a class if

    * its share of the information, smoothed by `smoothing` documents that hold c as often as any,
      reaches `disclosure`: it hardly occurs in documents without the class; and
    * they meet more often than chance explains. By chance a term of n(t) documents meets the class in
      n(t) n(c) / N of them; the probability of n(t, c) or more is bounded (Chernoff, for a Poisson
      number), and has to be below `chance` divided by the number of pairs looked at. Among many rare
      words some occur in a document that holds a value, and are not taken for revealing; and one text
      alone, however often it is copied, does not tell one of its words from another.

    It is marked wherever it occurs in a document that holds the class.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(content.alias("text")).withColumn("text_hash", text_key(F.col("text")))
    held = staged(values.select("text_hash", "kind", _entity().alias("entity")).distinct(), "entities")
    hashes = staged(held.select("text_hash").distinct(), "hashes")
    # Equal texts have the same values and terms: they are kept once, with their number.
    texts = staged(
        rows.join(hinted(hashes, most_bytes), "text_hash", "left_semi")
        .groupBy("text_hash")
        .agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("m")),
        "texts",
    )
    n = float(max(docs.count(), 1))
    # Values with the same texts: the same number of them, and the same combination of their hashes.
    bits = [F.bit_xor(F.xxhash64(F.lit(k), "text_hash")).alias(f"x{k}") for k in (1, 2)]
    sets = held.groupBy("entity").agg(F.count(F.lit(1)).alias("texts"), *bits).where("texts > 1")
    name = F.concat_ws(":", F.lit("set"), "texts", "x1", "x2").alias("class")
    of_values = held.join(sets.select("entity", name), "entity").select("text_hash", "class").distinct()
    of_kinds = held.select("text_hash", F.concat(F.lit("kind:"), F.col("kind").cast("string")).alias("class")).distinct()
    classes = staged(of_values.unionByName(of_kinds).join(texts.select("text_hash", "m"), "text_hash"), "classes")
    sizes = staged(
        classes.groupBy("class").agg(F.sum("m").alias("n_class")).where(F.col("n_class") < n), "class-sizes"
    )
    own = staged(texts.select("text_hash", F.explode(_terms_of(F.col("text"))).alias("term")), "text-terms")
    pairs = own.join(classes, "text_hash")
    counts = F.sum("m").alias("n_both"), F.count(F.lit(1)).alias("n_texts")
    together = staged(pairs.groupBy("class", "term").agg(*counts).join(sizes, "class"), "together")
    looked_at = max(together.count(), 1)
    # The least n(t) is n(t, c): what chance explains even then needs no count over all documents.
    k, least = F.col("n_both"), F.col("n_both") * F.col("n_class") / n

    def surprise(expected: Column) -> Column:
        return F.when(k > expected, k * F.log(k / expected) - k + expected).otherwise(0.0)

    needed = math.log(looked_at / chance)
    hopeful = staged(together.where((F.col("n_texts") > 1) & (surprise(least) >= needed)), "hopeful")
    wanted = staged(hopeful.select("term").distinct(), "terms")
    every = rows.select(F.explode(_terms_of(F.col("text"))).alias("term"))
    if is_small(wanted, most_bytes):
        counted = every.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    else:  # counted in every task before the counts, and not the terms, are dealt out
        counted = every.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(wanted, "term", "left_semi")
    share = F.col("n_class") / n
    given = F.log2((k + smoothing * share) / (F.col("n_term") + smoothing) / share)
    revealing = staged(
        hopeful.join(counted, "term")
        .where(given / -F.log2(share) >= disclosure)
        .where(surprise(F.col("n_term") * F.col("n_class") / n) >= needed)
        .select("class", "term"),
        "revealing",
    )
    marked = staged(
        own.join(hinted(revealing, most_bytes), "term")
        .join(classes.select("text_hash", "class"), ["text_hash", "class"], "left_semi")
        .select("text_hash", "term")
        .distinct(),
        "marked",
    )
    for frame in (held, hashes, classes, sizes, own, together, hopeful, wanted, revealing):
        unstage(frame)
    return marked, texts


def revealing_spans(docs: DataFrame, values: DataFrame, **options) -> DataFrame:
    """text_hash, start, end of every :func:`revealing_terms` in its texts."""
    marked, texts = revealing_terms(docs, values, **options)
    holders = texts.join(marked.select("text_hash").distinct(), "text_hash", "left_semi")
    return _places(holders).join(marked, ["text_hash", "term"]).select("text_hash", "start", "end")


def private_spans(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    disclosure: float = DISCLOSURE,
    smoothing: float = SMOOTHING,
    chance: float = CHANCE,
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, spans (array of kind, start, end, in order).

    kind is the index in ``KINDS``, or its length for a term of :func:`revealing_terms`. A null text
    counts as empty and has no spans. Rows that repeat an id and a text get the same spans; an id
    may be null. Very long texts are searched whole. Other columns are ignored. An empty table gives no
    row.
    """
    values = staged(personal_values(docs, doc_id=doc_id, text=text), "values")
    terms = revealing_spans(docs, values, disclosure=disclosure, smoothing=smoothing, chance=chance, text=text)
    span = F.struct(F.lit(len(KINDS)).alias("kind"), "start", "end")
    terms = terms.groupBy("text_hash").agg(F.collect_list(span).alias("terms"))
    spans = values.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("kind", "start", "end")).alias("spans"))
    spans = spans.join(terms, "text_hash", "left").select(
        "doc_id", "text_hash", F.sort_array(F.concat("spans", F.coalesce("terms", F.array()))).alias("spans")
    )
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), text_key(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_hash")
    )
    same = rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["text_hash"] == spans["text_hash"])
    empty = F.array().cast(spans.schema["spans"].dataType)
    return rows.join(spans, same, "left").select(
        rows["doc_id"], rows["text_hash"], F.coalesce(spans["spans"], empty).alias("spans")
    )


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans of those kinds, comma-joined."""
    names = F.array(*(F.lit(kind) for kind in (*KINDS, TERM)))
    own = F.filter(spans, lambda s: s["kind"].isin(*((*KINDS, TERM).index(kind) for kind in kinds)))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every value generalised to its kind, such as [email], and revealing terms removed."""
    names = F.array(*(F.lit(f"[{kind}]") for kind in KINDS), F.lit(""))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done: Column, s: Column) -> Column:
        # Spans of different kinds may overlap: what is gone already stays gone.
        kept = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(s["start"] - done["at"], F.lit(0)).cast("int"))
        new = F.when(s["end"] > done["at"], F.concat(done["out"], kept, F.get(names, s["kind"]))).otherwise(done["out"])
        return F.struct(new.alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    return F.aggregate(
        ordered, start, step,
        lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))),
    )
