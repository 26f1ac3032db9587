"""Rows as JSON messages and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from podium.functions.names import column


def to_messages(df: DataFrame, key: str | Column | None = None) -> DataFrame:
    """One message per row: the whole row as JSON text in `value`, and `key` as text where given.

    Null fields are left out of the JSON. Messages without a key are spread over a topic's
    partitions; with one, equal keys stay in order in one partition. A field of the payload may be
    the key, also one that is itself called ``value``.
    """
    payload = F.to_json(F.struct(*[column(name) for name in df.columns])).alias("value")
    if key is None:
        return df.select(payload)
    return df.select(column(key).cast("string").alias("key"), payload)


def parse_messages(
    messages: DataFrame,
    schema: str | StructType,
    bad_record: str | None = None,
    carry: Sequence[str] = (),
    only: Sequence[str] | None = None,
) -> DataFrame:
    """The fields of `schema` out of each message's `value`, preceded by the columns in `carry`.

    Nothing is rejected: a message that is no JSON object gives a row of nulls, a field of the
    wrong type gives null for that field, unknown fields are ignored, and names are matched with
    their case. `bad_record` names an extra column holding the raw text of messages that are
    malformed or mistyped, null for good ones. `only` restricts the fields of `schema` to those
    named; the others are skipped over in the text instead of being converted.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    schema = StructType([f for f in schema.fields if only is None or f.name in only])
    options = {}
    if bad_record is not None:
        schema = schema.add(bad_record, StringType())
        options["columnNameOfCorruptRecord"] = bad_record
    payload = F.from_json(column("value").cast("string"), schema, options)
    # `inline` of the one struct gives the same columns as `payload.*`, but conditions on them
    # (numbers present, join key present) are not pushed below it. Below it they would parse the
    # text again, once per condition.
    fields = F.inline(F.array(payload))
    return messages.select(*[column(name) for name in carry], fields)


def observe_bad(parsed: DataFrame, bad_record: str, name: str = "messages") -> DataFrame:
    """`parsed`, counting all and bad messages while it is being computed.

    The two counts appear as the observed metric `name` with each micro-batch's progress. They
    cost no extra pass over the data.
    """
    return parsed.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count(column(bad_record)).alias("bad"),
    )


def parse_variants(
    messages: DataFrame, name: str = "payload", carry: Sequence[str] = ()
) -> DataFrame:
    """Each message's `value` as a VARIANT in the column `name`, preceded by the columns in `carry`.

    For payloads that no schema describes: any JSON is kept, whatever its fields and types, in a binary
    form that is parsed once and read by path. Text that is no JSON gives null.
    """
    payload = F.try_parse_json(column("value").cast("string")).alias(name)
    return messages.select(*[column(c) for c in carry], payload)


def variant_fields(
    df: DataFrame, fields: Mapping[str, tuple[str, str]], name: str = "payload"
) -> DataFrame:
    """`df` with fields out of the VARIANT column `name`, which goes: name of the new column to path
    (``$.a.b[0]``) and type.

    A field that is missing, or not convertible to the type, is null in that row only.
    """
    found = {new: F.try_variant_get(column(name), path, to) for new, (path, to) in fields.items()}
    return df.withColumns(found).drop(name)


def payload_schema(messages: DataFrame) -> str:
    """The schema that all messages together have, as Spark writes it: ``OBJECT<a: BIGINT, ...>``.

    One aggregation, combined in every task. A field whose types do not go together is a VARIANT.
    """
    payload = F.try_parse_json(column("value").cast("string"))
    return messages.agg(F.schema_of_variant_agg(payload)).first()[0]
