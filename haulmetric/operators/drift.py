"""Payload drift: which shapes of message body a topic carries, with their fields and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def shape_of(body: Column) -> Column:
    """nested, flat, other JSON, or broken; a flat body may lack its vehicle."""
    has = lambda path: F.try_variant_get(body, path, "variant").isNotNull()
    return (
        F.when(body.isNull(), "broken")
        .when(has("$.telemetry"), "nested")
        .when(has("$.Vehicle_ID") | has("$.Timestamp"), "flat")
        .otherwise("other")
    )


def type_of(value: Column) -> Column:
    """A JSON type; how wide a number was stored is not the sender's doing."""
    found = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(found.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(found)


def payload_drift(bronze: DataFrame) -> DataFrame:
    """Rows (shape, field, type, bodies) for a topic that mixes payloads, in one pass.

    Bodies are parsed once, into VARIANT, with no schema given. Fields of objects in the body are
    named `outer.inner`; what lies deeper, or in arrays, is part of its field's type. A body that is
    null or no JSON is broken and has no fields; a field that is null has type VOID. The row with an
    empty field counts the bodies of a shape. Counts are combined before the shuffle, whose size is
    that of the shapes and not of the topic.
    """
    bodies = bronze.select(F.try_parse_json(F.col("value").cast("string")).alias("body"))
    shaped = bodies.select("body", shape_of(F.col("body")).alias("shape"))
    fields = bronze.sparkSession.sql(
        """
        SELECT shape, o.pos AS pos, o.key AS key, o.value AS value, i.pos AS inner_pos, i.key AS inner_key, i.value AS inner_value
        FROM {shaped}, LATERAL variant_explode_outer(body) AS o,
             LATERAL variant_explode_outer(if(schema_of_variant(o.value) LIKE 'OBJECT%', o.value, null)) AS i
        """,
        shaped=shaped,
    )
    # Each body, field and inner field once, by the first of the rows it is spread over.
    first_inner = F.coalesce(F.col("inner_pos"), F.lit(0)) == 0
    entry = lambda when, field, kind: F.when(when, F.struct(field.alias("field"), kind.alias("type")))
    none = F.lit("")
    found = F.array(
        entry(first_inner & (F.coalesce(F.col("pos"), F.lit(0)) == 0), none, none),
        entry(first_inner & F.col("key").isNotNull(), F.col("key"), type_of(F.col("value"))),
        entry(F.col("inner_key").isNotNull(), F.concat_ws(".", "key", "inner_key"), type_of(F.col("inner_value"))),
    )
    entries = fields.select("shape", F.inline(F.array_compact(found)))
    return entries.groupBy("shape", "field", "type").agg(F.count(F.lit(1)).alias("bodies"))


def merged_schema(bronze: DataFrame) -> DataFrame:
    """Rows (shape, schema): the one schema that holds all bodies of a shape, as a DDL-like text."""
    bodies = bronze.select(F.try_parse_json(F.col("value").cast("string")).alias("body"))
    return bodies.groupBy(shape_of(F.col("body")).alias("shape")).agg(F.schema_of_variant_agg("body").alias("schema"))
