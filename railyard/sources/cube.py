"""JSON-stat hypercubes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DIMENSION = "struct<category:struct<index:map<string,int>,label:map<string,string>>>"
_DOC = f"dimension struct<freq:{_DIMENSION},unit:{_DIMENSION},geo:{_DIMENSION},time:{_DIMENSION}>"


def decode_jsonstat(payloads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per observation of each document in ``payload``.

    The flat key is row-major over (freq, unit, geo, time).  A value whose JSON type
    is string or null is missing, also when the string looks like a number; keys that
    are not whole numbers or point outside the cube are skipped, and a document with
    a missing or empty dimension yields nothing.  The dimension dictionaries travel
    with each document, so decoding needs no shuffle.
    """
    kept = keep or []
    dims = payloads.select(
        *kept,
        F.from_json("payload", _DOC)["dimension"].alias("_d"),
        F.try_parse_json("payload").alias("_doc"),
    )
    index = {n: F.col(f"_d.{n}.category.index") for n in ("freq", "unit", "geo", "time")}
    size = {n: F.coalesce(F.size(m), F.lit(0)).alias(f"_n_{n}") for n, m in index.items()}
    by_position = {
        n: F.map_from_entries(
            F.transform(F.map_entries(index[n]), lambda e: F.struct(e["value"], e["key"]))
        ).alias(f"_{n}_at")
        for n in ("unit", "geo", "time")
    }
    cubes = dims.select(
        *kept,
        *size.values(),
        *by_position.values(),
        F.col("_d.geo.category.label").alias("_geo_label"),
        F.try_variant_get("_doc", "$.value", "map<string,variant>").alias("_cells"),
    ).where("_n_freq > 0 AND _n_unit > 0 AND _n_geo > 0 AND _n_time > 0")
    cells = cubes.select("*", F.explode("_cells").alias("_flat", "_v")).withColumn(
        "_k", F.col("_flat").try_cast("bigint")
    )
    present = F.col("_v").isNotNull() & ~F.schema_of_variant("_v").isin("STRING", "VOID")
    rest = F.expr("_k div _n_time")
    unit_rest = F.expr("(_k div _n_time) div _n_geo")
    rows = cells.where(present & F.col("_k").isNotNull() & (F.col("_k") >= 0)).select(
        *kept,
        F.try_element_at("_geo_at", (rest % F.col("_n_geo")).cast("int")).alias("country_code"),
        "_geo_label",
        F.try_element_at("_unit_at", (unit_rest % F.col("_n_unit")).cast("int")).alias("unit"),
        F.try_element_at("_time_at", (F.col("_k") % F.col("_n_time")).cast("int")).alias("period"),
        F.try_variant_get("_v", "$", "double").alias("value"),
        (F.expr("((_k div _n_time) div _n_geo) div _n_unit") < F.col("_n_freq")).alias("_inside"),
    )
    return rows.where(
        F.col("_inside")
        & F.col("country_code").isNotNull()
        & F.col("unit").isNotNull()
        & F.col("period").isNotNull()
    ).select(
        *kept,
        "country_code",
        F.try_element_at("_geo_label", "country_code").alias("country_name"),
        "unit",
        "period",
        "value",
    )
