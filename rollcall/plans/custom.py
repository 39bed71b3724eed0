"""Config-injected columns (P6 P7 P8) and their source checks.

``Config.custom_columns[dataset]`` is a tuple of ``(source, column, sql)``:
``sql`` is evaluated over the dataset row, left-joined on the dataset key to
``source`` (a staging relation or dataset) when a source is named.
``Config.extensions[dataset]`` lists extra staging columns passed through.
Expressions are trusted configuration, never user data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checks import check


def add_custom_columns(wh, dataset: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    specs = wh.config.custom_columns.get(dataset, ())
    sources = {}
    for source, _col, _sql in specs:
        if source and source not in sources:
            src = wh(source)
            # source columns are reachable as <source>.<column> in the expression
            sources[source] = src.alias(source)
    out = df.alias("__base")
    for name, src in sources.items():
        cond = [F.col(f"__base.{k}") == F.col(f"{name}.{k}") for k in key]
        out = out.join(src, cond, "left")
    extra = [F.expr(sql).alias(col) for _s, col, sql in specs]
    if not extra:
        return df
    return out.select(*[F.col(f"__base.{c}").alias(c) for c in df.columns], *extra)


def extension_columns(wh, staging: str) -> list:
    """The extension columns configured for a staging relation: one that it
    has, by name, or ``(name, path, type)`` read from its JSON column ``v_ext``."""
    out = []
    for spec in wh.config.extensions.get(staging, ()):
        if isinstance(spec, str):
            out.append(F.col(spec))
        else:
            name, path, kind = spec
            out.append(F.try_variant_get(F.try_parse_json("v_ext"), path, kind).alias(name))
    return out


def extension_names(wh, staging: str) -> list[str]:
    return [spec if isinstance(spec, str) else spec[0] for spec in wh.config.extensions.get(staging, ())]


def add_extensions(wh, staging: str, df: DataFrame) -> DataFrame:
    """A staging relation with its configured extension columns."""
    more = [c for c, n in zip(extension_columns(wh, staging), extension_names(wh, staging), strict=True) if n not in df.columns]
    return df.select("*", *more)


def custom_source_duplicates(wh, dataset: str, key: Sequence[str]) -> DataFrame:
    """A configured source must be unique on the dataset key."""
    out = None
    for source in sorted({s for s, _c, _e in wh.config.custom_columns.get(dataset, ()) if s}):
        d = (wh(source).groupBy(*key).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)
             .withColumn("data_source", F.lit(source)))
        out = d if out is None else out.unionByName(d)
    if out is None:
        schema = ", ".join(f"{k} string" for k in key) + ", n_records bigint, data_source string"
        return wh.spark.createDataFrame([], schema)
    return out


@check("d15_custom_course_section_sources_unique", "error")
def custom_course_section_sources_unique(wh) -> DataFrame:
    return custom_source_duplicates(wh, "dim_course_section", ["k_course_section"])


@check("custom_school_sources_unique", "error")
def custom_school_sources_unique(wh) -> DataFrame:
    return custom_source_duplicates(wh, "dim_school", ["k_school"])


@check("d16_custom_course_sources_unique", "error")
def custom_course_sources_unique(wh) -> DataFrame:
    return custom_source_duplicates(wh, "dim_course", ["k_course"])


@check("d17_custom_student_sources_unique", "error")
def custom_student_sources_unique(wh) -> DataFrame:
    return custom_source_duplicates(wh, "dim_student", ["k_student"])


@check("d19_grade_level_override_unique", "error")
def grade_level_override_unique(wh) -> DataFrame:
    """The grade override source must be unique on k_student."""
    if not wh.config.grade_level_override:
        return wh.spark.createDataFrame([], "k_student string, n_records bigint")
    source, _ = wh.config.grade_level_override
    return (wh(source).groupBy("k_student").agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))
