"""Keys and references of every table.

The primary key of a table is its declared grain.  A column that has the name of
the one key column of a dimension refers to it, as do the columns in ``ROLES``.

Rows are counted by a hash of their key first, all tables in one job, so eight
bytes a row are dealt; a key whose hash no other row has is unique.  Only rows
whose hash repeats are counted by the key itself.  References are checked parent by parent: the distinct keys of all
children are united and meet the parent's keys once, so the parent is dealt once
however many tables refer to it, and a hot key is one row per child.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keys import packed, unpacked
from ..sources.sinks import materialize
from .registry import DATASETS

# fixed values: references whose column isn't named like the key referred to
ROLES = {"k_school__responsibility": "dim_school", "k_school__assignment": "dim_school"}

#: tables checked together, by subject
GROUPS = {
    "organizations": ("dim_lea", "dim_school", "dim_school_calendar", "dim_session", "dim_class_period", "dim_classroom", "dim_cohort"),
    "students": ("dim_student", "fct_student_school_association", "fct_student_cohort_association", "dim_parent",
                 "fct_student_parent_association"),
    "programs": ("dim_program", "fct_student_program_association", "fct_student_program_service",
                 "fct_student_program_participation_status", "fct_student_homeless_program_association",
                 "fct_student_special_education_program_association"),
    "courses": ("dim_course", "dim_course_section", "dim_grading_period", "fct_student_grades", "fct_student_section_association",
                "fct_staff_section_association", "brg_course_section_program"),
    "discipline": ("dim_discipline_incident", "fct_student_discipline_actions", "fct_student_discipline_incident_behaviors"),
    "assessments": ("dim_assessment", "dim_objective_assessment", "fct_student_assessment", "fct_student_objective_assessment"),
}


def parents() -> dict[str, str]:
    """Key column -> the dimension it is the key of."""
    return {d.grain[0]: d.name for d in DATASETS.values() if d.kind == "dim" and len(d.grain) == 1}


def references(wh, names) -> dict[str, list[tuple[str, str]]]:
    """Parent -> ``(child, column)`` of the tables."""
    known, out = {**parents(), **ROLES}, {}
    for name in names:
        for c in wh.table(name).columns:
            parent = known.get(c)
            if parent and parent != name:
                out.setdefault(parent, []).append((name, c))
    return out


def _by_key(wh, name: str) -> tuple[DataFrame, list[str]]:
    grain = list(DATASETS[name].grain)
    return wh.table(name).groupBy(*grain).agg(F.count(F.lit(1)).alias("__n")), grain


def _has_null(grain: list[str]):
    return reduce(lambda a, b: a | b, [F.col(g).isNull() for g in grain])


def _by_hash(wh, names, key_hash=F.xxhash64) -> tuple[dict[str, DataFrame], dict]:
    """Per table the rows whose key may repeat, as its hash does; and counts of the
    others, whose keys are surely single: ``single:i`` keys, ``null:i`` of them with a
    NULL, ``more:i`` hashes that repeat, of the i-th table.

    The repeated hashes are a written table, so Spark knows its size where it is
    joined.  Equal keys have equal hashes; different ones may, and are told apart later.
    """
    hashed = [wh.table(n).withColumn("__h", key_hash(*DATASETS[n].grain)) for n in names]
    each = reduce(DataFrame.unionByName, [
        t.select(F.lit(i).alias("__t"), "__h", _has_null(DATASETS[n].grain).alias("__null"))
        for i, (n, t) in enumerate(zip(names, hashed, strict=True))])
    counts = each.groupBy("__t", "__h").agg(F.count(F.lit(1)).alias("__n"), F.max("__null").alias("__null"))
    single, seen = F.col("__n") == 1, Observation()
    counts = counts.observe(seen, *[c for i in range(len(names)) for c in (
        F.count_if(single & (F.col("__t") == i)).alias(f"single:{i}"),
        F.count_if(single & F.col("__null") & (F.col("__t") == i)).alias(f"null:{i}"),
        F.count_if(~single & (F.col("__t") == i)).alias(f"more:{i}"))])
    more = materialize(counts.filter(~single).select("__t", "__h"), f"{wh.root}/repeated-{uuid.uuid4().hex}")
    rows = {n: t.join(more.filter(F.col("__t") == i).select("__h"), "__h", "left_semi").drop("__h")
            for i, (n, t) in enumerate(zip(names, hashed, strict=True))}
    return rows, seen.get


def repeated_keys(wh, name: str) -> DataFrame:
    """The keys of a table that repeat, with their rows ``n_records``."""
    grain = list(DATASETS[name].grain)
    rows, _ = _by_hash(wh, [name])
    return rows[name].groupBy(*grain).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def key_summary(wh, names, key_hash=F.xxhash64) -> DataFrame:
    """Per table its rows, distinct keys, repeated keys and rows with a
    NULL in the key."""
    rows, seen = _by_hash(wh, names, key_hash)
    out = []
    for i, name in enumerate(names):
        grain = list(DATASETS[name].grain)
        single, null = F.lit(seen[f"single:{i}"]), F.lit(seen[f"null:{i}"])
        keys = rows[name].groupBy(*grain).agg(F.count(F.lit(1)).alias("__n"))
        if not seen[f"more:{i}"]:
            keys = keys.filter(F.lit(False))
        out.append(keys.agg(
            F.lit(name).alias("table_name"), F.lit(",".join(grain)).alias("key_columns"),
            (F.coalesce(F.sum("__n"), F.lit(0)) + single).alias("n_rows"), (F.count(F.lit(1)) + single).alias("n_keys"),
            F.count_if(F.col("__n") > 1).alias("n_repeated_keys"),
            (F.coalesce(F.sum(F.when(_has_null(grain), F.col("__n"))), F.lit(0)) + null).alias("n_null_rows")))
    return reduce(DataFrame.unionByName, out)


def key_violations(wh, names) -> DataFrame:
    """The keys that break a constraint, as JSON, with their rows."""
    out = []
    for name in names:
        keys, grain = _by_key(wh, name)
        broken = F.when(_has_null(grain), "not_null").when(F.col("__n") > 1, "unique")
        out.append(keys.select(F.lit(name).alias("table_name"), broken.alias("constraint_name"),
                               F.to_json(F.struct(*grain), {"ignoreNullFields": "false"}).alias("key_json"),
                               F.col("__n").alias("n_records")).filter(F.col("constraint_name").isNotNull()))
    return reduce(DataFrame.unionByName, out)


def _met(wh, names) -> list[tuple[str, DataFrame]]:
    """Per parent the distinct keys its children hold, packed, and whether it has them."""
    out = []
    for parent, held in sorted(references(wh, names).items()):
        keys = reduce(DataFrame.unionByName, [
            wh.table(child).filter(F.col(column).isNotNull()).groupBy(packed(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(child).alias("table_name"), F.lit(column).alias("key_columns"), "key", "n") for child, column in held])
        own = wh.table(parent).select(packed(DATASETS[parent].grain[0]).alias("key"), F.lit(True).alias("known"))
        out.append((parent, keys.join(own, "key", "left")))
    return out


def reference_summary(wh, names) -> DataFrame:
    """Per reference its distinct keys and rows, and those without a parent."""
    orphan = F.col("known").isNull()
    return reduce(DataFrame.unionByName, [
        keys.groupBy("table_name", "key_columns").agg(
            F.lit(parent).alias("parent_name"), F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"),
            F.count_if(orphan).alias("n_orphan_keys"), F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("n_orphan_rows"))
        for parent, keys in _met(wh, names)])


def reference_violations(wh, names) -> DataFrame:
    """The keys without a parent, with their rows."""
    return reduce(DataFrame.unionByName, [
        keys.filter(F.col("known").isNull()).select("table_name", "key_columns", F.lit(parent).alias("parent_name"), unpacked("key").alias("key"),
                                                    F.col("n").alias("n_records"))
        for parent, keys in _met(wh, names)])


SUMMARIES = {
    **{f"dq_d32_keys_{g}": (lambda wh, names=names: key_summary(wh, names)) for g, names in GROUPS.items()},
    **{f"dq_d33_references_{g}": (lambda wh, names=names: reference_summary(wh, names)) for g, names in GROUPS.items()},
}
