"""Parents / contacts and their links to students."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import accordion
from ..operators.dedupe import row_pluck
from ..operators.joins import seed
from ..operators.reshape import crosswalk_values, pivot_values
from .checks import check
from .registry import dataset


def _wide(wh, stage: str, xwalk: str, orig: str, norm: str, type_col: str, value: str, suffix: str) -> DataFrame:
    """X1 + S10: pivot a contact attribute by its normalized type; no crosswalk rows -> no columns."""
    xw = seed(wh(xwalk))
    st = wh(stage)
    j = st.join(xw, st[type_col] == xw[orig]).withColumnRenamed("k_contact", "k_parent")
    return pivot_values(j, ["k_parent", "tenant_code"], norm, crosswalk_values(xw, norm), value, agg="max",
                        suffix=suffix)


@dataset("bld_parent_wide_emails", grain=("k_parent", "tenant_code"))
def parent_wide_emails(wh) -> DataFrame:
    return _wide(wh, "stg_ef3__contacts__emails", "xwalk_parent_email_types", "original_email_type",
                 "normalized_email_type", "email_type", "email_address", "_email_address")


@dataset("bld_parent_wide_phone_numbers", grain=("k_parent", "tenant_code"))
def parent_wide_phone_numbers(wh) -> DataFrame:
    return _wide(wh, "stg_ef3__contacts__telephones", "xwalk_parent_phone_number_types", "original_phone_number_type",
                 "normalized_phone_number_type", "phone_number_type", "phone_number", "_phone_number")


@dataset("dim_parent", grain=("k_parent",))
def dim_parent(wh) -> DataFrame:
    """Contacts with wide phones and e-mails (P4 accordion) and a publishable
    address, Home preferred (R2 with a filter)."""
    c = wh("stg_ef3__contacts")
    phones = wh("bld_parent_wide_phone_numbers")
    emails = wh("bld_parent_wide_emails")
    addr = row_pluck(wh("stg_ef3__contacts__addresses"), "k_contact", "address_type", "Home",
                     where=F.col("do_not_publish").isNull() | ~F.col("do_not_publish")).select("k_contact", "full_address")
    j = (c.join(phones.drop("tenant_code"), c.k_contact == phones.k_parent, "left").drop("k_parent")
         .join(emails.drop("tenant_code"), c.k_contact == emails.k_parent, "left").drop("k_parent")
         .join(addr, "k_contact", "left"))
    return j.select(F.col("k_contact").alias("k_parent"), "tenant_code", F.col("api_year").alias("school_year"),
                    F.col("contact_unique_id").alias("parent_unique_id"),
                    F.concat(F.col("last_name"), F.lit(", "), F.col("first_name")).alias("display_name"),
                    "first_name", "last_name",
                    *accordion(phones, exclude=["k_parent", "tenant_code"]),
                    *accordion(emails, exclude=["k_parent", "tenant_code"]), "full_address")


@dataset("fct_student_parent_association", grain=("k_student", "k_parent"))
def fct_student_parent_association(wh) -> DataFrame:
    """The links of each student's most recent year, spread to every
    annual student row of the same cross-year student."""
    s = wh("stg_ef3__student_contact_associations")
    stu = wh("dim_student").select("k_student", "k_student_xyear", "is_latest_record")
    latest = stu.filter(F.col("is_latest_record")).select("k_student")
    fan = stu.select(F.col("k_student").alias("__k_student"), F.col("k_student_xyear").alias("__xyear"))
    par = wh("dim_parent").select("k_parent")
    j = (s.join(latest, "k_student").join(fan, s.k_student_xyear == fan.__xyear)
         .join(par, s.k_contact == par.k_parent))
    return j.select(F.col("__k_student").alias("k_student"), F.col("__xyear").alias("k_student_xyear"), "k_parent",
                    "tenant_code", "school_year", "contact_priority", "relation_type", "is_emergency_contact",
                    "is_primary_contact")


@check("d14_students_with_multiple_primary_contacts")
def multiple_primary_contacts(wh) -> DataFrame:
    return (wh.table("fct_student_parent_association").groupBy("tenant_code", "school_year", "k_student")
            .agg(F.sum(F.col("is_primary_contact").cast("int")).alias("n_primary_contacts"))
            .filter(F.col("n_primary_contacts") > 1))


@check("d21_parent_association_multiple_years", "error")
def parent_association_multiple_years(wh) -> DataFrame:
    return (wh.table("fct_student_parent_association").groupBy("tenant_code", "k_student_xyear", "k_parent")
            .agg(F.countDistinct("school_year").alias("n_school_years")).filter(F.col("n_school_years") > 1))
