"""Section associations (students, staff), staff, and section QC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iff
from ..functions.dates import within_end_date
from ..functions.keys import packed, unpacked
from ..operators.dedupe import first_by, row_pluck
from ..operators.windows import flag_partition_max
from .checks import check
from .registry import dataset

# fixed value: e-mail shape, anchored at the start only
EMAIL_PATTERN = r"^[a-zA-Z0-9_.'\-]+[+]?[a-zA-Z0-9.-]*@[a-zA-Z0-9.\-]+[.][a-zA-Z0-9]{2,9}"


def _active(df: DataFrame, today, name: str = "is_active_enrollment") -> DataFrame:
    """W7 + P18: latest school year of the tenant (aggregate + broadcast), begun, not ended."""
    df = flag_partition_max(df, ["tenant_code"], "school_year", "__latest_year", few_partitions=True)
    cond = F.col("__latest_year") & (F.col("end_date").isNull() | (F.col("end_date") >= today)) \
        & (F.col("begin_date") <= today)
    return df.withColumn(name, iff(cond, True, False)).drop("__latest_year")


@dataset("fct_student_section_association", grain=("k_student", "k_course_section", "begin_date"))
def fct_student_section_association(wh) -> DataFrame:
    """Student x section of known students and sections (J1), active flag."""
    s = _packed(wh("stg_ef3__student_section_associations"), "k_student", "k_course_section")
    stu = _packed(wh("dim_student").select("k_student", "k_student_xyear"), "k_student", "k_student_xyear")
    sec = _packed(wh("dim_course_section").select("k_course_section", "k_school"), "k_course_section", "k_school")
    j = _active(s.join(stu, "k_student").join(sec, "k_course_section"), wh.config.today())
    keys = ["k_student", "k_student_xyear", "k_school", "k_course_section"]
    return j.select(*[unpacked(k).alias(k) for k in keys], "tenant_code", "school_year", "begin_date", "end_date",
                    "is_homeroom", "is_active_enrollment")


def _packed(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumns({k: packed(k) for k in keys})


@dataset("bld_staff_emails")
def staff_emails(wh) -> DataFrame:
    """The staff's own e-mails stacked with ed-org contact e-mails
    (only those of the staff row's year), with a validity flag (pattern
    anchored at the start)."""
    own = wh("stg_ef3__staffs__emails").select(
        "tenant_code", "k_staff", F.lit(None).cast("string").alias("k_lea"),
        F.lit(None).cast("string").alias("k_school"), "email_type", "email_address")
    c = wh("stg_ef3__staff_education_organization_contact_associations")
    st = wh("stg_ef3__staffs").select("k_staff", "api_year")
    org = c.join(st, ["k_staff", "api_year"]).select(
        "tenant_code", "k_staff", "k_lea", "k_school", F.col("contact_title").alias("email_type"), "email_address")
    e = own.unionByName(org)
    return e.withColumn("is_valid_email", F.col("email_address").rlike(EMAIL_PATTERN))


@dataset("bld_staff_official_emails", grain=("k_staff", "email_address"))
def staff_official_emails(wh) -> DataFrame:
    """Valid, official-type e-mails outside personal domains, one row per address."""
    cfg = wh.config
    e = wh("bld_staff_emails")
    domain = F.split_part(F.col("email_address"), F.lit("@"), F.lit(2))
    e = e.filter(F.col("is_valid_email") & F.col("email_type").isin(list(cfg.official_email_types))
                 & ~domain.isin(list(cfg.banned_email_domains)))
    return first_by(e, ["k_staff", "email_address"], [("email_type", "asc nulls last"), ("k_school", "asc nulls last")]).select(
        "tenant_code", "k_staff", "email_type", "email_address")


@dataset("dim_staff", grain=("k_staff",))
def dim_staff(wh) -> DataFrame:
    """Staff with ids, preferred e-mail (R2 on its type, valid or not), race and
    display names (J2)."""
    from .custom import add_custom_columns
    st = wh("stg_ef3__staffs")
    em = row_pluck(wh("bld_staff_emails"), "k_staff", "email_type", wh.config.preferred_staff_email,
                   tie_break=[F.col("email_address").asc_nulls_last()]).select("k_staff", "email_address", "email_type")
    ids = wh("bld_wide_ids_staff").drop("tenant_code", "api_year")
    race = wh("bld_staff_race_ethnicity").select("k_staff", "race_ethnicity")
    name = F.concat("last_name", F.lit(", "), "first_name")
    out = (st.join(ids, "k_staff", "left").join(em, "k_staff", "left").join(race, "k_staff", "left").select(
        "k_staff", "tenant_code", "staff_unique_id", *[c for c in ids.columns if c != "k_staff"], "email_address", "email_type",
        name.alias("display_name"), F.concat(name, F.lit(" ("), "staff_unique_id", F.lit(")")).alias("safe_display_name"),
        "first_name", "last_name", "middle_name", "race_ethnicity"))
    return add_custom_columns(wh, "dim_staff", out, ["k_staff"])


@dataset("fct_staff_section_association", grain=("k_staff", "k_course_section", "begin_date"))
def fct_staff_section_association(wh) -> DataFrame:
    """Staff x section of known staff and sections (J1), active flag."""
    s = wh("stg_ef3__staff_section_associations")
    j = s.join(wh("dim_staff").select("k_staff"), "k_staff").join(
        wh("dim_course_section").select("k_course_section", "k_school"), "k_course_section")
    j = _active(j, wh.config.today(), "is_active_assignment")
    return j.select("k_staff", "k_course_section", "k_school", "tenant_code", "school_year", "begin_date", "end_date",
                    "classroom_position", "is_active_assignment")


@dataset("qc_sections_per_enrollment", grain=("tenant_code", "k_school", "k_student", "school_year", "entry_date"),
         domain="qc")
def sections_per_enrollment(wh) -> DataFrame:
    """Sections overlapping each enrollment (a section begins or ends
    inside it), zero kept.  Equi-joined on student and school; the overlap
    test is the residual.  Like the reference, a section that spans the whole
    enrollment is not counted.  Of the sections only packed keys, dates and
    whether they have a key go through the join."""
    inc = wh.config.exit_withdraw_date_inclusive
    e = wh.table("fct_student_school_association").select(
        "tenant_code", "k_school", "k_student", "school_year", "entry_date", "exit_withdraw_date")
    s = wh.table("fct_student_section_association").select(
        packed("k_student").alias("__s_student"), packed("k_school").alias("__s_school"),
        F.when(F.col("k_course_section").isNotNull(), True).alias("__s_known"), "begin_date", "end_date")
    begins_inside = (s.begin_date >= e.entry_date) & within_end_date(s.begin_date, e.exit_withdraw_date, inc)
    ends_inside = (s.end_date >= e.entry_date) & within_end_date(s.end_date, e.exit_withdraw_date, inc)
    j = e.join(s, (packed(e.k_student) == s.__s_student) & (packed(e.k_school) == s.__s_school)
               & (begins_inside | ends_inside), "left")
    return j.groupBy("tenant_code", "k_school", "k_student", "school_year", "entry_date").agg(
        F.count("__s_known").alias("n_sections"))


@check("d18_enrollments_without_overlapping_sections")
def enrollments_without_sections(wh) -> DataFrame:
    return (wh.table("qc_sections_per_enrollment").filter(F.col("n_sections") == 0)
            .select("k_school", "k_student", "school_year", "entry_date", "n_sections"))


@check("d22_schools_with_enrollments_without_sections")
def schools_with_enrollments_without_sections(wh) -> DataFrame:
    g = wh.table("qc_sections_per_enrollment").groupBy("k_school", "school_year").agg(
        F.count(F.lit(1)).alias("n_enrollments"),
        F.count_if(F.col("n_sections") == 0).alias("n_enrollments_without_sections"))
    p = F.round(F.col("n_enrollments_without_sections").cast("decimal(18,4)")
                / F.col("n_enrollments").cast("decimal(18,4)"), 4)
    return g.withColumn("p_enrollments_without_sections", p).filter(F.col("p_enrollments_without_sections") > 0)


def _without(sections: DataFrame, associations: DataFrame) -> DataFrame:
    """The sections no association names, met on packed keys."""
    named = associations.select(packed("k_course_section").alias("__named"))
    return sections.join(named, packed(sections.k_course_section) == named.__named, "left_anti")


@check("d23_sections_without_staff")
def sections_without_staff(wh) -> DataFrame:
    return _without(wh.table("dim_course_section"), wh.table("fct_staff_section_association"))


@check("d24_sections_without_students")
def sections_without_students(wh) -> DataFrame:
    return _without(wh.table("dim_course_section"), wh.table("fct_student_section_association"))


@dataset("fct_staff_school_association", grain=("k_staff_school_association",))
def fct_staff_school_association(wh) -> DataFrame:
    """Staff at known schools (J1) with their assignment: the school-level
    assignment is preferred over the district-level one (J12 coalesce); a
    surrogate key (F1); active flag per tenant's latest year (W7 P18)."""
    from ..functions.keys import surrogate_key
    ss = wh("stg_ef3__staff_school_associations")
    sch = wh("dim_school").select("k_school", "k_lea")
    stf = wh("dim_staff").select("k_staff")
    cal = wh("dim_school_calendar").select(F.col("k_school_calendar").alias("__cal"))
    a = wh("stg_ef3__staff_education_organization_assignment_associations")
    cols = ["position_title", "begin_date", "end_date", "full_time_equivalency", "order_of_assignment",
            "staff_classification"]
    lea = a.filter(F.col("ed_org_type") == "LocalEducationAgency").select(
        F.col("k_staff").alias("__l_staff"), F.col("school_year").alias("__l_year"), F.col("k_lea").alias("__l_lea"),
        *[F.col(c).alias(f"__l_{c}") for c in cols])
    sca = a.filter(F.col("ed_org_type") == "School").select(
        F.col("k_staff").alias("__s_staff"), F.col("school_year").alias("__s_year"),
        F.col("k_school").alias("__s_school"), *[F.col(c).alias(f"__s_{c}") for c in cols])
    j = ss.join(sch, "k_school").join(stf, "k_staff")
    j = j.join(lea, (j.k_staff == lea.__l_staff) & (j.school_year == lea.__l_year) & (j.k_lea == lea.__l_lea), "left")
    j = j.join(sca, (j.k_staff == sca.__s_staff) & (j.school_year == sca.__s_year) & (j.k_school == sca.__s_school),
               "left")
    j = j.join(cal, j.k_school_calendar == cal.__cal, "left")
    j = j.select("k_staff", "k_lea", "k_school", F.col("__cal").alias("k_school_calendar"), "tenant_code",
                 "school_year", "program_assignment",
                 *[F.coalesce(f"__s_{c}", f"__l_{c}").alias(c) for c in cols])
    j = j.withColumn("k_staff_school_association", surrogate_key(
        "tenant_code", "school_year", "begin_date", "k_staff", "k_school", "program_assignment", "staff_classification"))
    j = flag_partition_max(j, ["tenant_code"], "school_year", "__latest", few_partitions=True)
    today = wh.config.today()
    active = F.col("__latest") & (F.col("end_date").isNull() | (F.col("end_date") >= today)) & (
        F.col("begin_date") <= today)
    return j.withColumn("is_active_assignment", iff(active, True, False)).drop("__latest")


@dataset("bld_wide_ids_staff", grain=("tenant_code", "api_year", "k_staff"))
def wide_ids_staff(wh) -> DataFrame:
    """Staff identification codes pivoted to ``{id_name}_staff_id``."""
    from ..operators.joins import seed
    from ..operators.reshape import crosswalk_values, pivot_values
    xw = seed(wh("xwalk_id_types_staff"))
    ids = wh("stg_ef3__staffs__identification_codes").join(xw, "id_system")
    return pivot_values(ids, ["tenant_code", "api_year", "k_staff"], "id_name", crosswalk_values(xw, "id_name"),
                        "id_code", agg="min", suffix="_staff_id")


@dataset("bld_staff_race_ethnicity", grain=("k_staff",))
def staff_race_ethnicity(wh) -> DataFrame:
    """Race array and label; unlike students, staff without race
    rows drop (inner join)."""
    from ..functions.columns import race_label
    from ..operators.sets import sorted_array
    cfg = wh.config
    r = wh("stg_ef3__staffs__races").groupBy("k_staff").agg(
        sorted_array("race").alias("race_array"), F.max("has_hispanic_latino_ethnicity").alias("__h"))
    j = wh("stg_ef3__staffs").select("k_staff").join(r, "k_staff")
    return j.select("k_staff", "race_array",
                    race_label("__h", "race_array", cfg.hispanic_code, cfg.race_multiple_code, cfg.race_unknown_code)
                    .alias("race_ethnicity"))
