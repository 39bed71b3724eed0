"""Education staging relations derived from the driver's tables.

The warehouse consumes already-flattened ``stg_*`` relations.  For this repo
they are derived from the TPC-H-shaped parquet tables with plain column
expressions, so every staging relation (and all the work downstream) grows
with the input tables:

==============================  ==============================================
staging relation                derived from
==============================  ==============================================
tenant / LEA                    region, nation (tenant = region name)
school                          supplier (tenant from the supplier's nation)
calendars, dates, events,       one or two calendars per school, every day of
sessions                        January 2024, three sessions per school
student (per year)              customer; home school = the supplier at index c_custkey % count
enrollment                      customer (entry/exit/withdraw rules on the key)
attendance event                events (student = user_id, day = date(ts))
grades                          lineitem (student = order's customer)
program associations            orders (program = priority, 90-day window)
finance snapshots               orders (account = customer)
subgroup source                 customer segment, nation, balance sign
discipline                      events of type 'error'
identification codes            part (type -> brand)
==============================  ==============================================

Every relation is a lazy DataFrame: column pruning and filters reach the
parquet scans.  The "home school" lookup has one row per supplier and is a
written table of known size, which Spark broadcasts below its threshold.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key as key
from ..operators.numbering import dense_index
from . import seeds
from .program_stages import ProgramStaging
from .sinks import materialize, table_root

# fixed values: shape of the derived school year
SCHOOL_YEAR = 2024
PRIOR_YEAR = 2023
CAL_START = dt.date(2024, 1, 1)
CAL_END = dt.date(2024, 1, 31)
# fixed values: sessions (name, begin, end, total instructional days)
SESSIONS = [
    ("Year Round", dt.date(2024, 1, 1), dt.date(2024, 1, 31), 21),
    ("Half 1", dt.date(2024, 1, 1), dt.date(2024, 1, 15), 9),
    ("Half 2", dt.date(2024, 1, 16), dt.date(2024, 1, 31), 12),
]
# fixed values: grade level of a student by c_custkey % 7
GRADE_BY_KEY = ["Kindergarten", "First grade", "Second grade", "Third grade",
                "Fourth grade", "Fifth grade", "Sixth grade"]
# fixed values: grading periods (name, begin, end)
GRADING_PERIODS = [
    ("Third Quarter", dt.date(2024, 1, 1), dt.date(2024, 1, 15)),
    ("Fourth Quarter", dt.date(2024, 1, 16), dt.date(2024, 1, 31)),
]
# fixed values: assessment namespace, score names, performance levels
ASSESSMENT_NAMESPACE = "uri://rollcall.example/assessment"
SCORE_NAMES = ["Scale Score", "Raw Score", "Percentile"]
PERFORMANCE_LEVELS = [("Proficient", "3"), ("Approaching", "2"), ("Below", "1")]
# fixed value: sections of parts of this size or more have no teacher yet
VACANT_FROM_SIZE = 45
# fixed values: class periods (name, start, end) with 12-hour clock entries as sent by sources
CLASS_PERIODS = [
    ("Period 1", "08:00:00", "08:50:00"),
    ("Period 2", "11:30:00", "12:20:00"),
    ("Period 3", "01:00:00", "01:50:00"),
    ("Period 4", "12:30:00", "01:15:00"),
]
# fixed values: descriptor URI prefix of course level characteristics
CHAR_URI = "uri://rollcall.example/CourseLevelCharacteristicDescriptor#"
# fixed values: certification exams
CERT_EXAMS = ["Praxis Core", "Praxis Subject"]
# fixed values: chart-of-account dimensions (name, part column, modulus)
ACCOUNT_DIMENSIONS = [
    ("fund", "p_size", 5), ("function", "p_size", 7), ("object", "p_size", 11), ("program", "p_size", 13),
    ("project", "p_size", 3), ("source", "p_size", 4), ("operational_unit", "p_size", 6),
    ("balance_sheet", "p_size", 9),
]
# fixed values: objective codes of every assessment
OBJECTIVE_CODES = ["OBJ-A", "OBJ-B"]
# fixed value: subject of all assessments and objectives
ASSESSMENT_SUBJECT = "Mathematics"
# fixed values: every TRANSFER_EVERY-th student (at TRANSFER_FIRST) is enrolled in the next school too
TRANSFER_EVERY, TRANSFER_FIRST = 23, 5
# fixed values: races by c_custkey % 5 (index 4 = no race rows)
RACES_BY_KEY = [["White"], ["Black - African American"], ["White", "Asian"], ["Asian"], []]


class DriverTables:
    """Lazy parquet readers for the driver-provided tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _mod(col, n: int) -> Column:
    return F.pmod(F.col(col) if isinstance(col, str) else col, F.lit(n))


def assessment_key(*more: Column, subjects: int = 1) -> Column:
    """Key of an assessment, or with more columns of what belongs to it."""
    return key("tenant_code", F.lit(SCHOOL_YEAR), *[F.lower(F.lit(ASSESSMENT_SUBJECT))] * subjects,
               F.lower("o_orderpriority"), F.lower(F.lit(ASSESSMENT_NAMESPACE)), *more)


def student_assessment_key() -> Column:
    return assessment_key(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))


class Staging(ProgramStaging):
    """Name -> staging DataFrame (``stg_*``, ``xwalk_*`` and seeds)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = DriverTables(spark, sf_dir)
        self._memo: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._memo:
            if name in seeds.NAMES:
                self._memo[name] = seeds.seed(self.spark, name)
            else:
                fn = getattr(self, "_" + name, lambda: self.program_relation(name))
                df = fn()
                if df is None:
                    raise KeyError(f"unknown staging relation {name!r}")
                self._memo[name] = df
        return self._memo[name]

    def has(self, name: str) -> bool:
        return name in seeds.NAMES or hasattr(self, "_" + name) or self.program_relation(name) is not None

    # ---- organizations -------------------------------------------------
    def _nation_tenant(self) -> DataFrame:
        n = self.t("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.t("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("tenant_code"))
        return n.join(r, "n_regionkey")

    def _stg_ef3__local_education_agencies(self) -> DataFrame:
        nt = self("nation_tenant")
        return nt.select(
            "tenant_code",
            F.lit(SCHOOL_YEAR).alias("api_year"),
            key("tenant_code", "n_nationkey").alias("k_lea"),
            F.col("n_nationkey").cast("string").alias("lea_id"),
            F.col("n_name").alias("lea_name"),
            F.lit("Independent").alias("lea_category"),
            key("tenant_code", F.lit("esc")).alias("k_esc"),
        )

    def _stg_ef3__schools(self) -> DataFrame:
        s = self.t("supplier").select("s_suppkey", "s_name", "s_nationkey")
        nt = self("nation_tenant").select(F.col("n_nationkey").alias("s_nationkey"), "tenant_code")
        s = s.join(nt, "s_nationkey")
        return self._spread(s.select(
            "tenant_code",
            F.lit(SCHOOL_YEAR).alias("api_year"),
            key("tenant_code", "s_suppkey").alias("k_school"),
            key("tenant_code", "s_nationkey").alias("k_lea"),
            F.col("s_suppkey").alias("school_id"),
            F.col("s_name").alias("school_name"),
            F.when(_mod("s_suppkey", 3) == 0, "Elementary School")
             .when(_mod("s_suppkey", 3) == 1, "Middle School")
             .otherwise("High School").alias("school_category"),
        ), "school_id", "schools")

    def _written(self, df: DataFrame, what: str) -> DataFrame:
        return materialize(df, f"{table_root(self.spark)}/staging-{what}")

    def _spread(self, df: DataFrame, by: str, what: str) -> DataFrame:
        """Rows written in as many files as shuffles have partitions.  A scan of
        a driver table has no more tasks than the table has row groups, one or
        two for millions of short rows, and all that grows from these rows (keys,
        years, days, sorts) would run in them."""
        return self._written(df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), by), what)

    @cached_property
    def n_home_schools(self) -> int:
        """Number of schools; keys modulo this number are the index of a school."""
        return max(1, self("home_school").count())

    @cached_property
    def n_staff(self) -> int:
        """Number of staff (customers); keys modulo this number are the index of one."""
        return max(1, self("customer_index").count())

    @cached_property
    def n_sections(self) -> int:
        """Number of sections (parts); keys modulo this number are the index of one."""
        return max(1, self("part_index").count())

    def _home_school(self) -> DataFrame:
        """Every school with its tenant and its dense index: students, parts and
        events are assigned to all of them, whatever their keys are.  A written
        table, so that its size is known wherever it is joined."""
        nt = self("nation_tenant").select(F.col("n_nationkey").alias("s_nationkey"), "tenant_code")
        schools = self.t("supplier").select("s_suppkey", "s_nationkey").join(nt, "s_nationkey").select(
            F.col("s_suppkey").alias("home_school_id"), "tenant_code", F.col("s_nationkey").alias("home_nationkey"))
        return self._written(dense_index(schools, "home_school_id", "school_index", self._written), "home-school")

    def _customer_index(self) -> DataFrame:
        return self._written(dense_index(self.t("customer").select("c_custkey"), "c_custkey", "staff_index", self._written), "customers")

    def _part_index(self) -> DataFrame:
        return self._written(dense_index(self.t("part").select("p_partkey"), "p_partkey", "section_index", self._written), "parts")

    def _at_school(self, rows: DataFrame, key_column: str, *columns: str, school: str = "home_school_id",
                   tenant: str = "tenant_code") -> DataFrame:
        """Rows with the school (and its tenant) that their key names."""
        index = f"__index_{school}"
        schools = self("home_school").select(F.col("school_index").alias(index), F.col("home_school_id").alias(school),
                                             F.col("tenant_code").alias(tenant), *columns)
        return rows.join(schools, _mod(key_column, self.n_home_schools) == F.col(index)).drop(index)

    # ---- calendars and sessions ------------------------------------------
    def _stg_ef3__calendars(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "school_id", "k_school")
        codes = F.when(_mod("school_id", 4) == 0, F.array(F.lit("alt"), F.lit("main"))).otherwise(F.array(F.lit("main")))
        cal = sch.select("*", F.explode(codes).alias("calendar_code"))
        return cal.select(
            "tenant_code", "k_school", "school_id", "calendar_code",
            F.lit(SCHOOL_YEAR).alias("school_year"),
            key("tenant_code", "school_id", F.lit(SCHOOL_YEAR), "calendar_code").alias("k_school_calendar"),
            F.when(F.col("calendar_code") == "alt", "Student Specific").otherwise("IEP").alias("calendar_type"),
        )

    def _stg_ef3__calendars__grade_levels(self) -> DataFrame:
        cal = self("stg_ef3__calendars")
        grades = F.when(F.col("calendar_code") == "alt", F.array(F.lit("Kindergarten"))).otherwise(
            F.array(*[F.lit(g) for g in GRADE_BY_KEY[:6]]))
        return cal.select("tenant_code", "k_school_calendar", F.explode(grades).alias("grade_level"))

    def _stg_ef3__calendar_dates(self) -> DataFrame:
        cal = self("stg_ef3__calendars").select("tenant_code", "k_school_calendar", "school_year")
        # a join, not an explode: Spark takes exploded rows to be no more than their input and would broadcast all days
        d = cal.crossJoin(F.broadcast(self._calendar_days()))
        return d.withColumn("k_calendar_date", key("k_school_calendar", "calendar_date"))

    def _calendar_days(self) -> DataFrame:
        """The days of the fixed calendar, a row each."""
        n = (CAL_END - CAL_START).days + 1
        return self.spark.range(0, n, 1, 1).select(F.date_add(F.lit(CAL_START), F.col("id").cast("int")).alias("calendar_date"))

    def _stg_ef3__calendar_dates__calendar_events(self) -> DataFrame:
        d = self("stg_ef3__calendar_dates")
        cd = F.col("calendar_date")
        main = (F.when(cd == F.lit(dt.date(2024, 1, 1)), "Holiday")
                .when(cd == F.lit(dt.date(2024, 1, 2)), "Teacher Only Day")
                .when(F.dayofweek(cd).isin(1, 7), "Weekend")
                .otherwise("Instructional Day"))
        extra = (F.when(cd == F.lit(dt.date(2024, 1, 15)), "Holiday")
                 .when(cd == F.lit(dt.date(2024, 1, 31)), "Unmapped Event"))
        events = F.filter(F.array(main, extra), lambda e: e.isNotNull())
        return d.select("tenant_code", "k_calendar_date", F.lit(SCHOOL_YEAR).alias("api_year"),
                        F.explode(events).alias("calendar_event"))

    def _stg_ef3__sessions(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "school_id", "k_school")
        sess = F.explode(F.array(*[F.struct(F.lit(n).alias("session_name"), F.lit(b).alias("session_begin_date"),
                                            F.lit(e).alias("session_end_date"),
                                            F.lit(t).alias("total_instructional_days"))
                                   for n, b, e, t in SESSIONS]))
        s = sch.select("*", sess.alias("s")).select("tenant_code", "school_id", "k_school", "s.*")
        return s.select(
            "tenant_code", "k_school",
            key("tenant_code", "school_id", F.lit(SCHOOL_YEAR), "session_name").alias("k_session"),
            F.lit(SCHOOL_YEAR).alias("school_year"),
            "session_name", F.col("session_name").alias("academic_term"),
            "session_begin_date", "session_end_date", "total_instructional_days",
        )

    # ---- students and enrollment ----------------------------------------
    def _customer_home(self) -> DataFrame:
        c = self.t("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        return self._spread(self._at_school(c, "c_custkey", "school_index", "home_nationkey"), "c_custkey", "customer-home")

    def _student_transfers(self) -> DataFrame:
        """Students enrolled in the next school too, where that is another
        tenant's.  By ``kind`` the second record is the same (0), has another
        birth date (1), or other names as well, as if the id named someone else (2)."""
        c = self("customer_home").filter(_mod("c_custkey", TRANSFER_EVERY) == TRANSFER_FIRST)
        nxt = self("home_school").select(F.col("school_index").alias("next_index"), F.col("home_school_id").alias("next_school"),
                                         F.col("tenant_code").alias("next_tenant"))
        j = c.withColumn("next_index", _mod(F.col("school_index") + 1, self.n_home_schools)).join(nxt, "next_index")
        return j.filter("next_tenant != tenant_code").select(
            "c_custkey", F.col("next_tenant").alias("tenant_code"), F.col("next_school").alias("home_school_id"),
            "c_name", "c_mktsegment", _mod("c_custkey", 3).alias("kind"))

    def _stg_ef3__students(self) -> DataFrame:
        c = self("customer_home")
        years = F.when(_mod("c_custkey", 2) == 0, F.array(F.lit(SCHOOL_YEAR), F.lit(PRIOR_YEAR))).otherwise(
            F.array(F.lit(SCHOOL_YEAR)))
        s = c.select("tenant_code", "c_custkey", "c_name", "c_mktsegment", F.lit(0).cast("long").alias("kind"),
                     F.explode(years).alias("school_year"))
        s = s.unionByName(self("student_transfers").drop("home_school_id").withColumn("school_year", F.lit(SCHOOL_YEAR)))
        return s.select(
            "tenant_code",
            F.col("school_year").alias("api_year"), "school_year",
            key("tenant_code", "c_custkey", "school_year").alias("k_student"),
            key("tenant_code", "c_custkey").alias("k_student_xyear"),
            F.col("c_custkey").cast("string").alias("student_unique_id"),
            F.when(F.col("kind") == 2, F.concat(F.lit("Other "), F.col("c_name"))).otherwise(F.col("c_name")).alias("first_name"),
            F.when(F.col("school_year") == PRIOR_YEAR, F.concat(F.lit("Former "), F.initcap("c_mktsegment")))
             .when(F.col("kind") == 2, F.concat(F.lit("Other "), F.initcap("c_mktsegment")))
             .otherwise(F.initcap("c_mktsegment")).alias("last_name"),
            F.when(_mod("c_custkey", 3) == 0, F.lit("Quinn")).alias("middle_name"),
            F.date_add(F.lit(dt.date(2012, 1, 1)), (_mod("c_custkey", 2000) + F.least("kind", F.lit(1))).cast("int"))
             .alias("birth_date"),
            F.lit("US").alias("birth_country"),
        )

    def _stg_ef3__student_education_organization_associations(self) -> DataFrame:
        c = self("customer_home")
        years = F.when(_mod("c_custkey", 2) == 0, F.array(F.lit(SCHOOL_YEAR), F.lit(PRIOR_YEAR))).otherwise(
            F.array(F.lit(SCHOOL_YEAR)))
        c = c.select("tenant_code", "c_custkey", "home_school_id", F.explode(years).alias("school_year"))
        c = c.unionByName(self("student_transfers").select("tenant_code", "c_custkey", "home_school_id",
                                                           F.lit(SCHOOL_YEAR).alias("school_year")))
        return c.select(
            "tenant_code", F.col("school_year").alias("api_year"),
            key("tenant_code", "c_custkey", "school_year").alias("k_student"),
            key("tenant_code", "c_custkey").alias("k_student_xyear"),
            F.col("home_school_id").cast("string").alias("ed_org_id"),
            F.lit("School").alias("ed_org_type"),
            F.when(_mod("c_custkey", 2) == 0, "Female").otherwise("Male").alias("gender"),
            F.when(_mod("c_custkey", 14) == 0, "Nonbinary").alias("gender_identity"),
            (_mod("c_custkey", 9) == 0).alias("has_hispanic_latino_ethnicity"),
            F.when(_mod("c_custkey", 6) == 0, "Limited").alias("lep_code"),
        )

    def _stg_ef3__stu_ed_org__races(self) -> DataFrame:
        c = self("customer_home")
        arr = F.col("__races")
        races = F.when(_mod("c_custkey", 5) == 0, F.array(*[F.lit(x) for x in RACES_BY_KEY[0]]))
        for i in range(1, 4):
            races = races.when(_mod("c_custkey", 5) == i, F.array(*[F.lit(x) for x in RACES_BY_KEY[i]]))
        races = races.otherwise(F.array().cast("array<string>"))
        c = c.withColumn("__races", races)
        return c.select(
            key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
            F.col("home_school_id").cast("string").alias("ed_org_id"),
            F.explode(arr).alias("race"),
        )

    def _stg_ef3__stu_ed_org__characteristics(self) -> DataFrame:
        c = self("customer_home")
        chars = F.filter(F.array(
            F.when(_mod("c_custkey", 4) == 0, F.lit("Economic Disadvantaged")),
            F.when(_mod("c_custkey", 6) == 1, F.lit("Gifted")),
            F.when(_mod("c_custkey", 10) == 3, F.lit("Homeless")),
            F.when(_mod("c_custkey", 15) == 2, F.lit("Unmapped Characteristic")),
        ), lambda x: x.isNotNull())
        return c.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
            key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
            key("tenant_code", "c_custkey").alias("k_student_xyear"),
            F.col("home_school_id").cast("string").alias("ed_org_id"),
            F.explode(chars).alias("student_characteristic"),
        )

    def _stg_ef3__student_school_associations(self) -> DataFrame:
        c = self("customer_home")
        entry = F.date_add(F.lit(CAL_START), _mod("c_custkey", 7).cast("int"))
        exit_ = F.when(_mod("c_custkey", 5) == 0,
                       F.date_add(entry, (_mod("c_custkey", 17) - 2).cast("int")))
        main_cal = key("tenant_code", "home_school_id", F.lit(SCHOOL_YEAR), F.lit("main"))
        grade = F.element_at(F.array(*[F.lit(g) for g in GRADE_BY_KEY]), (_mod("c_custkey", 7) + 1).cast("int"))
        base = c.select(
            "tenant_code", "c_custkey", "home_school_id",
            F.lit(1).alias("enrollment_seq"),
            F.when(_mod("c_custkey", 3) == 0, F.lit(None).cast("string")).otherwise(main_cal).alias("k_school_calendar"),
            entry.alias("entry_date"),
            exit_.alias("exit_withdraw_date"),
            F.when(_mod("c_custkey", 13) == 0, "No show")
             .when(_mod("c_custkey", 5) == 0, "Transferred").alias("exit_withdraw_type"),
            grade.alias("entry_grade_level"),
        )
        second = c.filter(_mod("c_custkey", 11) == 0).select(
            "tenant_code", "c_custkey", "home_school_id",
            F.lit(2).alias("enrollment_seq"),
            main_cal.alias("k_school_calendar"),
            F.date_add(F.lit(dt.date(2024, 1, 3)), _mod("c_custkey", 5).cast("int")).alias("entry_date"),
            F.lit(None).cast("date").alias("exit_withdraw_date"),
            F.lit(None).cast("string").alias("exit_withdraw_type"),
            grade.alias("entry_grade_level"),
        )
        transfer = self("student_transfers").select(
            "tenant_code", "c_custkey", "home_school_id",
            F.lit(1).alias("enrollment_seq"),
            main_cal.alias("k_school_calendar"),
            F.date_add(F.lit(dt.date(2024, 1, 3)), _mod("c_custkey", 5).cast("int")).alias("entry_date"),
            F.lit(None).cast("date").alias("exit_withdraw_date"),
            F.lit(None).cast("string").alias("exit_withdraw_type"),
            grade.alias("entry_grade_level"),
        )
        e = base.unionByName(second).unionByName(transfer)
        return e.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
            key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
            key("tenant_code", "home_school_id").alias("k_school"),
            "k_school_calendar", "entry_date", "exit_withdraw_date", "exit_withdraw_type",
            "entry_grade_level", "enrollment_seq",
            (F.col("enrollment_seq") == 1).alias("is_primary_school"),
            F.lit("Regular").alias("enrollment_type"),
        )

    def _stg_ef3__student_school_attendance_events(self) -> DataFrame:
        ev = self.t("events").select("event_id", "ts", "user_id", "event_type", "value", "props")
        ev = self._at_school(ev, "user_id")
        day = F.to_date("ts")
        session = (F.when(_mod("event_id", 4) == 0, "Year Round")
                   .when(F.dayofmonth(day) <= 15, "Half 1").otherwise("Half 2"))
        return ev.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"), F.lit(SCHOOL_YEAR).alias("school_year"),
            key("tenant_code", "user_id", F.lit(SCHOOL_YEAR)).alias("k_student"),
            key("tenant_code", "home_school_id").alias("k_school"),
            key("tenant_code", "home_school_id", F.lit(SCHOOL_YEAR), session).alias("k_session"),
            day.alias("attendance_event_date"),
            F.col("event_type").alias("attendance_event_category"),
            F.col("props").alias("attendance_event_reason"),
            F.col("value").alias("event_duration"),
            F.lit(None).cast("double").alias("school_attendance_duration"),
            F.date_format("ts", "HH:mm:ss").alias("arrival_time"),
            F.lit(None).cast("string").alias("departure_time"),
            F.lit("Classroom").alias("educational_environment"),
        )

    # ---- programs (orders) ------------------------------------------------
    def _orders_home(self) -> DataFrame:
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                    "o_orderpriority")
        o = self._at_school(o, "o_custkey", "home_nationkey")
        return (o.withColumn("begin_date", F.to_date("o_orderdate"))
                .withColumn("school_year", F.when(F.year("o_orderdate") >= 1998, F.lit(SCHOOL_YEAR))
                            .otherwise(F.lit(PRIOR_YEAR))))

    def _stg_ef3__programs(self) -> DataFrame:
        o = self("orders_home").select("tenant_code", "home_school_id", "home_nationkey", "o_orderpriority").distinct()
        return o.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
            key("tenant_code", "home_school_id", "o_orderpriority").alias("k_program"),
            key("tenant_code", "home_nationkey").alias("k_lea"),
            key("tenant_code", "home_school_id").alias("k_school"),
            F.lit("School").alias("ed_org_type"),
            F.col("o_orderpriority").alias("program_name"),
            F.col("o_orderpriority").alias("program_id"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Intervention").otherwise("Enrichment")
             .alias("program_type"),
            F.col("home_school_id").cast("string").alias("ed_org_id"),
        )

    def _stg_ef3__student_program_associations(self) -> DataFrame:
        o = self("orders_home")
        end = F.when(F.col("o_orderstatus") == "F", F.date_add("begin_date", 90))
        return o.select(
            "tenant_code", "school_year",
            key("tenant_code", "o_custkey", "school_year").alias("k_student"),
            key("tenant_code", "o_custkey").alias("k_student_xyear"),
            key("tenant_code", "home_school_id", "o_orderpriority").alias("k_program"),
            key("tenant_code", "o_custkey", "o_orderkey").alias("k_student_program"),
            key("tenant_code", "home_school_id").alias("k_school"),
            F.col("home_school_id").cast("string").alias("ed_org_id"),
            F.col("o_orderpriority").alias("program_name"),
            F.col("begin_date").alias("program_enroll_begin_date"),
            end.alias("program_enroll_end_date"),
            F.col("o_orderstatus").alias("participation_status"),
            (_mod("o_orderkey", 3) == 0).alias("is_served_outside_regular_session"),
        )

    # ---- finance (orders) ---------------------------------------------------
    def _stg_ef3__local_accounts(self) -> DataFrame:
        o = self("orders_home").select("tenant_code", "o_custkey", "home_school_id").distinct()
        return o.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("fiscal_year"),
            key("tenant_code", "o_custkey").alias("k_local_account"),
            key("tenant_code", "home_school_id").alias("k_school"),
            F.col("o_custkey").cast("string").alias("local_account_identifier"),
            F.concat(F.lit("Account "), F.col("o_custkey").cast("string")).alias("local_account_name"),
            F.col("home_school_id").cast("string").alias("ed_org_id"),
            F.lit("School").alias("ed_org_type"),
        )

    def _stg_ef3__local_actuals(self) -> DataFrame:
        o = self("orders_home")
        return o.select(
            "tenant_code",
            key("tenant_code", "o_orderkey").alias("k_local_actual_snapshot"),
            key("tenant_code", "o_custkey").alias("k_local_account"),
            F.col("o_totalprice").alias("amount"),
            F.col("begin_date").alias("as_of_date"),
            F.col("home_school_id").cast("string").alias("ed_org_id"),
            F.col("o_orderpriority").alias("financial_collection"),
            F.year("begin_date").alias("fiscal_year"),
            F.col("o_custkey").cast("string").alias("local_account_identifier"),
        )

    # ---- school addresses and identification codes (supplier) --------------
    def _stg_ef3__schools__addresses(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "k_school", "school_id", "school_name")
        types = F.filter(F.array(F.when(_mod("school_id", 3) != 0, F.lit("Physical")), F.lit("Mailing"),
                                 F.when(_mod("school_id", 2) == 0, F.lit("Home"))), lambda x: x.isNotNull())
        a = sch.select("*", F.explode(types).alias("address_type"))
        return a.select("tenant_code", "k_school", "address_type",
                        F.concat(F.col("address_type"), F.lit(" Rd "), F.col("school_id").cast("string"))
                        .alias("street_address"),
                        F.concat(F.lit("City "), _mod("school_id", 50).cast("string")).alias("city"),
                        F.lpad(_mod("school_id", 100000).cast("string"), 5, "0").alias("postal_code"),
                        F.when((F.col("address_type") == "Physical") & (_mod("school_id", 4) == 1), F.lit(dt.date(2023, 6, 30)))
                        .alias("address_end_date"))

    def _stg_ef3__local_education_agencies__addresses(self) -> DataFrame:
        n = self("nation_tenant")
        types = F.when(_mod("n_nationkey", 2) == 0, F.array(F.lit("Physical"), F.lit("Mailing"))).otherwise(
            F.array(F.lit("Mailing"), F.lit("Billing")))
        a = n.select("*", F.explode(types).alias("address_type"))
        return a.select("tenant_code", key("tenant_code", "n_nationkey").alias("k_lea"), "address_type",
                        F.concat(F.col("address_type"), F.lit(" Ave "), F.col("n_nationkey").cast("string")).alias("street_address"),
                        F.initcap("n_name").alias("city"),
                        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal_code"),
                        F.when((F.col("address_type") != "Mailing") & (_mod("n_nationkey", 3) == 0), F.lit(dt.date(2023, 6, 30)))
                        .alias("address_end_date"))

    def _stg_ef3__schools__identification_codes(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "k_school", "school_id")
        systems = F.filter(F.array(F.lit("NCES"), F.lit("State"), F.when(_mod("school_id", 2) == 0, F.lit("Local")),
                                   F.when(_mod("school_id", 7) == 0, F.lit("Federal"))), lambda x: x.isNotNull())
        c = sch.select("*", F.explode(systems).alias("id_system"))
        return c.select("tenant_code", "k_school", "id_system",
                        F.concat(F.left("id_system", F.lit(1)), F.col("school_id").cast("string")).alias("id_code"))

    # ---- courses, sections, grading periods, grades (part, lineitem) --------
    def _part_home(self) -> DataFrame:
        p = self.t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
        return self._at_school(p, "p_partkey", "home_nationkey")

    def _stg_ef3__courses(self) -> DataFrame:
        p = self("part_home")
        js = F.when(F.col("p_size") > 40, self._course_chars_json(F.lit("Honors"))).otherwise(F.lit("[]"))
        return p.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "p_partkey").alias("k_course"),
                        key("tenant_code", "home_nationkey").alias("k_lea"),
                        key("tenant_code", "home_school_id").alias("k_school"),
                        F.col("home_school_id").cast("string").alias("ed_org_id"), F.lit("School").alias("ed_org_type"),
                        F.col("p_partkey").cast("string").alias("course_code"),
                        F.col("p_name").alias("course_title"),
                        F.initcap("p_type").alias("academic_subject"), js.alias("v_level_characteristics"))

    def _stg_ef3__course_offerings(self) -> DataFrame:
        p = self("part_home")
        js = (F.when(_mod("p_partkey", 10) == 0, self._course_chars_json(F.lit("AP")))
              .when(_mod("p_partkey", 6) == 0, self._course_chars_json(F.lit("Honors"))))
        return p.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "p_partkey", F.lit("offering")).alias("k_course_offering"),
                        key("tenant_code", "p_partkey").alias("k_course"),
                        key("tenant_code", "home_school_id").alias("k_school"),
                        key("tenant_code", "home_school_id", F.lit(SCHOOL_YEAR), F.lit("Year Round")).alias("k_session"),
                        F.lit("Year Round").alias("session_name"),
                        F.concat(F.lit("L"), F.col("p_partkey").cast("string")).alias("local_course_code"),
                        F.concat(F.col("p_name"), F.lit(" (local)")).alias("local_course_title"),
                        (F.col("p_size") * 10).alias("instructional_time_planned"), js.alias("v_course_level_characteristics"))

    def _stg_ef3__sections(self) -> DataFrame:
        p = self("part_home")
        js = (F.when(_mod("p_partkey", 13) == 0, F.lit(None).cast("string"))
              .when(_mod("p_partkey", 9) == 0, self._course_chars_json(F.lit("Dual Credit")))
              .when(_mod("p_partkey", 4) == 0, self._course_chars_json(F.lit("Honors")))
              .otherwise(F.lit("[]")))
        return p.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "p_partkey", F.lit("S1")).alias("k_course_section"),
                        key("tenant_code", "p_partkey", F.lit("offering")).alias("k_course_offering"),
                        F.when(_mod("p_partkey", 3) != 0, key("tenant_code", "home_school_id", F.lit("R101"))).alias("k_location"),
                        F.concat(F.col("p_partkey").cast("string"), F.lit("-S1")).alias("section_id"),
                        F.col("p_brand").alias("section_name"),
                        (_mod("p_partkey", 8) == 0).alias("is_official_attendance_period"),
                        (_mod("p_partkey", 2) + 1).alias("sequence_of_course"),
                        F.lit("Classroom").alias("educational_environment_type"),
                        F.col("p_size").alias("available_credits"), js.alias("v_course_level_characteristics"))

    def _stg_ef3__grading_periods(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "school_id", "k_school")
        gp = F.explode(F.array(*[F.struct(F.lit(n).alias("grading_period"), F.lit(b).alias("begin_date"),
                                          F.lit(e).alias("end_date"), F.lit(i + 3).alias("period_sequence"))
                                 for i, (n, b, e) in enumerate(GRADING_PERIODS)]))
        g = sch.select("*", gp.alias("g")).select("tenant_code", "school_id", "k_school", "g.*")
        return g.select("tenant_code", "k_school", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "school_id", F.lit(SCHOOL_YEAR), "grading_period").alias("k_grading_period"),
                        "grading_period", "begin_date", "end_date", "period_sequence")

    def _stg_ef3__grades(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
                                       "l_linestatus")
        o = self.t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        g = self._at_school(li.join(o, "l_orderkey"), "o_custkey", school="stu_school")
        g = self._at_school(g, "l_partkey", school="part_school", tenant="part_tenant")
        period = F.when(_mod("l_linenumber", 2) == 0, F.lit(GRADING_PERIODS[0][0])).otherwise(F.lit(GRADING_PERIODS[1][0]))
        ext = F.concat(F.lit('{"grading": {"scale": "'), F.when(_mod("l_linenumber", 2) == 0, "A-F").otherwise("1-4"),
                       F.lit('"}, "attempts": ['), F.col("l_linenumber").cast("string"), F.lit("]}"))
        return g.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), F.lit(SCHOOL_YEAR).alias("api_year"),
            F.when(_mod("l_linenumber", 7) != 0, ext).alias("v_ext"),
            key("tenant_code", "o_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
            key("tenant_code", "stu_school").alias("k_school"),
            key("part_tenant", "l_partkey", F.lit("S1")).alias("k_course_section"),
            key("tenant_code", "stu_school", F.lit(SCHOOL_YEAR), period).alias("k_grading_period"),
            F.when(F.col("l_linestatus") == "F", "Final").otherwise("Grading Period").alias("grade_type"),
            F.col("l_returnflag").alias("letter_grade_earned"),
            F.col("l_quantity").alias("numeric_grade_earned"),
        )

    # ---- discipline (events of type 'error') --------------------------------
    def _error_events(self) -> DataFrame:
        ev = (self.t("events").select("event_id", "ts", "user_id", "event_type", "value")
              .filter(F.col("event_type") == "error"))
        ev = self._at_school(ev, "user_id")
        band = F.when(F.col("value") >= 200, "Major").when(F.col("value") >= 50, "Moderate").otherwise("Minor")
        return ev.withColumn("behavior_type", band).withColumn("incident_date", F.to_date("ts"))

    def _stg_ef3__discipline_incidents(self) -> DataFrame:
        e = self("error_events")
        return e.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "home_school_id", "event_id").alias("k_discipline_incident"),
                        key("tenant_code", "home_school_id").alias("k_school"),
                        F.col("event_id").cast("string").alias("incident_id"),
                        F.col("home_school_id").cast("string").alias("school_id"),
                        "incident_date", F.col("value").alias("incident_cost"),
                        (_mod("event_id", 4) == 0).alias("was_reported_to_law_enforcement"),
                        F.to_json(F.transform(self._behaviors(), lambda b: F.struct(b.alias("behaviorDescriptor")))).alias("v_behaviors"))

    @staticmethod
    def _behaviors() -> Column:
        """Behaviors of an incident; one in 21 has the same behavior twice."""
        return F.when(_mod("event_id", 21) == 0, F.array("behavior_type", "behavior_type")).when(
            _mod("event_id", 7) == 0, F.array("behavior_type", F.lit("Unlisted"))).otherwise(F.array("behavior_type"))

    @staticmethod
    def _behavior_description() -> Column:
        return F.when(_mod("event_id", 3) == 0, F.concat(F.lit("Seen by staff: "), F.col("behavior_type"))).alias(
            "behavior_detailed_description")

    def _stg_ef3__discipline_incidents__behaviors(self) -> DataFrame:
        e = self("error_events")
        x = e.select("tenant_code", "home_school_id", "event_id", F.explode(self._behaviors()).alias("behavior_type"))
        return x.select(key("tenant_code", "home_school_id", "event_id").alias("k_discipline_incident"), "behavior_type",
                        self._behavior_description())

    def _stg_ef3__student_discipline_incident_behavior_associations(self) -> DataFrame:
        b = self("stg_ef3__discipline_incidents__behaviors").distinct()
        e = self("error_events").select("tenant_code", "home_school_id", "event_id", "user_id",
                                        key("tenant_code", "home_school_id", "event_id").alias("k_discipline_incident"))
        j = b.join(e, "k_discipline_incident")
        return j.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "user_id", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "user_id").alias("k_student_xyear"),
                        "k_discipline_incident", "behavior_type", "behavior_detailed_description",
                        F.col("event_id").cast("string").alias("incident_id"),
                        F.col("home_school_id").cast("string").alias("school_id"),
                        key("tenant_code", "home_school_id").alias("k_school"))

    def _stg_ef3__student_discipline_incident_behavior_associations__participation_codes(self) -> DataFrame:
        e = self("error_events")
        codes = F.when(_mod("event_id", 2) == 0, F.array(F.lit("Perpetrator"), F.lit("Accomplice"), F.lit("Perpetrator"))).when(
            _mod("event_id", 5) != 0, F.array(F.lit("Perpetrator"))).otherwise(F.array().cast("array<string>"))
        return e.select("tenant_code", key("tenant_code", "user_id", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "user_id").alias("k_student_xyear"),
                        key("tenant_code", "home_school_id", "event_id").alias("k_discipline_incident"),
                        F.explode(codes).alias("participation_code"))

    def _stg_ef3__discipline_actions(self) -> DataFrame:
        e = self("error_events")
        school = key("tenant_code", "home_school_id")
        uri = "uri://rollcall.example/DisciplineDescriptor#"
        one = F.concat(F.lit('[{"disciplineDescriptor": "' + uri),
                       F.when(F.col("value") >= 100, F.lit("Suspension")).otherwise(F.lit("Detention")), F.lit('"}'))
        more = F.when(_mod("event_id", 3) == 0, F.lit(', {"disciplineDescriptor": "' + uri + 'Warning"}')).otherwise(F.lit(""))
        staffs = F.concat(F.lit('[{"staffReference": {"staffUniqueId": "T'), _mod("user_id", 7).cast("string"),
                          F.lit('"}}]'))
        return e.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), F.lit(SCHOOL_YEAR).alias("api_year"),
            key("tenant_code", "user_id", F.lit(SCHOOL_YEAR)).alias("k_student"),
            key("tenant_code", "user_id").alias("k_student_xyear"),
            F.concat(F.lit("A"), F.col("event_id").cast("string")).alias("discipline_action_id"),
            F.col("incident_date").alias("discipline_date"),
            F.when(_mod("event_id", 3) != 0, school).alias("k_school__responsibility"),
            F.when(_mod("event_id", 3) != 2, school).alias("k_school__assignment"),
            F.when(_mod("event_id", 3) != 0, F.col("home_school_id").cast("string")).alias("responsibility_school_id"),
            F.when(_mod("event_id", 3) != 2, F.col("home_school_id").cast("string")).alias("assignment_school_id"),
            F.round(F.col("value") / 10, 0).alias("discipline_action_length"),
            F.concat(one, more, F.lit("]")).alias("v_disciplines"),
            staffs.alias("v_staffs"),
            F.col("event_id").cast("string").alias("incident_id"),
            F.col("home_school_id").cast("string").alias("school_id"),
            F.when(_mod("event_id", 5) != 0, F.col("behavior_type")).alias("link_behavior_type"),
        )

    # ---- assessments (orders, lineitem) -------------------------------------
    def _assessment_orders(self) -> DataFrame:
        """Orders as assessment results; some results of students enrolled in a
        second tenant are reported by that one too."""
        cols = ["tenant_code", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "begin_date",
                "school_year"]
        o = self("orders_home").select(*cols)
        to = self("student_transfers").select(F.col("c_custkey").alias("o_custkey"), F.col("tenant_code").alias("to_tenant"))
        again = (o.filter(_mod("o_orderkey", 5) == 0).join(to, "o_custkey")
                 .withColumn("tenant_code", F.col("to_tenant")).select(*cols))
        return o.unionByName(again)

    def _stg_ef3__assessments(self) -> DataFrame:
        o = self("assessment_orders").select("tenant_code", "o_orderpriority").distinct()
        return o.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
            assessment_key().alias("k_assessment"),
            F.col("o_orderpriority").alias("assessment_identifier"),
            F.lit(ASSESSMENT_NAMESPACE).alias("namespace"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Screener").otherwise("Benchmark")
             .alias("assessment_family"),
            F.concat(F.lit("Assessment "), F.col("o_orderpriority")).alias("assessment_title"),
            F.lit(ASSESSMENT_SUBJECT).alias("academic_subject"))

    def _stg_ef3__assessments__scores(self) -> DataFrame:
        a = self("stg_ef3__assessments").select("tenant_code", "api_year", "k_assessment")
        return a.select("*", F.explode(F.array(*[F.lit(n) for n in SCORE_NAMES])).alias("score_name"))

    def _stg_ef3__assessments__performance_levels(self) -> DataFrame:
        a = self("stg_ef3__assessments").select("tenant_code", "api_year", "k_assessment")
        pl = F.explode(F.array(*[F.struct(F.lit(n).alias("performance_level_name"),
                                          F.lit(v).alias("performance_level_value")) for n, v in PERFORMANCE_LEVELS]))
        return a.select("*", pl.alias("p")).select("tenant_code", "api_year", "k_assessment", "p.*")

    def _stg_ef3__assessments__grade_levels(self) -> DataFrame:
        a = self("stg_ef3__assessments").select("tenant_code", "api_year", "k_assessment")
        return a.select("*", F.explode(F.array(F.lit("Third grade"), F.lit("Fourth grade"))).alias("grade_level"))

    def _stg_ef3__student_assessments(self) -> DataFrame:
        o = self("assessment_orders")
        return o.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"), "school_year",
            student_assessment_key().alias("k_student_assessment"),
            assessment_key().alias("k_assessment"),
            key("tenant_code", "o_custkey", "school_year").alias("k_student"),
            key("tenant_code", "o_custkey").alias("k_student_xyear"),
            F.col("o_custkey").cast("string").alias("student_unique_id"),
            F.col("o_orderkey").cast("string").alias("student_assessment_identifier"),
            F.col("o_orderpriority").alias("assessment_identifier"),
            F.lit(ASSESSMENT_NAMESPACE).alias("namespace"),
            F.lit(ASSESSMENT_SUBJECT).alias("academic_subject"),
            F.col("begin_date").alias("administration_date"),
            F.when(_mod("o_orderkey", 2) == 0, "Third grade").otherwise("Fourth grade").alias("when_assessed_grade_level"))

    def _stg_ef3__student_assessments__score_results(self) -> DataFrame:
        li = self.t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
        o = self("assessment_orders").select("o_orderkey", "o_custkey", "tenant_code", "o_orderpriority")
        j = li.join(o, "o_orderkey")
        name = F.element_at(F.array(*[F.lit(n) for n in SCORE_NAMES]), (_mod("l_linenumber", 3) + 1).cast("int"))
        return j.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        student_assessment_key().alias("k_student_assessment"),
                        assessment_key().alias("k_assessment"),
                        F.col("o_orderpriority").alias("assessment_identifier"),
                        F.lit(ASSESSMENT_NAMESPACE).alias("namespace"),
                        name.alias("score_name"),
                        F.col("l_quantity").cast("int").cast("string").alias("score_result"))

    def _stg_ef3__student_assessments__performance_levels(self) -> DataFrame:
        o = self("assessment_orders")
        level = F.when(F.col("o_orderstatus") == "F", "Proficient").when(F.col("o_orderstatus") == "O", "Approaching") \
            .otherwise("Below")
        pls = F.when(_mod("o_orderkey", 5) == 0,
                     F.array(F.struct(F.lit("Proficiency").alias("n"), level.alias("r")),
                             F.struct(F.lit("Scale Score").alias("n"), F.lit("Z").alias("r")))
                     ).otherwise(F.array(F.struct(F.lit("Proficiency").alias("n"), level.alias("r"))))
        x = o.select("*", F.explode(pls).alias("p"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        student_assessment_key().alias("k_student_assessment"),
                        assessment_key().alias("k_assessment"),
                        F.col("o_orderpriority").alias("assessment_identifier"),
                        F.lit(ASSESSMENT_NAMESPACE).alias("namespace"),
                        F.col("p.n").alias("performance_level_name"), F.col("p.r").alias("performance_level_result"))

    # ---- student sections (lineitem) -----------------------------------------
    def _stg_ef3__student_section_associations(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus")
        o = self.t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        j = self._at_school(li.join(o, "l_orderkey"), "o_custkey", school="stu_school")
        j = self._at_school(j, "l_partkey", school="part_school", tenant="part_tenant")
        begin = F.date_add(F.lit(CAL_START), _mod("l_orderkey", 10).cast("int"))
        return j.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
            key("tenant_code", "o_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
            key("part_tenant", "l_partkey", F.lit("S1")).alias("k_course_section"),
            begin.alias("begin_date"),
            F.when(F.col("l_linestatus") == "F", F.date_add(begin, 15)).alias("end_date"),
            (F.col("l_linenumber") == 1).alias("is_homeroom"))

    # ---- staff (customers) ------------------------------------------------------
    def _staff_home(self) -> DataFrame:
        c = self("customer_home")
        return c.withColumn("staff_unique_id", F.concat(F.lit("T"), F.col("c_custkey").cast("string")))

    def _stg_ef3__staffs(self) -> DataFrame:
        c = self("staff_home")
        return c.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "staff_unique_id").alias("k_staff"), "staff_unique_id",
                        F.col("c_name").alias("first_name"), F.initcap("c_mktsegment").alias("last_name"),
                        F.when(_mod("c_custkey", 3) == 0, F.lit("Lee")).alias("middle_name"),
                        F.col("home_school_id").alias("school_id"))

    def _stg_ef3__staffs__emails(self) -> DataFrame:
        c = self("staff_home")
        sid = F.lower(F.col("staff_unique_id"))
        emails = F.filter(F.array(
            F.struct(F.lit("Work").alias("t"),
                     F.concat(sid, F.lit("@school"), F.col("home_school_id").cast("string"), F.lit(".edu")).alias("e")),
            F.when(_mod("c_custkey", 2) == 0, F.struct(F.lit("Personal").alias("t"),
                                                       F.concat(sid, F.lit("@gmail.com")).alias("e"))),
            F.when(_mod("c_custkey", 3) == 0, F.struct(F.lit("Work").alias("t"), F.concat(sid, F.lit(" at school")).alias("e"))),
            F.when(_mod("c_custkey", 5) == 0, F.struct(F.lit("Other").alias("t"),
                                                       F.concat(sid, F.lit("@district.org")).alias("e"))),
        ), lambda x: x.isNotNull())
        x = c.select("*", F.explode(emails).alias("m"))
        return x.select("tenant_code", key("tenant_code", "staff_unique_id").alias("k_staff"),
                        F.col("m.t").alias("email_type"), F.col("m.e").alias("email_address"))

    def _stg_ef3__staff_section_associations(self) -> DataFrame:
        # one teacher for each section that is not vacant
        st = self("staff_home").select("tenant_code", "staff_unique_id", "c_custkey")
        p = self("part_home").filter(F.col("p_size") < VACANT_FROM_SIZE).select(
            "p_partkey", _mod("p_partkey", self.n_staff).alias("staff_index"), F.col("tenant_code").alias("p_tenant"))
        p = p.join(self("customer_index"), "staff_index")
        j = st.join(p, "c_custkey")
        return j.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "staff_unique_id").alias("k_staff"),
                        key("p_tenant", "p_partkey", F.lit("S1")).alias("k_course_section"),
                        F.lit(CAL_START).alias("begin_date"),
                        F.when(_mod("c_custkey", 5) == 0, F.lit(dt.date(2024, 1, 20))).alias("end_date"),
                        F.lit("Teacher of Record").alias("classroom_position"))

    # ---- contacts (customers) -------------------------------------------------
    def _contact_home(self) -> DataFrame:
        c = self("customer_home")
        who = F.when(_mod("c_custkey", 4) == 0, F.array(F.lit("P"), F.lit("G"))).otherwise(F.array(F.lit("P")))
        x = c.select("*", F.explode(who).alias("role"))
        return x.withColumn("contact_unique_id", F.concat(F.col("role"), F.col("c_custkey").cast("string")))

    def _stg_ef3__contacts(self) -> DataFrame:
        c = self("contact_home")
        return c.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "contact_unique_id").alias("k_contact"), "contact_unique_id",
                        F.when(F.col("role") == "P", "Parent").otherwise("Guardian").alias("first_name"),
                        F.initcap("c_mktsegment").alias("last_name"))

    def _stg_ef3__contacts__emails(self) -> DataFrame:
        c = self("contact_home")
        cid = F.lower("contact_unique_id")
        em = F.filter(F.array(
            F.struct(F.lit("Home").alias("t"), F.concat(cid, F.lit("@mail.example")).alias("e")),
            F.when(_mod("c_custkey", 3) == 0, F.struct(F.lit("Work").alias("t"),
                                                       F.concat(cid, F.lit("@work.example")).alias("e"))),
            F.when(_mod("c_custkey", 5) == 0, F.struct(F.lit("Other").alias("t"),
                                                       F.concat(cid, F.lit("@other.example")).alias("e")))),
            lambda x: x.isNotNull())
        x = c.select("*", F.explode(em).alias("m"))
        return x.select("tenant_code", key("tenant_code", "contact_unique_id").alias("k_contact"),
                        F.col("m.t").alias("email_type"), F.col("m.e").alias("email_address"))

    def _stg_ef3__contacts__telephones(self) -> DataFrame:
        c = self("contact_home")
        num = F.lpad(_mod("c_custkey", 10000).cast("string"), 4, "0")
        ph = F.filter(F.array(
            F.struct(F.lit("Mobile").alias("t"), F.concat(F.lit("555-0"), num).alias("n")),
            F.when(_mod("c_custkey", 2) == 0, F.struct(F.lit("Home").alias("t"), F.concat(F.lit("555-1"), num).alias("n")))),
            lambda x: x.isNotNull())
        x = c.select("*", F.explode(ph).alias("m"))
        return x.select("tenant_code", key("tenant_code", "contact_unique_id").alias("k_contact"),
                        F.col("m.t").alias("phone_number_type"), F.col("m.n").alias("phone_number"))

    def _stg_ef3__contacts__addresses(self) -> DataFrame:
        c = self("contact_home")
        ad = F.array(
            F.struct(F.lit("Home").alias("t"), (_mod("c_custkey", 7) == 0).alias("d")),
            F.struct(F.lit("Mailing").alias("t"), F.lit(False).alias("d")))
        x = c.select("*", F.explode(ad).alias("m"))
        return x.select(key("tenant_code", "contact_unique_id").alias("k_contact"), F.col("m.t").alias("address_type"),
                        F.concat(F.col("c_custkey").cast("string"), F.lit(" "), F.col("m.t"), F.lit(" Ave")).alias("full_address"),
                        F.col("m.d").alias("do_not_publish"))

    def _stg_ef3__student_contact_associations(self) -> DataFrame:
        c = self("contact_home")
        years = F.when((_mod("c_custkey", 2) == 0) & (F.col("role") == "P"),
                       F.array(F.lit(SCHOOL_YEAR), F.lit(PRIOR_YEAR))).otherwise(F.array(F.lit(SCHOOL_YEAR)))
        x = c.select("*", F.explode(years).alias("school_year"))
        return x.select("tenant_code", "school_year",
                        key("tenant_code", "c_custkey", "school_year").alias("k_student"),
                        key("tenant_code", "c_custkey").alias("k_student_xyear"),
                        key("tenant_code", "contact_unique_id").alias("k_contact"),
                        F.when(F.col("role") == "P", 1).otherwise(2).alias("contact_priority"),
                        F.when(F.col("role") == "P", "Parent").otherwise("Guardian").alias("relation_type"),
                        ((F.col("role") == "P") | (_mod("c_custkey", 8) == 0)).alias("is_primary_contact"),
                        (F.col("role") == "P").alias("is_emergency_contact"))

    # ---- other names, indicators (customers) -----------------------------------
    def _stg_ef3__students__other_names(self) -> DataFrame:
        c = self("customer_home")
        types = F.when(_mod("c_custkey", 3) == 0, F.array(F.lit("Alias"), F.lit("Previous Legal Name"))).otherwise(
            F.array(F.lit("Alias")))
        x = c.select("*", F.explode(types).alias("other_name_type"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "c_custkey").alias("k_student_xyear"), "other_name_type",
                        F.when(_mod("c_custkey", 6) == 0, F.lit("Dr.")).alias("personal_title_prefix"),
                        F.concat(F.substring("c_name", 1, 3), F.lit("-"), F.left("other_name_type", F.lit(1))).alias("first_name"),
                        F.when(_mod("c_custkey", 4) == 0, F.lit("Lou")).alias("middle_name"),
                        F.upper("c_mktsegment").alias("last_surname"),
                        F.when(_mod("c_custkey", 9) == 0, F.lit("Jr.")).alias("generation_code_suffix"))

    def _stg_ef3__stu_ed_org__indicators(self) -> DataFrame:
        c = self("customer_home")
        ind = F.filter(F.array(
            F.struct(F.lit("Has IEP").alias("n"), F.when(_mod("c_custkey", 4) == 0, "Y").when(
                _mod("c_custkey", 4) == 1, "false").when(_mod("c_custkey", 4) == 2, "maybe").otherwise("1.0").alias("v")),
            F.struct(F.lit("Reading Level").alias("n"),
                     F.when(_mod("c_custkey", 9) == 0, F.lit("high")).otherwise(_mod("c_custkey", 6).cast("string")).alias("v")),
            F.when(_mod("c_custkey", 10) == 0, F.struct(F.lit("Unmapped Indicator").alias("n"), F.lit("x").alias("v")))),
            lambda x: x.isNotNull())
        x = c.select("*", F.explode(ind).alias("i"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "c_custkey").alias("k_student_xyear"),
                        F.col("home_school_id").cast("string").alias("ed_org_id"),
                        F.col("i.n").alias("indicator_name"), F.col("i.v").alias("indicator_value"))

    # ---- class periods, cohorts (supplier) --------------------------------------
    def _stg_ef3__class_periods(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "school_id", "k_school")
        per = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                                  for n, a, b in CLASS_PERIODS]))
        x = sch.select("*", per.alias("p"))
        meeting = F.concat(F.lit('[{"startTime": "'), F.col("p.a"), F.lit('", "endTime": "'), F.col("p.b"), F.lit('"}'),
                           F.when(_mod("school_id", 5) == 0, F.lit(', {"startTime": "14:00:00", "endTime": "14:30:00"}'))
                           .otherwise(F.lit("")), F.lit("]"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), "k_school",
                        key("tenant_code", "school_id", F.col("p.n")).alias("k_class_period"),
                        F.col("p.n").alias("class_period_name"),
                        (F.col("p.n") == "Period 1").alias("is_official_attendance_period"),
                        meeting.alias("v_meeting_times"))

    def _stg_ef3__cohorts(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "school_id", "k_school", "k_lea")
        x = sch.select("*", F.explode(F.array(F.lit("Class of 2030"), F.lit("Class of 2031"))).alias("cohort_id"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), "k_school", "k_lea",
                        key("tenant_code", "school_id", "cohort_id").alias("k_cohort"), "cohort_id",
                        F.concat(F.col("cohort_id"), F.lit(" at school "), F.col("school_id").cast("string"))
                        .alias("cohort_description"),
                        F.lit("Graduating Class").alias("cohort_type"), F.lit("School").alias("cohort_scope"))

    def _stg_ef3__student_cohort_associations(self) -> DataFrame:
        c = self("customer_home")
        cohort = F.when(_mod("c_custkey", 2) == 0, F.lit("Class of 2030")).otherwise(F.lit("Class of 2031"))
        return c.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "home_school_id", cohort).alias("k_cohort"),
                        F.date_add(F.lit(CAL_START), _mod("c_custkey", 20).cast("int")).alias("cohort_begin_date"),
                        F.when(_mod("c_custkey", 3) == 0, F.date_add(F.lit(CAL_START), 25)).alias("cohort_end_date"))

    # ---- academic records, GPAs, diplomas (customers) ----------------------------
    def _academic_home(self) -> DataFrame:
        c = self("customer_home")
        years = F.filter(F.array(F.lit(SCHOOL_YEAR), F.when(_mod("c_custkey", 2) == 0, F.lit(PRIOR_YEAR)),
                                 F.when(_mod("c_custkey", 3) == 0, F.lit(PRIOR_YEAR - 1))), lambda x: x.isNotNull())
        x = c.select("*", F.explode(years).alias("school_year"))
        return x.select("*", F.explode(F.array(F.lit("Fall"), F.lit("Spring"))).alias("academic_term"))

    def _stg_ef3__student_academic_records(self) -> DataFrame:
        a = self("academic_home")
        return a.select(
            "tenant_code", F.col("school_year").alias("api_year"), "school_year", "academic_term",
            key("tenant_code", "c_custkey", "school_year", "academic_term").alias("k_student_academic_record"),
            key("tenant_code", "c_custkey").alias("k_student_xyear"),
            F.when(_mod("c_custkey", 4) != 0, key("tenant_code", "home_school_id")).alias("k_school"),
            F.when(_mod("c_custkey", 2) == 1, key("tenant_code", F.lit("district"), _mod("c_custkey", 3))).alias("k_lea"),
            (_mod("c_custkey", 400) / 100.0).alias("cumulative_gpa"),
            F.when(_mod("c_custkey", 5) != 0, _mod("c_custkey", 300) / 100.0).alias("session_gpa"),
            _mod("c_custkey", 30).alias("cumulative_earned_credits"))

    def _stg_ef3__student_academic_records__gpas(self) -> DataFrame:
        a = self("academic_home").filter(F.col("school_year") == SCHOOL_YEAR)
        return a.select(
            "tenant_code", F.col("school_year").alias("api_year"),
            key("tenant_code", "c_custkey", "school_year", "academic_term").alias("k_student_academic_record"),
            F.lit("Cumulative, weighted").alias("gpa_type"), (_mod("c_custkey", 450) / 100.0).alias("gpa_value"),
            F.lit(True).alias("is_cumulative"), F.lit(4.5).alias("max_gpa_value"))

    def _stg_ef3__student_academic_records__diplomas(self) -> DataFrame:
        a = self("academic_home")
        return a.select(
            "tenant_code",
            key("tenant_code", "c_custkey", "school_year", "academic_term").alias("k_student_academic_record"),
            F.lit("Regular Diploma").alias("diploma_type"),
            F.make_date("school_year", F.lit(6), F.lit(1)).alias("diploma_award_date"),
            F.concat(F.lit("Diploma "), F.col("academic_term")).alias("diploma_description"))

    # ---- staff school assignments ------------------------------------------------
    def _stg_ef3__staff_school_associations(self) -> DataFrame:
        st = self("staff_home")
        progs = F.when(_mod("c_custkey", 2) == 0, F.array(F.lit("Regular Education"), F.lit("Special Education"))) \
            .otherwise(F.array(F.lit("Regular Education")))
        x = st.select("*", F.explode(progs).alias("program_assignment"))
        cal = key("tenant_code", "home_school_id", F.lit(SCHOOL_YEAR), F.lit("main"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "staff_unique_id").alias("k_staff"),
                        key("tenant_code", "home_school_id").alias("k_school"),
                        F.when(_mod("c_custkey", 3) != 0, cal).alias("k_school_calendar"), "program_assignment")

    def _stg_ef3__staff_education_organization_assignment_associations(self) -> DataFrame:
        st = self("staff_home")
        school = st.filter(_mod("c_custkey", 4) != 0).select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), key("tenant_code", "staff_unique_id").alias("k_staff"),
            F.lit("School").alias("ed_org_type"), key("tenant_code", "home_school_id").alias("k_school"),
            F.lit(None).cast("string").alias("k_lea"), F.lit("Teacher").alias("position_title"),
            F.date_add(F.lit(dt.date(2023, 8, 15)), _mod("c_custkey", 10).cast("int")).alias("begin_date"),
            F.when(_mod("c_custkey", 5) == 0, F.lit(dt.date(2024, 1, 20))).alias("end_date"),
            F.lit(1.0).alias("full_time_equivalency"), F.lit(1).alias("order_of_assignment"),
            F.lit("Teacher").alias("staff_classification"))
        lea = st.select(
            "tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), key("tenant_code", "staff_unique_id").alias("k_staff"),
            F.lit("LocalEducationAgency").alias("ed_org_type"), F.lit(None).cast("string").alias("k_school"),
            key("tenant_code", "home_nationkey").alias("k_lea"), F.lit("Staff").alias("position_title"),
            F.lit(dt.date(2023, 8, 1)).alias("begin_date"), F.lit(None).cast("date").alias("end_date"),
            F.lit(0.5).alias("full_time_equivalency"), F.lit(2).alias("order_of_assignment"),
            F.lit("Instructional Staff").alias("staff_classification"))
        return school.unionByName(lea)

    # ---- course characteristics, subjects, ids, section programs (part) -------
    def _course_chars_json(self, col) -> Column:
        return F.concat(F.lit('[{"courseLevelCharacteristicDescriptor": "' + CHAR_URI), col, F.lit('"}]'))

    def _stg_ef3__courses__academic_subjects(self) -> DataFrame:
        p = self("part_home")
        subj = F.when(_mod("p_partkey", 5) == 0, F.array(F.initcap("p_type"), F.lit("Science"))).when(
            _mod("p_partkey", 7) == 0, F.array().cast("array<string>")).otherwise(F.array(F.initcap("p_type")))
        return p.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "p_partkey").alias("k_course"), F.explode(subj).alias("academic_subject"))

    def _stg_ef3__courses__identification_codes(self) -> DataFrame:
        p = self("part_home")
        ids = F.array(F.struct(F.lit("LEA course code").alias("s"), F.col("p_name").alias("c")),
                      F.struct(F.lit("SCED course code").alias("s"),
                               F.concat(F.lit("S"), _mod("p_partkey", 100).cast("string")).alias("c")),
                      F.struct(F.lit("Other").alias("s"), F.col("p_brand").alias("c")))
        x = p.select("*", F.explode(ids).alias("i"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "p_partkey").alias("k_course"),
                        F.col("i.s").alias("id_system"), F.col("i.c").alias("id_code"))

    def _stg_ef3__sections__programs(self) -> DataFrame:
        p = self("part_home")
        prios = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-UNKNOWN"]
        prio = F.element_at(F.array(*[F.lit(x) for x in prios]), (_mod("p_partkey", 6) + 1).cast("int"))
        return p.select("tenant_code", key("tenant_code", "p_partkey", F.lit("S1")).alias("k_course_section"),
                        key("tenant_code", "home_school_id", prio).alias("k_program"))

    # ---- educator preparation (customers) -----------------------------------------
    def _candidate_home(self) -> DataFrame:
        c = self("customer_home")
        return c.withColumn("candidate_id", F.concat(F.lit("C"), F.col("c_custkey").cast("string")))

    def _stg_tpdm__candidates(self) -> DataFrame:
        c = self("candidate_home")
        years = F.when(_mod("c_custkey", 2) == 0, F.array(F.lit(SCHOOL_YEAR), F.lit(PRIOR_YEAR))).otherwise(
            F.array(F.lit(SCHOOL_YEAR)))
        x = c.select("*", F.explode(years).alias("school_year"))
        return x.select("tenant_code", "school_year", F.col("school_year").alias("api_year"),
                        key("tenant_code", "candidate_id", "school_year").alias("k_candidate"),
                        key("tenant_code", "candidate_id").alias("k_candidate_xyear"),
                        key("tenant_code", "candidate_id").alias("k_person"), "candidate_id",
                        F.col("c_name").alias("first_name"),
                        F.when(F.col("school_year") == PRIOR_YEAR, F.lit("Earlier")).otherwise(
                            F.initcap("c_mktsegment")).alias("last_name"),
                        F.when(_mod("c_custkey", 3) == 0, F.lit("Rae")).alias("middle_name"),
                        F.when(_mod("c_custkey", 2) == 0, "Female").otherwise("Male").alias("gender"),
                        (_mod("c_custkey", 9) == 0).alias("has_hispanic_latino_ethnicity"),
                        (_mod("c_custkey", 4) == 0).alias("is_economic_disadvantaged"))

    def _stg_tpdm__candidate__races(self) -> DataFrame:
        c = self("stg_tpdm__candidates").select("k_candidate", "candidate_id")
        r = self("candidate_home").select("candidate_id", "c_custkey")
        j = c.join(r, "candidate_id")
        races = F.when(_mod("c_custkey", 5) == 0, F.array(F.lit("White"))).when(
            _mod("c_custkey", 5) == 1, F.array(F.lit("White"), F.lit("Asian"))).otherwise(F.array().cast("array<string>"))
        return j.select("k_candidate", F.explode(races).alias("race"))

    def _stg_tpdm__candidates__other_names(self) -> DataFrame:
        c = self("stg_tpdm__candidates")
        return c.select("tenant_code", "api_year", "k_candidate", "k_candidate_xyear",
                        F.lit("Alias").alias("other_name_type"),
                        F.concat(F.left("first_name", F.lit(2)), F.lit("-A")).alias("first_name"),
                        F.upper("last_name").alias("last_surname"))

    def _stg_tpdm__educator_preparation_programs(self) -> DataFrame:
        t = self("nation_tenant").select("tenant_code").distinct()
        x = t.select("tenant_code", F.explode(F.array(F.lit("Traditional"), F.lit("Alternative"))).alias("program_type"))
        return x.select("tenant_code", key("tenant_code", "program_type").alias("k_educator_preparation_program"),
                        F.concat(F.lit("EPP-"), F.col("program_type")).alias("program_id"),
                        F.concat(F.col("program_type"), F.lit(" Preparation")).alias("program_name"), "program_type")

    def _stg_tpdm__candidate_educator_preparation_program_associations(self) -> DataFrame:
        c = self("candidate_home")
        ptype = F.when(_mod("c_custkey", 2) == 0, F.lit("Traditional")).otherwise(F.lit("Alternative"))
        return c.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "candidate_id", F.lit(SCHOOL_YEAR)).alias("k_candidate"),
                        key("tenant_code", ptype).alias("k_educator_preparation_program"),
                        F.lit(dt.date(2023, 9, 1)).alias("begin_date"),
                        F.when(_mod("c_custkey", 3) == 0, F.lit(dt.date(2024, 5, 30))).alias("end_date"),
                        ptype.alias("program_type"))

    def _stg_tpdm__certification_exams(self) -> DataFrame:
        t = self("nation_tenant").select("tenant_code").distinct()
        x = t.select("tenant_code", F.explode(F.array(*[F.lit(e) for e in CERT_EXAMS])).alias("certification_exam_title"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "certification_exam_title").alias("k_certification_exam"),
                        F.upper(F.regexp_replace("certification_exam_title", " ", "_")).alias("certification_exam_id"),
                        "certification_exam_title", F.lit("Licensure").alias("certification_exam_type"))

    def _stg_tpdm__certification_exam_results(self) -> DataFrame:
        c = self("candidate_home")
        x = c.select("*", F.explode(F.array(*[F.lit(e) for e in CERT_EXAMS])).alias("exam"))
        score = _mod(F.col("c_custkey") + F.length("exam"), 200)
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "candidate_id", "exam", F.lit(1)).alias("k_certification_exam_result"),
                        key("tenant_code", "candidate_id").alias("k_person"),
                        key("tenant_code", "exam").alias("k_certification_exam"),
                        F.lit(dt.date(2024, 1, 10)).alias("certification_exam_date"), F.lit(1).alias("attempt_number"),
                        F.when(score >= 100, "Pass").otherwise("Fail").alias("certification_exam_pass_indicator"),
                        score.cast("string").alias("certification_exam_score"))

    def _stg_tpdm__candidate_relationship_to_staff_associations(self) -> DataFrame:
        c = self("candidate_home")
        return c.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "candidate_id", F.lit(SCHOOL_YEAR)).alias("k_candidate"),
                        key("tenant_code", F.concat(F.lit("T"), F.col("c_custkey").cast("string"))).alias("k_staff"),
                        F.lit(dt.date(2023, 9, 1)).alias("begin_date"),
                        F.lit("Mentor").alias("staff_to_candidate_relationship"))

    # ---- networks (supplier, region) --------------------------------------------
    def _stg_ef3__education_organization_networks(self) -> DataFrame:
        t = self("nation_tenant").select("tenant_code").distinct()
        n = F.explode(F.array(F.struct(F.lit("Region Network").alias("name"), F.lit("Shared Services").alias("purpose")),
                              F.struct(F.lit("Charter Network").alias("name"), F.lit("Charter Management").alias("purpose"))))
        x = t.select("tenant_code", n.alias("n"))
        return x.select("tenant_code", key("tenant_code", F.col("n.name")).alias("k_network"),
                        F.col("n.name").alias("network_name"), F.col("n.purpose").alias("network_purpose"),
                        F.upper(F.regexp_replace(F.col("n.name"), " ", "_")).alias("network_id"))

    def _stg_ef3__education_organization_network_associations(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "k_school", "school_id")
        a = F.filter(F.array(
            F.struct(F.lit("Region Network").alias("n"), F.lit(dt.date(2020, 7, 1)).alias("b"),
                     F.lit(None).cast("date").alias("e")),
            F.when(_mod("school_id", 3) == 0, F.struct(F.lit("Region Network").alias("n"),
                                                       F.lit(dt.date(2018, 7, 1)).alias("b"),
                                                       F.lit(dt.date(2020, 6, 30)).alias("e"))),
            F.when(_mod("school_id", 4) == 0, F.struct(F.lit("Charter Network").alias("n"),
                                                       F.lit(dt.date(2022, 7, 1)).alias("b"),
                                                       F.lit(dt.date(2023, 6, 30)).alias("e")))),
            lambda x: x.isNotNull())
        x = sch.select("*", F.explode(a).alias("a"))
        return x.select("tenant_code", "k_school", key("tenant_code", F.col("a.n")).alias("k_network"),
                        F.col("a.b").alias("begin_date"), F.col("a.e").alias("end_date"))

    # ---- section attendance events (events) ---------------------------------------
    def _stg_ef3__student_section_attendance_events(self) -> DataFrame:
        ev = (self.t("events").select("event_id", "ts", "user_id", "event_type")
              .withColumn("section_index", _mod("event_id", self.n_sections)).join(self("part_index"), "section_index"))
        j = self._at_school(ev, "user_id", school="u_school")
        j = self._at_school(j, "p_partkey", school="p_school", tenant="p_tenant")
        return j.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"), F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "user_id", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("p_tenant", "p_partkey", F.lit("S1")).alias("k_course_section"),
                        F.to_date("ts").alias("attendance_event_date"),
                        F.when(F.col("event_type") == "view", "Tardy").otherwise(F.col("event_type"))
                        .alias("attendance_event_category"),
                        F.col("event_id").cast("string").alias("attendance_event_reason"))

    # ---- program participation statuses, local budgets (orders) ---------------------
    def _stg_ef3__local_budgets(self) -> DataFrame:
        o = self("orders_home")
        return o.select("tenant_code", F.col("o_orderstatus").alias("budget_status"),
                        key("tenant_code", F.lit("budget"), "o_orderkey").alias("k_local_budget_snapshot"),
                        key("tenant_code", "o_custkey").alias("k_local_account"),
                        F.col("o_totalprice").alias("amount"), F.col("begin_date").alias("as_of_date"),
                        F.col("home_school_id").cast("string").alias("ed_org_id"),
                        F.col("o_orderpriority").alias("financial_collection"),
                        F.year("begin_date").alias("fiscal_year"),
                        F.col("o_custkey").cast("string").alias("local_account_identifier"))

    # ---- transcripts (lineitem) ----------------------------------------------------
    def _stg_ef3__course_transcripts(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
        o = self.t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        j = self._at_school(li.join(o, "l_orderkey"), "o_custkey", school="u_school")
        j = self._at_school(j, "l_partkey", school="p_school", tenant="p_tenant")
        term = F.when(_mod("l_linenumber", 2) == 1, F.lit("Fall")).otherwise(F.lit("Spring"))
        return j.select("tenant_code",
                        key("p_tenant", "l_partkey").alias("k_course"),
                        key("tenant_code", "o_custkey", F.lit(SCHOOL_YEAR), term).alias("k_student_academic_record"),
                        F.when(F.col("l_returnflag") == "R", "Fail").otherwise("Pass").alias("course_attempt_result"),
                        F.when(_mod("l_linenumber", 3) != 0, F.concat(F.lit("Transcript "), F.col("l_partkey").cast("string")))
                        .alias("course_title"),
                        (F.col("l_quantity") / 10.0).alias("earned_credits"),
                        F.col("l_returnflag").alias("final_letter_grade_earned"))

    # ---- chart of accounts (part) --------------------------------------------------
    def _account_dimension(self, name: str) -> DataFrame:
        dims = {d: (c, m) for d, c, m in ACCOUNT_DIMENSIONS}
        col, m = dims[name]
        t = self("nation_tenant").select("tenant_code").distinct()
        codes = t.select("tenant_code", F.explode(F.sequence(F.lit(0), F.lit(m - 2))).alias("code"))
        return codes.select(key("tenant_code", F.lit(name), "code").alias(f"k_{name}_dimension"),
                            F.col("code").cast("string").alias(f"{name}_dimension_code"),
                            F.concat(F.lit(name.replace("_", " ").title() + " "), F.col("code").cast("string"))
                            .alias(f"{name}_dimension_code_name"))

    def _stg_ef3__chart_of_accounts(self) -> DataFrame:
        p = self("part_home")
        cols = [key("tenant_code", F.lit(d), _mod(c, m)).alias(f"k_{d}_dimension") for d, c, m in ACCOUNT_DIMENSIONS]
        return p.select("tenant_code", F.lit(SCHOOL_YEAR).alias("fiscal_year"),
                        key("tenant_code", F.lit("coa"), "p_partkey").alias("k_chart_of_account"),
                        F.col("p_partkey").cast("string").alias("chart_of_account_identifier"),
                        F.col("p_name").alias("chart_of_account_name"),
                        key("tenant_code", "home_school_id").alias("k_school"), *cols)

    # ---- education service centers (region) ------------------------------------------
    def _stg_ef3__education_service_centers(self) -> DataFrame:
        r = self.t("region").select("r_regionkey", F.col("r_name").alias("tenant_code"))
        return r.select("tenant_code", key("tenant_code", F.lit("esc")).alias("k_esc"),
                        F.col("r_regionkey").cast("string").alias("esc_id"),
                        F.concat(F.initcap("tenant_code"), F.lit(" Service Center")).alias("esc_name"))

    def _stg_ef3__education_service_centers__addresses(self) -> DataFrame:
        r = self.t("region").select("r_regionkey", F.col("r_name").alias("tenant_code"))
        types = F.when(_mod("r_regionkey", 2) == 0, F.array(F.lit("Mailing"), F.lit("Physical"))).otherwise(
            F.array(F.lit("Mailing"), F.lit("Billing")))
        x = r.select("*", F.explode(types).alias("address_type"))
        return x.select(key("tenant_code", F.lit("esc")).alias("k_esc"), "address_type",
                        F.concat(F.col("address_type"), F.lit(" Way "), F.col("r_regionkey").cast("string"))
                        .alias("street_address"), F.initcap("tenant_code").alias("city"),
                        F.lpad(F.col("r_regionkey").cast("string"), 5, "0").alias("postal_code"),
                        F.when((F.col("address_type") == "Physical") & (F.col("r_regionkey") == 2), F.lit(dt.date(2023, 6, 30)))
                        .alias("address_end_date"))

    def _stg_ef3__fund_dimensions(self) -> DataFrame:
        return self._account_dimension("fund")

    def _stg_ef3__function_dimensions(self) -> DataFrame:
        return self._account_dimension("function")

    def _stg_ef3__object_dimensions(self) -> DataFrame:
        return self._account_dimension("object")

    def _stg_ef3__program_dimensions(self) -> DataFrame:
        return self._account_dimension("program")

    def _stg_ef3__project_dimensions(self) -> DataFrame:
        return self._account_dimension("project")

    def _stg_ef3__source_dimensions(self) -> DataFrame:
        return self._account_dimension("source")

    def _stg_ef3__operational_unit_dimensions(self) -> DataFrame:
        return self._account_dimension("operational_unit")

    def _stg_ef3__balance_sheet_dimensions(self) -> DataFrame:
        return self._account_dimension("balance_sheet")

    # ---- objective assessments (orders) ------------------------------------------------
    def _stg_ef3__objective_assessments(self) -> DataFrame:
        a = self("stg_ef3__assessments").select("tenant_code", "api_year", "k_assessment", "assessment_identifier",
                                                "namespace", "academic_subject")
        x = a.select("*", F.explode(F.array(*[F.lit(c) for c in OBJECTIVE_CODES])).alias("objective_assessment_identification_code"))
        first = F.col("objective_assessment_identification_code") == OBJECTIVE_CODES[0]
        return x.withColumn("o_orderpriority", F.col("assessment_identifier")).select(
            "*", assessment_key(F.lower("objective_assessment_identification_code"), subjects=2).alias("k_objective_assessment"),
            F.concat(F.lit("Objective "), F.col("objective_assessment_identification_code"))
            .alias("objective_assessment_description"),
            F.when(first, 100).otherwise(50).alias("max_raw_score"), F.lit("Strand").alias("nomenclature"),
            F.when(first, 60).otherwise(40).alias("percent_of_assessment")).drop("o_orderpriority")

    def _objective_orders(self) -> DataFrame:
        o = self("assessment_orders")
        return o.select("*", F.explode(F.array(*[F.lit(c) for c in OBJECTIVE_CODES])).alias("code"))

    def _stg_ef3__student_objective_assessments(self) -> DataFrame:
        x = self("objective_orders")
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"), "school_year",
                        self._student_objective_key().alias("k_student_objective_assessment"),
                        assessment_key(F.lower("code"), subjects=2).alias("k_objective_assessment"),
                        student_assessment_key().alias("k_student_assessment"),
                        assessment_key().alias("k_assessment"),
                        key("tenant_code", "o_custkey", "school_year").alias("k_student"),
                        key("tenant_code", "o_custkey").alias("k_student_xyear"),
                        F.col("o_orderkey").cast("string").alias("student_assessment_identifier"),
                        F.lit(ASSESSMENT_SUBJECT).alias("assess_academic_subject"),
                        F.lit(ASSESSMENT_SUBJECT).alias("academic_subject"),
                        F.col("o_orderpriority").alias("assessment_identifier"),
                        F.lit(ASSESSMENT_NAMESPACE).alias("namespace"),
                        F.col("code").alias("objective_assessment_identification_code"),
                        F.col("begin_date").alias("administration_date"))

    @staticmethod
    def _student_objective_key() -> Column:
        return assessment_key(F.lower("code"), F.col("o_orderkey").cast("string"))

    def _stg_ef3__student_objective_assessments__score_results(self) -> DataFrame:
        res = F.explode(F.array(
            F.struct(F.lit("Raw Score").alias("n"), _mod(F.floor("o_totalprice"), 100).cast("string").alias("r")),
            F.struct(F.lit("Mastery").alias("n"), F.when(_mod("o_orderkey", 2) == 0, "Y").otherwise("N").alias("r"))))
        x = self("objective_orders").select("*", res.alias("x"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        self._student_objective_key().alias("k_student_objective_assessment"),
                        F.col("o_orderpriority").alias("assessment_identifier"), F.lit(ASSESSMENT_NAMESPACE).alias("namespace"),
                        F.col("code").alias("objective_assessment_identification_code"),
                        F.col("x.n").alias("score_name"), F.col("x.r").alias("score_result"))

    def _stg_ef3__student_objective_assessments__performance_levels(self) -> DataFrame:
        s = self("stg_ef3__student_objective_assessments")
        return s.select("tenant_code", "k_student_objective_assessment", "assessment_identifier", "namespace",
                        "objective_assessment_identification_code",
                        F.lit("Objective Level").alias("performance_level_name"),
                        F.when(F.col("objective_assessment_identification_code") == "OBJ-A", "Met").otherwise("Not Met")
                        .alias("performance_level_result"))

    def _stg_ef3__discipline_actions__student_discipline_incident_behaviors(self) -> DataFrame:
        a = self("stg_ef3__discipline_actions")
        return a.select("tenant_code", "k_student", "k_student_xyear", "discipline_action_id", "discipline_date",
                        "incident_id", "school_id", F.col("link_behavior_type").alias("behavior_type"))

    # ---- student and staff identification codes, staff races ------------------------
    def _stg_ef3__stu_ed_org__identification_codes(self) -> DataFrame:
        c = self("customer_home")
        ids = F.filter(F.array(
            F.struct(F.lit("State").alias("s"), F.concat(F.lit("ST"), F.col("c_custkey").cast("string")).alias("c")),
            F.struct(F.lit("District").alias("s"), F.concat(F.lit("D"), F.col("c_custkey").cast("string")).alias("c")),
            F.when(_mod("c_custkey", 3) == 0, F.struct(F.lit("Other").alias("s"), F.lit("X").alias("c")))),
            lambda x: x.isNotNull())
        x = c.select("*", F.explode(ids).alias("i"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "c_custkey").alias("k_student_xyear"),
                        F.col("home_school_id").cast("string").alias("ed_org_id"),
                        F.col("i.s").alias("id_system"), F.col("i.c").alias("id_code"))

    def _stg_ef3__staffs__identification_codes(self) -> DataFrame:
        st = self("staff_home")
        x = st.select("*", F.explode(F.array(F.lit("State"), F.lit("District"))).alias("id_system"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "staff_unique_id").alias("k_staff"), "id_system",
                        F.concat(F.left("id_system", F.lit(2)), F.col("staff_unique_id")).alias("id_code"))

    def _stg_ef3__staffs__races(self) -> DataFrame:
        st = self("staff_home")
        races = F.when(_mod("c_custkey", 3) == 0, F.array(F.lit("White"), F.lit("Asian"))).when(
            _mod("c_custkey", 3) == 1, F.array(F.lit("Black - African American"))).otherwise(F.array().cast("array<string>"))
        return st.select(key("tenant_code", "staff_unique_id").alias("k_staff"), F.explode(races).alias("race"),
                         (_mod("c_custkey", 9) == 0).alias("has_hispanic_latino_ethnicity"))

    def _stg_ef3__discipline_actions__disciplines(self) -> DataFrame:
        a = self("stg_ef3__discipline_actions")
        d = F.explode(F.from_json("v_disciplines", "array<struct<disciplineDescriptor:string>>"))
        x = a.select("k_student", "discipline_action_id", "discipline_date", d.alias("d"))
        return x.select("k_student", "discipline_action_id", "discipline_date",
                        F.substring_index(F.col("d.disciplineDescriptor"), "#", -1).alias("discipline_type"))

    def _non_offenders(self) -> DataFrame:
        return self("error_events").withColumn("witness", F.col("user_id") + 7)

    def _stg_ef3__student_discipline_incident_non_offender_associations(self) -> DataFrame:
        e = self("non_offenders")
        return e.select("tenant_code",
                        key("tenant_code", "witness", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "witness").alias("k_student_xyear"),
                        key("tenant_code", "home_school_id", "event_id").alias("k_discipline_incident"),
                        key("tenant_code", "home_school_id").alias("k_school"),
                        F.col("home_school_id").cast("string").alias("school_id"),
                        F.col("event_id").cast("string").alias("incident_id"))

    def _stg_ef3__student_discipline_incident_non_offender_associations__participation_codes(self) -> DataFrame:
        e = self("non_offenders")
        codes = F.when(_mod("event_id", 2) == 0, F.array(F.lit("Witness"), F.lit("Reporter"))).otherwise(
            F.array(F.lit("Witness")))
        return e.select(key("tenant_code", "witness", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        key("tenant_code", "witness").alias("k_student_xyear"),
                        key("tenant_code", "home_school_id", "event_id").alias("k_discipline_incident"),
                        F.explode(codes).alias("participation_code"))

    # ---- classrooms, graduation plans, learning standards, cohort years, disabilities -----
    def _stg_ef3__locations(self) -> DataFrame:
        sch = self("stg_ef3__schools").select("tenant_code", "k_school", "school_id")
        rooms = F.when(_mod("school_id", 2) == 0, F.array(F.lit("R101"), F.lit("R102"), F.lit("R103"))).otherwise(
            F.array(F.lit("R101"), F.lit("R102")))
        x = sch.select("*", F.explode(rooms).alias("classroom_id_code"))
        return x.select("tenant_code", "k_school", key("tenant_code", "school_id", "classroom_id_code").alias("k_location"),
                        "classroom_id_code", (F.lit(20) + _mod("school_id", 10)).alias("maximum_seating"))

    def _stg_ef3__graduation_plans(self) -> DataFrame:
        n = self("nation_tenant")
        x = n.select("*", F.explode(F.array(F.lit("Standard"), F.lit("Distinguished"))).alias("graduation_plan_type"))
        credits = F.when(F.col("graduation_plan_type") == "Standard", F.lit(22)).otherwise(F.lit(26))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("school_year"),
                        key("tenant_code", "n_nationkey", "graduation_plan_type", F.lit(SCHOOL_YEAR)).alias("k_graduation_plan"),
                        key("tenant_code", "n_nationkey").alias("k_lea"), "graduation_plan_type",
                        credits.alias("total_required_credits"),
                        F.concat(F.lit('[{"subject": "Mathematics", "credits": '), (credits / 5).cast("int").cast("string"),
                                 F.lit("}]")).alias("v_credits_by_subjects"))

    def _stg_ef3__learning_standards(self) -> DataFrame:
        p = self("part_home").select("tenant_code", "p_type").distinct()
        return p.select("tenant_code", key("tenant_code", F.lit("LS"), "p_type").alias("k_learning_standard"),
                        F.concat(F.lit("LS-"), F.col("p_type")).alias("learning_standard_id"),
                        F.concat(F.initcap("p_type"), F.lit(" standard")).alias("learning_standard_description"))

    def _stg_ef3__grades__learning_standards(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus", "l_returnflag")
        o = self.t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        pt = self.t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        j = self._at_school(li.join(o, "l_orderkey").join(pt, "l_partkey"), "o_custkey", school="stu_school")
        j = self._at_school(j, "l_partkey", school="part_school", tenant="part_tenant")
        period = F.when(_mod("l_linenumber", 2) == 0, F.lit(GRADING_PERIODS[0][0])).otherwise(F.lit(GRADING_PERIODS[1][0]))
        return j.select(
            "tenant_code", key("tenant_code", "o_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
            key("tenant_code", "stu_school").alias("k_school"),
            key("part_tenant", "l_partkey", F.lit("S1")).alias("k_course_section"),
            key("tenant_code", "stu_school", F.lit(SCHOOL_YEAR), period).alias("k_grading_period"),
            key("part_tenant", F.lit("LS"), "p_type").alias("k_learning_standard"),
            F.when(F.col("l_linestatus") == "F", "Final").otherwise("Grading Period").alias("grade_type"),
            F.col("l_returnflag").alias("learning_standard_letter_grade_earned"))

    def _stg_ef3__stu_ed_org__cohort_years(self) -> DataFrame:
        c = self("customer_home")
        cy = F.filter(F.array(
            F.struct(F.lit("Ninth grade").alias("t"), (F.lit(2027) + _mod("c_custkey", 3)).cast("int").alias("y"),
                     F.lit("Fall").alias("m")),
            F.when(_mod("c_custkey", 2) == 0, F.struct(F.lit("Graduation").alias("t"), F.lit(2030).alias("y"),
                                                       F.lit(None).cast("string").alias("m")))),
            lambda x: x.isNotNull())
        x = c.select("*", F.explode(cy).alias("c"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "c_custkey", F.lit(SCHOOL_YEAR)).alias("k_student"),
                        F.col("c.t").alias("cohort_year_type"), F.col("c.y").alias("school_year"),
                        F.col("c.m").alias("academic_term"))

    def _stg_ef3__stu_spec_ed__disabilities(self) -> DataFrame:
        s = self("stg_ef3__student_special_education_program_associations").select(
            "tenant_code", "school_year", "k_student_program", "k_student", "k_student_xyear", "k_program", "k_lea", "k_school",
            "program_enroll_begin_date")
        o = self("orders_home").select(key("tenant_code", "o_custkey", "o_orderkey").alias("k_student_program"),
                                       "o_orderkey")
        j = s.join(o, "k_student_program")
        d = F.filter(F.array(
            F.struct(F.lit("Autism").alias("t"), F.lit(1).alias("o")),
            F.when(_mod("o_orderkey", 3) == 0, F.struct(F.lit("Speech Impairment").alias("t"), F.lit(2).alias("o"))),
            F.when(_mod("o_orderkey", 5) == 0, F.struct(F.lit("Another Disability").alias("t"), F.lit(1).alias("o")))),
            lambda x: x.isNotNull())
        x = j.select("*", F.explode(d).alias("d"))
        return x.select("tenant_code", "school_year", "k_student_program", "k_student", "k_student_xyear", "k_program", "k_lea",
                        "k_school", "program_enroll_begin_date", F.col("d.t").alias("disability_type"),
                        F.when(_mod("o_orderkey", 2) == 0, F.lit("Parent")).alias("disability_source_type"),
                        F.concat(F.lit("Diagnosis of "), F.lower("d.t")).alias("disability_diagnosis"),
                        F.col("d.o").alias("order_of_disability"))

    def _stg_ef3__local_education_agencies__identification_codes(self) -> DataFrame:
        n = self("nation_tenant")
        x = n.select("*", F.explode(F.array(F.lit("NCES"), F.lit("State"), F.lit("Other"))).alias("id_system"))
        return x.select("tenant_code", F.lit(SCHOOL_YEAR).alias("api_year"),
                        key("tenant_code", "n_nationkey").alias("k_lea"), "id_system",
                        F.concat(F.left("id_system", F.lit(1)), F.col("n_nationkey").cast("string")).alias("id_code"))

    def _stg_ef3__staff_education_organization_contact_associations(self) -> DataFrame:
        st = self("staff_home")
        x = st.select("*", F.explode(F.array(F.lit(SCHOOL_YEAR), F.lit(PRIOR_YEAR))).alias("api_year"))
        return x.select("tenant_code", "api_year", key("tenant_code", "staff_unique_id").alias("k_staff"),
                        key("tenant_code", "home_nationkey").alias("k_lea"),
                        key("tenant_code", "home_school_id").alias("k_school"),
                        F.lit("Work").alias("contact_title"),
                        F.concat(F.lower("staff_unique_id"), F.lit("@district"), F.col("api_year").cast("string"),
                                 F.lit(".org")).alias("email_address"))

    def _stg_ef3__objective_assessments__scores(self) -> DataFrame:
        o = self("stg_ef3__objective_assessments").select("tenant_code", "api_year", "k_objective_assessment")
        return o.select("*", F.explode(F.array(F.lit("Raw Score"), F.lit("Mastery"))).alias("score_name"))

    def _stg_ef3__objective_assessments__performance_levels(self) -> DataFrame:
        o = self("stg_ef3__objective_assessments").select("tenant_code", "api_year", "k_objective_assessment")
        pl = F.explode(F.array(F.struct(F.lit("Met").alias("n"), F.lit("1").alias("v")),
                               F.struct(F.lit("Not Met").alias("n"), F.lit("0").alias("v"))))
        x = o.select("*", pl.alias("p"))
        return x.select("tenant_code", "api_year", "k_objective_assessment",
                        F.col("p.n").alias("performance_level_name"), F.col("p.v").alias("performance_level_value"))
