"""The outpatient cohort: which notes to read, one row per billed doctor, note and code."""

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noteloom import contract as C
from noteloom.operators.notes import with_row_id
from noteloom.session import stored

Star = Mapping[str, DataFrame]
IGNORE_CASE = "UTF8_LCASE_RTRIM"


def same_text(column: Column, value: str, ci: bool = False) -> Column:
    """Equality; with ``ci`` as under a case-insensitive, right-trimmed collation."""
    return (F.collate(column, IGNORE_CASE) if ci else column) == F.lit(value)


def mentions_doctor(category: Column) -> Column:
    return F.lower(category).contains(C.DOCTOR_WORD)


def day_before(as_of: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """[start, end) of the day before ``as_of``: a range that reaches the scan."""
    end = dt.datetime.combine(as_of, dt.time())
    return end - dt.timedelta(days=1), end


def in_window(timestamp: Column, start: dt.datetime | None, end: dt.datetime | None) -> Column:
    inside = F.lit(True)
    if start is not None:
        inside &= timestamp >= F.lit(start.isoformat(" ")).cast("timestamp_ntz")
    if end is not None:
        inside &= timestamp < F.lit(end.isoformat(" ")).cast("timestamp_ntz")
    return inside


# --- joins ----------------------------------------------------------------------------
# No broadcast hints: the planner broadcasts a side whose size it knows to be under
# spark.sql.autoBroadcastJoinThreshold and shuffles otherwise.


def with_credit_company(billing: DataFrame, star: Star, ci: bool = False) -> DataFrame:
    companies = star["dim_company"].filter(same_text(F.col("CashAccounts"), C.CREDIT_ACCOUNT, ci))
    return billing.join(companies, "Company_Key")


def with_outpatient_type(billing: DataFrame, star: Star, ci: bool = False) -> DataFrame:
    types = star["dim_patient_episode_type"].filter(
        same_text(F.col("Unified_ShortName"), C.OUTPATIENT_TYPE, ci)
    )
    return billing.join(types, "PatientEpisodeType_Key")


def with_staff(billing: DataFrame, staff: DataFrame) -> DataFrame:
    return billing.join(staff, billing["Doctor_Key"] == staff["Staff_Key"])


def with_organization(billing: DataFrame, star: Star) -> DataFrame:
    organization = star["dim_organization"]
    return billing.join(
        organization, billing["Organization_Key"] == organization["OrganizationKey"], "left"
    )


def with_notes(billing: DataFrame, star: Star) -> DataFrame:
    notes = star["dim_clinical_notes"].filter(F.col("Note").isNotNull())
    return billing.join(notes, "Episode_key")


def with_diagnosis(billing: DataFrame, star: Star) -> DataFrame:
    return billing.join(_codes(star), "Episode_key", "left")


def _codes(star: Star) -> DataFrame:
    """The codes with their key spelled as in the other tables."""
    return star["dim_diagnosis"].toDF("Episode_key", "ICDDiagnoseCode")


def sharing_a_doctors_degree(staff: DataFrame) -> DataFrame:
    """Staff whose degree is also held by someone in a doctor category."""
    degrees = staff.filter(mentions_doctor(F.col("category_desc"))).select("degree_key").distinct()
    return staff.join(degrees, "degree_key", "left_semi")


# --- de-duplication and limits --------------------------------------------------------


def keep_latest(
    df: DataFrame, keys: Sequence[str | Column], latest_first: Sequence[Column]
) -> DataFrame:
    """First row per key. The rank filter also runs before the shuffle, so a key sends at
    most one row per task however many rows it has."""
    order = Window.partitionBy(*keys).orderBy(*latest_first)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def latest_first(date: str = "Service_Date") -> list[Column]:
    """Newest service first; the organization's name decides between equal dates."""
    return [F.desc_nulls_last(date), F.asc_nulls_last("ShortName")]


def newest_first(df: DataFrame) -> list[Column]:
    """Total order of cohort rows: newest first, then every other column."""
    return [F.desc_nulls_last("FormattedDate")] + [
        F.asc_nulls_last(c) for c in C.COHORT_COLUMNS if c != "FormattedDate" and c in df.columns
    ]


ROWS_OF_ONE_TASK = 10_000


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in an order. A sort with a limit sends them all through one task, so
    beyond a few thousand the rows are numbered in range partitions instead: the same rows."""
    if n <= ROWS_OF_ONE_TASK:
        return df.orderBy(*order).limit(n)
    return with_row_id(df, order, "_place").filter(F.col("_place") < n).drop("_place")


def newest_rows(cohort: DataFrame, n: int | None) -> DataFrame:
    """The ``n`` newest rows; None or 0 keeps all, in any order."""
    return first_rows(cohort, newest_first(cohort), n) if n else cohort


def nth_newest(df: DataFrame, date: str, n: int) -> Column | None:
    """The n-th newest date as a literal of the column's type, or None if there are fewer.

    Reads and sends dates alone. The date comes to the driver as text or, where it is an
    instant, as a number: a Python date would be read in the driver's time zone.
    """
    kind = df.schema[date].dataType
    instant = isinstance(kind, T.TimestampType)
    value = F.unix_micros(F.min(date)) if instant else F.min(date).cast("string")
    newest = df.select(date).orderBy(F.desc_nulls_last(date)).limit(n)
    found = newest.agg(F.count(date).alias("dates"), value.alias("oldest")).first()
    if found["dates"] < n:
        return None
    oldest = F.lit(found["oldest"])
    return F.timestamp_micros(oldest) if instant else oldest.cast(kind)


# --- the cohort -----------------------------------------------------------------------


def billed_services(
    star: Star,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    organization_key: int | None = None,
    ci: bool = False,
) -> DataFrame:
    """Latest service per doctor name, patient and episode among the cohort's billing lines."""
    billing = star["fact_billing"].filter(in_window(F.col("Service_Date"), start, end))
    if organization_key is not None:
        billing = billing.filter(F.col("Organization_Key") == organization_key)
    billing = with_credit_company(billing, star, ci)
    billing = with_outpatient_type(billing, star, ci)
    billing = with_staff(billing, sharing_a_doctors_degree(star["dim_staff"]))
    return latest_services(billing, star, ci)


def latest_services(billing: DataFrame, star: Star, ci: bool = False) -> DataFrame:
    """Latest line per doctor name, patient and episode, with its organization's name.

    Notes and codes hang on the episode alone, so removing repeated billing lines before
    they are joined keeps the same rows as removing them afterwards. The rows sorted and
    shuffled here are a few narrow columns, without any note text.
    """
    billing = with_organization(billing, star).select(
        "Service_Date", "Staff_name", "patient_id", "Episode_key", "ShortName"
    )
    keys = [_same("Staff_name", ci), "patient_id", "Episode_key"]
    return keep_latest(billing, keys, latest_first())


def _same(text: str, ci: bool) -> Column:
    return F.collate(F.col(text), IGNORE_CASE) if ci else F.col(text)


def with_documents(services: DataFrame, star: Star, ci: bool = False) -> DataFrame:
    """Cohort rows: each service with every distinct note and code of its episode.

    Only documents of these episodes go on. Where the services are few they are broadcast:
    the notes are cut down at the scan, and equal ones collapse before their only shuffle.
    Otherwise one shuffle by episode serves the cut, the removal of equal notes and the
    join; the partition of a hot episode is split among tasks, each of which removes equal
    notes before the parts meet.
    """
    episodes = services.select("Episode_key")

    def of_these(documents: DataFrame, text: str) -> DataFrame:
        found = documents.join(episodes, "Episode_key", "left_semi")
        if not ci:
            return found.distinct()
        return keep_latest(found, ["Episode_key", _same(text, ci)], [F.asc_nulls_last(text)])

    episode_star = {
        "dim_clinical_notes": of_these(star["dim_clinical_notes"].filter("Note IS NOT NULL"), "Note"),
        "dim_diagnosis": of_these(_codes(star), "ICDDiagnoseCode"),
    }
    rows = with_diagnosis(with_notes(services, episode_star), episode_star)
    return rows.select(
        F.col("Service_Date").alias("FormattedDate"),
        F.col("Staff_name").alias("Doctor_Name"),
        F.col("patient_id").alias("Patient_Code"),
        "Episode_key",
        "Note",
        F.col("ICDDiagnoseCode").alias("ICD10_code"),
        "ShortName",
    )


def cohort(
    star: Star,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    organization_key: int | None = None,
    ci: bool = False,
    newest: int | None = None,
) -> DataFrame:
    """One row per doctor name, patient, episode, note and code, with the latest service.

    The services are written once: three joins read them, and their true size decides
    whether they are broadcast to the notes.

    ``newest`` keeps that many of the newest rows. Every service with a note gives at least
    one row, so no service older than the n-th newest of them can be among the rows: only
    the notes of the others are fetched.
    """
    services = stored(billed_services(star, start, end, organization_key, ci), "services")
    if newest:
        with_a_note = star["dim_clinical_notes"].filter("Note IS NOT NULL").select("Episode_key")
        dated = services.join(with_a_note.distinct(), "Episode_key", "left_semi")
        oldest = nth_newest(dated, "Service_Date", newest)
        if oldest is not None:
            recent = services.filter(F.col("Service_Date") >= oldest)
            services = stored(recent, "newest-services")
    return newest_rows(with_documents(services, star, ci), newest)


def recent_documents(
    documentation: DataFrame,
    as_of: dt.datetime,
    days: int = 30,
    n: int = C.MAX_ROWS,
    date: str = "Visit_Date",
) -> DataFrame:
    """Newest ``n`` rows of the last ``days`` days, counted back from the instant ``as_of``."""
    ties = [F.asc_nulls_last(c) for c in documentation.columns if c != date]
    recent = documentation.filter(in_window(F.col(date), as_of - dt.timedelta(days=days), None))
    oldest = nth_newest(recent, date, n)
    if oldest is not None:
        recent = recent.filter(F.col(date) >= oldest)
    return first_rows(recent, [F.desc_nulls_last(date), *ties], n)
