import datetime as dt
import random
import time

import pytest
from support import plan_of
from pyspark.sql import functions as F

from noteloom.operators import cohort
from noteloom.plans.queries import END, START
from noteloom.schemas import COHORT, STAR_TABLES
from noteloom.sources import tables


def star_of(spark, **rows):
    return {
        name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in STAR_TABLES.items()
    }


def day(n, hour=0):
    return dt.datetime(2024, 5, n, hour)


DIMENSIONS = {
    "dim_company": [(1, "Credit"), (2, "Cash"), (3, "credit  ")],
    "dim_patient_episode_type": [(1, "OPD"), (2, "IPD")],
    "dim_organization": [(1, "Main"), (2, "Annex")],
    "dim_staff": [
        (1, "Dr A", 10, "Senior Doctor"),
        (2, "Nurse B", 10, "Nurse"),
        (3, "Clerk C", 30, "Clerk"),
        (4, "No degree", None, "Doctor"),
        (5, "Dr A", 10, "DOCTOR"),
    ],
}


@pytest.fixture
def riyadh(monkeypatch):
    """The driver's own time zone, apart from the session's."""
    monkeypatch.setenv("TZ", "Asia/Riyadh")
    time.tzset()
    yield
    monkeypatch.undo()
    time.tzset()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_top_n_of_any_kind_of_date_in_any_time_zone(spark, riyadh, kind):
    dates = spark.range(10).selectExpr("id", f"CAST(CAST(date_add(DATE '2024-05-01', CAST(id AS INT)) AS TIMESTAMP) AS {kind}) AS Visit_Date")
    rows = cohort.recent_documents(dates, dt.datetime(2024, 5, 20), n=5).collect()
    assert [r.id for r in rows] == [9, 8, 7, 6, 5]


def test_many_newest_rows_are_the_same_rows(spark, small, monkeypatch):
    found = lambda: sorted(map(str, cohort.cohort(small.star(), START, END, newest=17).collect()))
    few = found()
    monkeypatch.setattr(cohort, "ROWS_OF_ONE_TASK", 5)
    assert found() == few and len(few) == 17
    rows = cohort.newest_rows(cohort.cohort(small.star(), START, END), 17)
    assert "TakeOrdered" not in plan_of(rows) and "GlobalLimit" not in plan_of(rows)


def test_newest_of_a_star_with_instants(spark, riyadh):
    billing = [(day(n, 1), 7, 100 + n, 1, 1, 1, 1) for n in range(1, 11)]
    notes = [(100 + n, f"note {n}") for n in range(1, 11)]
    star = star_of(spark, fact_billing=billing, dim_clinical_notes=notes, **DIMENSIONS)
    ntz = F.col("Service_Date").cast("string").cast("timestamp")
    star["fact_billing"] = star["fact_billing"].withColumn("Service_Date", ntz)
    assert cohort.cohort(star, newest=5).count() == 5


def test_columns_and_types_of_a_warehouse(spark):
    own = spark.createDataFrame([("3", "OPD")], "PatientEpisodeType_Key string, `Unified ShortName` string")
    found = tables.as_star_table(own, "dim_patient_episode_type")
    assert found.schema == STAR_TABLES["dim_patient_episode_type"] and found.first()[:] == (3, "OPD")
    other = own.withColumnsRenamed({"Unified ShortName": "kind", "PatientEpisodeType_Key": "id"})
    names = {"dim_patient_episode_type": {"Unified_ShortName": "kind", "PatientEpisodeType_Key": "id"}}
    assert tables.as_star_table(other, "dim_patient_episode_type", names).first()[:] == (3, "OPD")


def cohort_rows(spark, billing, notes, codes=(), **options):
    star = star_of(
        spark, fact_billing=billing, dim_clinical_notes=notes, dim_diagnosis=codes, **DIMENSIONS
    )
    return sorted(map(tuple, cohort.cohort(star, **options).collect()), key=repr)


def test_schema(small):
    found = cohort.cohort(small.star(), START, END)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in COHORT]


def test_who_is_in(spark):
    billing = [
        (day(1), 7, 100, 1, 1, 1, 1),  # doctor
        (day(1), 7, 101, 1, 2, 1, 1),  # shares a doctor's degree
        (day(1), 7, 102, 1, 3, 1, 1),  # degree no doctor has
        (day(1), 7, 103, 1, 4, 1, 1),  # doctor without a degree
        (day(1), 7, 104, 2, 1, 1, 1),  # cash
        (day(1), 7, 105, 1, 1, 2, 1),  # inpatient
        (day(1), 7, 106, 1, 1, 1, 9),  # unknown organization
        (day(1), 7, 107, 1, 9, 1, 1),  # unknown doctor
        (day(1), 7, 108, 1, 1, 1, 1),  # only a null note
    ]
    notes = [(e, "n") for e in range(100, 108)] + [(108, None), (100, "")]
    found = cohort_rows(spark, billing, notes, [(100, "J45"), (100, "K21")])
    assert {(r[3], r[4], r[5], r[6]) for r in found} == {
        (100, "n", "J45", "Main"), (100, "n", "K21", "Main"),
        (100, "", "J45", "Main"), (100, "", "K21", "Main"),
        (101, "n", None, "Main"), (106, "n", None, None),
    }
    assert len(found) == 6


def test_latest_wins_and_names_merge(spark):
    billing = [
        (day(1), 7, 100, 1, 1, 1, 1),
        (day(2, 8), 7, 100, 1, 5, 1, 1),  # another doctor of the same name
        (day(2, 8), 7, 100, 1, 1, 1, 2),  # same instant: the organization's name decides
        (day(2, 8), 7, 100, 1, 1, 1, 9),  # no name comes last
    ]
    [row] = cohort_rows(spark, billing, [(100, "n"), (100, "n")])
    assert (row[0], row[1], row[6]) == (day(2, 8), "Dr A", "Annex")


def test_window_organization_and_case(spark):
    billing = [
        (day(1, 23), 1, 100, 1, 1, 1, 1),
        (day(2), 2, 100, 1, 1, 1, 1),
        (day(2, 23), 3, 100, 3, 1, 1, 2),
        (day(3), 4, 100, 1, 1, 1, 1),
        (None, 5, 100, 1, 1, 1, 1),
    ]
    notes = [(100, "n")]
    start, end = cohort.day_before(dt.date(2024, 5, 3))

    def patients(**options):
        return [r[2] for r in cohort_rows(spark, billing, notes, **options)]

    assert sorted(patients()) == [1, 2, 4, 5]
    assert patients(start=start, end=end) == [2]
    assert sorted(patients(start=start, end=end, ci=True)) == [2, 3]
    assert patients(start=start, end=end, ci=True, organization_key=2) == [3]


def test_names_notes_and_codes_merge_without_regard_to_case(spark):
    star = star_of(
        spark,
        fact_billing=[(day(1), 7, 100, 1, 1, 1, 1), (day(2), 7, 100, 1, 2, 1, 1)],
        dim_clinical_notes=[(100, "Note"), (100, "NOTE  "), (100, "other")],
        dim_diagnosis=[(100, "J45"), (100, "j45"), (100, None)],
        **{**DIMENSIONS, "dim_staff": [(1, "Dr A", 10, "Doctor"), (2, "DR A", 10, "Nurse")]},
    )
    assert cohort.cohort(star).count() == 2 * 3 * 3
    found = cohort.cohort(star, ci=True).collect()
    assert {r.FormattedDate for r in found} == {day(2)}
    assert sorted((r.Note, r.ICD10_code or "") for r in found) == [
        ("NOTE  ", ""), ("NOTE  ", "J45"), ("other", ""), ("other", "J45")]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 50])
def test_newest_rows_fetch_only_what_can_count(spark, n):
    """Episodes without notes, ties in time and dates that are null."""
    billing = [(day(1 + i % 3), i, 100 + i, 1, 1, 1, 1) for i in range(6)]
    billing += [(None, 90, 100, 1, 1, 1, 1), (day(9), 91, 999, 1, 1, 1, 1)]
    notes = [(100 + i, t) for i in range(5) for t in ("a", "b")] + [(105, None)]
    star = star_of(spark, fact_billing=billing, dim_clinical_notes=notes, **DIMENSIONS)
    everything = cohort.cohort(star)
    expected = cohort.newest_rows(everything, n).collect()
    assert cohort.cohort(star, newest=n).collect() == expected
    assert len(expected) == min(n, everything.count()) and everything.count() == 12


def test_equals_the_late_deduplication(spark):
    """Removing repeated billing lines early gives what the window over the fan-out gives."""
    rng = random.Random(3)
    billing = [
        (day(rng.randint(1, 4)), rng.randint(1, 3), rng.randint(100, 105), 1, rng.choice([1, 2, 5]), 1, rng.choice([1, 2, 9]))
        for _ in range(300)
    ]
    notes = [(rng.randint(100, 106), rng.choice(["a", "b", "", None])) for _ in range(30)]
    codes = [(rng.randint(100, 104), rng.choice(["J45", "K21", None])) for _ in range(12)]
    star = star_of(
        spark, fact_billing=billing, dim_clinical_notes=notes, dim_diagnosis=codes, **DIMENSIONS
    )
    joined = cohort.with_organization(
        cohort.with_staff(star["fact_billing"], cohort.sharing_a_doctors_degree(star["dim_staff"])), star
    )
    joined = cohort.with_diagnosis(cohort.with_notes(joined, star), star)
    keys = ["Staff_name", "patient_id", "Episode_key", "Note", "ICDDiagnoseCode"]
    late = cohort.keep_latest(joined, keys, cohort.latest_first()).select(
        "Service_Date", *keys, "ShortName"
    )
    early = cohort.cohort(star)
    assert sorted(map(tuple, late.collect()), key=repr) == sorted(map(tuple, early.collect()), key=repr)


@pytest.fixture
def small_partitions(spark):
    """No broadcasts, and partitions small enough for the test's rows to count as skewed."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_notes(spark):
    """30,000 notes, a third of them on episode 1, half of those copies of one note."""
    own = F.concat(F.lit("note "), F.sha2(F.col("id").cast("string"), 512))
    return spark.range(0, 30000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("Episode_key"),
        F.when(F.col("id") % 6 == 0, F.repeat(F.lit("same note "), 14)).otherwise(own).alias("Note"),
    )


def test_a_hot_episode_is_split(spark, small_partitions):
    billing = spark.range(0, 3000).select(F.col("id").alias("Episode_key"), F.lit(1).alias("x"))
    joined = cohort.with_notes(billing, {"dim_clinical_notes": hot_notes(spark)})
    joined.collect()
    assert "skewed" in plan_of(joined) and "skew=true" in plan_of(joined)
    assert joined.count() == 10000 + sum(1 for i in range(3000) if i % 3)


def test_a_hot_episode_is_split_in_the_cohort(spark, small_partitions):
    services = spark.range(0, 3000).select(
        F.lit(day(1)).cast("timestamp_ntz").alias("Service_Date"),
        F.lit("Dr A").alias("Staff_name"),
        F.col("id").alias("patient_id"),
        F.col("id").alias("Episode_key"),
        F.lit("Main").alias("ShortName"),
    )
    codes = spark.createDataFrame([(1, "J45"), (1, "J45"), (1, "K21")], STAR_TABLES["dim_diagnosis"])
    star = {"dim_clinical_notes": hot_notes(spark), "dim_diagnosis": codes}
    rows = cohort.with_documents(services, star)
    found = rows.collect()
    assert "skew=true" in plan_of(rows)
    hot = [r for r in found if r.Episode_key == 1]
    # 5,000 notes of its own and the one that 5,000 copies share, plus note 1 itself
    assert len(hot) == 2 * (5000 + 1 + 1)
    assert len(found) - len(hot) == sum(1 for i in range(3000) if i % 3) - 1


def test_rank_filter_runs_before_the_shuffle(small):
    plan = plan_of(cohort.billed_services(small.star(), START, END))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "LeftSemi" in plan


def test_window_reaches_the_scan(small):
    plan = plan_of(cohort.billed_services(small.star(), *cohort.day_before(dt.date(1996, 4, 29))))
    assert "GreaterThanOrEqual(l_shipdate,1996-04-28" in plan
    assert "LessThan(l_shipdate,1996-04-29" in plan
    assert "l_extendedprice" not in plan


def test_top_n_does_not_sort_everything(small):
    found = cohort.cohort(small.star(), START, END, newest=10)
    assert "TakeOrderedAndProject" in plan_of(found)
    assert "newest-services" in plan_of(found)


def test_no_cap_keeps_all(small):
    rows = cohort.cohort(small.star(), START, END)
    for cap in (None, 0):
        assert cohort.newest_rows(rows, cap).count() == 45
    assert cohort.newest_rows(rows, 7).count() == 7


def test_recent_documents_counts_from_the_instant(spark):
    df = spark.createDataFrame(
        [(1, "a", dt.datetime(2024, 5, 1, 11)), (2, "b", dt.datetime(2024, 5, 1, 12)), (3, "c", dt.datetime(2024, 6, 1))],
        "Patient_ID int, Clinical_Notes string, Visit_Date timestamp_ntz",
    )
    as_of = dt.datetime(2024, 5, 31, 12)
    assert [r.Patient_ID for r in cohort.recent_documents(df, as_of).collect()] == [3, 2]
    assert [r.Patient_ID for r in cohort.recent_documents(df, as_of, n=1).collect()] == [3]


def test_sources_read_the_same_star(spark, small, tmp_path):
    """Files and catalog tables, one of them under another name."""
    spark.sql(f"CREATE DATABASE star_copy LOCATION '{tmp_path}/catalog'")
    for name, df in small.star().items():
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in STAR_TABLES[name]])
        typed.write.parquet(f"{tmp_path}/{name}.parquet")
        table = "billing_lines" if name == "fact_billing" else name
        spark.sql(f"CREATE TABLE star_copy.{table} USING parquet LOCATION '{tmp_path}/{name}.parquet'")
    try:
        for star in (
            tables.star_from_parquet(spark, str(tmp_path)),
            tables.star_from_catalog(spark, "star_copy", {"fact_billing": "billing_lines"}),
        ):
            assert cohort.cohort(star, START, END).count() == 45
    finally:
        spark.sql("DROP DATABASE star_copy CASCADE")


def test_query_file(spark, small, tmp_path):
    path = tmp_path / "query.sql"
    path.write_text("\n SELECT count(*) AS n FROM {billing} WHERE Service_Date >= :start  \n", encoding="utf-8")
    found = tables.run_query_file(
        spark, str(path), {"billing": small["fact_billing"]}, {"start": dt.datetime(1999, 1, 1)}
    )
    assert found.first().n == small["fact_billing"].filter("Service_Date >= '1999-01-01'").count()
    with pytest.raises(FileNotFoundError):
        tables.read_query(str(tmp_path / "absent.sql"))
