"""CSV ingest, audit, table writes, and the batch jobs end to end."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlight import session
from wardlight.functions.casts import lenient
from wardlight.operators import scoring
from wardlight.plans import jobs
from wardlight.sources.audit import require_files, source_audit
from wardlight.sources.raw import ingest
from wardlight.sources.tables import read_table, write_table

T0 = dt.datetime(2150, 3, 1, 10, 30)


def ts(hours):
    return (T0 + dt.timedelta(hours=hours)).strftime("%Y-%m-%d %H:%M:%S")


def raw_files(folder):
    files = {
        "PATIENTS": ["ROW_ID,SUBJECT_ID,GENDER,DOB,DOD", '1,1,"F",2090-01-01 00:00:00,', "2,2,M,1850-01-01 00:00:00,"],
        "ADMISSIONS": [
            "SUBJECT_ID,HADM_ID,ADMITTIME,DISCHTIME,HOSPITAL_EXPIRE_FLAG,DIAGNOSIS,INSURANCE,ETHNICITY",
            f'1,10,{ts(-2)},{ts(60)},0,"SEPSIS, SEVERE",Medicare,X',
            f"2,11,{ts(-2)},,1,OTHER,Private,Y",
        ],
        "ICUSTAYS": [
            "SUBJECT_ID,HADM_ID,ICUSTAY_ID,INTIME,OUTTIME,LOS",
            f"1,10,100,{ts(0)},{ts(30)},1.25",
            f"2,11,101,{ts(0)},{ts(10)},0.4",
        ],
        "CHARTEVENTS": [
            "SUBJECT_ID,HADM_ID,ICUSTAY_ID,ITEMID,CHARTTIME,VALUENUM,VALUEUOM,ERROR",
            *[f"1,10,100.0,52,{ts(h)},{75 + h},mmHg,0" for h in range(30)],
            f"1,10,100,52,{ts(3)},1,mmHg,1",
            f"1,10,100,198,{ts(2)},15,,",
            f"1,10,100,52,{ts(4)},n/a,mmHg,0",
        ],
        "LABEVENTS": [
            "SUBJECT_ID,HADM_ID,ITEMID,CHARTTIME,VALUENUM,VALUEUOM,FLAG",
            *[f"1,10,{item},{ts(5)},{v},u,{f}" for item, v, f in
              [(50912, 1.0, ""), (50885, 1.3, "abnormal"), (51265, 160, ""), (50821, 90, ""), (50816, 21, "delta")]],
        ],
        "NOTEEVENTS": [
            "ROW_ID,SUBJECT_ID,HADM_ID,CHARTDATE,CHARTTIME,STORETIME,CATEGORY,DESCRIPTION,ISERROR,TEXT",
            f'1,1,10,2150-03-01,{ts(1)},{ts(2)},Nursing,Report,,"Plan: first ""line"", then\nsecond line\n{"more words " * 8}"',
            f'2,1,10,2150-03-01,{ts(1)},{ts(3)},Nursing,Report,,"Plan: newer version\n{"more words " * 8}"',
        ],
    }
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


def test_lenient_casts(spark):
    df = spark.createDataFrame([("1.0",), ("7",), ("x",), (None,), ("1e2",)], "v string")
    assert [r.i for r in df.select(lenient(F.col("v"), "int").alias("i")).collect()] == [1, 7, None, None, 100]
    assert [r.d for r in df.select(lenient(F.col("v"), "double").alias("d")).collect()] == [1.0, 7.0, None, None, 100.0]


def test_ingest_types_and_provenance(spark, tmp_path):
    raw_files(tmp_path)
    df = ingest(spark, str(tmp_path / "CHARTEVENTS.csv"), "CHARTEVENTS")
    types = dict(df.dtypes)
    assert (types["ICUSTAY_ID"], types["CHARTTIME"], types["VALUENUM"], types["ERROR"]) == ("int", "timestamp", "double", "int")
    assert df.filter("ICUSTAY_ID = 100").count() == 33 and df.filter("VALUENUM IS NULL").count() == 1
    row = df.first()
    assert row._source_file.endswith("CHARTEVENTS.csv") and row._ingested_at is not None


def test_lower_case_headers_are_cast_too(spark, tmp_path):
    (tmp_path / "icustays.csv").write_text("subject_id,icustay_id,extra\n1,2.0,z\n")
    df = ingest(spark, str(tmp_path / "icustays.csv"), "icustays")
    assert dict(df.dtypes)["ICUSTAY_ID"] == "int" and df.first().EXTRA == "z"


def test_notes_keep_line_breaks_and_quotes(spark, tmp_path):
    raw_files(tmp_path)
    notes = ingest(spark, str(tmp_path / "NOTEEVENTS.csv"), "NOTEEVENTS").orderBy("ROW_ID").collect()
    assert len(notes) == 2 and notes[0].TEXT.startswith('Plan: first "line", then\nsecond line\n')


def test_audit(spark, tmp_path):
    raw_files(tmp_path)
    audit = {r.file_name: r for r in source_audit(spark, str(tmp_path)).collect()}
    assert len(audit) == 8
    assert audit["PATIENTS.csv"].present and audit["PATIENTS.csv"].size_bytes == (tmp_path / "PATIENTS.csv").stat().st_size
    assert not audit["D_ITEMS.csv"].present and audit["D_ITEMS.csv"].size_bytes is None
    require_files(source_audit(spark, str(tmp_path)))
    (tmp_path / "LABEVENTS.csv").unlink()
    require_files(source_audit(spark, str(tmp_path)), ["PATIENTS.csv"])
    with pytest.raises(FileNotFoundError, match="LABEVENTS.csv"):
        require_files(source_audit(spark, str(tmp_path)))


def test_audit_of_folders_of_part_files(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = source_audit(spark, str(tmp_path), {"events.parquet": True, "other.parquet": False}).collect()
    assert {r.file_name: r.present for r in got} == {"events.parquet": True, "other.parquet": False}


def test_write_counts_rows_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(7), path) == 7
    assert write_table(spark.range(3).withColumn("new", F.lit(1)), path) == 3
    assert read_table(spark, path).columns == ["id", "new"]


def test_partition_refresh_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    write_table(spark.range(6).withColumn("part", F.col("id") % 2), path, ("part",))
    write_table(spark.range(1).select(F.lit(99).alias("id"), F.lit(1).alias("part")), path, ("part",))
    assert sorted(r.id for r in read_table(spark, path).collect()) == [0, 2, 4, 99]


def test_jobs_end_to_end(spark, tmp_path):
    raw, bronze, silver, gold = (str(tmp_path / d) for d in ("raw", "bronze", "silver", "gold"))
    (tmp_path / "raw").mkdir()
    raw_files(tmp_path / "raw")
    assert jobs.ingest_all(spark, raw, bronze) == {
        "PATIENTS": 2, "ADMISSIONS": 2, "ICUSTAYS": 2, "CHARTEVENTS": 33, "LABEVENTS": 5, "NOTEEVENTS": 2,
    }
    assert jobs.clean_all(spark, bronze, silver) == {
        "patient_stays": 2, "vitals_hourly": 31, "labs_per_stay": 5, "clinical_notes": 1,
    }
    stays = {r.ICUSTAY_ID: r for r in read_table(spark, f"{silver}/patient_stays").collect()}
    assert stays[101].age_at_admission == 90.0 and stays[100].DIAGNOSIS == "SEPSIS, SEVERE"
    assert jobs.score_all(spark, silver, gold) == 7
    scores = read_table(spark, f"{gold}/sofa_scores").orderBy("score_window_end").collect()
    first, last = scores[0], scores[-1]
    # The hour bucket 10:00 of the first values lies before INTIME 10:30.
    assert first.map == 76.0 and first.gcs == 15.0 and first.pao2_fio2 == pytest.approx(90 / 0.21)
    assert (first.sofa_resp, first.sofa_coag, first.sofa_liver, first.sofa_cardio, first.sofa_cns, first.sofa_renal) == (0, 0, 1, 0, 0, 0)
    assert (first.sofa_total, first.risk_tier, first.sepsis_alert) == (1, "low", 0)
    assert last.gcs is None and last.platelet is None and last.sofa_total == 21 - 1

    frame = read_table(spark, f"{gold}/sofa_scores")
    empty = scoring.latest_alerts(frame).withColumns({"created_at": F.lit(T0), "updated_at": F.lit(T0)}).limit(0)
    one = jobs.refresh_alerts(empty, frame, F.lit(T0))
    later = T0 + dt.timedelta(hours=1)
    two = jobs.refresh_alerts(one, frame, F.lit(later)).collect()
    assert [(r.ICUSTAY_ID, r.created_at, r.updated_at) for r in two] == [(100, T0, later)]


def test_new_notes_job(spark):
    notes = spark.createDataFrame([(1, "Plan: rest"), (2, " ")], "note_id int, TEXT string")
    from wardlight.operators.embedding import backfill, embed_hashed

    hashed = lambda df: embed_hashed(df, dim=8)
    stored, done = backfill(notes.limit(0), ["note_id"], hashed)
    stored, done = jobs.embed_new_notes(notes, stored, done, ["note_id"], hashed)
    assert [(r.note_id, r.chunk_text) for r in stored.collect()] == [(1, "Plan: rest")] and done.count() == 2
    edited = spark.createDataFrame([(1, "Plan: go"), (2, " ")], "note_id int, TEXT string")
    stored, done = jobs.embed_new_notes(edited, stored, done, ["note_id"], hashed)
    assert [r.chunk_text for r in stored.collect()] == ["Plan: go"] and done.count() == 2


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert a != b and a.startswith(root)
