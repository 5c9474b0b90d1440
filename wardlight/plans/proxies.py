"""The test tables seen as clinical tables.

The driver's tables are not clinical. Each view renames and derives columns of one
or two whole tables, so that every operator runs on data that grows with them;
``plans.oracle`` spells out the same views in SQL.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators.metrics import request_cost
from wardlight.session import shared_dir
from wardlight.sources.tables import write_table

DAY0 = "timestamp_ntz'2024-01-01 00:00:00'"

# Line starts that occur in the test documents, in place of clinical headers.
LINE_HEADERS = ("The", "And", "Of")

# event_type and parity of k -> item code; any other combination has no known code.
ITEM_OF = {
    "view_0": 220052,
    "view_1": 456,
    "click_0": 198,
    "click_1": 646,
    "purchase_0": 50912,
    "purchase_1": 50885,
    "signup_0": 51265,
    "signup_1": 50821,
    "error_0": 50816,
}
MODELS = ("claude-opus-4-6", "claude-sonnet-4-6", "gpt-4o", "gpt-4o-mini", "other-model")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, as one job leaves a table for the next."""
    path = shared_dir(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def k_of(props: str = "props") -> Column:
    """The number in ``{"k": n}``, without parsing the JSON."""
    return F.translate(props, '{"k: }', "").try_cast("int")


def as_chart(events: DataFrame) -> DataFrame:
    """Chart and lab events; works on a batch or a stream of events."""
    stay = F.expr("user_id div 15")
    raw, k = F.col("value"), F.col("k")

    def num(x: float) -> Column:
        return F.lit(float(x))

    # Values scaled to clinical ranges, for even and odd k.
    scaled = {
        "view": (num(60) + raw / num(2), num(60) + raw / num(2)),
        "click": (num(15) - F.floor(raw / num(25)).cast("double"), num(100) - raw / num(20)),
        "purchase": (raw / num(30), raw / num(20)),
        "signup": (num(20) + raw * num(4), num(60) + raw),
        "error": (num(21) + k * num(0.3), raw),
    }
    item, value = F, F
    for kind, (even, odd) in scaled.items():
        hit = F.col("event_type") == kind
        codes = [F.lit(ITEM_OF.get(f"{kind}_{parity}", 0)) for parity in (0, 1)]
        item = item.when(hit, F.when(k % 2 == 0, codes[0]).otherwise(codes[1]))
        value = value.when(hit, F.when(k % 2 == 0, even).otherwise(odd))
    item, value = item.otherwise(0), value.otherwise(raw)
    return events.withColumn("k", k_of()).select(
        stay.alias("SUBJECT_ID"),
        stay.alias("HADM_ID"),
        stay.alias("ICUSTAY_ID"),
        "event_id",
        item.alias("ITEMID"),
        F.col("ts").alias("CHARTTIME"),
        value.alias("VALUENUM"),
        F.when(k % 3 == 0, F.lit("kPa")).when(k % 3 == 1, F.lit("umol/L")).alias("VALUEUOM"),
        F.when(k == 7, 1).when(k >= 50, 0).alias("ERROR"),
        F.when(k % 10 == 0, "abnormal").when(k % 10 == 1, "delta").when(k % 10 == 2, "normal").alias("FLAG"),
    )


def chart(spark: SparkSession, sf: str) -> DataFrame:
    return as_chart(table(spark, sf, "events"))


def icu_stays(spark: SparkSession, sf: str) -> DataFrame:
    """First to last event of every stay."""
    return (
        table(spark, sf, "events")
        .groupBy(F.expr("user_id div 15").alias("ICUSTAY_ID"))
        .agg(F.min("ts").alias("INTIME"), F.max("ts").alias("OUTTIME"))
        .select("ICUSTAY_ID", F.col("ICUSTAY_ID").alias("HADM_ID"), "INTIME", "OUTTIME")
    )


def patients(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    born = F.expr("timestamp_ntz'1890-01-01 00:00:00'") + days(c * 7919 % 36500)
    return table(spark, sf, "customer").select(
        c.alias("SUBJECT_ID"),
        F.when(c % 2 == 0, "F").otherwise("M").alias("GENDER"),
        born.alias("DOB"),
        F.when(c % 5 == 0, born + days(F.lit(30000))).alias("DOD"),
    )


def admissions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("HADM_ID"),
        F.col("o_orderdate").alias("ADMITTIME"),
        (F.col("o_orderdate") + days(F.lit(5))).alias("DISCHTIME"),
        (F.col("o_orderkey") % 2).alias("HOSPITAL_EXPIRE_FLAG"),
        F.col("o_orderpriority").alias("DIAGNOSIS"),
        F.col("o_orderstatus").alias("INSURANCE"),
        F.concat(F.lit("E"), (F.col("o_custkey") % 5).cast("string")).alias("ETHNICITY"),
    )


def line_stays(spark: SparkSession, sf: str) -> DataFrame:
    """A stay per order line; line 6 has no subject, line 7 an unknown admission."""
    subjects = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem")
    return lines.join(subjects, lines.l_orderkey == subjects.o_orderkey).select(
        F.when(F.col("l_linenumber") != 6, F.col("o_custkey")).alias("SUBJECT_ID"),
        F.when(F.col("l_linenumber") == 7, F.col("l_orderkey") + 1_000_000_000)
        .otherwise(F.col("l_orderkey"))
        .alias("HADM_ID"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("ICUSTAY_ID"),
        F.col("l_shipdate").alias("INTIME"),
        (F.col("l_shipdate") + hours(F.col("l_quantity"))).alias("OUTTIME"),
        (F.col("l_quantity") / F.lit(24.0)).alias("LOS"),
    )


def as_notes(documents: DataFrame) -> DataFrame:
    """Notes with versions, error flags and missing store times; batch or stream."""
    d = F.col("doc_id")
    at = F.expr(DAY0) + days(d % 7)
    return documents.select(
        d.alias("note_id"),
        F.col("source").alias("SUBJECT_ID"),
        (d % 20).alias("HADM_ID"),
        F.col("lang").alias("CATEGORY"),
        at.alias("CHARTTIME"),
        F.when(d % 11 != 0, at + hours(d * 13 % 97)).alias("STORETIME"),
        F.when(d % 17 == 0, 1).alias("ISERROR"),
        F.col("text").alias("TEXT"),
    )


def notes(spark: SparkSession, sf: str) -> DataFrame:
    return as_notes(table(spark, sf, "documents"))


def queue(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("note_id")
    return notes(spark, sf).select(
        d.alias("queue_id"),
        "HADM_ID",
        F.when(d % 13 != 0, F.col("CHARTTIME")).alias("charttime"),
        F.col("TEXT").alias("note_text"),
        F.when(d % 3 != 0, F.col("CHARTTIME")).alias("embedded_at"),
    )


def done_notes(spark: SparkSession, sf: str) -> DataFrame:
    """What an earlier embedding run recorded: English notes are new, German ones changed."""
    before = F.when(F.col("CATEGORY") == "de", F.concat("TEXT", F.lit("*"))).otherwise(F.col("TEXT"))
    return (
        notes(spark, sf)
        .filter(F.col("CATEGORY") != "en")
        .select("note_id", F.sha2(before, 256).alias("content_hash"))
    )


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """A stored chunk per vector, with the text of the document of the same number."""
    vectors, docs = table(spark, sf, "embeddings"), table(spark, sf, "documents")
    return vectors.join(docs.select("doc_id", "text", "lang"), vectors.vec_id == docs.doc_id, "left").select(
        F.col("vec_id").alias("note_id"),
        F.lit(0).alias("chunk_index"),
        F.col("label").cast("bigint").alias("ICUSTAY_ID"),
        F.col("lang").alias("note_category"),
        F.coalesce("text", F.concat(F.lit("chunk "), F.col("vec_id").cast("string"))).alias("chunk_text"),
        "embedding",
    )


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """A question per label: its vector is the mean vector of the label. Some top_k are NULL or large."""
    q = F.col("label").cast("bigint")
    return (
        table(spark, sf, "embeddings")
        .groupBy("label")
        .agg(Summarizer.mean(array_to_vector("embedding")).alias("m"))
        .select(
            q.alias("question_id"),
            F.concat(F.lit("Which stays are like group "), q.cast("string"), F.lit("?")).alias("question"),
            vector_to_array("m").alias("embedding"),
            F.when(q % 3 == 1, F.array(F.lit("high"), F.lit("critical")))
            .when(q % 3 == 2, F.array(F.lit("moderate")))
            .alias("tiers"),
            F.when(q % 5 != 0, F.when(q % 7 == 3, 40).otherwise(q + 3)).cast("int").alias("top_k"),
        )
    )


def mean_vector(spark: SparkSession, sf: str) -> Column:
    """Mean of all vectors as a scalar subquery: one question from the whole table."""
    mean = table(spark, sf, "embeddings").agg(Summarizer.mean(array_to_vector("embedding")).alias("m"))
    return mean.select(vector_to_array("m").alias("m")).scalar()


def as_metrics(events: DataFrame) -> DataFrame:
    """A row per answered question; works on a batch or a stream of events."""
    k = F.col("k")
    rows = events.withColumn("k", k_of()).select(
        F.col("event_id").alias("query_id"),
        F.col("event_type").alias("provider"),
        F.element_at(F.array(*map(F.lit, MODELS)), k % 5 + 1).alias("model"),
        (F.col("value") * F.lit(100.0)).alias("latency_ms"),
        (k + 100).cast("bigint").alias("tokens_in"),
        (k + 10).cast("bigint").alias("tokens_out"),
        F.col("ts").alias("queried_at"),
    )
    return rows.withColumns(
        {
            "tokens_used": F.col("tokens_in") + F.col("tokens_out"),
            "estimated_cost_usd": request_cost(F.col("model"), F.col("tokens_in"), F.col("tokens_out")),
        }
    )


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    return as_metrics(table(spark, sf, "events"))


def last_event(spark: SparkSession, sf: str) -> Column:
    return table(spark, sf, "events").agg(F.max("ts").alias("m")).scalar()
