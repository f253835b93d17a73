"""Registered cleaning queries (B7-B19, B27) over the patient projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import clean as C
from quarry.plans.registry import query
from quarry.sources.fixtures import patients

P = ("patients",)
PATIENT_COLUMNS = ["patient_id", "height", "weight", "diagnosis_date", "surgery_date", "stage",
                   "segment", "symptoms", "family_history"]
# Code tables for this data (the 4th priority level is deliberately unknown).
STAGE_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}
YES_NO = {"Yes": 1, "No": 0}
# Token dictionary of the driver tables (p_type values), passed by the caller;
# `multi_hot_indices` numbers any dictionary it finds in the data.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("drop_nulls", "SELECT * FROM patients WHERE surgery_date IS NOT NULL AND symptoms IS NOT NULL", P)
def q_drop_nulls(spark, sf):
    return C.drop_nulls(patients(spark, sf), ["surgery_date", "symptoms"])


@query("null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count FROM patients"
    for c in PATIENT_COLUMNS), P)
def q_null_profile(spark, sf):
    return C.null_profile(patients(spark, sf))


@query("distinct_values", "SELECT DISTINCT segment FROM patients", P)
def q_distinct(spark, sf):
    return C.distinct_values(patients(spark, sf), "segment")


@query("strip_unit", """
SELECT patient_id, TRY_CAST(regexp_replace(trim(height), '\\s*cm$', '') AS DOUBLE) AS height_cm FROM patients""", P)
def q_strip_unit(spark, sf):
    return patients(spark, sf).select("patient_id", C.strip_unit(F.col("height"), "cm").alias("height_cm"))


@query("map_codes", """
SELECT patient_id,
  CASE lower(trim(stage)) WHEN '1-urgent' THEN 1 WHEN '2-high' THEN 2 WHEN '3-medium' THEN 3 WHEN '5-low' THEN 5 END AS stage_code,
  CASE lower(trim(family_history)) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS family_history_code
FROM patients""", P)
def q_map_codes(spark, sf):
    return patients(spark, sf).select(
        "patient_id",
        C.map_codes(F.col("stage"), STAGE_CODES).alias("stage_code"),
        C.map_codes(F.col("family_history"), YES_NO).alias("family_history_code"),
    )


@query("presence_flags", """
SELECT patient_id, CAST(surgery_date IS NOT NULL AS INTEGER) AS has_surgery,
       CAST(symptoms IS NOT NULL AS INTEGER) AS has_symptoms FROM patients""", P)
def q_presence(spark, sf):
    p = patients(spark, sf)
    return p.select("patient_id", C.presence_flag(F.col("surgery_date")).alias("has_surgery"),
                    C.presence_flag(F.col("symptoms")).alias("has_symptoms"))


@query("token_dictionary", """
SELECT DISTINCT trim(t) AS token FROM (SELECT unnest(string_split(symptoms, ',')) AS t FROM patients)
WHERE trim(t) <> ''""", P)
def q_token_dictionary(spark, sf):
    return C.token_dictionary(patients(spark, sf), "symptoms")


@query("multi_hot", "SELECT patient_id, " + ", ".join(
    f"CAST(coalesce(list_contains(list_transform(string_split(symptoms, ','), lambda x: trim(x)), '{t}'), false) AS INTEGER) AS symptom_{t}"
    for t in PART_TYPES) + " FROM patients", P)
def q_multi_hot(spark, sf):
    p = patients(spark, sf).select("patient_id", "symptoms")
    return C.multi_hot(p, "symptoms", PART_TYPES, "symptom_").drop("symptoms")


@query("multi_hot_indices", """
WITH t AS (SELECT DISTINCT patient_id, trim(u) AS token FROM (SELECT patient_id, unnest(string_split(symptoms, ',')) AS u FROM patients) WHERE trim(u) <> ''),
d AS (SELECT token, row_number() OVER (ORDER BY encode(token)) - 1 AS k FROM (SELECT DISTINCT token FROM t)),
g AS (SELECT patient_id, list(k ORDER BY k) AS indices FROM t JOIN d USING (token) GROUP BY 1)
SELECT p.patient_id, coalesce(array_to_string(g.indices, ','), '') AS indices FROM patients p LEFT JOIN g ON p.patient_id = g.patient_id""", P)
def q_multi_hot_indices(spark, sf):
    out = C.multi_hot_indices(patients(spark, sf).select("patient_id", "symptoms"), "symptoms")
    return out.select("patient_id", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"))


@query("token_count", """
SELECT patient_id, CAST(coalesce(len(list_filter(list_transform(string_split(symptoms, ','), lambda x: trim(x)), lambda x: x <> '')), 0) AS INTEGER) AS n_symptoms
FROM patients""", P)
def q_token_count(spark, sf):
    return patients(spark, sf).select("patient_id", C.token_count(F.col("symptoms")).alias("n_symptoms"))


@query("date_gaps", """
SELECT patient_id, CAST(date_diff('day', diagnosis_date, surgery_date) AS INTEGER) AS gap_days,
       CAST(floor(date_diff('day', diagnosis_date, surgery_date) / 365) AS INTEGER) AS gap_years
FROM patients""", P)
def q_date_gaps(spark, sf):
    p = patients(spark, sf)
    days = C.days_between(F.col("surgery_date"), F.col("diagnosis_date"))
    return p.select("patient_id", days.alias("gap_days"), C.whole_years(days).alias("gap_years"))


@query("bmi_like", """
SELECT patient_id, weight / pow(TRY_CAST(regexp_replace(height, 'cm$', '') AS DOUBLE) / 100, 2) AS bmi FROM patients""", P)
def q_bmi(spark, sf):
    p = patients(spark, sf)
    return p.select("patient_id", C.ratio_feature(F.col("weight"), C.strip_unit(F.col("height"), "cm")).alias("bmi"))


@query("minmax_scale", """
SELECT patient_id, weight,
  (weight - min(weight) OVER ()) / (max(weight) OVER () - min(weight) OVER ()) * 1.0 + 0.0 AS weight_scaled
FROM patients""", P)
def q_minmax(spark, sf):
    return C.minmax_scale(patients(spark, sf).select("patient_id", "weight"), "weight")
