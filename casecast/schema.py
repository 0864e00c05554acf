"""The case table: column names of the source file, their types, and the working names used after the scan."""

from pyspark.sql import types as T

# The nine source columns, their types, and the name each one carries after `confirmed_cases`.
CASE_COLUMNS = {
    "sexo": (T.StringType(), "sex"),
    "edad": (T.IntegerType(), "age"),
    "fecha_inicio_sintomas": (T.DateType(), "symptom_date"),
    "fecha_internacion": (T.DateType(), "admission_date"),
    "cuidado_intensivo": (T.StringType(), "icu_raw"),
    "asistencia_respiratoria_mecanica": (T.StringType(), "ventilator_raw"),
    "clasificacion": (T.StringType(), "classification"),
    "fecha_diagnostico": (T.DateType(), "diagnosis_date"),
    "clasificacion_resumen": (T.StringType(), "classification_summary"),
}

# The cell contents the rules test for.
CONFIRMED = "Confirmado"
DIED = "Fallecido"
YES = "SI"
MALE = "M"

KEY = "case_id"
LABEL = "label"
WEIGHT = "weight"

CASE_SCHEMA = T.StructType([T.StructField(name, dtype) for name, (dtype, _) in CASE_COLUMNS.items()])

WORKING_NAMES = {name: working for name, (_, working) in CASE_COLUMNS.items()}

BASE_FEATURES = ["male", "age", "icu", "ventilator", "days_to_admission"]

FEATURE_SETS = {
    "base": BASE_FEATURES,
    "with_diagnosis": [*BASE_FEATURES, "days_to_diagnosis"],
}
