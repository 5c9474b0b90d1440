"""Column types of the six raw tables and the list of expected files."""

# Typed columns per raw table; any other column stays a string.
RAW_TYPES: dict[str, dict[str, str]] = {
    "PATIENTS": {
        "SUBJECT_ID": "int",
        "GENDER": "string",
        "DOB": "timestamp",
        "DOD": "timestamp",
    },
    "ADMISSIONS": {
        "SUBJECT_ID": "int",
        "HADM_ID": "int",
        "ADMITTIME": "timestamp",
        "DISCHTIME": "timestamp",
        "HOSPITAL_EXPIRE_FLAG": "int",
    },
    "ICUSTAYS": {
        "SUBJECT_ID": "int",
        "HADM_ID": "int",
        "ICUSTAY_ID": "int",
        "INTIME": "timestamp",
        "OUTTIME": "timestamp",
        "LOS": "double",
    },
    "CHARTEVENTS": {
        "SUBJECT_ID": "int",
        "HADM_ID": "int",
        "ICUSTAY_ID": "int",
        "ITEMID": "int",
        "CHARTTIME": "timestamp",
        "VALUENUM": "double",
        "VALUEUOM": "string",
        "ERROR": "int",
    },
    "LABEVENTS": {
        "SUBJECT_ID": "int",
        "HADM_ID": "int",
        "ITEMID": "int",
        "CHARTTIME": "timestamp",
        "VALUENUM": "double",
        "VALUEUOM": "string",
        "FLAG": "string",
    },
    "NOTEEVENTS": {
        "SUBJECT_ID": "int",
        "HADM_ID": "int",
        "CHARTTIME": "timestamp",
        "CHARTDATE": "string",
        "STORETIME": "timestamp",
        "CATEGORY": "string",
        "DESCRIPTION": "string",
        "ISERROR": "int",
        "TEXT": "string",
    },
}

# Only notes have line breaks inside a field. Reading a file that way keeps it in
# one task, so the large numeric tables are read line by line and stay splittable.
MULTI_LINE_TABLES = frozenset({"NOTEEVENTS"})

# Files the ingest looks for, and whether it needs them.
EXPECTED_FILES: dict[str, bool] = {
    "PATIENTS.csv": True,
    "ADMISSIONS.csv": True,
    "ICUSTAYS.csv": True,
    "CHARTEVENTS.csv": True,
    "LABEVENTS.csv": True,
    "NOTEEVENTS.csv": True,
    "D_ITEMS.csv": False,
    "D_LABITEMS.csv": False,
}
GATE_FILES = ("PATIENTS.csv", "ADMISSIONS.csv", "ICUSTAYS.csv")
