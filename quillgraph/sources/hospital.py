"""Declared schemas of the hospital tables. Codes are strings, so that leading zeros stay.

Fixed values: the column names are those of the public data set the tables come from.
"""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    "patients": (
        "row_id int, subject_id int, gender string, dob timestamp, dod timestamp, dod_hosp timestamp, "
        "dod_ssn timestamp, expire_flag int"
    ),
    "admissions": (
        "row_id int, subject_id int, hadm_id int, admittime timestamp, dischtime timestamp, deathtime timestamp, "
        "admission_type string, admission_location string, discharge_location string, insurance string, "
        "language string, religion string, marital_status string, ethnicity string, edregtime timestamp, "
        "edouttime timestamp, diagnosis string, hospital_expire_flag int, has_chartevents_data int"
    ),
    "diagnoses_icd": "row_id int, subject_id int, hadm_id int, seq_num int, icd9_code string",
    "procedures_icd": "row_id int, subject_id int, hadm_id int, seq_num int, icd9_code string",
    "prescriptions": (
        "row_id int, subject_id int, hadm_id int, icustay_id int, startdate timestamp, enddate timestamp, "
        "drug_type string, drug string, drug_name_poe string, drug_name_generic string, formulary_drug_cd string, "
        "gsn string, ndc string, prod_strength string, dose_val_rx string, dose_unit_rx string, "
        "form_val_disp string, form_unit_disp string, route string"
    ),
    "labevents": (
        "row_id int, subject_id int, hadm_id int, itemid int, charttime timestamp, value string, valuenum double, "
        "valueuom string, flag string"
    ),
    "noteevents": (
        "row_id int, subject_id int, hadm_id int, chartdate string, charttime string, storetime string, "
        "category string, description string, cgid int, iserror string, text string"
    ),
    "caregivers": "row_id int, cgid int, label string, description string",
    "d_icd_diagnoses": "row_id int, icd9_code string, short_title string, long_title string",
    "d_icd_procedures": "row_id int, icd9_code string, short_title string, long_title string",
    "d_labitems": "row_id int, itemid int, label string, fluid string, category string, loinc_code string",
}

# Tables stored by patient, and small lookup tables stored flat.
PARTITION_KEYS: dict[str, str | None] = {
    "patients": "subject_id",
    "admissions": "subject_id",
    "diagnoses_icd": "subject_id",
    "procedures_icd": "subject_id",
    "prescriptions": "subject_id",
    "labevents": "subject_id",
    "noteevents": "subject_id",
    "caregivers": None,
    "d_icd_diagnoses": None,
    "d_icd_procedures": None,
    "d_labitems": None,
}
