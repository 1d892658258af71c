"""Columns of the clinical input tables. Times are instants or wall clocks as stored; the
reader turns instants into the site's wall clock."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
_T = T.TimestampNTZType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SCHEMAS: dict[str, T.StructType] = {
    "patient": _table(patient_id=_S, sex_category=_S, race_category=_S, ethnicity_category=_S),
    "hospitalization": _table(
        patient_id=_S, hospitalization_id=_S, admission_dttm=_T, discharge_dttm=_T,
        age_at_admission=_D, admission_type_category=_S, discharge_category=_S),
    "adt": _table(
        hospitalization_id=_S, hospital_id=_S, hospital_type=_S, location_category=_S,
        location_type=_S, in_dttm=_T, out_dttm=_T),
    "hospital_diagnosis": _table(
        hospitalization_id=_S, diagnosis_code=_S, diagnosis_code_format=_S),
    "patient_procedures": _table(
        hospitalization_id=_S, procedure_code=_S, procedure_code_format=_S,
        procedure_billed_dttm=_T, billing_provider_id=_S),
    "medication_admin_intermittent": _table(
        hospitalization_id=_S, admin_dttm=_T, med_category=_S, med_dose=_S, med_dose_unit=_S,
        mar_action_category=_S),
    "medication_admin_continuous": _table(
        hospitalization_id=_S, admin_dttm=_T, med_category=_S, med_dose=_D),
    "respiratory_support": _table(
        hospitalization_id=_S, recorded_dttm=_T, device_category=_S, tracheostomy=_I),
    "vitals": _table(
        hospitalization_id=_S, recorded_dttm=_T, vital_category=_S, vital_value=_D),
    "labs": _table(hospitalization_id=_S, recorded_dttm=_T, lab_category=_S, lab_value=_D),
    "crrt_therapy": _table(hospitalization_id=_S, recorded_dttm=_T),
    "microbiology_culture": _table(hospitalization_id=_S, recorded_dttm=_T, fluid_category=_S),
}
# Tables a site may not have; they read as empty.
OPTIONAL = {"crrt_therapy"}
