"""Declared schemas of the nine model tables.

Nothing is inferred: every reader applies these ``StructType``s. Keys are
``LongType`` so the model survives key spaces beyond 2^31 rows; money is
``DoubleType`` (the source declares 32-bit floats, widened here) and is summed
as exact decimals by the operators (see ``wardlens.functions.exact``).
"""

from __future__ import annotations

from pyspark.sql import types as T

from wardlens.fixed_values import DERIVED_LIMITS, VARCHAR_LIMITS  # noqa: F401 (re-exported)


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


S, I, L, D, DT, B = (T.StringType(), T.IntegerType(), T.LongType(),
                     T.DoubleType(), T.DateType(), T.BooleanType())

DEPARTMENTS = T.StructType([
    _f("DepartmentID", L, False), _f("DepartmentName", S, False),
    _f("DepartmentType", S), _f("BedCapacity", I), _f("OperationalStatus", S),
    _f("Building", I), _f("FloorNumber", I), _f("PhoneExtension", S),
])

PATIENTS = T.StructType([
    _f("PatientID", L, False), _f("FirstName", S), _f("LastName", S),
    _f("DOB", DT), _f("Sex", S), _f("Address", S), _f("Zip", S),
])

STAFF = T.StructType([
    _f("StaffID", L, False), _f("FirstName", S), _f("LastName", S), _f("Role", S),
    _f("DepartmentID", L), _f("TypicalShift", S), _f("HireDate", DT),
    _f("EmploymentStatus", S), _f("VaxHBVStatus", S), _f("VaxTdapStatus", S),
])

SUPPLIES = T.StructType([
    _f("SupplyID", L, False), _f("SupplyName", S), _f("Category", S),
    _f("DepartmentID", L), _f("StockLevel", I), _f("ReorderThreshold", I),
    _f("ExpirationDate", DT), _f("UnitCost", D), _f("UnitOfMeasure", S),
    _f("ControlledItem", B), _f("UnitsConsumedLast30Days", I),
    _f("LastUsageUpdate", DT),
])

ENCOUNTERS = T.StructType([
    _f("EncounterID", L, False), _f("PatientID", L), _f("DepartmentID", L),
    _f("StaffID", L), _f("EncounterType", S), _f("EncounterDate", DT),
    _f("DischargeDate", DT), _f("ChiefComplaint", S), _f("DischargeStatus", S),
    _f("InsuranceType", S), _f("BillingCode", S), _f("EncounterCost", D),
])

REFERRALS = T.StructType([
    _f("ReferralID", L, False), _f("PatientID", L), _f("EncounterID", L),
    _f("DepartmentID", L), _f("ReceivingHospital", S), _f("SpecialtyRequired", S),
    _f("DateRequested", DT), _f("DateResolved", DT), _f("Status", S),
    _f("RejectionReason", S), _f("TransportDifficultyFlag", S),
    _f("TransportDifficultyReason", S), _f("ReferralDirection", S),
])

BILLING_CLAIMS = T.StructType([
    _f("ClaimID", L, False), _f("EncounterID", L), _f("BilledAmount", D),
    _f("AllowedAmount", D), _f("PaidAmount", D), _f("ClaimStatus", S),
    _f("DateSubmitted", DT),
])

SATISFACTION_SURVEYS = T.StructType([
    _f("SurveyID", L, False), _f("PatientID", L), _f("EncounterID", L),
    _f("OverallRating", I), _f("StaffRating", I), _f("FacilityRating", I),
    _f("SurveyDate", DT),
])

# Output of the indicator job. The generated surrogate id of the source table
# is dropped: the natural key is (IndicatorName, period, DepartmentID,
# CatchmentArea) and the two period columns are the partition columns.
QUALITY_INDICATORS = T.StructType([
    _f("DepartmentID", L), _f("CatchmentArea", S), _f("IndicatorName", S, False),
    _f("ReportingPeriodStart", DT, False), _f("ReportingPeriodEnd", DT, False),
    _f("Numerator", D), _f("Denominator", D), _f("ComputedValue", D, False),
    _f("SeverityFlag", S), _f("ComputationDate", DT, False),
    _f("DerivationRule", S, False),
])

# Derived columns the source stores in its base tables. They are not part of
# the base schemas (the library derives them); read them with
# ``with_derived=True`` to use stored values, e.g. a stored readmission flag.
DERIVED = {
    "encounters": [_f("IsReadmission", S), _f("LengthOfStayDays", I)],
    "patients": [_f("CatchmentArea", S)],
}


def with_derived(name: str) -> T.StructType:
    """The base schema of ``name`` plus its stored derived columns."""
    return T.StructType(list(MODEL[name].fields) + DERIVED.get(name, []))


MODEL = {
    "departments": DEPARTMENTS,
    "patients": PATIENTS,
    "staff": STAFF,
    "supplies": SUPPLIES,
    "encounters": ENCOUNTERS,
    "referrals": REFERRALS,
    "billing_claims": BILLING_CLAIMS,
    "satisfaction_surveys": SATISFACTION_SURVEYS,
}

# The tables that the checks cover: the base tables and the reporting table,
# which the library writes itself.
CHECKED = {**MODEL, "quality_indicators": QUALITY_INDICATORS}
