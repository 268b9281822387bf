"""Fixed values.

Values that must equal the source system's for the reports to give the same
results: code lists, text patterns, cutoffs, indicator names and texts, window
lengths, key declarations and declared string lengths. They are stated here
plainly, in the source's order; everything else in the library is its own
design. Report sizes (the source's row limits) are the defaults of the report
functions.
"""

from __future__ import annotations

# Catchment areas: ZIP codes of each health service area (first match wins);
# every other ZIP, and a missing one, is unassigned.
CATCHMENT_AREAS: dict[str, list[str]] = {
    "HSA-1": ["12307", "12305"],
    "HSA-2": ["12303", "12304", "12308"],
    "HSA-3": ["12301", "12306", "12302"],
}
UNASSIGNED = "Unassigned"

# Readmission: an encounter within this many days after the discharge of a
# closed stay of this type.
READMISSION_WINDOW_DAYS = 30
PRIOR_STAY_TYPE = "inpatient"

# The encounter type of a hospital stay (length of stay, bed use, costliest stays).
INPATIENT = "inpatient"

# Encounter types that count as a complication.
COMPLICATION_TYPES = ["emergency", "inpatient"]

# Chronic-disease pattern, searched in the lower-cased chief complaint.
CHRONIC_PATTERN = "diabetic|hypoglycemic|diabetes|hypertens|asthma|heart failure"

# Risk levels in report order, and the rank cut of the costliest stays.
RISK_LEVELS = ["High", "Moderate", "Low"]
COST_RANK_CUT = 3

# Infection control: the department of the complaint report, the complaint
# words of an infection-related encounter, the status that counts as vaccinated.
COMPLAINT_DEPARTMENT_ID = 3
INFECTION_WORDS = ["fever", "infection", "gastroenteritis"]
VACCINATED = "complete"

# Supplies: days ahead that count as expiring soon.
EXPIRY_HORIZON_DAYS = 90

# Referrals and claims.
OUTGOING = "outgoing"
REJECTED = "rejected"
DENIED = "denied"
MIN_CLAIMS = 5

# Quality indicators: name, critical and elevated cutoffs, rounding digits,
# derivation text.
INDICATORS = {
    "readmission_rate": ("readmission_rate_30d", 10, 5, 1,
                         "Readmissions / inpatient+ED encounters per catchment area"),
    "first_encounter_complication": (
        "first_encounter_complication_rate", 50, 30, 1,
        "Patients whose first encounter is emergency/inpatient per catchment"),
    "bed_utilization": (
        "bed_utilization_rate", 85, 70, 2,
        "Total bed-days used / (bed capacity x days in period) per department"),
    "provider_workload": (
        "provider_workload_index", 0.5, 0.3, 4,
        "Encounters / (active clinical staff x days in period) per department"),
}
READMISSION_SCOPE = ["inpatient", "emergency"]
CLINICAL_ROLES = ["resident", "nurse", "specialist", "consultant"]
ACTIVE = "active"

# Declared keys: foreign keys as (child table, child column, parent table,
# parent column), primary keys, and the one unique key (supply names compared
# case-insensitively).
FOREIGN_KEYS = [
    ("billing_claims", "EncounterID", "encounters", "EncounterID"),
    ("encounters", "PatientID", "patients", "PatientID"),
    ("encounters", "DepartmentID", "departments", "DepartmentID"),
    ("encounters", "StaffID", "staff", "StaffID"),
    ("referrals", "PatientID", "patients", "PatientID"),
    ("referrals", "EncounterID", "encounters", "EncounterID"),
    ("referrals", "DepartmentID", "departments", "DepartmentID"),
    ("satisfaction_surveys", "PatientID", "patients", "PatientID"),
    ("satisfaction_surveys", "EncounterID", "encounters", "EncounterID"),
    ("staff", "DepartmentID", "departments", "DepartmentID"),
    ("supplies", "DepartmentID", "departments", "DepartmentID"),
    ("quality_indicators", "DepartmentID", "departments", "DepartmentID"),
]
PRIMARY_KEYS = {
    "departments": ["DepartmentID"], "patients": ["PatientID"], "staff": ["StaffID"],
    "supplies": ["SupplyID"], "encounters": ["EncounterID"], "referrals": ["ReferralID"],
    "billing_claims": ["ClaimID"], "satisfaction_surveys": ["SurveyID"],
}
UNIQUE_KEYS = {"supplies": ["DepartmentID", "SupplyName"]}
# The reporting table's generated id is not kept; its rows are told apart by
# these columns, of which area and department may be null.
NATURAL_KEYS = {"quality_indicators": ["IndicatorName", "ReportingPeriodStart", "ReportingPeriodEnd",
                                       "DepartmentID", "CatchmentArea"]}

# Declared string lengths (characters) per table and column.
VARCHAR_LIMITS = {
    "departments": {"DepartmentName": 50, "DepartmentType": 50,
                    "OperationalStatus": 20, "PhoneExtension": 10},
    "patients": {"FirstName": 50, "LastName": 50, "Sex": 10, "Address": 200,
                 "Zip": 10},
    "staff": {"FirstName": 50, "LastName": 50, "Role": 50, "TypicalShift": 20,
              "EmploymentStatus": 20, "VaxHBVStatus": 20, "VaxTdapStatus": 20},
    "supplies": {"SupplyName": 100, "Category": 50, "UnitOfMeasure": 20},
    "encounters": {"EncounterType": 20, "ChiefComplaint": 200,
                   "DischargeStatus": 50, "InsuranceType": 50, "BillingCode": 20},
    "referrals": {"ReceivingHospital": 100, "SpecialtyRequired": 50,
                  "Status": 20, "RejectionReason": 200,
                  "TransportDifficultyFlag": 5,
                  "TransportDifficultyReason": 200, "ReferralDirection": 10},
    "billing_claims": {"ClaimStatus": 20},
    "quality_indicators": {"CatchmentArea": 20, "IndicatorName": 50, "SeverityFlag": 20,
                           "DerivationRule": 200},
}
# Lengths of stored derived columns.
DERIVED_LIMITS = {"encounters": {"IsReadmission": 3}, "patients": {"CatchmentArea": 20}}
