"""Field names and fixed values of the record model, and the domains it is bound to."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The raw extract, in file order.
RAW_FIELDS = (
    "source_row_id",
    "health_service_area",
    "hospital_county",
    "permanent_facility_id",
    "facility_name",
    "age_group",
    "length_of_stay",
    "type_of_admission",
    "patient_disposition",
    "discharge_year",
    "apr_drg_code",
    "apr_drg_description",
    "apr_severity_of_illness_code",
    "apr_severity_of_illness",
    "apr_risk_of_mortality",
    "payment_typology_1",
    "emergency_department_indicator",
    "total_charges",
    "total_costs",
)

ENTITY = "HospitalKey"
STRATA = ("ConditionKey", "SeverityKey", "AgeGroup")
ENTITY_FIELDS = ("HospitalKey", "HospitalName", "HospitalCounty")

# Stay bands in order, and the upper edge of each band but the last two.
STAY_BANDS = (
    "1-2 days",
    "3-5 days",
    "6-10 days",
    "11-20 days",
    "21-30 days",
    "31-119 days",
    "120+ days",
)
BAND_EDGES = (2, 5, 10, 20, 30)

# The eight tables of the model and their columns.
MODEL_TABLES = {
    "AgeGroups": ("AgeGroup", "AgeSort"),
    "Conditions": ("ConditionKey", "ConditionDescription", "Condition"),
    "Discharges": (
        "DischargeKey",
        "HospitalKey",
        "ConditionKey",
        "SeverityKey",
        "AgeGroup",
        "PrimaryPayer",
        "StayBand",
        "DischargeYear",
        "ExactLOS",
        "LOSCensored",
        "BedDaysLowerBound",
        "Disposition",
        "AdmissionType",
        "MortalityRisk",
        "EDIndicator",
        "ExpectedLOS",
        "BenchmarkEligible",
        "PeerN",
        "PeerHospitals",
        "EstimatedCost",
        "Charges",
    ),
    "Hospitals": ("HospitalKey", "HospitalName", "HospitalCounty"),
    "Payers": ("PrimaryPayer",),
    "Scenario": ("ReductionPct",),
    "Severity": ("SeverityKey", "Severity"),
    "StayBands": ("StayBand", "BandSort"),
}

# Dimension table -> key that links it to the fact.
RELATIONSHIPS = {
    "Hospitals": "HospitalKey",
    "Conditions": "ConditionKey",
    "Severity": "SeverityKey",
    "AgeGroups": "AgeGroup",
    "Payers": "PrimaryPayer",
    "StayBands": "StayBand",
}


@dataclass(frozen=True)
class Domain:
    """What a data set calls things: category values, labels, and the scope of the cohort."""

    age_groups: tuple[str, ...]
    condition_labels: dict[str, str]
    deceased: str
    selections: dict[str, Callable[[], Column]]
    years: tuple[str, ...] = ()
    areas: tuple[str, ...] = ()
    excluded_age: str = ""
    severities: tuple[int, int] = (1, 4)
    min_peers: int = 30
    min_entities: int = 3
    min_matched: int = 30
    longest_sensitivity_stay: int = 30

    def scope(self) -> Column:
        """Rows of a raw source that belong to the cohort; a missing area or age does not."""
        inside = F.col("apr_drg_code").isin(list(self.condition_labels))
        inside = inside & (F.col("age_group") != self.excluded_age)
        return inside & F.col("health_service_area").isin(list(self.areas)) if self.areas else inside

    def comparable(self) -> Column:
        """Records that enter the peer comparison."""
        return (
            F.col("ExactLOS").isNotNull()
            & F.col("SeverityKey").between(*self.severities)
            & F.col("AgeGroup").isin(list(self.age_groups))
        )

    def sensitivity_base(self) -> Column:
        """Records of the sensitivity rebuild: short exact stays that did not end in death."""
        return F.col("ExactLOS").between(1, self.longest_sensitivity_stay) & (
            F.col("Disposition") != self.deceased
        )

    def predicates(self) -> dict[str, Column]:
        return {label: predicate() for label, predicate in self.selections.items()}


# The hospital cohort.
HOSPITAL = Domain(
    age_groups=("18-29", "30-49", "50-69", "70 or Older"),
    condition_labels={
        "139": "Other pneumonia",
        "194": "Heart failure",
        "720": "Septicemia / disseminated infections",
    },
    deceased="Expired",
    selections={
        "All cohort": lambda: F.lit(True),
        "Heart failure only": lambda: F.col("ConditionKey") == "194",
        "Other pneumonia only": lambda: F.col("ConditionKey") == "139",
        "Septicemia group only": lambda: F.col("ConditionKey") == "720",
        "Age 70 or Older": lambda: F.col("AgeGroup") == "70 or Older",
        "Queens hospitals": lambda: F.col("HospitalCounty") == "Queens",
        "Heart failure and age 70 or Older": lambda: (F.col("ConditionKey") == "194")
        & (F.col("AgeGroup") == "70 or Older"),
    },
    years=("2024",),
    areas=("New York City",),
    excluded_age="0-17",
)

# The supply-chain tables read as stays: supplier = hospital, part type = condition, and so on.
SUPPLY = Domain(
    age_groups=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
    condition_labels={
        "ECONOMY": "Economy",
        "LARGE": "Large",
        "MEDIUM": "Medium",
        "PROMO": "Promotion",
        "SMALL": "Small",
        "STANDARD": "Standard",
    },
    deceased="F",
    selections={
        "All cohort": lambda: F.lit(True),
        "Economy only": lambda: F.col("ConditionKey") == "ECONOMY",
        "Large only": lambda: F.col("ConditionKey") == "LARGE",
        "Promotion only": lambda: F.col("ConditionKey") == "PROMO",
        "Household segment": lambda: F.col("AgeGroup") == "HOUSEHOLD",
        "Europe": lambda: F.col("HospitalCounty") == "EUROPE",
        "Economy and household": lambda: (F.col("ConditionKey") == "ECONOMY")
        & (F.col("AgeGroup") == "HOUSEHOLD"),
    },
    excluded_age="MACHINERY",
)
