"""The mart of injury reports: harmonised categories under the names that dashboards show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators import text

# What dashboards call each category, by field; what they call truth that no rule can place; industry sectors by
# the first two digits of an industry code, and what they call others.
SHOWN = {
    "event": {
        "violence_or_animal": "Violence or animal",
        "transportation": "Transportation",
        "fire_or_explosion": "Fire or explosion",
        "fall_slip_trip": "Fall, slip or trip",
        "harmful_exposure": "Harmful substance or environment",
        "contact_with_object": "Contact with object or equipment",
        "overexertion": "Overexertion or bodily reaction",
    },
    "nature": {
        "amputation": "Amputation",
        "fracture": "Fracture",
        "burn": "Burn",
        "electric_shock": "Electric shock",
        "heat_illness": "Heat illness",
        "head_brain_injury": "Concussion or brain injury",
        "cut_or_puncture": "Cut or puncture",
        "crushing": "Crushing injury",
        "internal_injury": "Internal injury",
        "poisoning_or_respiratory": "Poisoning or respiratory",
        "sprain_strain_or_bruise": "Sprain, strain or bruise",
        "other": "Other specific injury",
    },
    "body_part": {
        "head": "Head",
        "neck": "Neck",
        "trunk": "Trunk",
        "upper_extremities": "Upper extremities",
        "lower_extremities": "Lower extremities",
        "body_systems": "Body systems",
        "multiple_body_parts": "Multiple body parts",
    },
    "source": {
        "chemicals": "Chemicals",
        "containers_furniture_fixtures": "Containers, furniture, fixtures",
        "machinery": "Machinery",
        "parts_and_materials": "Parts and materials",
        "persons_plants_animals_minerals": "Persons, plants, animals, minerals",
        "structures_and_surfaces": "Structures and surfaces",
        "tools_instruments_equipment": "Tools, instruments, equipment",
        "vehicles": "Vehicles",
        "other_sources": "Other sources",
    },
}
NOWHERE = {"event": "Not classifiable", "nature": "Unspecified", "body_part": "Not classifiable", "source": "Not classifiable"}
SECTORS = {
    "11": "Agriculture, forestry, fishing and hunting",
    "21": "Mining, quarrying, and oil and gas",
    "22": "Utilities",
    "23": "Construction",
    "31": "Manufacturing",
    "32": "Manufacturing",
    "33": "Manufacturing",
    "42": "Wholesale trade",
    "44": "Retail trade",
    "45": "Retail trade",
    "48": "Transportation and warehousing",
    "49": "Transportation and warehousing",
    "51": "Information",
    "52": "Finance and insurance",
    "53": "Real estate and rental and leasing",
    "54": "Professional, scientific, and technical services",
    "55": "Management of companies and enterprises",
    "56": "Administrative, support and waste management services",
    "61": "Educational services",
    "62": "Health care and social assistance",
    "71": "Arts, entertainment, and recreation",
    "72": "Accommodation and food services",
    "81": "Other services (except public administration)",
    "92": "Public administration",
}
UNKNOWN_SECTOR = "Unknown"


def _named(key: Column, names: dict[str, str], other: str) -> Column:
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.coalesce(key, F.lit(""))), F.lit(other))


def sector(code: Column) -> Column:
    """The industry sector of a code by its first two digits."""
    return _named(F.substring(code, 1, 2), SECTORS, UNKNOWN_SECTOR)


def shown(label: Column, field: str) -> Column:
    return _named(label, SHOWN[field], NOWHERE[field])


def injury_facts(reports: DataFrame) -> DataFrame:
    """One row per report, without its text: 17 columns.

    ``reports`` has report_id, event_month (yyyy-MM), event_year, state, naics, naics_sector, ``<field>_code`` and ``<field>_title``
    of event, body_part and source, nature_title, the counts hospitalized, amputation and loss_of_eye (null: unknown, and
    stays so) and inspected.
    """
    out = reports
    for field in ("event", "body_part", "source"):
        out = text.harmonise(out, field, f"{field}_code", f"{field}_title", "event_month")
    return out.select(
        F.col("report_id").cast("long").alias("report_id"),
        "event_month",
        F.to_date(F.concat("event_month", F.lit("-01"))).alias("event_date"),
        F.col("event_year").cast("int").alias("event_year"),
        text.era(F.col("event_month")).alias("coding_era"),
        "state",
        "naics",
        "naics_sector",
        sector(F.col("naics_sector")).alias("industry_sector"),
        shown(F.col("event"), "event").alias("event_category"),
        shown(text.nature_type(F.col("nature_title")), "nature").alias("nature_category"),
        shown(F.col("body_part"), "body_part").alias("body_part_category"),
        shown(F.col("source"), "source").alias("source_category"),
        *(F.col(c).cast("int").alias(c) for c in ("hospitalized", "amputation", "loss_of_eye")),
        F.col("inspected").cast("boolean").alias("inspected"),
    )
