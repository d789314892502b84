"""Declarative description of a supervised table."""

from __future__ import annotations

from dataclasses import dataclass, field

# Strings that stand for a missing value, matched exactly.
NULL_TOKENS = ("", " ", "NA", "N/A", "NULL", "null", "?", "-")

# What the usual CSV reader of the Python world already reads as missing.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Bound:
    """Accepted range of a numeric input, either end may be open."""

    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class TableSpec:
    """Column roles and rules of one table; every operator takes its names from here."""

    columns: tuple[str, ...]
    casts: dict[str, str]
    target: str
    target_map: dict[int, int]
    skewed: tuple[str, ...] = ()
    regular: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    ratios: tuple[tuple[str, str, str], ...] = ()  # (output, numerator, denominator)
    renames: dict[str, str] = field(default_factory=dict)
    null_tokens: tuple[str, ...] = NULL_TOKENS
    key: str | None = None
    bounds: dict[str, Bound] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    labels: dict[int, str] = field(default_factory=dict)

    @property
    def raw_features(self) -> tuple[str, ...]:
        """Columns a scoring request has to bring, ratios not included."""
        derived = {name for name, _, _ in self.ratios}
        roles = (*self.skewed, *self.regular, *self.categorical)
        return tuple(c for c in roles if c not in derived)


# The clinical table's column names (its own spelling), types, roles, bounds.
CLINICAL = TableSpec(
    columns=(
        "Age", "Gender", "Total_Bilirubin", "Direct_Bilirubin", "Alkaline_Phosphotase",
        "Alamine_Aminotransferase", "Aspartate_Aminotransferase", "Total_Protiens", "Albumin",
        "Albumin_and_Globulin_Ratio", "Dataset",
    ),
    renames={"Dataset": "Diagnosis"},
    casts={
        "Age": "bigint",
        "Gender": "string",
        "Total_Bilirubin": "double",
        "Direct_Bilirubin": "double",
        "Alkaline_Phosphotase": "double",
        "Alamine_Aminotransferase": "double",
        "Aspartate_Aminotransferase": "double",
        "Total_Protiens": "double",
        "Albumin": "double",
        "Albumin_and_Globulin_Ratio": "double",
        "Diagnosis": "bigint",
    },
    target="Diagnosis",
    target_map={1: 1, 2: 0},
    skewed=(
        "Total_Bilirubin", "Direct_Bilirubin", "Alkaline_Phosphotase", "Alamine_Aminotransferase",
        "Aspartate_Aminotransferase", "Direct_to_Total_Bilirubin", "AST_to_ALT",
    ),
    regular=("Age", "Total_Protiens", "Albumin", "Albumin_and_Globulin_Ratio"),
    categorical=("Gender",),
    ratios=(
        ("Direct_to_Total_Bilirubin", "Direct_Bilirubin", "Total_Bilirubin"),
        ("AST_to_ALT", "Aspartate_Aminotransferase", "Alamine_Aminotransferase"),
    ),
    bounds={
        "Age": Bound(0, 120),
        "Total_Bilirubin": Bound(0),
        "Direct_Bilirubin": Bound(0),
        "Alkaline_Phosphotase": Bound(0),
        "Alamine_Aminotransferase": Bound(0),
        "Aspartate_Aminotransferase": Bound(0),
        "Total_Protiens": Bound(0),
        "Albumin": Bound(0),
        "Albumin_and_Globulin_Ratio": Bound(0),
    },
    domains={"Gender": ("Male", "Female")},
    labels={1: "Enfermedad hepática", 0: "Sin enfermedad hepática"},
)
