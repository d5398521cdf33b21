"""Grade scale and column roles: which column plays which part in an operator."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GradeScale:
    """Ordered grade labels, best first. Ordinals start at 1."""

    labels: tuple[str, ...] = ("A", "B", "C", "D", "E", "F", "G")

    @property
    def best(self) -> str:
        return self.labels[0]

    @property
    def worst(self) -> str:
        return self.labels[-1]

    def ordinal(self, grade: Column) -> Column:
        """Position of a label on the scale as int; null for any other value."""
        branches = F
        for position, label in enumerate(self.labels, start=1):
            branches = branches.when(grade == label, F.lit(position))
        return branches

    def contains(self, grade: Column) -> Column:
        return grade.isin(*self.labels)


GRADES = GradeScale()


@dataclass(frozen=True)
class Roles:
    """Names of the columns an operator works on."""

    key: str
    received: str
    grade: str
    ordinal: str
    intensity: str
    surface: str
    total: str | None = None
    commune: str | None = None
    building: str | None = None
    zone: str | None = None
    commune_name: str | None = None
    categoricals: tuple[str, ...] = ()
    numerics: tuple[str, ...] = ()
    extra_numbers: tuple[str, ...] = ()

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that must be present for a row to enter the class statistics."""
        return tuple(c for c in (self.grade, self.total, self.intensity, self.surface) if c)

    @property
    def numbers(self) -> tuple[str, ...]:
        """Columns that are cast to double before any rule looks at them."""
        named = (self.intensity, self.total, self.surface)
        return tuple(c for c in named if c) + self.extra_numbers

    def survivor_order(self, columns: Sequence[str]) -> list[str]:
        """Total order for choosing one row per key: latest first, then larger values, then the rest."""
        lead = [c for c in (self.received, self.intensity, self.total, self.surface) if c in columns]
        return lead + [c for c in columns if c not in lead and c != self.key]


# Column names of the two published record layouts, as the source data spells them.
CLASS_ROLES = Roles(
    key="N_DPE",
    received="Date_reception_DPE",
    grade="Etiquette_DPE",
    ordinal="Etiquette_DPE_num",
    intensity="Conso_5_usages_par_m2_e_finale",
    total="Conso_5_usages_e_finale",
    surface="Surface_habitable_logement",
    building="Type_batiment",
    categoricals=("Type_batiment", "Periode_construction", "Type_energie_principale_chauffage"),
    numerics=("Surface_habitable_logement", "Etiquette_DPE_num"),
    extra_numbers=("Emission_GES_5_usages_par_m2",),
)

MODEL_ROLES = Roles(
    key="numero_dpe",
    received="date_reception_dpe",
    grade="etiquette_dpe",
    ordinal="etiquette_dpe_num",
    intensity="conso_5_usages_par_m2_ef",
    surface="surface_habitable_immeuble",
    commune="code_insee_ban",
    building="type_batiment",
    zone="zone_climatique",
    commune_name="nom_commune_ban",
    categoricals=(
        "etiquette_dpe",
        "type_batiment",
        "periode_construction",
        "zone_climatique",
        "qualite_isolation_enveloppe",
        "qualite_isolation_murs",
        "qualite_isolation_menuiseries",
        "qualite_isolation_plancher_bas",
        "qualite_isolation_plancher_haut_comble_perdu",
        "type_energie_principale_chauffage",
        "type_installation_chauffage",
    ),
    numerics=("ubat_w_par_m2_k", "deperditions_enveloppe", "surface_habitable_immeuble"),
)

# Accented source names and the names the class analysis uses for them.
ACCENTED_NAMES = {
    "N°DPE": "N_DPE",
    "Date_réception_DPE": "Date_reception_DPE",
    "Etiquette_DPE": "Etiquette_DPE",
    "Etiquette_GES": "Etiquette_GES",
    "Conso_5_usages_é_finale": "Conso_5_usages_e_finale",
    "Conso_5_usages_par_m²_é_finale": "Conso_5_usages_par_m2_e_finale",
    "Surface_habitable_logement": "Surface_habitable_logement",
    "Type_bâtiment": "Type_batiment",
    "Période_construction": "Periode_construction",
    "Type_énergie_principale_chauffage": "Type_energie_principale_chauffage",
    "Code_postal_ban": "Code_postal_ban",
    "Emission_GES_5_usages_par_m²": "Emission_GES_5_usages_par_m2",
}

# The snake_case layout carries the same twelve fields under these names.
SNAKE_NAMES = {
    "numero_dpe": "N_DPE",
    "date_reception_dpe": "Date_reception_DPE",
    "etiquette_dpe": "Etiquette_DPE",
    "etiquette_ges": "Etiquette_GES",
    "conso_5_usages_ef": "Conso_5_usages_e_finale",
    "conso_5_usages_par_m2_ef": "Conso_5_usages_par_m2_e_finale",
    "surface_habitable_logement": "Surface_habitable_logement",
    "type_batiment": "Type_batiment",
    "periode_construction": "Periode_construction",
    "type_energie_principale_chauffage": "Type_energie_principale_chauffage",
    "code_postal_ban": "Code_postal_ban",
    "emission_GES_5_usages_par_m2": "Emission_GES_5_usages_par_m2",
}

CLASS_COLUMNS = tuple(ACCENTED_NAMES.values())

# Consumption file columns and the names used after the join preparation.
CONSUMPTION_NAMES = {
    "Code Commune": "code_insee_join",
    "consommation_annuelle_moyenne_par_site_de_ladresse_mwh": "conso_reelle_mwh",
}

# Published kWh/m²/yr of each grade, used by the renovation scenarios.
CLASS_REFERENCE = (
    ("A", 50.0),
    ("B", 80.0),
    ("C", 150.0),
    ("D", 230.0),
    ("E", 330.0),
    ("F", 450.0),
    ("G", 600.0),
)
