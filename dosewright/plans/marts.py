"""The fifteen summary tables.

All measures are counts, so a summary can be made of a finer count as well as
of the records. ``build_mart`` reads the records and suits a single summary:
the scan reads only its own columns. ``build_marts`` needs all fifteen and
reads the records three times instead of fifteen, once per *cube*:

===========  =================================================  =========
cube         keys                                               summaries
===========  =================================================  =========
territory    state, region, municipality, vaccine               7
calendar     year, month, vaccine                               5
profile      manufacturer, age band, sex                        3
===========  =================================================  =========

One cube over all twelve keys would hardly be smaller than the records, and
grouping sets would multiply the records before combining them. The three
cubes are bounded by the product of few code lists, are written once, and all
fifteen summaries are made of those small tables.

Coordinates depend on the municipality alone, so the dimension is joined to
counted rows, after the records have been combined. That needs unique
dimension keys, which is checked.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.functions.keys import municipality_key
from dosewright.operators.lookups import require_unique, with_geography
from dosewright.operators.rollups import COUNT_OF_FLAG, DOSES, RECORDS, flag_counts, with_rates
from dosewright.operators.topk import ordering
from dosewright.session import stored

MONTH = ("ano_vacinacao", "mes_vacinacao")
VACCINE = ("sg_vacina", "descricao_vacina")
MUNICIPALITY = ("codigo_municipio_paciente", "nome_municipio_paciente")
PLACE = ("latitude", "longitude")


@dataclass(frozen=True)
class Mart:
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cube: str
    measure: str = DOSES
    quality: bool = False

    @property
    def record_keys(self) -> tuple[str, ...]:
        """Keys found in the records; the others come from the dimension."""
        return tuple(k for k in self.keys if k not in PLACE)

    @property
    def needs_geography(self) -> bool:
        return self.record_keys != self.keys


def _quality(keys: tuple[str, ...], cube: str, order: tuple[str, ...] = ()) -> Mart:
    return Mart(keys, order or (f"-{RECORDS}", *keys), cube, RECORDS, quality=True)


def _count(keys: tuple[str, ...], cube: str, order: tuple[str, ...] = ()) -> Mart:
    return Mart(keys, order or (f"-{DOSES}", *keys), cube)


MARTS: dict[str, Mart] = {
    "monthly_vaccination_summary": _count(MONTH, "calendar", MONTH),
    "state_vaccination_summary": _count(("uf_paciente",), "territory"),
    "region_vaccination_summary": _count(("regiao_paciente",), "territory"),
    "vaccine_type_summary": _count(VACCINE, "calendar"),
    "manufacturer_summary": _count(("descricao_vacina_fabricante",), "profile"),
    "age_group_summary": _count(("faixa_etaria",), "profile"),
    "sex_summary": _count(("sexo_paciente",), "profile"),
    "monthly_vaccine_type_summary": _count(
        (*MONTH, *VACCINE), "calendar", (*MONTH, f"-{DOSES}", *VACCINE)
    ),
    "state_vaccine_type_summary": _count(
        ("uf_paciente", *VACCINE), "territory", ("uf_paciente", f"-{DOSES}", *VACCINE)
    ),
    "municipality_vaccination_summary": _count(
        ("uf_paciente", "regiao_paciente", *MUNICIPALITY, *PLACE), "territory"
    ),
    "state_municipality_vaccine_summary": _count(
        ("uf_paciente", *MUNICIPALITY, *PLACE, *VACCINE),
        "territory",
        ("uf_paciente", "nome_municipio_paciente", f"-{DOSES}", MUNICIPALITY[0], *VACCINE),
    ),
    "quality_by_month": _quality(MONTH, "calendar", MONTH),
    "quality_by_state": _quality(("uf_paciente",), "territory"),
    "quality_by_vaccine": _quality(VACCINE, "calendar"),
    "vaccine_dictionary": Mart(
        ("codigo_vacina", *VACCINE),
        (*VACCINE, "codigo_vacina"),
        "calendar",
        "registros_observados",
    ),
}

CUBES: dict[str, tuple[str, ...]] = {
    "territory": ("uf_paciente", "regiao_paciente", *MUNICIPALITY, *VACCINE),
    "calendar": (*MONTH, "codigo_vacina", *VACCINE),
    "profile": ("descricao_vacina_fabricante", "faixa_etaria", "sexo_paciente"),
}
_N = "n_registros"


def cube(curated: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of the records at the keys of one cube, ``by`` further keys."""
    quality = any(m.quality for m in MARTS.values() if m.cube == name)
    measures = flag_counts() if quality else []
    return curated.groupBy(*by, *CUBES[name]).agg(F.count("*").alias(_N), *measures)


def stored_cubes(curated: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {name: stored(cube(curated, name), f"cube-{name}") for name in names or CUBES}


def _finished(counted: DataFrame, mart: Mart, geography: DataFrame | None) -> DataFrame:
    if mart.quality:
        counted = with_rates(counted)
        return counted.orderBy(*ordering(mart.order))
    if mart.needs_geography:
        counted = with_geography(counted, geography)
    return counted.select(*mart.keys, mart.measure).orderBy(*ordering(mart.order))


def require_unique_places(geography: DataFrame | None) -> None:
    """An error where two rows of the dimension would join to one municipality."""
    if geography is not None:
        require_unique(geography.select(municipality_key(F.col("codigo_municipio")).alias("k")), "k")


def build_mart(curated: DataFrame, name: str, geography: DataFrame | None = None) -> DataFrame:
    """One summary from the records, in its published order."""
    mart = MARTS[name]
    if mart.needs_geography:
        require_unique_places(geography)
    measures = flag_counts() if mart.quality else []
    counted = curated.groupBy(*mart.record_keys).agg(F.count("*").alias(mart.measure), *measures)
    return _finished(counted, mart, geography)


def mart_from_cubes(
    cubes: Mapping[str, DataFrame], name: str, geography: DataFrame | None = None
) -> DataFrame:
    """The same summary from the counts of its cube."""
    mart = MARTS[name]
    measures = [F.sum(_N).alias(mart.measure)]
    if mart.quality:
        measures += [F.sum(c).alias(c) for c in COUNT_OF_FLAG.values()]
    counted = cubes[mart.cube].groupBy(*mart.record_keys).agg(*measures)
    return _finished(counted, mart, geography)


def build_marts(
    curated: DataFrame, geography: DataFrame | None = None, names: list[str] | None = None
) -> dict[str, DataFrame]:
    """All summaries (or ``names``) by way of the stored cubes."""
    names = names or list(MARTS)
    require_unique_places(geography)
    cubes = stored_cubes(curated, sorted({MARTS[n].cube for n in names}))
    return {name: mart_from_cubes(cubes, name, geography) for name in names}


def legacy_marts(curated: DataFrame) -> dict[str, DataFrame]:
    """Summaries of a frame whose columns may be incomplete.

    Missing keys are left out, a summary without any key is not made, quality
    needs all of its columns, and nothing is joined.
    """
    from dosewright.operators import rollups

    made: dict[str, DataFrame | None] = {}
    for name, mart in MARTS.items():
        if mart.quality:
            made[name] = rollups.quality_rollup(curated, mart.record_keys)
        elif name == "vaccine_dictionary":
            made[name] = rollups.vaccine_dictionary(curated)
        else:
            made[name] = rollups.group_count(curated, mart.record_keys)
    return {name: df for name, df in made.items() if df is not None}
