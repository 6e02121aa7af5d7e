"""Summaries, quality rates, dictionaries and duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from dosewright.operators import rollups
from dosewright.operators.dedup import drop_exact_duplicates, duplicate_counts
from dosewright.operators.rollups import COUNT_OF_FLAG
from dosewright.plans import monthly
from dosewright.plans.marts import MARTS, build_mart, build_marts, legacy_marts
from dosewright.session import scratch_path, stored
from dosewright.sinks import partitions, tables
from dosewright.spec import QUALITY_FLAGS
from entry_queries import oracle
from entry_queries.binding import curated, doses, geography, table
from entry_queries.registry import query, register


def _mart_query(name: str):
    mart = MARTS[name]

    def run(spark, sf_dir):
        columns = [*mart.record_keys, *(QUALITY_FLAGS if mart.quality else ())]
        records = curated(spark, sf_dir, *columns)
        geo = geography(spark, sf_dir) if mart.needs_geography else None
        return build_mart(records, name, geo)

    return run


def _mart_sql(name: str) -> str:
    mart = MARTS[name]
    keys = ", ".join(mart.keys)
    if mart.quality:
        return oracle.over_curated(oracle.quality(keys))
    if mart.needs_geography:
        return oracle.over_geo(oracle.grouped(keys, mart.measure, "enriched"))
    return oracle.over_curated(oracle.grouped(keys, mart.measure))


for _number, _name in enumerate(MARTS, 1):
    register(f"AGG_{_number:02d}_{_name}", _mart_query(_name), _mart_sql(_name))


def all_marts_columns() -> list[str]:
    return list(dict.fromkeys([*(k for m in MARTS.values() for k in m.record_keys), *QUALITY_FLAGS]))


_KEYS = 8  # more than any summary has


def _mart_rows_sql() -> str:
    parts = []
    for name, mart in MARTS.items():
        source = "enriched" if mart.needs_geography else "curated"
        keys = ", ".join(mart.keys)
        padded = [f"CAST({k} AS VARCHAR) AS key_{i}" for i, k in enumerate(mart.record_keys)]
        padded += [f"CAST(NULL AS VARCHAR) AS key_{i}" for i in range(len(mart.record_keys), _KEYS)]
        place = "latitude AS place" if mart.needs_geography else "CAST(NULL AS DOUBLE) AS place"
        flags = (
            ", ".join(
                f"count(*) FILTER (WHERE {f}) AS {f}"
                for f in ("registro_completo", "idade_valida", "registro_valido_documento")
            )
            if mart.quality
            else "CAST(NULL AS BIGINT) AS registro_completo, CAST(NULL AS BIGINT) AS idade_valida, "
            "CAST(NULL AS BIGINT) AS registro_valido_documento"
        )
        parts.append(
            f"SELECT '{name}' AS mart, {', '.join(padded)}, {place}, count(*) AS total, {flags} "
            f"FROM {source} GROUP BY {keys}"
        )
    return oracle.over_geo("\nUNION ALL\n".join(parts))


def _mart_rows(made):
    """All rows and values of summaries, in one shape."""

    def shaped(name, df):
        mart = MARTS[name]
        keys = [F.col(k).cast("string").alias(f"key_{i}") for i, k in enumerate(mart.record_keys)]
        keys += [F.lit(None).cast("string").alias(f"key_{i}") for i in range(len(keys), _KEYS)]
        place = F.col("latitude") if mart.needs_geography else F.lit(None).cast("double")
        flags = {
            flag: F.col(count) if mart.quality else F.lit(None).cast("bigint")
            for flag, count in COUNT_OF_FLAG.items()
        }
        return df.select(
            F.lit(name).alias("mart"), *keys, place.alias("place"), F.col(mart.measure).alias("total"),
            *(c.alias(f) for f, c in flags.items()),
        )

    return reduce(lambda a, b: a.unionByName(b), (shaped(n, df) for n, df in made.items()))


@query("MART_all_from_cubes", _mart_rows_sql())
def marts_from_cubes(spark, sf_dir):
    """All rows and values of the fifteen summaries by way of the cubes."""
    records = stored(curated(spark, sf_dir, *all_marts_columns()), "records")  # three cubes read them
    return _mart_rows(build_marts(records, geography(spark, sf_dir)))


@query("SNK_05_stored_tables", _mart_rows_sql())
def stored_tables(spark, sf_dir):
    """All fifteen summaries stored as tables and CSV, read back."""
    records = stored(curated(spark, sf_dir, *all_marts_columns()), "records")
    made = build_marts(records, geography(spark, sf_dir))
    return _mart_rows(tables.save_all(made, scratch_path(spark, "tables"), scratch_path(spark, "csv")))


def _stored_months(spark, sf_dir, root):
    """Curated records in four stored months, entered; the last not as it will be."""
    period = (F.col("l_orderkey") % 4 + 202501).cast("int")
    columns = list(dict.fromkeys(["l_orderkey", *all_marts_columns()]))
    records = stored(curated(spark, sf_dir, *columns).withColumn("arquivo_periodo", period).drop("l_orderkey"), "records")

    def enter(rows):
        partitions.write_by_period(rows, root, "arquivo_periodo")
        counts = rows.groupBy("arquivo_periodo").count().collect()
        entries = [(r[0] // 100, r[0] % 100, r[1]) for r in counts]
        partitions.commit_months(spark.createDataFrame(entries, "year int, month int, records bigint"), root)

    last = F.col("arquivo_periodo") == 202504
    enter(records.filter(~last | (F.col("sexo_paciente") == "A")))
    return lambda: enter(records.filter(last))


@query("SNK_05_by_month", _mart_rows_sql())
def summaries_by_month(spark, sf_dir):
    """The fifteen summaries from cubes of each month; one month is stored again and only its cubes are made again."""
    root, folder = scratch_path(spark, "months"), scratch_path(spark, "month-cubes")
    finish = _stored_months(spark, sf_dir, root)
    monthly.refresh(spark, root, folder)
    finish()
    return _mart_rows(monthly.monthly_marts(spark, root, folder, geography(spark, sf_dir)))


@query(
    "AGG_27_distinct_over_months",
    oracle.over_curated(
        "SELECT ano_vacinacao, count(DISTINCT sg_vacina) AS vaccines, count(DISTINCT codigo_vacina) AS codes "
        "FROM curated GROUP BY ano_vacinacao"
    ),
)
def distinct_over_months(spark, sf_dir):
    """Distinct vaccines of a year from the cubes of stored months, whatever months they are in."""
    root, folder = scratch_path(spark, "months"), scratch_path(spark, "month-cubes")
    _stored_months(spark, sf_dir, root)()
    monthly.refresh(spark, root, folder)
    figures = {"sg_vacina": "vaccines", "codigo_vacina": "codes"}
    return monthly.distinct_figures(monthly.cubes(spark, folder), figures, by=["ano_vacinacao"])


@query(
    "MART_cube_municipality_vaccine",
    oracle.over_geo(
        oracle.grouped(", ".join(MARTS["state_municipality_vaccine_summary"].keys), source="enriched")
    ),
)
def municipality_from_cubes(spark, sf_dir):
    name = "state_municipality_vaccine_summary"
    mart = MARTS[name]
    records = curated(spark, sf_dir, *mart.record_keys, "regiao_paciente", *QUALITY_FLAGS)
    return build_marts(records, geography(spark, sf_dir), [name])[name]


@query(
    "AGG_16_missing_key",
    oracle.over_curated(oracle.grouped("uf_paciente, sg_vacina")),
)
def group_count_missing_key(spark, sf_dir):
    """A key the frame lacks is left out of the grouping."""
    records = curated(spark, sf_dir, "uf_paciente", "sg_vacina")
    return rollups.group_count(records, ["uf_paciente", "nome_etnia_indigena_paciente", "sg_vacina"])


_LEGACY = ("uf_paciente", "sexo_paciente", "faixa_etaria", "sg_vacina", "descricao_vacina")


@query(
    "AGG_16_legacy_totals",
    oracle.over_curated(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS mart, count(*) AS mart_groups, CAST(sum(n) AS BIGINT) AS total "
            f"FROM (SELECT count(*) AS n FROM curated GROUP BY {keys})"
            for name, keys in {
                "state_vaccination_summary": "uf_paciente",
                "vaccine_type_summary": "sg_vacina, descricao_vacina",
                "age_group_summary": "faixa_etaria",
                "sex_summary": "sexo_paciente",
                "monthly_vaccine_type_summary": "sg_vacina, descricao_vacina",
                "state_vaccine_type_summary": "uf_paciente, sg_vacina, descricao_vacina",
                "municipality_vaccination_summary": "uf_paciente",
                "state_municipality_vaccine_summary": "uf_paciente, sg_vacina, descricao_vacina",
            }.items()
        )
    ),
)
def legacy_totals(spark, sf_dir):
    """Summaries of a frame that lacks some keys and all quality flags."""
    made = legacy_marts(curated(spark, sf_dir, *_LEGACY))
    totals = [
        df.agg(
            F.lit(name).alias("mart"),
            F.count("*").alias("mart_groups"),
            F.sum("doses_aplicadas").alias("total"),
        )
        for name, df in made.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), totals)


@query("AGG_17_quality_rollup", oracle.over_curated(oracle.quality("regiao_paciente, sexo_paciente")))
def quality_by_region_and_sex(spark, sf_dir):
    keys = ["regiao_paciente", "sexo_paciente"]
    return rollups.quality_rollup(curated(spark, sf_dir, *keys, *QUALITY_FLAGS), keys)


@query(
    "AGG_18_vaccine_dictionary",
    oracle.over_curated(
        oracle.grouped("codigo_vacina, sg_vacina, descricao_vacina", "registros_observados")
    ),
)
def dictionary(spark, sf_dir):
    return rollups.vaccine_dictionary(
        curated(spark, sf_dir, "codigo_vacina", "sg_vacina", "descricao_vacina")
    )


_DEDUP = ("l_orderkey", "sexo_paciente", "data_vacina", "data_deletado_rnds")
_DEDUP_SQL = ", ".join(_DEDUP)
# Every record of orders divisible by three arrives twice, the second time from
# another patient; the patient is a sensitive column and not compared.
_COPIES_SQL = f"""copies AS (
  SELECT {_DEDUP_SQL}, 'p' || CAST(l_linenumber AS VARCHAR) AS codigo_paciente FROM doses
  UNION ALL
  SELECT {_DEDUP_SQL}, 'q' || CAST(l_linenumber AS VARCHAR) FROM doses WHERE l_orderkey % 3 = 0
)"""


def _copies(spark, sf_dir):
    records = doses(spark, sf_dir, *_DEDUP, "l_linenumber")

    def patient(letter):
        return F.concat(F.lit(letter), F.col("l_linenumber").cast("string"))

    first = records.withColumn("codigo_paciente", patient("p")).drop("l_linenumber")
    again = records.filter("l_orderkey % 3 = 0").withColumn("codigo_paciente", patient("q"))
    return first.unionByName(again.drop("l_linenumber"))


@query(
    "AGG_19_dedup",
    f"WITH {oracle.DOSES}, {_COPIES_SQL} SELECT l_orderkey, sexo_paciente, "
    "CAST(data_vacina AS VARCHAR) AS data_vacina, "
    "CAST(data_deletado_rnds AS VARCHAR) AS data_deletado_rnds, "
    f"min(codigo_paciente) AS codigo_paciente FROM copies GROUP BY {_DEDUP_SQL}",
)
def dedup(spark, sf_dir):
    kept = drop_exact_duplicates(_copies(spark, sf_dir))
    dates = {c: F.col(c).cast("string") for c in ("data_vacina", "data_deletado_rnds")}
    return kept.withColumns(dates)


@query(
    "AGG_19_dedup_counts",
    f"WITH {oracle.DOSES}, {_COPIES_SQL}, grouped AS (SELECT count(*) AS n FROM copies "
    f"GROUP BY {_DEDUP_SQL}) SELECT CAST(sum(n) AS BIGINT) AS original_records, "
    "count(*) AS processed_records, CAST(sum(n - 1) AS BIGINT) AS removed_duplicate_records "
    "FROM grouped",
)
def dedup_counts(spark, sf_dir):
    return duplicate_counts(_copies(spark, sf_dir))


@query(
    "AGG_19_dedup_texts",
    "SELECT count(*) AS processed_records, CAST(sum(length(text)) AS BIGINT) AS characters "
    "FROM (SELECT DISTINCT text, lang FROM documents)",
)
def dedup_texts(spark, sf_dir):
    """Whole texts are compared, however long."""
    texts = drop_exact_duplicates(table(spark, sf_dir, "documents").select("text", "lang"))
    return texts.agg(
        F.count("*").alias("processed_records"), F.sum(F.length("text")).alias("characters")
    )


@query(
    "AGG_31_mart_again",
    oracle.over_curated(
        "SELECT regiao_paciente, CAST(sum(doses_aplicadas) AS BIGINT) AS doses_aplicadas FROM ("
        + oracle.grouped("uf_paciente, regiao_paciente")
        + ") GROUP BY regiao_paciente"
    ),
)
def mart_again(spark, sf_dir):
    """A summary of a summary."""
    by_state = rollups.group_count(
        curated(spark, sf_dir, "uf_paciente", "regiao_paciente"), ["uf_paciente", "regiao_paciente"]
    )
    return by_state.groupBy("regiao_paciente").agg(F.sum("doses_aplicadas").alias("doses_aplicadas"))


@query(
    "AGG_32_two_rates",
    oracle.over_curated(
        "SELECT uf_paciente, total_registros, registros_completos, idades_validas, "
        "pct_completude, pct_idade_valida FROM (" + oracle.quality("uf_paciente") + ")"
    ),
)
def two_rates(spark, sf_dir):
    flags = ("registro_completo", "idade_valida")
    records = curated(spark, sf_dir, "uf_paciente", *flags)
    return rollups.quality_rollup(records, ["uf_paciente"], flags)
