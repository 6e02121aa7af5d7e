"""Curation and duplicate removal as wholes, against brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dosewright import CurationSpec, curate
from dosewright.operators import lookups
from dosewright.operators.dedup import drop_exact_duplicates, duplicate_counts
from dosewright.plans.coverage import coverage, map_points
from dosewright.plans.marts import MARTS, build_mart, mart_from_cubes, stored_cubes
from dosewright.spec import TEXT_COLUMNS

RAW = "data_vacina string, uf_paciente string, numero_idade_paciente string, st_documento string, codigo_vacina string"
ROWS = [
    ("2025-01-14", " sp ", "35", "final", "087"),
    ("14/01/2025", "null", "-0.5", " FINAL ", " "),
    ("x", "\tmg\n", "131", None, None),
    (None, None, None, "rascunho", "87"),
]
quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def as_set(df):
    return sorted(map(repr, df.collect()))


def test_curating_twice_changes_nothing(spark):
    once = curate(spark.createDataFrame(ROWS, RAW))
    assert as_set(curate(once)) == as_set(once)


def test_partitioning_changes_nothing(spark):
    raw = spark.createDataFrame(ROWS * 10, RAW)
    assert as_set(curate(raw.repartition(7))) == as_set(curate(raw.coalesce(1)))


def test_curation_has_no_shuffle_and_no_python(spark):
    plan = curate(spark.createDataFrame(ROWS, RAW).repartition(2))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange") == 1 and "Python" not in physical


def test_alias_only_without_target(spark):
    both = spark.createDataFrame([("a", "b")], "sigla_vacina string, sg_vacina string")
    assert curate(both).first().sg_vacina == "B"


@quick
@given(st.lists(st.one_of(st.none(), st.text(max_size=8)), min_size=1, max_size=12))
def test_text_rule_is_the_python_rule(spark, texts):
    column = TEXT_COLUMNS[0]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {column} string")
    got = [r[column] for r in curate(df).orderBy("i").collect()]
    for raw, clean in zip(texts, got, strict=True):
        bare = None if raw is None else raw.strip()
        if bare is None or bare.upper() in ("", "NAN", "NONE", "NULL"):
            assert clean is None
        elif bare.isascii():
            assert clean == bare.upper()


@quick
@given(
    st.lists(
        st.tuples(*[st.sampled_from([None, "a", "b"])] * 3, st.sampled_from(["p", "q"])),
        min_size=1,
        max_size=30,
    )
)
def test_dedup_is_exact(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string, codigo_paciente string")
    kept = drop_exact_duplicates(df.repartition(3)).collect()
    least = {}
    for *key, patient in rows:
        least[tuple(key)] = min(patient, least.get(tuple(key), patient))
    assert sorted(map(repr, ((*k, v) for k, v in least.items()))) == sorted(
        repr(tuple(r)) for r in kept
    )
    counts = duplicate_counts(df).first()
    assert tuple(counts) == (len(rows), len(least), len(rows) - len(least))


def test_hot_copy_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 20000, 1, 4).select(F.lit("same").alias("a"), (F.col("id") % 2).alias("b"))
    kept = drop_exact_duplicates(df)
    assert kept.count() == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_hot_and_missing_keys_join_without_broadcast(spark):
    """A dimension too large to broadcast goes through the shuffle with the same result."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("000001"))
        .otherwise(F.lpad((F.col("id") % 50).cast("string"), 6, "0"))
        .alias("codigo_municipio_paciente")
    )
    geography = spark.range(60).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("codigo_municipio"),
        *(F.lit("x").alias(c) for c in ("nome_municipio_ibge", "uf_ibge", "nome_uf", "regiao_ibge", "nome_regiao")),
        F.col("id").cast("double").alias("latitude"),
        F.col("id").cast("double").alias("longitude"),
    )
    small = as_set(lookups.with_geography(facts, geography))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert as_set(lookups.with_geography(facts, geography)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(small) == 3000


def test_cubes_give_the_same_marts(spark):
    import __spark_entry__  # noqa: F401
    from entry_queries.binding import curated, geography

    sf = "/root/testdata/sf0.001"
    records = curated(spark, sf)
    geo = geography(spark, sf)
    cubes = stored_cubes(records)
    for name in ("quality_by_vaccine", "municipality_vaccination_summary", "vaccine_dictionary"):
        assert as_set(mart_from_cubes(cubes, name, geo)) == as_set(build_mart(records, name, geo)), name
    assert {m.cube for m in MARTS.values()} == set(cubes)


def test_map_of_nothing_and_of_one_point(spark):
    geo = spark.createDataFrame(
        [("000001", "A", "B", "C", 1.0, 2.0)],
        "codigo_municipio string, nome_municipio_ibge string, nome_uf string, nome_regiao string, "
        "latitude double, longitude double",
    )
    schema = (
        "uf_paciente string, regiao_paciente string, codigo_municipio_paciente string, "
        "nome_municipio_paciente string, doses_aplicadas bigint"
    )
    empty = spark.createDataFrame([], schema)
    assert {r.metric: r.value for r in coverage(empty, geo).collect()}["pct_mappable_doses"] == 0.0
    one = spark.createDataFrame([("U", "R", "1.0", "n", 5)], schema)
    from dosewright.plans.coverage import mappable_municipalities

    point = map_points(mappable_municipalities(one, geo)).first()
    assert (point.x, point.y, point.labelled, point.marker_size) == (None, None, True, 44.0)
    assert point.hover == "A - U<br>Doses aplicadas: 5"


def test_only_valid_documents(spark):
    raw = spark.createDataFrame(ROWS, RAW)
    assert curate(raw, CurationSpec(only_valid_documents=True)).count() == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_mart_reads_its_own_columns_only(spark):
    import __spark_entry__ as entries

    plan = plan_of(entries.queries()["AGG_07_sex_summary"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<l_returnflag:string>" in plan and "Join" not in plan


def test_dimension_meets_counted_rows(spark):
    import __spark_entry__ as entries

    name = "AGG_10_municipality_vaccination_summary"
    df = entries.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # In the printed tree a deeper operator comes later: join first, aggregate below it.
    assert plan.index("Join LeftOuter") < plan.index("Aggregate")


def test_stream_over_several_batches(spark, tmp_path):
    """State and metrics over files that arrive one per batch."""
    from dosewright.plans.reports import accumulate, long_form
    from dosewright.streaming import incremental

    source = str(tmp_path / "in")
    for rows in ([("a", 1), ("b", 1)], [("a", 2)], [("c", 3), ("c", 4)]):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(source)
    wanted = [("a", 2), ("b", 1), ("c", 2)]
    for mode, keys in (("complete", ()), ("update", ("k",))):
        root = str(tmp_path / mode)
        counts = incremental.running_counts(stream, ["k"], "n")
        incremental.write_running(counts, root, f"{root}-checkpoint", mode, keys, state_every=2).awaitTermination()
        batches = sorted(p.name for p in (tmp_path / mode).glob("batch=*"))
        assert batches[-1] == "batch=000000002"
        assert sorted(map(tuple, incremental.latest(spark, root).collect())) == wanted
        if mode == "complete":
            assert len(batches) == 2  # the whole state, and the one before
            continue
        assert [p.name for p in (tmp_path / mode).glob("state=*")] == ["state=000000001"]
        assert [tuple(r) for r in spark.read.parquet(f"{root}/{batches[-1]}").collect()] == [("c", 2)]  # what it changed
        # a batch that runs again: its entry in the log is lost, its files are written once more
        (tmp_path / f"{mode}-checkpoint/commits/2").unlink()
        (tmp_path / f"{mode}-checkpoint/commits/.2.crc").unlink(missing_ok=True)
        incremental.write_running(
            incremental.running_counts(stream, ["k"], "n"), root, f"{root}-checkpoint", mode, keys, state_every=2
        ).awaitTermination()
        assert sorted(map(tuple, incremental.latest(spark, root).collect())) == wanted
    with pytest.raises(ValueError, match="keys"):
        incremental.write_running(counts, root, f"{root}-checkpoint", "update")
    root = str(tmp_path / "metrics")
    incremental.write_batch_metrics(
        stream, root, f"{root}-checkpoint", lambda batch: long_form(batch.agg(F.count("*").alias("n")))
    ).awaitTermination()
    assert [tuple(r) for r in accumulate(spark.read.parquet(root)).collect()] == [("n", 5)]


def test_bounded_dedup_over_batches(spark, tmp_path):
    from dosewright.streaming import incremental

    source = str(tmp_path / "in")
    for minute in (1, 5, 3):
        rows = [("x", f"2025-01-01 00:0{minute}:00", f"p{minute}"), (f"only{minute}", "2025-01-01 00:02:00", "p")]
        frame = spark.createDataFrame(rows, "k string, t string, codigo_paciente string")
        frame.coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema("k string, t string, codigo_paciente string")
        .option("maxFilesPerTrigger", 1)
        .parquet(source)
    )
    kept = incremental.drop_duplicates_within(stream, "t", "1 day").select("k")
    out = str(tmp_path / "out")
    kept.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", f"{out}-checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["only1", "only3", "only5", "x"]
