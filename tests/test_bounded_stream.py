"""Dedup of a stream within a bound, against a plain version that keeps every sighting."""

import random
from datetime import datetime, timedelta

import pytest

from dosewright.streaming import bounded

START = datetime(2024, 1, 1)


def plain(batches, bound):
    """Records and times that stay: compared with all seen before, and earlier in the batch."""
    seen, kept = [], []
    for batch in batches:
        now = []
        for k, hours in sorted(batch, key=lambda r: (r[1] is not None, r[1] or 0)):
            if hours is None:
                kept.append((k, None))
                continue
            before = any(k == j and abs(hours - h) <= bound for j, h in seen)
            if not before and not any(k == j and hours - h <= bound for j, h in now):
                kept.append((k, hours))
            now.append((k, hours))
        seen += now
    return sorted(kept, key=str)


def write(spark, source, batch):
    rows = [(k, None if h is None else START + timedelta(hours=h), f"secret {i}") for i, (k, h) in enumerate(batch)]
    spark.createDataFrame(rows, "k string, t timestamp, codigo_paciente string").coalesce(1).write.mode("append").parquet(source)


def stream(spark, source):
    schema = "k string, t timestamp, codigo_paciente string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


def kept(spark, root):
    rows = bounded.kept_rows(spark, root).collect()
    return sorted(((r.k, None if r.t is None else (r.t - START).total_seconds() / 3600) for r in rows), key=str)


def test_copies_over_batches(spark, tmp_path):
    batches = [
        [("a", 0), ("a", 0), ("b", 5), (None, 1), ("n", None), ("n", None)],
        [("a", 24), ("b", 30), (None, 2), ("a", 48.5)],  # at the bound, beyond it, nulls equal, chained
        [("late", 3), ("b", 4), ("a", 500)],  # late and new, late and a copy
        [("a", 1)],  # a copy whose sighting is let go by then
    ]
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for batch in batches[:2]:
        write(spark, source, batch)
    bounded.write_without_copies(stream(spark, source), root, checkpoint, "t", "24 hours").awaitTermination()
    assert kept(spark, root) == plain(batches[:2], 24)
    for batch in batches[2:]:
        write(spark, source, batch)
        bounded.write_without_copies(stream(spark, source), root, checkpoint, "t", "24 hours").awaitTermination()
    assert kept(spark, root) == sorted([*plain(batches[:3], 24), ("a", 1)], key=str)
    assert len(list((tmp_path / "out" / "seen").glob("batch=*"))) == 2
    assert not list((tmp_path / "out" / "work").glob("batch=*"))


def test_any_batches(spark, tmp_path):
    rng = random.Random(3)
    batches = [[(rng.choice("abcde"), rng.choice([None, *range(120)])) for _ in range(25)] for _ in range(4)]
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in batches:
        write(spark, source, batch)
    for again in range(2):  # all batches a second time: each writes the same again
        query = bounded.write_without_copies(
            stream(spark, source), root, str(tmp_path / f"checkpoint{again}"), "t", "7 hours", lateness="30 days"
        )
        query.awaitTermination()
        assert kept(spark, root) == plain(batches, 7)


def test_nothing_and_clashing_names(spark, tmp_path):
    source = str(tmp_path / "in")
    write(spark, source, [])
    bounded.write_without_copies(stream(spark, source), str(tmp_path / "out"), str(tmp_path / "c"), "t", "1 day").awaitTermination()
    with pytest.raises(ValueError):
        bounded.write_without_copies(stream(spark, source).withColumnRenamed("k", "_row"), "x", "y", "t", "1 day")
