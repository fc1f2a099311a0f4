from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.operators import chunks
from roadpulse.operators.chunks import assign_chunks, placed_chunks, write_chunks
from roadpulse.sinks.files import write_csv
from roadpulse.storage import materialise


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    keys=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=60),
    size=st.integers(1, 9),
)
def test_chunks_equal_brute_force(spark, keys, size):
    frame = spark.createDataFrame([(key, at) for at, key in enumerate(keys)], "k int, at int")
    got = assign_chunks(frame.repartition(3), ["k", "at"], size).collect()
    ordered = sorted(enumerate(keys), key=lambda pair: (pair[1] is not None, pair[1] or 0, pair[0]))
    want = {at: (place + 1, place // size + 1) for place, (at, _) in enumerate(ordered)}
    assert {row["at"]: (row["row_position"], row["chunk_id"]) for row in got} == want


def test_copies_spread_over_tasks(spark, monkeypatch):
    """A third of the rows are exact copies; positions stay whole and unique."""
    written = []

    def keep(rows, label):
        written.append(materialise(rows, label))
        return written[-1]

    monkeypatch.setattr(chunks, "materialise", keep)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(0, 30_000, numPartitions=6).select(
            F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("k")
        )
        got = assign_chunks(frame, ["k"], 1000, from_scan=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = {row["chunk_id"]: row["count"] for row in got.groupBy("chunk_id").count().collect()}
    assert sizes == {number: 1000 for number in range(1, 31)}
    assert got.select("row_position").distinct().count() == 30_000
    keys = [row["k"] for row in got.orderBy("row_position").select("k").collect()]
    assert keys == sorted(keys)
    copies = written[0].where("k = 500").groupBy(F.input_file_name()).count().collect()
    assert len(copies) > 1
    assert max(row["count"] for row in copies) < 10_000


def test_one_ordered_file_per_chunk(spark, tmp_path):
    frame = spark.range(0, 25, numPartitions=4).select((24 - F.col("id")).alias("k"), F.lit(" x ").alias("v"))
    path = str(tmp_path / "chunks")
    write_chunks(assign_chunks(frame, ["k"], 10), path)
    folders = sorted(folder.name for folder in (tmp_path / "chunks").glob("chunk=*"))
    assert folders == ["chunk=0001", "chunk=0002", "chunk=0003"]
    for number, folder in enumerate(folders):
        files = list((tmp_path / "chunks" / folder).glob("*.csv"))
        assert len(files) == 1
        want = ["k,v"] + [f"{k}, x " for k in range(number * 10, min(25, number * 10 + 10))]
        assert files[0].read_text().splitlines() == want


def test_only_chunks_on_a_border_are_shuffled(spark, tmp_path):
    """The plan's one exchange stands above the filter of border chunks, and little goes through it."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(0, 20_000, numPartitions=5).select((F.col("id") * 7919 % 20_000).alias("k"))
        assigned = assign_chunks(frame, ["k"], 100, from_scan=True, borders=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    placed = placed_chunks(assigned)
    plan = placed._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange REPARTITION") <= 1
    assert "Union" in plan and plan.count("rangepartitioning") == 0
    crossing = assigned.where("crosses_border").select("chunk_id").distinct().count()
    assert 0 < crossing <= 8
    tasks = placed.select("chunk_id", F.spark_partition_id().alias("task")).distinct().groupBy("chunk_id").count()
    assert tasks.where("count > 1").count() == 0
    write_chunks(assigned, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("chunk=*/*.csv"))
    assert len(files) == 200
    for file in files:
        number = int(file.parent.name.removeprefix("chunk="))
        assert file.read_text().split()[1:] == [str(k) for k in range((number - 1) * 100, number * 100)]


def test_no_rows(spark):
    assert assign_chunks(spark.range(0), ["id"], 5).count() == 0


def test_shuffled_input_is_written_before_it_is_numbered(spark, monkeypatch):
    labels = []

    def note(rows, label):
        labels.append(label)
        return materialise(rows, label)

    monkeypatch.setattr(chunks, "materialise", note)
    frame = spark.range(20).repartition(4)
    assert assign_chunks(frame, ["id"], 5).count() == 20
    assert labels == ["unchunked", "chunks"]
    labels.clear()
    assert assign_chunks(materialise(frame, "scan"), ["id"], 5, from_scan=True).count() == 20
    assert labels == ["chunks"]


def test_loose_chunks_need_no_shuffle(spark, tmp_path):
    write_csv(spark.range(25, numPartitions=2), str(tmp_path / "loose"), max_rows_per_file=10)
    sizes = [len(file.read_text().splitlines()) - 1 for file in (tmp_path / "loose").glob("*.csv")]
    assert sum(sizes) == 25 and max(sizes) <= 10
