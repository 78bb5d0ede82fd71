import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from threshline.functions import entries as E
from threshline.operators import reports, shuffles
from threshline.storage import tables_written

SCHEMA = "_ord string, id string, other int"


def by_all_pairs(rows, n, size):
    """The same by every epoch's batches written out."""
    every = rows.distinct().filter("id IS NOT NULL").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    place = F.row_number().over(Window.partitionBy("epoch").orderBy(E.order_key(F.col("_ord"), F.col("epoch")), "_ord"))
    return reports.epoch_uniqueness(every.select("epoch", "id", F.floor((place - 1) / size).alias("batch_id"))).first()


def odd_rows():
    rows = [(f"r{i}", f"{i % 400}", 0) for i in range(1000)]  # two or three rows an id
    rows += [(f"h{i}", "hot", 0) for i in range(shuffles.HOT_ROWS + 20)]
    rows += [(f"s{i}", f"single {i}", None) for i in range(300)]
    rows += [(f"n{i}", None, 0) for i in range(50)] + [(f"e{i}", "", 0) for i in range(3)]
    return rows + rows[:40] + [(f"r{i}", f"{i % 400}", 1) for i in range(40)]  # equal rows; rows of one order


@pytest.mark.parametrize(("n", "size", "groups"), [(3, 10, 1 << 21), (3, 10, 30), (2, 7, 1), (4, 3, 200)])
def test_as_by_all_pairs(spark, monkeypatch, n, size, groups):
    monkeypatch.setattr(shuffles, "GROUPS", groups)
    rows = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    before = tables_written()
    assert tuple(shuffles.shuffle_uniqueness(rows, n, size).first()) == pytest.approx(tuple(by_all_pairs(rows, n, size)), rel=1e-12)
    assert tables_written() == before


def test_few_rows(spark):
    none = spark.createDataFrame([("a", None, 0)], SCHEMA)
    assert tuple(shuffles.shuffle_uniqueness(none, 3, 10).first()) == (None, None)
    one = spark.createDataFrame([("a", "x", 0), ("b", "x", 0)], SCHEMA)
    assert tuple(shuffles.shuffle_uniqueness(one, 3, 10).first()) == (100.0, 0.0)


def test_pairs_are_made_of_few_rows(spark, monkeypatch):
    """Pairs of all neighbours are some hundred times the table, too many for its disk."""
    sizes = []
    monkeypatch.setattr(shuffles, "neighbours", lambda placed: sizes.append(placed.count()) or reports.neighbours(placed))
    rows = spark.range(20_000).select(F.concat(F.lit("r"), "id").alias("_ord"), F.col("id").cast("string").alias("id"))
    got = tuple(shuffles.shuffle_uniqueness(rows, 3, 10).first())
    assert got == pytest.approx(tuple(by_all_pairs(rows, 3, 10)), rel=1e-12)
    assert 0 < sizes[0] < 3 * 20_000 / 10


def test_what_was_shuffled_goes_from_disk(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    with shuffles.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == was
