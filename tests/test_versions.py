"""Tables in versions: only touched buckets are rewritten, old versions stay, two writers do not overwrite each other."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import documents as docs
from millrace.session import scratch
from millrace.sources.versions import KeyedTable, Moved, Store, key_bucket


@pytest.fixture
def table(spark):
    made = KeyedTable(spark, scratch(spark, "table"), "k", buckets=16)
    made.create(spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.col("id").alias("n")))
    return made


def changes(spark, rows):
    return spark.createDataFrame(rows, "k long, op string, v string, n long")


def test_batches_equal_the_whole_table(spark, table):
    rows = table.read()
    batches = [[(1, "update", "x", None), (2, "delete", None, None)], [(500, "insert", "new", 5), (1, "insert", "no", 9)], [(900, "delete", None, None)]]
    for number, batch in enumerate(batches, 2):
        change = changes(spark, batch)
        whole = docs.apply_changes(rows, change, "k", "op")
        touched = {r[0] for r in change.select(key_bucket("k", 16)).collect()}
        assert table.apply(change).number == number
        assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, whole.collect()))
        assert table.rewritten(number) == len(touched) <= 2
        rows = table.read()
    assert table.read(1).count() == 200 and table.read(2).count() == 199
    assert [tuple(r) for r in table.find([1, 500, 2]).orderBy("k").collect()] == [(1, "x", 1), (500, "new", 5)]


def test_untouched_buckets_keep_their_files(spark, table):
    before = table.store.version().parts
    table.apply(changes(spark, [(7, "delete", None, None)]))
    now = table.store.version().parts
    assert sum(now.get(b) != before[b] for b in before) == 1


def test_a_slower_writer_starts_again(spark, table, monkeypatch):
    """Another commit between reading and pointing: the batch is applied to what the other one left."""
    other = KeyedTable(spark, table.store.path, "k", buckets=16)
    write, seen = Store.write, []

    def slow(self, rows, bucket):
        out = write(self, rows, bucket)
        if self is table.store and not seen:
            seen.append(other.apply(changes(spark, [(1, "update", "other", None)])).number)
        return out

    monkeypatch.setattr(Store, "write", slow)
    made = table.apply(changes(spark, [(1, "update", None, 77), (3, "delete", None, None)]))
    assert seen == [2] and made.number == 3
    assert [tuple(r) for r in table.find([1, 3]).collect()] == [(1, "other", 77)]
    seen.clear()
    with pytest.raises(Moved):
        table.apply(changes(spark, [(5, "delete", None, None)]), attempts=1)
    assert table.find([5]).count() == 1  # nothing half done


def test_vacuum_keeps_what_is_pointed_to(spark, table):
    for k in (1, 2, 3):
        table.apply(changes(spark, [(k, "delete", None, None)]))
    assert table.store.vacuum(keep=2) >= 1
    assert table.store.numbers() == [3, 4]
    assert table.read().count() == 197 and table.read(3).count() == 198


def test_edges(spark, table):
    with pytest.raises(Moved):
        table.create(table.read())
    with pytest.raises(ValueError, match="repeated key"):
        KeyedTable(spark, scratch(spark, "t"), "k").create(spark.createDataFrame([(1,), (1,)], "k int"))
    with pytest.raises(ValueError, match="no version"):
        KeyedTable(spark, scratch(spark, "t"), "k").read()
    assert table.apply(changes(spark, [])).number == 1
    empty = KeyedTable(spark, scratch(spark, "t"), "k", buckets=4)
    empty.create(spark.createDataFrame([], "k long, v string, n long"))
    assert empty.read().count() == 0
    empty.apply(changes(spark, [(None, "insert", "no key", 1), (4, "insert", "four", 4)]))
    assert sorted(map(tuple, empty.read().collect()), key=repr) == [(4, "four", 4), (None, "no key", 1)]
    empty.apply(changes(spark, [(4, "delete", None, None)]))
    assert empty.read().count() == 1
