import pytest

from tidemark.sources import publish

SCHEMA = "id int, text string"


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"t{i}") for i in ids], SCHEMA)


def test_the_last_finished_run_is_the_table(spark, tmp_path, rows):
    place = f"{tmp_path}/zone/headlines"
    assert publish.read_published(spark, place, SCHEMA).count() == 0
    assert publish.publish(frame(spark, 1, 2), place, "r1") == 2
    assert publish.publish(frame(spark, 3), place, "r2", "append") == 1
    assert rows(publish.read_published(spark, place, SCHEMA)) == [(1, "t1"), (2, "t2"), (3, "t3")]
    assert publish.publish(frame(spark, 9), place, "r3") == 1
    assert rows(publish.read_published(spark, place, SCHEMA)) == [(9, "t9")]
    with pytest.raises(ValueError):
        publish.publish(frame(spark, 1), place, "r4", "ignore")


def test_a_replay_adds_nothing(spark, tmp_path, rows):
    place = f"{tmp_path}/log"
    for _ in range(2):
        assert publish.publish(frame(spark, 1, 2), place, "batch-1", "append") == 2
    assert publish.publish(frame(spark, 5), place, "batch-1", "append") == 2
    assert rows(publish.read_published(spark, place, SCHEMA)) == [(1, "t1"), (2, "t2")]
    assert publish.manifest(spark, place).count() == 1


def test_a_run_that_dies_leaves_the_old_table(spark, tmp_path, rows, monkeypatch):
    place = f"{tmp_path}/zone"
    publish.publish(frame(spark, 1), place, "r1")
    # Dies while it writes: a row that cannot be computed; and after it has written, before its row is in the manifest.
    broken = frame(spark, 2, 3).selectExpr("cast(if(id = 3, raise_error('killed'), id) as int) as id", "text")
    with pytest.raises(Exception, match="killed"):
        publish.publish(broken, place, "r2")
    frame(spark, 7).write.parquet(f"{place}/data/r3-lost")
    assert rows(publish.read_published(spark, place, SCHEMA)) == [(1, "t1")]
    assert publish.publish(frame(spark, 4), place, "r2") == 1
    assert rows(publish.read_published(spark, place, SCHEMA)) == [(4, "t4")]
