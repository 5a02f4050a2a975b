"""Tables in the shared folder, and what may be deleted."""

from pathlib import Path

from marketloom.session import discard, written


def test_only_written_tables_are_deleted(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/marketloom/given")
    given = spark.read.parquet(f"{tmp_path}/marketloom/given")
    made = written(given)
    folder = Path(made.inputFiles()[0].removeprefix("file://")).parent
    assert made.count() == 5 and folder.exists()
    discard(given, made)
    assert not folder.exists() and given.count() == 5


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    import pytest

    from marketloom import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Session)
