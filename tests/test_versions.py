import pytest

from feedpulse.sources import versions

SCHEMA = "day string, n long"


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


@pytest.fixture
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def table(spark, path, schema, *args):
    return sorted(tuple(r) for r in versions.read(spark, path, schema, *args).collect())


def test_parts_are_replaced(spark, tmp_path, make, schema):
    path = str(tmp_path)
    assert table(spark, path, schema) == [] and versions.versions(spark, path) == []
    assert versions.replace(path, {"a": make(("a", 1)), "b": make(("b", 1))}) == 1
    assert versions.replace(path, {"b": make(("b", 2), ("b", 3))}) == 2
    assert table(spark, path, schema) == [("a", 1), ("b", 2), ("b", 3)]
    assert table(spark, path, schema, ["b", "c"]) == [("b", 2), ("b", 3)]
    assert table(spark, path, schema, None, 1) == [("a", 1), ("b", 1)]
    versions.replace(path, {"b": make()})
    assert table(spark, path, schema) == [("a", 1)]
    versions.commit(spark, path, {"a": None})
    assert table(spark, path, schema) == []
    with pytest.raises(ValueError, match="no version 9"):
        versions.parts(spark, path, 9)


@pytest.mark.parametrize("step", ["write_aside", "_propose", "between"])
def test_a_stop_at_any_step_leaves_the_old_rows(spark, tmp_path, make, schema, monkeypatch, step):
    path = str(tmp_path)
    versions.replace(path, {"a": make(("a", 1)), "b": make(("b", 1))})

    def stop(*args):
        raise KeyboardInterrupt

    if step == "between":  # the rows are aside, the list's file is written, but not in its place
        real = versions._files

        def files(spark, place):
            found, system = real(spark, place)
            if place.endswith("2.json"):
                stop()
            return found, system

        monkeypatch.setattr(versions, "_files", files)
    else:
        monkeypatch.setattr(versions, step, stop)
    with pytest.raises(KeyboardInterrupt):
        versions.replace(path, {"a": make(("a", 2))})
    monkeypatch.undo()
    assert table(spark, path, schema) == [("a", 1), ("b", 1)]
    versions.replace(path, {"a": make(("a", 3))})
    assert table(spark, path, schema) == [("a", 3), ("b", 1)]
    versions.clean(spark, path, keep=1)
    assert table(spark, path, schema) == [("a", 3), ("b", 1)]
    assert len(versions.entries(spark, f"{path}/{versions.ROWS}")) == 2


def test_two_writers(spark, tmp_path, make, schema, monkeypatch):
    path = str(tmp_path)
    versions.replace(path, {"a": make(("a", 1))})
    real, others = versions._propose, iter([("b", 2), ("c", 3)])

    def propose(*args):
        other = next(others, None)
        if other:  # another writer commits first
            folder = versions.write_aside(make(other), path)
            listed = {**versions.parts(spark, path), other[0]: folder}
            assert real(spark, path, versions.versions(spark, path)[-1] + 1, listed)
        return real(*args)

    monkeypatch.setattr(versions, "_propose", propose)
    assert versions.replace(path, {"a": make(("a", 4))}) == 4
    assert table(spark, path, schema) == [("a", 4), ("b", 2), ("c", 3)]


def test_a_writer_gives_up_in_the_end(spark, tmp_path, make, monkeypatch):
    monkeypatch.setattr(versions, "_propose", lambda *args: False)
    with pytest.raises(versions.Taken):
        versions.replace(str(tmp_path), {"a": make(("a", 1))})


def test_readers_keep_their_version(spark, tmp_path, make, schema):
    path = str(tmp_path)
    versions.replace(path, {"a": make(("a", 1))})
    reader = versions.read(spark, path, schema)
    versions.replace(path, {"a": make(("a", 2))})
    assert [tuple(r) for r in reader.collect()] == [("a", 1)]
