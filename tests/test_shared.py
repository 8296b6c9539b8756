import pytest

from loomstead.sources import shared


class Elsewhere:
    """A session on a cluster without the setting."""

    class conf:
        get = staticmethod(lambda name, default: default)

    class sparkContext:
        master = "spark://host:7077"


def test_no_folder_of_one_machine_on_a_cluster():
    with pytest.raises(ValueError, match="share"):
        shared.shared_folder(Elsewhere)


def test_cuts_are_written_and_dropped(spark):
    import os

    cuts = shared.Cuts(spark, "t")
    one = cuts.cut(spark.range(3), "x")
    path = one.cut_path.removeprefix("file://")
    assert one.count() == 3 and os.path.isdir(path)
    cuts.drop(one)
    assert not os.path.isdir(path)


def test_a_broken_subpackage_is_an_error(monkeypatch):
    import importlib

    import __spark_entry__ as entry

    def broken(missing):
        def load(name):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)

        return load

    monkeypatch.setattr(importlib, "import_module", broken("loomstead.llm"))
    assert "corpus_build" in entry.queries() and not any(n.startswith("p1_") for n in entry.queries())
    monkeypatch.setattr(importlib, "import_module", broken("numpy_of_another_world"))
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
