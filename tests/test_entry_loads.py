"""The registry loads without reading the Spark installation."""

import glob
import importlib
import sys


def test_registry_loads_when_no_jar_is_found(monkeypatch):
    monkeypatch.setattr(glob, "glob", lambda *a, **k: [])
    for name in [m for m in sys.modules if m == "wortlab.catalog.sqlparts"]:
        monkeypatch.delitem(sys.modules, name)
    importlib.import_module("wortlab.catalog.sqlparts")
    import __spark_entry__ as E

    assert len(E.queries()) > 100 and set(E.oracle_sql()) <= set(E.queries())


def test_stop_words_are_in_the_package():
    from wortlab.functions.text import spark_stop_words

    words = spark_stop_words("german")
    assert len(words) == len(set(words)) == 231 and {"und", "der", "nicht"} <= set(words)
