"""The entry point works with and without the training-data subpackage."""
import __spark_entry__ as E


def test_queries_without_the_llm_subpackage(monkeypatch):
    monkeypatch.setattr(E, "find_spec", lambda name: None)
    names = set(E.queries())
    assert names and not any(n.startswith("op") or n == "pipeline" for n in names)
    assert set(E.oracle_sql()) <= names


def test_every_core_query_has_an_oracle(monkeypatch):
    monkeypatch.setattr(E, "find_spec", lambda name: None)
    assert set(E.queries()) == set(E.oracle_sql())


def test_core_does_not_import_the_llm_subpackage():
    import subprocess
    import sys
    code = ("import sys; from quarry.plans import registry; registry.queries(); "
            "assert not any(m.startswith('quarry.llm') for m in sys.modules)")
    subprocess.run([sys.executable, "-c", code], check=True)
