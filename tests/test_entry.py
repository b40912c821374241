"""The driver contract without the optional text operators."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

from faretrail import registry

ROOT = Path(__file__).resolve().parent.parent


def listed(without: str) -> list[str]:
    """Names of the queries in a fresh interpreter in which ``without`` can't be imported."""
    code = f"""
        import sys
        class Missing:
            def find_spec(self, name, path=None, target=None):
                if name == {without!r} or name.startswith({without + "."!r}):
                    raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
        sys.meta_path.insert(0, Missing())
        import __spark_entry__ as e
        assert set(e.oracle_sql()) <= set(e.queries())
        print(",".join(sorted(e.queries())))
    """
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", textwrap.dedent(code)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.strip().split(",")


@pytest.mark.parametrize("without", ["ahocorasick", "xxhash", "sentencepiece", "faretrail.llm", "corpus_pipeline"])
def test_warehouse_queries_list_without_a_text_library(without):
    names = set(listed(without))
    assert set(registry.queries()) <= names
    assert not [n for n in names - set(registry.queries()) if without in ("faretrail.llm", "corpus_pipeline")]
