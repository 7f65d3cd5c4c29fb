"""The entry module with and without the optional corpus operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WITHOUT = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith('lexmill.llm') or name == 'corpus_pipeline':
            raise ImportError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries()), sorted(e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_without_corpus_operators():
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, check=True, timeout=120)


def test_oracles_name_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
