"""The entry module without the optional subpackage."""

import subprocess
import sys
import textwrap


def test_queries_without_the_corpus_operators():
    code = textwrap.dedent("""
        import sys

        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name.startswith("zonepulse.llm"):
                    raise ModuleNotFoundError(name)

        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as E
        names = set(E.queries())
        assert "pipe_features" in names and set(E.oracle_sql()) <= names
        assert not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
    """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
