import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(len(entry.queries()), any(k.startswith("op") and k[2].isdigit() for k in entry.queries()), len(entry.oracle_sql()) > 200)
"""


def told(*names):
    return subprocess.run([sys.executable, "-W", "ignore", "-c", HIDE.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_rest_registers_without_the_training_data_part():
    for names in (["corpus_pipeline"], ["lodestat.llm"], ["xxhash"], ["zstandard"]):
        found = told(*names)
        assert found.returncode == 0, found.stderr
        count, with_llm, with_sql = found.stdout.split()
        assert int(count) > 280 and with_sql == "True"
        if names[0] in ("corpus_pipeline", "lodestat.llm"):
            assert with_llm == "False"


def test_missing_module_of_the_library_is_an_error():
    assert told("lodestat.plans.graph").returncode != 0
