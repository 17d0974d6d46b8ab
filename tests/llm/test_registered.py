"""The registered queries: against SQL where there is some, and the guard around the subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.statements import STATEMENTS
from tallyloom.plans.registry import QUERIES as REST
from tests.llm.conftest import DATA

ROOT = Path(__file__).resolve().parents[2]


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", STATEMENTS)
def test_query_equals_its_sql(shipped, second, name):
    df = QUERIES[name](shipped, DATA)
    columns = sorted(df.columns)
    expected = second.sql(STATEMENTS[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    wanted = [tuple(row[i] for i in order) for row in expected.fetchall()]
    got = [tuple(row) for row in df.select(*columns).collect()]
    assert got and _sorted(got) == _sorted(wanted)


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items()
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {hidden!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


@pytest.mark.parametrize("hidden", ["", "public_tokenizers", "ahocorasick", "xxhash", "regex", "zstandard", "tiktoken"])
@pytest.mark.parametrize("without", [True, False])
def test_the_rest_works_without_the_subpackage_and_its_packages(tmp_path, without, hidden):
    """A copy without the two parts, or where a package cannot be imported, registers all other queries."""
    for name in ("__spark_entry__.py", "tallyloom", *([] if without else ["corpus_pipeline.py"])):
        source = ROOT / name
        if source.is_dir():
            left_out = ("llm", "__pycache__") if without else ("__pycache__",)
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns(*left_out))
        else:
            shutil.copy(source, tmp_path / name)
    code = HIDE.format(hidden={hidden})
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    found, all_, rest = int(said.stdout.split()[0]), len(entry.queries()), len(REST)
    assert rest == all_ - len(QUERIES) - 1
    assert found == rest if without or hidden in ("public_tokenizers", "ahocorasick") else found in (rest, all_)
    assert ("left out" in said.stderr) == (found == rest)


def test_nothing_else_imports_the_subpackage():
    for source in (ROOT / "tallyloom").rglob("*.py"):
        if "llm" not in source.parts:
            assert "tallyloom.llm" not in source.read_text()
