import os
import subprocess
import sys

import __spark_entry__
from conftest import ROOT


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_subpackage(tmp_path):
    """The rest imports and lists its queries where the subpackage and the pipeline are gone."""
    for name in os.listdir(ROOT):
        if name not in ("colloquy", "corpus_pipeline.py", ".git", "tests"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "colloquy")
    for name in os.listdir(f"{ROOT}/colloquy"):
        if name != "llm":
            os.symlink(f"{ROOT}/colloquy/{name}", tmp_path / "colloquy" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'search_pipeline' in q and not any(n.startswith('op') and n[2].isdigit() for n in q); e.oracle_sql()"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, check=True)
