"""The driver's contract, also without the subpackage for training data."""

import os
import shutil
import subprocess
import sys

import __spark_entry__

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() == 1 and {"added", "removed", "changed"} <= set(df.columns)
    assert tuple(df.select("added", "changed", "removed").first()) == (11, 39, 15)


def test_oracles_belong_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_training_data_operators(tmp_path):
    shutil.copytree(HERE, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True)
