"""The library without its optional subpackage, and a plain session without any setting."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def run(code, cwd, **env):
    own = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | env
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, env=own, capture_output=True, text=True, timeout=300)


@pytest.mark.parametrize("pipeline,shell", [(False, False), (True, False), (True, True)])
def test_rest_works_without_the_optional_folders(tmp_path, pipeline, shell):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skip)
    if shell:
        # compiled files may be all that is left of the folder
        (copy / "ledgerbrook/llm/__pycache__").mkdir(parents=True)
    code = (
        "import __spark_entry__ as e, ledgerbrook.plans.queries as p, ledgerbrook.plans.oracles as o\n"
        "assert list(e.queries()) == list(p.registered()) and list(e.oracle_sql()) == list(o.registered())\n"
        "print(len(e.queries()))"
    )
    done = run(code, copy)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 85
    collected = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "tests", "-p", "no:cacheprovider", "--ignore=tests/test_standalone.py"],
        cwd=copy, capture_output=True, text=True, timeout=300,
    )
    assert collected.returncode == 0, collected.stdout[-2000:]


def test_faults_inside_the_optional_folders_are_not_hidden(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    (copy / "ledgerbrook/llm/common.py").write_text("import no_such_module\n")
    done = run("import __spark_entry__ as e; e.queries()", copy)
    assert done.returncode != 0 and "no_such_module" in done.stderr


def test_shared_folder_without_any_setting(tmp_path):
    """A plain local session names no folder: one is made and kept."""
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "from ledgerbrook.session import cut_lineage, shared_dir\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert cut_lineage(spark.range(3)).count() == 3\n"
        "assert shared_dir(spark) == shared_dir(spark)\n"
        "print('fine')"
    )
    done = run(code, tmp_path, SPARK_CONF_DIR=str(tmp_path), TMPDIR=str(tmp_path))
    assert done.returncode == 0 and "fine" in done.stdout, done.stderr[-2000:]
