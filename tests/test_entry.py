"""The entry point without the training-data subpackage, and what scratch leaves."""

import os
import shutil
import subprocess
import sys

import pytest

from tidemark.session import drop_scratch, listed, materialize, new_database, scratch_path

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("caches", [False, True])
def test_entry_without_the_subpackage(tmp_path, caches):
    """Also with left-over caches, which make an empty namespace of it."""
    ignored = shutil.ignore_patterns(".git", "__pycache__", "tests")
    shutil.copytree(REPO, tmp_path / "repo", ignore=lambda folder, names: set(ignored(folder, names)) | ({"llm", "corpus_pipeline.py"} & set(names)))
    if caches:
        os.makedirs(tmp_path / "repo/tidemark/llm/__pycache__")
    told = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') for n in e.queries()))"],
        cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120,
    )
    assert told.returncode == 0, told.stderr
    queries, dealt = map(int, told.stdout.split())
    assert queries > 100 and dealt == 0


def test_a_broken_subpackage_is_an_error(tmp_path):
    ignored = shutil.ignore_patterns(".git", "__pycache__", "tests")
    shutil.copytree(REPO, tmp_path / "repo", ignore=ignored)
    if not os.path.exists(tmp_path / "repo/corpus_pipeline.py"):
        pytest.skip("the subpackage is not part of this build")
    (tmp_path / "repo/corpus_pipeline.py").write_text("from tidemark.llm import nothing_of_this_name\n")
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert told.returncode != 0 and "nothing_of_this_name" in told.stderr


def test_drop_scratch_leaves_nothing(spark):
    path = scratch_path(spark, "kept")
    shared = path.rsplit("/", 1)[0]
    drop_scratch(spark)
    before = {name for name, _, _ in listed(spark, shared)}
    spark.range(3).write.parquet(scratch_path(spark, "export"))
    target = scratch_path(spark, "target")
    spark.range(3).write.parquet(target)
    spark.range(3).write.parquet(f"{target}__staged-1")
    materialize(spark.range(3), "aside")
    database = new_database(spark)
    spark.range(3).write.saveAsTable(f"{database}.t")
    assert len({name for name, _, _ in listed(spark, shared)} - before) == 5
    # the database takes its own folder with it
    assert drop_scratch(spark) == 4
    assert {name for name, _, _ in listed(spark, shared)} == before
    assert not spark.catalog.databaseExists(database)
