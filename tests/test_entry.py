"""The entry module without the training-data folders, and without a package they need."""

import json
import os
import re
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = ("import sys, json; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e;"
         "print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))")


def _names(root, *, before=""):
    run = subprocess.run([sys.executable, "-c", before + NAMES, root], capture_output=True, text=True,
                         cwd=root, check=True)
    return json.loads(run.stdout)


def _core(names):
    return [n for n in names if not re.match(r"op\d+_|pipeline$", n)]


def _copy(root, *without):
    shutil.copytree(ROOT, root, ignore=lambda d, names: [
        n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(d, n), ROOT) in without])


def test_core_queries_outlive_the_training_data_folders(tmp_root):
    whole = _names(ROOT)
    core = _core(whole[0])
    assert len(core) >= 65
    for i, without in enumerate([("sluice/llm", "tests/llm", "corpus_pipeline.py"), ("sluice/llm", "tests/llm")]):
        _copy(f"{tmp_root}/{i}", *without)
        queries, oracles = _names(f"{tmp_root}/{i}")
        assert queries == core
        assert set(oracles) <= set(core) and len(oracles) >= 65


def test_core_queries_outlive_a_missing_package():
    missing = "import sys; sys.modules['tokenizers'] = sys.modules['ahocorasick'] = None;"
    queries, _ = _names(ROOT, before=missing)
    assert len(_core(queries)) >= 65
