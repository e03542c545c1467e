"""The entry points where modules that only the training-data operators need are missing."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent


@pytest.mark.parametrize("module", ["ahocorasick", "public_tokenizers", "sentencepiece", "numpy", "corpus_pipeline", "loadkit.llm"])
def test_core_queries_do_not_need(module):
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; print(set(e.QUERIES) <= set(e.queries()), set(e.ORACLES) <= set(e.oracle_sql()), len(e.ORACLES) > 90)"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == ["True", "True", "True"], run.stderr
