import os
import sys
from pathlib import Path

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE), str(HERE.parents[1])]
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE.parents[1]), os.environ.get("PYTHONPATH", "")])

import pytest  # noqa: E402

import cases  # noqa: E402
from twinledger.llm.textblocks import prepare  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return cases.documents(prepare(spark)).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return cases.none(prepare(spark))
