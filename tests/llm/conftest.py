import random

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def words():
    """Invented words, the same in every run."""
    draw = random.Random(3)
    return ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
