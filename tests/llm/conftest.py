import os

import pytest


@pytest.fixture(scope="session")
def more_labels(sf_dir):
    """The sample folder with enough labels to hold some out."""
    return os.path.join(os.path.dirname(sf_dir), "sf0.01")
