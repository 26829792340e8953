import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture
def scratch(spark):
    from tidemark.llm.common import shared_folder

    return shared_folder(spark)
