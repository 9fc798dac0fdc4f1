import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def quick_training(monkeypatch):
    """Few training steps, for tests that are not about what the network learns."""
    from kestrel.llm import pii
    monkeypatch.setattr(pii, "STEPS", 10)
