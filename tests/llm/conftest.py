import pytest

from lapwise.llm.shipping import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    """The Python workers can import the package."""
    ship(spark)
