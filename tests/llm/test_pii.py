import pytest

from funnelspark.llm import pii

KEY = "k3Y_" * 23 + "x"
JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmN-HlO_w5N"


@pytest.mark.parametrize("value", [KEY, JWT, "ab/cd+ef012345678gh//ij==", "x1" * 5000])
def test_whole_values_are_masked(value):
    text = f"use token = {value}. Then go on"
    assert pii.masked(text, pii.find(text)) == "use token = [ACCOUNT]. Then go on"


@pytest.mark.parametrize("text", ["account 12.50 paid", "the secret of words.", "token a1 b2"])
def test_short_values_are_left(text):
    assert not pii.find(text)
