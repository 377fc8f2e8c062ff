import pytest

from tidewatch.functions.params import bounded_int, positive_int, required_name


@pytest.mark.parametrize("value", [0, "0", "bad", "169", 169, "1.5", " 5", "1_0", True, -1])
def test_hours_out_of_bounds(value):
    with pytest.raises(ValueError, match="invalid hours"):
        bounded_int("hours", value, 24, 1, 168)


@pytest.mark.parametrize("value,want", [(None, 24), ("", 24), ("1", 1), ("+7", 7), (168, 168)])
def test_hours_accepted(value, want):
    assert bounded_int("hours", value, 24, 1, 168) == want


@pytest.mark.parametrize("value", [0, 101])
def test_limit_out_of_bounds(value):
    with pytest.raises(ValueError, match="invalid limit"):
        bounded_int("limit", value, 10, 1, 100)


@pytest.mark.parametrize("value", [None, "", "   "])
def test_blank_repo(value):
    with pytest.raises(ValueError, match="repo is required"):
        required_name("repo", value)


def test_repo_is_trimmed():
    assert required_name("repo", " a/b ") == "a/b"


def test_positive_int():
    assert positive_int("events", 1) == 1
    with pytest.raises(ValueError, match="events must be at least 1"):
        positive_int("events", 0)
