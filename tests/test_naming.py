import pytest

from reviewgrain.functions.naming import normalise_name, snake_case


@pytest.mark.parametrize(
    "name, expected",
    [
        ("starCount", "star_count"),
        ("StarCountTotal", "star_count_total"),
        ("seen from above", "seen_from_above"),
        ("already_snake", "already_snake"),
        ("XMLFileName", "xml_file_name"),
        ("-odd--marks-", "odd_marks"),
        ("a", "a"),
        ("", ""),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


@pytest.mark.parametrize(
    "name, expected",
    [
        ("row _key", "row_key"),
        (" review   _day ", "review_day"),
        ("plain", "plain"),
        ("SourceURL", "source_url"),
    ],
)
def test_normalise_name(name, expected):
    assert normalise_name(name) == expected
