"""Ratios of many pairs are those of each pair."""

from loomcast.functions import text_udfs as U


def test_ratios_of_pairs():
    titles = ["", "A day", "a dAy out", "night and day", "nights and days", None, "zebra"]
    a, b = [x for x in titles for _ in titles], titles * len(titles)
    for least in (0.0, 0.75):
        assert U.title_ratios(a, b, least) == [U.title_ratio(x, y, least) for x, y in zip(a, b, strict=True)]
