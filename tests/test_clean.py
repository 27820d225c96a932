"""Cleaning rules on hand-written cells."""

from __future__ import annotations

import datetime as dt

from chartmart.functions import clean as c

D = dt.date(2023, 10, 18)


def test_clean_text(values):
    cells = ["\t a  b \n", "  ", "", None, "x y", "\x1cq\x1f", "None"]
    assert values(c.clean_text, cells) == ["a b", None, None, None, "x y", "q", "None"]


def test_clean_numeric(values):
    cells = ["1.0", "1.01", "abc", None, " 0.25 ", "-0.1", "1e-1", "nan", "inf", "", "1d", "0.5f"]
    assert values(lambda x: c.clean_numeric(x, 0, 1, 0.5), cells) == [
        1.0, 0.5, 0.5, 0.5, 0.25, 0.5, 0.1, 0.5, 0.5, 0.5, 0.5, 0.5,
    ]


def test_clean_numeric_open_ends(values):
    assert values(lambda x: c.clean_numeric(x, 1), ["0", "1", "1e9", "inf", "nan", "x"]) == [
        None, 1.0, 1e9, None, None, None,
    ]


def test_clean_boolean(values):
    cells = ["True", "1", "yes", "T", "1.0", " true", "false", "", None]
    assert values(c.clean_boolean, cells) == [True] * 4 + [False] * 5


def test_clean_date(values):
    cells = {
        "2023-10-18": D,
        "2023-10-18 00:00:00": D,
        "2023-10-18T01:02:03Z": D,
        "2023-10-18T01:02:03.123456": D,
        "2023-10-18 01:02:03.5": D,
        "2023-10-18T01:00:00+05:00": D,
        "2023-10-18 23:30:00-0800": D,
        "2023-10-18 23:30 UTC": D,
        "10/18/2023": D,
        "18/10/2023": D,
        "2023/10/18": D,
        "20231018": D,
        "2023-1-5": dt.date(2023, 1, 5),
        "2023-10": dt.date(2023, 10, 1),
        "2023": dt.date(2023, 1, 1),
        "3/4/2023": dt.date(2023, 3, 4),
        "10/18/2023 00:00": D,
        "10/18/2023 12:30:00": D,
        "18/10/2023 12:30": D,
        "Oct 18, 2023": D,
        "October 18, 2023": D,
        "18 October 2023": D,
        "18 Oct 2023": D,
        "10-18-2023": D,
        "18-10-2023": D,
        "10/18/23": D,
        "2023-10-18 9:05 PM": D,
        "13/13/2023": None,
        "bad": None,
        "": None,
        "  ": None,
        "2023-02-30": None,
        "2023-10-18 late": None,
    }
    assert dict(zip(cells, values(c.clean_date, list(cells)))) == cells


def test_split_artists(values):
    cells = ["A, ,B ,A", "", None, " One  Two ,", ",,"]
    assert values(c.split_artists, cells) == [["A", "B", "A"], [], [], ["One Two"], []]


def test_clean_country(values):
    assert values(c.clean_country, [" VN ", "", None, "  "]) == ["VN", "GLOBAL", "GLOBAL", "GLOBAL"]


def test_clean_mode(values):
    assert values(c.clean_mode, ["0", "1", "0.5", "0.49", None, "x", "-3"]) == [0, 1, 1, 0, 1, 1, 0]
