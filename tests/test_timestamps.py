from datetime import datetime, timezone

import pytest

from quillgrid.functions.timestamps import readings
from quillgrid.operators.timestamps import fit, normalized


def us(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1_000_000)


CERTAIN = [
    ("2026-03-22T01:18:00-04:00[America/New_York]", None, "2026-03-22T05:18:00"),
    ("2026-02-02T13:54", "Europe/Berlin", "2026-02-02T12:54:00"),
    ("March 26, 2026 6:50 p.m. JST", None, "2026-03-26T09:50:00"),
    ("March 30, 2025 2:48 a.m. BST", None, "2025-03-30T01:48:00"),
    ("3 de febrero de 2026, 08:11", "Europe/Madrid", "2026-02-03T07:11:00"),
    ("15. August 2024, 19:07 Uhr", "Europe/Berlin", "2024-08-15T17:07:00"),
    ("14 décembre 2024 à 23h06", "Europe/Paris", "2024-12-14T22:06:00"),
    ("Mon, 04 Aug 2025 23:20:50 +1000", "UTC", "2025-08-04T13:20:50"),
    ("Mon, 11 Nov 2024 10:36:39 UT", None, "2024-11-11T10:36:39"),
    ("20250915T104720Z", "Asia/Tokyo", "2025-09-15T10:47:20"),
    ("  2025-09-24 12:38:00+00 ", "Asia/Tokyo", "2025-09-24T12:38:00"),
    ("2025-10-02 19:53:00 -07", None, "2025-10-03T02:53:00"),
    ("2024-12-18T03:43:59,937", None, "2024-12-18T03:43:59.937000"),
    ("2025-03-23T11:28:44.0563450Z", None, "2025-03-23T11:28:44.056345"),
    ("2024-10-18 17:53 America/New_York", "UTC", "2024-10-18T21:53:00"),
    ("October 26, 2024 at 2:28 AM ET", "UTC", "2024-10-26T06:28:00"),
    ("2025-12-31", "America/New_York", "2025-12-31T05:00:00"),
    ("Sep. 24, 2025", None, "2025-09-24T00:00:00"),
    ("2024/12/06 15:58", "Asia/Tokyo", "2024-12-06T06:58:00"),
    ("1740785880250", None, "2025-02-28T23:38:00.250000"),
    ("1746170240", None, "2025-05-02T07:17:20"),
    ("1782277740921912", None, "2026-06-24T05:09:00.921912"),
    # a clock that goes back shows 01:30 twice: the earlier; one that goes forward skips 02:30: the offset before
    ("2025-11-02T01:30", "America/New_York", "2025-11-02T05:30:00"),
    ("2025-03-09T02:30", "America/New_York", "2025-03-09T07:30:00"),
]


@pytest.mark.parametrize("text,zone,want", CERTAIN)
def test_certain_forms(text, zone, want):
    layout, found = readings(text, zone)
    assert layout == "" and found["x"][0] == us(want)


@pytest.mark.parametrize("text", [None, "", "  ", "soon", "yesterday", "Invalid Date", "31/31/2025", "2025-02-30T10:00:00Z", "2025-13-04", "T12:00Z", "{{date}}", "0000-00-00 00:00:00", "NaN", "2025-01-01 25:00", "2025-01-01 10:00 XYZ", "9" * 50, "x" * 100_000])
def test_no_date(text):
    assert readings(text, None)[1] == {}


def test_several_orders():
    layout, found = readings("03/04/2025 10:00", None)
    assert layout == "/y" and {o: a for o, (a, _) in found.items()} == {"dmy": us("2025-04-03T10:00:00"), "mdy": us("2025-03-04T10:00:00")}
    assert set(readings("25/04/2025", None)[1]) == {"dmy"}
    assert {o: y for o, (_, y) in readings("18-Sep-25", None)[1].items()} == {"dmy": 2025, "ymd": 2018}


def test_em_learns_the_order_and_marks_doubt():
    unsure = ("/y", {"dmy": 2025, "mdy": 2025}, 5)
    learned = fit([("/y", {"mdy": 2025}, 40), unsure], None)
    assert learned[1][0] == "mdy" and learned[1][1] > 0.9
    assert fit([unsure], "dmy")[0][0] == "dmy"
    blank = fit([unsure], None)
    assert blank[0][1] < 0.9  # nothing tells: ambiguous
    years = fit([("", {"x": 2025}, 50), ("m", {"dmy": 2025, "ymd": 2018}, 3)], "ymd")
    assert years[1][0] == "dmy"


def test_operator_on_odd_rows(spark):
    values = [("a", "s", "03/04/2025"), ("b", None, "2025-01-01"), ("c", "nowhere", "2025-01-01"), ("d", "s", None), ("e", "s", "gone"), ("f", "s", "03/04/2025"), ("a", "s", "03/04/2025")] + [(f"m{i}", "s", f"0{i}/1{i}/2025") for i in range(3, 9)]
    df = spark.createDataFrame(values, "record string, source string, raw string")
    locale = spark.createDataFrame([("s", "America/New_York", "mdy"), ("s", "America/New_York", "mdy"), ("t", None, None)], "source_id string, time_zone string, date_order string")
    got = {r.record: (r.utc_micros, r.status) for r in normalized(df, locale).collect()}
    assert got["a"] == (us("2025-03-04T05:00:00"), "resolved") == got["f"]
    assert got["b"] == (us("2025-01-01T00:00:00"), "certain") == got["c"]
    assert got["d"] == (None, "unusable") == got["e"]
    assert normalized(df, locale).count() == len(values)
    assert normalized(df.limit(0), locale).count() == 0
