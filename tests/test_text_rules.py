"""Literal cases of the text rules: numbers, time frames, diagnostics, bracketed dates."""

import datetime

import pytest
from pyspark.sql import functions as F

from surveyloom.functions import survey as S
from surveyloom.sources import span_tables as T

D = datetime.date


def each(spark, rule, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.select("i", rule(F.col("t")).alias("out")).orderBy("i").select("out").collect()]


def test_respondents(spark):
    cases = {"O • 2.004": 2004, "TOM • 1.00325.02.–03.03.": 1003, "1.234.567 x": 1234567, "12345.678": 12345, "telefonisch 1000": 1000, "1.23": 1, "12.3456": 12345, "7": 7, "": None, "none": None, None: None, "ca. 1.000-1.200": 1000}
    assert each(spark, S.respondents, list(cases)) == list(cases.values())


def test_embedded_range(spark):
    cases = {
        "TOM • 1.00325.02.–03.03.": (D(2026, 2, 25), D(2026, 3, 3)), "x 1.2.-3.4.": (D(2026, 2, 1), D(2026, 4, 3)), "1.2. – 3.4. y": (D(2026, 2, 1), D(2026, 4, 3)), "31.02.–03.03.": (None, D(2026, 3, 3)),
        "1.2-3.4.": (None, None), "1.004": (None, None), "": (None, None), "5.6.7.–8.9.": (D(2026, 7, 6), D(2026, 9, 8)), "1.100.–3.4.": (None, None),
    }
    got = each(spark, lambda c: S.embedded_range(c, F.lit("2026-05-01").cast("date")), list(cases))
    assert [tuple(r) for r in got] == list(cases.values())


def test_percentage(spark):
    cases = {"16,5 %": 16.5, "5–7": 6.0, "5 - 7": 6.0, "–": None, "-": None, "—": None, "": None, "k.A.": None, "BSW 2 %BP 1 %Sonst. 5 %": 8.0, "3.5–4,5": 4.0, "1.2.3": 4.2, "12": 12.0, " 7 %": 7.0, "-5": 5.0, "5.-7.": 12.0, "1..2": 3.0, "2-": 2.0, None: None, "4−6": 10.0}
    assert each(spark, S.percentage, list(cases)) == pytest.approx(list(cases.values()))


def test_diagnostics(spark):
    cases = {"telefonisch 1000": None, "face to face": "Could not extract count from 'face to face'", "1000": "Could not extract method from '1000'", "?": "Could not extract count, method from '?'", "": "Empty or invalid input", None: "Empty or invalid input"}
    assert each(spark, S.parse_diagnostics, list(cases)) == list(cases.values())


def test_timeframe_looks_past_other_numbers(spark):
    cases = {
        "KW 12-13: 01.–05.03.2024": ("VALID_RANGE", D(2024, 3, 1), D(2024, 3, 5)), "Welle 3-4; 24.06.-26.06.2024": ("VALID_RANGE", D(2024, 6, 24), D(2024, 6, 26)), "S. 1-2, 3-4": ("INVALID", None, None),
        "01.03–05.03.2024": ("VALID_RANGE", D(2024, 3, 1), D(2024, 3, 5)), "28.10.–01.11.": ("VALID_RANGE", D(2024, 10, 28), D(2024, 11, 1)), "32.01.-33.01.2024": ("INVALID", None, None), "bis 31.08.": ("BIS_PREFIX", None, None),
    }
    got = each(spark, lambda c: S.timeframe(c, F.lit(2024)), list(cases))
    assert [(r["type"], r["start"], r["end"]) for r in got] == list(cases.values())


def test_dates_of_time_frames_as_the_calendar_has_them(spark):
    """Days are counted without a parser: all that exist, and no others."""
    triples = [(d, m, y) for y in (1900, 2000, 2023, 2024) for m in range(14) for d in (0, 1, 28, 29, 30, 31, 32)]

    def real(d, m, y):
        try:
            return D(y, m, d)
        except ValueError:
            return None

    got = each(spark, lambda c: S.timeframe(c), [f"{d}.{m}.{y}–{d}.{m}.{y}" for d, m, y in triples])
    assert [r["start"] for r in got] == [r["end"] for r in got] == [real(*x) for x in triples]
    assert "to_date" not in str(spark.range(1).select(S.timeframe(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString())


def test_bracketed_end_and_days(spark):
    cases = {"INSA (01.02.24)": ("INSA", "01.02.24"), "A (x) (3.4.2024)": ("A (x)", "3.4.2024"), "no bracket": (None, None), "(open": (None, None), ")": ("", ")"[:0])}
    got = each(spark, lambda c: F.struct(*T.bracketed_end(c)), list(cases))
    assert [(r[0] or None, r[1] or None) for r in got] == [(a or None, b or None) for a, b in cases.values()]
    lines = {"24.05.–28.05.": True, "??.09.": True, "?.9.": True, "1.004 Befragte": True, "1000": False, "Mai 2024": False, "3. Welle 4": False, "": False}
    assert each(spark, T.holds_days, list(lines)) == list(lines.values())
