"""A small set of raw files with the usual faults: copies, gaps, bad text, odd case."""

from __future__ import annotations

from pathlib import Path

from pacewise.sources import schemas as S

PERFORMANCE = """\
01/08/2024,A1,One,1000,20,100.0,9.9,9.9,1.5
1/8/2024,A2,Two,2000,30,-50.0,9.9,9.9,1.0
02/08/2024,A1,One,500,10,40.0,1.0,1.0,2.0
02/08/2024,A1,One,500,10,40.0,1.0,1.0,2.0
02/08/2024,A1,One,,5,20.0,3.5,4.5,1.0
02/08/2024,A2,Two,0,0,0,0.5,0.6,1.0
03/08/2024,A1,One,800,abc,60.0,2.0,3.0,1.1
03/08/2024,,Nameless,10,1,5.0,1.0,1.0,1.0
04/08/2024,A3,Three,400.0,4,10.0,1.0,1.0,1.0
"""
BUDGET = """\
01/08/2024,A1,200,100,0.5,Under_Pacing
01/08/2024,A2,100,50,0.95,on_pace
02/08/2024,A1,200,60,0.3,under_pacing
02/08/2024,A2,100,120,1.2,over_pacing
03/08/2024,A1,200,60,0.92,
05/08/2024,A1,200,10,0.05,weird
06/08/2024,,1,1,1.0,on_pace
07/08/2024,,1,1,1.0,on_pace
"""
CONVERSIONS = """\
C1,01/08/2024,A1,booking_completed,300,1_day_click,x
C2,01/08/2024,A1,Booking_Completed,,7_Day_Click,x
C3,01/08/2024,A1,newsletter_signup,0,1_day_view,y
C4,02/08/2024,A1,booking_completed,80,1_day_click,x
C4,02/08/2024,A1,booking_completed,80,1_day_click,x
C5,08/08/2024,A1,flight_search,bad,1_day_click,x
C6,09/08/2024,A1,booking_completed,55,1_day_click,x
C7,02/08/2024,A4,booking_completed,70,1_day_click,x
C8,03/08/2024,,booking_completed,70,1_day_click,x
"""
AUDIENCE = """\
A1,One,25-45,"luxury, travel",vip,500
A2,Two,55+,family,bookers,
A3,Three,18-30,city,visitors,100
"""
FILES = {
    S.PERFORMANCE: PERFORMANCE,
    S.BUDGET: BUDGET,
    S.CONVERSIONS: CONVERSIONS,
    S.AUDIENCE: AUDIENCE,
}


def regular(folder: Path) -> dict[str, str]:
    """Six ad sets over twenty days: spend 10, 20, ... 60 a day, one booking of three times that.

    Pacing is 0.85 on odd days and 1.0 on even ones.
    """
    days = [(n, f"{n:02}/08/2024") for n in range(1, 21)]
    ads = range(1, 7)
    rows = {
        S.PERFORMANCE: [f"{d},A{i},Ad {i},{1000 * i},{10 * i},{10 * i},0,0,1.0" for _, d in days for i in ads],
        S.BUDGET: [
            f"{d},A{i},100,{85 if n % 2 else 100},{0.85 if n % 2 else 1.0},{'under_pacing' if n % 2 else 'on_pace'}"
            for n, d in days for i in ads
        ],
        S.CONVERSIONS: [
            f"C{n}-{i},{d},A{i},booking_completed,{30 * i},1_day_click,x" for n, d in days for i in ads
        ],
        S.AUDIENCE: [f"A{i},Ad {i},25-45,city,vip,{100 * i}" for i in ads],
    }
    return _write(folder, {t: "\n".join(lines) + "\n" for t, lines in rows.items()})


def write(folder: Path) -> dict[str, str]:
    """Write the four files, with a byte order mark, and return their paths."""
    return _write(folder, FILES)


def _write(folder: Path, files: dict[str, str]) -> dict[str, str]:
    paths = {}
    for table, body in files.items():
        path = folder / f"{table}.csv"
        path.write_text("﻿" + ",".join(S.RAW_TYPES[table]) + "\n" + body, encoding="utf-8")
        paths[table] = str(path)
    return paths
