"""Text built from metrics, and cleaning of suggestion texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's `str` sees it, bullet marks, limits, wording.
SPACE = r"\s\x1c-\x1f"
SPACES = rf"(?U)[{SPACE}]+"
BULLET = rf"(?U)[-\x{{2022}}][{SPACE}]+"
SOME_TEXT = rf"(?U)[^{SPACE}\x{{2022}}-]|[-\x{{2022}}](?![{SPACE}])"
MAX_BULLETS = 3
MAX_CHARS = 300
NO_SUGGESTIONS = "- No suggestions"
SUMMARY_MISSING = "Summary unavailable. Consider reallocating budget to top‑ROAS ad sets."
DEFAULT_ACTION = (
    "Review pacing and shift small budget from low‑ROAS to high‑ROAS ad sets to improve returns."
)


def clean_suggestions(c: str | Column) -> Column:
    """A free text to at most three `- ` bullets, one per line, pounds for dollars.

    The text is split first; only the parts that are kept have their white space
    collapsed, which gives the same parts as collapsing it all beforehand.
    """
    c = F.col(c) if isinstance(c, str) else c

    def flat(part: Column) -> Column:
        return F.regexp_replace(F.replace(part, F.lit("$"), F.lit("£")), SPACES, " ")

    def listed(part: Column) -> Column:
        return F.concat(F.lit("- "), F.left(part, F.lit(MAX_CHARS)))

    parts = F.filter(F.split(c, BULLET), lambda p: p.rlike(rf"(?U)[^{SPACE}]"))
    kept = F.transform(F.slice(parts, 1, MAX_BULLETS), lambda p: listed(F.trim(flat(p))))
    return (
        F.when(c.isNull() | (c == ""), F.lit(NO_SUGGESTIONS))
        .when(c.rlike(SOME_TEXT), F.array_join(kept, "\n"))
        .otherwise(listed(flat(c)))
    )


def bullets(c: str | Column) -> Column:
    """An array of texts as a bulleted block."""
    return F.array_join(F.transform(c, lambda p: F.concat(F.lit("- "), p)), "\n")


def pounds(c: str | Column) -> Column:
    """Whole pounds with thousands separators; null is £0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit("£"), F.format_number(c, 0)), F.lit("£0"))


def percent(c: str | Column) -> Column:
    """Shares up to 1 are scaled by 100, larger values are percent already; null is 0%."""
    c = F.col(c) if isinstance(c, str) else c
    scaled = F.when(c <= 1, c * 100).otherwise(c)
    shown = F.call_function("format_number", scaled, F.lit("0.0"))
    return F.coalesce(F.concat(shown, F.lit("%")), F.lit("0%"))


def summary(points: Column) -> Column:
    """First point, then the second one or a default action."""
    return (
        F.when(F.coalesce(F.size(points), F.lit(0)) == 0, F.lit(SUMMARY_MISSING))
        .when(F.size(points) == 1, F.concat(F.get(points, F.lit(0)), F.lit(" " + DEFAULT_ACTION)))
        .otherwise(F.concat_ws(" ", F.get(points, F.lit(0)), F.get(points, F.lit(1))))
    )


def change_sentence(spend_change: Column, revenue_change: Column) -> Column:
    return F.concat(
        F.lit("Spend changed by "),
        F.format_number(spend_change, 1),
        F.lit("% and revenue by "),
        F.format_number(revenue_change, 1),
        F.lit("%."),
    )


def focus_sentence(top_ids: Column) -> Column:
    return F.concat(
        F.lit("Focus budget on the top ROAS ad sets ("),
        F.array_join(top_ids, ", "),
        F.lit("); trim or test creatives for the bottom group."),
    )
