"""Categorical labels and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limelight.functions._util import col_of

# Fixed values that must equal the reference for equal results.
HIGH_SALIENCE = 0.70
MEDIUM_SALIENCE = 0.40
SIGNAL_GROUP_PREFIXES = [("gdelt_%", "media"), ("wikipedia_%", "wikipedia")]
SIGNAL_GROUP_DEFAULT = "google_trends"


def salience_class(score, high: float = HIGH_SALIENCE, medium: float = MEDIUM_SALIENCE) -> Column:
    """>= high -> high_salience, >= medium -> medium_salience, else low_salience."""
    s = col_of(score)
    return (
        F.when(s >= F.lit(high), F.lit("high_salience"))
        .when(s >= F.lit(medium), F.lit("medium_salience"))
        .otherwise(F.lit("low_salience"))
    )


def signal_group(signal, prefixes=SIGNAL_GROUP_PREFIXES, default: str = SIGNAL_GROUP_DEFAULT) -> Column:
    """first LIKE pattern that matches names the group (``_`` is a wildcard, as in SQL)."""
    s = col_of(signal)
    expr = None
    for pattern, group in prefixes:
        expr = (F.when if expr is None else expr.when)(s.like(pattern), F.lit(group))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def fetch_status(http_status, error) -> Column:
    """404 -> missing_upstream, other error -> download_failed, none -> downloaded."""
    code, err = col_of(http_status), col_of(error)
    return (
        F.when(code == 404, F.lit("missing_upstream"))
        .when(err.isNotNull() | (F.coalesce(code, F.lit(200)) >= 400), F.lit("download_failed"))
        .otherwise(F.lit("downloaded"))
    )


def ready_flag(mode: str = "local", download_status="download_status", unzip_status="unzip_status",
               remote_url="gcp_url") -> Column:
    """local -> skipped, or downloaded and extracted; remote -> non-empty URL."""
    if mode == "local":
        d, u = col_of(download_status), col_of(unzip_status)
        return F.coalesce((d == "skipped") | ((d == "downloaded") & (u == "extracted")), F.lit(False))
    url = col_of(remote_url)
    return F.coalesce(url.isNotNull() & (url != ""), F.lit(False))


def day_status(files_ready, files_unresolved_404, files_expected, full_day: int = 192) -> Column:
    """Empty / empty_all_404 / partial / complete day. ``full_day`` is a parameter
    (192 = two feeds x 96 slots) instead of a constant."""
    r, m, e = col_of(files_ready), col_of(files_unresolved_404), col_of(files_expected)
    return (
        F.when((r == 0) & (m == e), F.lit("empty_all_404"))
        .when(r == 0, F.lit("empty"))
        .when(r < F.lit(full_day), F.lit("partial"))
        .otherwise(F.lit("complete"))
    )


def plural(n, word: str) -> Column:
    n = col_of(n)
    return F.concat(n.cast("string"), F.lit(" " + word), F.when(n == 1, F.lit("")).otherwise(F.lit("s")))


def match_label(team1="team1", score="score", team2="team2", goals="goals",
                minutes=None, yellow_cards=None, red_cards=None) -> Column:
    """``team1 score team2 · n goal(s)`` plus optional minutes and card parts."""
    head = F.concat_ws(" ", col_of(team1), col_of(score), col_of(team2))
    parts = [head, plural(goals, "goal")]
    if minutes is not None:
        parts.append(F.concat(col_of(minutes).cast("string"), F.lit(" min")))
    for cards, word in ((yellow_cards, "yellow"), (red_cards, "red")):
        if cards is not None:
            c = col_of(cards)
            parts.append(F.when(F.coalesce(c, F.lit(0)) != 0, F.concat(c.cast("string"), F.lit(" " + word))))
    return F.concat_ws(" · ", *parts)
