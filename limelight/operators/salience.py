"""How central one entity is to each article.

``add_salience`` appends the 12 salience columns with column expressions over
in-row arrays. It is a narrow transformation (no shuffle): at any scale the
cost per article is bounded by the length of its own entity lists. The only
Python step is the name count (Unicode decomposition has no Spark function):
one Arrow-batched UDF returns two integers per article (``functions.text``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.functions.entities import is_target_name, names_of, offsets_of, parse_offset_entries
from limelight.functions.labels import salience_class
from limelight.functions.text import target_counts_udf
from limelight.functions.urls import url_contains_token

# Fixed values that must equal the reference for equal results.
OFFSET_THRESHOLD = 100
WEIGHTS = {
    "lead_or_url_signal": 0.20,
    "position_score": 0.35,
    "density_score": 0.30,
    "rank_score": 0.15,
}
DENSITY_CAP = 4

SALIENCE_COLUMNS = [
    "url_player_signal",
    "lead_player_signal",
    "lead_or_url_signal",
    "first_player_offset",
    "max_entity_offset",
    "position_score",
    "player_mentions",
    "max_mentions_of_any_person",
    "density_score",
    "rank_score",
    "salience_score",
    "salience_class",
]


def add_salience(
    df: DataFrame,
    token: str,
    canonical: str,
    persons: str = "V2Persons",
    all_names: str = "AllNames",
    organizations: str = "V2Organizations",
    themes: str = "V2Themes",
    url: str = "DocumentIdentifier",
    offset_threshold: int = OFFSET_THRESHOLD,
) -> DataFrame:
    """append the salience columns of entity ``token`` (canonical name ``canonical``)."""
    token = token.lower()
    w = WEIGHTS
    tmp = {
        "_p": parse_offset_entries(persons),
        "_n": parse_offset_entries(all_names),
        "_o": parse_offset_entries(organizations),
        "_t": parse_offset_entries(themes),
    }
    out = df.withColumns(tmp)
    player = F.filter(F.concat("_p", "_n"), lambda e: is_target_name(e["name"], token))
    counts = target_counts_udf(token, canonical)
    out = out.withColumns({
        "first_player_offset": F.array_min(offsets_of(player)),
        "max_entity_offset": F.array_max(offsets_of(F.concat("_p", "_n", "_o", "_t"))),
        "_pc": counts(names_of("_p")),
        "_nc": counts(names_of("_n")),
    })
    in_persons = F.col("_pc.mentions") > 0
    out = out.withColumns({
        "player_mentions": F.when(in_persons, F.col("_pc.mentions")).otherwise(F.col("_nc.mentions")).cast("bigint"),
        "max_mentions_of_any_person": F.when(in_persons, F.col("_pc.max_mentions"))
        .otherwise(F.col("_nc.max_mentions")).cast("bigint"),
        "url_player_signal": url_contains_token(url, token),
    })
    first, last = F.col("first_player_offset"), F.col("max_entity_offset")
    mentions, top = F.col("player_mentions"), F.col("max_mentions_of_any_person")
    out = out.withColumns({
        "lead_player_signal": F.when(first.isNotNull() & (first <= offset_threshold), F.lit(1.0)).otherwise(F.lit(0.0)),
        "position_score": F.when(first.isNotNull() & last.isNotNull() & (last > 0), F.lit(1.0) - first / last).otherwise(F.lit(0.0)),
        "density_score": F.least(mentions, F.lit(DENSITY_CAP)) / F.lit(float(DENSITY_CAP)),
        "rank_score": F.when(top > 0, mentions / top).otherwise(F.lit(0.0)),
    })
    out = out.withColumn(
        "lead_or_url_signal",
        F.when((F.col("url_player_signal") == 1.0) | (F.col("lead_player_signal") == 1.0), F.lit(1.0)).otherwise(F.lit(0.0)),
    )
    score = (
        F.lit(w["lead_or_url_signal"]) * F.col("lead_or_url_signal")
        + F.lit(w["position_score"]) * F.col("position_score")
        + F.lit(w["density_score"]) * F.col("density_score")
        + F.lit(w["rank_score"]) * F.col("rank_score")
    )
    out = out.withColumn("salience_score", score).withColumn("salience_class", salience_class("salience_score"))
    return out.drop("_p", "_n", "_o", "_t", "_pc", "_nc")
