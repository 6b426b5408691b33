"""Dates in names, names of layers and collections, accents, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date patterns in the order of trial, abbreviations, and words of collection names.
DATE_PATTERNS = [r"(\d{8}T\d{6}_\d{8}T\d{6})", r"(\d{8}T\d{6})", r"(\d{8}_\d{8})", r"(\d{8})"]
SPATIAL_ABBR = {"municipality": "mun", "health_region": "hr", "state": "uf"}
REGION_ABBR = {"north": "NO", "south": "SO", "east": "E", "west": "W", "northeast": "NE", "northwest": "NW", "southeast": "SE", "southwest": "SW"}
KEYWORDS = {"max": "maximum", "min": "minimum", "mean": "mean", "temp": "temperature", "prec": "precipitation", "humidity": "relative humidity", "anomaly": "anomaly"}
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def strip_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def natural_number(label: Column) -> Column:
    """The number that a label ends with, so that epiweek_9 sorts before epiweek_10."""
    return F.regexp_extract(label, r"(\d+)$", 1).try_cast("int")


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def item_period(name: Column) -> Column:
    """struct<start, end>: timestamp texts of the first date pattern that a name holds; a single date is both; NULL without one."""

    def shown(part: Column) -> Column:
        # by length, as a failed parse costs far more than a test
        moment = F.when(F.length(part) == 15, F.try_to_timestamp(part, F.lit("yyyyMMdd'T'HHmmss"))).otherwise(F.try_to_timestamp(part, F.lit("yyyyMMdd")))
        return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")

    def dated(s: Column) -> Column:
        tried = F.array(*[F.regexp_extract(s, p, 1) for p in DATE_PATTERNS])
        return F.split(F.get(F.filter(tried, lambda x: x != ""), F.lit(0)), "_")

    first, last = lambda p: F.get(p, F.lit(0)), lambda p: F.get(p, F.size(p) - 1)
    return _let(name, lambda s: _let(dated(s), lambda p: F.struct(_let(first(p), shown).alias("start"), _let(last(p), shown).alias("end"))))


def item_dates(name: Column) -> tuple[Column, Column]:
    """Start and end of item_period."""
    both = item_period(name)
    return both["start"], both["end"]


def _abbreviation(values: dict[str, str], key: Column) -> Column:
    return F.coalesce(*[F.when(key == k, F.lit(v)) for k, v in values.items()])


def layer_name(title: Column, region: Column, spatial: Column, period: Column) -> Column:
    """title_REGION_spatial_period; a region without abbreviation stays as it is, none is left out; NULL if spatial is unknown."""
    where = F.when(region.isNotNull(), F.coalesce(_abbreviation(REGION_ABBR, F.lower(region)), region))
    short = _abbreviation(SPATIAL_ABBR, spatial)
    when = F.when(period == "week", F.lit("epiweek")).otherwise(period)
    return F.when(short.isNotNull(), F.concat_ws("_", F.replace(F.lower(title), F.lit(" "), F.lit("_")), where, short, when))


def parse_collection_name(name: Column) -> dict[str, Column]:
    """Words, indicator, provider, period and region of a collection's name."""
    low = F.lower(name)
    ringed = F.concat(F.lit("_"), low, F.lit("_"))
    has = lambda k: F.contains(low, F.lit(k))
    words = F.array_compact(F.array(*[F.when(has(k), F.lit(v)) for k, v in KEYWORDS.items()]))
    warm = has("temp") & has("era5land") & has("anomaly") & (has("epiweek") | has("month"))
    return {
        "words": F.when(F.size(words) > 0, F.concat_ws(" ", words)).otherwise(F.lit("indicator")),
        "indicator": F.when(warm, F.lit("anomaly")).when(has("temp") & (has("era5land") | has("cptec")), F.lit("temperature"))
        .when(has("prec") & (has("era5land") | has("cptec")), F.lit("precipitation")).when(has("humidity"), F.lit("humidity")).otherwise(F.lit("temperature")),
        "provider": F.when(has("era5land"), F.lit("ERA5-Land")).when(has("cptec"), F.lit("CPTEC")).otherwise(F.lit("Unknown")),
        "period": F.when(F.contains(ringed, F.lit("epiweek")), F.lit("epidemiological week")).when(F.contains(ringed, F.lit("month")), F.lit("month")).otherwise(F.lit("time period")),
        "region": F.when(F.contains(ringed, F.lit("_ne_")), F.lit("Northeast")).when(F.contains(ringed, F.lit("_no_")), F.lit("North")).otherwise(F.lit("Brazil")),
    }
