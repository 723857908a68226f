"""Table contracts, series configuration and signal thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Raw layer contracts (NOT NULL columns are nullable=False).
OBSERVATIONS = T.StructType([
    T.StructField("series_id", T.StringType(), False),
    T.StructField("observation_date", T.DateType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("ingested_at", T.TimestampNTZType(), True),
    T.StructField("source_url", T.StringType(), True),
])

SERIES_METADATA = T.StructType([
    T.StructField("series_id", T.StringType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("frequency", T.StringType(), True),
    T.StructField("units", T.StringType(), True),
    T.StructField("seasonal_adj", T.StringType(), True),
    T.StructField("last_updated", T.TimestampNTZType(), True),
    T.StructField("ingested_at", T.TimestampNTZType(), True),
])

INGESTION_LOG = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("series_id", T.StringType(), False),
    T.StructField("records_fetched", T.IntegerType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("completed_at", T.TimestampNTZType(), True),
    T.StructField("error_message", T.StringType(), True),
])

# Maximum string lengths of the raw contracts (checked by conform()).
MAX_LENGTHS = {
    "observations": {"series_id": 20, "source_url": 500},
    "series_metadata": {"series_id": 20, "title": 500, "frequency": 20,
                        "units": 200, "seasonal_adj": 200},
    "ingestion_log": {"run_id": 36, "series_id": 20, "status": 20,
                      "error_message": 2000},
}

def observations_contract(keys=()) -> T.StructType:
    """The raw observations contract with entity key columns in front."""
    return T.StructType([T.StructField(k, T.StringType(), False) for k in keys] + OBSERVATIONS.fields)


# Landing payload shape: one JSON document per series file.
def observation_fields(keys=(), with_series: bool = False) -> T.StructType:
    """One landed observation: date and value as text, and the entity keys."""
    names = [*(["series_id"] if with_series else []), "date", "value", *keys]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def observation_payload(keys=()) -> T.StructType:
    return T.StructType([
        T.StructField("series_id", T.StringType()),
        T.StructField("observations", T.ArrayType(observation_fields(keys))),
        T.StructField("error_code", T.IntegerType()),
        T.StructField("error_message", T.StringType()),
    ])


OBSERVATION_PAYLOAD = observation_payload()

METADATA_PAYLOAD = T.StructType([
    T.StructField("seriess", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("frequency", T.StringType()),
        T.StructField("units", T.StringType()),
        T.StructField("seasonal_adjustment", T.StringType()),
        T.StructField("last_updated", T.StringType()),
    ]))),
])

MONTH = "observation_month"

# How a series lands on the monthly grid.
AS_IS = "as_is"                  # monthly series: value of the month (max if several)
LAST_OF_MONTH = "last_of_month"  # daily series: value of the last available day
FFILL = "ffill"                  # quarterly series: carried forward along the spine
ALIGNMENTS = (AS_IS, LAST_OF_MONTH, FFILL)


@dataclass(frozen=True)
class SeriesSpec:
    series_id: str
    column: str
    align: str = AS_IS
    name: str = ""
    frequency: str = "monthly"

    def __post_init__(self):
        if self.align not in ALIGNMENTS:
            raise ValueError(f"align must be one of {ALIGNMENTS}, got {self.align!r}")


# The six indicators of the reference, their wide-table column
# names and their frequencies.
DEFAULT_SERIES: tuple[SeriesSpec, ...] = (
    SeriesSpec("UNRATE", "unemployment_rate", AS_IS, "Unemployment Rate", "monthly"),
    SeriesSpec("CPIAUCSL", "cpi_index", AS_IS, "Consumer Price Index", "monthly"),
    SeriesSpec("FEDFUNDS", "fed_funds_rate", AS_IS, "Federal Funds Rate", "monthly"),
    SeriesSpec("GDP", "gdp", FFILL, "Gross Domestic Product", "quarterly"),
    SeriesSpec("T10Y2Y", "treasury_spread_10y2y", LAST_OF_MONTH, "10Y-2Y Treasury Spread", "daily"),
    SeriesSpec("UMCSENT", "consumer_sentiment", AS_IS, "Consumer Sentiment Index", "monthly"),
)

# Wide-table column order of the reference.
WIDE_COLUMNS = ("unemployment_rate", "cpi_index", "fed_funds_rate",
                "consumer_sentiment", "gdp", "treasury_spread_10y2y")

# Risk levels, from lowest to highest.
RISK_LEVELS = ("LOW", "MODERATE", "ELEVATED", "HIGH")

# Fixed value: first date of a full load.
DEFAULT_START_DATE = "2000-01-01"


@dataclass(frozen=True)
class Thresholds:
    """Signal thresholds. Fixed defaults of the reference: 0.50 / 5.0 / 60 / 1.0."""
    sahm_rule: float = 0.50
    high_inflation: float = 5.0
    low_sentiment: float = 60.0
    fed_tightening: float = 1.0
    # Hard-coded in the reference, not configurable there.
    yield_curve: float = 0.0
    level_cuts: tuple = field(default=(3, 2, 1))
