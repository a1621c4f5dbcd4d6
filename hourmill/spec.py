"""What a wide hourly series looks like: names, key, scope prefix and measures.

Everything else in the package takes a :class:`SeriesSpec`, so a different
source only needs another spec, not other code.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

# Names and formats of the German hourly power series.
UTC_COLUMN = "utc_timestamp"
LOCAL_COLUMN = "cet_cest_timestamp"
SCOPE_PREFIX = "DE_"
UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
LOCAL_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"
ZONES = ("50hertz", "amprion", "tennet", "transnetbw")
BRONZE_TABLE = "germany_energy_raw"
SILVER_TABLE = "germany_energy_clean"
LOAD_TABLE = "daily_load_summary"
GENERATION_TABLE = "daily_generation_summary"
SHARE_TABLE = "daily_wind_solar_share"
CONTROL_TABLE = "batch_control"


@dataclass(frozen=True)
class LoadArea:
    """One area with an actual and a forecast load, and its daily names."""

    actual: str
    forecast: str
    daily_actual: str
    daily_forecast: str
    daily_error: str


@dataclass(frozen=True)
class GenerationArea:
    """One area with solar and wind measures, and its daily names.

    An area with ``optional`` set takes part only as far as its columns exist.
    """

    solar: str
    wind: tuple[str, ...]
    daily_solar: str
    daily_wind: str
    optional: bool = False


def _zone(name: str) -> GenerationArea:
    return GenerationArea(
        solar=f"de_{name}_solar_generation_actual",
        wind=(f"de_{name}_wind_onshore_generation_actual", f"de_{name}_wind_offshore_generation_actual"),
        daily_solar=f"{name}_solar_generation_mwh",
        daily_wind=f"{name}_wind_generation_mwh",
        optional=True,
    )


@dataclass(frozen=True)
class TableNames:
    """What the tables of a lake are called."""

    bronze: str = BRONZE_TABLE
    silver: str = SILVER_TABLE
    load: str = LOAD_TABLE
    generation: str = GENERATION_TABLE
    share: str = SHARE_TABLE
    control: str = CONTROL_TABLE

    def parts(self) -> dict[str, str]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


@dataclass(frozen=True)
class SeriesSpec:
    key: str = UTC_COLUMN
    local_time: str = LOCAL_COLUMN
    prefix: str = SCOPE_PREFIX
    key_format: str = UTC_FORMAT
    local_format: str = LOCAL_FORMAT
    load: tuple[LoadArea, ...] = (
        LoadArea(
            "de_load_actual_entsoe_transparency",
            "de_load_forecast_entsoe_transparency",
            "de_load_actual_mwh",
            "de_load_forecast_mwh",
            "de_forecast_error_mwh",
        ),
        LoadArea(
            "de_lu_load_actual_entsoe_transparency",
            "de_lu_load_forecast_entsoe_transparency",
            "de_lu_load_actual_mwh",
            "de_lu_load_forecast_mwh",
            "de_lu_forecast_error_mwh",
        ),
    )
    national: GenerationArea = GenerationArea(
        "de_solar_generation_actual",
        ("de_wind_onshore_generation_actual", "de_wind_offshore_generation_actual"),
        "de_solar_generation_mwh",
        "de_wind_generation_mwh",
    )
    zones: tuple[GenerationArea, ...] = tuple(_zone(z) for z in ZONES)
    daily_renewable: str = "de_wind_solar_generation_mwh"
    daily_share: str = "wind_solar_share_percent"
    tables: TableNames = TableNames()

    @property
    def time_columns(self) -> tuple[str, str]:
        return (self.key, self.local_time)

    @property
    def typed_prefix(self) -> str:
        """The scope prefix once column names are lower case."""
        return self.prefix.lower()


GERMAN_POWER = SeriesSpec()
