"""What each panel column holds; attached to the columns as metadata."""

from __future__ import annotations

INCOME = "2005 USD PPP per person"
DENSITY = "persons per km^2"
REGION_YEAR = ["hierid", "year"]
PER_SCENARIO = [*REGION_YEAR, "scenario"]
PER_MODEL = [*PER_SCENARIO, "gdp_model"]


def _entry(description: str, unit: str, source: str, dims: list[str]) -> dict:
    return {"description": description, "unit": unit, "source": source, "dims": dims}


PANEL_DICTIONARY = {
    "scenario": _entry("Socioeconomic scenario", "none", "run settings", ["scenario"]),
    "gdp_model": _entry("Income projection model", "none", "run settings", ["gdp_model"]),
    "hierid": _entry("Region id; the country code comes first", "none", "region outlines", ["hierid"]),
    "iso3": _entry("Country code", "none", "region id", ["hierid"]),
    "year": _entry("Calendar year", "year", "spine", ["year"]),
    "gdppc": _entry(
        "Income per person: the region's 1990-2015 mean until 2015, kernel-smoothed later, gaps 0",
        INCOME,
        "gridded shape at accounts level, projected by scenario growth",
        PER_MODEL,
    ),
    "gdppc_raw": _entry("Income per person before smoothing", INCOME, "as gdppc", PER_MODEL),
    "gdppc_raw0": _entry(
        "gdppc_raw with gaps as 0 from 1990 on", INCOME, "derived from gdppc_raw", PER_MODEL
    ),
    "gdp": _entry("Total income, gdppc times pop", "2005 USD PPP", "derived", PER_MODEL),
    "pop": _entry("Population", "persons", "gridded shares of national totals", PER_SCENARIO),
    "area_km2": _entry("Region area on the sphere", "km^2", "region outlines", ["hierid"]),
    "pop_density": _entry("pop over area_km2", DENSITY, "derived", PER_SCENARIO),
    "pop_wtd_density": _entry(
        "Density where the average resident lives, base year", DENSITY, "population grid", ["hierid"]
    ),
    "pop0to4": _entry("Population aged 0-4", "persons", "national age shares of pop", PER_SCENARIO),
    "pop5to64": _entry("Population aged 5-64", "persons", "national age shares of pop", PER_SCENARIO),
    "pop65plus": _entry(
        "Population aged 65 and over", "persons", "national age shares of pop", PER_SCENARIO
    ),
}
