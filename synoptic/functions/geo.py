"""Functions on positions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The WGS84 ellipsoid, in km.
A, INVERSE_FLATTENING = 6378.137, 298.257223563
FLAT = 1 / INVERSE_FLATTENING
#: Regions that are no place on the ground.
SPACE_REGIONS = [
    "Earth.Magnetosheath", "Earth.Magnetosphere", "Earth.Magnetosphere.Magnetotail", "Earth.Magnetosphere.Main", "Earth.Magnetosphere.Polar", "Earth.Magnetosphere.RadiationBelt", "Earth.Moon", "Earth.NearSurface", "Earth.NearSurface.Atmosphere",
    "Earth.NearSurface.AuroralRegion", "Earth.NearSurface.EquatorialRegion", "Earth.NearSurface.Ionosphere", "Earth.NearSurface.Ionosphere.DRegion", "Earth.NearSurface.Ionosphere.ERegion", "Earth.NearSurface.Ionosphere.FRegion",
    "Earth.NearSurface.Ionosphere.Topside", "Earth.NearSurface.Mesosphere", "Earth.NearSurface.Plasmasphere", "Earth.NearSurface.PolarCap", "Earth.NearSurface.Stratosphere", "Earth.NearSurface.Thermosphere", "Space", "Airborne",
]
#: The states that are told apart within one country, by their codes.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana",
    "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia", "AS": "American Samoa",
    "GU": "Guam", "MP": "Northern Mariana Islands", "PR": "Puerto Rico", "UM": "United States Minor Outlying Islands", "VI": "Virgin Islands",
}
#: Codes of continents; the country whose sites east of a longitude are in Asia; the country without others.
CONTINENTS = {"NA": "North America", "SA": "South America", "AS": "Asia", "AF": "Africa", "OC": "Oceania", "EU": "Europe", "AQ": "Antarctica"}
SPLIT_COUNTRY, SPLIT_LONGITUDE, SOUTH_POLE = "RU", 59, "AQ"


def wrapped_longitude(lon: Column) -> Column:
    """Within -180..180; a longitude that is there already stays as it is."""
    return F.when(lon.between(-180, 180), lon).otherwise(F.pmod(F.pmod(lon, F.lit(360.0)) + 540, F.lit(360.0)) - 180)


def geodesic(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """km along the ellipsoid by the iteration on the auxiliary sphere; nearly opposite points, where it does not
    converge, by the great circle."""
    u1, u2, ll = math.atan((1 - FLAT) * math.tan(math.radians(lat1))), math.atan((1 - FLAT) * math.tan(math.radians(lat2))), math.radians(lon2 - lon1)
    su1, cu1, su2, cu2 = math.sin(u1), math.cos(u1), math.sin(u2), math.cos(u2)
    lam = ll
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
        if ss == 0:
            return 0.0
        cs = su1 * su2 + cu1 * cu2 * cl
        sigma, sa = math.atan2(ss, cs), cu1 * cu2 * sl / ss
        c2a = 1 - sa * sa
        c2m = cs - 2 * su1 * su2 / c2a if c2a else 0.0
        c = FLAT / 16 * c2a * (4 + FLAT * (4 - 3 * c2a))
        before, lam = lam, ll + (1 - c) * FLAT * sa * (sigma + c * ss * (c2m + c * cs * (2 * c2m * c2m - 1)))
        if abs(lam - before) < 1e-12:
            break
    else:
        h = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(ll / 2) ** 2
        return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))
    b = A * (1 - FLAT)
    uu = c2a * (A * A - b * b) / (b * b)
    big_a = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))
    big_b = uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
    d = big_b * ss * (c2m + big_b / 4 * (cs * (2 * c2m * c2m - 1) - big_b / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))
    return b * big_a * (sigma - d)


@F.pandas_udf(T.DoubleType())
def distance_km(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    return pd.Series([geodesic(*p) if all(x is not None and x == x for x in p) else None for p in zip(lat1, lon1, lat2, lon2, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def geodetic_latitude(rho_cos: pd.Series, rho_sin: pd.Series) -> pd.Series:
    """Latitude on the ellipsoid from the parallax constants (in radii of the equator), to 5 decimals."""
    e2 = FLAT * (2 - FLAT)
    p, z = rho_cos.to_numpy(float), rho_sin.to_numpy(float)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(6):
        n = 1 / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(z + e2 * n * np.sin(lat), p)
    return pd.Series(np.round(np.degrees(lat), 5))


def in_space(region: Column) -> Column:
    return F.trim(region).isin(SPACE_REGIONS)


def states_in(text: Column) -> Column:
    """The states that are named in a text, in order; the longer of two names that begin alike."""
    names = sorted(STATES.values(), key=len, reverse=True)
    return F.coalesce(F.regexp_extract_all(text, F.lit(r"\b(" + "|".join(names) + r")\b"), 1), F.array().cast("array<string>"))


def state_of(label: Column, location: Column | None = None) -> Column:
    """The state that label or location name; none where they name different ones, or several."""
    named = F.array_distinct(F.concat(states_in(label), states_in(location)) if location is not None else states_in(label))
    return F.when(F.size(named) == 1, F.get(named, F.lit(0)))


def with_continent(rows: DataFrame, countries: DataFrame, country: str, code: str, lon: str) -> DataFrame:
    """Adds `continent` and brings `country` to its standard name. `countries` (code, name, continent: a code of CONTINENTS)
    is a dimension of one row a country. The code of an address goes before the name; a name that is no country's leaves no
    country, and the place counts as Antarctica where there is no code either. Russia is split by longitude."""
    known = countries.groupBy(F.upper("code").alias("__code")).agg(F.min("name").alias("__name"), F.min("continent").alias("__continent"))
    names = F.broadcast(countries.groupBy(F.lower("name").alias("__low")).agg(F.min(F.upper("code")).alias("__by_name")))
    out = rows.join(names, F.lower(F.trim(F.col(country))) == F.col("__low"), "left").withColumn("__wanted", F.coalesce(F.upper(code), "__by_name"))
    out = out.join(F.broadcast(known), F.col("__wanted") == F.col("__code"), "left")
    continents = F.create_map(*[F.lit(x) for kv in CONTINENTS.items() for x in kv])
    split = F.when(F.col(lon) < SPLIT_LONGITUDE, "Europe").when(F.col(lon) >= SPLIT_LONGITUDE, "Asia")
    found = F.when(F.col("__code") == SPLIT_COUNTRY, split).when(F.col("__code") == SOUTH_POLE, CONTINENTS["AQ"]).otherwise(F.element_at(continents, F.col("__continent")))
    lost = F.col(country).isNotNull() & F.col(code).isNull() & F.col("__code").isNull()
    named = F.coalesce("__name", F.when(F.col(code).isNotNull(), F.col(country)))
    return out.withColumn("continent", F.when(lost, CONTINENTS["AQ"]).otherwise(found)).withColumn(country, named).drop("__low", "__by_name", "__wanted", "__code", "__name", "__continent")


def resolved(*steps: tuple[Column, Column, float]) -> Column:
    """(place, confidence) of the first step (applies, place, confidence) that applies and has a place."""
    out = F.lit(None).cast("struct<place:string,confidence:double>")
    for applies, place, confidence in reversed(steps):
        out = F.when(applies & place.isNotNull(), F.struct(place.alias("place"), F.lit(confidence).alias("confidence"))).otherwise(out)
    return out
