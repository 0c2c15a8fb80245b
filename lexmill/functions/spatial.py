"""Cells of the H3 grid as columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import hexagons as H

#: Resolution of the samplers' strata.
RESOLUTION = 3


def h3_cell(lat: Column, lon: Column, resolution: int = RESOLUTION, *, in_range: bool = True) -> Column:
    """The cell's index as text; null where a coordinate is null, not finite or, with ``in_range``, not on the globe.

    Rows of one place repeat its coordinates, so each pair of a batch is placed once.
    """
    if not 0 <= resolution <= H.FINEST:
        raise ValueError(f"resolutions are 0 to {H.FINEST}")

    @F.pandas_udf("string")
    def place(y: pd.Series, x: pd.Series) -> pd.Series:
        pairs = np.stack((y.to_numpy(np.float64, na_value=np.nan), x.to_numpy(np.float64, na_value=np.nan)), axis=1)
        good = np.isfinite(pairs).all(axis=1)
        if in_range:
            good &= (np.abs(pairs) <= (90, 180)).all(axis=1)
        out = np.full(len(pairs), None, object)
        if good.any():
            points, which = np.unique(pairs[good], axis=0, return_inverse=True)
            out[good] = np.array(H.names(H.cells(points[:, 0], points[:, 1], resolution)), object)[which.ravel()]
        return pd.Series(out)

    return place(lat.cast("double"), lon.cast("double"))


_POINTS = "array<struct<lat: double, lon: double>>"


def h3_outline(cell: Column) -> Column:
    """The corners of a cell, counter-clockwise; longitudes go on below -180 where it crosses 180 degrees.  Meant for distinct cells."""

    @F.pandas_udf(_POINTS)
    def trace(cells: pd.Series) -> pd.Series:
        return cells.map(lambda c: None if c is None else [{"lat": y, "lon": x} for y, x in H.unwrapped(H.outline(int(c, 16)))])

    return trace(cell)


def h3_centre(cell: Column) -> Column:
    @F.pandas_udf("struct<lat: double, lon: double>")
    def middle(cells: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if c is None else H.centre(int(c, 16)) for c in cells], columns=["lat", "lon"])

    return F.when(cell.isNotNull(), middle(cell))


def bad_coordinates(rows: DataFrame, lat: str = "lat", lon: str = "lon", *, in_range: bool = True) -> DataFrame:
    """``offender``: coordinates that are there but give no cell."""
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    fine = ~F.isnan(y) & ~F.isnan(x) & (F.abs(y) < float("inf")) & (F.abs(x) < float("inf"))
    if in_range:
        fine = fine & y.between(-90, 90) & x.between(-180, 180)
    return rows.where(y.isNotNull() & x.isNotNull() & ~fine).select(F.concat_ws(" ", y.cast("string"), x.cast("string")).alias("offender"))


def with_cell(rows: DataFrame, resolution: int = RESOLUTION, *, lat: str = "lat", lon: str = "lon", name: str = "cell") -> DataFrame:
    """Rows with their cell, by which samples are stratified; a row without coordinates has none, and is never chosen."""
    return rows.withColumn(name, h3_cell(F.col(lat), F.col(lon), resolution))


def h3_histogram(rows: DataFrame, resolution: int = RESOLUTION, *, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``cell, n``; rows without coordinates are under a null cell."""
    # Places are counted before they are put into cells: they are fewer than rows.
    places = rows.groupBy(F.col(lat).alias("lat"), F.col(lon).alias("lon")).agg(F.count("*").alias("n"))
    return with_cell(places, resolution).groupBy("cell").agg(F.sum("n").alias("n"))
