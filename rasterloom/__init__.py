"""Rasterloom: raster-and-object measurement expressed as Spark DataFrame plans."""
