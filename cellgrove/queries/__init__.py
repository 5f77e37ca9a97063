"""Every operator over the driver's tables, with an independent SQL twin where SQL can express it."""

from __future__ import annotations


def registry():
    from . import overlays, pipelines, rasters, sinks, spatial, tables

    return [tables, spatial, overlays, rasters, pipelines, sinks]
