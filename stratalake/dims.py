"""Small fixed tables: climate stages, namespaces, smoothing weights, proxy properties."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

# Climate-stage intervals (top and bottom in thousands of years, name, kind), one table per kind of archive.
ICE_STAGES = (
    (0, 14, "MIS 1", "warm"),
    (14, 29, "MIS 2", "cold"),
    (29, 57, "MIS 3", "inter"),
    (57, 71, "MIS 4", "cold"),
    (71, 130, "MIS 5", "warm"),
    (130, 191, "MIS 6", "cold"),
    (191, 243, "MIS 7", "warm"),
    (243, 300, "MIS 8", "cold_nodata"),
    (300, 337, "MIS 9", "warm_nodata"),
    (337, 374, "MIS 10", "cold_nodata"),
    (374, 424, "MIS 11", "warm"),
    (424, 527, "MIS 12", "cold"),
    (527, 545, "MIS 13", "warm"),
    (545, 621, "MIS 15", "warm"),
    (621, 676, "MIS 16", "cold"),
    (676, 712, "MIS 17", "warm"),
    (712, 761, "MIS 18", "cold"),
    (761, 790, "MIS 19", "warm"),
    (790, 814, "MIS 20", "cold"),
)
CAVE_STAGES = (
    (0, 14, "MIS 1", "warm"),
    (14, 29, "MIS 2", "cold"),
    (29, 57, "MIS 3", "inter"),
    (57, 71, "MIS 4", "cold"),
    (71, 130, "MIS 5", "warm"),
    (130, 191, "MIS 6", "cold"),
    (191, 243, "MIS 7", "warm"),
    (243, 300, "MIS 8", "cold"),
    (300, 337, "MIS 9", "warm"),
    (337, 374, "MIS 10", "cold"),
    (374, 424, "MIS 11", "warm"),
    (424, 533, "MIS 12", "cold"),
)
SCHEMES = {"ice": ICE_STAGES, "cave": CAVE_STAGES}
# How a kind of stage is drawn; other kinds are drawn as cold.
STAGE_KINDS = {"warm": "warm", "inter": "inter", "cold": "cold", "warm_nodata": "warm", "cold_nodata": "cold"}
# Public vocabularies, and the base of the identifiers minted here (a parameter wherever it is used).
BASE = "https://stratalake.example/id/"
NAMESPACES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "geo": "http://www.opengis.net/ont/geosparql#",
    "sf": "http://www.opengis.net/ont/sf#",
    "crm": "http://www.cidoc-crm.org/cidoc-crm/",
    "crmsci": "http://www.ics.forth.gr/isl/CRMsci/",
    "sosa": "http://www.w3.org/ns/sosa/",
    "qudt": "http://qudt.org/schema/qudt/",
    "unit": "http://qudt.org/vocab/unit/",
    "prov": "http://www.w3.org/ns/prov#",
    "dct": "http://purl.org/dc/terms/",
    "dcat": "http://www.w3.org/ns/dcat#",
    "own": BASE,
}
# The reference system of all geometry text, and the window and order of the smoothing.
CRS = "<http://www.opengis.net/def/crs/EPSG/0/4326>"
WINDOW, POLYORDER = 11, 2
# Scale and offset that take each proxy's ages to years before 2000.
DATUM_SHIFTS = {"ch4": (1000.0, 50.0), "d18o": (1000.0, 50.0), "dd": (1.0, 0.0), "do2n2": (1000.0, 50.0), "dust": (1000.0, -8.0)}


def iri(name: str, base: str = BASE) -> str:
    """The full form of prefix:local; `own:` stands for the base of minted identifiers."""
    prefix, _, local = name.partition(":")
    return (base if prefix == "own" else NAMESPACES[prefix]) + local


def stages(spark: SparkSession, scheme: str | None = None) -> DataFrame:
    """Stage intervals (scheme, top, bottom, stage, kind); at most 31 rows."""
    rows = [(s, float(a), float(b), n, k) for s, table in SCHEMES.items() if scheme in (None, s) for a, b, n, k in table]
    return spark.createDataFrame(rows, "scheme string, top double, bottom double, stage string, kind string")


@cache
def savgol_weights(window: int = WINDOW, polyorder: int = POLYORDER) -> tuple[tuple[float, ...], ...]:
    """The hat matrix of a polynomial fit to `window` points: row k gives the fitted value at point k."""
    if window % 2 == 0 or polyorder >= window:
        raise ValueError("window must be odd and larger than polyorder")
    a = np.vander(np.arange(window) - window // 2, polyorder + 1).astype(float)
    return tuple(map(tuple, (a @ np.linalg.pinv(a)).tolist()))
