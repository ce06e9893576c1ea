"""Radio formulas as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the public propagation and antenna models.
UE_HEIGHT_M = 1.5
ANTENNA_GAIN_DBI = 14.0
H_BEAMWIDTH_DEG, V_BEAMWIDTH_DEG = 70.0, 10.0
FRONT_TO_BACK_DB, SIDE_LOBE_DB = 25.0, 20.0
METROPOLITAN_DB = 3.0
LEAST_KM = 0.02
SHANNON_ALPHA, SNIR_MIN_DB, MOST_EFFICIENCY = 0.6, -10.0, 4.4
CQI_EFFICIENCY = (0.1523, 0.2344, 0.3770, 0.6016, 0.8770, 1.1758, 1.4766, 1.9141, 2.4063, 2.7305, 3.3223, 3.9023, 4.5234, 5.1152, 5.5547)
EARTH_KM = 8500.0


def path_loss_db(f_mhz: float, km: Column, mast_m: Column, urban: Column, suburban: Column) -> Column:
    """Median loss of the Hata and COST-231 formulas, blended over environments by weight
    (the rest is open land), never below free space."""
    # The coefficients of the published formulas.
    log = math.log10
    f, d, hb = min(f_mhz, 2000.0), F.greatest(km, F.lit(LEAST_KM)), F.log10(mast_m)
    handset = (1.1 * log(f) - 0.7) * UE_HEIGHT_M - (1.56 * log(f) - 0.8)
    high = f_mhz > 1500.0
    start = 46.3 + 33.9 * log(f) + 10 * log(f_mhz / f) if high else 69.55 + 26.16 * log(f)
    town = F.lit(start - handset) - 13.82 * hb + (44.9 - 6.55 * hb) * F.log10(d)
    fc = min(max(f_mhz, 150.0), 2000.0)
    off_suburb = 2 * log(fc / 28) ** 2 + 5.4
    off_open = 4.78 * log(fc) ** 2 - 18.33 * log(fc) + 40.94
    blend = town + urban * (METROPOLITAN_DB if high else 0.0) - suburban * off_suburb - (1 - urban - suburban) * off_open
    return F.greatest(blend, 32.45 + 20 * log(f_mhz) + 20 * F.log10(d))


def antenna_gain_db(off_azimuth: Column, off_tilt: Column) -> Column:
    """Gain of a sector antenna off its boresight (degrees), in dBi."""
    phi = F.pmod(off_azimuth + 180.0, F.lit(360.0)) - 180.0
    across = F.least(12 * F.pow(phi / H_BEAMWIDTH_DEG, 2), F.lit(FRONT_TO_BACK_DB))
    down = F.least(12 * F.pow(off_tilt / V_BEAMWIDTH_DEG, 2), F.lit(SIDE_LOBE_DB))
    return ANTENNA_GAIN_DBI - F.least(across + down, F.lit(FRONT_TO_BACK_DB))


def linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10)


def spectral_efficiency(sinr_db: Column) -> Column:
    """Attenuated Shannon bound, bit/s/Hz."""
    return F.when(sinr_db < SNIR_MIN_DB, 0.0).otherwise(F.least(SHANNON_ALPHA * F.log2(1 + linear(sinr_db)), F.lit(MOST_EFFICIENCY)))


def cqi(sinr_db: Column) -> Column:
    """Highest index whose efficiency the Shannon bound reaches; 0: none."""
    bound = F.log2(1 + linear(sinr_db))
    return F.size(F.filter(F.array(*map(F.lit, CQI_EFFICIENCY)), lambda e: e <= bound))


def area_class(density: Column, urban: float = 2900.0, suburban: float = 850.0) -> Column:
    return F.when(density >= urban, "urban").when(density >= suburban, "suburban").otherwise("rural")


def environment_weights(density: Column, urban: float = 2900.0, suburban: float = 850.0) -> tuple[Column, Column]:
    """Weights of the urban and the suburban loss: linear ramps between the classes'
    thresholds, the suburban one from half its threshold on."""
    ramp = lambda lo, hi: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (density - lo) / (hi - lo)))
    u = ramp(suburban, urban)
    return u, ramp(suburban / 2, suburban) * (1 - u)


def logistic(x: Column) -> Column:
    return 0.5 * (1 + F.tanh(0.5 * x))


def erlang_b(traffic: Column, servers: Column) -> Column:
    """Blocking probability by the recursion over servers, inside one expression."""
    steps = F.when(servers > 0, F.sequence(F.lit(1), servers.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.lit(1.0), lambda b, k: traffic * b / (k + traffic * b))


def knife_edge_db(v: Column) -> Column:
    """Loss over one edge for a diffraction parameter."""
    x = v - 0.1
    return F.when(v > -0.78, 6.9 + 20 * F.log10(F.sqrt(x * x + 1) + x)).otherwise(0.0)


def fresnel_m(d1: Column, d2: Column, ghz: float) -> Column:
    """Radius of the first zone, metres; distances in km."""
    return 17.3 * F.sqrt(d1 * d2 / (ghz * (d1 + d2)))


def earth_bulge_m(d1: Column, d2: Column) -> Column:
    return 500.0 * d1 * d2 / EARTH_KM


def serves(level: Column, threshold: float, margin: float = 14.2) -> Column:
    """Indoor service: the outdoor level clears the threshold by the entry loss."""
    return F.coalesce(level >= threshold + margin, F.lit(False))
