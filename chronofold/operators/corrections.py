"""Positions, corrected areas and energies: column expressions over event tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.monitor import azimuth

#: Energy per quantum in keV (fixed value).
W_KEV = 13.7e-3
#: Angle of the wires that lie across, in degrees (fixed value).
WIRE_ANGLE = 30.0


def energy_estimates(df: DataFrame, g1: float, g2: float, prefixes: Sequence[str] = ("",)) -> DataFrame:
    """e_light = W cs1 / g1, e_charge = W cs2 / g2, e_ces their sum, for each prefix."""
    out = df
    for p in prefixes:
        light, charge = F.col(f"{p}cs1") * (W_KEV / g1), F.col(f"{p}cs2") * (W_KEV / g2)
        out = out.withColumns({f"{p}e_light": light, f"{p}e_charge": charge, f"{p}e_ces": light + charge})
    return out


def to_wire_frame(x: Column, y: Column, extra: float = 0.0) -> tuple[Column, Column]:
    """Coordinates turned by the wire angle."""
    a = math.radians(WIRE_ANGLE + extra)
    return x * math.cos(a) - y * math.sin(a), x * math.sin(a) + y * math.cos(a)


def near_wires(x: Column, y: Column, half_width: float = 28.0, radius: float = 60.0) -> Column:
    """Whether a place lies in the strip of the wires (region AB) and inside the radius; elsewhere is CD."""
    u, _ = to_wire_frame(x, y)
    return (F.abs(u) < half_width) & (F.hypot(x, y) < radius)


def electron_lifetime(drift: Column, lifetime: Column | float) -> Column:
    return F.exp(drift / lifetime)


def relative_light_yield(z: Column, rly: Column | float, slope: float, b: float) -> Column:
    """rly * (a (z^2 + b z) + 1) with a = slope * (rly - 1)."""
    r = rly if isinstance(rly, Column) else F.lit(rly)
    return r * (slope * (r - 1) * (z * z + b * z) + 1)


#: The corrections of cS2 in the order of application, and the sets of them that get a column: one digit for each correction, 1 if it
#: is included (fixed values).
CS2_FACTORS = ("bias", "xy", "segee", "pi", "relcy", "elife")
CS2_VARIANTS = (
    "111111", "100000", "110000", "101000", "111000", "110001", "000001", "010001",
    "011101", "101101", "110101", "111001", "111100", "111101", "111110",
)


def cs2_name(variant: str, out: str = "cs2") -> str:
    """cs2 with all corrections, else cs2_w and the names of those included."""
    included = [f for f, digit in zip(CS2_FACTORS, variant) if digit == "1"]
    return out if len(included) == len(CS2_FACTORS) else "_".join([f"{out}_w", *included])


def corrected_s2(area: Column, aft: Column, factors: dict[str, Column], variants: Sequence[str] = CS2_VARIANTS, prefix: str = "") -> dict[str, Column]:
    """Corrected area and area fraction top for each variant.

    factors: bias, xy_top, xy_bottom, segee, relcy divide; pi multiplies the bottom part in the fraction; elife multiplies the area alone, so the
    fraction stays known where there is no drift time. A correction that a variant leaves out counts as 1.
    """
    out, one = {}, F.lit(1.0)
    for variant in variants:
        on = {f for f, digit in zip(CS2_FACTORS, variant) if digit == "1"}
        use = lambda name, group=None: factors[name] if (group or name) in on else one  # noqa: B023, E731
        shared = use("bias") * use("segee")
        top, bottom = area * aft / (shared * use("xy_top", "xy")), area * (1 - aft) / (shared * use("xy_bottom", "xy"))
        name = cs2_name(variant)
        out[f"{prefix}{name}"] = (top + bottom) / use("relcy") * use("elife")
        out[f"{prefix}cs2_area_fraction_top{name[3:]}"] = F.try_divide(top, top + bottom * use("pi"))
    return out


def corrected_s1(area: Column, factors: dict[str, Column], prefix: str = "") -> dict[str, Column]:
    """cs1 divided by all factors (peakbias, xyz, time), and with each one left out: cs1_wo_<factor>corr."""
    out = {}
    for skip in ("", *factors):
        value = area
        for name, f in factors.items():
            value = value if name == skip else value / f
        out[f"{prefix}cs1" + (f"_wo_{skip}corr" if skip else "")] = value
    return out


def region_value(x: Column, y: Column, gain: float | dict, average: float | dict, efficiency: float | dict, half_width: float = 28.0, radius: float = 60.0) -> Column:
    """gain / average * efficiency of the wire region AB or of CD; a number counts for both."""
    both = lambda v: v if isinstance(v, dict) else {"ab": v, "cd": v}
    g, m, e = both(gain), both(average), both(efficiency)
    value = {r: g[r] / m[r] * e[r] for r in ("ab", "cd")}
    return F.when(near_wires(x, y, half_width, radius), value["ab"]).otherwise(value["cd"])


def corrected_areas(
    events: DataFrame, maps: dict[str, Column], gain: float | dict, average: float | dict, efficiency: float | dict, pi_bottom: float, rel_charge_yield: float,
    lifetime: float, rel_light: Column, half_width: float = 28.0, radius: float = 60.0,
) -> DataFrame:
    """events with corrected areas of the main and alternate S1 and S2, every variant.

    maps: s1_bias, alt_s1_bias, s2_bias, alt_s2_bias (added to 1), s1_xyz, and for each prefix s2_xy_top and s2_xy_bottom, as columns (apply_map
    gives them). The alternate S1 is corrected at the place of the event; the alternate S2 with its interaction's drift time.
    """
    cols: dict[str, Column] = {}
    for p in ("", "alt_"):
        cols |= corrected_s1(F.col(f"{p}s1_area").cast("double"), {"peakbias": 1 + maps[f"{p}s1_bias"], "xyz": maps["s1_xyz"], "time": rel_light}, p)
        drift = F.col(f"{p}s2_interaction_drift_time" if p else "drift_time")
        factors = {
            "bias": 1 + maps[f"{p}s2_bias"], "xy_top": maps[f"{p}s2_xy_top"], "xy_bottom": maps[f"{p}s2_xy_bottom"],
            "segee": region_value(F.col(f"{p}s2_x"), F.col(f"{p}s2_y"), gain, average, efficiency, half_width, radius), "pi": F.lit(float(pi_bottom)),
            "relcy": F.lit(float(rel_charge_yield)), "elife": electron_lifetime(drift, lifetime),
        }
        cols |= corrected_s2(F.col(f"{p}s2_area").cast("double"), F.col(f"{p}s2_area_fraction_top").cast("double"), factors, prefix=p)
    return events.withColumns(cols)


def peak_corrections(
    peaks: DataFrame, maps: dict[str, Column], gain: float | dict, average: float | dict, efficiency: float | dict, lifetime: float, drift_velocity: float, gate_time: float,
    rel_light: float, half_width: float = 28.0, radius: float = 60.0,
) -> DataFrame:
    """peaks with the corrections of each one taken alone; what belongs to S2s is null for others, cs1_wo_xyzcorr and cs2_wo_xycorr
    are 0 for peaks of another type."""
    area, aft, drift = F.col("area").cast("double"), F.col("area_fraction_top").cast("double"), F.col("drift_time")
    two = F.col("type") == 2
    elife = electron_lifetime(drift, lifetime)
    xy_top, xy_bottom = area * aft / maps["s2_xy_top"], area * (1 - aft) / maps["s2_xy_bottom"]
    segee = region_value(F.col("x"), F.col("y"), gain, average, efficiency, half_width, radius)
    top, bottom = xy_top / segee, xy_bottom / segee
    of_s2 = {
        "z_obs_ms": drift_velocity * (gate_time - drift), "s1_xyz_correction_factor": 1 / maps["s1_xyz"], "s1_rel_light_yield_correction_factor": F.lit(1 / rel_light),
        "cs2_wo_timecorr": (xy_top + xy_bottom) * elife, "cs2_wo_elifecorr": top + bottom, "cs2_area_fraction_top": F.try_divide(top, top + bottom),
        "cs2": (top + bottom) * elife, "cs2_bottom": bottom * elife,
    }
    return peaks.withColumns({
        "cs1_wo_xyzcorr": F.when(F.col("type") == 1, area / (1 + maps["s1_bias"])).otherwise(0.0),
        "cs2_wo_xycorr": F.when(two, area / (1 + maps["s2_bias"])).otherwise(0.0), **{k: F.when(two, v) for k, v in of_s2.items()},
    })


def event_positions(df: DataFrame, drift_velocity: float, gate: float, correction: str = "r_correction", z_bias: Column | None = None, prefix: str = "") -> DataFrame:
    """z, r, theta from the observed place and drift time, the radial correction applied (no scaling at the centre)."""
    x, y, drift = (F.col(f"{prefix}{c}") for c in ("x", "y", "drift_time"))
    z_obs = -drift_velocity * drift.cast("double") + gate
    r_obs = F.hypot(x, y)
    r = r_obs + F.col(correction)
    scale = F.when(r_obs == 0, 0.0).otherwise(F.try_divide(r, r_obs))
    z = z_obs - (z_bias if z_bias is not None else F.lit(0.0))
    return df.withColumns({
        f"{prefix}r_naive": r_obs, f"{prefix}r": r, f"{prefix}x_corrected": x * scale, f"{prefix}y_corrected": y * scale, f"{prefix}theta": F.atan2(y, x),
        f"{prefix}z_naive": z_obs, f"{prefix}z": z,
    })


def position_spread(df: DataFrame, xs: Sequence[str], ys: Sequence[str], valid: Column, out: str = "s2_recon") -> DataFrame:
    """Mean place over algorithms and sqrt(var x + var y) (population); null unless all are there and valid."""
    there = valid
    for c in (*xs, *ys):
        there = there & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    mean = lambda cs: sum((F.col(c) for c in cs), F.lit(0.0)) / len(cs)
    var = lambda cs: sum((F.pow(F.col(c) - mean(cs), 2) for c in cs), F.lit(0.0)) / len(cs)
    return df.withColumns({
        f"{out}_avg_x": F.when(there, mean(xs)), f"{out}_avg_y": F.when(there, mean(ys)), f"{out}_pos_diff": F.when(there, F.sqrt(var(xs) + var(ys))),
    })


def veto_azimuth(x: Column, y: Column) -> Column:
    return azimuth(x, y)


def classify(df: DataFrame, area: str = "area", rise: str = "rise_time", aft: str = "area_fraction_top", coincidence: str = "tight_coincidence",
             s1_rise: tuple[float, float, float] = (80.0, 50.0, 20.0), s1_aft: tuple[float, float] = (-1.0, 2.0), s2_min_area: float = 10.0, s1_min_coincidence: int = 2) -> Column:
    """Type 1: fast enough for its area, even or bottom-heavy light and enough channels; type 2: slower and large enough; else 0.

    s1_rise: norm * exp(-area / tau) + const; s1_aft: 10^(slope * aft + offset) bounds the rise time of top-heavy light.
    """
    norm, tau, const = s1_rise
    slope, offset = s1_aft
    fast = (F.col(rise) <= norm * F.exp(-F.col(area) / tau) + const) & (F.col(rise) <= F.pow(F.lit(10.0), slope * F.col(aft) + offset))
    one = fast & (F.col(coincidence) >= s1_min_coincidence)
    return F.when(one, 1).when(~fast & (F.col(area) >= s2_min_area), 2).otherwise(0)
