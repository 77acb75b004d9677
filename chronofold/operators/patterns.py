"""Channel patterns against expected ones, and the light of calibration pulses: array expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions import special


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def settled(c: Column) -> Column:
    """c, computed once a row: the optimizer does not write it out again inside the steps (and their lambdas) that use it."""
    return F.when(F.spark_partition_id() >= 0, c)


def two_nll(observed: Column, efficiency: Column, area: Column, photon: float = 1.0) -> Column:
    """Modified Poisson -2 ln L of a pattern, less that of a perfect fit: the area is shared out by efficiency and counted in photons.
    Null where no channel has any efficiency; channels that saw nothing, or of which nothing is expected, add nothing."""
    whole = _sum(efficiency)
    mu = F.transform(efficiency, lambda e: e * F.try_divide(area, whole * photon))

    def term(m, o):
        n = o / F.lit(photon)
        return F.when((m > 0) & (n > 0), 2 * (m - n + n * F.ln(n / m))).when(m.isNotNull(), F.lit(0.0))

    return _sum(F.zip_with(mu, observed, term))


def pattern_fit(
    df: DataFrame, n_top: int, alive: Sequence[bool], photon: float = 1.0, min_area: float = 0.0, max_radius: float | None = None, observed: str = "area_per_channel",
    efficiency: str = "efficiency", area: str = "area", aft: str = "area_fraction_top", prefix: str = "",
) -> DataFrame:
    """df with two_nll, two_nll_top and two_nll_bottom: of all living channels, the first n_top, and the others. The area goes to the two
    arrays by the area fraction top. Null below min_area, without a fraction, or outside max_radius (of x, y)."""
    good = F.array(*[F.lit(bool(a)) for a in alive])
    top = lambda i: i < F.lit(n_top)
    pick = lambda c, side: F.filter(F.col(c).cast("array<double>"), lambda v, i: F.get(good, i) & side(i))
    size, share = F.col(area).cast("double"), F.col(aft)
    parts = {"": (lambda i: F.lit(True), size), "_top": (top, size * share), "_bottom": (lambda i: ~top(i), size * (1 - share))}
    fit = (size > min_area) & (share >= 0)
    if max_radius is not None:
        fit = fit & (F.col("x") * F.col("x") + F.col("y") * F.col("y") < max_radius**2)
    return df.withColumns({f"{prefix}two_nll{n}": F.when(fit, two_nll(pick(observed, side), pick(efficiency, side), a, photon)) for n, (side, a) in parts.items()})


def aft_probabilities(df: DataFrame, key: Sequence[str], expected: str, area: str, aft: str, photon: float = 1.0) -> DataFrame:
    """(key, continuous, discrete, photon_continuous, photon_discrete): how likely the area fraction top is under the expected one, for the
    area and for the number of photons. NaN where one of them is missing or unphysical."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in (expected, area, aft)]
    photons = [values[0], values[1] / photon, values[2]]
    test, density = special.aft_probability, lambda p, n, f: special.aft_probability(p, n, f, True)
    found = {"continuous": (test, values), "discrete": (density, values), "photon_continuous": (test, photons), "photon_discrete": (density, photons)}
    return df.select(*key, *[special.column(f, *v).alias(n) for n, (f, v) in found.items()])


def led_records(df: DataFrame, length: int, baseline: tuple[int, int], data: str = "data", fragment: str = "record_i") -> DataFrame:
    """First fragments of exactly that length, with baseline, baseline_rms, and data turned over around the baseline."""
    head = F.slice(F.col(data), baseline[0] + 1, baseline[1] - baseline[0])
    n = float(baseline[1] - baseline[0])
    rows = df.where((F.col(fragment) == 0) & (F.size(data) == length)).withColumn("baseline", settled(_sum(F.transform(head, lambda x: x.cast("double"))) / n))
    b = F.col("baseline")
    spread = F.sqrt(_sum(F.transform(head, lambda x: (x - b) * (x - b))) / n)
    return rows.withColumns({"baseline_rms": settled(spread), data: settled(F.transform(data, lambda x: b - x))})


def led_windows(
    df: DataFrame, height: float, extension: tuple[int, int], earliest: int, default: int, length: int, averaging: int, led_on: bool = True, data: str = "data", by: Sequence[str] = ()
) -> DataFrame:
    """df with triggered, hit_position, window_left and window_right. A record's hit is its first rise over height times its noise, not
    before ``earliest``. Records without one take the commonest hit of their group (the smallest of equals), or
    ``default`` if there is none or the light was off. No window reaches beyond the record."""
    c, over = F.col(data), F.col("baseline_rms") * height
    samples = F.transform(c, lambda v, i: F.when((v >= over) & (i >= earliest) & ((i == 0) | (F.get(c, i - 1) < over)), i))
    rows = df.withColumn("_hit", settled(F.array_min(F.filter(samples, lambda i: i.isNotNull()))))
    last = length - averaging - extension[1]
    usual = F.lit(default)
    if led_on:
        counts = rows.where("_hit is not null").groupBy(*by, "_hit").agg(F.count(F.lit(1)).alias("n"))
        modes = counts.groupBy(*by).agg(F.min_by("_hit", F.struct(-F.col("n"), F.col("_hit"))).alias("_mode"))
        rows = rows.join(modes, list(by), "left") if by else rows.join(F.broadcast(modes.select("_mode")))
        usual = F.when(F.col("_mode").isNotNull(), F.least("_mode", F.lit(last))).otherwise(F.lit(default))
    place = F.when(F.col("_hit").isNotNull(), F.least("_hit", F.lit(last))).otherwise(usual).cast("int")
    out = rows.withColumns({"triggered": F.col("_hit").isNotNull(), "hit_position": settled(place)})
    return out.withColumns({"window_left": F.col("hit_position") + extension[0], "window_right": F.col("hit_position") + extension[1]}).drop("_hit", "_mode")


def led_light(df: DataFrame, noise: tuple[int, int], averaging: int, step: int, data: str = "data") -> DataFrame:
    """df with amplitude_led, amplitude_noise (the maxima in both windows) and area: the mean over windows that grow by step up to averaging."""
    c, left, right = F.col(data), F.col("window_left"), F.col("window_right")
    within = lambda a, z: F.slice(c, F.greatest(a, F.lit(0)) + 1, F.greatest(z - F.greatest(a, F.lit(0)), F.lit(0)))
    grown = [_sum(F.transform(within(left, right + extra), lambda x: x.cast("double"))) for extra in range(0, averaging + step, step)]
    total = grown[0]
    for g in grown[1:]:
        total = total + g
    return df.withColumns({"amplitude_led": F.array_max(within(left, right)), "amplitude_noise": F.array_max(within(F.lit(noise[0]), F.lit(noise[1]))), "area": total / float(len(grown))})
