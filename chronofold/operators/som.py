"""Classification of peaklets by a self-organising map.

A peaklet becomes a vector: the logs of the times in which each tenth of its waveform's area comes, of its area, and its area fraction top. The
nearest neuron of the weight cube names its place on the map, the colour there its class, and a table the type of the class. The map is of fixed
size and goes with the function; distances are computed block by block in Arrow batches, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronofold.operators.executor import floats, lists

#: Vectors whose distances to all neurons are held at once.
BLOCK = 512


@dataclass(frozen=True)
class Som:
    """cube: neurons by their place (x, y, features); image: a colour for each place; norms: what the ten log times and the log area are divided by, and what is
    added to the area; types: the classes of each type, where a class is the rank of its colour; samples: length of a waveform with its padding."""

    cube: np.ndarray
    image: np.ndarray
    norms: Sequence[float]
    types: Mapping[int, Sequence[int]]
    samples: int = 200
    n_top: int = 253
    reduced: bool = False

    def classes(self) -> np.ndarray:
        """The class of each place: colours in ascending order count from 0."""
        x, y, _ = self.cube.shape
        if self.image.shape[:2] != (x, y):
            raise ValueError("the image does not fit the weight cube")
        return np.unique(self.image.reshape(x * y, -1), axis=0, return_inverse=True)[1].reshape(x, y)


def tenths(wave: np.ndarray, dt: float, samples: int, n: int = 10) -> np.ndarray:
    """Time in which each n-th part of the area comes; the last one goes on to the end of the padding. Zeros for an empty waveform."""
    data = np.zeros(samples)
    data[: min(len(wave), samples)] = np.maximum(wave[:samples], 0.0)
    total = data.sum()
    if total == 0:
        return np.zeros(n)
    filled = np.concatenate([[0.0], np.cumsum(data)]) / np.cumsum(data)[-1]
    at = np.interp(np.linspace(0.0, 1.0 - 1.0 / n, n), filled, np.arange(samples + 1) * dt)
    return np.diff(np.append(at, samples * dt))


def features(waves: tuple[np.ndarray, np.ndarray], dt: np.ndarray, area: np.ndarray, channels: tuple[np.ndarray, np.ndarray], som: Som) -> np.ndarray:
    """One vector per row, from (values, offsets) of the waveforms and of the areas per channel."""
    n = len(area)
    times = np.array([tenths(waves[0][waves[1][i] : waves[1][i + 1]], dt[i], som.samples) for i in range(n)]).reshape(n, 10)
    top = np.array([channels[0][channels[1][i] : min(channels[1][i + 1], channels[1][i] + som.n_top)].sum() for i in range(n)])
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.nan_to_num(np.clip(np.where(top / area > 0, top / area, 0.0), 0.0, 1.0))
        size = np.log10(area + som.norms[11] + 1)
    logs = np.log10(np.maximum(times, 1.0)) / np.asarray(som.norms[:10])
    logs = logs[:, 1:] if som.reduced else logs
    return np.column_stack([logs, size / som.norms[10], share])


def nearest_neuron(vectors: np.ndarray, cube: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(x, y) of the nearest neuron of each vector, the first of equally near ones."""
    neurons = cube.reshape(-1, cube.shape[-1])
    out = np.zeros(len(vectors), dtype=np.int64)
    for a in range(0, len(vectors), BLOCK):
        part, distance = vectors[a : a + BLOCK], 0.0
        for k in range(neurons.shape[1]):
            distance = distance + (part[:, k, None] - neurons[None, :, k]) ** 2
        out[a : a + BLOCK] = np.argmin(np.sqrt(distance), axis=1)
    return np.unravel_index(out, cube.shape[:2])


def classify(peaklets: DataFrame, som: Som, key: Sequence[str], use_som: bool = True) -> DataFrame:
    """(key, type, vanilla_type, som_type, som_sub_type, loc_x_som, loc_y_som).

    peaklets: type, area, dt, data, area_per_channel. Only types 1 and 2 meet the map; the others keep their type as type and class, and have no place. A class
    without a type is its own type. type is the map's, or the one before with use_som off.
    """
    classes = som.classes()
    kinds = {c: t for t, members in som.types.items() for c in members}
    table = np.array([kinds.get(c, c) for c in range(int(classes.max()) + 1)])

    def run(batches):
        for batch in batches:
            kind = floats(batch, "type")
            old = np.nan_to_num(kind, nan=-1).astype(np.int64)
            met = np.flatnonzero(np.isin(kind, (1, 2)))
            some = batch.take(pa.array(met))
            sub, new, place = old.copy(), old.copy(), np.zeros((2, batch.num_rows), dtype=np.int64)
            if len(met):
                vectors = features(lists(some, "data"), floats(some, "dt"), floats(some, "area"), lists(some, "area_per_channel"), som)
                x, y = nearest_neuron(vectors, som.cube)
                sub[met] = classes[x, y]
                new[met] = table[sub[met]]
                place[0, met], place[1, met] = x, y
            nothing, absent = np.isnan(kind), ~np.isin(kind, (1, 2))
            whole = lambda v: pa.array(v, pa.int32(), mask=nothing)  # noqa: B023, E731
            cols = [whole(new if use_som else old), whole(old), whole(new), whole(sub), pa.array(place[0], pa.int32(), mask=absent), pa.array(place[1], pa.int32(), mask=absent)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key), *cols], names=[*key, *names])

    names = ["type", "vanilla_type", "som_type", "som_sub_type", "loc_x_som", "loc_y_som"]
    fields = ", ".join([*(f"{c} {peaklets.schema[c].dataType.simpleString()}" for c in key), *(f"{n} int" for n in names)])
    return peaklets.select(*dict.fromkeys([*key, "type", "area", "dt", "data", "area_per_channel"])).mapInArrow(run, fields)
