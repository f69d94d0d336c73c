"""Embankments from a raster: relief mask, thinning to lines one pixel wide, paths, and lines with their relief.

A blob is thinned and walked by one kernel call; blobs are independent of each other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.operators import raster
from tessera.operators.dem import Raster
from tessera.operators.lines import as_points, simplified
from tessera.operators.raster import RING
from tessera.sources.layers import POINTS

Pixel = tuple[int, int]


@dataclass(frozen=True)
class Rules:
    min_relief: float = 1.0
    max_relief: float = 15.0
    width: float = 60.0
    min_area: float = 400.0
    min_length: float = 100.0
    max_sinuosity: float = 2.0
    flat_relief: float = 10.0
    flat_scale: float = 200.0
    simplify: float = 3.0

    def pixels(self, length: float, px: float) -> int:
        """An odd number of pixels, three at least."""
        return max(3, int(np.rint(length / px)) | 1)


def thinned(on: np.ndarray) -> np.ndarray:
    """A line one pixel wide: border pixels go in two alternating passes while what is left stays connected."""
    a = np.pad(on.astype(bool), 1)
    while True:
        before = a.sum()
        for first in (True, False):
            p = [np.roll(a, (-dr, -dc), (0, 1)) for dr, dc in RING]  # from above, clockwise
            count = sum(x.astype(int) for x in p)
            turns = sum((~p[k] & p[(k + 1) % 8]).astype(int) for k in range(8))
            up, right, down, left = p[0], p[2], p[4], p[6]
            gone = (up & right & down, right & down & left) if first else (up & right & left, up & down & left)
            a = a & ~(a & (count >= 2) & (count <= 6) & (turns == 1) & ~gone[0] & ~gone[1])
        if a.sum() == before:
            return a[1:-1, 1:-1]


def paths(pixels: set[Pixel]) -> list[list[Pixel]]:
    """Pixel chains between ends and forks, then closed ones; a fork is where the ring around a pixel changes thrice or more."""
    near = {p: [q for q in ((p[0] + dr, p[1] + dc) for dr, dc in RING) if q in pixels] for p in pixels}

    def changes(p: Pixel) -> int:
        on = [(p[0] + dr, p[1] + dc) in pixels for dr, dc in RING]
        return sum(on[k] and not on[k - 1] for k in range(8))

    through = {p for p in pixels if changes(p) == 2}
    used: set[frozenset[Pixel]] = set()
    out: list[list[Pixel]] = []

    def follow(start: Pixel, nxt: Pixel) -> list[Pixel]:
        chain, seen = [start, nxt], {start, nxt}
        used.add(frozenset(chain))
        while chain[-1] in through:
            here = chain[-1]
            ahead = [q for q in near[here] if q not in seen]
            if not ahead:
                if start in near[here] and len(chain) > 2:
                    chain.append(start)
                break
            step = min(ahead, key=lambda q: (abs(q[0] - here[0]) + abs(q[1] - here[1]), q))  # straight before diagonal
            used.add(frozenset((here, step)))
            chain.append(step)
            seen.add(step)
        return chain

    for p in sorted(pixels - through):
        out += [follow(p, q) for q in near[p] if frozenset((p, q)) not in used]
    rest = pixels - {p for chain in out for p in chain}
    while rest:
        p = min(rest)
        if near[p]:
            out.append(follow(p, near[p][0]))
            rest -= set(out[-1])
        rest.discard(p)
    return out


def mask(dem: DataFrame, grid: Raster, rules: Rules, inside: DataFrame | None = None) -> DataFrame:
    """row, col, blob, relief of the pixels taken for embankments; ``inside`` (row, col) limits them.

    Relief within bounds where the ground around is flat, closed twice, without blobs that are too small.
    """
    size = rules.pixels(rules.width, grid.px)
    relief = raster.top_hat(dem, size)
    found = raster.relief_mask(dem, size, rules.pixels(rules.flat_scale, grid.px), rules.min_relief, rules.max_relief, rules.flat_relief)
    if inside is not None:
        found = found.join(inside.select("row", "col", F.lit(True).alias("in__")), ["row", "col"], "left").select("row", "col", (F.col("mask") & F.coalesce("in__", F.lit(False))).alias("mask"))
    large = raster.large_blobs(raster.closed(found, 2), int(rules.min_area / (grid.px * grid.px)))
    return large.join(relief.select("row", "col", "relief"), ["row", "col"])


def lines(pixels: DataFrame, grid: Raster, rules: Rules) -> DataFrame:
    """blob, path, pts, length, relief_median, relief_max of lines along blobs (row, col, blob, relief).

    Lines that are too short, or wind too much for their ends' distance, go.
    """
    ship(pixels.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf["row"].min()), int(pdf["col"].min())
        r, c = pdf["row"].to_numpy() - r0, pdf["col"].to_numpy() - c0
        shape = (int(r.max()) + 1, int(c.max()) + 1)
        on, relief = np.zeros(shape, bool), np.zeros(shape)
        on[r, c], relief[r, c] = True, pdf["relief"]
        rows = []
        for k, chain in enumerate(paths({(int(i), int(j)) for i, j in np.argwhere(thinned(on))})):
            rc = np.array(chain)
            xy = np.column_stack([grid.x0 + (rc[:, 1] + c0 + 0.5) * grid.px, grid.y1 - (rc[:, 0] + r0 + 0.5) * grid.px])
            xy = simplified(xy, rules.simplify)
            length, apart = float(np.hypot(*np.diff(xy, axis=0).T).sum()), float(np.hypot(*(xy[-1] - xy[0])))
            if length >= rules.min_length and apart >= 1e-6 and length <= rules.max_sinuosity * apart:
                z = relief[rc[:, 0], rc[:, 1]]
                rows.append((pdf["blob"].iloc[0], k, as_points(xy), length, float(np.median(z)), float(z.max())))
        return pd.DataFrame(rows, columns=["blob", "path", "pts", "length", "relief_median", "relief_max"])

    return pixels.groupBy("blob").applyInPandas(run, f"blob long, path long, pts {POINTS}, length double, relief_median double, relief_max double")


def detected(dem: DataFrame, grid: Raster, rules: Rules = Rules(), inside: DataFrame | None = None) -> DataFrame:
    return lines(mask(dem, grid, rules, inside), grid, rules)
