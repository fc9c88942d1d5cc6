"""Stem circles: algebraic fit, robust fit, taper splines and the diameter of one tree. Arrays of one tree at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Config, identity_seed
from .nearest import nearest_points


def pratt_fit(x: np.ndarray, y: np.ndarray, steps: int = 20, eps: float = 1e-12) -> np.ndarray:
    """(cx, cy, r) for each row of x and y: Pratt's algebraic fit, the smallest root of its characteristic polynomial by
    Newton steps from 0 with the published stop rules: the root is 0 where the polynomial's value grows, where it would
    be negative and where the steps don't end."""
    mx, my = x.mean(1, keepdims=True), y.mean(1, keepdims=True)
    u, v = x - mx, y - my
    z = u * u + v * v
    xx, yy, xy, xz, yz, zz = ((a * b).mean(1) for a, b in ((u, u), (v, v), (u, v), (u, z), (v, z), (z, z)))
    mz = xx + yy
    cov, var = xx * yy - xy * xy, zz - mz * mz
    a2 = 4 * cov - 3 * mz * mz - zz
    a1 = var * mz + 4 * cov * mz - xz * xz - yz * yz
    a0 = xz * xz * yy + yz * yz * xx - 2 * xz * yz * xy - var * cov
    t, last = np.zeros(len(x)), np.full(len(x), np.inf)
    live = np.ones(len(x), bool)
    with np.errstate(all="ignore"):
        for step in range(steps):
            f = a0 + t * (a1 + t * (a2 + 4 * t * t))
            worse = live & (np.abs(f) > np.abs(last))
            t, live, last = np.where(worse, 0.0, t), live & ~worse, f
            new = t - f / (a1 + t * (2 * a2 + 16 * t * t))
            near = np.abs((new - t) / new) < eps
            t = np.where(live, new, t)
            live &= ~near
            t = np.where(live & ((t < 0) | (step == steps - 1)), 0.0, t)
            if not live.any():
                break
        det = t * t - t * mz + cov
        cx, cy = (xz * (yy - t) - yz * xy) / det / 2, (yz * (xx - t) - xz * xy) / det / 2
        return np.column_stack([cx + mx[:, 0], cy + my[:, 0], np.sqrt(cx * cx + cy * cy + mz + 2 * t)])


def local_density(xy: np.ndarray, radius: float = 0.05) -> np.ndarray:
    """Points within the radius, itself included; sorted by x, so only a band is compared."""
    order = np.argsort(xy[:, 0], kind="stable")
    s = xy[order]
    lo, hi = np.searchsorted(s[:, 0], s[:, 0] - radius), np.searchsorted(s[:, 0], s[:, 0] + radius, side="right")
    out = np.empty(len(s), np.int64)
    for i in range(len(s)):
        d = s[lo[i] : hi[i]] - s[i]
        out[i] = ((d * d).sum(1) <= radius * radius).sum()
    back = np.empty_like(out)
    back[order] = out
    return back


def ransac_circle_fit(xy: np.ndarray, n_iterations: int = 1000, distance_threshold: float = 0.01, min_inliers: int = 3, seed: int = 0) -> dict:
    """The circle with the most 10-degree bins, then the most inliers; of equals the later. Stops at 30 of 36 bins.

    Samples of up to five points, drawn without replacement with weight density + 1 (exponential keys)."""
    n = len(xy)
    none = {"cx": float(xy[:, 0].mean()) if n else None, "cy": float(xy[:, 1].mean()) if n else None, "r": None, "inliers": 0, "bins": 0}
    if n < 3:
        return none
    rng, w = np.random.default_rng(seed), local_density(xy) + 1.0
    best, score, m = none, (-1, -1), min(5, n)
    chunk = max(1, min(n_iterations, 2_000_000 // n))
    for at in range(0, n_iterations, chunk):
        size = min(chunk, n_iterations - at)
        pick = np.argpartition(rng.exponential(size=(size, n)) / w, m - 1, axis=1)[:, :m]
        c = pratt_fit(xy[pick, 0], xy[pick, 1])
        dx, dy = xy[None, :, 0] - c[:, :1], xy[None, :, 1] - c[:, 1:2]
        with np.errstate(invalid="ignore"):
            near = np.abs(np.hypot(dx, dy) - c[:, 2:]) < distance_threshold
        count = near.sum(1)
        for i in np.flatnonzero((count >= min_inliers) & np.isfinite(c).all(1)):
            angles = np.degrees(np.arctan2(dy[i, near[i]], dx[i, near[i]])) % 360
            bins = len(np.unique((angles // 10).astype(int)))
            if (bins, int(count[i])) >= score:
                score = (bins, int(count[i]))
                best = {"cx": float(c[i, 0]), "cy": float(c[i, 1]), "r": float(c[i, 2]), "inliers": score[1], "bins": bins}
                if bins >= 30:
                    return best
    return best


class Spline:
    """Natural cubic smoothing spline (Reinsch form): df degrees of freedom, or the smallest generalised cross-validation."""

    def __init__(self, x: np.ndarray, y: np.ndarray, df: float | None = None):
        n, h = len(x), np.diff(x)
        self.x = x
        q, r = np.zeros((n, n - 2)), np.zeros((n - 2, n - 2))
        for j in range(n - 2):
            q[j, j], q[j + 1, j], q[j + 2, j] = 1 / h[j], -1 / h[j] - 1 / h[j + 1], 1 / h[j + 1]
            r[j, j] = (h[j] + h[j + 1]) / 3
            if j + 1 < n - 2:
                r[j, j + 1] = r[j + 1, j] = h[j + 1] / 6
        k = q @ np.linalg.solve(r, q.T)
        value, vector = np.linalg.eigh((k + k.T) / 2)
        value = np.maximum(value, 0)
        turned = vector.T @ y
        trace = lambda lam: float((1 / (1 + lam * value)).sum())
        if df is not None:
            lo, hi = -20.0, 20.0
            for _ in range(200):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if trace(np.exp(mid)) > df else (lo, mid)
            lam = np.exp((lo + hi) / 2)
        else:
            grid = np.exp(np.linspace(-18, 12, 241))
            gcv = [float(((turned * (g * value / (1 + g * value))) ** 2).sum()) / max(1e-12, (1 - trace(g) / n)) ** 2 for g in grid]
            lam = grid[int(np.argmin(gcv))]
        self.g = vector @ (turned / (1 + lam * value))
        self.c = np.concatenate([[0.0], np.linalg.solve(r, q.T @ self.g), [0.0]])

    def __call__(self, at: float) -> float:
        x, g, c = self.x, self.g, self.c
        h = np.diff(x)
        if at <= x[0]:
            return float(g[0] + (at - x[0]) * ((g[1] - g[0]) / h[0] - h[0] * c[1] / 6))
        if at >= x[-1]:
            return float(g[-1] + (at - x[-1]) * ((g[-1] - g[-2]) / h[-1] + h[-1] * c[-2] / 6))
        i = min(int(np.searchsorted(x, at, side="right")) - 1, len(x) - 2)
        a, b = (x[i + 1] - at) / h[i], (at - x[i]) / h[i]
        return float(a * g[i] + b * g[i + 1] + ((a**3 - a) * c[i] + (b**3 - b) * c[i + 1]) * h[i] ** 2 / 6)


def slices_of(cfg: Config) -> np.ndarray:
    """Lower edges."""
    return cfg.slice_min + cfg.slice_increment * np.arange(int((cfg.slice_max - cfg.slice_width - cfg.slice_min) / cfg.slice_increment + 1e-9) + 1)


#: What becomes of a slice.
STATUS = ("fitted", "outlier_2sd", "growth_1_3x", "radius_below_0_04m", "too_few_points", "no_fit")


def slice_status(r: list[float | None], n: list[int] | None = None) -> list[str]:
    """What becomes of each slice's radius. Those further than two standard deviations from the median go; then, from the
    second slice on, those under 4 cm and those that grew by over 1.3 on the smallest kept so far: a slice's fate depends
    on the ones before it. n: the slices' points, to tell those with under three."""
    got = [x for x in r if x is not None]
    out = ["fitted" if x is not None else "too_few_points" if n is not None and n[i] < 3 else "no_fit" for i, x in enumerate(r)]
    if len(got) > 1:
        mid, sd = float(np.median(got)), float(np.std(got, ddof=1))
        out = ["outlier_2sd" if s == "fitted" and abs(x - mid) > 2 * sd else s for s, x in zip(out, r)]
    low = np.inf
    for i, x in enumerate(r):
        if out[i] != "fitted":
            continue
        if i and x < 0.04:
            out[i] = "radius_below_0_04m"
        elif i and x > 1.3 * low:
            out[i] = "growth_1_3x"
        else:
            low = min(low, x)
    return out


def reject_radii(r: list[float | None]) -> list[float | None]:
    """The radii, None for those that the quality rules reject."""
    return [x if s == "fitted" else None for x, s in zip(r, slice_status(r))]


def stem_features(xyz: np.ndarray, k: int) -> np.ndarray:
    """Planarity and Verticality of each point from its k nearest points, itself included."""
    n, out = len(xyz), np.full((len(xyz), 2), np.nan)
    near = nearest_points(xyz, xyz, k)
    for at in range(0, n, 50_000):
        p = xyz[near[at : at + 50_000]]
        p = p - p.mean(1, keepdims=True)
        value, vector = np.linalg.eigh(np.einsum("nki,nkj->nij", p, p) / max(1, near.shape[1] - 1))
        with np.errstate(all="ignore"):
            out[at : at + 50_000, 0] = np.where(value[:, 2] > 0, (value[:, 1] - value[:, 0]) / value[:, 2], np.nan)
        out[at : at + 50_000, 1] = 1 - np.abs(vector[:, 2, 0])
    return out


def fit_tree(band: np.ndarray, features: np.ndarray | None, cfg: Config, seed: int, iterations: int = 500, ground: float | None = None) -> dict:
    """One run over the points (X, Y, height) of a stem band: dbh, position, quality code and the slices.

    Codes: 1 under three points; 2 the mean of up to three circles (no diameter if there are none or it can't be); 3 a
    spline that can't be; 4 a spline. All but 4 stand at the band's mean."""
    mean = band[:, :2].mean(0) if len(band) else np.array([np.nan, np.nan])
    found = {"dbh": None, "x": float(mean[0]), "y": float(mean[1]), "code": 1, "slices": []}
    if len(band) < 3:
        return found
    edges, slices = slices_of(cfg), []
    for i, lo in enumerate(edges):
        on = (band[:, 2] >= lo) & (band[:, 2] < lo + cfg.slice_width)
        p = band[on, :2]
        if len(p) >= 100 and features is not None:
            f = features[on]
            if np.isfinite(f).any(0).all():
                q = min(0.99, 1 - np.sqrt(100 / len(p)) + 0.05)
                with np.errstate(invalid="ignore"):
                    p = p[(f > np.nanquantile(f, q, axis=0)).all(1)]
        c = ransac_circle_fit(p, iterations, seed=(seed + i) % 2147483647) if on.sum() >= 3 else {"cx": None, "cy": None, "r": None}
        slices.append({"slice_id": i + 1, "z_lo_m": float(lo), "z_hi_m": float(lo + cfg.slice_width), "ground_z": ground, "n_points": int(on.sum()), "n_fit_points": len(p) if on.sum() >= 3 else 0, "circle_x": c["cx"], "circle_y": c["cy"], "radius_m": c["r"], "spline_x": None, "spline_y": None, "spline_r": None})
    for s, status in zip(slices, slice_status([s["radius_m"] for s in slices], [s["n_points"] for s in slices])):
        s["status"] = status
    found["slices"] = slices
    use = [s for s in slices if s["status"] == "fitted"]
    # the first slice's centre counts even if its radius went
    centres = [s for i, s in enumerate(slices) if s["status"] == "fitted" or i == 0 and s["circle_x"] is not None]
    plausible = lambda d: d is not None and np.isfinite(d) and 0 <= d <= cfg.max_dbh
    if len(use) <= 3:
        d = 2 * float(np.mean([s["radius_m"] for s in use])) if use else None
        return found | {"dbh": d if plausible(d) else None, "code": 2}
    height = lambda xs: np.array([s["z_lo_m"] for s in xs])
    r = Spline(height(use), np.array([s["radius_m"] for s in use]), 3)
    x, y = (Spline(height(centres), np.array([s[c] for s in centres])) for c in ("circle_x", "circle_y"))
    for s in slices:
        s |= {"spline_x": x(s["z_lo_m"]), "spline_y": y(s["z_lo_m"]), "spline_r": r(s["z_lo_m"])}
    at = 1.3 + cfg.slice_increment / 2
    d, at_x, at_y = 2 * r(at), x(at), y(at)
    if not plausible(d) or abs(at_x - mean[0]) > 5 or abs(at_y - mean[1]) > 5:
        return found | {"code": 3}
    return found | {"dbh": d, "x": at_x, "y": at_y, "code": 4}


def median_run(runs: list[dict]) -> dict:
    """The fitted run at the middle rank by diameter if more than half fitted; else the first with the commonest code
    (the smaller on ties) and no diameter. ``chosen`` is its number."""
    fitted = sorted((i for i, r in enumerate(runs) if r["dbh"] is not None), key=lambda i: runs[i]["dbh"])
    spread = runs[fitted[-1]]["dbh"] - runs[fitted[0]]["dbh"] if fitted else None
    if 2 * len(fitted) > len(runs):
        i = fitted[(len(fitted) + 1) // 2 - 1]
        return runs[i] | {"fitted": len(fitted), "spread": spread, "chosen": i}
    codes = [r["code"] for r in runs]
    i = codes.index(min(codes, key=lambda c: (-codes.count(c), c)))
    return runs[i] | {"dbh": None, "fitted": len(fitted), "spread": spread, "chosen": i}


_SLICE = "struct<slice_id:int,z_lo_m:double,z_hi_m:double,ground_z:double,n_points:int,n_fit_points:int,circle_x:double,circle_y:double,radius_m:double,status:string,spline_x:double,spline_y:double,spline_r:double>"
_RUN = "struct<run:int,seed:bigint,dbh_m:double,quality_code:int,reported:boolean>"
DBH = f"segmentation_source string, instance_dimension string, instance_id bigint, dbh_x double, dbh_y double, dbh_z double, dbh_m double, dbh_quality_code int, dbh_runs int, dbh_runs_fitted int, dbh_spread_m double, dbh_band_points bigint, dbh_fits array<{_RUN}>, dbh_slices array<{_SLICE}>"
DBH_COLUMNS = ("segmentation_source", "instance_dimension", "instance_id", "dbh_x", "dbh_y", "dbh_z", "dbh_m", "dbh_quality_code", "dbh_runs", "dbh_runs_fitted", "dbh_spread_m", "dbh_band_points", "dbh_fits", "dbh_slices")


def measure_band(band: np.ndarray, ref: np.ndarray, features: np.ndarray | None, cfg: Config, dimension: str, instance: int) -> list:
    """The values of DBH from dbh_x on. band: X, Y, height, sorted; ref: their original Z. Position heights are the mean
    ground and 1.3 m, at code 1 the mean original Z."""
    ground = float((ref - band[:, 2]).mean())
    if features is None and len(band) > cfg.geometry_k:
        features = stem_features(band, cfg.geometry_k)
    seed, n = identity_seed(cfg.random_seed, dimension, instance), cfg.dbh_runs if len(band) >= 3 else 1
    seeds = [(seed + i) % 2147483647 for i in range(n)]
    runs = [fit_tree(band, features, cfg, s, ground=ground) for s in seeds]
    best = median_run(runs)
    fits = [{"run": i + 1, "seed": s, "dbh_m": r["dbh"], "quality_code": r["code"], "reported": i == best["chosen"]} for i, (s, r) in enumerate(zip(seeds, runs))]
    z = float(ref.mean()) if best["code"] == 1 else ground + 1.3
    return [best["x"], best["y"], z, best["dbh"], best["code"], n, best["fitted"], best["spread"], len(band), fits, best["slices"]]


def tree_diameters(points: DataFrame, cfg: Config, strict: bool = False) -> DataFrame:
    """Diameter of each (segmentation, tree) from its thinned stem band: X, Y, Z (height over ground) and, if there,
    Zref (the original Z), Planarity and Verticality; without those they are made from the band's points.

    Only the open band reaches the group function, thinned before, so that a giant tree stays within a task. The seed
    comes from the tree's name, and points are sorted, so order and partitions don't matter. A tree whose measurement
    fails has code 9 and no values; with ``strict`` it stops the job."""
    keys = ["segmentation_source", "instance_dimension", "instance_id"]
    used = [c for c in ("X", "Y", "Z", "Zref", "Planarity", "Verticality") if c in points.columns]

    def measure(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        source, dimension, instance = key
        f = f.sort_values(["X", "Y", "Z"], kind="stable")
        band = f[["X", "Y", "Z"]].to_numpy(float)
        ref = f["Zref"].to_numpy(float) if "Zref" in f else band[:, 2]
        features = f[["Planarity", "Verticality"]].to_numpy(float) if "Planarity" in f and "Verticality" in f else None
        try:
            row = measure_band(band, ref, features, cfg, dimension, int(instance))
        except Exception:
            if strict:
                raise
            row = [None, None, None, None, 9, None, None, None, len(band), None, None]
        return pd.DataFrame([[source, dimension, instance, *row]], columns=list(DBH_COLUMNS))

    band = points.select(*keys, *used).where((F.col("Z") > cfg.slice_min) & (F.col("Z") < cfg.slice_max))
    return band.groupBy(*keys).applyInPandas(measure, DBH)


def simple_diameters(points: DataFrame, slice_min: float = 1.2, slice_max: float = 1.4, random_seed: int = 42, id_col: str = "TreeID") -> DataFrame:
    """(id, X, Y, DBH, quality_flag): one circle over one slice of each tree, its diameter 2 m at most; under three
    points the mean position, no diameter and flag 1."""
    kind = dict(points.dtypes)[id_col]

    def measure(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        xy = f.sort_values(["X", "Y", "Z"], kind="stable")[["X", "Y"]].to_numpy(float)
        if len(xy) < 3:
            row = [float(xy[:, 0].mean()), float(xy[:, 1].mean()), None, 1]
        else:
            c = ransac_circle_fit(xy, 500, seed=identity_seed(random_seed, id_col, int(key[0])))
            row = [c["cx"], c["cy"], None if c["r"] is None else min(2 * c["r"], 2.0), 4]
        return pd.DataFrame([[key[0], *row]], columns=[id_col, "X", "Y", "DBH", "quality_flag"])

    part = points.select(id_col, "X", "Y", "Z").where((F.col("Z") > slice_min) & (F.col("Z") < slice_max))
    return part.groupBy(id_col).applyInPandas(measure, f"`{id_col}` {kind}, X double, Y double, DBH double, quality_flag int")
