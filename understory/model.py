"""Names, types and settings: attribute registry, segmentation specs, run configuration and its validation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

#: Standard point attributes and their Spark types.
STANDARD = {
    "X": "double", "Y": "double", "Z": "double", "gpstime": "double", "Intensity": "int", "ReturnNumber": "int", "NumberOfReturns": "int", "ScanDirectionFlag": "int",
    "EdgeOfFlightline": "int", "Classification": "int", "ScannerChannel": "int", "Synthetic_flag": "boolean", "Keypoint_flag": "boolean", "Withheld_flag": "boolean",
    "Overlap_flag": "boolean", "ScanAngle": "double", "ScanAngleRank": "int", "UserData": "int", "PointSourceID": "int", "R": "int", "G": "int", "B": "int", "NIR": "int",
}
RESERVED = ("Zref", "source_order__")
NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")
#: Labels of the diameter quality codes.
QUALITY = {1: "too_few_stem_slice_points", 2: "fallback_circle_estimate", 3: "rejected_or_unstable_fit", 4: "spline_fit"}


class ConfigError(ValueError):
    """A setting or a table that a run can't use."""


@dataclass(frozen=True)
class SegmentationSpec:
    """One segmentation of a cloud: the instance column and what belongs to it."""

    instance: str
    species: str | None = None
    probability: str | None = None
    score: str | None = None
    non_tree_ids: tuple[int, ...] = (0,)
    source: str | None = None

    def __post_init__(self):
        for n in self.columns:
            if not NAME.fullmatch(n):
                raise ConfigError(f"not an attribute name: {n!r}")
            if n in RESERVED:
                raise ConfigError(f"reserved attribute: {n}")
        if (self.species is None) != (self.probability is None):
            raise ConfigError("species and probability attributes come together or not at all")
        if self.source == "":
            raise ConfigError("empty source name")

    @property
    def columns(self) -> list[str]:
        return [c for c in (self.instance, self.species, self.probability, self.score) if c]

    @property
    def label(self) -> str:
        """The short name: the source, or the instance column without its usual prefix."""
        return self.source or self.instance.removeprefix("PredInstance_")


@dataclass(frozen=True)
class Config:
    specs: tuple[SegmentationSpec, ...] = ()
    enable_csp: bool = False
    voxel_resolution: float = 0.3
    geometry_k: int = 10
    verticality_weight: float = 0.0
    linearity_weight: float = 0.0
    sphericity_weight: float = 0.0
    seed_resolution: float = 0.1
    seed_z_min: float = 0.5
    seed_z_max: float = 2.0
    seed_quantile: float = 0.975
    seed_eps: float = 0.2
    slice_min: float = 0.3
    slice_max: float = 4.0
    slice_increment: float = 0.2
    slice_width: float = 0.1
    max_dbh: float = 1.0
    dbh_runs: int = 5
    metrics_grid: float = 0.01
    random_seed: int = 42
    dtm_resolution: float = 0.2
    dtm_candidate_resolution: float = 0.1
    stand_area_m2: float | None = None
    dbh_evidence: bool = True
    debug_outputs: bool = False
    #: Polygons: lists of rings, the outer one and its holes.
    aoi: tuple = field(default=())

    def validate(self) -> Config:
        names = [s.instance for s in self.specs]
        if len(set(names)) < len(names):
            raise ConfigError("duplicate instance attribute")
        labels = [s.label for s in self.specs]
        if len(set(labels)) < len(labels):
            raise ConfigError("duplicate source name")
        if not names and not self.enable_csp:
            raise ConfigError("no segmentation: name an instance attribute or enable the shortest-path segmentation")
        if self.enable_csp and "PredInstance_CSP" in names:
            raise ConfigError("PredInstance_CSP is made by the run itself")
        for n in ("voxel_resolution", "seed_resolution", "seed_eps", "slice_increment", "slice_width", "max_dbh", "metrics_grid", "dtm_resolution", "dtm_candidate_resolution"):
            if not getattr(self, n) > 0:
                raise ConfigError(f"{n} must be above 0")
        if self.slice_width > self.slice_increment / 2:
            raise ConfigError("slice_width is at most half of slice_increment")
        if not self.slice_min < self.slice_max or not self.seed_z_min < self.seed_z_max:
            raise ConfigError("an upper limit must be above its lower limit")
        if not 0 < self.seed_quantile < 1 or self.dbh_runs < 1 or self.geometry_k < 3:
            raise ConfigError("seed_quantile in (0, 1), dbh_runs at least 1, geometry_k at least 3")
        if self.dtm_candidate_resolution > self.dtm_resolution:
            raise ConfigError("dtm_candidate_resolution is at most dtm_resolution")
        return self


def parse_bool(x: str) -> bool:
    if x.lower() not in ("true", "1", "yes", "false", "0", "no"):
        raise ConfigError(f"true or false, not {x!r}")
    return x.lower() in ("true", "1", "yes")


def parse_ids(x: str) -> tuple[int, ...]:
    try:
        return tuple(int(i) for i in x.split(",") if i.strip())
    except ValueError as e:
        raise ConfigError(f"not a list of ids: {x!r}") from e


_OF_SPEC = {"species-attribute": "species", "species-probability-attribute": "probability", "score-attribute": "score", "non-tree-ids": "non_tree_ids", "source-name": "source"}


#: Options that steer readers, workers and scratch space. Spark's own settings do that here: they are checked and ignored.
IGNORED = (
    "read-chunk-size", "chunk-buffer", "dtm-workers", "dtm-streaming-threshold", "inventory-partitions", "inventory-workers", "inventory-index-workers", "inventory-index-queue-mb", "inventory-core-size",
    "inventory-buffer", "inventory-batch-points", "inventory-prefetch-mb", "inventory-decode-threads", "routing-workers", "geometry-threads",
)
CHOICES = {"dtm-strategy": ("auto", "spatial", "streaming"), "inventory-read-mode": ("auto", "spatial", "sequential", "copc-owned"), "seed-mode": ("automatic", "supplied")}


def parse_args(args: list[str]) -> tuple[dict[str, str], Config]:
    """(paths, config) from --name value pairs; options of a segmentation bind to the instance attribute before them."""
    if len(args) % 2:
        raise ConfigError("options come as --name value")
    paths, specs, values, modes = {}, [], {}, {}
    fields = {k.replace("_", "-"): k for k in Config.__dataclass_fields__}
    for name, value in zip(args[::2], args[1::2]):
        key = name.removeprefix("--")
        if key == "instance-attribute":
            specs.append({"instance": value})
        elif key in _OF_SPEC:
            if not specs:
                raise ConfigError(f"{name} needs an --instance-attribute before it")
            specs[-1][_OF_SPEC[key]] = parse_ids(value) if key == "non-tree-ids" else value
        elif key in ("input", "output-dir", "aoi-json", "dtm", "species-lookup", "seed-file"):
            paths[key] = value
        elif key in CHOICES:
            if value not in CHOICES[key]:
                raise ConfigError(f"{name} is one of {', '.join(CHOICES[key])}")
            modes[key] = value
        elif key in IGNORED:
            try:
                if float(value) < 0:
                    raise ValueError(value)
            except ValueError as e:
                raise ConfigError(f"{name} must be a number, 0 at least: {value!r}") from e
        elif key == "scratch-dir":
            pass
        elif key == "inventory-attributes":
            names = value.split(",")
            if not all(NAME.fullmatch(n) for n in names):
                raise ConfigError(f"{name} requires attribute names: {value!r}")
            specs += [{"instance": n} for n in names]
        elif key in fields and key not in ("specs", "aoi"):
            default = getattr(Config, fields[key])
            try:
                values[fields[key]] = parse_bool(value) if isinstance(default, bool) else int(value) if isinstance(default, int) else float(value)
            except ValueError as e:
                raise ConfigError(f"{name}: {e}") from e
        else:
            raise ConfigError(f"unknown option {name}")
    if modes.get("seed-mode") == "supplied" and "seed-file" not in paths:
        raise ConfigError("--seed-file is required when --seed-mode is supplied")
    if modes.get("seed-mode") == "automatic":
        paths.pop("seed-file", None)
    for need in ("input", "output-dir"):
        if need not in paths:
            raise ConfigError(f"--{need} is required")
    return paths, replace(Config(), specs=tuple(SegmentationSpec(**s) for s in specs), **values).validate()


def identity_seed(seed: int, dimension: str, instance: int) -> int:
    """A seed that depends on the tree alone, not on order or partitions: polynomial hash of its name."""
    out = seed % 2147483647
    for b in f"{dimension}:{instance}".encode():
        out = (out * 131 + b) % 2147483647
    return out


def partition_count(points: int, least: int = 64, most: int = 4096, each: int = 3_000_000) -> int:
    """Power of two for about three million points a partition."""
    n = least
    while n < most and n * each < points:
        n *= 2
    return n
