"""Coordinate systems as WKT text: is it metric, are two the same on the ground, and the 2-D form of a 3-D one."""

from __future__ import annotations

import re

from ..model import ConfigError

_TOKEN = re.compile(r'\s*("(?:[^"]|"")*"|[A-Za-z_][A-Za-z0-9_]*|[-+0-9.eE]+|[\[\](),])')
PROJECTED, GEOGRAPHIC = ("PROJCS", "PROJCRS", "PROJECTEDCRS"), ("GEOGCS", "GEOGCRS", "GEODCRS", "GEOCCS")


class Node(list):
    """Arguments of a WKT keyword: texts as written, and nodes."""

    def __init__(self, name: str, args=()):
        super().__init__(args)
        self.name = name

    def __str__(self) -> str:
        return f"{self.name}[{','.join(map(str, self))}]"

    def every(self, *names: str):
        """Nodes of these names, outer ones first."""
        for a in [self] if self.name in names else []:
            yield a
        for a in self:
            if isinstance(a, Node):
                yield from a.every(*names)


def parse(wkt: str) -> Node:
    tokens, at = [], 0
    while at < len(wkt.rstrip()):
        m = _TOKEN.match(wkt, at)
        if not m:
            raise ConfigError(f"no coordinate system: {wkt[:60]!r}")
        tokens.append(m[1])
        at = m.end()
    tokens = tokens[::-1]

    def item():
        t = tokens.pop() if tokens else None
        if t is None or t in "[](),":
            raise ConfigError(f"no coordinate system: {wkt[:60]!r}")
        if not tokens or tokens[-1] not in "[(":
            return t
        tokens.pop()
        node = Node(t.upper())
        while True:
            node.append(item())
            end = tokens.pop() if tokens else None
            if end in ("]", ")"):
                return node
            if end != ",":
                raise ConfigError(f"no coordinate system: {wkt[:60]!r}")

    out = item()
    if tokens or not isinstance(out, Node):
        raise ConfigError(f"no coordinate system: {wkt[:60]!r}")
    return out


def _unit(node: Node) -> float | None:
    """Metres of the first length unit directly in a node, or in its axes."""
    for part in (node, *(a for a in node if isinstance(a, Node) and a.name == "AXIS")):
        for a in part:
            if isinstance(a, Node) and a.name in ("UNIT", "LENGTHUNIT") and len(a) > 1:
                return float(a[1])
    return None


def require_metric(wkt: str | None) -> str:
    """The text itself, if it names a projected system in metres; anything else is an error."""
    if not wkt:
        raise ConfigError("the coordinate system is missing; an inventory in metres needs one")
    found = next(parse(wkt).every(*PROJECTED), None)
    if found is None or _unit(found) != 1.0:
        raise ConfigError("the coordinate system must be projected, with metre units")
    return wkt


def horizontal(wkt: str) -> str:
    """A projected system with three axes as its 2-D form; others as they are."""
    tree = parse(wkt)
    for p in tree.every(*PROJECTED):
        for a in p.every("CS"):
            if a[0].upper() == "CARTESIAN" and a[1:2] == ["3"]:
                a[1] = "2"
                p[:] = [x for x in p if not (isinstance(x, Node) and x.name == "AXIS" and any(isinstance(y, Node) and y.name == "ORDER" and y[0] == "3" for y in x))]
                return str(tree)
    return wkt


def epsg(wkt: str) -> int | None:
    """The code of the projected system itself, if the text holds one."""
    found = next(parse(wkt).every(*PROJECTED), None)
    for a in found or ():
        if isinstance(a, Node) and a.name in ("AUTHORITY", "ID") and a[0].strip('"').upper() == "EPSG":
            return int(a[1].strip('"'))
    return None


def same_horizontal(a: str | None, b: str | None) -> bool:
    """Do both name the same projected system? By their codes; without, by everything but names, identifiers and the third
    axis. A missing or geographic system equals none."""
    if not a or not b:
        return False
    trees = [next(parse(horizontal(x)).every(*PROJECTED), None) for x in (a, b)]
    if None in trees:
        return False
    codes = [epsg(x) for x in (a, b)]
    if None not in codes:
        return codes[0] == codes[1]

    def bare(x):
        if not isinstance(x, Node):
            return x.strip('"').lower() if x.startswith('"') else float(x) if re.fullmatch(r"[-+0-9.eE]+", x) else x.lower()
        rest = x[1:] if x and not isinstance(x[0], Node) and x[0].startswith('"') and x.name not in ("PROJECTION", "METHOD", "PARAMETER", "AXIS") else x
        return x.name, tuple(bare(y) for y in rest if not (isinstance(y, Node) and y.name in ("AUTHORITY", "ID", "USAGE", "REMARK", "EXTENSION")))

    return bare(trees[0]) == bare(trees[1])
