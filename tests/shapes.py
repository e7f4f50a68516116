"""Small polygons for tests, and slow but plain counterparts of the geometry operators."""

from __future__ import annotations

import numpy as np

GEOM = "struct<kind:string,parts:array<array<array<struct<x:double,y:double>>>>>"


def ring(points):
    return [(float(x), float(y)) for x, y in [*points, points[0]]]


def box(x, y, w, h):
    return ring([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])


def geom(*parts):
    """Each part is a list of rings."""
    return ("Polygon" if len(parts) == 1 else "MultiPolygon", [list(p) for p in parts])


def star(rng, cx, cy, radius, corners):
    """Random star-shaped polygon, concave in general."""
    angles = np.sort(rng.uniform(0, 2 * np.pi, corners))
    radii = rng.uniform(0.3, 1.0, corners) * radius
    return ring(list(zip(cx + radii * np.cos(angles), cy + radii * np.sin(angles))))


def segments(g):
    return [(*a, *b) for part in g[1] for r in part for a, b in zip(r, r[1:])]


def inside(x, y, g):
    odd = False
    for x1, y1, x2, y2 in segments(g):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _point_segment(px, py, s):
    x1, y1, x2, y2 = s
    d = np.array([x2 - x1, y2 - y1])
    w = np.array([px - x1, py - y1])
    t = np.clip(w @ d / (d @ d), 0, 1) if d @ d else 0.0
    return float(np.hypot(*(w - t * d)))


def _cross(s, t):
    def side(a, px, py):
        return (a[2] - a[0]) * (py - a[1]) - (a[3] - a[1]) * (px - a[0])

    return (
        side(s, t[0], t[1]) * side(s, t[2], t[3]) < 0
        and side(t, s[0], s[1]) * side(t, s[2], s[3]) < 0
    )


def distance(a, b):
    for one, two in ((a, b), (b, a)):
        if any(inside(*part[0][0], two) for part in one[1]):
            return 0.0
    best = np.inf
    for s in segments(a):
        for t in segments(b):
            if _cross(s, t):
                return 0.0
            best = min(
                best,
                _point_segment(s[0], s[1], t),
                _point_segment(s[2], s[3], t),
                _point_segment(t[0], t[1], s),
                _point_segment(t[2], t[3], s),
            )
    return best


def area(r):
    xy = np.asarray(r) - r[0]
    return float(np.sum(xy[:-1, 0] * xy[1:, 1] - xy[1:, 0] * xy[:-1, 1])) / 2


def clip_convex(subject, clip):
    """Intersection area of two convex counter-clockwise rings."""
    points = [np.array(p) for p in subject[:-1]]
    for a, b in zip(clip, clip[1:]):
        a, b = np.array(a), np.array(b)

        def side(p):
            return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])

        kept = []
        for p, q in zip(points, points[1:] + points[:1]):
            sp, sq = side(p), side(q)
            if sp >= 0:
                kept.append(p)
            if sp * sq < 0:
                kept.append(p + (q - p) * sp / (sp - sq))
        points = kept
        if not points:
            return 0.0
    return area([tuple(p) for p in points] + [tuple(points[0])])
