"""Sequential float32 versions of the point operators, for expected values."""

import hashlib
import math
from collections import Counter

import numpy as np

f = np.float32


def distance(p, q):
    dx, dy = float(f(f(p[0]) - f(q[0]))), float(f(f(p[1]) - f(q[1])))
    return f(math.sqrt(dx * dx + dy * dy))


def balls(points, d):
    return [sum(distance(p, q) <= f(d) for q in points) for p in points]


def cells(points, d):
    side = f(float(f(d)) / (2 * math.sqrt(2)))
    return Counter((math.floor(f(f(x) / side)), math.floor(f(f(y) / side))) for x, y in points)


def totals(points, d, m):
    """(sure outliers, uncertain points) by the 3x3 and 7x7 blocks of cells."""
    c = cells(points, d)
    block = lambda i, j, r: sum(c.get((i + a, j + b), 0) for a in range(-r, r + 1) for b in range(-r, r + 1))
    sure = sum(n for (i, j), n in c.items() if block(i, j, 3) <= m)
    return sure, sum(n for (i, j), n in c.items() if block(i, j, 1) <= m < block(i, j, 3))


def farthest_first(points, k):
    """Positions of the centers."""
    picks = [0]
    while len(picks) < min(k, len(points)):
        near = [min(distance(p, points[c]) for c in picks) for p in points]
        if max(near) == 0:
            break
        picks.append(near.index(max(near)))
    return picks


def radius(points, centers):
    return max(min(distance(p, c) for c in centers) for p in points)


def three_rounds(points, k, parts):
    """Centers by parts of (position mod parts)."""
    core = []
    for part in range(parts):
        own = points[part::parts]
        core += [own[i] for i in farthest_first(own, k)]
    return [core[i] for i in farthest_first(core, k)]


def uniforms(positions, tag, seed):
    digest = lambda p: hashlib.md5(f"{tag}:{seed}:{int(p)}".encode()).hexdigest()
    return np.array([int(digest(p)[:8], 16) / 2.0**32 for p in positions])
