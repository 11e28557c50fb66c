"""Distance along a densified line, by branch and bound over the line's original segments.

A *densified* line has extra points every ``step`` metres of each original segment (linear in latitude and
longitude), so that a segment A-B is a run of *pieces*. The projection of a point P scores every piece: ``t =
clamp(dAP / dAB, 0, 1)`` (radial, not the perpendicular foot), candidate = the point ``t * dAB`` along the piece,
score = its distance to P. The strictly smallest score wins, the first piece wins ties, and the result is the
length of all pieces before it plus ``t * dAB``.

Here the pieces are never made. ``Lines`` keeps the original segments:

* piece j of a segment of length d runs from ``t_j = j * step / d`` to ``t_(j+1)`` (the last one to B): arithmetic;
* the pieces before j add up to the length of the curve from 0 to t_j, whose exact line integral (eight Gauss
  nodes) differs from the sum of the pieces' geodesic lengths by ``step^2 * curvature^2 / 24`` of it, about
  1e-12 for 10 m pieces. With ``step`` above ``SUMMED_STEP`` the few pieces are measured one by one;
* a tree of spheres over runs of segments (Earth-centred coordinates), and inside a segment halved piece ranges in
  capsules (straight chord plus sagitta), bound the score from below and above. Only ranges that can still hold the
  winner are followed down to single pieces, and only those few are scored with geodesics.

A piece that P is further from than its length has ``t = 1``, so its score is the distance from P to its end; chords are
turned into bounds on that distance by circles of the smallest and largest radius of curvature.
"""

from __future__ import annotations

import numpy as np

from ..functions import geodesic as geo

#: Up to this step the lengths of a segment's pieces are added up by the line integral.
SUMMED_STEP = 100.0
#: Scores this close (m) are equal: geodesics leave noise, and a line that comes by the same place twice must not be
#: decided by it. The first piece wins.
TIE = 1e-6
POINTS_AT_ONCE = 4096

_E2 = geo.WGS84_F * (2 - geo.WGS84_F)
#: Radii that bound the curvature of the ellipsoid from both sides (its own are 6335 and 6400 km).
_TIGHT, _WIDE = 6.33e6, 6.5e6
_SLACK = 1e-4
_X, _W = np.polynomial.legendre.leggauss(8)


def ecef(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Earth-centred coordinates (m) on the WGS84 ellipsoid, one row per point."""
    la, lo = np.radians(lat), np.radians(lon)
    sin, cos = np.sin(la), np.cos(la)
    n = geo.WGS84_A / np.sqrt(1 - _E2 * sin * sin)
    return np.stack([n * cos * np.cos(lo), n * cos * np.sin(lo), n * (1 - _E2) * sin], -1)


def _circle(chord: np.ndarray, radius: float) -> np.ndarray:
    """Arc of a chord on a circle."""
    return 2 * radius * np.arcsin(np.minimum(chord / (2 * radius), 1.0))


def _running_in(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of the values before each one, within consecutive groups, added up in order from zero."""
    out = np.zeros(len(x))
    at = start[size > 0]
    live = size[size > 0]
    k = 1
    while (more := live > k).any():                       # the k-th value of every group that has one
        at, live = at[more], live[more]
        out[at + k] = out[at + k - 1] + x[at + k - 1]
        k += 1
    return out


class Lines:
    """Several lines, prepared together: every step below is one array operation over all of them.

    ``lat, lon``: the points of all lines in order; ``first``: where each line begins (and the end of the last).
    Segments of no length (or none that converges) are left out."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, first: np.ndarray, step: float):
        lat, lon, first = np.asarray(lat, np.float64), np.asarray(lon, np.float64), np.asarray(first, np.int64)
        count = np.diff(first)
        line = np.repeat(np.arange(len(count)), np.maximum(count - 1, 0))
        i = np.arange(len(line)) + (first[:-1] - (np.cumsum(np.maximum(count - 1, 0)) - np.maximum(count - 1, 0)))[line]
        d, _ = geo.inverse(lat[i], lon[i], lat[i + 1], lon[i + 1]) if len(i) else (np.empty(0), None)
        keep = d > 0
        i, line = i[keep], line[keep]
        self.lat, self.lon, self.end_lat, self.end_lon, self.d = lat[i], lon[i], lat[i + 1] if len(i) else lat[:0], lon[i + 1] if len(i) else lon[:0], d[keep]
        self.step = float(step)
        n = np.where(self.d > step, np.floor(self.d / step), 0).astype(np.int64) if step > 0 else np.zeros(len(self.d), np.int64)
        self.pieces = np.where(n > 0, n - (n * step / self.d >= 1.0), 0).astype(np.int64) + 1
        self.n = len(self.d)
        self.segments = np.bincount(line, minlength=len(count)).astype(np.int64)
        if not self.n:
            return
        every = np.arange(self.n)
        self._summed = 0 < step <= SUMMED_STEP
        if not self._summed:
            self._first = np.cumsum(self.pieces) - self.pieces
            seg = np.repeat(every, self.pieces)
            j = np.arange(len(seg)) - self._first[seg]
            a, b = self.at(seg, j), self.at(seg, j + 1)
            length, _ = geo.inverse(*a, *b)
            self._before = np.concatenate([[0.0], np.cumsum(length)])
        self.total = self.before(every, self.pieces)
        start = np.cumsum(self.segments) - self.segments              # a line's first segment
        self.cum = _running_in(self.total, start, self.segments)
        # Longest piece of each segment, and how far the curve between two of its points may leave their chord.
        t = np.linspace(0, 1, 33)[None, :]
        fastest = self._speed(every[:, None], t).max(1) * 1.01
        self.longest = np.where(self.pieces > 1, fastest * np.minimum(step / self.d, 1.0), fastest) if step > 0 else fastest
        high = np.tan(np.radians(np.minimum(np.maximum(np.abs(self.lat), np.abs(self.end_lat)), 89.9)))
        self._bend = 1.6e-7 + 3.2e-7 * high
        self.longest_of_line = np.zeros(len(count))
        np.maximum.at(self.longest_of_line, line, self.longest)
        # Spheres over runs of 1, 2, 4 .. segments of a line; each centre lies on the line.
        centre = ecef(*self.at(every, self.pieces // 2))
        half = np.maximum(self.pieces // 2, self.pieces - self.pieces // 2)
        self.levels = [(centre, half * self.longest + _SLACK, self.segments)]
        while self.levels[-1][2].max() > 1:
            c, r, size = self.levels[-1]
            up = (size + 1) // 2
            of = np.repeat(np.arange(len(up)), up)
            k = np.arange(len(of)) - np.repeat(np.cumsum(up) - up, up)
            left = (np.cumsum(size) - size)[of] + 2 * k
            right = np.where(2 * k + 1 < size[of], left + 1, left)
            gap = np.linalg.norm(c[left] - c[right], axis=1)
            r_left, r_right = np.maximum(r[left], gap + r[right]), np.maximum(r[right], gap + r[left])
            self.levels.append((np.where((r_left <= r_right)[:, None], c[left], c[right]), np.minimum(r_left, r_right), up))

    def at(self, seg: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Latitude and longitude of where piece j of a segment begins (j = pieces: the segment's end)."""
        t = j * self.step / self.d[seg]
        end, begin = j >= self.pieces[seg], j == 0
        lat = np.where(begin, self.lat[seg], np.where(end, self.end_lat[seg], self.lat[seg] + (self.end_lat[seg] - self.lat[seg]) * t))
        lon = np.where(begin, self.lon[seg], np.where(end, self.end_lon[seg], self.lon[seg] + (self.end_lon[seg] - self.lon[seg]) * t))
        return lat, lon

    def _speed(self, seg: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Metres per unit of t along the segment."""
        dlat, dlon = np.radians(self.end_lat[seg] - self.lat[seg]), np.radians(self.end_lon[seg] - self.lon[seg])
        phi = np.radians(self.lat[seg]) + t * dlat
        sin = np.sin(phi)
        w = 1 - _E2 * sin * sin
        north, east = geo.WGS84_A * (1 - _E2) / (w * np.sqrt(w)) * dlat, geo.WGS84_A / np.sqrt(w) * np.cos(phi) * dlon
        return np.sqrt(north * north + east * east)

    def before(self, seg: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Summed length of the pieces before piece j of a segment."""
        if not self._summed:
            return self._before[self._first[seg] + j] - self._before[self._first[seg]]
        t = np.minimum(j * self.step / self.d[seg], 1.0)
        t = np.where(j >= self.pieces[seg], 1.0, t)
        arc = t / 2 * (self._speed(seg[:, None], t[:, None] * (_X + 1) / 2) * _W).sum(1)
        return np.where(self.pieces[seg] == 1, np.where(j > 0, self.d[seg], 0.0), arc)

    def project(self, lat: np.ndarray, lon: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Distance along its line of each point; 0.0 on a line without segments (and for line -1)."""
        lat, lon, line = np.asarray(lat, np.float64), np.asarray(lon, np.float64), np.asarray(line, np.int64)
        out = np.zeros(len(lat))
        if self.n:
            real = np.flatnonzero((line >= 0) & (self.segments[line] > 0) & ~np.isnan(lat) & ~np.isnan(lon))
            for i in range(0, len(real), POINTS_AT_ONCE):
                r = real[i: i + POINTS_AT_ONCE]
                out[r] = self._project(lat[r], lon[r], line[r])
        return out

    def _project(self, lat: np.ndarray, lon: np.ndarray, line: np.ndarray) -> np.ndarray:
        at = ecef(lat, lon)
        most = np.full(len(lat), np.inf)                    # an upper bound of each point's smallest score

        def lower(p: np.ndarray, gap: np.ndarray, more: np.ndarray | float) -> None:
            """Some piece scores at most the distance to a point of the line, ``gap`` away by chord, plus ``more``."""
            np.minimum.at(most, p, _circle(gap, _TIGHT) + more + _SLACK)

        # From the top: a node is (line, place in its level).
        p, k = np.arange(len(lat)), np.zeros(len(lat), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            centre, radius, size = self.levels[level]
            node = (np.cumsum(size) - size)[line[p]] + k
            gap = np.linalg.norm(at[p] - centre[node], axis=1)
            lower(p, gap, self.longest_of_line[line[p]])
            keep = gap - radius[node] <= most[p]
            p, k, node = p[keep], k[keep], node[keep]
            if level:
                p, k = np.repeat(p, 2), np.repeat(2 * k, 2) + np.tile([0, 1], len(k))
                there = k < self.levels[level - 1][2][line[p]]
                p, k = p[there], k[there]
        # Piece ranges [a, b) of the segments that are left, halved until they are single pieces.
        seg, a, b = node, np.zeros(len(node), np.int64), self.pieces[node]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        while len(p):
            x, y = ecef(*self.at(seg, a)), ecef(*self.at(seg, b))
            q = at[p]
            way = y - x
            u = np.clip(((q - x) * way).sum(1) / np.maximum((way * way).sum(1), 1e-12), 0, 1)
            gap = np.linalg.norm(q - x - u[:, None] * way, axis=1)
            size = (b - a) * self.longest[seg]
            to_end = np.linalg.norm(q - y, axis=1)
            lower(p, to_end, np.where(to_end <= 2 * self.longest[seg], self.longest[seg], 0.0))     # further away, it is the score itself
            keep = gap - (self._bend[seg] * size * size / 8 + _SLACK) <= most[p]
            single = keep & (b - a == 1)
            if single.any():
                done.append((p[single], seg[single], a[single], to_end[single]))
            keep &= ~single
            p, seg, a, b = p[keep], seg[keep], a[keep], b[keep]
            mid = (a + b) // 2
            p, seg = np.repeat(p, 2), np.repeat(seg, 2)
            a, b = np.stack([a, mid], 1).ravel(), np.stack([mid, b], 1).ravel()
        p, seg, j, to_end = (np.concatenate(c) for c in zip(*done, strict=True))
        # A piece further away than its own length scores the distance to its end.
        far = np.linalg.norm(at[p] - ecef(*self.at(seg, j)), axis=1) > 2 * self.longest[seg]
        keep = np.where(far, _circle(to_end, _WIDE) - _SLACK, 0.0) <= most[p]
        p, seg, j = p[keep], seg[keep], j[keep]
        a_lat, a_lon = self.at(seg, j)
        b_lat, b_lon = self.at(seg, j + 1)
        length, azimuth = geo.inverse(a_lat, a_lon, b_lat, b_lon)
        real = length > 0
        p, seg, j, a_lat, a_lon, b_lat, b_lon, length, azimuth = (z[real] for z in (p, seg, j, a_lat, a_lon, b_lat, b_lon, length, azimuth))
        reach, _ = geo.inverse(a_lat, a_lon, lat[p], lon[p])
        along = length * np.clip(reach / length, 0.0, 1.0)
        score, _ = geo.inverse(*geo.direct(a_lat, a_lon, azimuth, along), lat[p], lon[p])
        lost = np.isnan(score)
        if lost.any():
            score[lost] = geo.inverse(b_lat[lost], b_lon[lost], lat[p[lost]], lon[p[lost]])[0]
        score = np.where(np.isnan(score) | np.isnan(along), np.inf, score)
        least = np.full(len(lat), np.inf)
        np.minimum.at(least, p, score)
        tied = np.flatnonzero(score <= least[p] + TIE)
        order = tied[np.lexsort((j[tied], seg[tied], p[tied]))]
        out = np.zeros(len(lat))
        ok = order[np.concatenate([[True], p[order][1:] != p[order][:-1]])] if len(order) else order
        ok = ok[np.isfinite(score[ok])]
        out[p[ok]] = self.cum[seg[ok]] + self.before(seg[ok], j[ok]) + along[ok]
        return out


class PlanarLines:
    """The same rule with latitude and longitude taken as a plane: only correctly rounded operations on the
    original segments (no densifying), so that an SQL engine reproduces it bit for bit."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, first: np.ndarray, step: float = 0.0):
        self.lat, self.lon, self.first = np.asarray(lat, np.float64), np.asarray(lon, np.float64), np.asarray(first, np.int64)

    def project(self, lat: np.ndarray, lon: np.ndarray, line: np.ndarray) -> np.ndarray:
        lat, lon, line = np.asarray(lat, np.float64), np.asarray(lon, np.float64), np.asarray(line, np.int64)
        out = np.zeros(len(lat))
        for k in np.unique(line[line >= 0]).tolist():
            rows = np.flatnonzero(line == k)
            points = slice(self.first[k], self.first[k + 1])
            out[rows] = self._one(self.lat[points], self.lon[points], lat[rows], lon[rows])
        return out

    @staticmethod
    def _one(lat: np.ndarray, lon: np.ndarray, p_lat: np.ndarray, p_lon: np.ndarray, budget: int = 2_000_000) -> np.ndarray:
        dy, dx = np.diff(lat), np.diff(lon)
        d = np.sqrt(dy * dy + dx * dx)
        keep = d != 0
        lat, lon, dy, dx, d = lat[:-1][keep], lon[:-1][keep], dy[keep], dx[keep], d[keep]
        out = np.zeros(len(p_lat))
        if not len(d):
            return out
        cum = np.concatenate([[0.0], np.cumsum(d)[:-1]])
        rows = max(1, budget // len(d))
        for i in range(0, len(p_lat), rows):
            p, q = p_lat[i: i + rows, None], p_lon[i: i + rows, None]
            y, x = p - lat, q - lon
            t = np.clip(np.sqrt(y * y + x * x) / d, 0.0, 1.0)
            cy, cx = lat + t * dy - p, lon + t * dx - q
            best = np.argmin(np.sqrt(cy * cy + cx * cx), axis=1)
            out[i: i + rows] = cum[best] + d[best] * t[np.arange(len(best)), best]
        return out


#: Line classes by metric.
METRICS = {"wgs84": Lines, "planar": PlanarLines}


class Line:
    """One line of either metric."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, step: float, metric: str = "wgs84"):
        self.lines = METRICS[metric](lat, lon, [0, len(lat)], step)

    def project(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        return self.lines.project(lat, lon, np.zeros(len(lat), np.int64))
