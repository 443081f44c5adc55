"""Plain-Python reference implementations used to check the Spark operators."""

from __future__ import annotations

from collections import defaultdict


def brute_streaks(rows, limit):
    """rows: (device, ts_ms, seq, value). Returns alerts (device, start, count, ts)."""
    by_dev = defaultdict(list)
    for d, t, s, v in rows:
        by_dev[d].append((t, s, v))
    out = []
    for d, items in by_dev.items():
        prev = None
        start = cnt = None
        for t, s, v in sorted(items):
            if prev is None or prev >= v:
                start, cnt = t, 1
            else:
                cnt += 1
            prev = v
            if cnt >= limit:
                out.append((d, start, cnt, t))
    return sorted(out)


def brute_bin(v, start, step, count):
    if v is None:
        return None
    edges = [start + i * step for i in range(count)]
    for e in edges:
        if e >= v:
            return e
    return edges[-1]


def brute_changelog(rows, start, step, count):
    """rows: (seq, ts_ms, value) -> (seq, bin, running count)."""
    seen = defaultdict(int)
    out = []
    for s, t, v in sorted(rows, key=lambda r: (r[1], r[0])):
        b = brute_bin(v, start, step, count)
        seen[b] += 1
        out.append((s, b, seen[b]))
    return sorted(out)
