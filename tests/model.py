"""Single-threaded models of the stateful operators, written from their definitions."""

from collections import defaultdict


def trades(ticks):
    """ticks: (key, seq, ltt, vtt, ltq) -> (key, seq, qty)"""
    state, out = defaultdict(lambda: (0, 0)), []
    for key, seq, ltt, vtt, ltq in sorted(ticks, key=lambda t: (t[0], t[1])):
        s_ltt, s_vtt = state[key]
        if ltt > s_ltt or vtt > s_vtt:
            qty = vtt - s_vtt if s_vtt > 0 else ltq
            if qty > 0:
                out.append((key, seq, qty))
            state[key] = (ltt, vtt)
    return out


def reset_alerts(buckets, width, threshold):
    """buckets: (key, b, paise) -> (key, b, value, first_b)"""
    live, out = defaultdict(list), []
    for key, b, paise in sorted(buckets):
        held = [x for x in live[key] if width is None or x[0] > b - width] + [(b, paise)]
        value = sum(x[1] for x in held)
        if value >= threshold:
            out.append((key, b, value, held[0][0]))
            held = []
        live[key] = held
    return out


def sliding_alerts(buckets, width, threshold, base_width):
    """-> (key, b, value, first_b, base value)"""
    by_key, out = defaultdict(list), []
    for key, b, paise in sorted(buckets):
        by_key[key].append((b, paise))
    for key, rows in by_key.items():
        for at in range(rows[0][0], rows[-1][0] + width):
            held = [x for x in rows if at - width < x[0] <= at]
            value = sum(x[1] for x in held)
            if held and value >= threshold:
                out.append((key, at, value, held[0][0], sum(x[1] for x in rows if at - base_width < x[0] <= at)))
    return sorted(out)


def registry(alerts):
    """alerts: (reg_key, alert_ms, tie, paise) of one day
    -> (reg_key, tie, count, paise so far, minutes, first gap, last gap)"""
    seen, out = defaultdict(list), []
    for key, ms, tie, paise in sorted(alerts):
        seen[key].append((ms, paise))
        times = [t for t, _ in seen[key]]
        gaps = [(b - a) / 1000 for a, b in zip(times, times[1:])]
        first, last = (gaps[0], gaps[-1]) if len(times) >= 3 else (None, None)
        out.append((key, tie, len(times), sum(p for _, p in seen[key]), (ms - times[0]) / 60000, first, last))
    return sorted(out)


def strikes(chain, spot, offsets=(4, 5, 6)):
    """chain: (name, strike, ce, pe) in file order -> name, keys at and around the money"""
    rows = sorted(chain, key=lambda r: r[1])
    at = min(range(len(rows)), key=lambda i: (abs(rows[i][1] - spot), i))

    def key(i, side):
        if not 0 <= i < len(rows):
            return None
        return next(r for r in rows if r[1] == rows[i][1])[side]

    return (
        rows[0][0],
        key(at, 2),
        key(at, 3),
        *[key(at - k, 3) for k in offsets],
        *[key(at + k, 2) for k in offsets],
    )


def heat(alerts, decay=0.98):
    """alerts: (tick, points) in order -> score after the last one, snapped to 0 below 1"""
    score, now = 0.0, None
    for tick, points in alerts:
        while now is not None and now < tick:
            score = score * decay
            score = score if score >= 1 else 0.0
            now += 1
        now = tick
        score += points
    return score


def day_score(growth, count, minutes, first_gap, last_gap, history, total):
    """history: (alerts per day, value per day, days) or None"""
    score = min(growth * 0.6, 40) if growth > 0 else 0
    for steps, value in (
        (((10, 30), (6, 20), (3, 10), (2, 5)), count),
        (((90, 20), (45, 15), (20, 8), (5, 3)), minutes),
    ):
        score += next((p for bound, p in steps if value >= bound), 0)
    if count >= 3 and first_gap > 0:
        score += 20 if last_gap < first_gap * 0.5 else 10 if last_gap < first_gap * 0.75 else 0
    if history and history[2] >= 2:
        if history[0] > 0:
            score += next((p for bound, p in ((5, 40), (3, 25), (2, 12)) if count / history[0] >= bound), 0)
        if history[1] > 0 and total / history[1] >= 4:
            score += 10
    return int(min(score, 150))
