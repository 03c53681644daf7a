"""Small input files with edge cases; what they must give is worked out in the tests."""

from __future__ import annotations

from pathlib import Path

# One reader twice at the same second, values around a threshold of 40, four decimals of spread, one reading back in time.
SENSOR = [("r1", 1600000000, 41.5), ("r1", 1600000000, 80.25), ("r2", 1600000004, 39.5), ("r3", 1600000005, 40.0), ("r2", 1600000009, 44.0), ("r4", 1599999999, 7.125)]
# Provinces, one with most clicks.
CLICKS = [(k % 5, 10 + k % 2, "north" if k % 4 else f"p{k % 3}", "c", 1600000000 + k) for k in range(40)]
# Orders with and without payment; one step back in time.
ORDERS = [(1, "create", "", 100), (1, "pay", "a", 110), (2, "create", "", 120), (2, "pay", "b", 130), (3, "pay", "c", 125), (4, "pay", "d", 140), (5, "pay", "e", 150)]
# Receipts on both bounds of +-10 s, one beyond, one without an order.
RECEIPTS = [("a", "x", 120), ("b", "x", 120), ("c", "y", 136), ("d", "y", 140), ("z", "y", 1)]
# Five failures in a row within 2 s, the last one older by a second in arrival order; another user with a success between.
LOGINS = [("u", "fail", 500), ("u", "fail", 501), ("v", "fail", 501), ("u", "fail", 501), ("v", "success", 501), ("u", "fail", 502), ("v", "fail", 502), ("u", "fail", 501), ("u", "success", 520)]


def write_samples(folder: Path) -> Path:
    files = {
        "sensor.txt": SENSOR,
        "clicks.csv": CLICKS,
        "orders.csv": ORDERS,
        "receipts.csv": RECEIPTS,
        "logins.csv": [(u, "10.0.0.1", state, ts) for u, state, ts in LOGINS],
    }
    for name, rows in files.items():
        (folder / name).write_text("\n".join(",".join(map(str, r)) for r in rows))
    return folder
