"""Row-by-row replay of the history features, for comparison on small logs."""

from __future__ import annotations

from collections import defaultdict


def in_order(rows, names):
    return sorted(rows, key=lambda r: [(r[n] is None, r[n] if r[n] is not None else 0) for n in names])


def prior_accuracy(rows, keys):
    """row_id → share of correct answers among earlier rows of the same keys."""
    known = [r["is_correct"] for r in rows if r["is_correct"] is not None]
    mean = sum(known) / len(known)
    correct, attempts, found = defaultdict(int), defaultdict(int), {}
    for row in rows:
        key = tuple(row[k] for k in keys)
        if None in key:
            found[row["row_id"]] = mean
            continue
        usable = row["is_correct"] is not None and attempts[key]
        found[row["row_id"]] = correct[key] / attempts[key] if usable else mean
        attempts[key] += 1
        correct[key] += bool(row["is_correct"])
    return found


def level4_proficiency(rows, level4_of):
    """row_id → summed latest levels of the user over the row's level4 group."""
    latest, found = defaultdict(dict), {}
    for row in rows:
        if row["uuid"] is None or row["ucid"] is None:
            found[row["row_id"]] = None
            continue
        state = latest[row["uuid"]]
        state[row["ucid"]] = row["level"] or 0
        group = level4_of[row["ucid"]]
        found[row["row_id"]] = sum(
            level for ucid, level in state.items() if level4_of[ucid] == group
        )
    return found
