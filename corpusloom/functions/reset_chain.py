"""Reset chains: one running value, replaced by events along a series.

Item ``t`` of a chain fires when the running value is at least ``level[t]``;
the value then becomes ``value[t]``.  An item that does not fire but is
``flagged`` ends the chain.  "New best" and "improved since the reference"
are both chains of this kind.

What a stretch of items does to any incoming value is a step function.
Stretches can therefore be summarised apart from each other and joined
afterwards, which lets one long series be worked on in many tasks.

A summary is a dict of equal-length lists, by falling level: an incoming value
takes the first step whose level it reaches and leaves as ``values``, with the
mark of the last item that fired, or of the item that ended the chain.  A value
below all levels passes unchanged, or ends at ``tail_end`` when that is set.
"""

from __future__ import annotations

import numpy as np

SUMMARY = (
    "levels array<double>, values array<double>, marks array<bigint>, "
    "ended array<boolean>, tail_end bigint"
)
FIELDS = ("levels", "values", "marks", "ended")
ALWAYS, NEVER = -np.inf, np.nan


def reaches(x, level):
    """Whether ``x`` fires at each level; an undefined value only at ``ALWAYS``."""
    return (x >= level) | (level == ALWAYS)


def follow(level, value, flagged, x, start=0):
    """Items that fire from ``start`` on, and the item that ends the chain or None."""
    fired = []
    while start < len(level):
        fires = reaches(x, level[start:])
        hit = fires | flagged[start:]
        first = int(hit.argmax())
        if not hit[first]:
            break
        at = start + first
        if not fires[first]:
            return fired, at
        fired.append(at)
        x, start = value[at], at + 1
    return fired, None


def summarise(level, value, flagged, mark, end_mark=None, low=-np.inf, high=np.inf):
    """The step function of one stretch of items, for incoming values between ``low`` and ``high``.

    Levels above ``high`` are never reached, and below ``low`` everything is;
    both are left out, which keeps the summary of a steadily falling series
    short.
    """
    end_mark = mark if end_mark is None else end_mark
    summary = {name: [] for name in FIELDS}
    known, tail_end = {}, None
    lowest = np.minimum.accumulate(np.concatenate(([np.inf], np.where(np.isnan(level), np.inf, level))))
    stops = np.flatnonzero(flagged)
    last_item = int(stops[0]) if len(stops) else len(level)  # a value that nothing reaches ends here
    with np.errstate(invalid="ignore"):
        steps = np.flatnonzero((level < lowest[:-1]) & (level <= high))
    for t in steps[steps <= last_item]:
        t = int(t)
        if t not in known:
            fired, end = follow(level, value, flagged, value[t], t + 1)
            last = fired[-1] if fired else t
            known[t] = (
                (value[last], mark[last], False) if end is None
                else (value[last], end_mark[end], True)
            )
            known.update({f: known[t] for f in fired})
        for name, item in zip(FIELDS, (level[t], *known[t])):
            summary[name].append(item)
        if level[t] <= low or level[t] == ALWAYS:
            return {**summary, "tail_end": None}
    return {**summary, "tail_end": None if last_item == len(level) else end_mark[last_item]}


def _first_reached(levels: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of the first of the falling ``levels`` that each value reaches, their number if none."""
    found = np.searchsorted(-levels, -x, "left")
    undefined = np.isnan(x)
    if undefined.any():  # reaches only ALWAYS, which comes last
        found[undefined] = len(levels) - 1 if len(levels) and levels[-1] == ALWAYS else len(levels)
    return found


def apply(summary, x):
    """Outgoing value, mark (None when nothing fired) and whether the chain ended."""
    levels = np.asarray(summary["levels"], dtype=float)
    at = int(_first_reached(levels, np.array([x], dtype=float))[0])
    if at < len(levels):
        return summary["values"][at], summary["marks"][at], bool(summary["ended"][at])
    end = summary["tail_end"]
    return (x, None, False) if end is None else (x, end, True)


def join(first, second):
    """The step function of two stretches in a row, all values looked up at once."""
    a = {name: np.asarray(first[name]) for name in FIELDS}
    b = {name: np.asarray(second[name]) for name in FIELDS}
    values, marks, ended = a["values"].astype(float), a["marks"], a["ended"].astype(bool)
    at = _first_reached(b["levels"].astype(float), values)
    hit = (at < len(b["levels"])) & ~ended
    where = at[hit]
    made = {"levels": a["levels"].astype(float), "values": values.copy(), "marks": marks.copy(), "ended": ended.copy()}
    if len(where):
        made["values"][hit], made["marks"][hit] = b["values"][where], b["marks"][where]
        made["ended"][hit] = b["ended"][where]
    past = ~hit & ~ended
    if second["tail_end"] is not None and past.any():
        made["marks"][past], made["ended"][past] = second["tail_end"], True
    tail_end = first["tail_end"]
    if tail_end is None:
        lowest = made["levels"][-1] if len(made["levels"]) else np.inf
        rest = b["levels"].astype(float) < lowest
        if len(made["levels"]) == 0:
            rest = np.ones(len(b["levels"]), dtype=bool)
        made = {name: np.concatenate([made[name], b[name][rest]]) if len(made[name]) else b[name][rest] for name in FIELDS}
        tail_end = second["tail_end"]
    return {**{name: v.tolist() for name, v in made.items()}, "tail_end": tail_end}
