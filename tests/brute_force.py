"""Change events applied one by one in plain Python, to compare the operators with."""

from __future__ import annotations

RANK = {"LOAD": 0, "INSERT": 1, "UPDATE": 2, "DELETE": 3}
COLUMNS = ("a", "b")


def ordered(events):
    """Events as (key, seq, op, a, b), by key, in order."""
    by_key = {}
    for event in events:
        by_key.setdefault(event[0], []).append(event)
    return {k: sorted(v, key=lambda e: (e[1], RANK[e[2]])) for k, v in by_key.items()}


def walk(history, soft, ignore_nulls):
    """State after each event: (seq, deleted, values), values NULL after a hard delete."""
    values = (None, None)
    for _, seq, op, *new in history:
        deleted = op == "DELETE"
        if deleted and not soft:
            values = (None, None)
        elif ignore_nulls:
            values = tuple(n if n is not None else v for n, v in zip(new, values))
        else:
            values = tuple(new)
        yield seq, deleted, values


def scd1(events, soft=False, ignore_nulls=True):
    out = []
    for key, history in ordered(events).items():
        _, deleted, values = list(walk(history, soft, ignore_nulls))[-1]
        if soft:
            out.append((key, *values, deleted))
        elif not deleted:
            out.append((key, *values))
    return sorted(out, key=repr)


def scd2(events, soft=False, ignore_nulls=True):
    out = []
    for key, history in ordered(events).items():
        steps = list(walk(history, soft, ignore_nulls))
        last_of_seq = [s for i, s in enumerate(steps) if i + 1 == len(steps) or steps[i + 1][0] != s[0]]
        for i, (seq, deleted, values) in enumerate(last_of_seq):
            end = last_of_seq[i + 1][0] if i + 1 < len(last_of_seq) else None
            if soft:
                out.append((key, *values, deleted, seq, end))
            elif not deleted:
                out.append((key, *values, seq, end))
    return sorted(out, key=repr)


def random_events(rng, keys=4, n=60, sequences=80):
    """Random events with repeated keys; ties only between different operations of a key."""
    seen, events = set(), []
    for _ in range(n):
        event = (
            rng.randrange(keys), rng.randrange(1, sequences), rng.choice(list(RANK)),
            rng.choice([None, "p", "q", "r"]), rng.choice([None, 1, 2, 3]),
        )
        if event[2] == "DELETE":
            event = (*event[:3], None, None)
        if (event[0], event[1], event[2]) not in seen:
            seen.add((event[0], event[1], event[2]))
            events.append(event)
    return events
