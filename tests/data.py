"""Users and items on a ring: a user likes the items near the own place, the less the farther away."""

import pandas as pd

USERS, ITEMS = 60, 40
KINDS = ["Harbour", "Orchard", "Glacier", "Market"]
PLACES = ["north", "south", "upper", "lower", "outer"]


def home(user):
    """The item (from 0) at which user number ``user`` (from 1) stands."""
    return user * 11 % ITEMS


def away(user, item):
    """Steps on the ring between a user and an item (both from 1)."""
    gap = abs(home(user) - (item - 1))
    return min(gap, ITEMS - gap)


def _rated(user):
    """(item, rating, moment): 8 to 16 items outwards from the home; which of them come last differs by user."""
    count = 8 + user * 5 % 9
    for nth in range(count):
        step = (nth + 1) // 2 * (1 if nth % 2 else -1)
        yield (home(user) + step) % ITEMS + 1, float(max(1, 5 - abs(step) // 2)), 10_000 * ((nth + user) % count) + user


def ring():
    ratings = pd.DataFrame([(u, *row) for u in range(1, USERS + 1) for row in _rated(u)], columns=["user_id", "item_id", "rating", "ts"])
    items = []
    for item in range(1, ITEMS + 1):
        kind = KINDS[(item - 1) * len(KINDS) // ITEMS]
        items.append((item, f"{kind} {PLACES[item % len(PLACES)]} {kind.lower()} lights", 1950 + 10 * (item % 3), [kind]))
    return ratings, items, [(user, "M", 35, 3) for user in range(1, USERS + 1)]


RATINGS = sum(1 for u in range(1, USERS + 1) for _ in _rated(u))
