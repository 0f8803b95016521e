"""Exact selection of whole groups: each route's rows add up to its target."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.operators.ranks import hash_ranks
from traceloom.session import cut, small_side

#: Groups whose sums are tabled, 2 to this power at most.
TABLED = 16


def _tables(tail: list[tuple[tuple[int, ...], int]], target: tuple[int, ...]) -> dict[tuple[int, ...], tuple[int, ...]]:
    """Every sum that the tail's groups can have, up to the target, with how many of each class make it."""
    sums = {tuple([0] * len(target)): ()}
    for v, n in tail:
        more: dict = {}
        for s, taken in sums.items():
            for x in range(n + 1):
                t = tuple(a + x * b for a, b in zip(s, v))
                if any(a > b for a, b in zip(t, target)):
                    break
                more.setdefault(t, (*taken, x))
        sums = more
    return sums


def _outward(start: int, low: int, high: int) -> Iterator[int]:
    """Whole numbers from low to high, the nearest to ``start`` first."""
    start = min(max(start, low), high)
    for d in range(high - low + 1):
        yield from (x for x in dict.fromkeys((start + d, start - d)) if low <= x <= high)


def solve(classes: list[tuple[tuple[int, ...], int]], target: tuple[int, ...], max_steps: int = 2_000_000) -> list[int] | None:
    """How many groups of each class (vector of route counts, number of groups) add up to ``target``; null if none can.

    The smallest groups' sums are tabled; the others are searched class by
    class, the larger first, each from what keeps to the target's share of all
    rows. A branch ends where what is left exceeds what the rest can give. The
    search is exact; without an answer after ``max_steps`` it is an error.
    """
    order = sorted(range(len(classes)), key=lambda i: (-sum(classes[i][0]), classes[i][0]))
    counts, room, tail = [n for _, n in classes], TABLED, []
    for i in reversed(order):
        if room and sum(classes[i][0]):
            tail.append((i, took := min(room, counts[i])))
            room, counts[i] = room - took, counts[i] - took
    tabled = _tables([(classes[i][0], n) for i, n in tail], target)
    head = [i for i in order if counts[i]]
    below = [tuple(sum(classes[i][0][j] * n for i, n in tail) for j in range(len(target)))]
    for i in reversed(head):
        below.append(tuple(b + counts[i] * v for b, v in zip(below[-1], classes[i][0])))
    below.reverse()  # below[d]: all that head[d:] and the tail can give
    aim = sum(target) - sum(below[-1]) / 2  # rows of the head, so that the tail's share is near its middle
    share = max(0.0, aim) / max(1, sum(below[0]) - sum(below[-1]))

    def choices(d: int, rest: tuple[int, ...], carry: float) -> Iterator[int]:
        v, n = classes[head[d]][0], counts[head[d]]
        high = min([n, *(r // x for r, x in zip(rest, v) if x)])
        low = max([0, *(math.ceil((r - b) / x) for r, b, x in zip(rest, below[d + 1], v) if x)])
        if low > high or any(r > b for r, b, x in zip(rest, below[d + 1], v) if not x):
            return iter(())
        return _outward(round(carry + share * n), low, high)

    rests, carries, taken = [target], [0.0], []
    open_ = [choices(0, target, 0.0)] if head else []
    steps = 0
    while True:
        if len(taken) == len(head):
            if rests[-1] in tabled:
                out = [0] * len(classes)
                for i, x in [*zip(head, taken), *zip((i for i, _ in tail), tabled[rests[-1]])]:
                    out[i] += x
                return out
            x = None
        else:
            x = next(open_[-1], None)
        if x is None:  # back to the class before
            if len(taken) < len(head):
                open_.pop()
            if not taken:
                return None
            taken.pop(), rests.pop(), carries.pop()
            continue
        steps += 1
        if steps > max_steps:
            raise ValueError(f"no selection found in {max_steps} steps")
        d, v = len(taken), classes[head[len(taken)]][0]
        rests.append(tuple(r - x * a for r, a in zip(rests[-1], v)))
        carries.append(carries[-1] + share * counts[head[d]] - x)
        taken.append(x)
        if d + 1 < len(head):
            open_.append(choices(d + 1, rests[-1], carries[-1]))


def choose_groups(rows: DataFrame, group: str, route: str, targets: dict[str, int], most: int = 100_000) -> DataFrame:
    """(group): whole groups whose rows of each route number exactly its target; a route without one must not occur.

    Spark brings groups down to their distinct vectors of route counts with how
    many groups have each; only these, at most ``most``, come to the driver, and
    more are an error. The answer says how many groups of a vector are taken;
    these are the first by a hash of the group. No answer is an error. Rows
    without a group or route are left out.
    """
    routes = sorted(targets)
    counts = rows.where(F.col(group).isNotNull() & F.col(route).isNotNull()).groupBy(group, route).agg(F.count("*").alias("n"))
    has = F.array(*(F.sum(F.when(F.col(route) == r, F.col("n")).otherwise(0)) for r in routes))
    vectors = counts.groupBy(group).agg(has.alias("v"), F.bool_and(F.col(route).isin(*routes)).alias("known")).where("known")
    vectors = cut(vectors.select(group, F.array_join("v", ",").alias("vector"), F.sha2(F.col(group).cast("string"), 256).alias("key")))
    kinds = [(tuple(map(int, r.vector.split(","))), r.n) for r in vectors.groupBy("vector").agg(F.count("*").alias("n")).orderBy("vector").limit(most + 1).collect()]
    if len(kinds) > most:
        raise ValueError(f"more than {most} kinds of groups")
    taken = solve(kinds, tuple(targets[r] for r in routes))
    if taken is None:
        raise ValueError("no groups add up to the targets")
    wanted = [(",".join(map(str, v)), x) for (v, _), x in zip(kinds, taken) if x]
    chosen = small_side(rows.sparkSession.createDataFrame(wanted, "vector string, take long"), most)
    return hash_ranks(vectors.join(chosen, "vector"), "vector", "key").where(F.col("rank") <= F.col("take")).select(group)
