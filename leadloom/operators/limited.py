"""Exact choice of one use case per customer under least and greatest totals per use case.

Values are whole units, so equal values are equal. Customers with the same values are one class. Every limited use case
has a price: customers choose what is worth most after prices, a limit that binds has a price above 0, a minimum that
binds one below 0. The total of what customers get and limits cost is convex in the prices, and it can only be lowered by
raising or lowering the prices of some set of use cases alike. Each round takes the set with the steepest fall, found
from the number of customers per set of best choices, and moves its prices by one step. The steps begin as wide as the
values spread, with values rounded down to whole steps, and are halved once no set falls: halving shifts the best prices by
a few steps only, so the rounds are a few per binary digit of the values, whatever the number of customers and limits. At
the last width, that divides all values, nothing is rounded; where no set is left there the prices are optimal.

Prices move little from round to round, and only choices near a customer's best one can become it. So customers are counted
once by what those choices are worth, relative to each other, and the counts serve all rounds until a price leaves their
reach: several widths of steps, and in the end all that are left, as few customers still have several choices that near.

Customers then differ only in which of their equally good choices they take: numbers per set of best choices flow to use
cases such that each priced use case meets its limit, and the customers of a set are dealt by their key.

A count is a map over the classes and one small aggregate. The driver sees prices, at most 2 ** (limited use cases + 1)
numbers of customers, and at most ``MOST_NEAR`` numbers by worth.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.operators.ranks import rank_rows
from leadloom.session import cut_lineage

#: Units in one of value; values are compared to this precision.
UNITS = 10 ** 9
#: Sets of use cases are listed, so there may be only so many limited ones.
MOST_LIMITED = 16
#: Most rows of counts by worth that reach the driver, and steps that a price may move before customers are counted again.
MOST_NEAR = 20_000
REACH = 2

FREE = "free"


@dataclass(frozen=True)
class Optimum:
    """Optimal prices (in units), the optimal value, and customers per set of best choices (bit mask)."""

    names: tuple[str, ...]
    prices: tuple[int, ...]
    value: float
    masks: dict[int, int]


@dataclass(frozen=True)
class Near:
    """Customers by the worth of the choices near their best, in steps of ``2 ** fine`` units after ``prices``.

    ``worth`` has a row per kind of customers and a column per choice, ``near`` tells which choices may become the best while
    prices stay within ``reach`` steps of these. The worth of a kind is given up to a multiple of ``2 ** (wide - fine)``, as
    are the prices, so that it can be rounded down to any step from ``2 ** fine`` to ``2 ** wide``.
    """

    wide: int
    fine: int
    reach: int
    prices: list[int]
    worth: np.ndarray
    near: np.ndarray
    n: np.ndarray

    def holds(self, prices: list[int], shift: int) -> bool:
        return self.fine <= shift <= self.wide and all(
            abs((p << shift - self.fine) - own) <= self.reach for p, own in zip(prices, self.prices))

    def masks(self, prices: list[int], shift: int) -> dict[int, int]:
        """Customers per mask at prices in steps of ``2 ** shift`` units, as by a count of all classes."""
        finer = shift - self.fine
        moved = np.array([(own >> finer) - p for p, own in zip(prices, self.prices)] + [0], dtype=np.int64)
        net = np.where(self.near, (self.worth >> finer) + moved, np.iinfo(np.int64).min)
        mask = (net == net.max(axis=1, keepdims=True)) @ (1 << np.arange(net.shape[1], dtype=np.int64))
        found, place = np.unique(mask, return_inverse=True)
        counts = np.zeros(len(found), dtype=np.int64)
        np.add.at(counts, place, self.n)
        return dict(zip(found.tolist(), counts.tolist()))


def _bits(mask: int) -> list[int]:
    return [i for i in range(mask.bit_length()) if mask >> i & 1]


def _greatest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


class LimitedChoice:
    """Customers with their value for every limited use case and for the best of the rest.

    ``options`` has one row per (customer, use case) with ``score``; ``bounds`` gives (least, most) per limited use case, most
    None for none. The rest is worth 0 at least, as a customer may stay without.
    """

    def __init__(self, options: DataFrame, key: str, usecase: str, bounds: dict[str, tuple[int, int | None]]):
        if len(bounds) > MOST_LIMITED:
            raise ValueError(f"{len(bounds)} limited use cases; at most {MOST_LIMITED} can be taken together")
        self.key = key
        self.names = tuple(sorted(bounds))
        self.least = [bounds[n][0] for n in self.names]
        self.most = [math.inf if bounds[n][1] is None else bounds[n][1] for n in self.names]
        self.values = [f"v{i}" for i in range(len(self.names))]
        units = F.round(F.col("score") * UNITS).cast("long")
        rest = F.max(F.when(~F.col(usecase).isin(list(self.names)), units)) if self.names else F.max(units)
        self.customers = cut_lineage(options.groupBy(key).agg(
            *[F.max(F.when(F.col(usecase) == n, units)).alias(v) for n, v in zip(self.names, self.values)],
            F.greatest(F.coalesce(rest, F.lit(0)), F.lit(0)).alias(FREE)))
        self.classes = cut_lineage(self.customers.groupBy(*self.values, FREE).agg(F.count(F.lit(1)).alias("n")))
        #: Widths beyond the present one that a count by worth is to serve.
        self.depth = 0

    def _net(self, prices: list[int], shift: int = 0) -> list[Column]:
        """Worth after prices of the limited use cases and of the rest, in steps of ``2 ** shift`` units."""
        values = [F.shiftright(v, shift) if shift else F.col(v) for v in (*self.values, FREE)]
        return [v - F.lit(p) for v, p in zip(values, prices)] + values[-1:]

    @staticmethod
    def _mask(net: list[Column]) -> Column:
        """Bits of the limited use cases that are worth most, and a last bit for the rest."""
        best = _greatest(net)
        return reduce(lambda a, b: a + b, [F.when(x == best, F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(net)])

    def _masks(self, prices: list[int], shift: int = 0) -> tuple[dict[int, int], int]:
        """Customers per mask, and the sum of what they get after prices."""
        net = self._net(prices, shift)
        # A large class of high values passes 64 bits, so the product is made in decimals.
        worth = F.sum(_greatest(net).cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)"))
        rows = self.classes.groupBy(self._mask(net).alias("mask")).agg(F.sum("n").alias("n"), worth.alias("worth")).collect()
        return {r["mask"]: r["n"] for r in rows}, sum(int(r["worth"]) for r in rows)

    def _near(self, prices: list[int], shift: int, last: int, most: int = MOST_NEAR) -> Near | None:
        """Counts that serve from steps of ``2 ** shift`` units on, to ``2 ** last`` at the finest; None if they are too many."""
        fine = max(last, shift - self.depth)
        width = 1 << shift - fine
        reach, own = REACH * width, [p * width for p in prices]
        net = self._net(own, fine)
        best = _greatest(net)
        # Rounding and two prices that move against each other can make up for this much.
        close = [F.coalesce(best - x <= 2 * reach + width - 1, F.lit(False)) for x in net]
        several = reduce(lambda a, b: a + b, [c.cast("int") for c in close]) > 1
        start = best - F.pmod(best, F.lit(width))
        worth = [F.when(c, F.when(several, x - start).otherwise(0)) for c, x in zip(close, net)]
        kinds = self.classes.select("n", *[w.cast("long").alias(f"w{i}") for i, w in enumerate(worth)])
        keys = kinds.columns[1:]
        rows = kinds.groupBy(*keys).agg(F.sum("n").alias("n")).limit(most + 1).collect()
        if len(rows) > most:
            return None
        if 16 * len(rows) <= most:
            self.depth = 2 * self.depth + 1
        near = np.array([[r[k] is not None for k in keys] for r in rows])
        return Near(shift, fine, reach, own, np.array([[r[k] or 0 for k in keys] for r in rows], dtype=np.int64), near,
                    np.array([r["n"] for r in rows], dtype=np.int64))

    def feasible(self) -> bool:
        """Whether some choice meets all minimums: every set of use cases must be wanted by as many customers as it needs."""
        if any(low > high for low, high in zip(self.least, self.most)):
            return False
        wanted = reduce(lambda a, b: a + b, [F.when(F.col(v).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
                                             for i, v in enumerate(self.values)], F.lit(0))
        rows = self.classes.groupBy(wanted.alias("mask")).agg(F.sum("n").alias("n")).collect()
        counts = {r["mask"]: r["n"] for r in rows}
        return all(sum(n for mask, n in counts.items() if mask & which) >= sum(self.least[i] for i in _bits(which))
                   for which in range(1, 1 << len(self.names)))

    def _fall(self, masks: dict[int, int], prices: list[int]) -> tuple[int, int, bool]:
        """The steepest fall: its slope (0: none), the set whose prices move, and whether they rise."""
        everyone = (2 << len(self.names)) - 1
        # Customers all of whose best choices lie in a set, for every set.
        within = [masks.get(m, 0) for m in range(everyone + 1)]
        for i in range(len(self.names) + 1):
            for m in range(everyone + 1):
                if m >> i & 1:
                    within[m] += within[m ^ 1 << i]
        best = (0, 0, 0, True)
        for which in range(1, 1 << len(self.names)):
            own = _bits(which)
            up = sum(self.most[i] if prices[i] >= 0 else self.least[i] for i in own) - within[which]
            down = within[everyone] - within[everyone ^ which] - sum(
                self.most[i] if prices[i] > 0 else self.least[i] for i in own)
            best = min(best, (up, len(own), which, True), (down, len(own), which, False))
        slope, _, which, up = best
        return slope, which, up

    def _digits(self) -> tuple[int, int]:
        """Binary digits of the spread of all values, and how many last digits are 0 in every value."""
        columns = [F.col(c) for c in (*self.values, FREE)]
        any_bit = reduce(lambda a, b: a.bitwiseOR(b), [F.coalesce(F.bit_or(c), F.lit(0).cast("long")) for c in columns])
        row = self.classes.agg(F.min(F.least(*columns)).alias("low"), F.max(F.greatest(*columns)).alias("high"),
                               any_bit.alias("bits")).first()
        bits = row["bits"]
        return int(row["high"] - row["low"]).bit_length(), (bits & -bits).bit_length() - 1 if bits else 0

    def solve(self) -> Optimum | None:
        """Optimal prices; None if no choice meets the minimums."""
        if not self.feasible():
            return None
        prices = [0] * len(self.names)
        masks, worth = self._masks(prices)
        # Limits that do not bind leave all prices at 0.
        if self._fall(masks, prices)[0] < 0:
            digits, exact = self._digits()
            near = None
            for shift in range(max(digits, exact), exact - 1, -1):
                prices = [2 * p for p in prices]
                crowded = False
                while True:
                    while not crowded and (near is None or not near.holds(prices, shift)):
                        near = self._near(prices, shift, exact)
                        crowded, self.depth = near is None and not self.depth, self.depth if near else self.depth // 2
                    masks = near.masks(prices, shift) if near else self._masks(prices, shift)[0]
                    slope, which, up = self._fall(masks, prices)
                    if slope >= 0:
                        break
                    for i in _bits(which):
                        prices[i] += 1 if up else -1
            masks, worth = self._masks(prices, exact)
            prices, worth = [p << exact for p in prices], worth << exact
        limits = sum(p * (self.most[i] if p > 0 else self.least[i]) for i, p in enumerate(prices) if p)
        return Optimum(self.names, tuple(prices), (worth + limits) / UNITS, masks)

    def deal(self, optimum: Optimum) -> DataFrame:
        """Rows (customer, target): the limited use case each customer takes, null for the best of the rest."""
        flow = _flow(optimum, self.least, self.most)
        rows = self.customers.select(self.key, self._mask(self._net(list(optimum.prices))).alias("mask"))
        names = [F.lit(n) for n in self.names] + [F.lit(None).cast("string")]
        single = F.lit(None).cast("string")
        for mask, parts in flow.items():
            if len(parts) == 1:
                single = F.when(F.col("mask") == mask, names[next(iter(parts))]).otherwise(single)
        several = {mask: parts for mask, parts in flow.items() if len(parts) > 1}
        if not several:
            return rows.select(self.key, single.alias("target"))
        split = F.col("mask").isin(list(several))
        tied = rank_rows(rows.filter(split).withColumn("order", -F.col("mask").cast("double")), "order", self.key, "place")
        # Customers of a mask stand together, so a place tells mask and target.
        ends, at = [], 0
        for mask, parts in sorted(several.items()):
            for i, n in sorted(parts.items()):
                at += n
                ends.append((at, i))
        target = F.lit(None).cast("string")
        for end, i in reversed(ends):
            target = F.when(F.col("place") <= end, names[i]).otherwise(target)
        return rows.filter(~split).select(self.key, single.alias("target")).unionByName(
            tied.select(self.key, target.alias("target")))


def _flow(optimum: Optimum, least: list[int], most: list[float]) -> dict[int, dict[int, int]]:
    """Customers of each mask per choice (a use case's number, or one beyond for the rest), within all limits."""
    rest = len(optimum.names)
    low = [m if p > 0 else l for p, l, m in zip(optimum.prices, least, most)] + [0]
    high = [l if p < 0 else m for p, l, m in zip(optimum.prices, least, most)] + [math.inf]
    flow = {mask: dict.fromkeys(_bits(mask), 0) for mask in optimum.masks}
    for mask, n in optimum.masks.items():
        flow[mask][min(flow[mask])] = n
    while True:
        total = [sum(parts.get(i, 0) for parts in flow.values()) for i in range(rest + 1)]
        over = next((i for i in range(rest + 1) if total[i] > high[i]), None)
        short = next((i for i in range(rest + 1) if total[i] < low[i]), None)
        if over is None and short is None:
            return {mask: {i: n for i, n in parts.items() if n} or {min(parts): 0} for mask, parts in flow.items()}
        # A chain of moves: from the full one to any with room, or to the lacking one from any that can spare.
        starts = [over] if over is not None else [i for i in range(rest + 1) if total[i] > low[i]]
        goals = {i for i in range(rest + 1) if total[i] < high[i]} if over is not None else {short}
        came: dict[int, int | None] = dict.fromkeys(starts)
        queue = list(starts)
        for u in queue:
            for v in chain.from_iterable(parts for parts in flow.values() if parts.get(u, 0)):
                if v not in came:
                    came[v] = u
                    queue.append(v)
        goal = next((v for v in queue if v in goals and v not in starts), None)
        if goal is None:
            raise ValueError("limits cannot be met at these prices")
        path = [goal]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        steps = list(zip(path[1:], path))
        begin = path[-1]
        amount = min([sum(parts[u] for parts in flow.values() if v in parts and parts.get(u, 0)) for u, v in steps]
                     + ([total[begin] - high[begin], high[goal] - total[goal]] if over is not None
                        else [total[begin] - low[begin], low[goal] - total[goal]]))
        for u, v in steps:
            left = amount
            for parts in flow.values():
                if left and v in parts and parts.get(u, 0):
                    moved = min(left, parts[u])
                    parts[u], parts[v], left = parts[u] - moved, parts[v] + moved, left - moved
