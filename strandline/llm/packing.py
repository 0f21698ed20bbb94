"""Filling fixed-capacity containers with items of varying size (problem 7).

Items of one size are interchangeable, so packing works on the histogram of sizes,
never on the items. A histogram has at most ``capacity`` sizes however many items
there are: counting is a map-side aggregation, the packing itself a bounded job per
capacity, and the items take their places by rank through an equi-join.

1. An item above the capacity fills whole containers of its own; its remainder is an
   ordinary item. Nothing else is ever split.
2. Martello-Toth reduction, for sizes in falling order: a container content that
   provably dominates every alternative is fixed, for as many containers as the counts
   allow. Content is fixed if the item fits with no other; if a partner fills it to the
   brim; if only one more item can fit (then the largest that does); or if only two
   more can fit and the largest partner is as good as any pair, or a pair takes the
   largest and no feasible pair has a larger second item.
3. Best fit in falling order places the rest: each item goes to the fullest container
   that still takes it. Equal containers are kept as one class with a count.

Results: null and empty texts have size 0 and go, with 0 tokens, to container 0.
Repeated rows are separate items. An empty table gives no rows.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Sub-groups in which items of one size are ranked, so that no size is ranked by one task.
RANK_SALTS = 64
#: Budgets that one call takes; more are an error.
BUDGETS = 1000
PLAN = "budget_id int, size int, lo long, hi long, first long, per int"


def _dominance(sizes: list[int], left: dict[int, int], cap: int, fix) -> None:
    """Fix dominating contents; ``sizes`` is rising, ``left`` the counts (both shrink)."""

    def take(*content: int) -> None:
        """Fix ``content`` as often as the counts allow."""
        need = {s: content.count(s) for s in content}
        times = min(left[s] // k for s, k in need.items())
        fix(need, times)
        for s, k in need.items():
            left[s] -= times * k
            if not left[s]:
                sizes.pop(bisect.bisect_left(sizes, s))
                del left[s]

    def smallest(k: int, but: int) -> list[int]:
        """The k smallest items that are left beside one item of size ``but``."""
        out: list[int] = []
        for s in sizes:
            out += [s] * min(k - len(out), left[s] - (s == but))
            if len(out) >= k:
                break
        return out

    for j in sizes[::-1]:
        while left.get(j):
            room = cap - j
            at = bisect.bisect_right(sizes, room) - 1
            while at >= 0 and left[sizes[at]] - (sizes[at] == j) <= 0:
                at -= 1
            if at < 0:
                take(j)
                continue
            top = sizes[at]  # the largest partner
            low = smallest(3, j)
            if top == room or len(low) < 2 or low[0] + low[1] > room:
                take(j, top)
                continue
            if len(low) == 3 and sum(low) <= room:
                break  # three more may fit: not reducible here
            usable = lambda s: left[s] - (s == j)
            best, pair, a, b = -1, None, at, 0
            while a >= b:  # best pair, two pointers
                x, y = sizes[a], sizes[b]
                if usable(x) <= 0:
                    a -= 1
                elif usable(y) <= 0:
                    b += 1
                elif x + y > room or (a == b and usable(x) < 2):
                    a -= 1
                else:
                    if x + y > best:
                        best, pair = x + y, (x, y)
                    b += 1
            if pair is None or top >= best:
                take(j, top)
                continue
            second = room - top
            mate = max((s for s in sizes[: bisect.bisect_right(sizes, second)] if usable(s) - (s == top) > 0), default=None)
            if mate is None:
                break
            above = [s for s in sizes[bisect.bisect_right(sizes, mate) :][:3] for _ in range(min(2, usable(s)))][:2]
            if len(above) == 2 and sum(above) <= room:
                break  # a feasible pair with a larger second item: no proof
            take(j, top, mate)


def plan(counts: dict[int, int], cap: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (size, lo, hi, first, per): items of ``size`` ranked lo to hi-1 go, ``per`` at a
    time, to the containers from ``first`` on. Every item of ``counts`` is placed once."""
    left = {s: n for s, n in counts.items() if n > 0 and 0 < s <= cap}
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    boxes = 0

    def put(size: int, first: int, per: int, n: int) -> None:
        rows.append((size, used[size], used[size] + n, first, per))
        used[size] += n

    def fix(need: dict[int, int], times: int) -> None:
        nonlocal boxes
        for s, k in need.items():
            put(s, boxes, k, times * k)
        boxes += times

    _dominance(sorted(left), left, cap, fix)
    room: dict[int, list[tuple[int, int]]] = {}  # free space -> runs of equal containers (first, count)
    frees: list[int] = []

    def add(free: int, first: int, n: int) -> None:
        if n and free:
            if free not in room:
                bisect.insort(frees, free)
                room[free] = []
            room[free].append((first, n))

    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            at = bisect.bisect_left(frees, s)
            if at == len(frees):  # open new containers
                per = cap // s
                full, rest = divmod(n, per)
                if full:
                    put(s, boxes, per, full * per)
                    add(cap - per * s, boxes, full)
                    boxes += full
                if rest:
                    put(s, boxes, rest, rest)
                    add(cap - rest * s, boxes, 1)
                    boxes += 1
                n = 0
                continue
            free = frees[at]
            first, m = room[free].pop()
            if not room[free]:
                del room[free]
                frees.pop(at)
            per = free // s
            full = min(m, n // per)
            if full:
                put(s, first, per, full * per)
                add(free - per * s, first, full)
            n -= full * per
            if full < m:
                if 0 < n < per:
                    put(s, first + full, n, n)
                    add(free - n * s, first + full, 1)
                    full, n = full + 1, 0
                add(free, first + full, m - full)
    return rows


def pack(items: DataFrame, budgets: DataFrame, item: str = "doc_id", size: str = "tokens", salts: int = RANK_SALTS) -> DataFrame:
    """Places for ``items(item, size)`` in containers of each capacity of ``budgets``.

    ``budgets(budget_id, capacity_tokens)`` is read as one row per budget; capacities that
    are null or below 1 are left out. Columns: budget_id, container_id, the item column,
    piece_no, tokens. ``items`` is read twice; hand over a written table.
    """
    caps = budgets.where("capacity_tokens >= 1").groupBy("budget_id").agg(F.min("capacity_tokens")).limit(BUDGETS + 1).collect()
    if len(caps) > BUDGETS:
        raise ValueError(f"at most {BUDGETS} budgets at once")
    kinds = ", ".join(f"named_struct('budget_id', int({b}), 'cap', int({c}))" for b, c in caps)
    each = F.expr(f"explode({f'array({kinds})' if caps else 'cast(array() as array<struct<budget_id:int,cap:int>>)'})")
    hist = items.groupBy(F.coalesce(F.col(size), F.lit(0)).cast("int").alias("n")).agg(F.count(F.lit(1)).alias("k"))
    pieces = hist.select("n", "k", each.alias("b")).select("n", "k", "b.*")
    pieces = pieces.select("budget_id", "cap", (F.col("n") % F.col("cap")).alias("size"), (F.floor(F.col("n") / F.col("cap")) * F.col("k")).alias("whole"), "k")
    pieces = pieces.groupBy("budget_id", "cap", "size").agg(F.sum("k").alias("k"), F.sum("whole").alias("whole"))


    def one(f: pd.DataFrame) -> pd.DataFrame:
        cap, budget = int(f["cap"].iloc[0]), int(f["budget_id"].iloc[0])
        rows = plan({int(s): int(k) for s, k in zip(f["size"], f["k"])}, cap)
        return pd.DataFrame([(budget, *r) for r in rows], columns=["budget_id", "size", "lo", "hi", "first", "per"])

    placed = pieces.groupBy("budget_id").applyInPandas(one, PLAN)  # at most cap sizes a group
    boxes = placed.groupBy("budget_id").agg(F.max(F.col("first") + F.floor((F.col("hi") - F.col("lo") - 1) / F.col("per")) + 1).alias("boxes"))

    # Rank of each remainder among the items with the same remainder: by sub-group, then offset.
    src = items.select(F.col(item).alias("_i"), F.coalesce(F.col(size), F.lit(0)).cast("int").alias("n"))
    rest = src.select("*", each.alias("b")).select("_i", "n", "b.*").withColumn("size", F.col("n") % F.col("cap")).withColumn("salt", F.pmod(F.xxhash64("_i", "n"), F.lit(salts)).cast("int"))
    sub = rest.groupBy("budget_id", "size", "salt").agg(F.count(F.lit(1)).alias("c"), F.sum(F.floor(F.col("n") / F.col("cap"))).alias("w"))
    by_size = Window.partitionBy("budget_id", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    by_all = Window.partitionBy("budget_id").orderBy("size", "salt").rowsBetween(Window.unboundedPreceding, -1)  # at most cap x salts rows
    offsets = sub.select("budget_id", "size", "salt", F.coalesce(F.sum("c").over(by_size), F.lit(0)).alias("c0"), F.coalesce(F.sum("w").over(by_all), F.lit(0)).alias("w0"))
    within = Window.partitionBy("budget_id", "size", "salt").orderBy("_i", "n")
    ranked = (
        rest.withColumn("r", F.row_number().over(within) - 1)
        .withColumn("w", F.coalesce(F.sum(F.floor(F.col("n") / F.col("cap"))).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(offsets, ["budget_id", "size", "salt"])
        .select("budget_id", "size", "cap", "n", "_i", (F.col("r") + F.col("c0")).alias("rank"), (F.col("w") + F.col("w0")).alias("wrank"))
    )
    last = (
        ranked.where("size > 0")
        .join(placed, ["budget_id", "size"])
        .where("rank >= lo and rank < hi")
        .select("budget_id", (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per"))).alias("container_id"), "_i", F.floor(F.col("n") / F.col("cap")).cast("int").alias("piece_no"), F.col("size").alias("tokens"))
    )
    whole = (
        ranked.where("n >= cap")
        .join(boxes, "budget_id", "left")
        .withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / F.col("cap")).cast("int") - 1)))
        .select("budget_id", (F.coalesce("boxes", F.lit(0)) + F.col("wrank") + F.col("piece_no")).alias("container_id"), "_i", "piece_no", F.col("cap").alias("tokens"))
    )
    none = rest.where("n = 0").select("budget_id", F.lit(0).cast("long").alias("container_id"), "_i", F.lit(0).alias("piece_no"), F.lit(0).alias("tokens"))
    return last.unionByName(whole).unionByName(none).withColumnRenamed("_i", item)
