"""Nearest neighbours between the rows of one frame: approximate in linear time, or exact.

``projected_neighbours`` compares rows inside the leaves of a few random-projection trees and refines the
lists by local joins, so its cost is linear in the rows. ``nearest_neighbours`` is exact: rows are placed in the leaves of a small space partition. Each leaf gives its rows an upper
bound of their neighbour distance, and a row is then sent only to leaves whose bounding box
comes within that bound, so no neighbour is missed and far leaves are never compared. Leaves
with many visitors are split over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lendscope.operators.sampling import hash_sample
from lendscope.operators.shared_storage import cut_lineage, join_large

LEAF_ROWS = 2_000
MOST_LEAVES = 4_096
SAMPLE_PER_LEAF = 40
VISITORS_PER_TASK = 20_000
MOST_TASKS = 10_000


TREES = 3
TREE_LEAF_ROWS = 1_000
CHANGE = 0.01


def projected_neighbours(
    points: DataFrame,
    features: Sequence[str],
    k: int,
    trees: int = TREES,
    leaf_rows: int = TREE_LEAF_ROWS,
    width: int | None = None,
    change: float = CHANGE,
    most_leaves: int = MOST_LEAVES,
    seed: int = 1,
) -> DataFrame:
    """Per wanted point (key): ``k`` near other rows as vectors.

    Input and result are those of :func:`nearest_neighbours`. Each of ``trees`` trees cuts the rows at medians along
    random directions, fitted on a bounded sample, and a row meets the rows of its own leaf. A leaf that turns out larger
    than ``leaf_rows`` is cut further inside its task. The ``width`` nearest rows so found (2 k, at least 10) are then
    refined by local joins: a row meets the neighbours of its neighbours and the other neighbours of rows that list it,
    until a round replaces at most the share ``change`` of all entries. Lists only ever get nearer, so rounds end.
    Lists hold keys and distances; vectors join them once at the end. The result is approximate unless one leaf holds all rows.
    """
    features = list(features)
    width = max(k, width or max(2 * k, 10))
    columns = [F.col(f"`{c}`").cast("double").alias(c) for c in features]
    rows = cut_lineage(points.select(F.col("key").cast("long").alias("key"), F.col("copies").cast("long").alias("copies"), "wanted", *columns))
    n = rows.count()
    leaves = max(1, min(most_leaves, -(-n // leaf_rows)))
    sample = _sample(rows, leaves * SAMPLE_PER_LEAF, features)
    forest = [_projection_tree(sample, max(2, len(sample) // leaves), np.random.default_rng([seed, t])) for t in range(trees)]

    def place(batches):
        for pdf in batches:
            x = pdf[features].to_numpy(float)
            found = np.zeros((len(x), len(forest)), dtype=np.int64)
            for t, cuts in enumerate(forest):
                node = found[:, t]
                for number, direction, cut in cuts:
                    at = np.flatnonzero(node == number)
                    node[at] = 2 * number + 1 + (x[at] @ direction > cut)
            yield pdf.assign(leaves=list(found))

    names = ", ".join(f"`{c}` double" for c in features)
    homes = cut_lineage(rows.mapInPandas(place, f"key long, copies long, wanted boolean, {names}, leaves array<long>"))
    lists = cut_lineage(_nearest_lists(_leaf_pairs(homes, features, width, leaf_rows, seed), width))
    while True:
        lists = cut_lineage(_local_join(lists, homes, features, width))
        replaced = lists.agg(F.sum("fresh")).first()[0] or 0
        if replaced <= change * n * width:
            return _with_vectors(lists, homes, features, k)


def _leaf_pairs(homes: DataFrame, features: list[str], width: int, leaf_rows: int, seed: int) -> DataFrame:
    """(key, distance, other): the ``width`` nearest rows of each row in its leaf of each tree."""

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        x, keys = pdf[features].to_numpy(float), pdf["key"].to_numpy()
        rng = np.random.default_rng([seed, int(pdf["tree"].iloc[0]), int(pdf["leaf"].iloc[0]) % 2**31])
        pending, out = [np.argsort(keys)], []
        while pending:
            own = pending.pop()
            if len(own) > leaf_rows:
                high = _upper_half((x[own] - x[own[0]]) @ rng.normal(size=x.shape[1]))
                if high is None:  # a direction rounds their differences away: one of the columns tells them apart
                    high = _upper_half(x[own, np.argmax([len(np.unique(x[own, j])) for j in range(x.shape[1])])])
                if high is not None:
                    pending += [own[~high], own[high]]
                    continue
            if len(own) < 2:
                continue
            size = max(1, 4_000_000 // len(own))
            near_zero = x[own] - x[own[0]]  # large common offsets would drown the differences
            squares = (near_zero**2).sum(1)
            for start in range(0, len(own), size):
                asked = own[start : start + size]
                d = squares[start : start + size, None] + squares[None, :] - 2 * near_zero[start : start + size] @ near_zero.T
                d[np.arange(len(asked)), start + np.arange(len(asked))] = np.inf
                best = own[np.argpartition(d, min(width, len(own) - 1) - 1, axis=1)[:, : min(width, len(own) - 1)]]
                left = np.repeat(asked, best.shape[1])
                out.append((keys[left], _distances(x, left, best.ravel()), keys[best.ravel()]))
        return _pairs_frame(out)

    each = homes.select("key", *[F.col(f"`{c}`") for c in features], F.posexplode("leaves").alias("tree", "leaf"))
    return each.groupBy("tree", "leaf").applyInPandas(near, "key long, distance double, other long")


def _hosts(lists: DataFrame, homes: DataFrame) -> DataFrame:
    """(place, listed, listing, new_listed, new_listing): per row with new entries around it, whom it lists and who lists it.

    Two rows that met at a host in the round before cannot get nearer to each other, so a host without a new entry on either side
    has no work, and one whose own list is as it was only needs those who list it anew.
    """
    entries = lists.select("key", F.explode(F.transform("near", lambda e: e["other"])).alias("host"), "new")
    fresh = F.array_contains("new", F.col("host"))
    listing = entries.select("host", F.col("key").alias("member"), fresh.alias("fresh")).groupBy("host").agg(
        F.collect_list("member").alias("listing"), F.collect_list(F.when(F.col("fresh"), F.col("member"))).alias("new_listing"))
    place = homes.select(F.col("key").alias("host"), F.col("leaves")[0].alias("place"))
    own = lists.select(F.col("key").alias("host"), F.transform("near", lambda e: e["other"]).alias("listed"), F.col("new").alias("new_listed"))
    none = F.array().cast("array<long>")
    around = join_large(join_large(own, place, "host"), listing, "host", "left").withColumns(
        {c: F.coalesce(c, none) for c in ("listing", "new_listing")})
    kept = F.when(F.size("new_listed") > 0, F.col("listing")).otherwise(F.col("new_listing"))
    return around.where("size(new_listed) > 0 OR size(new_listing) > 0").select("place", "listed", kept.alias("listing"), "new_listed", "new_listing")


def _local_join(lists: DataFrame, homes: DataFrame, features: list[str], width: int) -> DataFrame:
    """One round: who lists a row, and whom it lists, meet the rows it lists. ``new`` are a list's new entries, ``fresh`` counts them.

    The meeting place of a row is its leaf in the first tree, where most of its neighbours live, so a vector travels
    to few places. Pairs that met in the round before are left out, and only pairs nearer than the last entry of the list they
    go to leave a task.
    """
    hosts = cut_lineage(_hosts(lists, homes))
    last = F.when(F.size("near") >= width, F.get("near", F.lit(width - 1))["distance"]).otherwise(F.lit(float("inf")))
    axes = [f"x{i}" for i in range(len(features))]
    vectors = join_large(homes.select(F.col("key").alias("member"), *[F.col(f"`{c}`").alias(x) for c, x in zip(features, axes, strict=True)]),
                         lists.select(F.col("key").alias("member"), last.alias("last")), "member")
    guests = hosts.select("place", F.explode(F.array_union("listed", "listing")).alias("member")).distinct()
    # Aliased, so that both sides of the cogroup have columns of their own.
    needed = join_large(guests, vectors, "member").select(*[F.col(c).alias(c) for c in ("place", "member", *axes, "last")])

    def flat(lists: pd.Series, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Host number and row number of each entry of the lists."""
        sizes = lists.map(len).to_numpy(np.int64)
        entries = np.concatenate([np.empty(0, np.int64), *lists]).astype(np.int64)
        return np.repeat(np.arange(len(lists)), sizes), np.searchsorted(keys, entries)

    def meet(hosts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("member")
        keys, x, last = rows["member"].to_numpy(), rows[axes].to_numpy(float), rows["last"].to_numpy(float)
        out = []
        listed, new_listed = flat(hosts["listed"], keys), flat(hosts["new_listed"], keys)
        listing, new_listing = flat(hosts["listing"], keys), flat(hosts["new_listing"], keys)
        seen = ~np.isin(listed[0] * len(keys) + listed[1], new_listed[0] * len(keys) + new_listed[1])
        old_listed = listed[0][seen], listed[1][seen]
        # All members meet the new entries of the host's list, new members meet its other entries too.
        for members, guests in (((listed, listing), new_listed), ((new_listed, new_listing), old_listed)):
            table = np.full((len(hosts), width), -1, dtype=np.int64)
            table[guests[0], np.arange(len(guests[0])) - np.searchsorted(guests[0], guests[0])] = guests[1]
            meetings = np.unique(np.concatenate([host * len(keys) + member for host, member in members]))
            for start in range(0, len(meetings), 50_000):
                at, who = np.divmod(meetings[start : start + 50_000], len(keys))
                left, right = np.repeat(who, width), table[at].ravel()
                usable = (right >= 0) & (right != left)
                pair = np.unique(left[usable] * len(keys) + right[usable])
                left, right = np.divmod(pair, len(keys))
                d = _distances(x, left, right)
                better = d < last[left]
                out.append((keys[left[better]], d[better], keys[right[better]]))
        return _pairs_frame(out)

    nearer = hosts.groupBy("place").cogroup(needed.groupBy("place")).applyInPandas(meet, "key long, distance double, other long")
    known = lists.select("key", F.explode("near").alias("entry")).select("key", "entry.distance", "entry.other", F.lit(True).alias("known"))
    return _nearest_lists(known.unionByName(nearer.withColumn("known", F.lit(False))), width)


def _nearest_lists(pairs: DataFrame, width: int) -> DataFrame:
    """(key, near, new, fresh) from (key, distance, other): the ``width`` nearest others, ties to the smaller key."""
    if "known" not in pairs.columns:
        pairs = pairs.withColumn("known", F.lit(False))
    found = pairs.groupBy("key").agg(
        F.slice(F.array_sort(F.collect_set(F.struct("distance", "other"))), 1, width).alias("near"),
        F.collect_set(F.when(F.col("known"), F.col("other"))).alias("before"),
    )
    others = F.transform("near", lambda entry: entry["other"])
    return found.select("key", "near", F.array_except(others, F.col("before")).alias("new")).withColumn("fresh", F.size("new"))


def _with_vectors(lists: DataFrame, homes: DataFrame, features: list[str], k: int) -> DataFrame:
    """(key, neighbours) of the wanted rows: further copies of the row itself first, then its list."""
    wanted = homes.where("wanted")
    vector = F.array(*[F.col(f"`{c}`") for c in features]).alias("vector")
    entries = join_large(lists, wanted.select("key"), "key").select("key", F.explode(F.slice("near", 1, k)).alias("entry"))
    others = join_large(entries.select("key", "entry.distance", "entry.other"), homes.select(F.col("key").alias("other"), "copies", vector), "other")
    own = wanted.where("copies > 1").select("key", F.lit(-1.0).alias("distance"), F.col("key").alias("other"), (F.col("copies") - 1).alias("copies"), vector)
    sorted_entries = F.array_sort(F.collect_list(F.struct("distance", "other", F.least("copies", F.lit(k)).cast("int").alias("copies"), "vector")))
    repeated = F.flatten(F.transform(sorted_entries, lambda entry: F.array_repeat(entry["vector"], entry["copies"])))
    return others.unionByName(own).groupBy("key").agg(F.slice(repeated, 1, k).alias("neighbours"))


def _distances(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of row pairs, the same number in whatever task a pair meets."""
    total = np.zeros(len(left))
    for j in range(x.shape[1]):
        total += (x[left, j] - x[right, j]) ** 2
    return total


def _upper_half(values: np.ndarray) -> np.ndarray | None:
    """Rows above the median, or those of the largest value; None where all values are equal."""
    for high in (values > np.median(values), values >= values.max()):
        if high.any() and not high.all():
            return high
    return None


def _pairs_frame(parts: list[tuple]) -> pd.DataFrame:
    if not parts:
        return pd.DataFrame({"key": pd.Series(dtype="int64"), "distance": pd.Series(dtype="float64"), "other": pd.Series(dtype="int64")})
    return pd.DataFrame({name: np.concatenate([p[i] for p in parts]) for i, name in enumerate(("key", "distance", "other"))})


def _sample(rows: DataFrame, n: int, features: list[str]) -> np.ndarray:
    """The vectors of ``n`` rows by hash of the key, in its order.

    They come as Arrow, so a task merges the first rows of all partitions; a plain collect would merge them in the driver, which
    gets up to ``n`` rows of each, and make an object of every number.
    """
    table = hash_sample(rows, n, "key").select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)]).toArrow()
    return np.column_stack([c.to_numpy() for c in table.columns]).astype(float)


def _projection_tree(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> list[tuple[int, np.ndarray, float]]:
    """Cuts (node, direction, median) from the root down; node i has the children 2 i + 1 and 2 i + 2."""
    cuts, pending = [], [(0, np.arange(len(sample)))]
    while pending:
        node, rows = pending.pop(0)
        if len(rows) <= leaf or node > 2**50:
            continue
        direction = rng.normal(size=sample.shape[1])
        along = sample[rows] @ direction
        cut = float(np.median(along))
        high = along > cut
        if high.any() and not high.all():
            cuts.append((node, direction, cut))
            pending += [(2 * node + 1, rows[~high]), (2 * node + 2, rows[high])]
    return cuts


def nearest_neighbours(
    points: DataFrame,
    features: Sequence[str],
    k: int,
    leaf_rows: int = LEAF_ROWS,
    visitors_per_task: int = VISITORS_PER_TASK,
) -> DataFrame:
    """Per wanted point (key): its ``k`` nearest other rows as vectors.

    ``points`` has unique columns ``key`` (long), ``copies``, ``wanted`` (boolean) and the
    features; every point is a possible neighbour. Other copies of the same point come first,
    at distance 0. Result: key, neighbours (array of vectors).
    """
    features = list(features)
    points = points.select("key", "copies", "wanted", *[F.col(f"`{c}`") for c in features])
    n = points.count()
    leaves = max(1, min(MOST_LEAVES, -(-n // leaf_rows)))
    tree = 0
    if leaves > 1:
        tree = _partition(_sample(points, leaves * SAMPLE_PER_LEAF, features), leaves)
    # One stable copy: the leaf of a row and everything below have to come from the same rows.
    placed = cut_lineage(_with_leaf(points, features, tree)).repartition(leaves, "leaf")
    if leaves == 1:
        visits, parts = placed.filter("wanted"), {0: 1}
    else:
        boxes = placed.groupBy("leaf").agg(
            *[F.min(f"`{c}`").alias(f"a{i}") for i, c in enumerate(features)],
            *[F.max(f"`{c}`").alias(f"b{i}") for i, c in enumerate(features)],
        ).toPandas()
        visits = cut_lineage(_visits(_local_reach(placed, features, k), features, boxes))
        loads = {r["leaf"]: r["count"] for r in visits.groupBy("leaf").count().collect()}
        parts = {leaf: max(1, -(-load // visitors_per_task)) for leaf, load in loads.items()}
    candidates = _compare(visits, placed, features, k, parts)
    best = F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k)
    return candidates.groupBy("key").agg(best.alias("found")).select(
        "key", F.transform("found", lambda f: f["vector"]).alias("neighbours")
    )


def _partition(sample: np.ndarray, leaves: int):
    """Nested (feature, cut, lower, upper) splits with leaf numbers at the ends."""
    target = max(1, len(sample) // leaves)
    numbers = iter(range(10**9))

    def split(rows: np.ndarray):
        if len(rows) > 2 * target - 1 and len(rows) > 1:
            for feature in np.argsort(-np.ptp(rows, axis=0)):
                values = rows[:, feature]
                cut = np.median(values)
                upper = values > cut
                if not upper.any():
                    upper = values >= cut
                    below = values[~upper]
                    cut = below.max() if len(below) else cut
                if upper.any() and not upper.all():
                    return int(feature), float(cut), split(rows[~upper]), split(rows[upper])
        return next(numbers)

    return split(sample)


def _with_leaf(points: DataFrame, features: list[str], tree) -> DataFrame:
    def place(batches):
        def descend(x, rows, node, out):
            if isinstance(node, int):
                out[rows] = node
                return
            feature, cut, lower, upper = node
            high = x[rows, feature] > cut
            descend(x, rows[~high], lower, out)
            descend(x, rows[high], upper, out)

        for pdf in batches:
            x = pdf[features].to_numpy(float)
            leaf = np.zeros(len(pdf), dtype=np.int64)
            descend(x, np.arange(len(pdf)), tree, leaf)
            yield pdf.assign(leaf=leaf)

    schema = ", ".join(["key long", "copies long", "wanted boolean", *[f"`{c}` double" for c in features], "leaf long"])
    return points.select(
        F.col("key").cast("long").alias("key"), F.col("copies").cast("long").alias("copies"), F.col("wanted"),
        *[F.col(f"`{c}`").cast("double").alias(c) for c in features],
    ).mapInPandas(place, schema)


def _local_reach(placed: DataFrame, features: list[str], k: int) -> DataFrame:
    """Squared distance within which the k nearest rows of each point surely lie."""

    def reach(pdf: pd.DataFrame) -> pd.DataFrame:
        x, copies = pdf[features].to_numpy(float), pdf["copies"].to_numpy()
        wanted = np.flatnonzero(pdf["wanted"].to_numpy())
        bound = np.full(len(wanted), np.inf)
        size = max(1, 4_000_000 // max(1, len(pdf)))
        for start in range(0, len(wanted), size):
            block = slice(start, start + size)
            own = wanted[block]
            asked = x[own]
            d = np.maximum(0, (asked**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * asked @ x.T)
            weight = np.broadcast_to(copies, d.shape).copy()
            weight[np.arange(len(d)), own] -= 1
            d[np.arange(len(d)), own] = 0.0
            nearest = np.argpartition(d, min(k, d.shape[1] - 1), axis=1)[:, : k + 1]
            near = np.take_along_axis(d, nearest, 1)
            order = np.argsort(near, axis=1, kind="stable")
            held = np.cumsum(np.take_along_axis(np.take_along_axis(weight, nearest, 1), order, 1), axis=1)
            enough = held >= k
            at = np.argmax(enough, axis=1)
            kth = np.take_along_axis(np.take_along_axis(near, order, 1), at[:, None], 1)[:, 0]
            bound[block] = np.where(enough.any(1), kth, np.inf)
        return pdf.iloc[wanted][["key", *features]].assign(reach=bound * (1 + 1e-9) + 1e-9)

    schema = ", ".join(["key long", *[f"`{c}` double" for c in features], "reach double"])
    return placed.groupBy("leaf").applyInPandas(reach, schema)


def _visits(reach: DataFrame, features: list[str], boxes: pd.DataFrame) -> DataFrame:
    """One row per point and leaf it has to be compared with."""
    low = boxes[[f"a{i}" for i in range(len(features))]].to_numpy(float)
    high = boxes[[f"b{i}" for i in range(len(features))]].to_numpy(float)
    numbers = boxes["leaf"].to_numpy()

    def visit(batches):
        for pdf in batches:
            for start in range(0, len(pdf), 512):
                part = pdf.iloc[start : start + 512]
                x = part[features].to_numpy(float)
                gap = np.zeros((len(part), len(numbers)))
                for j in range(x.shape[1]):
                    out = np.maximum(0, np.maximum(low[None, :, j] - x[:, j, None], x[:, j, None] - high[None, :, j]))
                    gap += out**2
                row, leaf = np.nonzero(gap <= part["reach"].to_numpy()[:, None])
                yield part.iloc[row][["key", *features]].assign(leaf=numbers[leaf])

    schema = ", ".join(["key long", *[f"`{c}` double" for c in features], "leaf long"])
    return reach.mapInPandas(visit, schema)


def _compare(visits: DataFrame, placed: DataFrame, features: list[str], k: int, parts: dict[int, int]) -> DataFrame:
    """Nearest rows of each visitor among the members of the visited leaf."""
    counts = F.create_map(*[F.lit(x) for item in parts.items() for x in item])
    many = F.coalesce(F.try_element_at(counts, F.col("leaf")), F.lit(1))
    # Aliased, so that both sides of the cogroup have columns of their own.
    columns = [F.col(f"`{c}`").alias(c) for c in ("leaf", "part", "key", *features)]
    visitors = visits.withColumn("part", F.pmod(F.xxhash64("key"), many).cast("long")).select(*columns)
    spread = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (many - 1).cast("long"))))
    tasks = min(MOST_TASKS, sum(parts.values()))
    visitors = visitors.repartition(tasks, "leaf", "part")
    members = spread.select(*columns, F.col("copies").alias("copies")).repartition(tasks, "leaf", "part")

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys, found = [], []
        if len(left) and len(right):
            x, y = left[features].to_numpy(float), right[features].to_numpy(float)
            mine, theirs, copies = left["key"].to_numpy(), right["key"].to_numpy(), right["copies"].to_numpy()
            size = max(1, 4_000_000 // len(y))
            for start in range(0, len(x), size):
                block = x[start : start + size]
                d = np.maximum(0, (block**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2 * block @ y.T)
                same = mine[start : start + size, None] == theirs[None, :]
                d[same] = -1.0
                nearest = np.argpartition(d, min(k, len(y) - 1), axis=1)[:, : k + 1]
                for i, row in enumerate(nearest):
                    entries = []
                    for j in sorted(row, key=lambda j: (d[i, j], theirs[j])):
                        repeat = copies[j] - 1 if same[i, j] else copies[j]
                        entry = {"distance": max(0.0, float(d[i, j])), "key": int(theirs[j]), "vector": y[j].tolist()}
                        entries += [entry] * int(min(repeat, k - len(entries)))
                        if len(entries) >= k:
                            break
                    keys.append(int(mine[start + i]))
                    found.append(entries)
        return pd.DataFrame({"key": pd.Series(keys, dtype="int64"), "found": pd.Series(found, dtype=object)})

    return visitors.groupBy("leaf", "part").cogroup(members.groupBy("leaf", "part")).applyInPandas(
        nearest, "key long, found array<struct<distance: double, key: long, vector: array<double>>>"
    )
