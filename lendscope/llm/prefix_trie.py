"""Trie of conversation prefixes; subtree totals by parallel tree contraction in join rounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.skew import spread_lookup
from lendscope.llm.tables import partitions, written, written_counting

RANGE_ROWS = 200_000
CHUNK_TURNS = 4_096
PIECE_BYTES = 1 << 20
MOST_ROUNDS = 200
PREFIX = ["depth", "a", "b"]
NODE = ["conv", "depth"]


def _lanes(*parts: Column) -> list[Column]:
    """128 bits that stand for some values, in two numbers."""
    digest = F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv, place, content, size): turns of each conversation numbered from 1, by turn (null first).

    ``turns`` has (conv_id, turn, role, text). Nulls of role and text are empty. Turns with one number are ordered by
    the digest of their content, so equal ones are alike. Rows without conv_id belong to no conversation. Rows are cut into
    ranges of (conversation, turn, content), numbered inside, and moved on by what earlier ranges hold of the conversation,
    so one conversation may have any share of the rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.unhex(content).alias("content"),
        F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("row"))
    rows, total = written_counting(rows, F.lit(True))
    order = ["conv", "turn", "content", "row"]
    ranges = partitions(turns.sparkSession, total, RANGE_ROWS)
    ranged = written(rows.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")).where("start > 0")
    inside = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order[1:]))
    placed = ranged.withColumn("place", inside.cast("long")).join(starts, ["conv", "part"], "left")
    return placed.select("conv", (F.col("place") + F.coalesce("start", F.lit(0))).alias("place"), "content", "size")


def rebuilt_turns(placed: DataFrame, total: int, heads: int, group: int) -> tuple[DataFrame, DataFrame]:
    """Conversations after taking the first turns of their group's first one: (conv, depth, content, size), (conv, length).

    Conversation c takes the first h turns of conversation c - c % ``group`` (all if there are fewer, none if there is no such
    one), h = crc32(c in digits) % ``heads``, and then its own turns after its first h.
    """
    lengths = placed.groupBy("conv").agg(F.count("*").alias("own"))
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("long")
    known = lengths.withColumn("taken", taken).withColumn("base", F.col("conv") - F.col("conv") % group)
    bases = lengths.select(F.col("conv").alias("base"), F.col("own").alias("has"))
    plan = known.join(bases, "base", "left").withColumn("from_base", F.least("taken", F.coalesce("has", F.lit(0).cast("long"))))
    plan = written(plan.select("conv", "base", "taken", "from_base", (
        F.col("from_base") + F.greatest(F.lit(0), F.col("own") - F.col("taken"))).cast("long").alias("length")))
    first = placed.where(F.col("place") < heads).select(F.col("conv").alias("base"), F.col("place").alias("depth"), "content", "size")
    borrowed = plan.join(first, "base").where("depth <= from_base").select("conv", "depth", "content", "size")
    own = spread_lookup(placed, plan.select("conv", "taken", "from_base"), ["conv"], F.col("place"), lengths.withColumnRenamed("own", "n"), total)
    own = own.where("place > taken").select("conv", (F.col("place") - F.col("taken") + F.col("from_base")).alias("depth"), "content", "size")
    return borrowed.union(own), plan.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, a, b, xa, xb, size): the prefix that ends with each turn, as 128 bits (a, b).

    The bits of a prefix are the exclusive or of those of its (depth, turn) pairs, (xa, xb) for the last one, so
    the prefix before has (a ^ xa, b ^ xb). Two of n prefixes agree by accident with probability n * n / 2**129. Running
    values are taken in runs of CHUNK_TURNS turns and carried on.
    """
    xa, xb = _lanes(F.col("depth"), F.hex("content"))
    marked = turns.select("conv", "depth", "size", xa.alias("xa"), xb.alias("xb"),
                          F.floor(F.col("depth") / CHUNK_TURNS).cast("long").alias("run"))
    marked = written(marked)
    within = Window.partitionBy("conv", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = marked.groupBy("conv", "run").agg(F.bit_xor("xa").alias("ra"), F.bit_xor("xb").alias("rb"))
    before = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv", "run", F.bit_xor("ra").over(before).alias("ca"), F.bit_xor("rb").over(before).alias("cb")).where("run > 0")
    running = marked.withColumns({"a": F.bit_xor("xa").over(within), "b": F.bit_xor("xb").over(within)}).join(carried, ["conv", "run"], "left")
    zero = F.lit(0).cast("long")
    return running.select("conv", "depth", F.col("a").bitwiseXOR(F.coalesce("ca", zero)).alias("a"),
                          F.col("b").bitwiseXOR(F.coalesce("cb", zero)).alias("b"), "xa", "xb", "size")


def trie_nodes(found: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, depth, a, b, n_convs, size, parent): a row per distinct prefix, the root with depth 0 and no parent.

    ``conv`` is the smallest member; (conv, depth) names a node, as a conversation has one prefix of each depth. ``parent``
    is the smallest member of the prefix before.
    """
    zero = F.lit(0).cast("long")
    below = found.groupBy(*PREFIX).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
                                       F.max("xa").alias("xa"), F.max("xb").alias("xb"))
    root = conversations.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv", "n_convs", zero.alias("size"), zero.alias("xa"), zero.alias("xb"))
    nodes, total = written_counting(below.unionByName(root), F.lit(True))
    children = nodes.where("depth > 0").select(
        "conv", (F.col("depth") - 1).alias("depth"), F.col("a").bitwiseXOR(F.col("xa")).alias("a"), F.col("b").bitwiseXOR(F.col("xb")).alias("b"),
        F.col("a").alias("own_a"), F.col("b").alias("own_b"), "n_convs", "size")
    counts = children.groupBy(*PREFIX).agg(F.count("*").alias("n"))
    linked = spread_lookup(children, nodes.select(*PREFIX, F.col("conv").alias("parent")), PREFIX, F.col("conv"), counts, total)
    linked = linked.select("conv", (F.col("depth") + 1).alias("depth"), F.col("own_a").alias("a"), F.col("own_b").alias("b"), "n_convs", "size", "parent")
    return written(linked.unionByName(nodes.where("depth = 0").select("conv", "depth", "a", "b", "n_convs", "size").withColumn("parent", F.lit(None).cast("long"))))


def _all(frames: list[DataFrame]) -> DataFrame:
    first, *more = frames
    for frame in more:
        first = first.unionByName(frame)
    return first


def _doubled(chain: DataFrame) -> DataFrame:
    """Chain nodes (conv, depth, to_conv, to_depth, leaves, saved, open, ...) with ``to`` moved to the first node below that
    is no chain node.

    ``leaves`` and ``saved`` are summed over the nodes from a node to ``to``, without the latter. Each round an open node takes
    over the pointer and adds the sums of the node it points at, so the distance doubles; a node that points at the
    end is done and not written again.
    """
    done: list[DataFrame] = []
    still, left = written_counting(chain, F.col("open"))
    for _ in range(MOST_ROUNDS):
        done.append(still.where("not open"))
        if not left:
            return _all(done)
        moving = still.where("open")
        target = _all([*done, moving]).select(
            F.col("conv").alias("to_conv"), F.col("depth").alias("to_depth"), F.col("to_conv").alias("next_conv"),
            F.col("to_depth").alias("next_depth"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"), F.col("open").alias("its_open"))
        moved = moving.join(target, ["to_conv", "to_depth"])
        still, left = written_counting(moved.select(
            *NODE, F.col("next_conv").alias("to_conv"), F.col("next_depth").alias("to_depth"), "parent_conv", "parent_depth",
            (F.col("leaves") + F.col("more_leaves")).alias("leaves"), (F.col("saved") + F.col("more_saved")).alias("saved"),
            F.col("its_open").alias("open")), F.col("open"))
    raise RuntimeError("chains did not settle")


def subtree_totals(tree: DataFrame) -> DataFrame:
    """Sums over every subtree, its top included: (conv, depth, leaves, saved).

    ``tree`` has a row per node: (conv, depth, parent_conv, parent_depth, leaves, saved) with the node's own values; roots have
    a null parent. Tree contraction: a round compresses every chain of nodes with one child to a pointer to the chain's end
    (by doubling), then rakes all leaves: a leaf's total is final and goes, with the chain above it, to its parent. A
    round at least halves the leaves, so their number is logarithmic whatever the tree's shape. Then the rounds are undone
    from the last to the first: a chain node's total is what it held plus the total of the chain's end. A node with
    many children costs one row per task, as sums combine there first; a long chain's end is looked up by salted rows.
    """
    zero = F.lit(0).cast("long")
    active, left = written_counting(tree, F.lit(True))
    raked, chains = [], []
    while left:
        if len(raked) == MOST_ROUNDS:
            raise RuntimeError("the tree did not contract")
        degree = active.where("parent_conv is not null").groupBy("parent_conv", "parent_depth").agg(
            F.count("*").alias("children"), F.min(F.struct("conv", "depth")).alias("child"))
        degree = degree.select(F.col("parent_conv").alias("conv"), F.col("parent_depth").alias("depth"), "children", "child")
        state = active.join(degree, NODE, "left").withColumn("children", F.coalesce("children", zero))
        state, unary = written_counting(state, F.col("children") == 1)
        rest = state.where("children <> 1")
        above = {c: zero for c in ("leaves", "saved")}
        parent = {c: F.col(f"parent_{c}") for c in NODE}
        if unary:
            pointers = state.where("children = 1").select(
                *NODE, F.col("child.conv").alias("to_conv"), F.col("child.depth").alias("to_depth"), "parent_conv", "parent_depth", "leaves", "saved")
            kinds = state.select(F.col("conv").alias("to_conv"), F.col("depth").alias("to_depth"), (F.col("children") == 1).alias("open"))
            chain = _doubled(pointers.join(kinds, ["to_conv", "to_depth"]))
            # The top of a chain is its node of least depth: what it holds lies between its parent and the chain's end.
            tops = chain.groupBy("to_conv", "to_depth").agg(
                F.min(F.struct("depth", "parent_conv", "parent_depth", "leaves", "saved")).alias("top"), F.count("*").alias("n"))
            tops = written(tops)
            chains.append((chain, tops.select("to_conv", "to_depth", "n"), unary))
            rest = rest.join(tops.select(F.col("to_conv").alias("conv"), F.col("to_depth").alias("depth"), "top"), NODE, "left")
            above = {c: F.coalesce(f"top.{c}", zero) for c in above}
            parent = {c: F.when(F.col("top").isNull(), F.col(f"parent_{c}")).otherwise(F.col(f"top.parent_{c}")) for c in parent}
        else:
            chains.append(None)
        rest = written(rest.select(*NODE, *[v.alias(f"parent_{c}") for c, v in parent.items()], "leaves", "saved", "children",
                                   *[v.alias(f"above_{c}") for c, v in above.items()]))
        raked.append(rest.where("children = 0").select(*NODE, "leaves", "saved"))
        leaf = F.col("children") == 0
        gifts = rest.where("parent_conv is not null").groupBy("parent_conv", "parent_depth").agg(*[
            F.sum(F.col(f"above_{c}") + F.when(leaf, F.col(c)).otherwise(0)).alias(f"more_{c}") for c in ("leaves", "saved")])
        gifts = gifts.select(F.col("parent_conv").alias("conv"), F.col("parent_depth").alias("depth"), "more_leaves", "more_saved")
        active, left = written_counting(rest.where("children > 1").join(gifts, NODE, "left").select(
            *NODE, "parent_conv", "parent_depth", *[(F.col(c) + F.coalesce(f"more_{c}", zero)).alias(c) for c in ("leaves", "saved")]), F.lit(True))
    known = [active.select(*NODE, "leaves", "saved")]
    for own, undone in zip(reversed(raked), reversed(chains), strict=True):
        known.append(own)
        if undone is None:
            continue
        chain, counts, total = undone
        ends = _all(known).select(F.col("conv").alias("to_conv"), F.col("depth").alias("to_depth"), F.col("leaves").alias("end_leaves"), F.col("saved").alias("end_saved"))
        opened = spread_lookup(chain, ends, ["to_conv", "to_depth"], F.struct(*NODE), counts, total)
        known.append(written(opened.select(*NODE, *[(F.col(c) + F.col(f"end_{c}")).alias(c) for c in ("leaves", "saved")])))
    return _all(known)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted rows as comma-joined pieces: (depth, a, b, low, piece)."""
    import itertools

    held, ids, size = None, [], 0

    def send() -> pa.RecordBatch:
        depth, a, b = held
        return pa.RecordBatch.from_pydict({"depth": [depth], "a": [a], "b": [b], "low": [ids[0]], "piece": [",".join(map(str, ids))]})

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in (*PREFIX, "conv")), strict=True)
        for key, group in itertools.groupby(rows, lambda r: r[:3]):
            if held is not None and (key != held or size >= PIECE_BYTES):
                yield send()
                ids, size = [], 0
            held = key
            new = [r[3] for r in group]
            ids += new
            size += 12 * len(new)
    if ids:
        yield send()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of sorted rows to one SHA-256 per prefix, fed piece by piece."""
    held, digest = None, None
    out: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], pa.int64()) for i in range(3)), pa.array([r[3] for r in out], pa.string())],
                                          names=[*PREFIX, "ends_sha256"])

    for batch in batches:
        for depth, a, b, piece in zip(*(batch.column(c).to_pylist() for c in (*PREFIX, "piece")), strict=True):
            if (depth, a, b) != held:
                if held is not None:
                    out.append((*held, digest.hexdigest()))
                    if len(out) >= 10_000:
                        yield batch_of()
                        out = []
                held, digest = (depth, a, b), hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if held is not None:
        out.append((*held, digest.hexdigest()))
    yield batch_of()


def end_hashes(ends: DataFrame, total: int) -> DataFrame:
    """(depth, a, b, ends_sha256) of the ``total`` conversations (conv, depth, a, b) that end at a prefix, ids ascending.

    Ranges of sorted ids become pieces of text; a prefix's pieces are then fed to one hash in order. SHA-256 takes its bytes
    in order, so those of one prefix, a few per conversation, pass one task, piece by piece and never held together.
    """
    ranges = partitions(ends.sparkSession, total, RANGE_ROWS)
    ordered = ends.repartitionByRange(ranges, *PREFIX, "conv").sortWithinPartitions(*PREFIX, "conv")
    pieces = ordered.select(*PREFIX, "conv").mapInArrow(_pieces, "depth long, a long, b long, low long, piece string")
    return pieces.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "low").mapInArrow(
        _hashes, "depth long, a long, b long, ends_sha256 string")


def conversation_trie(turns: DataFrame, heads: int = 9, group: int = 5) -> DataFrame:
    """The trie of all rebuilt conversations, a row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256).

    ``turns`` has (conv_id, turn, role, text); see ``numbered_turns`` for their order, nulls, ties and repeated rows (each is a
    turn of its own) and ``rebuilt_turns`` for h. A node is a distinct sequence of first rebuilt turns, the root the
    empty one; its members are the conversations that begin with it, and conv_id is the smallest. n_leaves counts the
    childless nodes of its subtree, saved_tokens sums (members - 1) * UTF-8 bytes of the last text over it; ends_sha256 is
    that of the ids that end there, comma-joined (of nothing, if none). A conversation without rebuilt turns ends at the
    root. Rows with a null conv_id belong to no conversation; a table without conversations gives no rows. Texts, of any length,
    are hashed in the scan and never shuffled; other columns are not read.
    """
    placed, rows = written_counting(numbered_turns(turns), F.lit(True))
    rebuilt, conversations = rebuilt_turns(placed, rows, heads, group)
    found = written(prefixes(rebuilt))
    nodes = trie_nodes(found, conversations)
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    own = nodes.select(*NODE, F.col("parent").alias("parent_conv"), F.when(F.col("parent").isNotNull(), F.col("depth") - 1).alias("parent_depth"),
                       F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                       ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    totals = subtree_totals(own)
    zero = F.lit(0).cast("long")
    turnless = conversations.where("length = 0").select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"))
    last = found.groupBy("conv").agg(F.max(F.struct(*PREFIX)).alias("end")).select("conv", "end.*")
    ends, total = written_counting(last.unionByName(turnless), F.lit(True))
    ends = end_hashes(ends, total)
    full = nodes.join(totals, NODE).join(ends, PREFIX, "left")
    return full.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                       F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
