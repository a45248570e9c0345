"""Operator 13: the prefix trie of conversations, rolled up by centroid decomposition.

**Turns.** A turn is known by a SHA-256 of its role and text; texts are not shuffled. Rows are sorted by
conversation and turn over ranges that may cut a conversation in two, so a conversation that holds a third of all rows
is spread over many tasks; a turn's place is its place in the range plus the counts of the ranges before.

**Trie.** A prefix is known by its length and the exclusive or of 128-bit hashes of (place, turn), which adds up in
blocks of ``BLOCK`` places. The prefix's node is named by its depth and its least member, the *face*. A
conversation's node at a depth is looked up in the *walks*: (conversation, depth, face). A face's own nodes form
a vertical run, cut into blocks of ``BLOCK`` depths wherever rows are grouped by face.

**Rollup.** The nodes form a forest by their parent edges. Every component is known by its top. The weight of a
node is the number of walk rows in its subtree, which the walks give without a rollup. In each round
the centroid of a component is its deepest node with more than half of the weight: what hangs below it, and what is left
above, each has at most half, so the rounds are at most log2 of all rows. The components below the centroid give
their totals, which together with its own value are its sum within the component; that sum is added to all nodes on the
path from the centroid to the top, which its face's walk lists, and its weight is taken off them. Then the
centroid leaves, its children become tops, and every part goes on by itself. A node's sum is its sum as a centroid plus what
was added before. Paths are never walked step by step, so a conversation of millions of turns takes no more
rounds than a bushy trie of the same weight.

Each round is stored under ``spark.checkpoint.dir``; heavy components and nodes are joined by broadcast of at
most ``skewed.SHARE`` keys. The member list of a node is hashed as a stream of pieces of 4096 ids: SHA-256 runs in order, so
one task reads the ids of one node, but holds one batch of them.

Defined cases: rows without ``conv_id`` belong to no conversation and are left out; turns of one number (null among
them, first) are ordered by the digest of role and text, equal rows are turns of their own; null role or text is
empty; the remainder of a negative ``conv_id`` has its sign; an empty table has no node; further columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.skewed import join_heavy
from tallyspan.llm.staging import map_arrow, staged

#: Places (or depths) of a conversation that are handled as one group.
BLOCK = 1 << 12
#: Low bits of an id within one piece of a member list.
PIECE_BITS = 12
#: Conversations of one family share the first turns of its first member, up to one less than ``HEADS``.
FAMILY, HEADS = 5, 9

_COMPONENT = ["top", "top_depth"]


# ---- turns ----------------------------------------------------------------------------------


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)``: rows of (conv, pos from 1, n turns of conv, digest, n_bytes), and (conv, n)."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        # only to cut between equal rows; it follows the scan's splits, so a repeated task makes the same
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(
        ranged.select("conv", "digest", "n_bytes", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")),
        "turns",
    )
    # as many rows for a conversation as it has ranges
    runs = placed.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("k"), F.min("at").alias("first"))
    by_range = Window.partitionBy("conv").orderBy("range")
    earlier = F.coalesce(F.sum("k").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = staged(
        runs.select("conv", "range", "first", "k", earlier.alias("earlier"), F.sum("k").over(Window.partitionBy("conv")).alias("n")),
        "turn-runs",
    )
    turns = placed.join(runs, ["conv", "range"]).select(
        "conv", (F.col("at") - F.col("first") + F.col("earlier") + 1).alias("pos"), "n", "digest", "n_bytes"
    )
    return staged(turns, "placed-turns"), runs.where("earlier = 0").select("conv", "n")


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with its first h turns replaced by those of the family's first member c - c % 5,
    where h is crc32(c) % 9. Same columns as :func:`ordered_turns`."""
    heads = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h")
    family = (F.col("conv") - F.col("conv") % FAMILY).alias("family")
    own = convs.select("conv", F.col("n").alias("was"), heads, family)
    first = convs.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("family"), F.col("n").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    known = staged(
        own.join(first, "family", "left").select(
            "conv", "family", "h", taken.alias("taken"), (taken + F.greatest(F.col("was") - F.col("h"), F.lit(0))).alias("n")
        ),
        "conversations",
    )
    # what a turn needs to know of its conversation is joined block by block, as one conversation may be most of the rows
    kept = turns.withColumn("h", heads).where("pos > h")
    blocks = kept.withColumn("block", _block("pos"))
    wanted = blocks.select("conv", "block").distinct().join(known.select("conv", "taken", F.col("n").alias("length")), "conv")
    tails = blocks.join(wanted, ["conv", "block"]).select(
        "conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), F.col("length").alias("n"), "digest", "n_bytes"
    )
    lent = turns.where((F.col("pos") < HEADS) & (F.col("conv") % FAMILY == 0)).select(
        F.col("conv").alias("family"), "pos", "digest", "n_bytes"
    )
    fronts = lent.join(known, "family").where("pos <= h").select("conv", "pos", "n", "digest", "n_bytes")
    return tails.unionByName(fronts), known.select("conv", "n")


def _block(place: str) -> Column:
    return F.floor(F.col(place) / BLOCK)


# ---- trie -----------------------------------------------------------------------------------


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for each turn: (conv, pos, n, n_bytes) and the 128-bit hash ``x``, ``y`` of the turns up to it."""
    block = F.floor((F.col("pos") - 1) / BLOCK)
    hashed = turns.select(
        "conv", "pos", "n", "n_bytes", block.alias("block"),
        F.xxhash64("pos", "digest").alias("x"), F.xxhash64("digest", "pos").alias("y"),
    )
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = staged(
        hashed.select(
            "conv", "pos", "n", "n_bytes", "block", F.bit_xor("x").over(inside).alias("x"), F.bit_xor("y").over(inside).alias("y")
        ),
        "prefix-blocks",
    )
    # a full block's last row holds the block's hash
    so_far = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    carried = local.where(F.col("pos") % BLOCK == 0).select(
        "conv", (F.col("block") + 1).alias("block"), F.bit_xor("x").over(so_far).alias("cx"), F.bit_xor("y").over(so_far).alias("cy")
    )
    return local.join(carried, ["conv", "block"], "left").select(
        "conv", "pos", "n", "n_bytes",
        F.col("x").bitwiseXOR(F.coalesce("cx", F.lit(0))).alias("x"),
        F.col("y").bitwiseXOR(F.coalesce("cy", F.lit(0))).alias("y"),
    )


def build_trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, walks)``. Nodes: (face, depth, parent, n_convs, n_children, weight, n_bytes), the parent by its face;
    walks: (conv, depth, face, parent, ends), without the root."""
    rows = staged(prefixes(turns), "prefixes")
    same = ["pos", "x", "y"]
    found = staged(
        rows.groupBy(*same).agg(
            F.min("conv").alias("face"), F.count(F.lit(1)).alias("n_convs"),
            F.sum(F.col("n") - F.col("pos") + 1).alias("weight"), F.max("n_bytes").alias("n_bytes"),
        ),
        "prefix-groups",
    )
    everything = convs.agg(F.min("conv"), F.count(F.lit(1)), F.sum("n")).first()
    root, n_convs = everything[0], everything[1]
    if root is None:
        root, weight = 0, 0
    else:
        weight = n_convs + everything[2]
    faced = join_heavy(rows.select("conv", "n", *same), found.select(*same, "face", "n_convs"), same, "n_convs", max(weight, 1))
    steps = staged(faced.select("conv", F.col("pos").alias("depth"), "face", (F.col("pos") == F.col("n")).alias("ends")), "steps")
    above = steps.select("conv", (F.col("depth") + 1).alias("depth"), F.col("face").alias("parent"))
    walks = staged(
        steps.join(above, ["conv", "depth"], "left").select(
            "conv", "depth", "face", F.coalesce("parent", F.lit(root).cast("long")).alias("parent"), "ends"
        ),
        "walks",
    )
    own = walks.where("conv = face").select("face", "depth", "parent")
    counted = found.select("face", F.col("pos").alias("depth"), "n_convs", "weight", "n_bytes").join(own, ["face", "depth"])
    spark = turns.sparkSession
    top = spark.createDataFrame(
        [(root, 0, None, n_convs, weight, 0)] if n_convs else [],
        "face long, depth long, parent long, n_convs long, weight long, n_bytes long",
    )
    every = counted.unionByName(top)
    children = own.groupBy(F.col("parent").alias("face"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = every.join(children, ["face", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return staged(nodes, "nodes"), walks


# ---- rollup ---------------------------------------------------------------------------------


def subtree_sums(nodes: DataFrame, walks: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(face, depth) and, for each of the measures of ``nodes`` (long, not null), its sum over the node's subtree."""
    spark = nodes.sparkSession
    keyed = ["face", "depth"]
    top = nodes.where("depth = 0").select("face", "weight").first()
    schema = ", ".join(["face long, depth long", *[f"{m} long" for m in measures]])
    if top is None:
        return spark.createDataFrame([], schema)
    root, total = top
    state = staged(
        nodes.select(
            *keyed, "weight", F.lit(root).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"),
            *measures, *[F.lit(0).cast("long").alias(f"added_{m}") for m in measures],
        ),
        "components",
    )
    settled = []
    while not state.isEmpty():
        centroids, state = _split(state, walks, measures, root, total)
        settled.append(centroids)
    done = spark.read.parquet(*[f for c in settled for f in c.inputFiles()])
    return done.select(
        F.col("c_face").alias("face"), F.col("c_depth").alias("depth"), *[(F.col(m) + F.col(f"added_{m}")).alias(m) for m in measures]
    )


def _split(state: DataFrame, walks: DataFrame, measures: Sequence[str], root: int, total: int) -> tuple[DataFrame, DataFrame]:
    """One round: the centroids with their sums, and the nodes that are left in their new components."""
    added = [f"added_{m}" for m in measures]
    tops = state.where("face = top AND depth = top_depth").select(*_COMPONENT, F.col("weight").alias("whole"))
    heavy_half = join_heavy(state.select(*_COMPONENT, "face", "depth", "weight"), tops, _COMPONENT, "whole", total).where("2 * weight > whole")
    # these lie on one path of the component; the deepest is the centroid
    centroids = staged(
        heavy_half.groupBy(*_COMPONENT).agg(
            F.max("depth").alias("c_depth"), F.max_by("face", "depth").alias("c_face"),
            F.min("weight").alias("c_weight"), F.max("whole").alias("whole"),
        ),
        "centroids",
    )

    marked = staged(join_heavy(state, centroids, _COMPONENT, "whole", total).withColumn("block", _block("depth")), "marked")
    # where a face's walk goes just below the centroid; one lookup for a block of a face's nodes
    lookup = ["face", "block", "c_depth", "c_face"]
    below = (
        marked.where("depth > c_depth").select(*lookup).distinct()
        .join(
            walks.select(F.col("conv").alias("face"), (F.col("depth") - 1).alias("c_depth"), F.col("face").alias("child"), F.col("parent").alias("c_face")),
            ["face", "c_depth", "c_face"],
        )
    )
    moved = marked.join(below.select(*lookup, "child"), lookup, "left").withColumn(
        "child", F.when(F.col("depth") > F.col("c_depth"), F.col("child"))
    )
    is_centroid = (F.col("face") == F.col("c_face")) & (F.col("depth") == F.col("c_depth"))
    moved = staged(moved.withColumn("is_centroid", is_centroid), "moved")

    sums = moved.where("child IS NOT NULL OR is_centroid").groupBy("c_face", "c_depth").agg(
        *[F.sum(m).alias(m) for m in measures],
        *[F.max(F.when(F.col("is_centroid"), F.col(a))).alias(a) for a in added],
    )
    solved = staged(centroids.join(sums, ["c_face", "c_depth"]), "solved")

    path = _paths(solved, walks, root).select(
        "face", "depth", F.col("c_weight").alias("less"), *[F.col(m).alias(f"more_{m}") for m in measures]
    )
    below_now = F.col("child").isNotNull()
    rest = moved.where("NOT is_centroid").select(
        "face", "depth", "weight",
        F.when(below_now, F.col("child")).otherwise(F.col("top")).alias("top"),
        F.when(below_now, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        *measures, *added,
    )
    left = rest.join(path, ["face", "depth"], "left").select(
        "face", "depth", (F.col("weight") - F.coalesce("less", F.lit(0))).alias("weight"), *_COMPONENT, *measures,
        *[(F.col(f"added_{m}") + F.coalesce(f"more_{m}", F.lit(0))).alias(f"added_{m}") for m in measures],
    )
    return solved, staged(left, "components")


def _paths(centroids: DataFrame, walks: DataFrame, root: int) -> DataFrame:
    """A row for each node above a centroid, up to the top of its component, with the centroid's columns."""
    low, high = F.greatest("top_depth", F.lit(1)), F.col("c_depth") - 1
    long = centroids.where("c_depth > top_depth")
    # block by block, so that no array is longer than a block
    blocks = long.where(low <= high).withColumn("block", F.explode(F.sequence(F.floor(low / BLOCK), F.floor(high / BLOCK))))
    spread = blocks.repartition("c_face", "block")
    first = F.greatest(low, F.col("block") * BLOCK)
    last = F.least(high, F.col("block") * BLOCK + (BLOCK - 1))
    places = spread.withColumn("depth", F.explode(F.sequence(first, last))).withColumn("conv", F.col("c_face"))
    steps = places.join(walks.select("conv", "depth", "face"), ["conv", "depth"])
    at_root = long.where("top_depth = 0").withColumns({"depth": F.lit(0).cast("long"), "face": F.lit(root).cast("long")})
    return steps.drop("conv", "block").unionByName(at_root)


# ---- members that end at a node ---------------------------------------------------------------


def ends_digest(walks: DataFrame, convs: DataFrame, root: int) -> DataFrame:
    """(face, depth, ends_sha256): the SHA-256 of the ids that end at a node, ascending, joined by commas."""
    here = walks.where("ends").select("face", "depth", "conv")
    turnless = convs.where("n = 0").select(F.lit(root).cast("long").alias("face"), F.lit(0).cast("long").alias("depth"), "conv")
    # an id ends at one node only, so a piece has at most 2**PIECE_BITS ids
    pieces = (
        here.unionByName(turnless)
        .groupBy("face", "depth", F.shiftright("conv", PIECE_BITS).alias("piece"))
        .agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for face, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("face", "depth", "ids")), strict=True):
                if (face, depth) == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (face, depth), hashlib.sha256(ids.encode())
            yield _ends(out)
        if node is not None:
            yield _ends([(*node, digest.hexdigest())])

    ordered = pieces.repartition("face", "depth").sortWithinPartitions("face", "depth", "piece")
    return map_arrow(ordered.select("face", "depth", "ids"), run, "face long, depth long, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = [[r[k] for r in rows] for k in range(3)]
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["face", "depth", "ends_sha256"])


# ---- the operator -----------------------------------------------------------------------------


def trie_report(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of these turns; ``convs`` lists every conversation, turnless ones too."""
    nodes, walks = build_trie(turns, convs)
    root = nodes.where("depth = 0").select("face").first()
    valued = nodes.withColumns(
        {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}
    )
    sums = subtree_sums(valued, walks, ["n_leaves", "saved_tokens"])
    ends = ends_digest(walks, convs, root[0] if root else 0)
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.select("face", "depth", "parent", "n_convs", "n_children")
        .join(sums, ["face", "depth"])
        .join(ends, ["face", "depth"], "left")
        .select(
            F.col("face").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    return trie_report(*ordered_turns(conversations))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations whose first turns are those of their family's first member."""
    return trie_report(*rebuilt_turns(*ordered_turns(conversations)))
