"""Linking shared by the near-duplicate operators: candidate rounds and components.

DataFrame operations only. Intermediate tables go to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import release, stored, sweep

# A table of ids up to this many rows (16 bytes each) may be broadcast; larger ones are joined by shuffle.
BROADCAST_IDS = 1_000_000
# A node that has more rows of other components to look at than this, and than so many times
# its size, gets a cheaper allocation. A look is a comparison of sketches inside a join (about 20 ns); a node's full
# index has about three rows per element, which cost some 2 us each to sign, store, rank and join.
PLAIN_COST = 64
PLAIN_SIZES = 200
# Star rounds at most, and the share of tested pairs that must link for another one. They only spare later work: what they leave apart is searched whole.
STAR_ROUNDS = 4
STAR_GAIN = 50


def bounded(rows: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """Broadcast a stored narrow table if it has at most ``limit`` rows, else leave the join to Spark."""
    return F.broadcast(rows) if rows.count() <= limit else rows


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps: every node points at the smallest
    neighbour until only stars remain. A node's neighbours are never gathered, only their
    minimum (combined map-side), so a hub with any number of links is safe."""
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    seen = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        pointed = down.join(least, "a")
        small = pointed.select(F.col("b").alias("a"), F.col("m").alias("b")).union(pointed.select("a", F.col("m").alias("b")))
        edges, before = stored(small.where("a <> b").distinct(), "edges"), edges
        release(before)
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == state:
            break
        seen = state
    out = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component")), "components")
    release(edges)
    return out


def shared_signatures(rows: DataFrame) -> DataFrame:
    """(sig, node, meta, others) of signatures that two or more nodes have, not all of them low; a row occurs once.

    One shuffle by signature. ``others``: how many other nodes have it; two low rows do not count for each other."""
    by_sig, low = Window.partitionBy("sig"), F.shiftright("meta", 1).bitwiseAND(1)
    met = rows.repartition("sig").withColumns({"lo": F.min("node").over(by_sig), "hi": F.max("node").over(by_sig), "all_low": F.min(low).over(by_sig)})
    return (met.where("lo < hi and all_low = 0").groupBy("sig", "node").agg(F.max("meta").alias("meta"))
            .withColumn("others", F.when(low == 1, F.sum(1 - low).over(by_sig)).otherwise(F.count(F.lit(1)).over(by_sig) - 1)))


def probing(members: DataFrame) -> DataFrame:
    """(sig, node, low, probes, hub, hub_low): which rows probe, and a hub for each signature that has one: the smallest
    probing node, one whose row is not low if there is any.

    ``meta`` is 4 * spare + 2 * low + first: a node's rows of one scheme (low or not) may leave out
    ``spare`` units, dearest first. The rows with ``first`` (one segment and its one-deletion
    neighbourhood) are worth two units together, every other row one."""
    low, first, spare = F.shiftright("meta", 1).bitwiseAND(1), F.col("meta").bitwiseAND(1), F.shiftright("meta", 2)
    rows = members.withColumns({"low": low, "first": first})
    part = Window.partitionBy("node", "low", "first")
    rows = rows.withColumn("cost", F.when(F.col("first") == 1, F.sum("others").over(part)).otherwise(F.col("others")))
    # Units up to and including this row and its equals; the first segment's rows come together and count two.
    dearest = Window.partitionBy("node", "low").orderBy(F.col("cost").desc(), "first")
    units = F.sum(1 - F.col("first")).over(dearest) + 2 * F.max("first").over(dearest)
    probes = units > spare
    by_sig = Window.partitionBy("sig")
    hub = F.min(F.struct((~F.col("probes")).alias("quiet"), F.col("low"), F.col("node"))).over(by_sig)
    return (rows.withColumn("probes", probes).withColumn("hub", hub).where("not hub.quiet")
            .select("sig", "node", F.col("low").cast("int").alias("low"), "probes", F.col("hub.node").alias("hub"), F.col("hub.low").cast("int").alias("hub_low")))


Fit = Callable[[str, str], Column]       # two aliases -> whether their nodes may link, from the columns of ``known``


def allocated_candidates(index: DataFrame, label: DataFrame, known: DataFrame, fit: Fit, held: list[DataFrame]) -> DataFrame:
    """Candidate pairs (a, b) of different components, from a full index and the cheapest allocation per node.

    ``index``: (sig, node, scheme, segment, deleted, low, need), one-deletion rows of every
    segment included. Allocation 1 of a segment finds the nodes with the same part,
    allocation 2 also those whose part differs by one element; allocations of a node add up to
    ``need``. Costs are the numbers of rows found, other components only. The stored index joins ``held``, to be released
    when the pairs are written."""
    sig, same = Window.partitionBy("sig"), Window.partitionBy("sig", "c")

    def found(deleted: bool) -> Column:
        one = F.when(F.col("deleted") == deleted, 1).otherwise(0)
        own = F.when(F.col("low"), 0).otherwise(one)
        return F.when(F.col("low"), F.sum(own).over(sig) - F.sum(own).over(same)).otherwise(F.sum(one).over(sig) - F.sum(one).over(same))
    rows = stored(index.join(label, "node").withColumns({"full_cost": found(False), "deleted_cost": found(True)}), "full-index")
    held.append(rows)
    one = F.sum(F.when(~F.col("deleted"), F.col("full_cost")).otherwise(0))
    two = one + F.sum(F.when(F.col("deleted"), F.col("full_cost")).otherwise(F.col("deleted_cost")))
    per_part = rows.groupBy("node", "scheme", "segment").agg(one.alias("one"), two.alias("two"), F.first("need").alias("need"))
    # Units of allocation by price; the second unit of a part never comes before the first.
    units = per_part.select("node", "scheme", "segment", "need", F.explode(F.array(
        F.struct(F.col("one").alias("price"), F.lit(1).alias("unit")),
        F.struct(F.greatest(F.col("two") - F.col("one"), F.col("one")).alias("price"), F.lit(2).alias("unit")))).alias("u"))
    rank = F.row_number().over(Window.partitionBy("node", "scheme").orderBy("u.price", "u.unit", "segment"))
    chosen = units.withColumn("rank", rank).where("rank <= need").groupBy("node", "scheme", "segment").agg(F.count(F.lit(1)).alias("v"))
    live = rows.where("full_cost > 0 or deleted_cost > 0")
    probes = live.join(chosen, ["node", "scheme", "segment"]).where("v = 2 or not deleted")
    x, y = probes.join(known, "node").alias("x"), live.join(known, "node").alias("y")
    fits = fit("x", "y") & (F.col("x.sig") == F.col("y.sig")) & (F.col("x.c") != F.col("y.c")) & ~(F.col("x.deleted") & F.col("y.deleted")) & ~(F.col("x.low") & F.col("y.low")) & ((F.col("x.v") == 2) | ~F.col("y.deleted"))
    return x.join(y, fits).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def star_candidates(members: DataFrame, label: DataFrame, salt: int) -> DataFrame:
    """Candidate pairs (a, b) that may join components: in every signature one node of each component against one hub.

    Node and hub are drawn by a salted hash among those that probe, so another round tries others. At most one pair
    per row, two low rows never; hubs are minima of aggregates, so a signature that very many nodes share is never gathered."""
    low = F.col("low") if "low" in members.columns else F.lit(0)
    c = F.coalesce(F.col("component"), F.col("node"))
    reps = (members.join(label, "node", "left").groupBy("sig", c.alias("c"))
            .agg(F.min(F.struct((~F.col("probes")).alias("quiet"), low.alias("low"), F.xxhash64("node", F.lit(salt)).alias("drawn"), F.col("node"))).alias("r")))
    hubs = (reps.groupBy("sig").agg(F.min(F.struct(F.col("r.quiet"), F.col("r.low"), F.xxhash64("c", F.lit(salt)).alias("drawn"), F.col("r.node"))).alias("hub"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and not hub.quiet").select("sig", F.col("hub.node").alias("hub"), F.col("hub.low").alias("hub_low")))
    return (reps.join(hubs, "sig").where("r.node <> hub and r.low + hub_low < 2")
            .select(F.least("hub", "r.node").alias("a"), F.greatest("hub", "r.node").alias("b")).distinct())


def resolve(rows: DataFrame, traits: Callable[[DataFrame], DataFrame], fit: Fit, verify: Callable[[DataFrame, DataFrame], DataFrame],
            full_index: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None, fine: Fit | None = None) -> DataFrame:
    """Verified links (a, b), stored, that connect every pair of nodes that shares a signature and verifies.

    ``rows``: (sig, node, meta), see :func:`probing`. ``traits`` gives (node, n, short columns) of
    nodes, stored; pairs whose traits do not ``fit`` cannot link and are left out inside the candidate
    joins, those that do not pass ``fine`` (columns q...) right after. ``verify(pairs, known)`` returns the pairs
    that link, stored. Star rounds come first: round one tests each node against its signature's hub, the next ones a node of each
    component that shares a signature with another (:func:`star_candidates`), until a round joins less than one in ``STAR_GAIN``
    of them. A signature that many copies share, and a family that links, costs about one pair per node that way; nodes
    that this connects need no further tests among themselves.

    What is still apart is searched whole: nodes find others by their own
    signatures, if that is at most ``PLAIN_COST`` rows or ``PLAIN_SIZES`` times the node's size ``n`` (about the
    price of its full index): a number linear in the input. Pairs of two more expensive nodes
    come from ``allocated_candidates`` (``full_index`` returns the index and a stored table to release after it is read; without one,
    from their signatures too). Every candidate pair that links ends in one component."""
    shared = stored(shared_signatures(rows), "shared")
    sweep(shared.sparkSession)                 # the largest shuffle of all goes before the next ones come
    members = stored(probing(shared), "members")
    release(shared)
    known = traits(members.select("node").distinct())
    narrow = known.select(*[c for c, kind in known.dtypes if kind != "binary"])
    short = narrow.select(*[c for c in narrow.columns if not c.startswith("q")])

    def fitting(pairs: DataFrame) -> DataFrame:
        both = fit("x", "y") & fine("x", "y") if fine else fit("x", "y")
        return (pairs.join(narrow.alias("x"), F.col("a") == F.col("x.node"))
                .join(narrow.alias("y"), (F.col("b") == F.col("y.node")) & both).select("a", "b"))

    star = members.where("node <> hub and low + hub_low < 2").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    tested = stored(fitting(star), "pairs")
    links = verify(tested, known)
    label = components(links)
    for salt in range(1, STAR_ROUNDS):
        pairs = stored(fitting(star_candidates(members, label, salt).join(tested, ["a", "b"], "left_anti")), "pairs")
        new = verify(pairs, known)
        tested, old = stored(tested.union(pairs), "tested"), (tested, pairs)
        release(*old)
        gained = new.count()
        if gained:
            links, old = stored(links.union(new), "links"), (links, new)
            release(*old, label)
            label = components(links)
        if gained * STAR_GAIN < tested.count():
            break
    sig, same = Window.partitionBy("sig"), Window.partitionBy("sig", "c")
    rest = (members.join(label, "node", "left").withColumn("c", F.coalesce("component", "node"))
            .withColumn("others", F.when(F.col("low") == 1, F.sum(1 - F.col("low")).over(sig) - F.sum(1 - F.col("low")).over(same))
                        .otherwise(F.count(F.lit(1)).over(sig) - F.count(F.lit(1)).over(same))).where("others > 0"))
    rest = stored(rest.select("sig", "node", "low", "probes", "c", "others"), "rest")
    release(members)
    cost = rest.groupBy("node").agg(F.sum(F.when(F.col("probes"), F.col("others")).otherwise(0)).alias("cost"))
    plain = (F.col("cost") <= F.greatest(F.lit(PLAIN_COST), PLAIN_SIZES * F.col("n"))).alias("plain")
    judged = stored(cost.join(short, "node").select("node", plain, *[c for c in short.columns if c != "node"]), "judged")
    open_ = rest.join(judged, "node")
    asks = F.col("probes") & F.col("plain") if full_index else F.col("probes")
    open_ = open_.withColumn("asks", asks)
    x, y = open_.where("asks").alias("x"), open_.alias("y")
    once = ~F.col("y.asks") | (F.col("x.node") < F.col("y.node"))       # where both ask, one of them does
    pairs = (x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.c") != F.col("y.c")) & (F.col("x.low") + F.col("y.low") < 2) & once & fit("x", "y"))
             .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    held = []
    if full_index is not None:
        dear = stored(rest.join(judged.where("not plain").select("node"), "node", "left_semi").select("node", "c").distinct(), "dear")
        held.append(dear)
        if not dear.isEmpty():
            index, sets = full_index(dear.select("node"))
            pairs = pairs.union(allocated_candidates(index, dear, short, fit, held)).distinct()
            release(sets)
    pairs = pairs.join(tested, ["a", "b"], "left_anti")
    wanted = stored(fitting(pairs) if fine else pairs, "pairs")
    release(rest, judged, tested, *held)
    more = verify(wanted, known)
    out = stored(links.union(more), "links")
    release(wanted, more, links, known, label)
    return out
