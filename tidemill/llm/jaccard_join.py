"""N-gram Jaccard join by grouped prefix filtering.

Every document is the set of its distinct word shingles, as 64-bit hashes. A similar pair must share a token among the
first ``n - ceil(t * n) + 1`` of both sets under any one global order. The order here: tokens with a low hash that few sets
have, those with a low hash that many have, then all others by hash; a set's head holds all that can stand in its prefix.
Equal sets are collapsed first; sets with the same size and the same prefix (without tokens that no other head has) form one group, and
only groups meet in the token lists. Group pairs are filtered by size, by position and by parity bitmaps (with the spread of
a group's members around its leader), expanded to members, filtered by the members' own bitmaps and verified on whole sets.

Only connections are asked for, so pairs that are already connected are never listed: a first round links every group to
leaders of its lists, and every member to the leader of its group. Afterwards a list matters only if it still holds
different components. While those lists could form very many pairs, sets of different components that stand side by side in
a shuffled list are linked. At last all pairs with a side outside the largest component of a list are formed. All those are
verified, so no link between two components is lost, however large a group of copies is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import textkit
from tidemill.llm.components import components, contract, labels
from tidemill.llm.stage import drop, settle

#: Low tokens that so many sets have stand behind the other low ones. It only moves cost; any value gives the same result.
FREQUENT = 64
#: 64-bit words of a set's parity bitmap: two sets differ in as many elements at least as their bitmaps differ in bits. Larger sets have
#: a wide one as well, of two bits an element at least.
PARITY = 8
#: Partners that a set tries in each round but the last, which tries all that are left.
LEADERS = 2
#: Members of a group that stand for its leader; the one that is nearest to the others leads.
CANDIDATES = 16
#: Pairs an entry of a list that may be formed at last, on average; beyond it, neighbours are linked first. It only moves cost.
MANY = 2_000
#: A set's first tokens that its entries carry in the last round: two sets that have one of them in common meet in the first list they share alone. It only moves cost.
FIRST = 4
#: Entries of a list that are put in order at once.
BLOCK = 5_000
_NONE = 2**63 - 1
_SET = "id long, n int, k1 long, k2 long, low int, head array<long>, bits array<long>, wide array<long>"
_WHOLE = "node long, n int, tokens array<long>"


def _prefix_size(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return n - (percent * n + 99) // 100 + 1


def _low_limit(percent: int) -> int:
    """Tokens below are low: the prefix's share of all hashes and two fifths more, as frequent tokens will be put behind."""
    return int(2**64 * min(1.0, (100 - percent) / 100 * 1.4)) - 2**63 - 1


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each block of documents, the sorted distinct shingle hashes of each."""
    for at, data, offsets in textkit.blocks(texts, 1 << 19):
        starts, ends, first = textkit.words(data, offsets)
        hashes, limits = textkit.shingles(textkit.span_hashes(data, starts, ends, lower=True), first, k)
        hashes = hashes.view(np.int64)
        out = []
        for i in range(len(limits) - 1):
            own = np.sort(hashes[limits[i] : limits[i + 1]])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
        yield at, out


def _lists(parts: list[np.ndarray]) -> pa.Array:
    limits = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(limits), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def _parity(x: np.ndarray, words: int) -> np.ndarray:
    return np.packbits(np.bincount((x.view(np.uint64) >> np.uint64(9) & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1).view(np.int64)


def _heads(k: int, percent: int):
    """Each document's set: its size, two hashes of the whole, its low tokens' number, its head, and the parity bitmaps."""
    limit = _low_limit(percent)

    def one(x: np.ndarray) -> tuple:
        if not len(x):
            return 0, 0, 0, x, np.zeros(PARITY, np.int64), None
        mixed = textkit._mix(x.view(np.uint64))
        low = int(np.searchsorted(x, limit))
        words = 1 << max(0, (len(x) - 1) // 32).bit_length()
        return np.add.reduce(mixed, dtype=np.uint64), np.bitwise_xor.reduce(mixed), low, x[: max(low, _prefix_size(len(x), percent))], _parity(x, PARITY), _parity(x, words) if words > PARITY else None

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for at, sets in _sets(batch.column("text"), k):
                k1, k2, low, head, bits, wide = zip(*map(one, sets), strict=True)
                sums = (pa.array(np.array(c, np.uint64).view(np.int64)) for c in (k1, k2))
                sizes = pa.array(np.array([len(x) for x in sets], np.int32))
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(sets)), sizes, *sums, pa.array(low, pa.int32()), _lists(list(head)), _lists(list(bits)), pa.array(wide, pa.list_(pa.int64()))], ["id", "n", "k1", "k2", "low", "head", "bits", "wide"])

    return run


def _wholes(k: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for at, sets in _sets(batch.column("text"), k):
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(sets)), pa.array(np.array([len(x) for x in sets], np.int32)), _lists(sets)], ["node", "n", "tokens"])

    return run


class _Verifier:
    """Verifies pairs (a, b) of nodes: on their wide bitmaps (of ``members``), then on their whole sets, which are kept for later rounds."""

    def __init__(self, docs: DataFrame, members: DataFrame, k: int, percent: int):
        self.docs, self.members, self.k, self.percent, self.held = docs, members, k, percent, []

    def __call__(self, pairs: DataFrame) -> DataFrame:
        sides = [self.members.select(F.col("node").alias(c), F.struct("n", "wide").alias(name)) for c, name in (("a", "x"), ("b", "y"))]
        near = settle(pairs.filter("a != b").join(sides[0], "a").join(sides[1], "b").filter(_may_overlap(self.percent, differ=_WIDE)).select("a", "b").distinct())
        nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
        for known in self.held:
            nodes = nodes.join(known.select("node"), "node", "left_anti")
        nodes = nodes.withColumnRenamed("node", "id")
        # The texts are dealt by id in the first round, at every size; later ones ask for few.
        nodes = nodes if self.held else nodes.hint("merge")
        self.held.append(settle(self.docs.join(nodes, "id").mapInArrow(_wholes(self.k), _WHOLE)))
        wholes = self.held[0]
        for more in self.held[1:]:
            wholes = wholes.union(more)
        sides = [wholes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("tokens").alias(f"t{c}")) for c in "ab"]
        both = F.size(F.array_intersect("ta", "tb"))
        enough = (100 + self.percent) * both >= self.percent * (F.col("na") + F.col("nb"))
        links = settle(near.join(sides[0], "a").join(sides[1], "b").filter(enough).select("a", "b"))
        drop(near)
        return links

    def close(self) -> None:
        for known in self.held:
            drop(known)


def _can_match(percent: int) -> F.Column:
    """Size and position filters for two entries x and y of one token's list."""
    least = f"({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent}"
    return F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and least(x.n - x.pos, y.n - y.pos) >= {least}")


_DIFFER = "(" + " + ".join(f"bit_count(x.bits[{i}] ^ y.bits[{i}])" for i in range(PARITY)) + ")"


#: The bits in which wide bitmaps differ; the larger one is folded to the size of the other. 0 where there is nothing to compare.
_FOLDED = """aggregate(sequence(0, size({s}.wide) - 1), 0, (d, i) -> d + bit_count({s}.wide[i] ^ {l}.wide[i] ^ if(size({l}.wide) > size({s}.wide), {l}.wide[i + size({s}.wide)], 0L)))"""
_WIDE = f"(case when x.wide is null or y.wide is null then 0 when size(x.wide) <= size(y.wide) and size(y.wide) <= 2 * size(x.wide) then {_FOLDED.format(s='x', l='y')} when size(x.wide) <= 2 * size(y.wide) then {_FOLDED.format(s='y', l='x')} else 0 end)"


def _may_overlap(percent: int, spread: str = "0", differ: str = _DIFFER) -> F.Column:
    """The bound on the overlap that the bitmaps of x and y leave; members of a group may be nearer by the spreads."""
    return F.expr(f"{100 + percent} * (x.n + y.n - {differ} + {spread}) >= {2 * percent} * (x.n + y.n)")


def _best(tries: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b, shared), the most promising LEADERS for each a."""
    sides = [members.select(F.col("node").alias(c), F.struct("n", "bits").alias(name)) for c, name in (("a", "x"), ("b", "y"))]
    tries = tries.join(sides[0], "a").join(sides[1], "b").filter(_may_overlap(percent)).select("a", "b", "shared", F.expr(_DIFFER).alias("differ"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "differ", "b"))
    return tries.withColumn("r", rank).filter(F.col("r") <= LEADERS).select("a", "b")


def _regrouped(several: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of groups as (node, gid, lead): a group whose members are in several components is split into its members."""
    own = several.select("node", "gid").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sides = own.groupBy("gid").agg((F.min("comp") == F.max("comp")).alias("one"))
    return own.join(sides, "gid").select("node", F.when(F.col("one"), F.col("gid")).otherwise(F.col("node")).alias("gid"), F.col("gid").alias("lead"))


def _divided(lists: DataFrame, several: DataFrame, comps: DataFrame) -> DataFrame:
    """The entries of lists that hold several components, with their own (comp), the largest of the list (main) and the entries of the list (often)."""
    heads = _regrouped(several, comps).select(F.col("gid").alias("part"), F.col("lead").alias("node")).distinct()
    placed = lists.select("token", "node", "n", "pos").join(heads, "node", "left").withColumn("node", F.coalesce("part", "node")).drop("part")
    placed = placed.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sides = placed.groupBy("token", "comp").agg(F.count("*").alias("size"))
    main = sides.groupBy("token").agg(F.max(F.struct("size", "comp")).getField("comp").alias("main"), F.count("*").alias("sides"), F.sum("size").alias("often"))
    return placed.join(main.filter("sides > 1").drop("sides"), "token")


def _neighbours(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of different components that stand side by side in a list: each list in an order of its own, another one each turn; a long list in blocks."""
    block = F.pmod(F.xxhash64("node", F.lit(turn)), F.expr(f"often div {BLOCK} + 1"))
    order = Window.partitionBy("token", block).orderBy(F.xxhash64("node", "token", F.lit(turn)), "node")
    placed = placed.select("token", "node", "often", F.struct("node", "n", "pos", "comp").alias("x"))
    near = placed.withColumn("y", F.lag("x").over(order)).filter("x.comp != y.comp").filter(_can_match(percent))
    return near.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count("*").alias("shared"))


def _work(placed: DataFrame) -> tuple[int, int]:
    """Pairs that the lists could form, at most, and their entries."""
    seen = placed.agg(F.sum(F.expr("if(comp != main, often, 0)")).alias("pairs"), F.count("*").alias("entries")).first()
    return seen.pairs or 0, seen.entries


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """The tokens (token, node, n, pos, often) that stand in prefixes and that several heads have. ``FREQUENT`` is 2 at least."""
    # Sets of one document (rows with one id) are told apart by bits of their hash, beside the number of low tokens.
    mark = F.expr("low + shiftleft(k1 & 1073741823L, 32)").alias("mark")
    tokens = sets.select("node", "n", mark, F.posexplode("head").alias("at", "token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1")
    entries = tokens.join(shared.hint("merge"), "token").withColumn("low", F.expr("int(mark & 4294967295L)"))
    entries = entries.withColumn("late", F.expr(f"int(at < low and often >= {FREQUENT})"))
    own = Window.partitionBy("node", "n", "mark")
    entries = entries.withColumns({"behind": F.sum("late").over(own.orderBy("at")), "lates": F.sum("late").over(own)})
    pos = "case when at >= low then at when late = 1 then low - lates + behind - 1 else at - behind end"
    return entries.withColumn("pos", F.expr(pos)).filter(f"pos < n - ({percent} * n + 99) div 100 + 1").select("token", "node", "n", "pos", "often")


def _live(entries: DataFrame, percent: int) -> DataFrame:
    """The entries of lists in which another one has a size that can match. By the sizes that a list has, not by its entries."""
    entries = settle(entries)
    sizes = entries.groupBy("token", "n").agg(F.count("*").alias("same"))
    by_size = Window.partitionBy("token").orderBy("n")
    sizes = sizes.withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
    met = sizes.filter(f"same > 1 or 100 * below >= {percent} * n or 100 * n >= {percent} * above").select("token", "n")
    out = settle(entries.join(met.hint("merge"), ["token", "n"]))
    drop(entries)
    return out


def _led(members: DataFrame) -> DataFrame:
    """The leader (lead) of each group (gid) of several: of CANDIDATES members by hash, the one whose bitmap is nearest to the others'."""
    rank = F.row_number().over(Window.partitionBy("gid").orderBy(F.xxhash64("node"), "node"))
    some = settle(members.withColumn("r", rank).filter(F.col("r") <= CANDIDATES).select("gid", "node", "bits"))
    apart = some.select("gid", "node", F.struct("bits").alias("x")).join(some.select("gid", F.struct("bits").alias("y")), "gid")
    apart = apart.groupBy("gid", "node").agg(F.sum(F.expr(_DIFFER)).alias("apart"))
    return settle(apart.groupBy("gid").agg(F.min(F.struct("apart", "node")).getField("node").alias("lead")))


def _first_tries(lists: DataFrame, several: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, shared) of a group and a leader of one of its lists: the least by size, and the one of the most members, or whose lists are
    the most common (a text that others are copies of shares all of it)."""
    entry = F.struct("n", "pos", "node")
    common = lists.groupBy("node").agg((F.sum(F.log("often")) / F.max(F.expr(f"n - ({percent} * n + 99) div 100 + 1"))).alias("common"))
    common = common.join(several.groupBy(F.col("gid").alias("node")).agg(F.count("*").alias("many")), "node", "left").withColumn("many", F.coalesce("many", F.lit(1)))
    leaders = lists.join(common, "node").groupBy("token").agg(F.min(entry).alias("p"), F.max(F.struct("many", "common", entry.alias("e"))).getField("e").alias("q"))
    leaders = leaders.select("token", F.explode(F.array_distinct(F.array("p", "q"))).alias("y"))
    tries = lists.select("token", entry.alias("x")).join(leaders.hint("merge"), "token").filter("x.node != y.node").filter(_can_match(percent))
    return tries.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count("*").alias("shared"))


def _first_tokens(placed: DataFrame, members: DataFrame) -> DataFrame:
    """The FIRST tokens (first) that a node has in the lists, in the order that all sets share. None for sets of one document and one size: a node
    has the tokens of all of them."""
    single = members.groupBy("node", "n").agg(F.count("*").alias("sets")).filter("sets = 1").select("node", "n")
    first = placed.groupBy("node", "n").agg(F.expr(f"transform(slice(array_sort(collect_list(struct(pos, token))), 1, {FIRST}), t -> t.token)").alias("first"))
    return first.join(single, ["node", "n"])


def _met(left: DataFrame, percent: int) -> DataFrame:
    """Pairs (ga, gb) of nodes that no filter excludes, of the entries (token, x, minor) of lists; nearly all of them once."""
    # Sets meet in bands of sizes, three times as wide (in the logarithm) as the sizes that can match; one side stands in all bands it can match.
    band = lambda size: F.expr(f"int(floor(ln({size}) / {max(3 * math.log(100 / percent), 0.01)}))")
    spans = F.explode(F.sequence(band(f"x.n * {percent} / 100"), band(f"x.n * 100 / {percent}")))
    minor = left.filter("minor").select("token", "x", spans.alias("band"))
    other = left.select("token", F.col("x").alias("y"), F.col("minor").alias("too"), band("x.n").alias("band"))
    met = minor.join(other, ["token", "band"]).filter("x.node < y.node or not too").filter("x.comp != y.comp")
    met = met.filter(_can_match(percent)).filter(_may_overlap(percent, "x.spread + y.spread"))
    # If any of the first tokens are common, the first list that both stand in is among them.
    met = met.filter("token = coalesce(get(array_intersect(x.first, y.first), 0), token)")
    return met.select(F.col("x.node").alias("ga"), F.col("y.node").alias("gb"))


def _left(placed: DataFrame, members: DataFrame, several: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of members of different components that the lists still hold and no filter excludes."""
    parts = settle(_regrouped(several, comps).join(several.select("node", "bits"), "node").filter("gid = lead").select("gid", "node", "bits"))
    lead = parts.filter("gid = node").select("gid", F.struct("bits").alias("y"))
    spreads = parts.select("gid", F.struct("bits").alias("x")).join(lead, "gid").groupBy(F.col("gid").alias("node")).agg(F.max(F.expr(_DIFFER)).alias("spread"))
    leaders = members.select("node", "n", "bits").join(spreads, "node", "left").join(_first_tokens(placed, members), ["node", "n"], "left")
    entry = F.struct("node", "n", "pos", "comp", "bits", F.coalesce("spread", F.lit(0)).alias("spread"), "first")
    left = settle(placed.join(leaders, ["node", "n"]).select("token", entry.alias("x"), F.expr("comp != main").alias("minor")))
    met = settle(_met(left, percent).distinct())
    drop(left)
    # Group pairs are expanded to members, which are compared by their own bitmaps.
    own = members.select("node", "n", "bits").join(parts.select("node", "gid"), "node", "left")
    own = own.select(F.coalesce("gid", "node").alias("g"), F.struct("node", "n", "bits").alias("x"))
    pairs = met.join(own.withColumnRenamed("g", "ga"), "ga").join(own.select(F.col("g").alias("gb"), F.col("x").alias("y")), "gb")
    out = settle(pairs.filter(_may_overlap(percent)).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    drop(met)
    drop(parts)
    return out


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Join documents on word-shingle similarity and return each one's component.

    Words are runs of characters other than space, tab, newline, vertical tab, form feed and return, with A-Z lower-cased. Two documents
    link when ``100 * |intersection| >= percent * |union|`` of their sets of distinct ``k``-word shingles; fewer words
    make one shingle of the whole sequence.

    Returns ``doc_id``, ``n_shingles`` (long) and ``component_id`` (the least id that links lead to, itself included), one row per
    input row. A null, empty or blank text has no shingles and is linked with nothing. A null id counts as one document behind
    all others and comes back as null. Rows with one id are one document. Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)).alias("id"), F.col(text_col).alias("text"))
    known = settle(docs.mapInArrow(_heads(k, percent), _SET))

    # Equal sets become one, named by its least document.
    sets = known.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min("id").alias("node"), F.min_by(F.struct("low", "head", "bits", "wide"), "id").alias("s"))
    sets = settle(sets.select("k1", "k2", "node", "n", "s.*"))
    entries = _live(_prefixes(sets, percent), percent)
    # Sets of one size that stand at the same places of the same lists form a group, led by its least set.
    groups = entries.groupBy("node", "n").agg(F.count("*").alias("tokens"), F.expr("sum(xxhash64(token, pos) >> 20)").alias("s"), F.expr("bit_xor(xxhash64(pos, token))").alias("x"))
    groups = settle(groups)
    same = ["n", "s", "x", "tokens"]
    led = groups.groupBy(*same).agg(F.min("node").alias("gid"), F.count("*").alias("many"))
    members = settle(groups.join(led, same).select("node", "n", "gid", "many").join(sets.select("node", "n", "bits", "wide").hint("merge"), ["node", "n"]))
    drop(groups)
    several = members.filter("many > 1")
    several = settle(several.join(_led(several), "gid").select("node", F.col("lead").alias("gid"), "n", "bits"))
    lists = entries.join(several.filter("node != gid").select("node", "n"), ["node", "n"], "left_anti")
    lists = settle(lists.select("token", "node", "n", "pos", "often"))
    drop(entries)

    verify = _Verifier(docs, members, k, percent)
    tries = settle(_best(_first_tries(lists, several, percent), members, percent).union(several.filter("node != gid").select("node", "gid")))
    links = contract(verify(tries), 2)
    drop(tries)

    placed = settle(_divided(lists, several, labels(links)))
    # While much is left: neighbours in the lists, as long as a round takes off a tenth of it.
    (work, entries), before, turn = _work(placed), None, 0
    while work > MANY * entries and (before is None or 10 * work <= 9 * before):
        before, turn = work, turn + 1
        tries = settle(_best(_neighbours(placed, turn, percent), members, percent))
        links = contract(links.union(verify(tries)), 2)
        drop(tries)
        drop(placed)
        placed = settle(_divided(lists, several, labels(links)))
        work, entries = _work(placed)

    # Last round: all that the lists still hold of different components.
    pairs = _left(placed, members, several, labels(links), percent)
    comps = settle(components(links.union(verify(pairs))))
    for table in (placed, pairs, lists, members, several):
        drop(table)
    verify.close()

    found = sets.select("k1", "k2", "n", "node").join(comps, "node", "left").select("k1", "k2", "n", F.coalesce("comp", "node").alias("comp"))
    out = known.select("id", "n", "k1", "k2").join(found, ["k1", "k2", "n"], "left").select("id", "n", F.coalesce("comp", "id").alias("comp"))
    # Rows with one id share its least component.
    least = out.groupBy("id").agg(F.min("comp").alias("comp"))
    out = out.select("id", "n").join(least, "id")
    back = lambda c: F.when(F.col(c) != _NONE, F.col(c))
    return out.select(back("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), back("comp").alias("component_id"))
