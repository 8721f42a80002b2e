"""Operator 6: near duplicates by one-permutation MinHash, with links confirmed on full shingle sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.components import components
from marlstone.llm.texts import map_texts, mix
from marlstone.workspace import written

WORDS = 5
PERCENT = 75
#: Bins of a signature and bins of a band. 32 bands of 4 miss a pair of similarity 0.75 with probability 0.00001.
BINS, ROWS = 128, 4
#: Members of a group that one task compares in its memory at most, and their shingles; larger groups are split by their differences first.
HELD_MEMBERS, HELD_ITEMS = 512, 4_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A-Z become a-z; tab, line feed, vertical tab, form feed and carriage return become spaces.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256)], dtype=np.uint8)


def powers(base: int, size: int) -> np.ndarray:
    """1, base, base² ... modulo 2^64."""
    steps = np.full(size, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def shingle_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts, and where each text's begin (one entry more). Words are runs of bytes without white space."""
    raw = [t.encode() if t else b"" for t in texts]
    # a space after each text keeps words apart
    data = _FOLD[np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)]
    ends = np.cumsum([len(r) + 1 for r in raw])
    word = data != 32
    starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    stops = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
    size = len(data)
    ups = powers(_BASE, size)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * ups, out=sums[1:])
    words = mix((sums[stops] - sums[starts]) * powers(_INVERSE, size)[starts])
    first = np.concatenate([[0], np.searchsorted(starts, ends)])  # first word of each text
    count = np.diff(first)
    made = np.maximum(count - WORDS + 1, np.minimum(count, 1))
    begins = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(begins[-1]) - np.repeat(begins[:-1], made) + np.repeat(first[:-1], made)
    long = np.minimum(np.repeat(count, made), WORDS)
    hashes = long.astype(np.uint64)
    for i in range(WORDS):
        part = words[np.minimum(at + i, max(len(words) - 1, 0))] if len(words) else words
        hashes = np.where(i < long, mix(hashes * np.uint64(_BASE) + part), hashes)
    return hashes, begins


def distinct_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, begins = shingle_hashes(texts)
    return [np.unique(hashes[a:b]) for a, b in zip(begins, begins[1:], strict=False)]


def _detours(bins: int, tries: int) -> np.ndarray:
    """Where an empty bin looks at its first, second ... try: the same for all documents."""
    return (mix(np.arange(bins * tries, dtype=np.uint64) + np.uint64(1 << 40)) % np.uint64(bins)).astype(np.int64).reshape(tries, bins)


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One hash function deals the shingles of a set to bins, and a bin keeps its smallest one. An empty bin copies the
    bin that a fixed random walk of its own reaches first (optimal densification), so bins of two sets agree with the
    sets' similarity, however small the sets are. Sets must not be empty.
    """
    shift = np.uint64(64 - bins.bit_length() + 1)
    table = np.zeros((len(sets), bins), dtype=np.uint64)
    full = np.zeros((len(sets), bins), dtype=bool)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    cell = owner * bins + (values >> shift).astype(np.int64)
    leads = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, np.int64)
    table.ravel()[cell[leads]] = values[leads]  # sets are sorted: the first of a bin is its smallest
    full.ravel()[cell[leads]] = True
    row, column = np.nonzero(~full)
    round_, walk = 0, _detours(bins, 64)
    while len(row):
        if round_ == len(walk):
            walk = _detours(bins, 4 * len(walk))
        source = walk[round_][column]
        there = full[row, source]
        table[row[there], column[there]] = table[row[there], source[there]]
        row, column, round_ = row[~there], column[~there], round_ + 1
    return table


def band_keys(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash per band of ``rows`` bins; the band's number is part of it."""
    bands = table.reshape(len(table), -1, rows)
    keys = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2])
    for i in range(rows):
        keys = mix(keys * np.uint64(_BASE) + bands[:, :, i])
    return keys


def signed(df: DataFrame, key: str, text: str) -> DataFrame:
    """id, n_shingles, set_low and set_high (equal for equal sets), and band keys (none for an empty set)."""

    def factory():
        def work(texts):
            sets = distinct_sets(texts)
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(signatures([sets[i] for i in some])).view(np.int64) if some else []
            bands: list = [None] * len(sets)
            for i, k in zip(some, keys, strict=True):
                bands[i] = k
            low = [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            high = [int(mix(s ^ np.uint64(_BASE)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            return [len(s) for s in sets], low, high, bands

        return work

    longs = [T.StructField(n, T.LongType()) for n in ("n_shingles", "set_low", "set_high")]
    named = df.select(df[key].cast("long").alias("id"), df[text].alias("text"))
    return map_texts(named, ["id"], "text", [*longs, T.StructField("bands", T.ArrayType(T.LongType()))], factory)


def shingle_sets(df: DataFrame) -> DataFrame:
    """id and the shingles of ``df`` (id, text) as 32-bit hashes."""

    def factory():
        return lambda texts: ([np.unique((s >> np.uint64(32)).astype(np.uint32)).view(np.int32) for s in distinct_sets(texts)],)

    return map_texts(df, ["id"], "text", [T.StructField("shingles", T.ArrayType(T.IntegerType()))], factory)


def similar_sizes(n: Column, m: Column) -> Column:
    """No pair beyond this can be linked: the intersection is at most the smaller set, the union at least the larger."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets have 100 * intersection >= 75 * union."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("one"), F.col("n").alias("n"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("two"), F.col("n").alias("m"))
    both = F.size(F.array_intersect("one", "two"))
    return pairs.join(one, "a").join(two, "b").withColumn("both", both).filter(100 * F.col("both") >= PERCENT * (F.col("n") + F.col("m") - F.col("both"))).select("a", "b")


def compared(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """Confirmed links among the distinct ``pairs`` (node, centre) that are in different components and of sizes that allow a link.

    ``nodes`` (id, n, label) has the size and the component of every node.
    """
    one = nodes.select(F.col("id").alias("node"), F.col("n").alias("n"), F.col("label").alias("l"))
    two = nodes.select(F.col("id").alias("centre"), F.col("n").alias("m"), F.col("label").alias("k"))
    met = pairs.select("node", "centre").join(one, "node").join(two, "centre").filter((F.col("l") != F.col("k")) & similar_sizes(F.col("n"), F.col("m")))
    return written(confirmed(written(met.select(*pair(F.col("node"), F.col("centre"))).distinct(), f"{label}-pairs"), sets), f"{label}-links")


def relabelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` after ``links`` (node ids a, b) joined their components. Links are taken between components, one for each pair of them."""
    if links.isEmpty():
        return nodes
    ends = nodes.select("id", "label")
    between = links.join(ends.toDF("a", "la"), "a").join(ends.toDF("b", "lb"), "b").select(*pair(F.col("la"), F.col("lb"))).filter("a <> b").distinct()
    found = components(between)
    return written(nodes.join(found.toDF("label", "low"), "label", "left").select("id", "n", F.coalesce("low", "label").alias("label")), "nodes")


def mixed(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``groups`` (g, node, ...) whose group still has members of several components. Of groups with the same members one stays."""
    named = groups.join(nodes.select(F.col("id").alias("node"), "label"), "node")
    members = F.struct(F.bit_xor(F.xxhash64("node")).alias("mixed"), F.count(F.lit(1)).alias("size"), F.min("node").alias("first")).alias("members")
    split = named.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high"), members).filter("low <> high")
    chosen = split.groupBy("members").agg(F.min("g").alias("g")).select("g")
    return written(groups.join(chosen, "g"), "groups")


def common_items(sets: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """How many items any two sets have in common, as a matrix; ``width`` items are looked at at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    distinct, item = np.unique(np.concatenate([*sets, np.empty(0, np.int32)]), return_inverse=True)
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for start in range(0, len(distinct), width):
        low, high = np.searchsorted(item, (start, start + width))
        holds = np.zeros((len(sets), width), dtype=np.float32)
        holds[owner[low:high], item[low:high] - start] = 1
        both += (holds @ holds.T).astype(np.int64)
    return both


def links_within(rows: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of groups of bounded size. ``rows``: g, node, label, n, items.

    A task holds one group, compares members of different components on their full sets, and gives out a link only where two components
    become one; so a group of m members has at most m - 1 rows.
    """

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        nodes, sizes, label = (group[c].to_numpy(copy=True) for c in ("node", "n", "label"))
        both = common_items([np.asarray(x) for x in group["items"]])
        linked = 100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both)
        found = []
        for i, j in np.argwhere(np.triu(linked, 1)).tolist():
            if label[i] != label[j]:
                found.append((int(nodes[i]), int(nodes[j])))
                label[label == label[j]] = label[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("g").applyInPandas(compare, "a long, b long")


def split_by_differences(rows: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stars and smaller groups for the members ``rows`` (g, node, n, items) of groups: pairs (node, centre), the groups (g, node, parent)
    that the other links are in, and the differences (parent, node, n, items) by which those can be split again. ``nodes`` has the components.

    A group has a core: the items that more than half of its members hold. A member is known by its difference from the core, the
    items it has besides and those of the core that it lacks. Differences differ where the sets do, so A and B have a link if their differences
    differ in at most (n of A + n of B) / 7 places. If the differences have nothing in common, their sizes add up to no more
    than that. Then the member with the most room, n / 7 less the size of its difference, has a link to both: it is the centre of the
    group's star, and nobody else needs to be compared for such links. All others have a difference in common. Members that share one are a
    smaller group; as at most half of a group share one, groups halve from level to level.

    Of a difference only the rarest items count. Let a member's lack be the size of its difference less n / 7. Two linked differences have at least the mean of
    their lacks in common, so the one of smaller lack has a common item among its rarest n / 7 + 1 (it asks there), and the other one among
    as many as a link could lack at all, a third of its n, and one.
    """
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    held = rows.select("g", F.explode("items").alias("item")).groupBy("g", "item").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").join(sizes, "g")
    in_core = 2 * F.col("held") > F.col("size")
    cores = held.filter(in_core).groupBy("g").agg(F.collect_list("item").alias("core"))
    core = F.coalesce("core", F.array().cast("array<int>"))
    different = F.concat(F.array_except("items", core), F.array_except(core, F.col("items")))
    known = written(rows.join(cores, "g", "left").select("g", "node", "n", different.alias("items")), "differences")
    room = F.struct((F.col("n") - 7 * F.size("items")).alias("room"), (-F.col("node")).alias("minus"))
    centres = known.groupBy("g").agg((-F.max(room)["minus"]).alias("centre"))
    stars = known.select("g", "node").join(centres, "g").filter("node <> centre")
    rest = known.join(centres, "g").filter("node <> centre").join(nodes.select(F.col("id").alias("node"), "label"), "node")
    rest = rest.select("g", "node", "label", "n", F.size("items").alias("size"), F.explode("items").alias("item"))
    # only a difference that members of several components share can lead to a link that matters
    often = rest.groupBy("g", "item").agg(F.count(F.lit(1)).alias("often"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    shared = rest.drop("label").join(often.select("g", "item", "often"), ["g", "item"])
    rare = shared.groupBy("g", "node", "n", "size").agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("rare"))
    # the others come first in the order, as the rarest ones
    alone = F.col("size") - F.size("rare")
    enough = F.greatest(F.lit(0), F.floor(F.col("n") / 3).cast("int") + 1 - alone)
    placed = rare.select("g", "node", F.floor(F.col("n") / 7).cast("int").alias("first"), alone.alias("alone"), F.posexplode(F.slice("rare", F.lit(1), enough)).alias("place", "c"))
    smaller = placed.select(F.xxhash64("g", "c.item").alias("g"), "node", F.col("g").alias("parent"), (F.col("alone") + F.col("place") <= F.col("first")).alias("asks"))
    asked = smaller.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.bool_or("asks").alias("any")).filter("size > 1 AND any").select("g")
    return stars, written(smaller.join(asked, "g").select("g", "node", "parent"), "smaller"), known.withColumnRenamed("g", "parent")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable over links) and kept, for every document.

    Words: A-Z lower-cased, split at ASCII white space. A document's set: its distinct shingles of five words; with fewer
    words, all of them as one. Null, empty and blank texts have empty sets and are linked with nothing.

    1. Documents of one set become a class, named by its smallest id; only classes go on.
    2. Classes that share a band key share a bucket. A bucket's centre is the class that shares most buckets with others (the text that
       copies were made from), so all buckets of a group of copies have one centre. A class is compared with its best centre
       first, and with the centres of its other buckets only if they are in other components by then.
    3. Classes of one centre that are still in different components are a group. A group of at most HELD_MEMBERS (and HELD_ITEMS) is compared in the memory of one task.
       The links of a larger one are those that a star from the member next to the group's core finds, and those between members that share a rare
       difference from that core (``split_by_differences``). Members that share one are a group of at most half the size, and so on until
       all groups are of one component.

    Every linked pair that shares a bucket ends in one component. Pairs whose sizes rule a link out are left out, all others are
    confirmed on full sets. What is written grows with the members, never with pairs of a group.

    Rows of equal id count as one node; rows of null id belong to no group (component_id null, kept). Empty tables give
    no rows. Very long texts are one set of many shingles. Texts of classes in shared buckets are read again and shuffled; no other text is.
    """
    documents = df.select(df[key].cast("long").alias("id"), df[text].cast("string").alias("text"))
    signs = written(signed(documents, "id", "text"), "signatures")
    usable = signs.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = usable.groupBy("set_low", "set_high").agg(F.min("id").alias("node"), F.max("n_shingles").alias("n"), F.min_by("bands", "id").alias("bands"))
    classes = written(classes, "classes")
    dealt = classes.select(F.explode("bands").alias("bucket"), "node", "n")
    crowded = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(dealt.join(crowded, "bucket"), "members")
    mates = written(members.groupBy("node").agg(F.sum(F.col("size") - 1).alias("mates"), F.max("n").alias("n")), "mates")
    chosen = mates.select(F.col("node").alias("id"), "n")
    sets = written(shingle_sets(documents.join(chosen.select("id"), "id", "left_semi")).join(chosen, "id"), "sets")
    by_mates = F.struct("mates", (-F.col("node")).alias("minus"))
    heads = members.join(mates.select("node", "mates"), "node").groupBy("bucket").agg(F.max(by_mates).alias("most"))
    centred = members.select("bucket", "node").join(heads, "bucket").groupBy("node", (-F.col("most.minus")).alias("centre")).agg(F.max("most.mates").alias("mates"))
    centred = written(centred.filter("node <> centre"), "centred")
    best = centred.groupBy("node").agg((-F.max(F.struct("mates", (-F.col("centre")).alias("minus")))["minus"]).alias("centre"))
    nodes = chosen.withColumn("label", F.col("id"))
    nodes = relabelled(nodes, compared(best, nodes, sets, "best"))
    nodes = relabelled(nodes, compared(centred, nodes, sets, "other"))
    groups = mixed(centred.select(F.col("centre").alias("g"), "node"), nodes)
    whole = sets.select(F.col("id").alias("node"), "n", F.col("shingles").alias("items"))
    known, keys = whole.withColumn("n", F.size("items").cast("long")), ["node"]
    while not groups.isEmpty():
        sizes = groups.join(chosen.select(F.col("id").alias("node"), "n"), "node").groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"))
        small = (F.col("size") <= HELD_MEMBERS) & (F.col("n") <= HELD_ITEMS)
        held = groups.join(sizes.filter(small), "g").select("g", "node")
        links = links_within(held.join(nodes.select(F.col("id").alias("node"), "label"), "node").join(whole, "node"))
        nodes = relabelled(nodes, written(links, "group-links"))
        large = mixed(groups.join(sizes.filter(~small).select("g"), "g"), nodes)
        if large.isEmpty():
            break
        rows = written(large.join(known, keys).select("g", "node", "n", "items"), "rows")
        stars, groups, known = split_by_differences(rows, nodes)
        keys = ["parent", "node"]
        nodes = relabelled(nodes, compared(stars, nodes, sets, "level"))
        # groups have members in common: their first ones are centres of a star each
        groups = mixed(groups, nodes)
        first = groups.join(groups.groupBy("g").agg(F.min("node").alias("centre")), "g").filter("node <> centre")
        nodes = relabelled(nodes, compared(first, nodes, sets, "first"))
        groups = mixed(groups, nodes)
    labels = nodes.select(F.col("id").alias("node"), "label")
    found = classes.join(labels, "node", "left").select("set_low", "set_high", F.coalesce("label", "node").alias("label"))
    grouped = signs.join(found, ["set_low", "set_high"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("label")).otherwise(F.col("id"))
    return grouped.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
