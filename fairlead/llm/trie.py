"""Conversation prefix trie by burst tries: containers of suffixes under trie heads.

Every distinct sequence of turns is a string of turn ids. All strings begin under the root, in
one container per first turn id. A container holds the rest of its strings; one that holds too
many turns bursts: the turns of one of its strings become trie nodes, and each other string goes
to the container of the place where it leaves them and of its next turn id there. What remains
is sorted and swept into nodes, container by container. The sums over subtrees then rise from
the containers through the paths of the bursts to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.llm.common import arrow_rows, partitions
from fairlead.session import stored

# A container of more turns bursts.
BURST = 4096
# Strings of a bursting container that are compared with one copy of its path.
SPREAD = 4096
# Running sums go along stretches of so many places, and then over the stretches.
STRETCH = 4096
MODULUS, LONGEST = 5, 9
NODE = "home long, top long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end_seq long"


def placed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn id (t1, t2) and text bytes of every turn, by turn number.

    Null numbers come first, equal numbers follow each other by their turn ids. The rows are
    ranged over tasks by conversation, number and id, so a conversation of any length is spread;
    places add up over the tasks that share a conversation, two rows a task at most.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.octet_length(text).cast("long").alias("size"),
    )
    order = ["conv_id", "turn", "t1", "t2"]
    ranged = slim.repartitionByRange(partitions(turns.sparkSession), *order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranged-turns")
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    cut = counts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts"))
    cut = cut.filter(F.size("parts") > 1)
    cut = cut.select("conv_id", F.posexplode("parts").alias("k", "at"), "parts").select(
        F.col("conv_id").alias("_conv"),
        F.col("at.part").alias("_part"),
        F.aggregate(F.slice("parts", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias("before"),
    )
    nth = F.row_number().over(W.partitionBy("conv_id", "part").orderBy(*order[1:]))
    rows = ranged.withColumn("nth", nth)
    # Only the conversations at the ends of a task's range are in several.
    rows = rows.join(F.broadcast(cut), (F.col("conv_id") == F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    place = F.col("nth") + F.coalesce("before", F.lit(0))
    return rows.select("conv_id", place.cast("long").alias("place"), "t1", "t2", "size")


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place, t1, t2, size) and conversations (conv_id, length), as rebuilt.

    Conversation c begins with the first h turns of conversation c - c % 5, as far as there
    are any, and goes on with its own after its first h; h is crc32 of its decimal id % 9.
    """
    placed = stored(placed_turns(turns), "placed-turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LONGEST
    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % MODULUS, "h": h})
    bases = convs.select(F.col("conv_id").alias("_base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, F.col("base") == F.col("_base"), "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.select("conv_id", "base", "h", taken.alias("k"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = stored(convs, "rebuilt-convs")
    heads = placed.filter(F.col("place") < LONGEST).withColumnRenamed("conv_id", "_conv")
    heads = heads.join(convs, (F.col("_conv") == F.col("base")) & (F.col("place") <= F.col("h")))
    own = placed.withColumnRenamed("conv_id", "_conv").join(convs, F.col("_conv") == F.col("conv_id"))
    own = own.filter(F.col("place") > F.col("h")).withColumn("place", F.col("place") - F.col("h") + F.col("k"))
    columns = ["conv_id", "place", "t1", "t2", "size"]
    return stored(heads.select(columns).unionByName(own.select(columns)), "rebuilt-turns"), convs.select("conv_id", "length")


def distinct_strings(rows: DataFrame) -> DataFrame:
    """conv_id and seq, the smallest conversation with the same turns, of conversations with turns."""
    digests = rows.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("length"),
        F.bit_xor(F.xxhash64(F.lit(1), "place", "t1")).alias("d1"),
        F.bit_xor(F.xxhash64(F.lit(2), "place", "t2")).alias("d2"),
    )
    digests = stored(digests, "string-digests")
    firsts = digests.groupBy(F.col("length").alias("_l"), F.col("d1").alias("_1"), F.col("d2").alias("_2")).agg(
        F.min("conv_id").alias("seq")
    )
    same = (F.col("length") == F.col("_l")) & (F.col("d1") == F.col("_1")) & (F.col("d2") == F.col("_2"))
    return digests.join(firsts, same).select("conv_id", "seq", "length")


def housed(moved: DataFrame) -> DataFrame:
    """Strings (p_home, p_top, p_place, depth, t1, t2, seq, n, length) with their container's home.

    A container is named by the smallest of its strings and the depth of its first turn, its top.
    """
    key = ["p_home", "p_top", "p_place", "t1", "t2"]
    homes = moved.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.min("seq").alias("home"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    for condition in same[1:]:
        same[0] = same[0] & condition
    return moved.join(homes, same[0]).select("home", F.col("depth").alias("top"), "p_home", "p_top", "p_place", "seq", "n", "length")


def burst(held: DataFrame, big: DataFrame, turns: DataFrame, number: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Burst the big containers: their paths' places, the containers they were, and the strings that go on.

    A path is that of one drawn string, so that each round parts a container as a random
    string would. A path's place has the strings that stay on it just so far (n, low, end_seq).
    """
    b = held.join(big.select(F.col("home").alias("_home"), F.col("top").alias("_top"), "copies"), (F.col("home") == F.col("_home")) & (F.col("top") == F.col("_top")))
    b = stored(b.drop("_home", "_top"), "bursting")
    drawn = F.max(F.struct(F.xxhash64(F.lit(number), "seq").alias("r"), "seq")).alias("drawn")
    paths = b.groupBy("home", "top", "copies").agg(drawn).select("home", "top", "copies", F.col("drawn.seq").alias("path"))
    path = turns.join(paths, F.col("seq") == F.col("path")).filter(F.col("place") >= F.col("top"))
    path = stored(path.select("home", "top", "copies", "place", "t1", "t2", "size"), "path")
    copies = path.select(
        F.col("home").alias("_home"), F.col("top").alias("_top"), F.col("place").alias("_place"),
        F.col("t1").alias("_t1"), F.col("t2").alias("_t2"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("_copy"),
    )
    rest = turns.join(b.withColumnRenamed("seq", "_seq"), F.col("seq") == F.col("_seq")).filter(F.col("place") > F.col("top"))
    rest = rest.withColumn("copy", F.pmod(F.xxhash64("seq"), F.col("copies")))
    met = rest.join(
        copies,
        (F.col("home") == F.col("_home")) & (F.col("top") == F.col("_top")) & (F.col("place") == F.col("_place")) & (F.col("copy") == F.col("_copy")),
        "left",
    )
    other = F.col("_t1").isNull() | (F.col("t1") != F.col("_t1")) | (F.col("t2") != F.col("_t2"))
    left = met.filter(other).groupBy(F.col("seq").alias("_seq")).agg(F.min(F.struct("place", "t1", "t2")).alias("left"))
    b = stored(b.join(left, F.col("seq") == F.col("_seq"), "left").drop("_seq"), "parted")
    reach = F.coalesce(F.col("left.place") - 1, F.col("length"))
    reached = b.groupBy(F.col("home").alias("_home"), F.col("top").alias("_top"), reach.alias("_place")).agg(
        F.sum("n").alias("n"), F.min("seq").alias("low"), F.max(F.when(F.col("left").isNull(), F.col("seq"))).alias("end_seq")
    )
    same = (F.col("home") == F.col("_home")) & (F.col("top") == F.col("_top")) & (F.col("place") == F.col("_place"))
    path = path.join(reached, same, "left").select("home", "top", "place", "size", F.coalesce("n", F.lit(0)).alias("n"), "low", "end_seq")
    moved = b.filter("left is not null").select(
        F.col("home").alias("p_home"), F.col("top").alias("p_top"), (F.col("left.place") - 1).alias("p_place"),
        F.col("left.place").alias("depth"), F.col("left.t1").alias("t1"), F.col("left.t2").alias("t2"), "seq", "n", "length",
    )
    parents = b.select("home", "top", "p_home", "p_top", "p_place").distinct()
    return stored(path, "path-places"), stored(parents, "burst-parents"), stored(housed(moved), "containers")


def sweep(strings: list[tuple[list, int, int]], top: int) -> Iterator[tuple]:
    """Nodes of a container from its strings (turns as (t1, t2, size), n, seq), all with one first turn."""
    strings.sort(key=lambda s: [turn[:2] for turn in s[0]])
    # Per node: depth, smallest string, strings, children, leaves, saved, end, size, parent's place.
    nodes: list[list] = []
    stack: list[int] = []
    before: list = []

    def close() -> None:
        node = nodes[stack.pop()]
        node[4] = node[4] or 1
        node[5] += (node[2] - 1) * node[7]
        if stack:
            above = nodes[stack[-1]]
            above[1] = min(above[1], node[1])
            above[2] += node[2]
            above[3] += 1
            above[4] += node[4]
            above[5] += node[5]

    for turns, n, seq in strings:
        shared = 0
        while shared < min(len(before), len(turns)) and before[shared][:2] == turns[shared][:2]:
            shared += 1
        while len(stack) > shared:
            close()
        for k in range(shared, len(turns)):
            nodes.append([top + k, seq, 0, 0, 0, 0, None, turns[k][2], stack[-1] if stack else None])
            stack.append(len(nodes) - 1)
        node = nodes[stack[-1]]
        node[2] += n
        node[6] = seq
        before = turns
    while stack:
        close()
    for depth, low, n, children, leaves, saved, end, _, parent in nodes:
        yield depth, low, None if parent is None else nodes[parent][1], n, children, leaves, saved, end


def swept(held: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of all containers, each of which fits into a task many times over."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in NODE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, last, strings, out = None, None, [], []

        def flush() -> None:
            if strings:
                out.extend((*box, *node) for node in sweep(strings, box[1]))
                strings.clear()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[] for _ in schema]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        for batch in batches:
            for home, top, seq, n, _, t1, t2, size in zip(*(c.to_pylist() for c in batch.columns)):
                if (home, top) != box:
                    flush()
                    box, last = (home, top), None
                if seq != last:
                    strings.append(([], n, seq))
                    last = seq
                strings[-1][0].append((t1, t2, size))
            if len(out) > 10_000:
                yield rows()
        flush()
        yield rows()

    rest = turns.join(held.withColumnRenamed("seq", "_seq"), F.col("seq") == F.col("_seq")).filter(F.col("place") >= F.col("top"))
    rest = rest.select("home", "top", "seq", "n", "place", "t1", "t2", "size")
    rest = rest.repartition(partitions(turns.sparkSession), "home", "top").sortWithinPartitions("home", "top", "seq", "place")
    return rest.mapInArrow(run, NODE)


def from_here_on(places: DataFrame) -> DataFrame:
    """Sums of n, leaves and saved and the least low of each place of a path and all after it."""
    rows = places.withColumn("stretch", F.floor(F.col("place") / STRETCH))
    later = W.partitionBy("home", "top").orderBy(F.col("stretch").desc()).rowsBetween(W.unboundedPreceding, -1)
    inner = W.partitionBy("home", "top", "stretch").orderBy(F.col("place").desc())
    for sums in (["n"], ["leaves", "saved"]):
        # saved needs the n of the node itself: the second round follows the first.
        lows = [F.min("low").alias("low")] if sums == ["n"] else []
        totals = rows.groupBy("home", "top", "stretch").agg(*[F.sum(c).alias(c) for c in sums], *lows)
        after = totals.select(
            F.col("home").alias("_home"), F.col("top").alias("_top"), F.col("stretch").alias("_stretch"),
            *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"_{c}") for c in sums],
            *([F.min("low").over(later).alias("_low")] if lows else []),
        )
        new = {c: F.sum(c).over(inner) for c in sums} | ({"low": F.min("low").over(inner), "own_low": F.col("low")} if lows else {})
        same = (F.col("home") == F.col("_home")) & (F.col("top") == F.col("_top")) & (F.col("stretch") == F.col("_stretch"))
        rows = rows.withColumns(new).join(after, same)
        rows = rows.withColumns({c: F.col(c) + F.col(f"_{c}") for c in sums} | ({"low": F.least("low", "_low")} if lows else {}))
        rows = rows.drop("_home", "_top", "_stretch", *[f"_{c}" for c in sums], "_low")
        if lows:
            rows = rows.withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("size"))
    return rows.drop("stretch")


def path_nodes(places: DataFrame, attached: DataFrame) -> DataFrame:
    """The nodes of burst containers' paths, from what hangs on them (home, top, place, kids, leaves, saved)."""
    below = attached.select(F.col("home").alias("_home"), F.col("top").alias("_top"), F.col("place").alias("_place"), "kids", "leaves", "saved")
    same = (F.col("home") == F.col("_home")) & (F.col("top") == F.col("_top")) & (F.col("place") == F.col("_place"))
    ends = places.groupBy(F.col("home").alias("_h"), F.col("top").alias("_t")).agg(F.max("place").alias("last"))
    rows = places.join(below, same, "left").drop("_home", "_top", "_place")
    rows = rows.join(ends, (F.col("home") == F.col("_h")) & (F.col("top") == F.col("_t"))).drop("_h", "_t")
    kids = F.coalesce("kids", F.lit(0)) + (F.col("place") < F.col("last")).cast("long")
    rows = rows.withColumn("kids", kids)
    # A path's last node without anything on it is a leaf.
    leaves = F.when(F.col("kids") == 0, F.lit(1).cast("long")).otherwise(F.coalesce("leaves", F.lit(0)))
    rows = rows.withColumns({"leaves": leaves, "saved": F.coalesce("saved", F.lit(0))})
    rows = stored(from_here_on(rows), "path-sums")
    # The node before has the strings of this one and those that stay on the path just so far.
    before = rows.select(F.col("home").alias("_home"), F.col("top").alias("_top"), (F.col("place") + 1).alias("_place"), F.col("low").alias("parent"))
    rows = rows.join(before, same, "left")
    return rows.select(
        "home", "top", F.col("place").alias("depth"), F.col("low").alias("conv_id"), F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "end_seq",
    )


def id_hashes(owners: DataFrame) -> DataFrame:
    """key and the SHA-256 of its conv_ids, ascending and comma-joined.

    A hash of many ids is taken as they stream by, in constant memory; it cannot be split.
    """
    schema = pa.schema([("key", pa.int64()), ("sha", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            keys, shas = [], []
            for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if sha is None or k != key:
                    if sha is not None:
                        keys.append(key)
                        shas.append(sha.hexdigest())
                    key, sha = k, hashlib.sha256(str(conv).encode())
                else:
                    sha.update(f",{conv}".encode())
            yield arrow_rows(schema, key=keys, sha=shas)
        if sha is not None:
            yield arrow_rows(schema, key=[key], sha=[sha.hexdigest()])

    rows = owners.select("key", "conv_id").repartition(partitions(owners.sparkSession), "key")
    return rows.sortWithinPartitions("key", "conv_id").mapInArrow(run, "key long, sha string")


def conversation_trie(turns: DataFrame, limit: int = BURST) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, the textless root included.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256; (conv_id, depth) is unique. See rebuilt_conversations.

    Null roles and texts are empty. Rows without a conv_id are no conversation. Repeated rows
    are turns of their own, turns of one number follow each other by the hash of role and
    text. Turns are compared by 128 bits of hashes. A rebuilt conversation without turns is a
    member of the root only. An empty table has no node; other columns are ignored. No group
    is gathered whole: a container of more than `limit` turns bursts, also if it is one long
    conversation, and the ids of a node's copies stream through their hash.
    """
    rows, convs = rebuilt_conversations(turns)
    owners = stored(distinct_strings(rows), "strings")
    strings = owners.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.first("length").alias("length"))
    rows = stored(rows.join(strings.select(F.col("seq").alias("_seq")), F.col("conv_id") == F.col("_seq"), "left_semi").withColumnRenamed("conv_id", "seq"), "string-turns")
    first = rows.filter("place = 1").select(F.col("seq").alias("_seq"), "t1", "t2")
    none = F.lit(None).cast("long")
    held = strings.join(first, F.col("seq") == F.col("_seq")).select(
        none.alias("p_home"), none.alias("p_top"), none.alias("p_place"), F.lit(1).cast("long").alias("depth"), "t1", "t2", "seq", "n", "length"
    )
    held = stored(housed(held), "containers")

    rounds, settled = [], []
    while True:
        sizes = held.groupBy("home", "top").agg(
            F.sum(F.col("length") - F.col("top") + 1).alias("size"), F.ceil(F.count(F.lit(1)) / SPREAD).alias("copies")
        )
        big = stored(sizes.filter(F.col("size") > limit), "big")
        if big.isEmpty():
            settled.append(held)
            break
        same = (F.col("home") == F.col("_home")) & (F.col("top") == F.col("_top"))
        named = big.select(F.col("home").alias("_home"), F.col("top").alias("_top"))
        settled.append(held.join(named, same, "left_anti"))
        path, parents, held = burst(held, big, rows, len(rounds))
        rounds.append((path, parents))
    boxes = settled[0]
    for more in settled[1:]:
        boxes = boxes.unionByName(more)
    boxes = stored(boxes, "settled")
    nodes = [stored(swept(boxes, rows), "swept-nodes")]
    hung = [boxes.select("home", "top", "p_home", "p_top", "p_place").distinct()] + [parents for _, parents in rounds]
    parents = hung[0]
    for more in hung[1:]:
        parents = parents.unionByName(more)
    parents = stored(parents, "parents").select(F.col("home").alias("_home"), F.col("top").alias("_top"), "p_home", "p_top", "p_place")

    def tops(found: DataFrame) -> DataFrame:
        """The first nodes of containers, with the place they hang on."""
        top = found.filter(F.col("depth") == F.col("top"))
        return top.join(parents, (F.col("home") == F.col("_home")) & (F.col("top") == F.col("_top"))).drop("_home", "_top")

    sums = [F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")]
    above = tops(nodes[0])
    for path, _ in reversed(rounds):
        attached = above.filter("p_home is not null").groupBy(
            F.col("p_home").alias("home"), F.col("p_top").alias("top"), F.col("p_place").alias("place")
        )
        nodes.append(stored(path_nodes(path, attached.agg(*sums)), "path-nodes"))
        above = above.unionByName(tops(nodes[-1]))
    above = stored(above, "tops")

    # First nodes of containers have their parents on paths or in the root.
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    # The root is one row, whose numbers are sums over all.
    least, n_convs = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    kids, leaves, saved = above.filter("p_home is null").agg(*sums).first()
    root = [(least, n_convs, kids, leaves or 1, saved or 0, 0)] if n_convs else []
    root = turns.sparkSession.createDataFrame(
        root, "conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, zero long"
    )
    places = None
    for more in nodes[1:]:
        some = more.select(F.col("home").alias("_ph"), F.col("top").alias("_pt"), F.col("depth").alias("_pp"), F.col("conv_id").alias("_parent"))
        places = some if places is None else places.unionByName(some)
    inside = every.filter(F.col("depth") > F.col("top"))
    start = above.select(*every.columns, "p_home", "p_top", "p_place")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_seq"]
    under_root = start.filter("p_home is null").withColumn("parent_conv_id", F.lit(least).cast("long"))
    out = inside.select(columns).unionByName(under_root.select(columns))
    if places is not None:
        on = (F.col("p_home") == F.col("_ph")) & (F.col("p_top") == F.col("_pt")) & (F.col("p_place") == F.col("_pp"))
        out = out.unionByName(start.join(places, on).withColumn("parent_conv_id", F.col("_parent")).select(columns))
    hashes = stored(id_hashes(owners.select(F.col("seq").alias("key"), "conv_id")), "end-hashes")
    nothing = hashlib.sha256(b"").hexdigest()
    out = out.join(hashes, F.col("end_seq") == F.col("key"), "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(nothing)))
    turnless = id_hashes(convs.filter("length = 0").select(F.lit(0).cast("long").alias("key"), "conv_id"))
    root = root.withColumns({"depth": F.lit(0).cast("long"), "parent_conv_id": none})
    root = root.join(turnless, F.col("zero") == F.col("key"), "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(nothing)))
    columns = columns[:-1] + ["ends_sha256"]
    return out.select(columns).unionByName(root.select(columns))
