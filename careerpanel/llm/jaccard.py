"""Documents whose shingle sets are alike: an exact Jaccard join with signature trees."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerpanel.llm.common import lists, map_slices, row_key, strings
from careerpanel.llm.components import components
from careerpanel.sources.staging import scratch, stage

#: Words whose hashes a task keeps; the store starts anew when full.
CACHE = 400_000
#: Sets of a signature tree, of a leaf, and least and most words of 64 bits in a bitmap.
TREE, LEAF, WORDS = 2000, 16, (16, 1024)
#: A set goes on if at least one in SHARE of its hashes is among the least of other sets, too.
SHARE = 20
#: Sets that link have one part in common more for each ALIKE shingles that they may differ in.
ALIKE = 3
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _B
    return x ^ x >> np.uint64(29)


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def words(self, text: str) -> list[bytes]:
        """Runs of other bytes than 0x20 and 0x09 to 0x0D, with A-Z in lower case."""
        return text.encode().lower().split()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        out = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > CACHE:
            known.clear()
        return out

    def rolled(self, h: np.ndarray, width: int) -> np.ndarray:
        """The hash of each run of ``width`` words."""
        n = len(h) - width + 1
        out = np.full(n, width, np.uint64)
        for i in range(width):
            out = _mix(out * _A + h[i : i + n])
        return out

    def __call__(self, text: str) -> np.ndarray:
        """The set's hashes. Of fewer words than the width the whole sequence is the shingle."""
        words = self.words(text)
        if not words:
            return np.empty(0, np.uint64)
        return np.unique(self.rolled(self.hashes(words), min(self.width, len(words))))


class Parts:
    """Groups of keys such that any two unlike sets that link have enough in common of one group.

    Sizes fall into bands; sets that link are in the same or in neighbouring bands. For two neighbouring
    bands the sets that link differ in at most D shingles. If shingles are dealt by hash into D + T + E
    parts, at least T + E parts are alike, and unless more than E parts of a set are empty (then that is a
    key of a group of its own), T parts alike are not empty. A key is the hash of such a part. Sets that merely share
    a passage have rarely a whole part in common, and seldom T. E is what chance makes of empty parts, and four deviations.
    """

    def __init__(self, percent: int):
        self.percent, self.starts, self.deals = percent, [1], {}
        while self.starts[-1] < 1 << 40:
            self.starts.append(self.starts[-1] * 100 // percent + 1)

    def deal(self, lower: int, differ: int) -> tuple[int, int, int]:
        """The number of parts for two bands, how many are alike and not empty at least, and how many may be empty."""
        if lower not in self.deals:
            m, need = self.starts[lower], 1 + differ // ALIKE
            for empty in range(1, 4 * m + 10):
                n = differ + need + empty
                mean = n * (1 - 1 / n) ** m
                spread = max(0.0, mean + n * (n - 1) * (1 - 2 / n) ** m - mean * mean) ** 0.5
                if empty >= mean + 4 * spread:
                    break
            self.deals[lower] = n, need, empty
        return self.deals[lower]

    def groups(self, s: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """For each group how many keys sets that link share at least, and the set's keys."""
        if not len(s):
            return []
        band = int(np.searchsorted(self.starts, len(s), side="right")) - 1
        mixed = _mix(s ^ _A)
        out = []
        for lower in (band - 1, band):
            differ = (100 - self.percent) * 2 * (self.starts[lower + 2] - 1) // (100 + self.percent) if lower >= 0 else 0
            if not differ:
                continue  # such sets link only when they are equal
            n, need, empty = self.deal(lower, differ)
            part = (mixed % np.uint64(n)).astype(np.int64)
            sums, sizes = np.zeros(n, np.uint64), np.bincount(part, minlength=n)
            np.add.at(sums, part, _mix(mixed * _B))
            keys = _mix(sums ^ _mix(np.arange(n, dtype=np.uint64) * _A + np.uint64(lower)))[sizes > 0]
            out.append((need, keys))
            if n - len(keys) > empty:
                out.append((1, _mix(np.array([~lower & 0xFFFFFFFF], np.uint64) * _A)))
        return out

    def __call__(self, s: np.ndarray) -> np.ndarray:
        """The set's keys of all groups."""
        return np.unique(np.concatenate([np.empty(0, np.uint64), *(keys for _, keys in self.groups(s))]))


def least_common(n: int, percent: int) -> int:
    """How many hashes a set of ``n`` and any that links with it share at least."""
    return -(-percent * n // 100)


def prefix(s: np.ndarray, percent: int) -> np.ndarray:
    """The least hashes of a sorted set: any two sets that link have ``least_marks`` of either in common here.

    Of what two linked sets share the k least are among all but ``least_common`` less k of either. k is a
    SHARE-th of the set's size; the other set may be as small as ``least_common``, and has its own k.
    """
    return s[: len(s) - least_common(len(s), percent) + max(1, len(s) // SHARE)] if len(s) else s


def least_marks(n: int, percent: int) -> int:
    return max(1, least_common(n, percent) // SHARE)


class Tree:
    """A binary tree over sets. A node holds the OR and the AND of its sets' bitmaps and their range of sizes."""

    def __init__(self, sets: list[np.ndarray], words: int):
        self.sets = sets
        self.size = np.fromiter(map(len, sets), np.int64, len(sets))
        self.bits = np.zeros((len(sets), words), np.uint64)
        for i, s in enumerate(sets):
            bit = _mix(s) % np.uint64(64 * words)
            np.bitwise_or.at(self.bits[i], (bit >> np.uint64(6)).astype(int), np.uint64(1) << (bit & np.uint64(63)))
        self.order = np.lexsort((self.size, np.fromiter((s.min() for s in sets), np.uint64, len(sets))))
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(sets))

    def _build(self, a: int, b: int) -> int:
        at = self.order[a:b]
        node = (a, b, np.bitwise_or.reduce(self.bits[at]), np.bitwise_and.reduce(self.bits[at]), int(self.size[at].min()), int(self.size[at].max()))
        kids = (self._build(a, (a + b) // 2), self._build((a + b) // 2, b)) if b - a > LEAF else ()
        self.nodes.append((*node, kids))
        return len(self.nodes) - 1


def bitmap_words(sets: list[np.ndarray]) -> int:
    """Words of a bitmap with two bits for each hash of nine sets in ten: fuller ones tell unlike sets not apart."""
    wanted = int(np.percentile([len(s) for s in sets], 90)) // 32
    return int(np.clip(1 << wanted.bit_length(), *WORDS))


def _count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def tree_links(sets: list[np.ndarray], percent: int, label: np.ndarray, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that, with those that ``label`` stands for, connect what the join's links connect.

    ``sets`` are sorted arrays. Two trees (one for each ``side``; else one with itself) are walked
    together. A pair of nodes is left when no two of its sets can overlap enough: an overlap is at most a
    set's size less its bits that the other node lacks, and at least percent / (100 + percent) of both sizes
    is needed. It is also left when all its sets are connected already. What remains is compared exactly.
    """
    label = label.copy()
    found: list[tuple[int, int]] = []
    groups = [np.arange(len(sets))] if side is None else [np.flatnonzero(side == 0), np.flatnonzero(side == 1)]
    if min(map(len, groups)) == 0:
        return found
    words = bitmap_words(sets)
    trees = [Tree([sets[i] for i in g], words) for g in groups]
    left, right = trees[0], trees[-1]
    ids_l, ids_r = groups[0], groups[-1]
    same = side is None
    stack = [(left.root, right.root)]
    while stack:
        i, j = stack.pop()
        a, b = left.nodes[i], right.nodes[j]
        low = min(a[5] - _count(a[3] & ~b[2]), b[5] - _count(b[3] & ~a[2]))
        if (100 + percent) * low < percent * (a[4] + b[4]) or 100 * min(a[5], b[5]) < percent * max(a[4], b[4]):
            continue
        la, lb = left.order[a[0] : a[1]], right.order[b[0] : b[1]]
        labels = label[ids_l[la]], label[ids_r[lb]]
        if (labels[0] == labels[0][0]).all() and (labels[1] == labels[0][0]).all():
            continue
        if a[6] or b[6]:
            if a[6] and (not b[6] or a[1] - a[0] >= b[1] - b[0]):
                pairs = [(x, j) for x in a[6]] if not (same and i == j) else [(a[6][0], a[6][1]), (a[6][1], a[6][1]), (a[6][0], a[6][0])]
            else:
                pairs = [(i, y) for y in b[6]]
            stack += pairs
            continue
        x, y = np.meshgrid(la, lb, indexing="ij")
        x, y = x.ravel(), y.ravel()
        if same and i == j:
            x, y = x[x < y], y[x < y]
        nx, ny = left.size[x], right.size[y]
        bx, by = left.bits[x], right.bits[y]
        most = np.minimum(nx - _count(bx & ~by), ny - _count(by & ~bx))
        ok = (100 + percent) * most >= percent * (nx + ny)
        for p, q in zip(ids_l[x[ok]], ids_r[y[ok]], strict=True):
            if label[p] != label[q]:
                overlap = len(sets[p]) + len(sets[q]) - len(np.unique(np.concatenate([sets[p], sets[q]])))
                if 100 * overlap >= percent * (len(sets[p]) + len(sets[q]) - overlap):
                    found.append((int(p), int(q)))
                    label[label == label[q]] = label[p]
    return found


def _links_of_units(units: DataFrame, percent: int) -> DataFrame:
    """(u, v): links within each group of ``units`` (unit, part, side, c, label, set).

    Parts are joined each by itself; sides 0 and 1 of a part with each other, side 2 with itself.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        c, label = table["c"].to_numpy(), table["label"].to_numpy()
        sets = [x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in table["set"]]
        side, part = table["side"].to_numpy(), table["part"].to_numpy()
        order = np.argsort(part, kind="stable")
        out: list[tuple[int, int]] = []
        for at in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            _, first = np.unique(np.stack([c[at], side[at]]), axis=1, return_index=True)  # a set read twice
            at = at[first]
            sides = None if (side[at] == 2).all() else side[at]
            for p, q in tree_links([sets[i] for i in at], percent, label[at], sides):
                out.append((c[at[p]], c[at[q]]))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    return units.groupBy("unit").applyInArrow(run, "u bigint, v bigint")


def refine(sets: DataFrame, percent: int) -> DataFrame:
    """``sets`` (k, c, set) with clusters cut to what the rarest shingles hold together.

    Two sets that link have one of their rarest shingles in common: of all but ``least_common`` less one, in an
    order of shingles that is the same for both. The order is by number of sets of the cluster, then by hash. Shingles
    of one set alone come first and meet nothing, so what many sets share is seldom a key. A set
    without a key links with nothing and goes.
    """
    each = sets.dropDuplicates(["c"]).select("k", "c", F.size("set").alias("size"), F.explode("set").alias("s"))
    often = stage(each.groupBy("k", "s").agg(F.count("*").alias("n")).where("n > 1"), "often")
    shared = each.join(often, ["k", "s"]).groupBy("c", "size").agg(F.sort_array(F.collect_list(F.struct("n", "s", "k"))).alias("of"))  # of one set
    # the first shingles of the order, size - least_common + 1 of them, less those of the set alone
    least = F.ceil(F.col("size") * percent / 100).cast("int")
    keys = F.greatest(F.lit(0), F.size("of") - least + 1)
    entries = stage(shared.select("c", F.explode(F.slice("of", F.lit(1), keys)).alias("e")).select("c", "e.k", "e.s"), "rare")
    star = stage(entries.groupBy("k", "s").agg(F.min("c").alias("u"), F.max("c").alias("v")).where("u <> v").drop("v"), "stars")
    edges = entries.join(star, ["k", "s"]).where("c <> u").select("u", F.col("c").alias("v"))
    return sets.drop("k").join(components(edges).select(F.col("node").alias("c"), F.col("label").alias("k")), "c").select("k", "c", "set")


def rare_parts(groups: DataFrame) -> DataFrame:
    """(c, part): the keys of ``groups`` (c, need, value) in which classes that link meet, of each group of keys.

    Sets that link share ``need`` keys of a group, so one of all but ``need`` less one, in an order of keys that is the same
    for both: keys of one class alone come first and meet nothing, then those of few rows. So a class with
    fewer than ``need`` keys that others have, which is most that merely share passages, meets none and makes no chains.
    """
    each = groups.select("c", "need", F.posexplode("value").alias("g", "keys"))
    entries = each.select("c", "g", F.get("need", F.col("g")).alias("need"), F.explode("keys").alias("part"))
    often = entries.groupBy("part").agg(F.count("*").alias("n"), F.min("c").alias("u"), F.max("c").alias("v")).where("u <> v").select("part", "n")
    # of one set; equal rows give their class' keys once each
    shared = entries.join(stage(often, "often"), "part").groupBy("c", "g", "need").agg(F.sort_array(F.collect_set(F.struct("n", "part"))).alias("of"))
    keys = F.greatest(F.lit(0), F.size("of") - F.col("need").cast("int") + 1)
    return shared.select("c", F.explode(F.slice("of", F.lit(1), keys)).alias("e")).select("c", "e.part")


def _unit(*parts) -> list:
    return [F.xxhash64(*parts).alias("unit"), F.xxhash64(*parts).alias("part")]


def _join_sets(sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) within each cluster of ``sets`` (k, c, set), enough to connect what is linked.

    A cluster of more than TREE sets is cut by :func:`refine` first. Clusters of up to TREE sets are joined in
    one tree; a task takes some of them. One that is still larger is cut in blocks. First each block is joined
    with itself and with block 0. Then the largest component so far is left out as one side: sets outside it, in
    blocks, are joined with all blocks. So no two sets of unlike component stay unseen, and a group of copies
    of any size costs two passes over its blocks.
    """
    sizes = stage(sets.groupBy("k").agg(F.countDistinct("c").alias("m")), "clusters")
    if (sizes.agg(F.max("m")).first()[0] or 0) > TREE:
        large = sizes.where(F.col("m") > TREE).select("k")
        cut = refine(sets.join(large, "k", "left_semi"), percent)
        # labels of cut clusters and of others are the least classes of unlike sets, so they stay apart
        sets = stage(sets.join(large, "k", "left_anti").select("k", "c", "set").unionByName(cut), "sets")
        sizes = stage(sets.groupBy("k").agg(F.countDistinct("c").alias("m")), "clusters")
    total = sizes.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).first()
    bins = max(1, total[0] // (TREE // 2))
    sized = sets.join(sizes, "k").withColumn("label", F.col("c"))
    small = sized.where(F.col("m") <= TREE).select(F.pmod(F.xxhash64("k"), F.lit(bins)).alias("unit"), F.col("k").alias("part"), F.lit(2).alias("side"), "c", "label", "set")
    links = _links_of_units(small, percent)
    if total[1] <= TREE:
        return links
    blocks = F.ceil(F.col("m") / (TREE // 2)).cast("int")
    large = sized.where(F.col("m") > TREE).withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("c"), blocks).cast("int")})
    columns = ["c", "label", "set"]
    own = large.select(*_unit("k", "block"), F.lit(2).alias("side"), *columns)
    hub = large.where("block = 0").withColumn("other", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
    hub = hub.select(*_unit("k", F.lit(-1), "other"), F.lit(0).alias("side"), *columns)
    spoke = large.where("block > 0").select(*_unit("k", F.lit(-1), "block"), F.lit(1).alias("side"), *columns)
    links = stage(links.unionByName(_links_of_units(own.unionByName(hub).unionByName(spoke), percent)), "links")
    labels = components(links)
    labelled = large.drop("label").join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    counts = labelled.groupBy("k", "label").agg(F.count("*").alias("n"))
    most = counts.groupBy("k").agg(F.max(F.struct("n", "label")).alias("most"))
    labelled = stage(labelled.join(most, "k").withColumn("outside", F.col("label") != F.col("most.label")).drop("most"), "labelled")
    rest = labelled.groupBy("k").agg(F.sum(F.col("outside").cast("int")).alias("rest")).where("rest > 0")
    cut = labelled.join(rest.withColumn("turns", F.ceil(F.col("rest") / (TREE // 2)).cast("int")), "k")
    a = cut.where("outside").withColumn("turn", F.pmod(F.xxhash64(F.lit(1), "c"), F.col("turns")).cast("int"))
    a = a.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    b = cut.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    pair = [*_unit("k", "turn", "block")]
    across = a.select(*pair, F.lit(0).alias("side"), *columns).unionByName(b.select(*pair, F.lit(1).alias("side"), *columns))
    return links.unionByName(_links_of_units(across, percent))


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    Two rows link when 100 * common shingles >= percent * all their shingles. ``component_id`` is the least
    non-null id that links reach, the row's own included (null if there is none). Shingles are runs of
    ``width`` words, compared by 64-bit hash. A text without words, or null, has an empty set and links with
    nothing. Repeated rows and equal sets are one set from the start. Further columns are not read.

    Equal sets are one class. Only classes whose ``prefix`` meets those of others often enough can link. Of these, classes
    that link share keys of ``Parts``, and one of the rarest of them; classes that share such a one, by any chain, form a
    cluster, and within clusters signature trees find the links. Large clusters are cut by their rarest shingles before.
    Tables that are written on the way are deleted when the next ones stand.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))

    def marks():
        shingle = Shingler(width)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle(t) for t in strings(batch, 1)]
            digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            n = pa.array([len(s) for s in sets], pa.int64())
            need = pa.array([least_marks(len(s), percent) for s in sets], pa.int64())
            least = lists([prefix(s, percent).view(np.int64) for s in sets], pa.int64())
            return pa.record_batch([batch.column(0), batch.column(2), n, pa.array(digest, pa.binary()), need, least], names=["id", "key", "n", "digest", "need", "marks"])

        return step

    kind = rows.schema["id"].dataType.simpleString()
    spark = docs.sparkSession
    with scratch(spark) as keep:
        sets = map_slices(rows, marks, f"id {kind}, key bigint, n bigint, digest binary, need bigint, marks array<bigint>")
        sets = stage(sets.withColumn("rid", F.monotonically_increasing_id()), "marked")
        seen = keep(sets.select("id", "n", "digest"), "seen")
        classes = sets.where("n > 0").groupBy("digest").agg(F.min("rid").alias("rid"), F.min("id").alias("least"))
        classes = keep(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
        first = stage(classes.join(sets.select("rid", "key", "need", "marks"), "rid").select("c", "digest", "key", "need", "marks"), "first")
        marked = first.select("c", F.explode("marks").alias("mark"))
        shared = stage(marked.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"), "marks")
        met = stage(marked.join(shared, "mark").groupBy("c").agg(F.count("*").alias("met")), "met")
        first = keep(first.drop("marks").join(met, "c").where("met >= need").select("c", "digest", "key"), "first")

    def whole_sets(after: Callable[[list[np.ndarray]], list[pa.Array]], names: tuple[str, ...] = ("value",)):
        """(c, names): of a class' own text, not of one with an equal key, what ``after`` makes of its set."""

        def start():
            shingle = Shingler(width)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                sets = [shingle(t) for t in strings(batch, 2)]
                digests = batch.column(1).to_pylist()
                right = [i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s.tobytes()) == digests[i]]
                return pa.record_batch([batch.column(0).take(pa.array(right, pa.int64())), *after([sets[i] for i in right])], names=["c", *names])

            return step

        return start

    def whole(sets: list[np.ndarray]) -> list[pa.Array]:
        return [lists([s.view(np.int64) for s in sets], pa.int64())]

    parts = Parts(percent)

    def grouped(sets: list[np.ndarray]) -> list[pa.Array]:
        groups = [parts.groups(s) for s in sets]
        need = lists([np.array([n for n, _ in g], np.int64) for g in groups], pa.int64())
        ends = pa.array(np.cumsum([0, *map(len, groups)]), pa.int32())
        return [need, pa.ListArray.from_arrays(ends, lists([keys.view(np.int64) for g in groups for _, keys in g], pa.int64()))]

    texts = rows.select("key", "text")
    with scratch(spark) as keep:
        found = texts.join(first, "key").select("c", "digest", "text")
        keyed = map_slices(found, whole_sets(grouped, ("need", "value")), "c bigint, need array<bigint>, value array<array<bigint>>")
        entries = stage(rare_parts(stage(keyed, "parts")), "rare-parts")
        star = entries.groupBy("part").agg(F.min("c").alias("u"), F.max("c").alias("v")).where("u <> v").drop("v")
        star = stage(star, "stars")
        edges = entries.join(star, "part").where("c <> u").select("u", F.col("c").alias("v")).distinct()
        clusters = keep(components(edges), "clusters")
    with scratch(spark) as keep:
        members = first.join(clusters, F.col("c") == F.col("node"), "left_semi")
        found = map_slices(texts.join(members, "key").select("c", "digest", "text"), whole_sets(whole), "c bigint, value array<bigint>")
        sets = stage(found.join(clusters, F.col("c") == F.col("node")).select(F.col("label").alias("k"), "c", F.col("value").alias("set")), "sets")
        linked = components(stage(_join_sets(sets, percent), "links")).withColumnRenamed("node", "c")
        labels = classes.join(linked, "c", "left").withColumn("label", F.coalesce("label", "c"))
        least = labels.groupBy("label").agg(F.min("least").alias("component"))
        named = keep(labels.join(least, "label").select("digest", "component"), "named")
    out = seen.select("id", "n", "digest").join(named, "digest", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
