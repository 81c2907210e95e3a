"""Near-duplicates by an LSH forest over MinHash signatures, with links confirmed on full sets.

A document is its set of distinct word shingles. Documents with equal sets are one class from the
start. A class has a MinHash signature; a tree of the forest reads the signature in its own order,
and classes that agree in a long prefix of that order stand next to each other in it, in one
region. All members of a region are candidates of the region's first member; those that this
doesn't bring together are candidates of each other. Regions begin at ``DEPTH`` equal values. One
in which those are too many for its size is cut up by reading on in the tree's order; the depth is
a region's own. A pair near the threshold may part there, so the members of such regions are also
joined on their rarest shingles, which misses none.

Candidates are tested first on signatures, with a wide margin, then on the full sets. Components
are found by alternating star contractions, whose work doesn't depend on a component's shape.

What is shuffled by class or region is one short row per class and tree. A group of very many
copies is one class; a group of very many near copies meets in one region, where it costs one
candidate each. Tables between steps are written to the shared folder.

Chance to miss a pair of classes of similarity s: (1 - s**DEPTH)**TREES, under 4 in a million at
0.8 and less above it.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm import vectext as V
from tradewind.sinks.shared import shared_dir

WORDS = 5
PERCENT = 80
VALUES = 128
TREES = 24
DEPTH = 4
# depths at which a large region is cut up; it is large if its members would have more candidates
# each than this, on the average
DEEPER = (8, 16)
LARGE = 8
# members of a region whose order is looked at together
STRETCH = 4096
# characters of the texts that a task looks at together, and of those it sends together: its arrays
# are some dozen times as large, and a worker keeps what it once took
TASK_CHARS = 1 << 17
SENT_CHARS = 1 << 20
# signatures agree in fewer values than this share only if the sets are far from the threshold:
# five standard deviations
_MARGIN = 5.0


def shingle_sets(texts: "list[str]", words: int) -> "list[np.ndarray]":
    """Sorted hashes of each text's distinct shingles.

    A-Z count as a-z. A text with fewer words than a shingle is one shingle; without words it has none.
    """
    out = []
    for begin, end in V.batches(texts, TASK_CHARS):
        points, at = V.code_points(texts[begin:end])
        start, stop = V.runs(~V.is_blank(points), at)
        word = V.run_hashes(V.mixed(V.lower_ascii(points)), start, stop)
        first = V.text_of_words(start, at)
        total = len(word) - words + 1
        rolled = V.gram_hashes(word, words) if total > 0 else word[:0]
        for i in range(end - begin):
            n = first[i + 1] - first[i]
            if n >= words:
                out.append(np.unique(rolled[first[i] : first[i + 1] - words + 1]))
            elif n:
                out.append(V.gram_hashes(word[first[i] : first[i + 1]], int(n)) + np.uint64(n))
            else:
                out.append(word[:0])
    return out


def _orders(values: int) -> "tuple[np.ndarray, np.ndarray]":
    rng = np.random.default_rng(41)
    odd = rng.integers(0, 1 << 31, values, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return rng.integers(0, 1 << 32, values, dtype=np.uint32), odd


def signatures(sets: "list[np.ndarray]", values: int = VALUES) -> np.ndarray:
    """One row of ``values`` 32-bit minima per non-empty set."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    begins = np.append(0, np.cumsum([len(s) for s in sets]))[:-1]
    out = np.empty((values, len(sets)), dtype=np.uint32)
    for i, (seed, odd) in enumerate(zip(*_orders(values))):
        x = (flat ^ seed) * odd
        x ^= x >> np.uint32(15)
        out[i] = np.minimum.reduceat(x * np.uint32(0x2C1B3C6D), begins)
    return out.T


def _sketch(words: int, values: int):
    def part(key: pd.Series, texts: "list[str]") -> pd.DataFrame:
        sets = shingle_sets(texts, words)
        some = [i for i, s in enumerate(sets) if len(s)]
        signed: "list" = [None] * len(sets)
        left: "list" = [None] * len(sets)
        right: "list" = [None] * len(sets)
        if some:
            of = signatures([sets[i] for i in some], values).view(np.int32)
            for k, i in enumerate(some):
                signed[i] = of[k]
                # equal sets have equal sums; 128 bits tell all others apart
                spread = V.mix(sets[i])
                left[i] = int(spread.sum().view(np.int64))
                right[i] = int(V.mix(spread ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().view(np.int64))
        return pd.DataFrame(
            {
                "key": key.to_numpy(),
                "n_shingles": [len(s) for s in sets],
                "left": pd.array(left, dtype="Int64"),
                "right": pd.array(right, dtype="Int64"),
                "signature": signed,
            }
        )

    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            texts = frame["text"].fillna("").tolist()
            for begin, end in V.batches(texts, SENT_CHARS):
                yield part(frame["key"].iloc[begin:end], texts[begin:end])

    return run


def _sets(words: int):
    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            texts = frame["text"].fillna("").tolist()
            for begin, end in V.batches(texts, SENT_CHARS):
                sets = shingle_sets(texts[begin:end], words)
                yield pd.DataFrame(
                    {"id": frame["id"].iloc[begin:end].to_numpy(), "set": [s.tobytes() for s in sets]}
                )

    return run


class _Work:
    """Tables of one run: written to the shared folder and read again."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession

    def kept(self, frame: DataFrame, name: str) -> DataFrame:
        place = shared_dir(self.spark, f"neardup-{name}")
        frame.write.parquet(place)
        return self.spark.read.parquet(place)


def components(links: DataFrame, work: _Work) -> DataFrame:
    """``a, b`` (links) -> ``id, root``: every linked id and the smallest one it is linked with.

    Alternating large-star and small-star steps until nothing moves; each step hangs neighbours on
    the smallest one, so stars of any size are done in two steps and long chains in a few more.
    """

    def directed(pairs: DataFrame) -> DataFrame:
        return pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a")))

    edges = work.kept(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while True:
        # large star: larger neighbours of a node go to its smallest neighbour
        both = directed(edges)
        least = work.kept(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")), "large"
        ).select("node", F.least("node", "m").alias("m"))
        large = (
            both.join(least, F.col("a") == F.col("node"))
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = work.kept(large, "edges")
        # small star: smaller neighbours of a node, and the node, go to the smallest of them
        least = work.kept(
            large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")), "small"
        )
        small = (
            large.join(least, F.col("a") == F.col("node"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        small = work.kept(small, "edges")
        # done when every node hangs on one root that hangs on none
        moved = small.join(
            small.select(F.col("a").alias("inner")), F.col("b") == F.col("inner"), "left_semi"
        )
        if moved.isEmpty() and small.groupBy("a").count().filter("count > 1").isEmpty():
            break
        edges = small
    return small.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        small.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )


def _prefix(tree: int, depth: int, values: int) -> Column:
    """The first values of a tree's order as one number."""
    signature = F.col("signature")
    at = [(tree * DEPTH + j) % values for j in range(depth)]
    return F.xxhash64(F.lit(tree), *[signature[i] for i in at])


def _regions(classes: DataFrame, trees: int, values: int) -> DataFrame:
    """``region, id, tree``: the region of every class in every tree, at the first depth."""
    keys = F.array(*[_prefix(t, DEPTH, values) for t in range(trees)])
    return classes.select("id", F.posexplode(keys).alias("tree", "region"))


def _near(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in at least that share of their values."""
    signature = classes.select("id", "signature")
    both = pairs.join(
        signature.select(F.col("id").alias("_a"), F.col("signature").alias("sa")),
        F.col("a") == F.col("_a"),
    ).join(
        signature.select(F.col("id").alias("_b"), F.col("signature").alias("sb")),
        F.col("b") == F.col("_b"),
    )
    alike = F.aggregate(
        F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
    )
    return both.filter(alike >= F.lit(least) * F.size("sa")).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have the wanted similarity. ``sets``: ``id, set`` of every class."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common = int((large[at] == small).sum())
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(out)

    left = sets.select(F.col("id").alias("_a"), F.col("set").alias("sa"))
    right = sets.select(F.col("id").alias("_b"), F.col("set").alias("sb"))
    return (
        pairs.join(left, F.col("a") == F.col("_a"))
        .join(right, F.col("b") == F.col("_b"))
        .filter(linked("sa", "sb"))
        .select("a", "b")
    )


def _across(members: DataFrame, group: DataFrame) -> DataFrame:
    """``members`` with ``group``: the component of each id, itself if it has none yet."""
    return members.join(
        group.select(F.col("id").alias("_id"), "root"), F.col("id") == F.col("_id"), "left"
    ).select(*members.columns, F.coalesce("root", "id").alias("group"))


def _apart(pairs: DataFrame, group: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that are in different groups."""
    left = group.select(F.col("id").alias("_ia"), F.col("root").alias("_ra"))
    right = group.select(F.col("id").alias("_ib"), F.col("root").alias("_rb"))
    return (
        pairs.join(left, F.col("a") == F.col("_ia"), "left")
        .join(right, F.col("b") == F.col("_ib"), "left")
        .filter(F.coalesce("_ra", "a") != F.coalesce("_rb", "b"))
        .select("a", "b")
    )


def _neighbours(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that stand next to each other, or next but one, in a tree's order.

    Within a region the order goes by the values that follow the region's own, so neighbours are
    those with the longest common prefix. A region of more than ``STRETCH`` members is ordered in
    several stretches, by a hash of the id, so that no task gets a whole large region.
    """
    following = F.slice(
        F.concat("signature", "signature"), F.col("tree") * DEPTH + DEPTH + 1, F.lit(8)
    )
    ordered = members.join(
        classes.select(F.col("id").alias("_c"), "signature"), F.col("id") == F.col("_c")
    ).select(
        "region",
        "id",
        F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / STRETCH)).alias("stretch"),
        following.alias("order"),
    )
    along = Window.partitionBy("region", "stretch").orderBy("order", "id")
    before = ordered.select(
        "id", F.array(F.lag("id", 1).over(along), F.lag("id", 2).over(along)).alias("before")
    )
    pairs = before.select("id", F.explode("before").alias("b")).filter("b is not null")
    return pairs.select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b")).distinct()


def _open_regions(members: DataFrame, least: int) -> DataFrame:
    """``r, n, across``: regions of at least so many members in several groups, and their pairs of
    members in different groups."""
    return (
        members.groupBy("region", "group")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(F.col("region").alias("r"))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("n")).alias("_same"),
            F.count(F.lit(1)).alias("_groups"),
        )
        .filter((F.col("n") >= least) & (F.col("_groups") > 1))
        .select("r", "n", ((F.col("n") * F.col("n") - F.col("_same")) / 2).alias("across"))
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    trees: int = TREES,
    values: int = VALUES,
) -> DataFrame:
    """``key, n_shingles, class_id, component_id`` for every row of ``docs``; the key is a long.

    Documents are linked if ``100 * common shingles >= percent * all shingles`` of the two. A class
    is the documents with one set, named by its smallest key; a component is named by the smallest
    key that can be reached. Null and empty texts have no shingles and are linked with nothing. Rows
    with one key are one document. A row with a null key takes no part: its names are null.
    """
    work = _Work(docs)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # as text, a null key doesn't turn the whole numbers beside it into floats
    sketch = work.kept(
        rows.withColumn("key", F.col("key").cast("string"))
        .mapInPandas(
            _sketch(words, values),
            "key string, n_shingles long, left long, right long, signature array<int>",
        )
        .withColumn("key", F.col("key").cast("long")),
        "sketch",
    )
    named = work.kept(
        sketch.filter("key is not null and left is not null")
        .groupBy("left", "right")
        .agg(F.min("key").alias("id")),
        "classes",
    )
    # one row a class: that of its smallest key
    classes = work.kept(
        sketch.join(
            named.select(F.col("id"), F.col("left").alias("_l"), F.col("right").alias("_r")),
            (F.col("key") == F.col("id")) & (F.col("left") == F.col("_l")) & (F.col("right") == F.col("_r")),
        )
        .select("id", "signature")
        .dropDuplicates(["id"]),
        "signatures",
    )
    regions = work.kept(_regions(classes, trees, values), "regions")
    shared = work.kept(
        regions.groupBy(F.col("region").alias("r"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        .filter("n > 1"),
        "shared",
    )
    members = work.kept(
        regions.join(shared, F.col("region") == F.col("r")).select(
            "region", "tree", "id", "first", "n"
        ),
        "members",
    )
    # The full sets of all classes that are in a region with others, once: texts pass through one
    # shuffle, keyed by the class, whatever the size of the list of classes.
    met = members.select(F.col("id").alias("_met")).distinct().hint("merge")
    sets = work.kept(
        rows.withColumnRenamed("key", "id")
        .join(met, F.col("id") == F.col("_met"), "left_semi")
        .dropDuplicates(["id"])
        .mapInPandas(_sets(words), "id long, set binary"),
        "sets",
    )
    # every member with its region's first; the one a member meets most often is tried at once
    stars = work.kept(
        members.filter("id <> first").groupBy("id", "first").agg(F.count(F.lit(1)).alias("times")),
        "stars",
    )
    share = percent / 100
    least = max(0.0, share - _MARGIN * float(np.sqrt(share * (1 - share) / values)))
    best = (
        stars.groupBy("id")
        .agg(F.max(F.struct("times", (-F.col("first")).alias("first"))).alias("best"))
        .select(F.col("id").alias("a"), (-F.col("best.first")).alias("b"))
    )
    tried = work.kept(_near(best, classes, least), "tried")
    links = work.kept(_confirmed(tried, sets, percent), "links")
    group = work.kept(components(links, work), "groups")

    def linked_too(pairs: DataFrame) -> None:
        """Test the pairs that are in different groups and were not tested before."""
        nonlocal links, group, tried
        new = _apart(pairs, group).join(
            tried.select(F.col("a").alias("ta"), F.col("b").alias("tb")),
            (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")),
            "left_anti",
        )
        near = work.kept(_near(new, classes, least), "tried")
        more = work.kept(_confirmed(near, sets, percent), "links")
        tried = tried.union(near)
        if not more.isEmpty():
            links = links.union(more)
            group = work.kept(components(links, work), "groups")

    # neighbours in the trees' orders, then what is still apart: members of one region
    linked_too(work.kept(_neighbours(members, classes), "neighbours"))
    linked_too(
        stars.select(F.col("id").alias("a"), F.col("first").alias("b"))
        .union(_cross_pairs(
                members, group, classes, sets, percent, trees, values, work
            ))
        .distinct()
    )

    placed = work.kept(
        named.join(group.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").select(
            F.col("left").alias("_l"), F.col("right").alias("_r"), "id", F.coalesce("root", "id").alias("root")
        ),
        "placed",
    )
    return sketch.join(
        placed,
        (F.col("left") == F.col("_l")) & (F.col("right") == F.col("_r")) & F.col("key").isNotNull(),
        "left",
    ).select(
        F.col("key").alias(key),
        "n_shingles",
        F.coalesce("id", "key").alias("class_id"),
        F.coalesce("root", "key").alias("component_id"),
    )


def _cross_pairs(
    members: DataFrame,
    group: DataFrame,
    classes: DataFrame,
    sets: DataFrame,
    percent: int,
    trees: int,
    values: int,
    work: _Work,
) -> DataFrame:
    """Pairs of one region and different groups, at the region's own depth.

    Reading on in a large region's order finds the pairs that agree further, but a pair near the
    threshold may part there. The members of large regions are therefore joined on rare shingles,
    which finds every pair of them that can reach the threshold.
    """
    grouped = work.kept(_across(members.select("region", "tree", "id"), group), "grouped")
    found, least, crowded = None, 3, None
    for depth in (*DEEPER, None):
        # the pair in a first region of two is one with the first member
        regions = work.kept(_open_regions(grouped, least), "open")
        inside = grouped.join(regions, F.col("region") == F.col("r"))
        large = F.col("across") > F.col("n") * LARGE
        pairs = _pairs_across(inside.filter(~large).select("region", "id", "group"))
        found = pairs if found is None else found.union(pairs)
        if regions.filter(large).isEmpty():
            break
        standing = work.kept(inside.filter(large).select("id", "tree", "group"), "large")
        if crowded is None:
            crowded = standing.select("id", "group").distinct()
        if depth is None:
            break
        deeper = F.array(*[_prefix(t, depth, values) for t in range(trees)])
        grouped = work.kept(
            standing.join(classes.withColumnRenamed("id", "_c"), F.col("id") == F.col("_c")).select(
                "id", "tree", "group", deeper[F.col("tree")].alias("region")
            ),
            "grouped",
        )
        least = 2
    if crowded is not None:
        found = found.union(_rare_pairs(crowded, sets, percent, work))
    return found


def _shingle_rows(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
    for frame in frames:
        sets = [np.frombuffer(bits, dtype=np.int64) for bits in frame["set"]]
        sizes = [len(s) for s in sets]
        yield pd.DataFrame(
            {
                "id": np.repeat(frame["id"].to_numpy(), sizes),
                "group": np.repeat(frame["group"].to_numpy(), sizes),
                "size": np.repeat(np.array(sizes, dtype=np.int64), sizes),
                "shingle": np.concatenate([np.zeros(0, dtype=np.int64), *sets]),
            }
        )


def _rare_pairs(crowded: DataFrame, sets: DataFrame, percent: int, work: _Work) -> DataFrame:
    """Every pair of ``crowded`` (``id, group``) that can reach the threshold, in different groups.

    Two sets that are similar enough share one of the rarest ``size - ceil(size * percent / 100) +
    1`` shingles of either, under any one order; rarest first keeps common passages out of them.
    """
    wanted = work.kept(crowded, "crowded")
    rows = work.kept(
        sets.join(wanted.withColumnRenamed("id", "_w"), F.col("id") == F.col("_w"))
        .select("id", "group", "set")
        .mapInPandas(_shingle_rows, "id long, group long, size long, shingle long"),
        "shingles",
    )
    often = rows.groupBy(F.col("shingle").alias("_s")).agg(F.count(F.lit(1)).alias("often"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("often", "shingle"))
    rare = work.kept(
        rows.join(often, F.col("shingle") == F.col("_s"))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1)
        .filter("often > 1")
        .select("shingle", "id", "group", "rank", "size"),
        "rare",
    )

    def possible(rank: Column, size: Column, least_rank: Column, low: Column, high: Column) -> Column:
        """If this is the first shingle two sets share, so many can follow it in both."""
        rest = F.least(size - rank, high - least_rank) + 1
        return (rest * (100 + percent) >= percent * (size + low)) & (high * 100 >= size * percent) & (
            size * 100 >= low * percent
        )

    groups = rare.groupBy(F.col("shingle").alias("_s"), F.col("group").alias("_other")).agg(
        F.min("rank").alias("_rank"), F.min("size").alias("_low"), F.max("size").alias("_high")
    )
    meeting = rare.join(
        groups,
        (F.col("shingle") == F.col("_s"))
        & (F.col("group") > F.col("_other"))
        & possible(F.col("rank"), F.col("size"), F.col("_rank"), F.col("_low"), F.col("_high")),
    ).select("shingle", "id", "rank", "size", "_other")
    partners = rare.select(
        F.col("shingle").alias("_s"),
        F.col("group").alias("_g"),
        F.col("id").alias("_id"),
        F.col("rank").alias("_r"),
        F.col("size").alias("_n"),
    )
    return meeting.join(
        partners,
        (F.col("shingle") == F.col("_s"))
        & (F.col("_other") == F.col("_g"))
        & possible(F.col("rank"), F.col("size"), F.col("_r"), F.col("_n"), F.col("_n")),
    ).select(F.greatest("id", "_id").alias("a"), F.least("id", "_id").alias("b"))


def _pairs_across(members: DataFrame) -> DataFrame:
    """Pairs of one region and different groups. Members meet the region's other groups first, so
    the work follows the pairs that come out, not the square of a region's largest group."""
    groups = members.select(
        F.col("region").alias("_r"), F.col("group").alias("_other")
    ).distinct()
    wanted = members.join(
        groups, (F.col("region") == F.col("_r")) & (F.col("group") > F.col("_other"))
    ).select("region", F.col("id").alias("a"), "_other")
    partners = members.select(
        F.col("region").alias("_r"), F.col("group").alias("_g"), F.col("id").alias("b")
    )
    return wanted.join(
        partners, (F.col("region") == F.col("_r")) & (F.col("_other") == F.col("_g"))
    ).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def kept_documents(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the near-duplicates: of each component the row with the smallest key stays.

    Rows that repeat a kept key stay once; rows with a null key all stay.
    """
    work = _Work(docs)
    marks = work.kept(
        near_duplicates(docs, key, **options).select(
            F.col(key).alias("_k"), (F.col(key) == F.col("component_id")).alias("_stays")
        ),
        "marks",
    )
    # keys that don't simply stay: dropped ones, and kept ones that several rows have
    special = work.kept(
        marks.filter("_k is not null")
        .groupBy("_k")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_stays").alias("_stays"))
        .filter("_n > 1 or not _stays"),
        "special",
    )
    same = docs[key] == special["_k"]
    plain = docs.join(special, same, "left_anti")
    repeated = docs.join(special.filter("_stays"), same, "left_semi")
    columns = docs.columns
    mark = "_one_of_key"
    while mark in columns:
        mark += "_"
    once = Window.partitionBy(key).orderBy(*[F.col(c) for c in columns if c != key])
    first = repeated.withColumn(mark, F.row_number().over(once)).filter(F.col(mark) == 1)
    return plain.union(first.select(*columns))
