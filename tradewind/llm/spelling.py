"""Spelling variants: words that differ by one letter, found by a frequency-vector trie.

A word's vector counts its letters in fixed groups, and a trie arranges words by one count after the
other. One edit takes at most one letter from a group and brings at most one to another, so the words
near a word lie at leaves that a depth-first search reaches on a budget of one surplus and one deficit.
Leaf words are verified on their letters; within a leaf they are looked up by their first and by their
last half, one of which an edit leaves whole.

The trie's top is walked by Spark: a region is a node, and a word is sent to the regions its budget
reaches, so no task holds the trie. A region with more than ``REGION`` words is taken apart further
down, and a single leaf with more, all of whose words have the same counts, is dealt out to several
tasks. What comes back per word and region is a count and the best partner, never pairs.
"""

from collections.abc import Iterator
from math import ceil, log2, log10

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.vectext import mix, powers
from tradewind.sinks.shared import shared_dir

# fixed values: the runs, and the letters that are made small
RUN = "[A-Za-zÀ-ÿ]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAST_LENGTH = 7
LEAST_COUNT = 2
FACTOR = 10
DROP_EVERY = 31

# letters of each level's group; the last level takes all others
GROUPS = ("e", "n", "t", "a", "i", "o", "r", "s", "hj", "lkz", "udy", "cmw", "gpbfvqx")
LEVELS = len(GROUPS) + 1
# levels of a region: the first, and what is tried next while it holds too many words
DEPTHS = (3, 6, 9, LEVELS)
# most words of a region's trie; per so many words the driver holds at most one region's name
REGION = 50_000
# search states, and letters of candidates, that are held at once
STATES, LETTERS = 1 << 18, 1 << 22

_GROUP = np.full(256, LEVELS - 1, dtype=np.int64)
for _level, _letters in enumerate(GROUPS):
    _GROUP[[ord(c) for c in _letters]] = _level
_BASE = 0x9E3779B97F4A7C15 | 1
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _small(word: Column) -> Column:
    return F.translate(word, CAPITALS, SMALL)


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` of every run in the texts that is long enough, after its letter was dropped.

    Runs are lower-cased from A to Z only. Where ``DROP_EVERY`` divides the crc32 h of
    ``key:run``, the run loses its letter h modulo its length. A null key counts as empty text.
    """
    # greedy from the first letter of a run: the whole run, if it is long enough
    runs = F.regexp_extract_all(F.col(text), F.lit(f"({RUN}{{{LEAST_LENGTH},}})"), F.lit(1))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    each = docs.select(name.alias("name"), F.explode(runs).alias("run")).withColumn("run", _small("run"))
    h = F.crc32(F.concat(F.col("name"), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(
        F.substring(F.col("run"), F.lit(1), at),
        F.substring(F.col("run"), at + 2, F.length("run")),
    )
    word = F.when(F.pmod(h, F.lit(DROP_EVERY)) == 0, cut).otherwise(F.col("run"))
    return each.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)


def vocabulary_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words that occur at least ``LEAST_COUNT`` times in all texts."""
    counted = occurrences(docs, key, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


class _Words:
    """Words as one array of Latin-1 bytes, with their vectors and running hashes."""

    def __init__(self, words: "list[str]"):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.at = np.concatenate([[0], np.cumsum(self.length)])
        self.data = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        row = np.repeat(np.arange(len(words)), self.length)
        counts = np.bincount(row * LEVELS + _GROUP[self.data], minlength=len(words) * LEVELS)
        self.vectors = counts.reshape(-1, LEVELS)

    def hashes(self, of: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the letters start..end of the words ``of``; equal letters, equal hashes."""
        if not hasattr(self, "sums"):
            self.down = powers(pow(_BASE, -1, 1 << 64), len(self.data) + 1)
            self.sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_VALUE[self.data] * powers(_BASE, len(self.data) + 1)[:-1], out=self.sums[1:])
        a, b = self.at[of] + start, self.at[of] + end
        return mix((self.sums[b] - self.sums[a]) * self.down[a])


class Trie:
    """Words arranged by their group counts, level by level.

    A level's nodes are numbered in order; ``keys[level]`` has each node's parent and count in one
    number, ascending, so a child is found by a binary search.
    """

    def __init__(self, words: "list[str]"):
        words = _Words(words)
        order = np.lexsort(words.vectors.T[::-1])
        vectors = words.vectors[order]
        self.wide = np.int64(int(vectors.max(initial=0)) + 3)
        self.keys, parent = [], np.zeros(len(order), dtype=np.int64)
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        for level in range(LEVELS):
            new[1:] |= vectors[1:, level] != vectors[:-1, level]
            first = np.flatnonzero(new)
            self.keys.append(parent[first] * self.wide + vectors[first, level])
            parent = np.cumsum(new) - 1
        self.order, self.words = order, words
        leaf = np.empty(len(order), dtype=np.int64)
        leaf[order] = parent
        # half of a word one shorter than the leaf's: an edit leaves the first or the last one whole
        half = (words.length - 1) // 2
        every = np.arange(len(order))
        self.half = np.zeros(len(self.keys[-1]), dtype=np.int64)
        self.half[leaf] = half
        self.size = np.zeros(len(self.keys[-1]), dtype=np.int64)
        self.size[leaf] = words.length
        self.firsts = self._index(leaf, words.hashes(every, 0 * half, half))
        self.lasts = self._index(leaf, words.hashes(every, words.length - half, words.length))

    @staticmethod
    def _key(leaf: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return mix(hashes + leaf.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    def _index(self, leaf: np.ndarray, hashes: np.ndarray) -> "tuple[np.ndarray, np.ndarray]":
        key = self._key(leaf, hashes)
        order = np.argsort(key, kind="stable")
        return key[order], order

    def leaves(self, vectors: np.ndarray) -> "Iterator[tuple[np.ndarray, np.ndarray]]":
        """(row of ``vectors``, leaf) of every leaf within the budget, in blocks, depth first."""
        n = len(vectors)
        spent = np.zeros(n, dtype=bool)
        stack = [(0, np.arange(n), np.zeros(n, dtype=np.int64), spent, spent)]
        while stack:
            level, row, node, up, down = stack.pop()
            if level == LEVELS:
                yield row, node
                continue
            if len(row) > STATES:
                half = len(row) // 2
                stack += [(level, *(x[part] for x in (row, node, up, down)))
                          for part in (slice(half, None), slice(half))]
                continue
            count, found = vectors[row, level], []
            for step, able in ((0, None), (1, ~up), (-1, ~down)):
                of = np.flatnonzero(able) if step else np.arange(len(row))
                wanted = count[of] + step
                key = node[of] * self.wide + wanted
                child = np.searchsorted(self.keys[level], key)
                child[child == len(self.keys[level])] = 0
                hit = (self.keys[level][child] == key) & (wanted >= 0) & (wanted < self.wide)
                of = of[hit]
                found.append((row[of], child[hit], up[of] | (step == 1), down[of] | (step == -1)))
            row, *rest = map(np.concatenate, zip(*found))
            if len(row):
                stack.append((level + 1, row, *rest))

    def near(self, asked: _Words) -> "Iterator[tuple[np.ndarray, np.ndarray]]":
        """(asked word, word of the trie) of all pairs that differ by exactly one edit, in blocks."""
        for row, leaf in self.leaves(asked.vectors):
            half, length = self.half[leaf], asked.length[row]
            heads = asked.hashes(row, 0 * half, half)
            tails = asked.hashes(row, length - half, length)
            for by, (keys, order), hashes in (
                ("first", self.firsts, heads),
                ("last", self.lasts, tails),
            ):
                key = self._key(leaf, hashes)
                begin = np.searchsorted(keys, key)
                n = np.searchsorted(keys, key, "right") - begin
                for pick in _portions(n, length + 1):
                    a = np.repeat(row[pick], n[pick])
                    step = np.arange(len(a)) - np.repeat(np.cumsum(n[pick]) - n[pick], n[pick])
                    b = order[np.repeat(begin[pick], n[pick]) + step]
                    if by == "last":
                        # those with an equal first half were found by that
                        h = np.repeat(half[pick], n[pick])
                        other = _common(asked, a, self.words, b, h, back=False) < h
                        a, b = a[other], b[other]
                    fits = one_edit(asked, a, self.words, b)
                    yield a[fits], b[fits]


def _portions(n: np.ndarray, length: np.ndarray) -> "Iterator[slice]":
    """Consecutive parts of the asked words whose candidates hold about ``LETTERS`` letters."""
    ends = np.cumsum(n * length)
    first = 0
    while first < len(n):
        done = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, done + LETTERS, "right")), first + 1)
        yield slice(first, last)
        first = last


def _common(a: _Words, i: np.ndarray, b: _Words, j: np.ndarray, n: np.ndarray, back: bool) -> np.ndarray:
    """How many of the first (or last) ``n`` letters of the words are equal in a row."""
    row = np.repeat(np.arange(len(i)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    if back:
        same = a.data[a.at[i + 1][row] - 1 - step] == b.data[b.at[j + 1][row] - 1 - step]
    else:
        same = a.data[a.at[i][row] + step] == b.data[b.at[j][row] + step]
    out = n.copy()
    wrong = np.flatnonzero(~same)
    rows, first = np.unique(row[wrong], return_index=True)
    out[rows] = step[wrong[first]]
    return out


def one_edit(a: _Words, i: np.ndarray, b: _Words, j: np.ndarray) -> np.ndarray:
    """Whether a's words i and b's words j differ by exactly one letter put in, left out or replaced."""
    out = np.zeros(len(i), dtype=bool)
    la, lb = a.length[i], b.length[j]
    near = np.flatnonzero(np.abs(la - lb) <= 1)
    i, j, short, long = i[near], j[near], np.minimum(la, lb)[near], np.maximum(la, lb)[near]
    head = _common(a, i, b, j, short, back=False)
    tail = _common(a, i, b, j, short, back=True)
    # one letter of the longer word is in neither; words that are equal share all letters
    out[near] = (head + tail >= long - 1) & ~((head == short) & (short == long))
    return out


def _reached(vector: Column, depth: int) -> Column:
    """Names of the trie's nodes at ``depth`` that the budget reaches from a vector: an array.

    At most one of the first ``depth`` counts is one higher and at most one lower. The moves are
    written out, so that Spark compiles them.
    """
    moves = [
        (up, down) for up in range(-1, depth) for down in range(-1, depth) if up < 0 or up != down
    ]

    def reached(up: int, down: int) -> Column:
        counts = [vector[k] + F.lit((k == up) - (k == down)) for k in range(depth)]
        name = F.concat_ws(".", *[c.cast("string") for c in counts])
        return name if down < 0 else F.when(vector[down] > 0, name)

    return F.array_compact(F.array(*[reached(up, down) for up, down in moves]))


def _name(vector: Column, depth: int) -> Column:
    return F.concat_ws(".", *[vector[k].cast("string") for k in range(depth)])


def _vector(word: Column) -> Column:
    """A word's counts by level."""
    every = "".join(GROUPS)

    def count(letters: str) -> Column:
        return F.length(word) - F.length(F.translate(word, letters, ""))

    return F.array(*[count(g) for g in GROUPS], F.length(word) - count(every))


def _crowded(words: DataFrame, region: int) -> "list[dict[str, int]]":
    """For each depth, the nodes with more than ``region`` words, and how many words they have."""
    out, names = [], []
    for depth in DEPTHS:
        rows = words if not out else words.filter(_name(F.col("vector"), DEPTHS[len(out) - 1]).isin(names))
        found = (
            rows.groupBy(_name(F.col("vector"), depth).alias("name"))
            .agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > region)
            .collect()
        )
        out.append({r["name"]: r["n"] for r in found})
        names = list(out[-1])
        if not names:
            break
    return out


def _visits(words: DataFrame, region: int) -> DataFrame:
    """``region, part, word, n, home``: each word in the regions it reaches, its own one included.

    A region's words are its members where ``home``, the others only ask. In a leaf that is dealt
    out each member is in one part, and whoever asks goes to all parts.
    """
    crowded = _crowded(words, region)
    out, vector = [], F.col("vector")
    for k, depth in enumerate(DEPTHS[: len(crowded)]):
        reached = words.select(
            "word", "n", "vector", F.explode(_reached(vector, depth)).alias("region")
        )
        if k:
            # below the crowded nodes of the depth before only
            above = F.substring_index("region", ".", DEPTHS[k - 1])
            reached = reached.filter(above.isin(list(crowded[k - 1])))
        home = F.col("region") == _name(vector, depth)
        if depth < LEVELS:
            rows = reached.filter(~F.col("region").isin(list(crowded[k]))).withColumn("part", F.lit(0))
            rows = rows.withColumn("home", home)
        else:
            pairs = [F.lit(x) for name, n in crowded[k].items() for x in (name, ceil(n / region))]
            parts = F.coalesce(F.create_map(*pairs)[F.col("region")], F.lit(1)) if pairs else F.lit(1)
            own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
            rows = (
                reached.withColumn("parts", parts)
                .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .withColumn("home", home & (F.col("part") == own))
            )
        out.append(rows.select("region", "part", "word", "n", "home"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


_FOUND = "word string, n_near long, form_n long, form string"


def _answers(trie: Trie, counts: np.ndarray, frame: pd.DataFrame) -> pd.DataFrame:
    """Per asking word with partners: how many, and the most frequent, least by letters."""
    asked = _Words(frame["word"].tolist())
    pairs = [(np.zeros(0, np.int64),) * 2, *trie.near(asked)]
    a, b = (np.concatenate(x) for x in zip(*pairs))
    words = np.array(trie.words.words, dtype=object)
    best = pd.DataFrame({"a": a, "form_n": counts[b], "form": words[b]})
    best = best.sort_values(["a", "form_n", "form"], ascending=[True, False, True])
    grouped = best.groupby("a", sort=True)
    out = grouped.first().reset_index()
    out["n_near"] = grouped.size().to_numpy()
    out["word"] = frame["word"].to_numpy()[out["a"]]
    return out[["word", "n_near", "form_n", "form"]]


def _search(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
    """Rows come by region, members first: they make the trie, the rest asks batch by batch."""
    at, members, counts, trie = None, [], [], None
    for frame in frames:
        for here, rows in frame.groupby(["region", "part"], sort=False):
            if here != at:
                at, members, counts, trie = here, [], [], None
            new = rows[rows["home"]]
            members += new["word"].tolist()
            counts += new["n"].tolist()
            asking = rows[rows["asks"]]
            if len(asking) and members:
                if trie is None:
                    trie, known = Trie(members), np.array(counts, dtype=np.int64)
                yield _answers(trie, known, asking)


def near_words(words: DataFrame, region: int = REGION) -> DataFrame:
    """``word, n_near, form_n, form`` of the words that have near words.

    ``words`` has distinct ``word`` and ``n``. ``form`` is the near word of the largest ``n``, and of
    those with the same the first in code-point order.
    """
    vectors = words.withColumn("vector", _vector(F.col("word")))
    visits = _visits(vectors, region)
    # members are listed once to build the trie, and once more among those that ask
    both = F.when(F.col("home"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    rows = visits.withColumn("home", F.explode(both)).withColumn("asks", ~F.col("home"))
    found = (
        rows.repartition("region", "part")
        .sortWithinPartitions("region", "part", F.col("home").desc())
        .mapInPandas(_search, _FOUND)
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: where its forms lead.

    A form occurs at least ``FACTOR`` times as often as its word, so a chain has at most as many
    steps as the largest count has digits, and each round doubles the steps taken.
    """
    most = forms.agg(F.max("form_n")).first()[0]
    steps = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(log10(most) + 1)) if most else 0):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = steps.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")
        )
        steps = _written(steps, "spelling-roots")
    return steps


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: a lost executor costs no recomputation."""
    place = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(place)
    return rows.sparkSession.read.parquet(place)


def variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", region: int = REGION
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the texts.

    A word's form is its most frequent near word if that occurs at least ``FACTOR`` times as often,
    else null; ``root`` is where forms lead, the word itself if it has none. Null and empty texts and
    texts without a long run have no words; repeated rows count as often as they are there; an
    empty table gives no rows. Other columns, whatever their names, are not read.
    """
    words = _written(vocabulary_counts(docs, key, text), "spelling-words")
    near = near_words(words, region).withColumnsRenamed({"form": "best", "form_n": "best_n"})
    told = F.col("best_n") >= FACTOR * F.col("n")
    rows = _written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(told, F.col("best")).alias("form"),
            F.when(told, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(rows.filter(F.col("form").isNotNull()).select("word", "form", "form_n"))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
