"""Near duplicates by n-gram Jaccard similarity: a count-vector R-tree join.

Hashed shingles are dealt into groups; a text is the point of its group counts.  Two
texts share at most the sum of the smaller counts, and every box of an R-tree over the
points bounds that sum for all texts in it.  Pairs that survive are verified exactly.

Random groups make all points alike but those of near copies, so no box over a corpus
prunes.  Trees are therefore built per cluster: texts of similar size are linked texts
only if some group of their shingles is the same in both (there are more groups than a
pair may differ in shingles), so texts that share no group hash need no comparison.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import one_of_each, pieces, texts, utf8, wrapped
from skyledger.llm.graph import components
from skyledger.llm.hashing import Stretches, mix, words
from skyledger.shared import written

#: Coordinates of a point.
GROUPS = 32
#: Points of a leaf, and of a tree (about): larger clusters are several trees.
LEAF = 16
TREE = 1024
#: Sizes of one band of a large cluster differ by this ratio at most.
BAND = 1.05
#: Size classes that one way to cut sets into groups serves, besides the next one.
CLASSES = 3
#: Groups beyond those that a pair may differ in, at least, and as a share: a text leaves
#: its emptiest groups out.  An empty group is no group: a linked pair escapes if all its
#: other groups differ, which has a chance below 1e-6 for sets of ten and far less for
#: larger ones.
SPARE, SPARE_SHARE = 6, 0.5
#: The most frequent shingles weigh nothing: so many at most, and those of more than
#: ``OFTEN`` texts only.  Stretches of so many shingles are counted by one task.
COMMON, OFTEN, COUNTED = 200_000, 8, 4_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Rule:
    """Two sets link when ``100 * intersection >= percent * union``."""

    def __init__(self, percent: int):
        self.percent = percent
        # Sizes of linked sets differ by this ratio at most: they are in the same size
        # class or in adjacent ones.
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            last = self.bounds[-1]
            self.bounds.append(max(last + 1, -(-last * 100 // percent)))

    def size_class(self, n: int) -> int:
        return int(np.searchsorted(self.bounds, n, "right")) - 1

    def differing(self, total: int) -> int:
        """In how many elements linked sets of this total size may differ at most."""
        return total * (100 - self.percent) // (100 + self.percent)

    def most_differing(self, n: int) -> int:
        """In how many elements a set of ``n`` may differ from any set that it links with."""
        return self.differing(n + n * 100 // self.percent)

    def schemes(self, n: int) -> list[int]:
        """Numbers of the ways to cut a set of this size into groups.  One serves ``CLASSES``
        size classes and the next, so linked sets have one in common."""
        own, rest = divmod(self.size_class(n), CLASSES)
        return [own] if rest or not own else [own - 1, own]

    def groups(self, scheme: int) -> int:
        """Groups of a scheme; 0 if its sets must be equal to link."""
        most = self.most_differing(self.bounds[CLASSES * (scheme + 1) + 1] - 1)
        return most + 1 + max(SPARE, int(SPARE_SHARE * most)) if most else 0

    def links(self, shared, total):
        return shared * (100 + self.percent) >= self.percent * total


def shingle_sets(data: np.ndarray, starts: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``n`` words, A-Z lower-cased.  A
    text with fewer words has one of all its words; one without words has none."""
    data = _LOWER[data]
    first, last, before = words(data, starts)
    word = Stretches(data).hash(first, last)
    rolled = mix(word + np.uint64(n))
    for k in range(1, n):
        if len(word) > k:
            rolled[: len(word) - k] = mix(rolled[: len(word) - k] ^ word[k:])
    for a, b in itertools.pairwise(before.tolist()):
        if b - a >= n:
            own = np.sort(rolled[a : b - n + 1])
            yield own[_firsts(own)]
        elif b > a:
            short = np.uint64(b - a)
            for w in word[a:b]:
                short = mix(np.array([short]) ^ w)[0]
            yield np.array([short], np.uint64)
        else:
            yield np.empty(0, np.uint64)


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each of the sorted values comes first."""
    new = np.ones(len(sorted_values), bool)
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=new[1:])
    return np.flatnonzero(new)


def identity(shingles: np.ndarray) -> int:
    """A set's 64-bit name, the same for equal sets."""
    named = mix(mix(shingles).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(shingles)))
    return int(named.view(np.int64)[0])


def group_hashes(shingles: np.ndarray, rule: Rule, common: np.ndarray) -> np.ndarray:
    """Hashes of the set's weightiest groups, in each of its schemes.

    A group weighs as many shingles as it has that are not ``common`` (sorted); what weighs
    the same is ordered by its hash.  With D shingles that may differ from any linked set, a
    set tells D + 1 groups.  Of two linked sets, take the one whose last group told comes
    earlier in that order: one of its groups told is the same in the other, and told there.
    """
    most = rule.most_differing(len(shingles))
    if not most:
        return np.empty(0, np.uint64)
    spread = mix(shingles ^ np.uint64(0x5BD1E995))
    rare = np.ones(len(shingles), np.int64)
    if len(common):
        at = np.searchsorted(common, shingles)
        at[at == len(common)] = 0
        rare[common[at] == shingles] = 0
    found = []
    for scheme in rule.schemes(len(shingles)):
        k = rule.groups(scheme)
        group = (spread >> np.uint64(20)) % np.uint64(k)
        # Numbers of 16 bits are sorted by their digits.
        order = np.argsort(group.astype(np.uint16) if k <= 1 << 16 else group, kind="stable")
        group = group[order]
        first = _firsts(group)
        content = np.add.reduceat(spread[order], first)
        told = mix(content ^ mix(group[first] + np.uint64(scheme << 32)))
        if len(told) > most + 1:
            weight = np.add.reduceat(rare[order], first)
            told = told[np.lexsort((told, weight))[-most - 1 :]]
        found.append(told)
    return np.concatenate(found)


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key that finds them again: the id, or a hash of the text without one."""
    return texts(docs).withColumn("key", F.coalesce("doc_id", F.xxhash64("text")))


def _points(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, key, member (its set's name, null without words) and n_shingles of every
    row; and, with shingle not null, how many texts of a stretch of the input have it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for piece in pieces(batch):
                sets = list(shingle_sets(*utf8(piece.column("text")), n))
                names = [identity(s) if len(s) else None for s in sets]
                yield told(
                    doc_id=piece.column("doc_id"), key=piece.column("key"),
                    member=pa.array(names, pa.int64()), n_shingles=pa.array(list(map(len, sets)), pa.int64()),
                )
                held += sets
                if sum(map(len, held)) > COUNTED:
                    yield frequent(held)
                    held = []
        yield frequent(held)

    def frequent(sets: list[np.ndarray]) -> pa.RecordBatch:
        shingle, times = np.unique(
            np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True
        )
        many = times > 2
        return told(shingle=pa.array(shingle[many].view(np.int64)), times=pa.array(times[many]))

    def told(**columns: pa.Array) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        arrays = [columns.get(c, pa.nulls(size, pa.int64())) for c in names_of]
        return pa.RecordBatch.from_arrays(arrays, names_of)

    names_of = ["doc_id", "key", "member", "n_shingles", "shingle", "times"]
    return _keyed(docs).mapInArrow(run, ", ".join(f"{c} long" for c in names_of))


def _common(points: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles that most texts have, as far as stretches of the input
    show it.  They only steer which groups are told; any list gives the same links."""
    seen = points.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
    seen = written(seen.filter(F.col("times") > OFTEN), "frequent-shingles")
    step = F.floor(F.log2(F.col("times").cast("double")) * 64)
    lowest, taken = None, 0
    # A row for each step of a sixty-fourth octave: a few thousand whatever the corpus.
    for row in sorted(seen.groupBy(step.alias("step")).count().collect(), reverse=True):
        if taken + row["count"] > COMMON:
            break
        lowest, taken = row["step"], taken + row["count"]
    rows = [] if lowest is None else seen.filter(step >= lowest).select("shingle").collect()
    return np.sort(np.array([r["shingle"] for r in rows], np.int64).view(np.uint64))


def _group_rows(docs: DataFrame, n: int, rule: Rule, common: np.ndarray) -> DataFrame:
    """Group hash and member, for every distinct set of each stretch of the input."""
    held = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sets = {identity(s): s for s in shingle_sets(*utf8(piece.column("text")), n) if len(s)}
                hashes = [group_hashes(s, rule, held.value) for s in sets.values()]
                members = np.repeat(np.fromiter(sets, np.int64, len(sets)), list(map(len, hashes)))
                grouped = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grouped.view(np.int64)), pa.array(members)], ["grp", "member"]
                )

    return texts(docs).mapInArrow(run, "grp long, member long")


def _stars(grouped: DataFrame) -> DataFrame:
    """grp, member and hub of all sets that share a group hash with another set: the hub
    is the smallest member, the others have a row each.

    Most hashes have one member.  Sorted rows go by in batches, of which the last hash and
    its hub are kept: a window would begin anew for every hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            grp, member = (batch.column(c).to_numpy() for c in ("grp", "member"))
            if not len(grp):
                continue
            first = _firsts(grp)
            hub = np.repeat(member[first], np.diff(np.append(first, len(grp))))
            if last is not None and grp[0] == last[0]:
                hub[: first[1] if len(first) > 1 else len(grp)] = last[1]
            last = grp[-1], hub[-1]
            others = np.flatnonzero(member != hub)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[others]) for x in (grp, member, hub)], ["grp", "member", "hub"]
            )

    same = grouped.select("grp", "member").repartition("grp").sortWithinPartitions("grp", "member")
    return written(same.mapInArrow(run, "grp long, member long, hub long"), "stars")


def _planned(points: DataFrame, clusters: DataFrame) -> DataFrame:
    """key, member, root, band, part and large of one row for every set in a cluster: the
    tree it belongs to.  A large cluster is cut by size, sets of one size by chance."""
    one = points.groupBy("member").agg(F.min("key").alias("key"), F.first("n_shingles").alias("n"))
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(BAND))
    banded = one.join(clusters, one["member"] == clusters["node"]).withColumn("band", band)
    banded = written(banded.drop("node"), "cluster-members")
    size = banded.groupBy("root").agg(F.count("*").alias("cluster_size"))
    fill = banded.groupBy("root", "band").agg(F.count("*").alias("band_size"))
    large = F.col("cluster_size") > TREE
    part = F.pmod(F.xxhash64("member"), F.ceil(F.col("band_size") / TREE))
    return (
        banded.join(size, "root")
        .join(fill, ["root", "band"])
        .select(
            "key",
            "member",
            "root",
            F.when(large, F.col("band")).otherwise(F.lit(-1).cast("long")).alias("band"),
            F.when(large, part).otherwise(F.lit(0).cast("long")).alias("part"),
            large.alias("large"),
        )
    )


_PLACE = ["root", "band", "part", "large", "member"]


def _trees(docs: DataFrame, planned: DataFrame, n: int) -> DataFrame:
    """The planned rows with their shingles, read from the texts again."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sets = list(shingle_sets(*utf8(piece.column("text")), n))
                members = piece.column("member").to_pylist()
                # Rows may repeat an id, with this text or another.
                hit = list({m: k for k, m in enumerate(members) if len(sets[k]) and identity(sets[k]) == m}.values())
                place = [piece.column(c).take(pa.array(hit, pa.int64())) for c in _PLACE]
                yield pa.RecordBatch.from_arrays(
                    [*place, pa.array([sets[k].tobytes() for k in hit], pa.binary())],
                    [*_PLACE, "shingles"],
                )

    # What is wanted grows with the input: it is never broadcast, small as it may be.
    told = _keyed(docs).join(planned.hint("merge"), "key").select("text", *_PLACE)
    schema = "root long, band long, part long, large boolean, member long, shingles binary"
    return written(told.mapInArrow(run, schema), "trees")


class CountTree:
    """R-tree over group counts, with the component of every point."""

    def __init__(self, sets: list[np.ndarray], component: np.ndarray | None = None):
        points = np.stack([counts(s) for s in sets])
        self._order: list[int] = []
        self._nodes: list[tuple] = []  # low, high, upper corner, least size, children
        self._size = np.array([len(s) for s in sets])
        self._root = self._build(points, np.arange(len(sets)))
        self._order = np.array(self._order)
        self._sets = [sets[k] for k in self._order]
        self._points, self._size = points[self._order], self._size[self._order]
        of = np.arange(len(sets)) if component is None else component
        self.component = of[self._order]

    def _build(self, points: np.ndarray, at: np.ndarray) -> int:
        low = len(self._order)
        children = ()
        if len(at) > LEAF:
            own = points[at]
            widest = int(np.argmax(own.max(0) - own.min(0)))
            at = at[np.argsort(own[:, widest], kind="stable")]
            half = len(at) // 2
            children = (self._build(points, at[:half]), self._build(points, at[half:]))
        else:
            self._order += at.tolist()
        corner = points[at].max(0)
        self._nodes.append((low, low + len(at), corner, int(self._size[at].min()), children))
        return len(self._nodes) - 1

    def partners(self, shingles: np.ndarray, component: int, rule: Rule) -> Iterator[int]:
        """Points of other components that link with a set, one of each component."""
        point, n, seen = counts(shingles), len(shingles), {component}
        stack = [self._root]
        while stack:
            low, high, corner, least, children = self._nodes[stack.pop()]
            most = int(np.minimum(point, corner).sum())
            if not rule.links(most, n + least):
                continue
            of = self.component[low:high]
            if of.min() == of.max() and of[0] in seen:
                continue
            if children:
                stack += children
                continue
            bound = np.minimum(point, self._points[low:high]).sum(1)
            for k in low + np.flatnonzero(rule.links(bound, n + self._size[low:high])):
                other = self.component[k]
                if other not in seen:
                    shared = _shared(shingles, self._sets[k])
                    if rule.links(shared, n + self._size[k]):
                        seen.add(other)
                        yield int(k)

    def join(self, rule: Rule) -> np.ndarray:
        """Components of all links among the points, in the order they were given."""
        for k in range(len(self._sets)):
            for other in list(self.partners(self._sets[k], self.component[k], rule)):
                a, b = self.component[k], self.component[other]
                self.component[self.component == max(a, b)] = min(a, b)
        joined = np.empty_like(self.component)
        joined[self._order] = self.component
        return joined

    def given(self, k: int) -> int:
        """Where the k-th point stood when it was given."""
        return int(self._order[k])


def counts(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]


def _join_group(rule: Rule):
    """member and hub (another member of its component, or itself) of one tree's sets."""

    def run(table: pa.Table) -> pa.Table:
        member, first = np.unique(table.column("member").to_numpy(), return_index=True)
        joined = CountTree(_sets_of(table.take(pa.array(first)))).join(rule)
        return pa.table({"member": member, "hub": member[joined]})

    return run


def _join_guests(rule: Rule):
    """Links of sets that visit a tree (``own`` false) with its points of other labels."""

    def run(table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy(zero_copy_only=False).astype(bool)
        member, label = table.column("member").to_numpy(), table.column("label").to_numpy()
        sets = _sets_of(table)
        home, links = np.flatnonzero(own), []
        if len(home):
            tree = CountTree([sets[k] for k in home], label[home])
            for g in np.flatnonzero(~own):
                for k in tree.partners(sets[g], label[g], rule):
                    links.append((member[g], member[home[tree.given(k)]]))
        pair = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"member": pair[:, 0], "hub": pair[:, 1]})

    return run


_PAIR = "member long, hub long"


def _links(trees: DataFrame, stars: DataFrame, rule: Rule) -> DataFrame:
    """Edges that connect the members of every component."""
    inside = written(
        trees.groupBy("root", "band", "part").applyInArrow(_join_group(rule), _PAIR), "tree-links"
    )
    spread = trees.filter("large")
    if spread.isEmpty():
        return inside.filter("member != hub")
    # Of each component found in a tree one set stands for it: these are joined first.
    several = inside.groupBy("hub").agg(F.count("*").alias("n")).filter("n > 1")
    heads = spread.join(several.select(F.col("hub").alias("member")), "member", "left_semi")
    tables = heads.groupBy("root").agg(F.ceil(F.count("*") / TREE).alias("tables"))
    part = F.pmod(F.xxhash64("member", F.lit(1)), F.col("tables")).alias("part")
    heads = heads.join(tables, "root").select("root", part, "member", "shingles")
    between = heads.groupBy("root", "part")
    between = written(between.applyInArrow(_join_group(rule), _PAIR), "head-links")
    found = inside.unionByName(between).filter("member != hub")
    labels = components(found)
    labelled = spread.join(labels.withColumnRenamed("node", "member"), "member", "left")
    labelled = labelled.select(
        spread["root"], "member", "shingles", "band", "part",
        F.coalesce(labels["root"], F.col("member")).alias("label"),
    )
    labelled = written(labelled, "labelled")
    visits = _visits(labelled, stars)
    if visits.isEmpty():
        return found
    home = ["root", "band", "part"]
    hosts = labelled.join(visits.select(*home).distinct(), home, "left_semi")
    own = hosts.select(*home, "member", "shingles", "label", F.lit(True).alias("own"))
    come = labelled.select("member", "shingles", "label").join(visits, "member")
    come = come.select(*home, "member", "shingles", "label", F.lit(False).alias("own"))
    late = own.unionByName(come).groupBy(*home).applyInArrow(_join_guests(rule), _PAIR)
    return found.unionByName(late)


def _visits(labelled: DataFrame, stars: DataFrame) -> DataFrame:
    """Sets outside their cluster's largest component, and the trees where a set with
    another label shares a group hash with them."""
    slim = written(labelled.drop("shingles"), "labels")
    count = slim.groupBy("root", "label").agg(F.count("*").alias("n"))
    largest = count.groupBy("root").agg(F.max("n").alias("n")).join(count, ["root", "n"])
    largest = largest.groupBy("root").agg(F.min("label").alias("largest"))
    guests = slim.join(largest, "root").filter("label != largest").select("member", "label")
    hubs = stars.select("grp", F.col("hub").alias("member")).distinct()
    shared = written(
        stars.select("grp", "member").distinct().unionByName(hubs).join(slim, "member"), "shared"
    )
    # Trees by group hash; one label alone has nothing for a guest that bears it.
    trees = shared.groupBy("grp", "root", "band", "part").agg(
        F.min("label").alias("least"), F.max("label").alias("most")
    )
    mixed = shared.groupBy("grp").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    mixed = mixed.filter("a != b").select("grp")
    coming = shared.select("grp", "member", "label").join(mixed, "grp", "left_semi")
    coming = coming.join(guests.select("member"), "member", "left_semi")
    met = coming.join(trees, "grp").filter("label != least OR label != most")
    return written(met.select("member", "root", "band", "part").distinct(), "visits")


def join_ngrams(docs: DataFrame, percent: int = 85, words_each: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.  More about them: ``_joined``."""
    return _joined(docs, percent, words_each).drop("key")


def drop_near_copies(docs: DataFrame, percent: int = 80, words_each: int = 5) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns, whatever their names.

    The row with the smallest doc_id stays, a null losing to any other; of rows that repeat
    it, one.  Texts without words (or null) link with nothing, so all but repeated rows
    stay.  No rows give no rows.
    """
    # Rows go by a hash of id and text here, as one id may have several texts.
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.xxhash64(F.coalesce(doc_id, F.lit(0)), doc_id.isNull(), text)
    found = _joined(docs.select(name.alias("doc_id"), text.alias("text")), percent, words_each)
    found = found.select(F.col("doc_id").alias("name"), "component_id").distinct()
    ids = docs.select(name.alias("name"), doc_id.isNull().alias("unnamed"), doc_id.alias("id")).distinct()
    least = F.min(F.struct("unnamed", "id", "name")).alias("least")
    first = found.join(ids, "name").groupBy("component_id").agg(least)
    stay = first.select(F.col("least.name").alias("name"))
    return one_of_each(wrapped(docs, name=name), stay, "name")


def _joined(docs: DataFrame, percent: int, words_each: int) -> DataFrame:
    """key, doc_id, n_shingles, component_id.

    Texts link when their sets of distinct shingles have ``100 * intersection >= percent *
    union``; component_id is the smallest doc_id reachable.  A text without words (or
    null) has the empty set and no links.  Repeated rows are equal texts; a null doc_id
    takes part but never names a component, so a component of such rows alone has none.
    No rows give no rows; other columns are left.  Shingles and sets are compared by
    64-bit hashes.
    """
    rule = Rule(percent)
    docs = texts(docs)
    points = written(_points(docs, words_each), "points")
    stars = _stars(_group_rows(docs, words_each, rule, _common(points)))
    points = points.filter("shingle IS NULL")
    clusters = components(stars.select("member", "hub").distinct())
    planned = _planned(points.filter("member IS NOT NULL"), clusters)
    roots = components(_links(_trees(docs, planned, words_each), stars, rule))
    label = F.coalesce("root", "member").alias("label")
    labelled = points.join(roots, points["member"] == roots["node"], "left").select(
        "key", "doc_id", "n_shingles", label
    )
    labelled = written(labelled, "labelled")
    least = labelled.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    alone = labelled.filter("label IS NULL").select(
        "key", "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    linked = labelled.join(least, "label").select(
        "key", "doc_id", "n_shingles", F.col("least").alias("component_id")
    )
    return linked.unionByName(alone)
