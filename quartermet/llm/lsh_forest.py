"""Near-duplicate documents with an LSH forest over MinHash signatures.

A document's set holds its distinct shingles of five words (A-Z as a-z; fewer
words are one shingle).  Equal sets form a class; everything after works on
classes, so exact copies cost nothing.  Each of ``TREES`` trees orders the classes
by a label of ``DEPTH`` MinHashes.  Classes with a common prefix of ``LEAST``
labels form a region; one of more than ``REGION`` classes is cut deeper, each class
at the shortest prefix that at most ``REGION`` share.  A class's candidates are its
neighbours in the sorted order of its region, ``NEAR`` on either side: first those
with the longest common prefix, of equal ones those whose sketches of 128 bytes
agree most.  Pairs whose sketches agree in less than ``LIKELY`` are left out (a link
at the threshold lies four standard errors above: 1 in 100,000 of them is lost).

Candidates are confirmed on full sets in rounds: first each class with its best
neighbour and the region's centre, the class with most likely neighbours; then, always between
classes not yet connected, more neighbours from a wider stretch of the order; and
at last, for what the order leaves out, all of a region at its shallowest depth.
(Classes of one whole label, if more than ``REGION``, are dealt by chance in the first
rounds, otherwise in each tree and round.)
In the last round the classes outside the region's largest group ask and
all are asked, and each block of those that ask meets each block of those asked in
a task group of its own: at any size all pairs that could still join two groups are
compared, and no task holds more than two blocks.  That round sends no pairs: the
sets of the classes that still have a likely partner in another group go to the
blocks, which compare them there and give the links that join groups.  So a group
of thousands of near copies makes as many rows as it has members; classes that
share labels and are no near copies cost up to the square of their number.

NULL and empty texts, and those of white space, have no words: they are linked with
nothing and are their own group.  Rows that repeat an id stand for themselves;
a NULL id loses against any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, components, joined, kept, mix, small, steps, stored, windows_hash, word_hashes

WORDS = 5
#: Links share so many hundredths of their union.
SIMILAR = 75
TREES, DEPTH, LEAST = 16, 8, 3
#: Most classes of a region that are compared in one piece, and about the most of two blocks.
REGION = 4096
#: Shingles of a block, about (a single class may have more).
SHINGLES = 1 << 21
LIKELY = 0.58
#: Neighbours on either side that a class looks at, times the number it may choose.
NEAR = 8
#: Best partners confirmed for each class in each round; then all.
ROUNDS = (1, 2)
SIGNED = "uid long, doc_id long, n long, k binary, th binary, sig binary"
PAIRS = "a long, b long"
PART = ["key", "x", "y"]
BLOCK = "key long, x long, y long, tree int, rep long, component long, sig binary, other boolean, asks boolean, asked boolean"


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of a document's word hashes."""
    if not len(words):
        return words
    return np.unique(windows_hash(words, min(WORDS, len(words))))


def sets_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    for a, b in steps(texts):
        blob, begins = joined(texts[a:b])
        starts, _, hashes = word_hashes(blob, True)
        cuts = np.searchsorted(starts, begins)
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield shingles(hashes[low:high])


def set_key(own: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    one, two = mix(own), mix(own ^ np.uint64(0xA5A5A5A55A5A5A5A))
    return (np.array([one.sum(), np.bitwise_xor.reduce(two)], "<u8") + np.uint64(len(own))).tobytes()


_FACTORS = np.random.default_rng(77).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)


def signature(own: np.ndarray) -> np.ndarray:
    out = np.empty(len(_FACTORS), np.uint64)
    for i, factor in enumerate(_FACTORS):
        out[i] = (own * factor).min()
    return mix(out)


def signed(docs: DataFrame) -> DataFrame:
    """Each document with the size, key and signature of its set.

    ``uid`` follows the partitions: write the result before it is used twice.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("lsh_forest")
        uid = TaskContext.get().partitionId() << 36
        for batch in small(batches):
            made: list[list] = [[], [], []]
            for own in sets_of(batch.column("text").to_pylist()):
                if len(own):
                    row = (len(own), set_key(own), signature(own).astype(">u4").tobytes())
                else:
                    row = (0, None, None)
                for column, value in zip(made, row, strict=True):
                    column.append(value)
            n, k, sig = made
            yield batch_of(
                SIGNED,
                [np.arange(uid, uid + len(n)), batch.column("doc_id").to_pylist(), n, k,
                 batch.column("th").to_pylist(), sig],
            )
            uid += len(n)

    return with_hash(docs).mapInArrow(sign, SIGNED)


def with_hash(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("th"))


def classes(rows: DataFrame) -> DataFrame:
    """Equal sets as one row: k, rep, doc_id (smallest), n, th (of one of the texts), sig."""
    return rows.where("n > 0").groupBy("k").agg(
        F.min("uid").alias("rep"), F.min("doc_id").alias("doc_id"), F.min("th").alias("th"),
        F.any_value("n").alias("n"), F.any_value("sig").alias("sig"),
    )


def forest(found: DataFrame) -> DataFrame:
    """Classes by region: key, tree, c (classes of the region), rep, n, sig; only regions of two and more."""
    keys = [F.xxhash64(F.lit(t), F.substring("sig", t * DEPTH * 4 + 1, LEAST * 4)) for t in range(TREES)]
    places = found.select("rep", F.posexplode(F.array(*keys)).alias("tree", "key"))
    shared = places.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    own = places.join(shared, "key").groupBy("rep").agg(F.collect_list(F.struct("tree", "key", "c")).alias("at"))
    rows = own.join(found.select("rep", "n", "sig"), "rep")
    return rows.select("rep", "n", "sig", F.explode("at").alias("at")).select(
        "at.key", "at.tree", "at.c", "rep", "n", "sig"
    )


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Columns rep, own: the shingles of each class of ``wanted`` (k, rep, th)."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies within a task go no further: the largest group of copies is spread over few rows.
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for th in batch.column("th").to_pylist():
                new.append(th not in seen)
                seen.add(th)
            yield batch.filter(pa.array(new))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = list(sets_of(batch.column("text").to_pylist()))
            reps = batch.column("rep").to_pylist()
            yield batch_of("rep long, own binary", [reps, [x.astype("<u8").tobytes() for x in sets]])

    texts = with_hash(docs).select("th", "text").mapInArrow(once, "th binary, text binary")
    rows = texts.join(wanted.select("th", "rep"), "th").select("rep", "text")
    return rows.mapInArrow(spell, "rep long, own binary").groupBy("rep").agg(F.any_value("own").alias("own"))


def prefixes(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many labels at the start are common, row by row."""
    return np.logical_and.accumulate(one == two, axis=1).sum(1)


def candidates(labels: np.ndarray, sketches: np.ndarray, groups: np.ndarray, top: int) -> np.ndarray:
    """Pairs of places that are neighbours in the order of the labels, may be links and would join two groups.

    Each class takes the ``top`` best of its neighbours, and the centre.  Members
    of the largest group ask for none: the other side does.
    """
    least = int(LIKELY * sketches.shape[1])
    names, of, sizes = np.unique(groups, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return np.zeros((0, 2), np.int64)
    order = np.lexsort(labels.T[::-1])
    labels, sketches, of = labels[order], sketches[order], of[order]
    n, near = len(order), min(NEAR * top, len(order) - 1)
    worth = np.zeros((n, 2 * near), np.int32)  # of the neighbour behind by 1, 2, ...; then of those before
    for k in range(1, near + 1):
        agree = (sketches[:-k] == sketches[k:]).sum(1, dtype=np.int32)
        worth_k = np.where((agree >= least) & (of[:-k] != of[k:]), prefixes(labels[:-k], labels[k:]) * 1024 + agree, 0)
        worth[:-k, k - 1] = worth_k
        worth[k:, near + k - 1] = worth_k
    steps_of = np.concatenate([np.arange(1, near + 1), -np.arange(1, near + 1)])
    asks = of != sizes.argmax() if sizes.max() > 1 else np.ones(n, bool)
    out: list[np.ndarray] = []
    centre = int((worth > 0).sum(1).argmax())
    for _ in range(top):
        best = worth.argmax(1)
        i = np.flatnonzero(asks & (worth[np.arange(n), best] > 0))
        out.append(np.stack([i, i + steps_of[best[i]]], 1))
        worth[i, best[i]] = 0
    # The class most like the others: the text that the copies were made from.
    agree = (sketches == sketches[centre]).sum(1)
    i = np.flatnonzero(asks & (agree >= least) & (of != of[centre]))
    out.append(np.stack([i, np.full(len(i), centre)], 1))
    return order[np.concatenate(out)]


class Region:
    """Classes of one region, or of two blocks of one."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        self.tree = rows.column("tree")[0].as_py()
        self.reps, self.groups = (rows.column(c).to_numpy() for c in ("rep", "component"))
        raw = b"".join(rows.column("sig").to_pylist())
        self.sigs = np.frombuffer(raw, ">u4").reshape(len(self.reps), TREES, DEPTH)
        self.sketches = (self.sigs & 255).astype(np.uint8).reshape(len(self.reps), -1)

    def open_pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of classes that ask and are asked, may be links, would join two groups and meet in no earlier tree."""
        other, asks, asked = (self.rows.column(c).to_numpy() for c in ("other", "asks", "asked"))
        asking, asked = np.flatnonzero(asks), np.flatnonzero(asked)
        there, width = self.sketches[asked], self.sketches.shape[1]
        least = int(LIKELY * width)
        block = max(1, (1 << 23) // (max(1, len(asked)) * width))
        for a in range(0, len(asking), block):
            own = asking[a : a + block]
            same = (self.sketches[own, None, :] == there[None, :, :]).sum(2, dtype=np.int32) >= least
            same &= self.groups[own, None] != self.groups[asked]
            # Two that both ask meet twice: the smaller asks.
            same &= ~(other[asked] & (self.reps[asked] < self.reps[own, None]))
            i, j = np.nonzero(same)
            i, j = own[i], asked[j]
            met = np.zeros(len(i), bool)
            for t in range(self.tree):
                met |= (self.sigs[i, t, :LEAST] == self.sigs[j, t, :LEAST]).all(1)
            yield i[~met], j[~met]


def by_part(rows: DataFrame, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Run ``work`` on the rows of each key, x, y, if two and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last: list[int] = []

        def done() -> Iterator[pa.RecordBatch]:
            if sum(x.num_rows for x in held) > 1 and (made := work(pa.Table.from_batches(held))):
                yield made

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in PART], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b and last != keys[a].tolist():
                    yield from done()
                    held, last = [], keys[a].tolist()
                held.append(batch.slice(a, b - a))
        yield from done()

    return rows.repartition(*PART).sortWithinPartitions(*PART, "rep").mapInArrow(run, schema)


def cut_deeper(regions: DataFrame, top: int) -> DataFrame:
    """Rows with the part ``x`` of their region: the shortest prefix that at most ``REGION`` classes share.

    Classes with a whole label in common are dealt by chance if they are more.
    """
    small_ones, large = regions.where(F.col("c") <= REGION), regions.where(F.col("c") > REGION)
    label = F.expr(f"substring(sig, tree * {DEPTH * 4} + 1, {DEPTH * 4})")
    deeper = [
        F.struct(F.lit(d).alias("d"), F.xxhash64(F.lit(d), F.substring("label", 1, d * 4)).alias("h"))
        for d in range(LEAST + 1, DEPTH + 1)
    ]
    places = large.withColumn("label", label).select("key", "rep", F.explode(F.array(*deeper)).alias("p"))
    places = places.select("key", "rep", "p.d", "p.h")
    shares = places.groupBy("key", "d", "h").agg(F.count(F.lit(1)).alias("m"))
    fits = places.join(shares, ["key", "d", "h"]).where((F.col("m") <= REGION) | (F.col("d") == DEPTH))
    chosen = fits.groupBy("key", "rep").agg(F.min(F.struct("d", "h", "m")).alias("at"))
    chance = F.pmod(F.xxhash64("rep", "tree", F.lit(top)), F.ceil(F.col("at.m") * 2 / REGION))
    x = F.when(F.col("at.m") > REGION, F.xxhash64("at.h", chance)).otherwise(F.col("at.h"))
    parts = large.join(chosen, ["key", "rep"]).withColumn("x", x).drop("at")
    return parts.unionByName(small_ones.withColumn("x", F.lit(0).cast("long")))


def likely_pairs(regions: DataFrame, top: int) -> DataFrame:
    """Distinct pairs a < b of the best neighbours."""

    def work(rows: pa.Table) -> pa.RecordBatch | None:
        region = Region(rows)
        found = candidates(region.sigs[:, region.tree], region.sketches, region.groups, top)
        pairs = np.unique(np.sort(region.reps[found], 1), axis=0)
        return batch_of(PAIRS, [pairs[:, 0], pairs[:, 1]]) if len(pairs) else None

    parts = cut_deeper(regions, top).withColumn("y", F.lit(0).cast("long"))
    return by_part(parts.select(*PART, "tree", "rep", "component", "sig"), work, PAIRS).distinct()


def blocks(regions: DataFrame) -> DataFrame:
    """Rows BLOCK: each block of classes outside the region's largest group (``other``) with each block of its classes.

    A region that is small enough is one part, its rows ask and are asked; regions of one group are left out.
    """
    sizes = regions.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("size"))
    whole = sizes.groupBy("key").agg(
        F.max(F.struct("m", "component", "size")).alias("top"), F.sum("m").alias("all"), F.sum("size").alias("size")
    )
    rows = regions.join(whole.where("all > top.m"), "key")

    def deal(classes, shingles):
        return F.greatest(F.ceil(classes * 2 / REGION), F.ceil(shingles / SHINGLES), F.lit(1))

    def at(x, y, asks, asked):
        return F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), asks.alias("asks"), asked.alias("asked"))

    rows = rows.withColumn("other", F.col("component") != F.col("top.component"))
    rows = rows.withColumn("across", deal(F.col("all") - F.col("top.m"), F.col("size") - F.col("top.size")))
    rows = rows.withColumn("down", deal(F.col("all"), F.col("size")))
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0).cast("long")
    x, y = F.pmod(F.xxhash64("rep"), "across"), F.pmod(F.xxhash64("rep", F.lit(1)), "down")
    asks = F.transform(F.sequence(zero, F.col("down") - 1), lambda k: at(x, k, yes, no))
    asked = F.transform(F.sequence(zero, F.col("across") - 1), lambda k: at(k, y, no, yes))
    one = (F.col("all") <= REGION) & (F.col("size") <= 2 * SHINGLES)
    places = F.when(one, F.array(at(zero, zero, F.col("other"), yes))).when(F.col("other"), F.concat(asks, asked))
    rows = rows.withColumn("at", F.explode(places.otherwise(asked)))
    return rows.select("key", "at.x", "at.y", "tree", "rep", "component", "sig", "other", "at.asks", "at.asked")


def rest_confirmed(regions: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that join groups, of all candidates, found where the sets of their classes meet."""

    def involved(rows: pa.Table) -> pa.RecordBatch | None:
        live = np.zeros(rows.num_rows, bool)
        for i, j in Region(rows).open_pairs():
            live[i] = live[j] = True
        return rows.filter(pa.array(live)).combine_chunks().to_batches()[0] if live.any() else None

    def links(rows: pa.Table) -> pa.RecordBatch | None:
        region = Region(rows)
        own = [np.frombuffer(x, "<u8") for x in rows.column("own").to_pylist()]
        _, flat = np.unique(np.concatenate(own), return_inverse=True)
        sizes = np.array([len(x) for x in own])
        flat = np.split(flat, np.cumsum(sizes)[:-1])
        seen = np.zeros(max(int(x.max()) for x in flat) + 1, bool)
        group = np.unique(region.groups, return_inverse=True)[1]
        found = []
        for one, two in region.open_pairs():
            for i in np.unique(one):
                j = two[one == i]
                j = j[group[j] != group[i]]
                seen[flat[i]] = True
                both = np.array([np.count_nonzero(seen[flat[k]]) for k in j], np.int64)
                seen[flat[i]] = False
                j = j[100 * both >= SIMILAR * (sizes[i] + sizes[j] - both)]
                # One link to each group that it joins; what is joined is not compared again.
                joined_groups, at = np.unique(group[j], return_index=True)
                found.append(np.stack([np.full(len(at), i), j[at]], 1))
                group[np.isin(group, joined_groups)] = group[i]
        links = np.sort(region.reps[np.concatenate(found)], 1) if found else np.zeros((0, 2), np.int64)
        return batch_of(PAIRS, [links[:, 0], links[:, 1]]) if len(links) else None

    return by_part(by_part(blocks(regions), involved, BLOCK).join(sets, "rep"), links, PAIRS)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                one, two = np.frombuffer(one, "<u8"), np.frombuffer(two, "<u8")
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= SIMILAR * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("rep").alias("a"), F.col("own").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("own").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(confirm, PAIRS)


def groups(docs: DataFrame) -> DataFrame:
    """Each document with n_shingles, component_id (smallest id of its group), th (MD5 of its text), uid and root.

    ``uid`` tells rows apart, ``root`` groups: ids may repeat or be NULL.  Rows without words have no root.
    """
    rows = stored(signed(docs), "signed")
    found = stored(classes(rows), "classes")
    regions = stored(forest(found), "forest")
    live = regions.select("rep").distinct()
    sets = stored(full_sets(docs, found.select("k", "rep", "th").join(live, "rep")), "sets")
    links = joins = None
    for top in (*ROUNDS, None):
        if joins is None:
            grouped = regions.withColumn("component", F.col("rep"))
        else:
            grouped = regions.join(joins, regions["rep"] == joins["node"], "left")
            grouped = grouped.withColumn("component", F.coalesce("component", "rep"))
        grouped = grouped.select("key", "tree", "c", "rep", "n", "component", "sig")
        found_now = rest_confirmed(grouped, sets) if top is None else confirmed(likely_pairs(grouped, top), sets)
        new = stored(found_now, "links")
        if new.isEmpty():
            continue
        links = new if links is None else links.union(new)
        joins = stored(components(links, "components"), "joins")
    named = found.select("k", "rep", "doc_id")
    if joins is not None:
        named = named.join(joins, named["rep"] == joins["node"], "left")
        named = named.withColumn("root", F.coalesce("component", "rep")).drop("node", "component")
        least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        named = named.join(least, "root")
    else:
        named = named.withColumn("component_id", F.col("doc_id")).withColumn("root", F.col("rep"))
    out = rows.select("uid", "doc_id", "n", "k", "th").join(named.select("k", "component_id", "root"), "k", "left")
    linked = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("uid", "doc_id", F.col("n").alias("n_shingles"), linked.alias("component_id"), "th", "root")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: the first text of the smallest id; rows without words all stay."""
    # NULL ids come last; of rows that share the smallest id, the first text by its hash.
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    keepers = groups(docs).where("n_shingles > 0").groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    th = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"), F.unhex(th).alias("th"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    chosen = row.where("worded").alias("r").join(
        keepers.alias("k"), F.expr("r.id <=> k.doc_id AND r.th = k.th"), "left_semi"
    )
    # Rows of one id and text are of one group.
    return chosen.dropDuplicates(["id", "th"]).select("row.*").union(row.where("NOT worded").select("row.*"))
