"""Exact Jaccard join of word n-gram sets by vertical partitioning, and the components of its links.

N-grams are 64-bit hashes, and their global order is that of the hashes. Fragments cut it into even ranges; what a set
has in a fragment is its segment.

* Sets that are equal are one from the start.
* Two sets of similarity t differ in d = (1 - t) / t of the smaller set's n-grams at most, so with more than d fragments
  at least one segment is the same in both. Sets are therefore met by whole segments, not by single n-grams: a common
  passage brings only those sets together that have nothing else in a fragment. Sizes fall into classes, each 1 / t^2
  wide; a class has its own number of fragments, and a set is cut for its own class and, as the larger of a pair,
  for the one below. As an empty segment is no meeting place, there are d / 4 + 2 fragments to spare; a set with so many
  empty segments that these don't suffice also meets others by the first n-grams of its order (the prefix of the
  similarity), which any similar set that has the same lack must share.
* Partial overlaps bound a pair's overlap from above: the counts of both sets in 128 ranges, the smaller of each summed.
  Pairs that stay below the threshold go, and of the others the overlaps are counted fragment by fragment and summed.
* A group that meets is not listed as pairs. First each of its members is compared with one of them, that which meets most
  others in all its groups (of a text and its variants, usually the text); links made so far give components, and those
  that are not in the centre's have a second round with a centre of theirs. What is left in different components is
  compared within tasks, in cells of two blocks: members that the bound leaves a partner get sketches of their sets, which
  bound overlaps nearly exactly, and a cell proposes no more pairs than join its members. For these overlaps are counted
  fragment by fragment and summed; a cell that proposed a pair in vain is worked out from whole sets. So all that is
  written grows with the members of the groups, not with their pairs.

Sets whose hashes of all n-grams agree are taken as equal, and so are n-grams; both are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millstream.llm.arrow import add_columns, bound_batches
from millstream.llm.components import components
from millstream.llm.sieve import keeper
from millstream.session import stored

#: Members of a block and n-grams of its sets, about at most; rounds of stars.
BLOCK, GRAMS, STARS = 2048, 4_000_000, 2
#: Ranges of the upper bound, and fragments in which overlaps are counted.
RANGES, FRAGMENTS = 128, 16
WORDS_KEPT = 100_000
#: Bits of the table of shared meeting places, of which there are many: 8 MB at most.
KEY_BITS = 25
#: Bits of a meeting place that are counted first where places aren't kept.
CUT_BITS = 40
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly (the finaliser of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    """Hashes of words, remembered up to a number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


class Shingles:
    """N-gram sets of texts: words are runs without ASCII white space, in lower case as far as A to Z go."""

    def __init__(self, n: int):
        self.n, self.words = n, _Words()
        self.places = _mixed(np.arange(1, n + 1, dtype=_U)) | _U(1)

    def of(self, text: str | None) -> np.ndarray:
        """Sorted hashes of the distinct n-grams; of the whole sequence where it is shorter; none without words."""
        found = (text or "").encode().translate(_LOWER).split()
        if not found:
            return np.zeros(0, _U)
        h = np.fromiter(map(self.words.__getitem__, found), _U, len(found))
        n = min(self.n, len(h))
        grams = h[: len(h) - n + 1] * self.places[0]
        for i in range(1, n):
            grams = grams + h[i : len(h) - n + 1 + i] * self.places[i]
        return np.unique(_mixed(grams + _U(n)))


class Scheme:
    """Meeting places of sets for a similarity of `num` hundredths or more."""

    def __init__(self, num: int):
        self.num, self.rest = num, 100 - num
        tops = [1]  # the first size of each class: a class is two steps of the similarity wide
        while tops[-1] < 1 << 40:
            tops.append(max(tops[-1] + 1, -(-tops[-1] * 10_000 // num**2)))
        self.first = np.array(tops, np.int64)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        n = len(grams)
        own = int(np.searchsorted(self.first, n, side="right")) - 1
        made = []
        for g in (own, own - 1):
            if g < 0 or g < own and (int(self.first[own]) - 1) * 100 < self.num * n:
                continue
            most = self.rest * (int(self.first[g + 1]) - 1) // self.num
            fragments = most + 1 + (-(-most // 4) + 2 if most else 0)
            at = ((grams >> _U(32)) * _U(fragments)) >> _U(32)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
            segments = np.add.reduceat(_mixed(grams + _U(g)), starts)
            made.append(_mixed(segments + _mixed(at[starts] + _U(g << 40))))
            differ = self.rest * n // self.num
            if differ and fragments - len(starts) >= fragments - differ:
                prefix = grams[: n - -(-self.num * n // 100) + 1]
                made.append(_mixed(prefix ^ _mixed(np.array([(g << 1) + 1], _U))))
        return np.unique(np.concatenate(made))


def _ranges(grams: np.ndarray) -> bytes:
    counts = np.bincount((grams >> _U(57)).astype(np.int64), minlength=RANGES)
    return np.minimum(counts, 65535).astype(np.uint16).tobytes()


def signatures(docs: DataFrame, n: int, num: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, s, n, ranges, keys): each row's set by hash, its size, counts in ranges and meeting places."""
    fields = [
        T.StructField("s", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("ranges", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]

    def start():
        shingles, scheme = Shingles(n), Scheme(num)

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            rows = []
            for t in columns[0].to_pylist():
                grams = shingles.of(t)
                if len(grams):
                    whole = xxhash.xxh64_intdigest(grams.tobytes())
                    rows.append((whole - (1 << 64) if whole >> 63 else whole, len(grams), _ranges(grams), scheme.keys(grams).view(np.int64)))
                else:
                    rows.append((None, 0, None, []))
            return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))]

        return work

    rows = docs.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text"))
    return add_columns(rows, ["text"], fields, start).drop("text")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, RANGES)


def _may_reach(least: np.ndarray, sizes: np.ndarray, cut: np.ndarray, num: int) -> np.ndarray:
    """Whether an overlap of `least` at most can do for sets of `sizes` in all. cut: counts that stop at the largest say nothing."""
    return cut | (least * 100 >= num * (sizes - least))


def _close(ranges: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, num: int) -> np.ndarray:
    """Of members i and members j which pairs can be within the similarity, by their counts in ranges."""
    a, b = ranges[i], ranges[j]
    least = np.empty((len(a), len(b)), np.int64)
    step = max(1, (1 << 16) // max(len(b), 1))
    for at in range(0, len(a), step):
        least[at : at + step] = np.minimum(a[at : at + step, None, :], b[None, :, :]).sum(axis=2, dtype=np.int64)
    cut = (a == 65535).any(axis=1)[:, None] & (b == 65535).any(axis=1)[None, :]
    return _may_reach(least, n[i][:, None] + n[j][None, :], cut, num)


def _stars(rest: DataFrame, nodes: DataFrame, num: int) -> tuple[DataFrame, DataFrame]:
    """(centres, pairs): the member of each group (key, s, degree) with the largest degree, and (a, b), the others with it
    where they can be linked."""
    centres = stored(rest.groupBy("key").agg(F.max(F.struct("degree", "s")).alias("m")).select("key", F.col("m.s").alias("a")), "jaccard-centres")
    pairs = rest.join(centres, "key").filter("s <> a").select("a", F.col("s").alias("b")).distinct()
    of = nodes.select("s", "n", "ranges")
    both = pairs.join(of.withColumnsRenamed({"s": "a", "n": "na", "ranges": "ra"}), "a").join(of.withColumnsRenamed({"s": "b", "n": "nb", "ranges": "rb"}), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch["ra"]), _matrix(batch["rb"])
                cut = (a == 65535).any(axis=1) & (b == 65535).any(axis=1)
                sizes = np.array(batch["na"], np.int64) + np.array(batch["nb"], np.int64)
                ok = _may_reach(np.minimum(a, b).sum(axis=1, dtype=np.int64), sizes, cut, num)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    bound_batches(rest.sparkSession)
    return centres, both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def _cells(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of each group that meets, in cells (key, i, j) of two blocks at most; i = j is a block by itself."""
    rows = met.join(nodes.select("s", "c", "n", "ranges"), "s")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / GRAMS)).cast("int")
    rows = rows.join(rows.groupBy("key").agg(blocks.alias("blocks")), "key").withColumn("block", F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "s", "c", "n", "ranges")


def _by_cell(cells: DataFrame, columns: list[str], of_cell: Callable[[pa.Table, bool], list[np.ndarray]], out: list[str]) -> DataFrame:
    """What of_cell(members, between two blocks) gives for each cell, as long columns `out`. One cell is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def cut(table: pa.Table, last: bool) -> tuple[pa.Table, list[list[np.ndarray]]]:
            """The rows of the last cell of a sorted table, which may go on, and what the cells before give."""
            key, i, j = (np.array(table[x], np.int64) for x in ("key", "i", "j"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *new.tolist(), len(key)] if last else [0, *new.tolist()]
            found = [of_cell(table.slice(x, y - x), bool(i[x] != j[x])) for x, y in zip(bounds, bounds[1:]) if y - x > 1]
            return table.slice(bounds[-1]), found

        def rows(found: list[list[np.ndarray]]) -> pa.RecordBatch:
            made = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(len(out))]
            return pa.RecordBatch.from_arrays([pa.array(m, pa.int64()) for m in made], names=out)

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                held, found = cut(pa.concat_tables([held, table]) if held is not None else table, False)
                yield rows(found)
        if held is not None and held.num_rows:
            yield rows(cut(held, True)[1])

    bound_batches(cells.sparkSession)
    cell = ["key", "i", "j"]
    dealt = cells.select(*cell, *columns).repartition(*cell).sortWithinPartitions(*cell)
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in out))


def _candidates(c: np.ndarray, block: np.ndarray, n: np.ndarray, ranges: np.ndarray, two: bool, num: int) -> Iterator[tuple[int, np.ndarray]]:
    """(p, qs): for members p of a cell the later members of other components that they can be linked with by the bound."""
    for at in range(0, len(c), 256):
        part = np.arange(at, min(at + 256, len(c)))
        may = (c[part, None] != c[None, :]) & (part[:, None] < np.arange(len(c))[None, :])
        if two:
            may &= block[part, None] != block[None, :]
        near, far = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
        if len(near):
            ok = _close(ranges, n, near + at, far, num) & may[np.ix_(near, far)]
            for p in np.flatnonzero(ok.any(axis=1)):
                yield int(near[p]) + at, far[ok[p]]


def _survivors(cells: DataFrame, num: int) -> DataFrame:
    """(key, i, j, s): members of each cell that can be linked with one of another component there, by counts in ranges.

    Cells that are left with the same members say the same, and one of them is kept.
    """

    def of_cell(cell: pa.Table, two: bool) -> list[np.ndarray]:
        s, c, n, block = (np.array(cell[x], np.int64) for x in ("s", "c", "n", "block"))
        hit = np.zeros(len(s), bool)
        for p, qs in _candidates(c, block, n, _matrix(cell["ranges"]), two, num):
            hit[p] = hit[qs] = True
        size = int(hit.sum())
        return [np.full(size, cell[x][0].as_py(), np.int64) for x in ("key", "i", "j")] + [s[hit]]

    found = stored(_by_cell(cells, ["block", "s", "c", "n", "ranges"], of_cell, ["key", "i", "j", "s"]), "jaccard-survivors")
    cell = ["key", "i", "j"]
    # Hashes of two seeds, summed with wide numbers, tell the member lists apart.
    parts = [F.sum(F.xxhash64(F.lit(seed), "s", F.col("i") == F.col("j")).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]
    lists = found.groupBy(*cell).agg(F.count("*").alias("n"), *parts)
    once = lists.groupBy("n", "h1", "h2").agg(F.min(F.struct(*cell)).alias("m")).select("m.*")
    return found.join(once, cell, "left_semi")


def _proposed(members: DataFrame, num: int) -> DataFrame:
    """(key, i, j, a, b): pairs of each cell that are links as far as their sketches tell, and join what they connect there.

    members: (key, i, j, block, s, c, sketch). Pairs that are connected already by pairs of the cell are passed over, so a
    cell has fewer pairs than members.
    """

    def of_cell(cell: pa.Table, two: bool) -> list[np.ndarray]:
        s, c, block = (np.array(cell[x], np.int64) for x in ("s", "c", "block"))
        sketches = [np.frombuffer(x, np.uint16) for x in cell["sketch"].to_pylist()]
        n = np.fromiter(map(len, sketches), np.int64, len(s))
        of = np.repeat(np.arange(len(s)), n) * RANGES
        ranges = np.bincount(of + (np.concatenate(sketches) >> 9), minlength=len(s) * RANGES).reshape(-1, RANGES)
        ranges = np.minimum(ranges, 65535).astype(np.uint16)
        counted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        label, found = c.copy(), []
        for p, qs in _candidates(c, block, n, ranges, two, num):
            qs = qs[label[qs] != label[p]]
            own = np.bincount(sketches[p], minlength=1 << 16) if len(qs) else None
            for q in qs.tolist():
                if label[p] != label[q]:
                    if q not in counted:
                        counted[q] = np.unique(sketches[q], return_counts=True)
                    values, times = counted[q]
                    both = int(np.minimum(own[values], times).sum())
                    if both * 100 >= num * (n[p] + n[q] - both):
                        found.append((s[p], s[q]))
                        label[label == label[q]] = label[p]
        made = np.array(found, np.int64).reshape(-1, 2)
        return [np.full(len(made), cell[x][0].as_py(), np.int64) for x in ("key", "i", "j")] + [made[:, 0], made[:, 1]]

    return _by_cell(members, ["block", "s", "c", "sketch"], of_cell, ["key", "i", "j", "a", "b"])


def _forest(members: DataFrame, num: int) -> DataFrame:
    """(a, b): of the links between the components in each cell as many as join what is linked there, and no more.

    members: (key, i, j, block, s, c, lists). Overlaps are counted fragment by fragment and summed for a pair; pairs that
    are connected already by links found in the cell are passed over, so a cell has fewer links than members.
    """

    def of_cell(cell: pa.Table, two: bool) -> list[np.ndarray]:
        s, c, block = (np.array(cell[x], np.int64) for x in ("s", "c", "block"))
        lists = pa.concat_arrays(cell["lists"].chunks) if cell["lists"].num_chunks > 1 else cell["lists"].chunk(0)
        inner = lists.flatten()
        grams = np.asarray(inner.flatten(), np.int64).view(_U)
        ends = np.concatenate([[0], np.cumsum(np.diff(np.asarray(inner.offsets)))]).reshape(-1)
        starts = ends[:-1].reshape(len(s), FRAGMENTS)
        stops = ends[1:].reshape(len(s), FRAGMENTS)
        n = stops[:, -1] - starts[:, 0]
        of = np.repeat(np.arange(len(s)), n)
        ranges = np.bincount(of * RANGES + (grams >> _U(57)).astype(np.int64), minlength=len(s) * RANGES).reshape(-1, RANGES)
        ranges = np.minimum(ranges, 65535).astype(np.uint16)
        known, at = np.unique(grams, return_inverse=True)
        mark = np.zeros(len(known), bool)
        label, found = c.copy(), []
        for p, qs in _candidates(c, block, n, ranges, two, num):
            own = at[starts[p, 0] : stops[p, -1]]
            mark[own] = True
            for q in qs:
                if label[p] != label[q]:
                    shared = [int(mark[at[x:y]].sum()) for x, y in zip(starts[q], stops[q])]
                    both = sum(shared)
                    if both * 100 >= num * (n[p] + n[q] - both):
                        found.append((s[p], s[q]))
                        label[label == label[q]] = label[p]
            mark[own] = False
        made = np.array(found, np.int64).reshape(-1, 2)
        return [made[:, 0], made[:, 1]]

    return _by_cell(members, ["block", "s", "c", "lists"], of_cell, ["a", "b"]).distinct()


def _sets(docs: DataFrame, rows: DataFrame, n: int, key: str, text: str, field: T.StructField, of: Callable[[np.ndarray], object]) -> DataFrame:
    """(row, field): what `of` makes of the sorted set of each of these rows. Rows that repeat key and text are one."""
    asked = keeper(rows, "row")(docs.select(F.xxhash64(key, text).alias("row"), F.col(text).alias("text")), F.col("row"))

    def start():
        shingles = Shingles(n)

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            return [pa.array([of(shingles.of(t)) for t in columns[0].to_pylist()], to_arrow_type(field.dataType))]

        return work

    made = add_columns(asked, ["text"], [field], start)
    return made.join(rows, "row", "left_semi").groupBy("row").agg(F.first(field.name).alias(field.name))


LISTS = T.StructField("lists", T.ArrayType(T.ArrayType(T.LongType())))
SKETCH = T.StructField("sketch", T.BinaryType())


def _fragments(grams: np.ndarray) -> list[np.ndarray]:
    """The segments of a sorted set in FRAGMENTS even ranges."""
    cuts = np.searchsorted(grams >> _U(60), np.arange(FRAGMENTS + 1, dtype=_U))
    return [grams[x:y].view(np.int64) for x, y in zip(cuts, cuts[1:])]


def _sketch(grams: np.ndarray) -> bytes:
    """The first 16 bits of each n-gram. What two sketches have in common is never less than what the sets have."""
    return (grams >> _U(48)).astype(np.uint16).tobytes()


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, num: int, key: str, text: str) -> DataFrame:
    """The pairs whose similarity is reached: partial overlaps by fragment, summed. Sets are made anew for these pairs only."""
    size = nodes.select("s", "n", "row")
    sized = pairs.join(size.withColumnsRenamed({"s": "a", "n": "na", "row": "x"}), "a").join(size.withColumnsRenamed({"s": "b", "n": "nb", "row": "y"}), "b")
    sized = stored(sized, "jaccard-sized")
    sets = _sets(docs, sized.select(F.explode(F.array("x", "y")).alias("row")).distinct(), n, key, text, LISTS, _fragments)
    left, right = sets.withColumnsRenamed({"row": "x", "lists": "gx"}), sets.withColumnsRenamed({"row": "y", "lists": "gy"})
    # Sorted joins: by the size of its files Spark would take the list of pairs for small.
    both = sized.hint("merge").join(left, "x").join(right.hint("merge"), "y")
    parts = F.zip_with("gx", "gy", lambda g, h: F.size(F.array_intersect(g, h)))
    whole = both.select("a", "b", "na", "nb", F.aggregate(parts, F.lit(0), lambda t, part: t + part).alias("both"))
    return whole.filter(F.col("both") * 100 >= num * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _linked(met: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, num: int, key: str, text: str) -> DataFrame:
    """(s, c): the sets that are linked with others, with the smallest of their component."""
    sizes = met.groupBy("key").agg(F.count("*").alias("size"))
    degree = met.join(sizes, "key").groupBy("s").agg(F.sum("size").alias("degree"))
    rest, links = stored(met.join(degree, "s").select("key", "s", "degree"), "jaccard-degrees"), None
    for _ in range(STARS):
        centres, pairs = _stars(rest, nodes, num)
        new = stored(_links(pairs, nodes, docs, n, num, key, text), "jaccard-links")
        links = new if links is None else links.unionByName(new)
        found = components(links)
        if new.isEmpty():
            break
        label = found.select(F.col("s").alias("a"), F.col("c").alias("of"))
        apart = rest.join(centres, "key").join(found, "s", "left").join(label, "a", "left").filter(F.coalesce("c", "s") != F.coalesce("of", "a"))
        rest = stored(apart.select("key", "s", "degree"), "jaccard-rest")
    labelled = stored(nodes.join(found, "s", "left").withColumn("c", F.coalesce("c", "s")), "jaccard-labelled")
    split = met.join(labelled.select("s", "c"), "s").groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y")
    cells = stored(_cells(met.join(split.select("key"), "key", "left_semi"), labelled), "jaccard-cells")
    kept = stored(_survivors(cells, num), "jaccard-kept")
    rows = kept.select("s").distinct().join(nodes.select("s", "row"), "s")
    cell = ["key", "i", "j"]
    kept = stored(cells.select(*cell, "block", "s", "c").join(kept, [*cell, "s"], "left_semi"), "jaccard-members")

    def with_sets(of: DataFrame, field: T.StructField, make) -> DataFrame:
        wanted = rows.join(of.select("s").distinct(), "s", "left_semi")
        sets = _sets(docs, wanted.select("row"), n, key, text, field, make).join(wanted, "row").select("s", field.name)
        return of.join(sets, "s")

    proposed = stored(_proposed(with_sets(kept, SKETCH, _sketch), num), "jaccard-proposed")
    pairs = proposed.select("a", "b").distinct()
    forest = stored(_links(pairs, nodes, docs, n, num, key, text), "jaccard-forest")
    links = links.unionByName(forest)
    # Sketches may say too much: cells that proposed a pair which is none are worked out from whole sets.
    wrong = proposed.join(forest, ["a", "b"], "left_anti").select(*cell).distinct()
    if not wrong.isEmpty():
        again = kept.join(wrong, cell, "left_semi")
        links = links.unionByName(stored(_forest(with_sets(again, LISTS, _fragments), num), "jaccard-exact"))
    return components(links)


def _shared(keys: DataFrame) -> DataFrame:
    """(key): meeting places of several sets."""
    several = keys.groupBy("key").agg(F.min("s").alias("x"), F.max("s").alias("y")).filter("x <> y")
    return stored(several.select("key"), "jaccard-keys")


def similar(docs: DataFrame, n: int = 5, num: int = 80, key: str = "doc_id", text: str = "text", store_keys: bool = True) -> DataFrame:
    """(key, row, n_shingles, component_id, component): a row for each row of `docs`, with the smallest key that it is linked to.

    Two texts are linked when 100 * |intersection| >= num * |union| of their sets of word n-grams (see `Shingles`);
    links hold on from text to text. row is a hash of key and text. Texts without words are linked with nothing, nor
    are they with each other: their component is their own key. Rows that repeat key and text, and keys with several
    texts, are rows each. A null key counts for its links, and is never the smallest unless there is no other.
    component tells components apart, also those with the same smallest key or none: the smallest hash of their sets,
    null for texts without words.

    store_keys: whether meeting places are kept between the two passes over them, or made anew, which takes more time
    and, at low similarities, much less disk.
    """
    made = signatures(docs, n, num, key, text)
    each = stored(made if store_keys else made.drop("keys"), "jaccard-signatures")
    some = each.filter("n > 0")
    keys = (some if store_keys else made.filter("n > 0")).select("s", F.explode("keys").alias("key"))
    if store_keys:
        shared = _shared(keys)
        met = keeper(shared, "key", KEY_BITS)(keys, F.col("key")).join(shared, "key").distinct()
        met = stored(met, "jaccard-met")
    else:
        # The beginnings of meeting places, with a count that packs to nothing, take half the bytes of whole ones with two sets.
        # What comes through by copies or equal beginnings alone goes afterwards, when it is little.
        cut = F.pmod("key", F.lit(1 << CUT_BITS))
        often = keys.groupBy(cut.alias("cut")).agg(F.count("*").alias("rows")).filter("rows > 1").select("cut")
        often = stored(often, "jaccard-cut")
        met = stored(keeper(often, "cut", KEY_BITS)(keys, cut).join(often, cut == F.col("cut")).select("s", "key").distinct(), "jaccard-maybe")
        met = stored(met.join(_shared(met), "key"), "jaccard-met")
    # Copies are counted down to one row a task before they are shuffled.
    sets = some.groupBy("s").agg(F.min("row").alias("row"), F.min("id").alias("id"), F.first("n").alias("n"), F.first("ranges").alias("ranges"))
    sets = stored(sets, "jaccard-sets")
    nodes = stored(sets.drop("id").join(met.select("s").distinct(), "s", "left_semi"), "jaccard-nodes")
    found = _linked(met, nodes, docs, n, num, key, text)
    classes = sets.select("s", "id").join(found, "s", "left").select("s", "id", F.coalesce("c", "s").alias("c"))
    smallest = classes.groupBy("c").agg(F.min("id").alias("component_id"))
    of = classes.select("s", "c").join(smallest, "c").select("s", "component_id", F.col("c").alias("component"))
    joined = some.select("id", "row", "n", "s").join(of, "s").select("id", "row", "n", "component_id", "component")
    rest = each.filter("n = 0").select("id", "row", "n", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("component"))
    return joined.unionByName(rest).select(F.col("id").alias(key), "row", F.col("n").alias("n_shingles"), "component_id", "component")


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each component of `similar`: that of the smallest key, then of the smallest hash.

    Rows that repeat key and text wholly are one; of their other columns the smallest values stay. Rows without words
    all stay. A row without key stays if its component has none with a key, and no smaller hash.
    """
    found = stored(similar(docs, n, num, key, text, store_keys=False), "jaccard-found")
    own = "_" * max(map(len, docs.columns)) + "row"
    worded = found.filter("n_shingles > 0").select(key, "row", "component")
    best = worded.groupBy("component").agg(F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("id"), "row")).alias("best"), F.count("*").alias("rows"))
    several = worded.join(best.filter("rows > 1"), "component")
    marks = several.select("row", (F.col("row") == F.col("best.row")).alias("stays")).groupBy("row").agg(F.max("stays").alias("stays"), F.count("*").alias("times"))
    marks = stored(marks.filter("NOT stays OR times > 1"), "jaccard-marks")
    keep = keeper(marks, "row")
    rows = docs.withColumn(own, F.xxhash64(key, text))
    judged = keep(rows, F.col(own)).join(marks.withColumnRenamed("row", f"{own}2"), F.col(own) == F.col(f"{own}2"), "left")
    kept = judged.filter(F.col("stays").isNull()).select(*docs.columns)
    again = judged.filter("stays").groupBy(own).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("m")).select("m.*")
    return keep(rows, F.col(own), False).select(*docs.columns).unionByName(kept).unionByName(again)
