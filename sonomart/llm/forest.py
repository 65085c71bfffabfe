"""Near-duplicate groups by an LSH forest over MinHash signatures.

Documents with equal shingle sets collapse to one class first. Each class enters ``TREES`` sorted orders: a
tree orders the classes by its own sequence of signature components, so classes that share a prefix stand
together and the longest common prefixes are neighbours. Depth adapts to the region:

* in a region (classes that share the first ``MIN_DEPTH`` components) of up to ``WINDOW`` members, all meet all, but
  two members of crowds (next point) count only if they meet in two trees;
* in a denser region, a class meets its nearest neighbours in order, which share the deepest prefixes, and the
  pivot of its region at several depths. A pivot is the member that shares the fullest prefixes with most
  others over all trees, the original of a crowd of copies, so a crowd of any size costs a constant number of
  candidates per member. What these few candidates link collapses; members of crowds that are still in different
  components then meet in an exact join, so no link inside a crowd is lost.

Orders are range-partitioned by the whole key and node, so a region may cross tasks; what stands at the seams
meets in a second small pass. Candidates are thinned by set sizes and signatures and confirmed on full shingle
sets: first each class with its likeliest partner, then, among pairs that are still in different components, the
rest, and last what the join of the crowds finds. So the texts that travel are few, and no pair is enumerated within
a large group.

The join of the crowds is a prefix filter: shingles of a set stand in one order, rare ones first, and two sets of
enough overlap share one of their first shingles, whose places bound the overlap. The order comes from a table of
counts of fixed size; any order is exact, a good one is fast. Its pairs pass the same signature test as all others, which
loses a pair at the threshold once in a billion. Shingles that only one component holds are left out
before the join, and pairs within the largest component of a shingle are never formed.

Two sets of similarity ``s`` share a region in some tree with probability ``1 - (1 - s**4)**20``: a miss is one in
two million at 0.85 and one in forty thousand at 0.8. Links are never false: the test on full sets is exact in integers.

Defined results
---------------
* Null or empty text, or text of white space: empty set, linked with nothing, its own component.
* Fewer words than a shingle: the whole sequence is the one shingle.
* A group's id is its least document id; ``kept`` marks it. Rows that repeat id and text are kept alike; a null
  id is greater than all others, and kept if the whole group has null ids.
* Only the named columns are read. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomart.llm.components import components
from sonomart.operators.staging import stage

SHINGLE_WORDS = 5
MIN_PERCENT = 80
TREES, MIN_DEPTH, DEPTH = 20, 4, 8
COMPONENTS = TREES * MIN_DEPTH
WINDOW, NEAR = 32, 1
PIVOT_DEPTHS = (4, 8)
# Scores differ by up to this share between groups of trees, so that trees take different pivots among near equals.
PIVOT_SPREAD, PIVOT_DRAWS = 0.15, 4
BATCH_BYTES = 1 << 20
# Counts that order the shingles of crowds; 4 MB in every task.
COUNT_BITS = 20
FAN_IN = 16
# Rows of 40 bytes; more class representatives are joined through the shuffle.
BROADCAST_ROWS = 500_000

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stream(seed: int, n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BYTE = _stream(11, 256)
_PLACE = _stream(12, 1 << 16) | _U(1)
_STEP = _stream(13, 64) | _U(1)
_MULTIPLY, _ADD = _stream(14, COMPONENTS) | _U(1), _stream(15, COMPONENTS)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of ``data`` (lower-cased ASCII letters, other bytes as they are)."""
    codes = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[codes]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return start, np.zeros(0, _U)
    lengths = end - start
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    weight = _PLACE[place & 0xFFFF] + (place >> 16).astype(_U) * _U(0xD1342543DE82EF95)
    sums = np.add.reduceat(_BYTE[codes[inside]] * weight, first)
    return start, _mix(sums + lengths.astype(_U))


def shingles(texts: list[str | None], k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of the distinct shingles of every text, ordered by both."""
    data = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    offsets = np.cumsum([0] + [len(d) + 1 for d in data])
    start, words = _word_hashes(b"\n".join(data))
    owner = np.searchsorted(offsets, start, side="right") - 1
    n_words = np.bincount(owner, minlength=len(texts))
    parts = [(np.zeros(0, np.int64), np.zeros(0, _U))]
    if len(words) >= k:
        h = np.zeros(len(words) - k + 1, _U)
        for j in range(k):
            h += words[j:len(words) - k + 1 + j] * _STEP[j]
        whole = owner[:len(h)] == owner[k - 1:]
        parts.append((owner[:len(h)][whole], _mix(h[whole] + _U(k))))
    first = np.cumsum(n_words) - n_words
    for i in np.flatnonzero((n_words > 0) & (n_words < k)):
        some = words[first[i]:first[i] + n_words[i]]
        parts.append((np.array([i]), _mix(np.array([(some * _STEP[:len(some)]).sum() + _U(len(some))], _U))))
    owner, h = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return owner[new], h[new]


def _batches(batch: pa.RecordBatch, text: str):
    """Slices of a batch with about BATCH_BYTES of text, at least one row each."""
    sizes = np.cumsum([len(t or "") for t in batch.column(text).to_pylist()])
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, base + BATCH_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


_SIGNED = "doc_id {id}, text_key long, n_shingles long, node binary, signature binary"


def _signer(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole, "text"):
                owner, h = shingles(batch.column("text").to_pylist(), k)
                rows = batch.num_rows
                n = np.bincount(owner, minlength=rows)
                nodes, signatures = [None] * rows, [None] * rows
                if len(h):
                    filled = np.flatnonzero(n)
                    at = np.cumsum(n[filled]) - n[filled]
                    one = np.add.reduceat(_mix(h ^ _U(0x5851F42D4C957F2D)), at) + n[filled].astype(_U)
                    two = np.add.reduceat(_mix(h ^ _U(0x14057B7EF767814F)), at)
                    names = np.stack([one, two], axis=1).astype(">u8")
                    least = np.empty((len(filled), COMPONENTS), ">u4")
                    for c in range(COMPONENTS):
                        least[:, c] = np.minimum.reduceat(((h * _MULTIPLY[c] + _ADD[c]) >> _U(32)).astype(np.uint32), at)
                    for i, row in enumerate(filled):
                        nodes[row], signatures[row] = names[i].tobytes(), least[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()),
                     pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "node", "signature"])
    return run


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and tree: the tree's components in its order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), ">u4").reshape(-1, COMPONENTS)
        for tree in range(TREES):
            order = (np.arange(DEPTH) + tree * MIN_DEPTH) % COMPONENTS
            keys = np.ascontiguousarray(signatures[:, order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), tree, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                 batch.column("node"), batch.column("n_shingles")], names=["tree", "key", "node", "n"])


PAIR, SEAM, CROWD = 0, 1, 2
_FOUND = "kind int, tree int, key binary, a binary, b binary, na long, nb long"


class _Rows:
    """Rows of a sorted order as arrays."""

    def __init__(self, tree, key, node, n):
        self.tree, self.key, self.node, self.n = tree, key, node, n

    @classmethod
    def of(cls, batch):
        return cls(batch.column("tree").to_numpy(zero_copy_only=False),
                   np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(-1, DEPTH),
                   np.array(batch.column("node").to_pylist(), dtype=object), batch.column("n").to_numpy(zero_copy_only=False))

    def __len__(self):
        return len(self.tree)

    def __getitem__(self, at):
        return _Rows(self.tree[at], self.key[at], self.node[at], self.n[at])

    def __add__(self, other):
        return _Rows(*(np.concatenate([x, y]) for x, y in zip(self.columns(), other.columns())))

    def columns(self):
        return self.tree, self.key, self.node, self.n

    def region(self, i):
        return int(self.tree[i]), self.key[i, :MIN_DEPTH].tobytes()


def _emit(kind: int, rows: _Rows, i, j=None) -> pa.RecordBatch:
    a, na = rows.node[i], rows.n[i]
    b, nb = (rows.node[j], rows.n[j]) if j is not None else (np.full(len(i), None), np.zeros(len(i), np.int64))
    keys = [None] * len(i) if j is not None else [k.tobytes() for k in rows.key[i]]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(i), kind, np.int32)), pa.array(rows.tree[i].astype(np.int32)), pa.array(keys, pa.binary()),
         pa.array(a.tolist(), pa.binary()), pa.array(b.tolist(), pa.binary()), pa.array(na, pa.int64()), pa.array(nb, pa.int64())],
        names=["kind", "tree", "key", "a", "b", "na", "nb"])


def _neighbours(percent: int, seams: bool):
    """Candidates of one task's stretch of the sorted orders; holds WINDOW rows and one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opening, opening_done = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _Rows.of(batch)
            rows = new if held is None else held + new
            begin = 0 if held is None else len(held)
            same = np.zeros(len(rows), bool)
            same[1:] = (rows.tree[1:] == rows.tree[:-1]) & (rows.key[1:, :MIN_DEPTH] == rows.key[:-1, :MIN_DEPTH]).all(axis=1)
            since = np.arange(len(rows)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(rows))))
            i = np.arange(begin, len(rows))
            crowded = i[since[i] >= WINDOW]
            for lag in range(1, WINDOW + 1):
                at = i[since[i] >= lag]
                if not len(at):
                    break
                if lag > NEAR:
                    at = at[since[at] < WINDOW]
                n, m = rows.n[at], rows.n[at - lag]
                at = at[(np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (rows.node[at] != rows.node[at - lag])]
                if len(at):
                    yield _emit(PAIR, rows, at, at - lag)
            if len(crowded):
                # The first crowded row brings in the rows before it, which were still few.
                entering = crowded[since[crowded] == WINDOW]
                before = (entering[:, None] - np.arange(1, WINDOW + 1)).ravel()
                yield _emit(CROWD, rows, np.unique(np.concatenate([crowded, before])))
            if seams and not opening_done:
                opening = new if opening is None else opening + new
                other = [x for x in range(min(len(opening), WINDOW + 1)) if opening.region(x) != opening.region(0)]
                opening = opening[:min(other[0] if other else len(opening), WINDOW)]
                opening_done = bool(other) or len(opening) >= WINDOW
            held = rows[max(0, len(rows) - WINDOW):]
        if seams and held is not None:
            last = [x for x in range(len(held)) if held.region(x) == held.region(len(held) - 1)]
            yield _emit(SEAM, opening, np.arange(len(opening)))
            yield _emit(SEAM, held, np.array(last))
    return run


def _size_filter(percent: int) -> str:
    return f"least(na, nb) * 100 >= greatest(na, nb) * {percent} and a <> b"


def candidates(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs (a, b), a < b, from the forest over ``classes`` (node, n_shingles, signature), and the
    nodes of all crowded regions."""
    order = ["tree", "key", "node"]
    rows = classes.mapInArrow(_tree_rows, "tree int, key binary, node binary, n long")
    found = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours(percent, True), _FOUND),
                  "forest-found")
    seam = found.filter(F.col("kind") == SEAM).select(
        "tree", "key", F.col("a").alias("node"), F.col("na").alias("n"), F.substring("key", 1, 4 * MIN_DEPTH).alias("region"))
    seam = seam.distinct().repartition("tree", "region").sortWithinPartitions(*order).drop("region")
    more = stage(seam.mapInArrow(_neighbours(percent, False), _FOUND), "forest-seams")
    pairs = found.filter(F.col("kind") == PAIR).union(more.filter(F.col("kind") == PAIR))
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("trees"))

    crowd = found.filter(F.col("kind") == CROWD).union(more.filter(F.col("kind") == CROWD))
    crowd = stage(crowd.select("tree", "key", "a", "na").distinct(), "forest-crowds")
    fullness = crowd.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("full"))
    score = crowd.join(fullness, ["tree", "key"]).groupBy("a").agg(F.sum("full").alias("score"))
    levels = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.substring("key", 1, 4 * d).alias("prefix")) for d in PIVOT_DEPTHS]))
    draw = F.pmod(F.xxhash64("a", F.col("tree") % PIVOT_DRAWS), F.lit(1 << 20)) / float(1 << 20)
    scored = crowd.join(score, "a").withColumn("score", F.col("score") * (1 + PIVOT_SPREAD * draw))
    member = scored.select("a", "na", "score", "tree", levels.alias("l")).select("a", "na", "score", "tree", "l.depth", "l.prefix")
    best = F.max(F.struct("score", F.col("a").alias("b"), F.col("na").alias("nb"))).alias("best")
    pivots = member.groupBy("tree", "depth", "prefix").agg(best).select("tree", "depth", "prefix", "best.b", "best.nb")
    spokes = member.join(pivots, ["tree", "depth", "prefix"]).filter(_size_filter(percent)).select("a", "b")
    members = stage(crowd.select(F.col("a").alias("node")).distinct(), "forest-members")
    # Two members of crowds that meet in one tree only are left to the pivots and the exact join.
    once = pairs.filter("trees = 1").select("a", "b")
    outside = [once.join(members.withColumnRenamed("node", end), end, "left_anti").select("a", "b") for end in ("a", "b")]
    spokes = spokes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = pairs.filter("trees > 1").select("a", "b").union(outside[0]).union(outside[1]).union(spokes).distinct()
    return pairs, members


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> _U(64 - COUNT_BITS)).astype(np.int64)


_COUNTED = "node long, counts binary"


def _packed(counts: np.ndarray) -> bytes:
    """The filled slots with their counts."""
    filled = np.flatnonzero(counts)
    return np.stack([filled.astype(np.uint32), counts[filled].astype(np.uint32)]).tobytes()


def _unpacked(rows) -> np.ndarray:
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for row in rows:
        slots, n = np.frombuffer(row, np.uint32).reshape(2, -1)
        counts[slots] += n
    return np.minimum(counts, (1 << 32) - 1)


def _slot_counts(k: int):
    """One row a task: how often its shingles fall into each slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        for whole in batches:
            for batch in _batches(whole, "text"):
                np.add.at(counts, _slot(shingles(batch.column("text").to_pylist(), k)[1]), 1)
        packed = _packed(np.minimum(counts, (1 << 32) - 1))
        if packed:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([packed], pa.binary())],
                                             names=["node", "counts"])
    return run


def _added(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"node": group["node"].iloc[:1].to_numpy(), "counts": [_packed(_unpacked(group["counts"]))]})


def slot_counts(texts: DataFrame, k: int) -> np.ndarray:
    """Counts by slot over all rows; tasks' tables of at most 8 MB meet FAN_IN at a time up a tree."""
    tables = stage(texts.select("text").mapInArrow(_slot_counts(k), _COUNTED), "forest-counts")
    nodes = (tables.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        tables = tables.withColumn("node", F.col("node") % nodes).groupBy("node").applyInPandas(_added, _COUNTED)
    return _unpacked(r.counts for r in tables.collect()).astype(np.uint32)


_POSTING = "shingle long, node binary, root binary, n long, at long, first boolean"


def _prefixes(counts: np.ndarray, percent: int, k: int):
    """Rows of the first shingles of every set, rare ones first; ``first``: within the prefix towards sets not smaller."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole, "text"):
                owner, h = shingles(batch.column("text").to_pylist(), k)
                order = np.lexsort((h, counts[_slot(h)], owner))
                owner, h = owner[order], h[order]
                n = np.bincount(owner, minlength=batch.num_rows)
                at = np.arange(len(h)) - (np.cumsum(n) - n)[owner]
                size = n[owner]
                take = at <= size + (-percent * size // 100)
                first = at <= size + (-2 * percent * size // (100 + percent))
                owner, row = owner[take], pa.array(owner[take])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[take].view(np.int64)), batch.column("node").take(row), batch.column("root").take(row),
                     pa.array(size[take].astype(np.int64)), pa.array(at[take].astype(np.int64)), pa.array(first[take])],
                    names=["shingle", "node", "root", "n", "at", "first"])
    return run


def crowd_pairs(crowd: DataFrame, percent: int, k: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of rows (node, text, root) with unequal roots: all that can be similar enough."""
    counts = slot_counts(crowd, k)
    rows = stage(crowd.select("node", "text", "root").mapInArrow(_prefixes(counts, percent, k), _POSTING), "forest-prefixes")
    shares = rows.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("rows"))
    mixed = shares.groupBy("shingle").agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("rows", "root")).alias("main"))
    mixed = mixed.filter("roots > 1").select("shingle", F.col("main.root").alias("main"))
    live = stage(rows.join(mixed, "shingle").withColumn("in_main", F.col("root") == F.col("main")).drop("main"), "forest-live")
    x = live.filter("first").select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("node", "root", "n", "at", "in_main")])
    y = live.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "root", "n", "at", "in_main")])
    near = F.expr(f"""root_a <> root_b AND (n_a < n_b OR (n_a = n_b AND node_a < node_b)) AND n_a * 100 >= n_b * {percent}
        AND (least(n_a - at_a, n_b - at_b)) * {100 + percent} >= {percent} * (n_a + n_b)""")
    found = [left.join(right, "shingle").filter(near).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
             for left, right in ((x.filter("NOT in_main"), y), (x.filter("in_main"), y.filter("NOT in_main")))]
    return found[0].union(found[1]).distinct()


def _agreeing(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(-1, COMPONENTS) for c in ("sa", "sb"))
            agree = (one == two).sum(axis=1)
            keep = pa.array(agree >= least)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(agree.astype(np.int32))],
                                             names=["a", "b", "agree"])
            yield out.filter(keep)
    return run


def least_agreement(percent: int) -> int:
    """Six standard deviations below what a pair at the threshold is expected to agree on."""
    s = percent / 100
    return max(1, int(COMPONENTS * (s - 6 * (s * (1 - s) / COMPONENTS) ** 0.5)))


def _confirmed(percent: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole, "ta"):
                rows = batch.num_rows
                owner, h = shingles(batch.column("ta").to_pylist() + batch.column("tb").to_pylist(), k)
                cuts = np.searchsorted(owner, np.arange(2 * rows + 1))
                keep = []
                for i in range(rows):
                    a, b = h[cuts[i]:cuts[i + 1]], h[cuts[i + rows]:cuts[i + rows + 1]]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.select("a", "b").join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(
        _confirmed(percent, k), "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = MIN_PERCENT, k: int = SHINGLE_WORDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, component_id, kept), one per row of ``docs``.

    Rows are linked where ``100 * intersection >= percent * union`` of their shingle sets.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    signed = stage(rows.mapInArrow(_signer(k), _SIGNED.format(id=id_type)), "forest-signed")
    filled = signed.filter("node IS NOT NULL")
    classes = stage(filled.groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")), "forest-classes")

    signatures = classes.select("node", "signature")

    def agreeing(found: DataFrame) -> DataFrame:
        both = found.join(signatures.toDF("a", "sa"), "a").join(signatures.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        return stage(both.mapInArrow(_agreeing(least_agreement(percent)), "a binary, b binary, agree int"), "forest-pairs")

    found, crowd = candidates(classes.select("node", "n_shingles", "signature"), percent)
    pairs = agreeing(found)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowd).distinct()
    wanted = stage(classes.join(ends, "node", "left_semi").select(
        "node", F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")), "forest-wanted")
    small = wanted.count() <= BROADCAST_ROWS
    texts = rows.join(F.broadcast(wanted) if small else wanted,
                      F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    texts = stage(texts.groupBy("node").agg(F.first("text").alias("text")), "forest-texts")

    # Round one: the likeliest partner of every class settles most components.
    ways = pairs.select(F.col("a").alias("node"), "a", "b", "agree").union(pairs.select("b", "a", "b", "agree"))
    likeliest = ways.groupBy("node").agg(F.max(F.struct("agree", "a", "b")).alias("best")).select("best.a", "best.b").distinct()
    links = stage(_confirm(likeliest, texts, percent, k), "forest-links")
    roots = components(links)
    # Round two: every other pair whose ends are still apart.
    ra, rb = roots.toDF("a", "ra"), roots.toDF("b", "rb")
    apart = pairs.join(likeliest, ["a", "b"], "left_anti").join(ra, "a", "left").join(rb, "b", "left").filter(
        "coalesce(ra, a) <> coalesce(rb, b)")
    more = stage(_confirm(apart, texts, percent, k), "forest-links")
    joined = more.join(ra, "a", "left").join(rb, "b", "left").selectExpr("coalesce(ra, a) AS a", "coalesce(rb, b) AS b")
    # Only roots meet again, so the second search is as small as what round one left open.
    tops = components(joined).toDF("root", "top")

    def raised(named: DataFrame, tops: DataFrame) -> DataFrame:
        return named.join(tops, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")

    # Round three: members of crowds that are still apart meet exactly.
    members = texts.join(crowd, "node", "left_semi").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = stage(raised(members, tops).select("node", "text", "root"), "forest-members")
    last = stage(_confirm(agreeing(crowd_pairs(members, percent, k)), texts, percent, k), "forest-links")
    at = members.select("node", "root")
    last = last.join(at.toDF("a", "ra"), "a").join(at.toDF("b", "rb"), "b").selectExpr("ra AS a", "rb AS b")
    ends_of = components(last).toDF("root", "top")

    least = F.min(F.struct(F.col("first.none").alias("none"), F.col("first.doc_id").alias("id"))).alias("least")
    named = classes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = raised(raised(named, tops), ends_of)
    groups = named.groupBy("root").agg(least)
    ids = named.select("node", "root").join(groups, "root").select("node", F.col("least.id").alias("group_id"), F.lit(True).alias("found"))
    out = signed.select("doc_id", "text_key", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("found"), F.col("group_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = MIN_PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the least id."""
    gone = near_duplicates(docs, percent, id_col=id_col, text_col=text_col).filter("NOT kept").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct()
    same = docs[id_col].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs[text_col]) == gone["_gone_key"])
    return docs.join(gone, same, "left_anti")
