"""Stored cuboids: which ones to store under a budget, and answers from the smallest that covers a question.

The full base over all dimensions answers anything, but is about as large as the fact. The store adds the cuboids that
save most reading per byte: sketches estimate the size of every set the aggregation groups allow, and a greedy choice
takes the set whose storing shrinks the reading of all sets it covers most, per byte, until the budget is spent. What is
stored, with exact rows and bytes, is a published list (see ``sources/versions``), so a store can be rebuilt while it is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.plans import cube as cb
from sonomart.sources import versions

# A stored set must save this much reading; opening a file costs about as much.
WORTH_BYTES = 4 << 20
# Bytes of a cell's measures and keys, and of one song id in it, before compression.
CELL_BYTES, SONG_BYTES = 160, 4
SCHEMA = "dims array<string>, rows long, bytes long, folder string, model_filter string, place int"


@dataclass(frozen=True)
class Stored:
    dims: tuple[str, ...]
    rows: int
    bytes: int
    folder: str


def estimated_size(cells: int, pairs: int) -> int:
    """Bytes of a cuboid; dense cells hold bitmaps of 4 KB."""
    return cells * CELL_BYTES + min(pairs * SONG_BYTES, max(cells, 1) * 4096)


def choose(
    top: tuple[str, ...], sizes: Mapping[tuple[str, ...], tuple[int, int]], budget: int, worth: int = WORTH_BYTES
) -> list[tuple[str, ...]]:
    """Sets to store besides ``top``, in the order of their benefit per byte.

    The benefit of a set is what it saves of the bytes read by all sets it covers, each asked once, given the sets
    taken before it. Sets that save no more than ``worth`` are not stored.
    """
    size = {s: estimated_size(*n) for s, n in sizes.items()}
    members = {s: frozenset(s) for s in size}
    cost = dict.fromkeys(size, size[top])
    covers = {s: [t for t in size if members[t] <= members[s]] for s in size}
    chosen: list[tuple[str, ...]] = []
    left = budget
    while True:
        def saved(p: tuple[str, ...]) -> int:
            return sum(max(0, cost[s] - size[p]) for s in covers[p])

        open_ = [p for p in size if p != top and p not in chosen and size[p] <= left and saved(p) > worth]
        best = max(open_, key=lambda p: (saved(p) / max(size[p], 1), p), default=None)
        if best is None:
            return chosen
        chosen.append(best)
        left -= size[best]
        for s in covers[best]:
            cost[s] = min(cost[s], size[best])


class CuboidStore:
    """The published list below ``path``, held as of one version."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        self.spark, self.path = spark, path
        self.version = max(versions.published(spark, path), default=0) if version is None else version
        # At most one row per stored set.
        rows = versions.read(spark, path, SCHEMA, self.version).orderBy("place").collect()
        self.stored = [Stored(tuple(r.dims), r.rows, r.bytes, r.folder) for r in rows]
        self.model_filter = rows[0].model_filter if rows else None

    def catalogue(self) -> DataFrame:
        return versions.read(self.spark, self.path, SCHEMA, self.version)

    def covering(self, names: Iterable[str]) -> Stored | None:
        """The smallest stored set with all the names."""
        wanted = set(names)
        return min((s for s in self.stored if wanted <= set(s.dims)), key=lambda s: s.bytes, default=None)

    def read(self, stored: Stored) -> DataFrame:
        return self.spark.read.parquet(stored.folder)

    def answer(self, dims: Sequence[str], sets: Sequence[tuple[str, ...]]) -> DataFrame:
        """Measures of all sets, each from the smallest stored one that covers it; ``cuboid`` = grouping id over ``dims``."""
        by_source: dict[Stored, list[tuple[str, ...]]] = {}
        for s in sets:
            found = self.covering(s)
            if found is None:
                raise LookupError(f"no stored cuboid covers {s}")
            by_source.setdefault(found, []).append(s)
        bases = {stored: self.read(stored) for stored in by_source}
        types = {f.name: f.dataType for base in bases.values() for f in base.schema.fields}
        return cb.union_all([cb.cuboids(bases[stored], dims, mine, stored.dims, types) for stored, mine in by_source.items()])


def build(
    cube: cb.Cube, path: str, budget: int, sets: Sequence[tuple[str, ...]] | None = None, dims: Sequence[str] = tuple(cb.DIMENSIONS),
    worth: int = WORTH_BYTES,
) -> CuboidStore:
    """Store the base over ``dims`` and the sets that the budget of bytes allows; returns the published store.

    ``sets`` defaults to all that the cube's groups allow. Larger sets are stored first, so that smaller ones start
    from them.
    """
    spark = cube.fact.sparkSession
    before = max(versions.published(spark, path), default=0)
    top = tuple(dims)
    sets = sets if sets is not None else [s for g in cube.groups for s in g.grouping_sets()]
    sets = list(dict.fromkeys([top, *(tuple(d for d in top if d in s) for s in sets)]))
    folder = versions.data_folder(path)
    cb.group_base(cube.fact, cube.dims, top, None, cube.model_filter).write.parquet(f"{folder}/0")
    base = spark.read.parquet(f"{folder}/0")
    sizes = cb.set_sizes(cb.spread(base), sets)
    chosen = choose(top, sizes, budget, worth)
    made = {top: base}
    for s in sorted(chosen, key=lambda s: (-len(s), chosen.index(s))):
        source = made[min((p for p in made if set(p) >= set(s)), key=lambda p: estimated_size(*sizes[p]))]
        cells, pairs = sizes[s]
        small = cb.merge(source, s, dense=pairs >= cb.DENSE_IDS * cells)
        at = f"{folder}/{chosen.index(s) + 1}"
        # Few files each, however many tasks computed it; a large set still makes many.
        small.hint("rebalance").write.parquet(at)
        made[s] = spark.read.parquet(at)
    order = [top, *chosen]
    rows = [(list(s), made[s].count(), versions.folder_bytes(spark, f"{folder}/{k}"), f"{folder}/{k}", cube.model_filter, k)
            for k, s in enumerate(order)]
    versions.publish(spark, path, spark.createDataFrame(rows, SCHEMA).coalesce(1), before)
    return CuboidStore(spark, path)
