"""Semantic model over the star: named dimensions and measures, aggregation groups, cuboids and queries.

The fact is read once per aggregation group and aggregated by its foreign keys before any dimension is
joined; all further levels come from that group base. Partials are additive, and a base keeps the set of
songs of each cell, cut into buckets of 32,768 ids: as a list of ids where cells hold few songs, as a bitmap
where they hold many. Both merge exactly, so distinct counts survive every roll-up, and no row of a base
grows beyond one bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations, product
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sonomart.operators.joins import lookup_left
from sonomart.operators.staging import estimated_bytes, stage
from sonomart.plans.contract import FOREIGN_KEYS

# Fixed names of the cube: alias -> (dimension table, column).
DIMENSIONS: dict[str, tuple[str, str]] = {
    "ANIO": ("dim_fecha", "anio"),
    "MES": ("dim_fecha", "mes"),
    "DIA": ("dim_fecha", "dia"),
    "MESSTRING": ("dim_fecha", "mesString"),
    "ESTACION": ("dim_fecha", "estacion"),
    "FINDE": ("dim_fecha", "finde"),
    "FESTIVO": ("dim_fecha", "festivo"),
    "FECHASTRING": ("dim_fecha", "fechaString"),
    "FRANJAHORARIA": ("dim_hora", "franjaHoraria"),
    "ARTISTA_NOMBRE": ("dim_artista", "nombre"),
    "ARTISTA_GENERO": ("dim_artista", "genero"),
    "ARTISTA_PAIS": ("dim_artista", "pais"),
    "ARTISTA_TIPO": ("dim_artista", "tipo"),
    "ALBUM_NOMBRE": ("dim_album", "nombre"),
    "PRODUCTORA": ("dim_album", "productora"),
    "ALBUM_ANYO": ("dim_album", "anyo"),
    "TITULO": ("dim_cancion", "titulo"),
    "RANGODURACION": ("dim_cancion", "rangoDuracion"),
    "PLAYLIST": ("dim_cancion", "playlist"),
    "USUARIO_NOMBRE": ("dim_usuario", "nombre"),
    "GENERACION": ("dim_usuario", "generacion"),
    "USUARIO_PAIS": ("dim_usuario", "pais"),
    "TIPOUSUARIO": ("dim_usuario", "tipoUsuario"),
}
COUNT = "_COUNT_"
DISTINCT_SONGS = "CANCIONES_DISTINTAS"
LONG_SUMS = ("msEscuchados", "msNoEscuchados", "msTotal", "cancionesEscuchadas")
DOUBLE_SUMS = (
    "danceability", "energy", "valence", "acousticness", "tempo", "speechiness", "instrumentalness", "liveness",
)
SUMS = {f"{c.upper()}_SUM": c for c in LONG_SUMS + DOUBLE_SUMS}
AVERAGES = {f"AVG_{c.upper()}": f"{c.upper()}_SUM" for c in DOUBLE_SUMS}
MEASURES = (COUNT, *list(SUMS)[:4], DISTINCT_SONGS, *list(SUMS)[4:])
SETS_PER_EXPAND = 32
# Songs of a cell and bucket from which a bitmap of 4 KB is cheaper than a list of ids.
DENSE_IDS = 128
# Sketches in one pass over a base, and their size as a power of two: an error of about 3 %.
SKETCHES, SKETCH_LOG = 128, 10
# Rows that could be expanded in the time that storing one more parent takes besides its rows.
PARENT_ROWS = 1_000_000
# Expanded rows of a task where sets are computed by key, without a shuffle of their cells.
EXPANDED_ROWS = 1_000_000

_FK_OF = {table: fk for fk, (table, _) in FOREIGN_KEYS.items()}
_KEY_OF = {table: key for table, key in FOREIGN_KEYS.values()}


@dataclass(frozen=True)
class Group:
    """Aggregation group. ``bitmap`` keeps song bitmaps (or lists) in its base whatever their density."""

    name: str
    dims: tuple[str, ...]
    hierarchies: tuple[tuple[str, ...], ...] = ()
    mandatory: tuple[str, ...] = ()
    joint: tuple[tuple[str, ...], ...] = ()
    bitmap: bool | None = None

    def grouping_sets(self) -> list[tuple[str, ...]]:
        """All dimension subsets the rules allow, each in group order.

        A hierarchy contributes one of its prefixes, a joint set all or nothing, a mandatory
        dimension is always there, any other dimension is free.
        """
        taken = {d for h in self.hierarchies for d in h} | {d for j in self.joint for d in j}
        choices: list[list[tuple[str, ...]]] = [[h[:i] for i in range(len(h) + 1)] for h in self.hierarchies]
        choices += [[(), j] for j in self.joint]
        choices += [[(), (d,)] for d in self.dims if d not in taken]
        found = []
        for parts in product(*choices):
            chosen = {d for p in parts for d in p}
            if chosen.issuperset(self.mandatory):
                found.append(tuple(d for d in self.dims if d in chosen))
        return sorted(set(found), key=lambda s: (-len(s), [self.dims.index(d) for d in s]))


# The aggregation groups of the cube.
GROUPS = (
    Group("time", ("ANIO", "MES", "MESSTRING", "DIA", "ESTACION", "FINDE", "FESTIVO", "FRANJAHORARIA"),
          hierarchies=(("ANIO", "MES", "DIA"),)),
    Group("music", ("ARTISTA_NOMBRE", "ARTISTA_GENERO", "ARTISTA_PAIS", "ARTISTA_TIPO", "ALBUM_NOMBRE",
                    "PRODUCTORA", "TITULO", "RANGODURACION", "PLAYLIST"),
          hierarchies=(("ARTISTA_NOMBRE", "ALBUM_NOMBRE", "TITULO"),)),
    Group("user", ("USUARIO_NOMBRE", "GENERACION", "USUARIO_PAIS", "TIPOUSUARIO")),
    Group("cross", ("ANIO", "MES", "ESTACION", "FINDE", "FRANJAHORARIA", "ARTISTA_GENERO", "ARTISTA_NOMBRE",
                    "USUARIO_NOMBRE")),
)


def star_view(fact: DataFrame, dims: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """Fact with the named dimension columns; only the dimensions they need are joined."""
    names = list(names)
    out = fact
    for table in FOREIGN_KEYS.values():
        table = table[0]
        wanted = [n for n in names if DIMENSIONS[n][0] == table]
        if wanted:
            fk = _FK_OF[table]
            side = dims[table].select(F.col(_KEY_OF[table]).alias(fk), *[F.col(DIMENSIONS[n][1]).alias(n) for n in wanted])
            out = lookup_left(out, side, [fk])
    return out


def _raw_partials() -> list[Column]:
    return [
        F.count(F.lit(1)).alias(COUNT),
        *[F.sum(F.col(c).cast("bigint") if c in LONG_SUMS else F.col(c)).alias(m) for m, c in SUMS.items()],
    ]


def _merged_partials() -> list[Column]:
    return [F.sum(m).alias(m) for m in (COUNT, *SUMS)]


def _filtered(fact: DataFrame, dims: Mapping[str, DataFrame], names: Sequence[str], model_filter: str | None) -> DataFrame:
    """Fact rows that satisfy an SQL condition on fact columns and any dimension name."""
    if not model_filter:
        return fact
    # All dimensions are on offer, in any letter case; joins the filter does not use are left out.
    used = [n for n in DIMENSIONS if n in names or re.search(rf"\b{n}\b", model_filter, re.I)]
    return star_view(fact, dims, used).filter(model_filter).select(*fact.columns)


def song_rows(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    names: Sequence[str],
    bitmap: bool = False,
    model_filter: str | None = None,
    segment: str | None = None,
) -> DataFrame:
    """Partials by the named dimensions and ``_song``, or ``_bucket`` with a bitmap ``_songs``.

    ``segment`` keeps that fact column as a further key, for incremental builds.
    """
    fact = _filtered(fact, dims, names, model_filter)
    fks = sorted({_FK_OF[DIMENSIONS[n][0]] for n in names})
    extra = [segment] if segment and segment not in fks else []
    if bitmap:
        song, keep = "_bucket", [F.bitmap_or_agg("_songs").alias("_songs")]
        fact = fact.withColumn("_bucket", F.bitmap_bucket_number("IDCancion"))
        first = [F.bitmap_construct_agg(F.bitmap_bit_position("IDCancion")).alias("_songs")]
    else:
        song, keep, first = "_song", [], []
        fact = fact.withColumn("_song", F.col("IDCancion"))
    # Map-side combine by foreign keys: dimensions join the shrunken rows, not the plays.
    by_keys = fact.groupBy(*fks, *extra, song).agg(*_raw_partials(), *first)
    named = star_view(by_keys, dims, names)
    key = [segment] if segment else []
    return named.groupBy(*names, *key, song).agg(*_merged_partials(), *keep)


def key_density(fact: DataFrame, names: Sequence[str]) -> float:
    """Songs per cell and bucket at the grain of the foreign keys, from two sketches; cells by names are denser still."""
    fks = sorted({_FK_OF[DIMENSIONS[n][0]] for n in names})
    bucket = F.bitmap_bucket_number("IDCancion")
    row = fact.agg(_sketch([*fks, bucket]).alias("cells"), _sketch([*fks, "IDCancion"]).alias("songs")).first()
    return row["songs"] / max(row["cells"] or 0, 1)


def group_base(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    names: Sequence[str],
    bitmap: bool | None = None,
    model_filter: str | None = None,
    segment: str | None = None,
) -> DataFrame:
    """Partials by the named dimensions and song bucket, with the songs as ``_songs`` (bitmap) or ``_ids`` (list).

    Their density decides between both unless ``bitmap`` does.
    """
    if bitmap is None:
        bitmap = key_density(fact, names) >= DENSE_IDS
    rows = song_rows(fact, dims, names, bitmap, model_filter, segment)
    return rows if bitmap else pack(rows, [*names, *([segment] if segment else [])])


def pack(rows: DataFrame, keys: Sequence[str], dense: bool = False) -> DataFrame:
    """Rows by song as one row per cell and bucket; at most 32,768 ids or bits in each."""
    songs = (F.bitmap_construct_agg(F.bitmap_bit_position("_song")).alias("_songs") if dense
             else F.collect_list("_song").alias("_ids"))
    return rows.groupBy(*keys, F.bitmap_bucket_number("_song").alias("_bucket")).agg(*_merged_partials(), songs)


def spread(base: DataFrame) -> DataFrame:
    """A base by ``_song`` where it has lists of ids; the measures of a cell stay with its first id."""
    if "_ids" not in base.columns:
        return base
    keys = [c for c in base.columns if c not in (COUNT, *SUMS, "_bucket", "_ids")]
    rows = base.select(*keys, COUNT, *SUMS, F.posexplode_outer("_ids").alias("_place", "_song"))
    first = F.coalesce("_place", F.lit(0)) == 0
    return rows.select(*keys, "_song", *[F.when(first, F.col(m)).alias(m) for m in (COUNT, *SUMS)])


def _song_columns(rows: DataFrame) -> tuple[str, list[Column], Column]:
    """(song key, how partials of the song merge, final distinct count) of spread rows."""
    if "_songs" in rows.columns:
        return "_bucket", [F.bitmap_or_agg("_songs").alias("_songs")], F.sum(F.bitmap_count("_songs"))
    return "_song", [], F.count("_song")


def merge(base: DataFrame, keys: Sequence[str], dense: bool = False) -> DataFrame:
    """Partials of a base by fewer keys, songs merged: bitmaps stay bitmaps, lists become bitmaps if ``dense``."""
    rows = spread(base)
    song, keep, _ = _song_columns(rows)
    merged = rows.groupBy(*keys, song).agg(*_merged_partials(), *keep)
    return merged if keep else pack(merged, keys, dense)


def _finish(df: DataFrame, keys: Sequence[str], distinct: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*_merged_partials(), distinct.alias(DISTINCT_SONGS)).select(*keys, *MEASURES)


def roll_up(base: DataFrame, names: Sequence[str]) -> DataFrame:
    """Measures by a subset of the base's dimensions."""
    rows = spread(base)
    song, keep, distinct = _song_columns(rows)
    return _finish(rows.groupBy(*names, song).agg(*_merged_partials(), *keep), names, distinct)


def _sketch(columns: Sequence[Column | str]) -> Column:
    """Estimated number of distinct combinations."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*columns), F.lit(SKETCH_LOG)))


def distinct_counts(rows: DataFrame, sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """Estimated number of distinct combinations of every set of columns."""
    used = [c for c in rows.columns if any(c in s for s in sets)]
    # Each column is hashed once a row; a set hashes as the exclusive or of its columns.
    hashed = rows.select(*[F.xxhash64(F.lit(c), c).alias(c) for c in used])
    found: dict[tuple[str, ...], int] = {(): 1}
    wanted = [s for s in dict.fromkeys(sets) if s]
    for at in range(0, len(wanted), SKETCHES):
        some = wanted[at:at + SKETCHES]
        mixed = [" ^ ".join(f"`{c}`" for c in s) for s in some]
        sizes = hashed.selectExpr(*[f"hll_sketch_estimate(hll_sketch_agg({m}, {SKETCH_LOG})) AS n{i}" for i, m in enumerate(mixed)])
        found.update((s, int(n or 0)) for s, n in zip(some, sizes.first()))
    return found


def set_sizes(rows: DataFrame, sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], tuple[int, int]]:
    """Estimated (cells, cells by song key) of every set; ``rows`` are spread."""
    song = _song_columns(rows)[0]
    found = distinct_counts(rows, [*sets, *((*s, song) for s in sets)])
    return {s: (found[s], found[(*s, song)]) for s in sets}


def choose_parents(
    top: tuple[str, ...], sets: Sequence[tuple[str, ...]], rows: Mapping[tuple[str, ...], int], fixed: int = PARENT_ROWS
) -> list[tuple[str, ...]]:
    """Sets of ``rows`` worth storing on the way to ``sets``, greedily: rows saved by those they cover, less what storing them costs.

    Every set starts from the smallest stored one that covers it; ``top`` is stored. Storing shuffles and writes the rows,
    so a set is stored only if it at least halves what it starts from.
    """
    covered = {p: [s for s in sets if set(s) <= set(p)] for p in rows}
    cost = {s: rows[top] for s in sets}
    chosen: list[tuple[str, ...]] = []
    while True:
        best, gain = None, 0
        for p in rows:
            if p != top and p not in chosen:
                source = min(rows[q] for q in [top, *chosen] if set(p) <= set(q))
                saved = sum(max(0, cost[s] - rows[p]) for s in covered[p]) - source - fixed
                if saved > gain and 2 * rows[p] <= source:
                    best, gain = p, saved
        if best is None:
            return chosen
        chosen.append(best)
        for s in covered[best]:
            cost[s] = min(cost[s], rows[best])


def cuboids(
    base: DataFrame, dims: Sequence[str], sets: Sequence[tuple[str, ...]], top: tuple[str, ...] | None = None,
    types: Mapping[str, DataType] | None = None,
) -> DataFrame:
    """All grouping sets of a staged base, with ``cuboid`` = grouping id over ``dims``.

    ``top`` are the dimensions the base holds, if not all; ``types`` those of the others.

    Where that saves more than it costs, sets without one or two dimensions are stored on the way, as bitmaps if their
    cells are dense; sketches tell how far each would shrink. The others expand from the smallest that covers them.
    """
    top = tuple(dims) if top is None else top
    sizes = {top: base.count()}
    # An expand is heavy in rows, not in bytes read, so the partition count of what it reads is not left to size.
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = "_ids" in base.columns and sizes[top] * len(sets) > PARENT_ROWS
    stored: dict[tuple[str, ...], DataFrame] = {top: stage(spread(base).repartition(tasks), "cuboid-parent") if large else spread(base)}

    def source(s: tuple[str, ...]) -> tuple[str, ...]:
        return min((p for p in stored if set(p) >= set(s)), key=lambda p: sizes[p])

    waiting = [top]
    while waiting:
        p = waiting.pop(0)
        mine = [s for s in sets if source(s) == p]
        if sizes[p] * len(mine) <= PARENT_ROWS:
            continue
        song, keep, _ = _song_columns(stored[p])
        fewer = [tuple(d for d in p if d not in out) for n in (1, 2) for out in combinations(p, n)]
        fewer = [c for c in fewer if sum(set(s) <= set(c) for s in mine) > 1]
        found = distinct_counts(stored[p], [(*c, song) for c in [p, *fewer]])
        sizes[p] = found[(*p, song)]
        for c in choose_parents(p, mine, {c: found[(*c, song)] for c in [p, *fewer]}):
            small = stored[source(c)]
            small = stage(small.groupBy(*c, song).agg(*_merged_partials(), *keep).repartition(tasks), "cuboid-parent")
            if not keep and found[(*c, song)] >= DENSE_IDS * distinct_counts(small, [c])[c]:
                small = stage(pack(small, c, dense=True), "cuboid-parent")
            stored[c], sizes[c] = small, small.count()
            waiting.append(c)
    by_source: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
    for s in sets:
        by_source.setdefault(source(s), []).append(s)
    types = {**(types or {}), **{f.name: f.dataType for f in base.schema.fields}}
    return union_all([expand(stored[p], dims, mine, types, sizes[p]) for p, mine in by_source.items()])


def expand(
    rows: DataFrame, dims: Sequence[str], sets: Sequence[tuple[str, ...]], types: Mapping[str, DataType], size: int = 0
) -> DataFrame:
    """Measures of the sets from spread rows that hold all their dimensions; ``size`` is about how many there are.

    Where they make many cells, the sets with the dimension of most values are computed by its values, then those of the
    others with the next one. The rest, of few values, combine before the shuffle, at most SETS_PER_EXPAND in one expand.
    """
    parts: list[DataFrame] = []
    if size * len(sets) > EXPANDED_ROWS:
        held = [d for d in dims if d in rows.columns]
        counts = distinct_counts(rows, [(d,) for d in held])
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        for key in sorted(held, key=lambda d: -counts[(d,)]):
            mine = [s for s in sets if key in s]
            if counts[(key,)] >= tasks and size * len(mine) > EXPANDED_ROWS:
                parts += expand_by_key(rows, dims, mine, types, size, key)
                sets = [s for s in sets if key not in s]
    if sets:
        parts.append(expand_shuffled(rows, dims, sets, types))
    return union_all(parts)


def expand_by_key(
    rows: DataFrame, dims: Sequence[str], sets: Sequence[tuple[str, ...]], types: Mapping[str, DataType], size: int, key: str
) -> list[DataFrame]:
    """Measures of sets that all hold ``key``: rows are dealt by its values once, so no cell leaves its task.

    Rows of values that fill a task are dealt by song too; their cells combine in the tasks, then across them.
    """
    song, keep, distinct = _song_columns(rows)
    tasks = -(-size * len(sets) // EXPANDED_ROWS)
    # At most one value a task and a half.
    hot = rows.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(hot.filter(F.col("_n") * len(sets) > 2 * EXPANDED_ROWS).select("_hot"), "hot-values")
    dealt = [(rows, [key])]
    if not hot.isEmpty():
        same = F.col(key).eqNullSafe(F.col("_hot"))
        dealt = [(rows.join(F.broadcast(hot), same, "left_anti"), [key]), (rows.join(F.broadcast(hot), same, "left_semi"), [key, song])]
    out = {s: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s) for s in sets}

    def value(d: str, i: int) -> Column:
        inside = sum(d in s for s in sets)
        if not inside:
            return F.lit(None).cast(types[d]).alias(d)
        if inside == len(sets):
            return F.col(d)
        return F.when(F.col("cuboid").bitwiseAND(F.lit(1 << (len(dims) - 1 - i))) == 0, F.col(d)).alias(d)

    parts = []
    for some, by in dealt:
        each = some.repartition(tasks, *by).withColumn("cuboid", F.explode(F.array(*[F.lit(n).cast("long") for n in out.values()])))
        rest = [c for c in rows.columns if c not in DIMENSIONS and c != song]
        each = each.select("cuboid", *[value(d, i) for i, d in enumerate(dims)], song, *rest)
        per_song = each.groupBy("cuboid", *dims, song).agg(*_merged_partials(), *keep)
        parts.append(_finish(per_song, ["cuboid", *dims], distinct))
    return parts


def expand_shuffled(rows: DataFrame, dims: Sequence[str], sets: Sequence[tuple[str, ...]], types: Mapping[str, DataType]) -> DataFrame:
    """Measures of sets of few cells, at most SETS_PER_EXPAND in one expand."""
    song, keep, distinct = _song_columns(rows)
    used = {d for s in sets for d in s}
    rest = [c for c in rows.columns if c not in DIMENSIONS and c != song]
    rows = rows.select(*[F.col(d) if d in used else F.lit(None).cast(types[d]).alias(d) for d in dims], song, *rest)
    parts = []
    for at in range(0, len(sets), SETS_PER_EXPAND):
        per_song = rows.groupingSets([[*s, song] for s in sets[at:at + SETS_PER_EXPAND]], *dims, song).agg(
            F.shiftright(F.grouping_id(), 1).alias("cuboid"), *_merged_partials(), *keep
        )
        parts.append(_finish(per_song, ["cuboid", *dims], distinct))
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def derived_averages(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Averages as sum over count."""
    return df.withColumns({n: F.try_divide(F.col(AVERAGES[n]), F.col(COUNT)) for n in names})


@dataclass
class Cube:
    """Built bases by group and stored cuboids; queries take the smallest that covers them, else the star itself."""

    fact: DataFrame
    dims: Mapping[str, DataFrame]
    groups: Sequence[Group] = GROUPS
    model_filter: str | None = None
    bases: dict[str, DataFrame] = field(default_factory=dict)
    # A CuboidStore of the same model filter.
    store: Any = None

    def build(self, names: Iterable[str] | None = None, path: str | None = None) -> "Cube":
        """Materialise the bases of the named groups (all by default), below ``path`` if given."""
        wanted = set(names) if names is not None else {g.name for g in self.groups}
        for g in self.groups:
            if g.name not in wanted:
                continue
            base = group_base(self.fact, self.dims, g.dims, g.bitmap, self.model_filter)
            if path:
                base.write.mode("overwrite").parquet(f"{path}/{g.name}")
                base = self.fact.sparkSession.read.schema(base.schema).parquet(f"{path}/{g.name}")
            else:
                base = stage(base, "cube-" + g.name)
            self.bases[g.name] = base
        return self

    def group(self, name: str) -> Group:
        return next(g for g in self.groups if g.name == name)

    def cuboids(self, name: str) -> DataFrame:
        """All cuboids of a group, from its base if it was built."""
        g = self.group(name)
        base = self.bases.get(name)
        if base is None:
            # Lists of ids would be spread again at once.
            bitmap = key_density(self.fact, g.dims) >= DENSE_IDS if g.bitmap is None else g.bitmap
            base = stage(song_rows(self.fact, self.dims, g.dims, bitmap, self.model_filter), "cube-" + name)
        return cuboids(base, g.dims, g.grouping_sets())

    def write_cuboids(self, path: str) -> None:
        for g in self.groups:
            # Rebalanced by cuboid: few files each, however many tasks computed it.
            self.cuboids(g.name).hint("rebalance", "cuboid").write.mode("overwrite").partitionBy("cuboid").parquet(f"{path}/{g.name}")

    def full_base(self) -> DataFrame:
        """Partials over all dimensions, the source for combinations no group covers."""
        return group_base(self.fact, self.dims, list(DIMENSIONS), None, self.model_filter)

    def query(
        self, dims: Sequence[str], measures: Sequence[str] = MEASURES, where: Mapping[str, object] | None = None
    ) -> DataFrame:
        """Measures by any dimensions; ``where`` maps a dimension to a value or a list of values."""
        where = dict(where or {})
        needed = list(dict.fromkeys([*dims, *where]))
        covering = [self.bases[g.name] for g in self.groups if g.name in self.bases and set(needed) <= set(g.dims)]
        if self.store is not None:
            if self.store.model_filter != self.model_filter:
                raise ValueError("the stored cuboids were built with another model filter")
            stored = self.store.covering(needed)
            covering += [self.store.read(stored)] if stored else []
        if covering:
            base = min(covering, key=estimated_bytes)
        else:
            base = song_rows(self.fact, self.dims, needed, False, self.model_filter)
        for d, value in where.items():
            values = list(value) if isinstance(value, (list, tuple, set)) else [value]
            base = base.filter(F.col(d).isin(*values))
        out = roll_up(base, dims)
        return derived_averages(out, [m for m in measures if m in AVERAGES]).select(*dims, *measures)


def refresh_segments(
    fact: DataFrame, dims: Mapping[str, DataFrame], group: Group, path: str, days: Sequence[int] | None = None
) -> None:
    """Rebuild the day segments of a group base; all other segments stay untouched."""
    if days is not None:
        fact = fact.filter(F.col("IDDate").isin(*days))
    base = group_base(fact, dims, group.dims, group.bitmap, segment="IDDate").withColumnRenamed("IDDate", "segmento")
    # Rebalanced: few files per day, and a day that is too large for one task is split.
    base = base.hint("rebalance", "segmento")
    base.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segmento").parquet(path)


def compact_segments(segments: DataFrame, days: int) -> DataFrame:
    """Merge day segments into spans of ``days`` days (7 and 28 are usual); ``segmento`` is the first day."""
    day = F.to_date(F.col("segmento").cast("string"), "yyyyMMdd")
    first = F.date_sub(day, F.pmod(F.unix_date(day), F.lit(days)).cast("int"))
    span = F.when(F.col("segmento") < 0, F.col("segmento")).otherwise(F.date_format(first, "yyyyMMdd").cast("int"))
    rows = segments.withColumn("segmento", span)
    return merge(rows, [c for c in rows.columns if c not in (COUNT, *SUMS, "_bucket", "_songs", "_ids")])


def mean_by(fact: DataFrame, dims: Mapping[str, DataFrame], names: Sequence[str], feature: str) -> DataFrame:
    """Play count and mean feature by dimensions, straight from the star."""
    base = fact.groupBy(*sorted({_FK_OF[DIMENSIONS[n][0]] for n in names})).agg(
        F.count(F.lit(1)).alias("n"), F.sum(feature).alias("s")
    )
    out = star_view(base, dims, names).groupBy(*names).agg(F.sum("n").alias("plays"), F.sum("s").alias("s"))
    return out.select(*names, "plays", F.try_divide("s", "plays").alias(f"avg_{feature}"))
