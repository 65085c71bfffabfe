"""Interaction of document filters, audited in every order by a walk over their subsets.

Each document fails some set of the filters, its mask. Counts by part and mask, at most ``2 ** len(FILTERS)`` cells a
part, hold all there is to know. A walk in Gray code visits every subset of active filters by toggling one filter at
a time: every cell has a counter of active filters that it fails, a cell whose counter leaves zero leaves the running
survivors, one that comes back to zero returns. The survivors of every state are stored, and each step of each order
is the difference of two states.

Filters, as what fails them: A under 200 words; B fewer distinct words than half of the words; C capital ASCII letters
above 2 % of the code points; D one of ``#$%&*|``; E the text of a smaller id, in the whole table.

Equal texts share a digest and all other masks, so E needs the least id of each digest only: rows are counted by
(digest, mask, part, labels) before the digests meet, and no group of copies stands in one task.

Defined results
---------------
* Null text counts as empty, so null and empty texts are copies of each other. A null source is the part ''.
* A null id is smaller than none and none is smaller than it: it neither fails E nor makes others fail. Rows that
  repeat the least id of a text all pass E.
* A document with several label rows has a property if any row says so; without label rows it has none.
* Every part has all rows, zeros included; no documents, no rows. Other columns are not read.
* Texts are read in pieces, so memory grows only with the distinct words of one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sonomart.operators.staging import stage

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SPECIAL = 200, 50, 2, b"#$%&*|"
PIECE_BYTES = 1 << 16

_COPY = 1 << FILTERS.index("E")
_CELLS = 1 << len(FILTERS)
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SPACE = b" \t\n\x0b\x0c\r"


def pieces(data: bytes, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """Slices of about ``most`` bytes that cut no word."""
    at = 0
    while at < len(data):
        stop = at + most
        while stop < len(data) and data[stop] not in _SPACE:
            stop += 1
        yield data[at:stop]
        at = stop


def text_mask(data: bytes, chars: int) -> int:
    """Bits of the filters that a text fails by itself."""
    n, distinct, capitals, special = 0, set(), 0, False
    for piece in pieces(data):
        words = piece.split()
        n += len(words)
        distinct.update(words)
        capitals += len(piece) - len(piece.translate(None, _CAPITALS))
        special = special or len(piece.translate(None, SPECIAL)) < len(piece)
    failed = (n < LEAST_WORDS, 100 * len(distinct) < DISTINCT_PERCENT * n, 100 * capitals > CAPITAL_PERCENT * chars, special)
    return sum(bit << k for k, bit in enumerate(failed))


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_mask(t.as_py(), n) for t, n in zip(batch.column("text"), batch.column("chars").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", "part", "digest"]).columns, pa.array(found, pa.int32())],
                                         names=["doc_id", "part", "digest", "mask"])


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Rows (part, mask, docs, good, toxic): documents by the set of filters that they fail."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.cast("binary").alias("text"), F.length(text).alias("chars"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = stage(rows.mapInArrow(_masks, f"doc_id {kind}, part string, digest binary, mask int"), "audit-masks")
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    said = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    labelled = rows.filter("doc_id IS NOT NULL").join(said, "doc_id", "left")
    unknown = rows.filter("doc_id IS NULL").withColumns({"good": F.lit(None).cast("boolean"), "toxic": F.lit(None).cast("boolean")})
    rows = labelled.unionByName(unknown).fillna(False, ["good", "toxic"])

    known = F.when(F.col("doc_id").isNotNull(), F.col("n"))
    groups = rows.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(known), F.lit(0)).alias("known"), F.min("doc_id").alias("least"),
        F.min_by(known, "doc_id").alias("at_least"))
    first = F.min("least").over(Window.partitionBy("digest"))
    copies = F.col("known") - F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = groups.withColumn("first", first).withColumn("copies", F.coalesce(copies, F.lit(0)))
    both = F.array(F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
                   F.struct((F.col("mask") + _COPY).alias("mask"), F.col("copies").alias("n")))
    split = split.select("part", "good", "toxic", F.explode(both).alias("c")).select("part", "good", "toxic", "c.mask", "c.n")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def survivors(counts: np.ndarray) -> np.ndarray:
    """Survivors of every subset of active filters, by a Gray-code walk; ``counts`` is (parts, cells, measures)."""
    states = np.zeros_like(counts)
    failures = np.zeros(_CELLS, np.int64)
    masks = np.arange(_CELLS)
    running = counts.sum(axis=1)
    states[:, 0] = running
    active = 0
    for step in range(1, _CELLS):
        toggled = (step & -step).bit_length() - 1
        hit = (masks >> toggled) & 1 == 1
        active ^= 1 << toggled
        if active >> toggled & 1:
            leaving = hit & (failures == 0)
            failures[hit] += 1
            running = running - counts[:, leaving].sum(axis=1)
        else:
            failures[hit] -= 1
            running = running + counts[:, hit & (failures == 0)].sum(axis=1)
        states[:, active] = running
    return states


_ORDERS = ["".join(p) for p in permutations(FILTERS)]
_ROW = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All orders and steps of every part of a batch: differences of two states each."""
    filters = np.array([[FILTERS.index(f) for f in order] for order in _ORDERS])
    after = np.cumsum(1 << filters, axis=1)
    before = after - (1 << filters)
    filters, after, before = filters.ravel(), after.ravel(), before.ravel()
    orders, steps = np.repeat(_ORDERS, len(FILTERS)), np.tile(np.arange(1, len(FILTERS) + 1), len(_ORDERS)).astype(np.int32)
    every = _CELLS - 1
    for batch in batches:
        for part, held in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
            counts = np.zeros((1, _CELLS, 3), np.int64)
            for cell in held:
                counts[0, cell["mask"]] = cell["docs"], cell["good"], cell["toxic"]
            kept = survivors(counts)[0]
            lost = kept[before] - kept[after]
            failing = kept[0, 0] - kept[1 << filters, 0]
            unique = kept[every - (1 << filters), 0] - kept[every, 0]
            shapley = np.zeros(len(FILTERS), np.int64)
            np.add.at(shapley, filters, lost[:, 0])
            columns = [pa.array([part] * len(steps), pa.string()), pa.array(orders), pa.array(steps)]
            columns += [pa.array(c) for c in (kept[after, 0], lost[:, 0], failing - lost[:, 0], unique, lost[:, 1], lost[:, 2],
                                              shapley[filters])]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _ROW.split(", ")])


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step; see the module for the columns read."""
    by_part = cells(docs, labels, **columns).groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells"))
    return by_part.mapInArrow(_steps, _ROW)
