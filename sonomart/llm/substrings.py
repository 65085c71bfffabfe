"""Passages of ``WINDOW`` words or more that repeat across documents, found and removed but for their first document.

A window is ``WINDOW`` consecutive words of one document; it repeats if a smaller document id has the same words
somewhere. The search narrows what it looks at, then locates occurrences exactly:

1. *Candidates.* Of the word groups inside a window the one with the least hash is its anchor, so equal windows have equal
   anchors. Anchors that lie in one document only rule out nearly all windows at a small part of their number.
2. *Confirmed passages.* The other windows are counted by a 128-bit hash. Those in two documents are recurring, and the
   least id that holds one is its owner. Runs of windows that a document owns are passages; runs of windows that
   another document shares with one owner are segments of that document.
3. *Sharded automata.* Passages are dealt to shards of bounded size. A shard cuts them into blocks of half a window,
   every window of a passage holds a whole block, and compiles the blocks to one Aho-Corasick automaton over words. All
   segments stream through the automata of their owners' shards. Each hit compares words on both sides, and only windows
   that stand there word by word count.

Documents with equal words collapse first, so of a group of copies only the least id is searched. Hot windows meet in
partial aggregations and in joins that adaptive execution splits; the segments of a hot owner spread over several
shards, each with the owner's passages.

Defined results
---------------
* Words are runs of bytes other than space and the controls 9 to 13, compared byte by byte. Null and empty texts have none.
* A null id is neither smaller nor larger than others: nothing is removed from it, and it removes nothing. Rows that
  repeat an id do not remove from each other.
* Windows are judged on the input, not on what is left. Empty tables give empty results.
* A long text takes some 100 bytes of memory a word while it is searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonomart.llm.filteraudit import pieces
from sonomart.llm.forest import _mix, _stream, _word_hashes
from sonomart.operators.staging import stage

WINDOW = 50
# Words of a group; a window has WINDOW - GRAM + 1 of them, and about every (WINDOW - GRAM + 2) / 2 words an anchor.
GRAM = 10
BLOCK = WINDOW // 2
# Words of passages that one automaton holds, and of segments that one shard streams.
SHARD_WORDS, STREAM_WORDS = 100_000, 100_000
# Rows of 16 bytes; more documents are joined through the shuffle.
BROADCAST_ROWS = 500_000
PIECE_BYTES = 1 << 20
# Rows or bytes after which a task hands on what it has found.
OUT_ROWS, OUT_BYTES = 100_000, 4 << 20

SPANS = T.ArrayType(T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))

_U = np.uint64
_SEEDS = _stream(31, 4) | _U(1)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def word_hashes(data: bytes) -> np.ndarray:
    found = [_word_hashes(piece)[1] for piece in pieces(data, PIECE_BYTES)]
    return np.concatenate(found) if found else np.zeros(0, _U)


def run_hashes(words: np.ndarray, width: int, seed: np.uint64) -> np.ndarray:
    """Hash of every run of ``width`` words, from runs of half the length."""
    if len(words) < width:
        return np.zeros(0, _U)
    joined, covered, size, runs = None, 0, 1, _mix(words ^ seed)
    while True:
        if width & size:
            if joined is None:
                joined = runs
            else:
                n = min(len(joined), len(runs) - covered)
                joined = _mix(joined[:n] * seed + runs[covered:covered + n])
            covered += size
        if 2 * size > width:
            return joined[:len(words) - width + 1]
        runs = _mix(runs[:len(runs) - size] * seed + runs[size:])
        size *= 2


def window_anchors(words: np.ndarray) -> np.ndarray:
    """For every window the least hash of the word groups in it."""
    least, span, width = run_hashes(words, GRAM, _SEEDS[0]), WINDOW - GRAM + 1, 1
    if len(words) < WINDOW:
        return np.zeros(0, _U)
    while 2 * width <= span:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    rest = span - width
    return np.minimum(least[:len(least) - rest], least[rest:])


def words_digest(data: bytes) -> tuple[int, str]:
    """Number of words, and SHA-256 of the words joined by one space."""
    n, digest = 0, hashlib.sha256()
    for piece in pieces(data, PIECE_BYTES):
        words = piece.split()
        if words:
            digest.update((b" " if n else b"") + b" ".join(words))
            n += len(words)
    return n, digest.hexdigest()


_SIGNED = "doc_id {id}, text_key long, n_words long, words_sha256 string, anchors array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, digests, anchors = [], [], []
        for text in batch.column("text"):
            data = text.as_py() or b""
            n, digest = words_digest(data)
            numbers.append(n), digests.append(digest)
            anchors.append(np.unique(window_anchors(word_hashes(data))).view(np.int64) if n >= WINDOW else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(numbers, pa.int64()), pa.array(digests),
             pa.array(anchors, pa.list_(pa.int64()))], names=["doc_id", "text_key", "n_words", "words_sha256", "anchors"])


def _found(ids: list, schema: pa.Schema, columns: dict[str, np.ndarray], counts: list[int]) -> pa.RecordBatch:
    """Arrays of several documents beside their (id, key)."""
    at = pa.array(np.repeat(np.arange(len(ids)), counts))
    own = [pa.array([i[c] for i in ids], schema.field(name).type).take(at) for c, name in enumerate(("id", "key"))]
    return pa.RecordBatch.from_arrays([*own, *map(pa.array, columns.values())], names=["id", "key", *columns])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct windows of every document whose anchor recurs."""
    for batch in batches:
        ids, found, rows = [], [], 0
        for i in range(batch.num_rows):
            words = word_hashes(batch.column("text")[i].as_py())
            hot = np.sort(batch.column("hot")[i].values.to_numpy().view(_U))
            anchors = window_anchors(words)
            at = np.minimum(np.searchsorted(hot, anchors), len(hot) - 1)
            take = hot[at] == anchors
            one, two = (run_hashes(words, WINDOW, s)[take] for s in _SEEDS[1:3])
            _, first = np.unique(one, return_index=True)
            ids.append((batch.column("id")[i].as_py(), batch.column("key")[i].as_py()))
            found.append((one[first].view(np.int64), two[first].view(np.int64)))
            rows += len(first)
            if rows >= OUT_ROWS or i + 1 == batch.num_rows:
                columns = {name: np.concatenate([f[c] for f in found]) for c, name in enumerate(("w1", "w2"))}
                yield _found(ids, batch.schema, columns, [len(f[0]) for f in found])
                ids, found, rows = [], [], 0


_SEGMENT = "owner_id {id}, owner_key long, kind int, id {id}, key long, start long, n long, words binary"


def _runs(me: tuple, data: bytes, marks: pa.StructArray) -> list[tuple]:
    """Rows of _SEGMENT of one document."""
    owners: dict[tuple, int] = {}
    numbers = [owners.setdefault(o, len(owners)) for o in zip(*(marks.field(c).to_pylist() for c in ("owner_id", "owner_key")))]
    named = marks.field("w1").to_numpy().view(_U)
    order = np.argsort(named)
    named, numbers = named[order], np.array(numbers)[order]
    one = run_hashes(word_hashes(data), WINDOW, _SEEDS[1])
    at = np.minimum(np.searchsorted(named, one), len(named) - 1)
    owner = np.where(named[at] == one, numbers[at], -1)
    edges = np.flatnonzero(np.diff(owner, prepend=-2, append=-2))
    words, known, out = data.split(), list(owners), []
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if owner[lo] >= 0:
            by, some = known[owner[lo]], words[lo:hi + WINDOW - 1]
            out.append((*by, int(by != me), *me, lo, len(some), b" ".join(some)))
    return out


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of marked windows of one owner: kind 0 the owner's own passages, kind 1 segments of others."""
    for batch in batches:
        id_type = batch.schema.field("id").type
        types = (id_type, pa.int64(), pa.int32(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary())
        out, size = [], 0
        for i in range(batch.num_rows):
            me = batch.column("id")[i].as_py(), batch.column("key")[i].as_py()
            runs = _runs(me, batch.column("text")[i].as_py(), batch.column("marks")[i].values)
            out += runs
            size += sum(len(r[-1]) for r in runs)
            if out and (size >= OUT_BYTES or i + 1 == batch.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)],
                    names=["owner_id", "owner_key", "kind", "id", "key", "start", "n", "words"])
                out, size = [], 0


def _common(left, right) -> int:
    n = 0
    for a, b in zip(left, right):
        if a != b:
            break
        n += 1
    return n


def disjoint(stretches) -> list[list[int]]:
    """Stretches [from, to) with those that touch joined, in order."""
    out: list[list[int]] = []
    for lo, hi in sorted(stretches):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


class Shard:
    """Passages as blocks of words in one automaton, with the words on both sides of each block."""

    def __init__(self):
        self.names: dict[bytes, int] = {}
        self.blocks: dict[tuple, int] = {}
        # (block, owner): distinct surroundings, the left one read backwards.
        self.around: dict[tuple, set] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self.made = False

    def add(self, owner, words: list[bytes]) -> None:
        ids = [self.names.setdefault(w, len(self.names) + 1) for w in words]
        for at in range(0, len(ids) - BLOCK + 1, BLOCK):
            block = tuple(ids[at:at + BLOCK])
            number = self.blocks.get(block)
            if number is None:
                number = self.blocks[block] = len(self.blocks)
                self.automaton.add_word(block, number)
            sides = tuple(ids[max(0, at - BLOCK):at][::-1]), tuple(ids[at + BLOCK:at + 2 * BLOCK])
            self.around.setdefault((number, owner), set()).add(sides)

    def ranges(self, owner, words: list[bytes]) -> list[list[int]]:
        """Disjoint stretches [from, to) covered by windows that stand in the owner's passages."""
        if not self.made:
            self.automaton.make_automaton()
            self.made = True
        ids = tuple(self.names.get(w, 0) for w in words)
        found = []
        for end, number in self.automaton.iter(ids) if self.blocks and len(ids) >= BLOCK else ():
            at = end - BLOCK + 1
            here = ids[max(0, at - BLOCK):at][::-1], ids[at + BLOCK:at + 2 * BLOCK]
            for left, right in self.around.get((number, owner), ()):
                before, after = _common(here[0], left), _common(here[1], right)
                if before + after >= WINDOW - BLOCK:
                    found.append([at - before, at + BLOCK + after])
        return disjoint(found)


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task come by shard, passages first; one shard's automaton is held at a time."""
    number, shard = None, None
    for batch in batches:
        out = []
        kind_of = [batch.column(c).to_pylist() for c in ("shard", "kind", "owner_id", "owner_key", "id", "key", "start")]
        for i, (at, kind, *owner, id_, key, start) in enumerate(zip(*kind_of)):
            if at != number:
                number, shard = at, Shard()
            words = batch.column("words")[i].as_py().split()
            if kind == 0:
                shard.add(tuple(owner), words)
            else:
                out += [(id_, key, start + lo, start + hi) for lo, hi in shard.ranges(tuple(owner), words)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (batch.schema.field("id").type, pa.int64(), pa.int64(), pa.int64()))],
                names=["id", "key", "from", "to"])


def _sharded(segments: DataFrame) -> DataFrame:
    """Passages and segments with a shard; an owner whose segments are many is in several."""
    owner = ["owner_id", "owner_key"]
    loads = segments.groupBy(*owner).agg(
        F.sum(F.when(F.col("kind") == 1, F.col("n")).otherwise(0)).alias("load"), F.sum(F.when(F.col("kind") == 0, F.col("n")).otherwise(0)).alias("own"))
    loads = stage(loads.withColumn("salts", F.ceil(F.greatest(F.col("load"), F.lit(1)) / STREAM_WORDS)), "substrings-loads")
    total = loads.agg(F.sum(F.col("own") * F.col("salts")), F.sum("load")).first()
    shards = max(1, -(-int(total[0] or 0) // SHARD_WORDS), -(-int(total[1] or 0) // STREAM_WORDS))
    dealt = segments.join(loads.select(*owner, "salts"), owner)
    passages = dealt.filter("kind = 0").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    others = dealt.filter("kind = 1").withColumn("salt", F.pmod(F.xxhash64("id", "key", "start"), F.col("salts")))
    both = passages.unionByName(others).withColumn("shard", F.pmod(F.xxhash64(*owner, "salt"), F.lit(shards))).drop("salts", "salt")
    tasks = min(shards, int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(tasks, "shard").sortWithinPartitions("shard", "kind")


@F.pandas_udf(SPANS)
def _disjoint(spans: pd.Series) -> pd.Series:
    return pd.Series([[{"from": lo, "to": hi} for lo, hi in disjoint((s["from"], s["to"]) for s in some)] for some in spans])


class Search:
    """Stored results of one search: signed rows, the least id of each word sequence, and spans of those documents."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                           F.col(text_col).cast("binary").alias("text"))
        kind = rows.schema["doc_id"].dataType.simpleString()
        self.signed = stage(rows.mapInArrow(_signed, _SIGNED.format(id=kind)), "substrings-signed")
        least = F.min(F.struct("doc_id", "text_key")).alias("least")
        long = self.signed.filter(f"doc_id IS NOT NULL AND n_words >= {WINDOW}")
        self.firsts = stage(long.groupBy("words_sha256").agg(least, F.first("anchors").alias("anchors")).select(
            "words_sha256", F.col("least.doc_id").alias("id"), F.col("least.text_key").alias("key"), "anchors"), "substrings-firsts")

        anchors = self.firsts.select("id", "key", F.explode("anchors").alias("anchor"))
        recurring = anchors.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
        recurring = stage(recurring.select("anchor"), "substrings-anchors")
        wanted = stage(anchors.join(recurring, "anchor").groupBy("id", "key").agg(F.collect_list("anchor").alias("hot")),
                       "substrings-wanted")
        keys = wanted.select("id", "key")
        keys = F.broadcast(keys) if wanted.count() <= BROADCAST_ROWS else keys
        texts = rows.join(keys, (F.col("doc_id") == F.col("id")) & (F.col("text_key") == F.col("key")))
        texts = stage(texts.groupBy("id", "key").agg(F.first("text").alias("text")), "substrings-texts")

        windows = stage(texts.join(wanted, ["id", "key"]).select("id", "key", "text", "hot").mapInArrow(
            _windows, f"id {kind}, key long, w1 long, w2 long"), "substrings-windows")
        owned = windows.groupBy("w1", "w2").agg(
            F.min("id").alias("owner_id"), F.min_by("key", "id").alias("owner_key"), F.max("id").alias("last"))
        owned = stage(owned.filter("owner_id < last").drop("last"), "substrings-owned")
        later = windows.join(owned, ["w1", "w2"]).filter("id > owner_id").select("id", "key", "owner_id", "owner_key", "w1")
        marks = later.unionByName(owned.select(F.col("owner_id").alias("id"), F.col("owner_key").alias("key"), "owner_id", "owner_key", "w1"))
        marks = marks.groupBy("id", "key").agg(F.collect_list(F.struct("owner_id", "owner_key", "w1")).alias("marks"))
        segments = stage(texts.join(marks, ["id", "key"]).select("id", "key", "text", "marks").mapInArrow(
            _segments, _SEGMENT.format(id=kind)), "substrings-segments")
        located = _sharded(segments).mapInArrow(_located, f"id {kind}, key long, `from` long, `to` long")
        spans = located.groupBy("id", "key").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
        self.texts, self.spans = texts, stage(spans.withColumn("spans", _disjoint("spans")), "substrings-spans")

    def _rows(self, found: DataFrame) -> DataFrame:
        """Signed rows beside what was found of the least id with the same words."""
        firsts = self.firsts.drop("anchors").join(found, ["id", "key"], "left").drop("key")
        return self.signed.drop("anchors").join(firsts, "words_sha256", "left")

    def repeats(self) -> DataFrame:
        """Rows (doc_id, text_key, n_words, words_sha256, spans): disjoint word stretches [from, to) to remove."""
        whole = F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("n_words").alias("to")))
        spans = F.when(F.col("doc_id") > F.col("id"), whole).when(F.col("doc_id") == F.col("id"), F.col("spans"))
        return self._rows(self.spans).select(
            "doc_id", "text_key", "n_words", "words_sha256", F.coalesce(spans, F.array().cast(SPANS)).alias("spans"))

    def report(self) -> DataFrame:
        """Rows (doc_id, n_words, n_removed, kept_sha256); the digest is of the kept words joined by one space."""
        gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
        cut = self.texts.join(self.spans, ["id", "key"]).select(
            "id", "key", gone.alias("gone"), F.sha2(without("text", "spans"), 256).alias("cut_sha256"))
        copy, first = F.col("doc_id") > F.col("id"), (F.col("doc_id") == F.col("id")) & F.col("gone").isNotNull()
        return self._rows(cut).select(
            "doc_id", "n_words", F.when(copy, F.col("n_words")).when(first, F.col("gone")).otherwise(0).alias("n_removed"),
            F.when(copy, _EMPTY_SHA).when(first, F.col("cut_sha256")).otherwise(F.col("words_sha256")).alias("kept_sha256"))


@F.pandas_udf(T.StringType())
def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Words outside the spans, joined by one space."""
    out = []
    for text, cut in zip(texts, spans):
        words = text.split() if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass").split()
        kept, at = [], 0
        for s in cut:
            kept += words[at:s["from"]]
            at = s["to"]
        out.append(b" ".join(kept + words[at:]).decode("utf-8", "surrogatepass"))
    return pd.Series(out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated passages cut out; other texts stay as they are."""
    found = Search(docs, id_col, text_col).repeats().filter("size(spans) > 0").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"), F.col("spans").alias("_gone_spans"))
    found = stage(found.dropDuplicates(["_gone_id", "_gone_key"]), "substrings-found")
    same = (docs[id_col] == found["_gone_id"]) & (F.xxhash64(docs[text_col]) == found["_gone_key"])
    cut = F.when(F.col("_gone_spans").isNull(), docs[text_col]).otherwise(without(docs[text_col], F.coalesce("_gone_spans", F.array().cast(SPANS))))
    return docs.join(found, same, "left").select(*[(cut.alias(c) if c == text_col else docs[c]) for c in docs.columns])
